"""Problem definition: every tunable of the engine with its default.

The task: for each customer with at least one order before a cutoff, will they
order again in the ``horizon_days`` from that cutoff on?
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

# The published monthly design.
CUTOFFS = [
    "2011-03-01", "2011-04-01", "2011-05-01", "2011-06-01", "2011-07-01",
    "2011-08-01", "2011-09-01", "2011-10-01", "2011-11-01",
]
DEV_CUTOFFS = CUTOFFS[:7]
TEST_CUTOFFS = CUTOFFS[7:]
HORIZON_DAYS = 30
MIN_HISTORY_DAYS = 30
CAMPAIGN_CAPACITY = 0.20
CONTACT_COST = 1.50
INCREMENTAL_MARGIN = 28.0
CAPACITIES = (0.05, 0.10, 0.20, 0.30, 0.50)
SEED = 42
HOME_MARKET = "United Kingdom"

# Trailing windows, in days before the cutoff.
WINDOW_DAYS = (30, 60, 90, 180)

# Money is summed in whole minor units so that sums do not depend on row order.
MONEY_DECIMALS = 2


@dataclass(frozen=True)
class SnapshotSettings:
    """What one snapshot run needs to know."""

    cutoffs: tuple | None = tuple(CUTOFFS)
    horizon_days: int = HORIZON_DAYS
    min_history_days: int = MIN_HISTORY_DAYS
    home_market: str = HOME_MARKET

    def ordered_cutoffs(self) -> list[datetime]:
        """The cutoffs in time order; none given means the published ones."""
        return parse_cutoffs(self.cutoffs or CUTOFFS)


def parse_cutoffs(cutoffs) -> list[datetime]:
    """Distinct cutoffs in time order, from ISO text or datetime values."""
    parsed = {c if isinstance(c, datetime) else datetime.fromisoformat(str(c)) for c in cutoffs}
    if not parsed:
        raise ValueError("at least one cutoff is required")
    return sorted(parsed)
