"""Leakage audit: prove on the data at hand that no feature moves with the future.

For every cutoff and every way of changing what comes after it there is a copy of the lines. All
copies are moved in time so that their cutoffs fall on one day, which changes no feature, and go
through a single plan; their features are then compared with those of the unchanged lines. Lines
are brought together by customer first and copied there, so that no copy is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import SnapshotSettings, parse_cutoffs
from tidemark.functions.scalars import count_reached, timestamp
from tidemark.operators.ranking import union_all
from tidemark.operators.snapshots import FEATURES, build_snapshots, placed, snapshot

CHANGES = ("deleted", "inflated")
_AMOUNTS = ("quantity", "unit_price", "line_revenue")


def changed_futures(transactions: DataFrame, cutoffs, changes: Iterable[str] = CHANGES,
                    factor: int = 1000) -> DataFrame:
    """A copy of the lines per (cutoff, change), with both as columns: the lines from the cutoff
    on are deleted, or their amounts multiplied."""
    unknown = set(changes) - set(CHANGES)
    if unknown:
        raise ValueError(f"unknown change {sorted(unknown)}; known are {CHANGES}")
    copies = F.explode(F.array(*[
        F.struct(timestamp(m).alias("cutoff"), F.lit(change).alias("change"))
        for m in parse_cutoffs(cutoffs) for change in changes]))
    future = F.col("invoice_date") >= F.col("copy.cutoff")
    inflated = future & (F.col("copy.change") == "inflated")
    lines = transactions.withColumn("copy", copies).filter(
        ~(future & (F.col("copy.change") == "deleted")))
    return lines.select(
        *[F.when(inflated, F.col(c) * factor).otherwise(F.col(c)).alias(c) if c in _AMOUNTS
          else F.col(c) for c in transactions.columns], "copy.*")


def _same(name: str, tolerance: float) -> Column:
    a, b = F.col(f"a.{name}"), F.col(f"b.{name}")
    near = F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    return (a.isNull() & b.isNull()) | F.coalesce(near, F.lit(False))


def leakage_audit(transactions: DataFrame, settings: SnapshotSettings, changes=CHANGES,
                  tolerance: float = 1e-9, original: DataFrame | None = None) -> DataFrame:
    """One row per (cutoff, change): rows compared, rows whose features moved, labels before and
    after. Zero moved rows is the pass.

    ``original`` may be the stored snapshots of the same settings; they are built if it is not
    given. Features are compared within a relative tolerance, since sums of prices may be added
    up in another order.
    """
    moments = settings.ordered_cutoffs()
    if original is None:
        original = build_snapshots(transactions, settings)
    changes = list(changes)
    names = F.array(*[F.lit(c) for c in changes])
    number = (count_reached("cutoff", moments) - 1) * len(changes)
    copy = (number + F.array_position(names, F.col("change")).cast("int") - 1).alias("copy")

    def of_copies(lines: DataFrame, spread: bool) -> DataFrame:
        moved = changed_futures(lines, moments, changes).select(
            copy, (F.col("invoice_date") + (timestamp(moments[0]) - F.col("cutoff")))
            .alias("invoice_date"), *[c for c in lines.columns if c != "invoice_date"])
        return snapshot(moved, moments[0], settings.horizon_days, settings.min_history_days,
                        settings.home_market, require_history=False, spread=spread,
                        keys=("customer_id", "copy")).select(
                            "customer_id", "copy", *FEATURES, "label")

    changed = union_all([of_copies(lines, spread) for lines, spread in
                         placed(transactions, len(moments) * len(changes))]).alias("b")
    before = (original.filter(F.col("cutoff").isin([timestamp(m) for m in moments]))
              .withColumn("change", F.explode(names))
              .select("customer_id", copy, *FEATURES, "label").alias("a"))
    # Joined by customer alone, so that the copies stay where they are: a customer has one row
    # per copy on either side. An equality of copies would become a key and move them.
    pairs = before.join(changed, (F.col("a.customer_id") == F.col("b.customer_id"))
                        & (F.abs(F.col("a.copy") - F.col("b.copy")) < 1), "full")
    matched = F.col("a.customer_id").isNotNull() & F.col("b.customer_id").isNotNull()
    equal = reduce(and_, [_same(name, tolerance) for name in FEATURES], matched)
    found = pairs.groupBy(F.coalesce("a.copy", "b.copy").alias("copy")).agg(
        F.count(F.lit(1)).alias("rows_compared"), F.count_if(~equal).alias("rows_moved"),
        F.sum(F.col("a.label").cast("bigint")).alias("labels_before"),
        F.sum(F.col("b.label").cast("bigint")).alias("labels_after"))
    audited = F.array(*[F.struct(timestamp(m).alias("cutoff"), F.lit(c).alias("change"))
                        for m in moments for c in changes])
    return found.select(F.get(audited, F.col("copy")).alias("audited"), *found.columns[1:]).select(
        "audited.*", *found.columns[1:])
