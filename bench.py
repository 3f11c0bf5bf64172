"""Time the headline queries and print one JSON line.

``queries`` and ``value`` are of the first run of each in a fresh session, ``warm`` of a second run
in the same session, and ``models`` of queries that fit models, which do not count in ``value``.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans import catalog  # noqa: E402
from tidemark.session import local_session  # noqa: E402

# In run order: the first two store the tables that the later ones read.
HEADLINES = [
    "transactions", "snapshots", "cleaned_transactions", "orders_at_cutoffs", "event_snapshots",
    "seasonality", "fold_sizes", "holdout_metrics", "global_rank", "gains_table",
    "capacity_sweep", "calibration_table", "cross_validation", "permutation_importance",
    "feature_medians",
]
MODELS = ["stored_model_scores", "logistic_certificate", "zoo_holdout"]


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, "tidemark-bench",
                          **{"spark.ui.showConsoleProgress": "false"})
    spark.range(1000).selectExpr("sum(id)").collect()   # start the executor threads
    seconds = {name: timed(spark, sf_dir, name) for name in HEADLINES}
    warm = {name: timed(spark, sf_dir, name) for name in HEADLINES}
    models = {name: timed(spark, sf_dir, name) for name in MODELS}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
        "cores": cores, "warm": warm, "warm_value": round(sum(warm.values()), 3),
        "models": models}))
    spark.stop()


if __name__ == "__main__":
    main()
