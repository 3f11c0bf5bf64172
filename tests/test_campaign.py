from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest

from tidemark.config import SnapshotSettings
from tidemark.operators import audit
from tidemark.operators import models as M
from tidemark.operators import snapshots as S
from tidemark.plans.campaign import CampaignSettings, run_campaign
from tidemark.sources import tables

SCHEMA = ("customer_id bigint, invoice_no string, invoice_date timestamp_ntz, stock_code string, "
          "quantity bigint, unit_price double, country string, line_revenue double")
CUTOFFS = tuple(f"2011-0{m}-01" for m in range(3, 9))


@pytest.fixture(scope="module")
def transactions(spark):
    """150 customers who buy at steady but different intervals."""
    rng = np.random.default_rng(11)
    rows = []
    for customer in range(150):
        step, day = int(rng.integers(7, 90)), int(rng.integers(0, 60))
        while day < 260:
            date = datetime(2011, 1, 1) + timedelta(days=day, minutes=int(rng.integers(0, 1400)))
            rows += [(customer, f"{customer}-{day}", date, f"P{rng.integers(0, 9)}", 2, 1.25,
                      "United Kingdom" if customer % 3 else "France", 2.5)
                     for _ in range(int(rng.integers(1, 4)))]
            day += step + int(rng.integers(0, 5))
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_whole_run(spark, transactions, tmp_path):
    settings = CampaignSettings(
        SnapshotSettings(CUTOFFS), CUTOFFS[:4], CUTOFFS[4:], repeats=2, tune=True,
        tune_rounds_share=0.005,
        sizes=M.ModelSizes(logistic_iterations=20, forest_trees=5, forest_depth=4,
                           forest_min_rows=5, boosting_rounds=3, boosting_min_rows=5))
    out = str(tmp_path / "run")
    results = run_campaign(spark, lambda: transactions, out, settings)
    holdout = results["holdout_metrics"].toPandas()
    assert len(holdout) == 4 * 3
    pooled = holdout[holdout.split == "holdout"].set_index("model").pr_auc
    assert pooled.drop("recency_baseline").max() > pooled["recency_baseline"]
    for name in results:
        stored = spark.read.option("header", True).csv(f"{out}/reports/{name}")
        assert stored.columns == results[name].columns and stored.count() > 0, name
    assert results["tuning"].count() == 5
    assert {"cv_fold_series", "money", "top_importance", "leakage_audit", "fingerprint"} <= set(results)
    audited = results["leakage_audit"].toPandas()
    assert len(audited) == 2 * 6 and (audited.rows_moved == 0).all()
    assert results["money"].first()["net"].startswith("£")
    # Results are stored tables, so showing one computes nothing again.
    assert all("Scan parquet" in r._jdf.queryExecution().executedPlan().toString()
               for r in results.values())
    pin = results["fingerprint"].first()
    with pytest.raises(RuntimeError, match="fingerprint mismatch"):
        run_campaign(spark, lambda: transactions, out,
                     replace(settings, pin=(pin["n_rows"], pin["hash_sum"] + 1)))
    table = spark.read.schema(S.SNAPSHOT_SCHEMA).parquet(f"{out}/snapshots")
    assert table.select("cutoff").distinct().count() == 6
    plan = table.filter("cutoff = timestamp_ntz'2011-05-01'") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cutoff" in plan
    assert tables.table_exists(spark, f"{out}/transactions")


def test_audit_passes_here_and_catches_a_leak(spark, transactions, monkeypatch):
    settings = SnapshotSettings(("2011-04-01", "2011-05-01T12:30:00", "2011-06-10"), 45)
    report = {(r["cutoff"], r["change"]): r for r in
              audit.leakage_audit(transactions, settings).collect()}
    assert len(report) == 6
    for (_, change), r in report.items():
        assert r["rows_moved"] == 0 and r["rows_compared"] > 80 and r["labels_before"] > 0
        assert r["labels_after"] == (0 if change == "deleted" else r["labels_before"])

    def leaky(build):
        def with_all_lines(lines, *args, **options):
            total = lines.groupBy("customer_id").agg(audit.F.sum("line_revenue").alias("all"))
            return build(lines, *args, **options).join(total, "customer_id") \
                .withColumn("monetary", audit.F.col("all"))
        return with_all_lines

    monkeypatch.setattr(audit, "snapshot", leaky(S.snapshot))
    monkeypatch.setattr(audit, "build_snapshots", leaky(S.build_snapshots))
    caught = audit.leakage_audit(transactions, settings).collect()
    assert len(caught) == 6 and all(r["rows_moved"] > 50 for r in caught)
    with pytest.raises(ValueError, match="unknown change"):
        audit.changed_futures(transactions, ["2011-05-01"], ("shuffled",))
