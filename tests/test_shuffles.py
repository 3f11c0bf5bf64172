"""What travels between tasks, and by way of the driver."""

from datetime import datetime

from tidemark.config import SnapshotSettings
from tidemark.operators import audit, diagnostics, metrics, models, ranking
from tidemark.operators import snapshots as S


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_offsets_of_bins_are_not_sent_by_way_of_the_driver(spark):
    scored = spark.createDataFrame([("a", 0.5, 1), ("b", 0.1, 0)],
                                   "model string, score double, label int")
    assert "BroadcastHashJoin" not in plan_of(ranking.score_curve(scored, ["model"]))


def test_audit_shuffles_no_copies(spark):
    lines = spark.createDataFrame(
        [(k, datetime(2011, m, 1), f"I{k}{m}", "P", 1, 2.0, 2.0, "France")
         for k in range(5) for m in range(1, 7)],
        "customer_id bigint, invoice_date timestamp_ntz, invoice_no string, stock_code string, "
        "quantity bigint, unit_price double, line_revenue double, country string")
    settings = SnapshotSettings(("2011-04-02", "2011-05-02"))
    original = S.build_snapshots(lines, settings).localCheckpoint()
    plan = plan_of(audit.leakage_audit(lines, settings, original=original))
    assert not [line for line in plan.splitlines()
                if "Exchange hashpartitioning(" in line and "copy" in line
                and "customer_id" in line.split("hashpartitioning(")[1].split("),")[0]
                and "copy" in line.split("hashpartitioning(")[1].split("),")[0]]


def test_medians_are_found_for_boosting_candidates_too(monkeypatch):
    seen = []
    monkeypatch.setattr(models.MedianImputer, "medians_of",
                        lambda self, train: seen.append(self.features) or {"a": 1.0})
    found = models.medians_of(models.boosting_candidates(["a"]).values(), None)
    assert found == {"a": 1.0} and seen == [["a"]]


def test_scores_of_permuted_copies_travel_once(spark):
    """Straight to their bin, not by score first, and the same for both uses of the curve."""
    rows = spark.createDataFrame(
        [(k, datetime(2011, 1, 1), float(k % 7), k % 2) for k in range(40)],
        "customer_id bigint, cutoff timestamp_ntz, recency_days double, label int")
    fitted = models.fit(models.recency_rule(), rows)
    table = diagnostics.permutation_table(fitted, rows, ["recency_days"], 2)
    assert table.count() == 1
    keys = [line.split("hashpartitioning(")[1] for line in plan_of(table).splitlines()
            if "Exchange hashpartitioning(" in line]
    assert keys and not [k for k in keys if "score" in k or "feature" in k and "repeat" in k]


def test_curve_of_rows_that_travel_once_is_the_same(spark):
    scored = spark.createDataFrame(
        [(k % 3, None if k % 11 == 5 else float("nan") if k % 13 == 4 else (k * 7 % 17) / 4 - 2,
          k % 2) for k in range(200)], "copy int, score double, label int")
    once, combined = [ranking.score_curve(scored, ["copy"], combined=c) for c in (False, True)]
    assert sorted(map(str, once.collect())) == sorted(map(str, combined.collect()))
    assert sorted(metrics.average_precision(once, ["copy"]).collect()) == \
        sorted(metrics.average_precision(combined, ["copy"]).collect())
