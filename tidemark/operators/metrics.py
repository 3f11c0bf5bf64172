"""Ranking, probability and money metrics, exact, for any number of groups in one job.

Input is one row per scored customer: group keys, ``label`` (0/1), ``score`` and the tie keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import CAMPAIGN_CAPACITY, CAPACITIES, CONTACT_COST, INCREMENTAL_MARGIN
from tidemark.functions.scalars import ratio_or_zero, round_half_even
from tidemark.operators.ranking import TIE_KEYS, cut_points, hits_at, score_curve, top_rows

_ALL = "_all"


def metric_names(k: float = CAMPAIGN_CAPACITY) -> list[str]:
    share = int(k * 100)
    return ["base_rate", "accuracy", "majority_accuracy", "precision", "recall", "f1", "roc_auc",
            "pr_auc", f"precision_at_{share}", f"recall_at_{share}", f"lift_at_{share}", "brier"]


def _keyed(scored: DataFrame, keys) -> tuple[DataFrame, list[str]]:
    """A constant key where there is none, so that ungrouped input takes the same path."""
    keys = list(keys)
    return (scored, keys) if keys else (scored.withColumn(_ALL, F.lit(0)), [_ALL])


def average_precision(curve: DataFrame, keys: list[str]) -> DataFrame:
    """Sum over distinct scores of recall gained times precision there (no interpolation)."""
    return curve.groupBy(*keys).agg(_average_precision().alias("pr_auc"))


def _average_precision() -> Column:
    precision = (F.col("pos_before") + F.col("pos")) / (F.col("n_before") + F.col("n"))
    return F.coalesce(F.try_divide(F.sum(F.col("pos") * precision), F.max("pos_total")),
                      F.lit(0.0))


def _roc_auc() -> Column:
    """Share of (positive, negative) pairs in the right order, ties counting half."""
    negatives = (F.col("n_total") - F.col("pos_total")).cast("double")
    neg = (F.col("n") - F.col("pos")).cast("double")
    neg_above = (F.col("n_before") - F.col("pos_before")).cast("double")
    below = negatives - neg_above - neg
    pairs = F.max("pos_total").cast("double") * F.max(negatives)
    return F.try_divide(F.sum(F.col("pos") * (below + neg / 2)), pairs)


def _curve_sums(threshold: float) -> list[Column]:
    """All that the metrics without a cut in the ranking need from the curve."""
    called = F.col("score") >= F.lit(threshold)
    return [
        F.sum(F.when(called, F.col("n")).otherwise(0)).alias("called"),
        F.sum(F.when(called, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.col("pos") * F.pow(F.col("score") - 1, F.lit(2.0))
              + (F.col("n") - F.col("pos")) * F.pow("score", F.lit(2.0))).alias("squares"),
        _roc_auc().alias("roc_auc"), _average_precision().alias("pr_auc")]


def _top(scored, keys, shares, label, score, ties, extra=()) -> DataFrame:
    cuts = {str(k): top_rows(F.col("n_total"), k) for k in shares}
    points = cut_points(score_curve(scored, keys, label, score), keys, cuts, extra)
    precision = F.col("hits") / F.col("size")
    return (
        hits_at(points, scored, keys, cuts, label, score, ties)
        .withColumn("k", F.col("cut").cast("double"))
        .withColumn("precision_at", precision)
        .withColumn("recall_at", ratio_or_zero("hits", "pos_total"))
        .withColumn("lift_at", F.try_divide(precision, F.col("pos_total") / F.col("n_total"))))


def top_share(scored: DataFrame, keys=(), shares=(CAMPAIGN_CAPACITY,), label="label",
              score="score", ties=TIE_KEYS) -> DataFrame:
    """Precision, recall and lift in the top share(s): keys, k, size, hits, *_at."""
    scored, keys = _keyed(scored, keys)
    return _top(scored, keys, shares, label, score, ties) \
        .drop("n_total", "pos_total", "cut", _ALL)


def precision_at_k(scored, keys=(), k=CAMPAIGN_CAPACITY, **columns) -> DataFrame:
    return top_share(scored, keys, (k,), **columns).select(
        *keys, F.col("precision_at").alias("precision_at_k"))


def recall_at_k(scored, keys=(), k=CAMPAIGN_CAPACITY, **columns) -> DataFrame:
    return top_share(scored, keys, (k,), **columns).select(
        *keys, F.col("recall_at").alias("recall_at_k"))


def lift_at_k(scored, keys=(), k=CAMPAIGN_CAPACITY, **columns) -> DataFrame:
    return top_share(scored, keys, (k,), **columns).select(
        *keys, F.col("lift_at").alias("lift_at_k"))


def evaluate(scored: DataFrame, keys=(), threshold: float = 0.5, k: float = CAMPAIGN_CAPACITY,
             label="label", score="score", ties=TIE_KEYS) -> DataFrame:
    """The twelve metrics, one row per group. ROC-AUC and lift are NULL where undefined."""
    scored, keyed = _keyed(scored, keys)
    share = int(k * 100)
    sums = _top(scored, keyed, (k,), label, score, ties, _curve_sums(threshold))
    base = F.col("pos_total") / F.col("n_total")
    correct = F.col("n_total") - F.col("pos_total") - F.col("called") + 2 * F.col("tp")
    return sums.select(
        *keys, base.alias("base_rate"),
        (correct / F.col("n_total")).alias("accuracy"),
        F.greatest(base, 1 - base).alias("majority_accuracy"),
        ratio_or_zero("tp", "called").alias("precision"),
        ratio_or_zero("tp", "pos_total").alias("recall"),
        ratio_or_zero(2 * F.col("tp"), F.col("called") + F.col("pos_total")).alias("f1"),
        "roc_auc", "pr_auc",
        F.col("precision_at").alias(f"precision_at_{share}"),
        F.col("recall_at").alias(f"recall_at_{share}"),
        F.col("lift_at").alias(f"lift_at_{share}"),
        (F.col("squares") / F.col("n_total")).alias("brier"))


def gains_table(scored: DataFrame, keys=(), bins: int = 10, label="label", score="score",
                ties=TIE_KEYS) -> DataFrame:
    """Decile table: customers, positives, precision, lift and cumulative columns, to 3 digits.

    Decile ``j`` ends at row ``ceil(j * n / bins)``; empty ones are left out.
    """
    scored, keyed = _keyed(scored, keys)
    n = F.col("n_total")
    ends = {str(j): F.floor((n * j + (bins - 1)) / bins) for j in range(1, bins + 1)}
    points = cut_points(score_curve(scored, keyed, label, score), keyed, ends)
    reached = hits_at(points, scored, keyed, ends, label, score, ties)
    # At most ``bins`` rows per group from here on.
    by_decile = Window.partitionBy(*keyed).orderBy("decile")
    table = (
        reached.withColumn("decile", F.col("cut").cast("int"))
        .withColumn("customers", F.col("size") - F.lag("size", 1, 0).over(by_decile))
        .withColumn("returned", F.col("hits") - F.lag("hits", 1, 0).over(by_decile))
        .filter(F.col("customers") > 0))
    precision = F.col("returned") / F.col("customers")
    return table.select(
        *keys, "decile", "customers", "returned",
        round_half_even(precision, 3).alias("precision"),
        round_half_even(F.try_divide(precision, F.col("pos_total") / n), 3).alias("lift"),
        F.col("hits").alias("cumulative_returned"),
        round_half_even(F.try_divide("hits", "pos_total"), 3).alias("cumulative_recall"),
        round_half_even(F.col("hits") / F.col("size"), 3).alias("cumulative_precision"))


def _money(top: DataFrame, keys, contact_cost: float, margin: float) -> DataFrame:
    revenue = F.col("hits") * F.lit(float(margin))
    cost = F.col("size") * F.lit(float(contact_cost))
    return top.select(
        *keys, "k", F.col("size").alias("contacted"), "hits",
        F.col("precision_at").alias("precision"), revenue.alias("revenue"), cost.alias("cost"),
        (revenue - cost).alias("net"), ((revenue - cost) / F.col("size")).alias("net_per_contact"),
        F.col("recall_at").alias("recall"), F.col("lift_at").alias("lift"))


def expected_value(scored: DataFrame, keys=(), k: float = CAMPAIGN_CAPACITY,
                   contact_cost: float = CONTACT_COST, margin: float = INCREMENTAL_MARGIN,
                   **columns) -> DataFrame:
    """Money made by contacting the top share, under the given unit economics."""
    return _money(top_share(scored, keys, (k,), **columns), keys, contact_cost, margin) \
        .drop("recall", "lift")


def capacity_sweep(scored: DataFrame, keys=(), capacities=CAPACITIES,
                   contact_cost: float = CONTACT_COST, margin: float = INCREMENTAL_MARGIN,
                   **columns) -> DataFrame:
    """Expected value, recall and lift at each campaign size, from one ranking; 3 digits."""
    money = _money(top_share(scored, keys, capacities, **columns), keys, contact_cost, margin)
    exact = {*keys, "contacted", "hits"}
    return money.select(*[c if c in exact else round_half_even(c, 3).alias(c)
                          for c in money.columns])


def calibration_table(scored: DataFrame, keys=(), bins: int = 10, label="label", score="score",
                      digits: int | None = 3) -> DataFrame:
    """Mean prediction against observed rate in quantile bins.

    A score's bin is the number of inner quantile edges strictly below it. An edge lies between
    the values at positions floor(h) and floor(h)+1, h = (n-1)*j/bins, so it is below a score
    exactly if position floor(h) holds a smaller one: positions alone decide, no edge is needed.
    """
    scored, keyed = _keyed(scored, keys)
    curve = score_curve(scored, keyed, label, score)
    below = F.col("n_total") - F.col("n_before") - F.col("n")
    # Integer division: number of j in 1..bins-1 with floor((n-1)*j/bins) < below.
    edges = [F.when(F.floor((F.col("n_total") - 1) * j / bins) < below, 1).otherwise(0)
             for j in range(1, bins)]
    bin_number = sum(edges, F.lit(0))
    table = (
        curve.groupBy(*keyed, bin_number.alias("bin"))
        .agg((F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("predicted"),
             (F.sum("pos") / F.sum("n")).alias("observed"))
        .withColumn("gap", F.col("predicted") - F.col("observed")))
    values = ["predicted", "observed", "gap"]
    if digits is not None:
        return table.select(*keys, "bin", *[round_half_even(c, digits).alias(c) for c in values])
    return table.select(*keys, "bin", *values)


def pr_curve(scored: DataFrame, keys=(), label="label", score="score") -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the end point (1, 0)."""
    scored, keyed = _keyed(scored, keys)
    curve = score_curve(scored, keyed, label, score)
    hits = F.col("pos_before") + F.col("pos")
    points = curve.select(
        *keyed, F.col("score").alias("threshold"),
        (hits / (F.col("n_before") + F.col("n"))).alias("precision"),
        F.coalesce(F.try_divide(hits, "pos_total"), F.lit(1.0)).alias("recall"))
    end = scored.select(*keyed).distinct().select(
        *keyed, F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end).drop(_ALL)


def roc_curve(scored: DataFrame, keys=(), label="label", score="score") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, plus the start point (0, 0)."""
    scored, keyed = _keyed(scored, keys)
    curve = score_curve(scored, keyed, label, score)
    hits = F.col("pos_before") + F.col("pos")
    false_hits = F.col("n_before") + F.col("n") - hits
    points = curve.select(
        *keyed, F.col("score").alias("threshold"),
        F.try_divide(false_hits, F.col("n_total") - F.col("pos_total")).alias("fpr"),
        F.try_divide(hits, "pos_total").alias("tpr"))
    start = scored.select(*keyed).distinct().select(
        *keyed, F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start).drop(_ALL)
