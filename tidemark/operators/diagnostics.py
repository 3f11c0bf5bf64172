"""Holdout evaluation and the questions that follow it."""

from __future__ import annotations

from hashlib import md5

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import SEED, TEST_CUTOFFS, parse_cutoffs
from tidemark.functions.scalars import day_text, round_half_even
from tidemark.operators import metrics
from tidemark.operators.metrics import average_precision
from tidemark.operators.models import fit, score
from tidemark.operators.ranking import row_positions, score_curve, union_all
from tidemark.session import materialise

POOLED = "holdout"

#: Rounds of the keyed permutation, and how often a place that lands outside is sent on.
ROUNDS, WALK = 4, 8
# The Mersenne prime below 2^31 and a factor below it, so products stay in a long.
_PRIME, _FACTOR = (1 << 31) - 1, 1_500_450_271


def fit_all(models: dict, dev: DataFrame) -> dict[str, PipelineModel]:
    """Each model fitted once on all development rows."""
    medians: dict[str, float] = {}
    return {name: fit(model, dev, medians) for name, model in models.items()}


def score_all(fitted: dict[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """Rows scored by every model: (model, customer_id, cutoff, label, score)."""
    return union_all([
        score(model, rows).select(F.lit(name).alias("model"), "customer_id", "cutoff",
                                  "label", "score")
        for name, model in fitted.items()])


def with_splits(scored: DataFrame, pooled: str = POOLED) -> DataFrame:
    """Every row twice: in the pooled split and in that of its cutoff."""
    splits = F.array(F.lit(pooled), day_text("cutoff"))
    return scored.select(*scored.columns, F.explode(splits).alias("split"))


def holdout_metrics(scored: DataFrame, pooled: str = POOLED) -> DataFrame:
    """Pooled and per-cutoff metrics of every model, in one job."""
    return metrics.evaluate(with_splits(scored, pooled), ["model", "split"])


def evaluate_holdout(models: dict, dev: DataFrame, test: DataFrame) -> DataFrame:
    # Scores are stored once: ranking reads them several times, and a forest is slow to apply.
    return holdout_metrics(materialise(score_all(fit_all(models, dev), test)))


def best_model(holdout: DataFrame, pooled: str = POOLED) -> DataFrame:
    """Name and average precision of the best model on the pooled holdout."""
    return holdout.filter(F.col("split") == pooled).agg(
        F.max_by("model", "pr_auc").alias("model"), F.max("pr_auc").alias("pr_auc"))


def headline(holdout: DataFrame, best: str, baseline: str = "recency_baseline",
             pooled: str = POOLED) -> DataFrame:
    """Best model beside the baseline on the pooled holdout: (metric, best, baseline, difference)."""
    names = ["pr_auc", "roc_auc", "precision_at_20", "lift_at_20", "brier", "accuracy",
             "majority_accuracy"]
    compared = set(names[:5])

    def of(model: str, name: str):
        return F.max(F.when(F.col("model") == model, F.col(name)))

    one = holdout.filter((F.col("split") == pooled) & F.col("model").isin(best, baseline)).agg(
        *[of(best, n).alias(f"{n}_best") for n in names],
        *[of(baseline, n).alias(f"{n}_base") for n in names])
    missing = F.lit(None).cast("double")
    rows = [F.struct(
        F.lit(n).alias("metric"), F.col(f"{n}_best").alias("best"),
        (missing if n == "majority_accuracy" else F.col(f"{n}_base")).alias("baseline"),
        (F.col(f"{n}_best") - F.col(f"{n}_base") if n in compared else missing)
        .alias("difference")) for n in names]
    return one.select(F.inline(F.array(*rows)))


def seasonality(snapshots: DataFrame, test_cutoffs=tuple(TEST_CUTOFFS)) -> DataFrame:
    """Size, positives and base rate (percent, 1 digit) of every cutoff."""
    holdout = [m.date().isoformat() for m in parse_cutoffs(test_cutoffs)]
    return (
        snapshots.groupBy(day_text("cutoff").alias("cutoff"))
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("label").alias("returned"))
        .select("cutoff", "customers", "returned",
                round_half_even(F.col("returned") / F.col("customers") * 100, 1)
                .alias("base_rate"),
                F.when(F.col("cutoff").isin(holdout), "holdout").otherwise("development")
                .alias("split")))


def stability(scored: DataFrame, keys=("model",)) -> DataFrame:
    """Holdout months in order: base rate, average precision, lift and mean prediction."""
    keys = list(keys)
    by_month = scored.withColumn("cutoff_day", day_text("cutoff"))
    group = [*keys, "cutoff_day"]
    predicted = by_month.groupBy(*group).agg(F.avg("score").alias("mean_predicted"))
    # One row per group and cutoff from here on.
    order = Window.partitionBy(*keys).orderBy("cutoff_day")
    return (
        metrics.evaluate(by_month, group).join(predicted, group)
        .select(*keys, F.col("cutoff_day").alias("cutoff"),
                F.row_number().over(order).alias("months_after_training"),
                round_half_even("base_rate", 3).alias("base_rate"),
                round_half_even("pr_auc", 4).alias("pr_auc"),
                round_half_even("lift_at_20", 3).alias("lift_at_20"),
                round_half_even("mean_predicted", 3).alias("mean_predicted")))


def round_keys(seed: int, feature: str, repeat: int) -> list[int]:
    """The keys of one (feature, repeat), from a hash that any engine with md5 can take."""
    texts = [f"{seed}|{feature}|{repeat}|{k}" for k in range(ROUNDS)]
    return [int(md5(t.encode()).hexdigest()[:15], 16) % _PRIME for t in texts]


def _mixed(value: Column, key: Column) -> Column:
    start = (value + key) % _PRIME
    return ((start * start % _PRIME + key) % _PRIME) * F.lit(_FACTOR) % _PRIME


def _sent(place: Column, across: Column, down: Column, keys: list[Column]) -> Column:
    """A permutation of [0, across * down): a place is a row and a column, and each round adds a
    hash of one to the other."""
    row, column = F.call_function("div", place, across), place % across
    for k, key in enumerate(keys):
        if k % 2:
            column = (column + _mixed(row, key)) % across
        else:
            row = (row + _mixed(column, key)) % down
    return row * across + column


def keyed_place(place: Column, n: Column, keys: list[Column]) -> Column:
    """Where a place of [0, n) goes in the permutation that the keys stand for.

    A Feistel network over rows and columns of the smallest near-square with n places. The few
    places beyond n send a visitor on until it is back inside, which is a permutation of [0, n)
    for any n below 2^62. The square is larger by less than a row, so a walk of eight steps
    ends but for odds of n^-4 at most; if one does not, the query fails and loses no row.
    """
    down = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    across = F.call_function("div", n + down - 1, down)
    first = _sent(place, across, down, keys)
    walked = F.aggregate(
        F.sequence(F.lit(2), F.lit(WALK)), first,
        lambda at, _: F.when(at < n, at).otherwise(_sent(at, across, down, keys)))
    end = F.when(first < n, first).otherwise(walked)
    return F.when(end < n, end).otherwise(
        F.raise_error(F.lit("a walk of the keyed permutation did not end")).cast("bigint"))


def _copies(rows: DataFrame, features: list[str], repeats: int, seed: int) -> DataFrame:
    """``shuffle_feature`` with the number of the copy, ``_copy``, in place of its names."""
    def keys_of(feature: str) -> Column:
        return F.array(*[F.array(*[F.lit(k).cast("bigint") for k in round_keys(seed, feature, r)])
                         for r in range(repeats)])

    values = F.inline(F.array(*[
        F.struct(F.lit(k * repeats).alias("_first"), F.col(f).cast("double").alias("_value"),
                 keys_of(f).alias("_repeats")) for k, f in enumerate(features)]))
    # One value per feature and repeat arrives at each position.
    sent = (rows.select("position", "position_total", values)
            .select("position", "position_total", "_first", "_value",
                    F.posexplode("_repeats").alias("_repeat", "_keys")))
    target = keyed_place(F.col("position"), F.col("position_total"),
                         [F.col("_keys")[k] for k in range(ROUNDS)])
    arrivals = sent.select(target.alias("position"),
                           (F.col("_first") + F.col("_repeat")).alias("_copy"), "_value")
    types = dict(rows.dtypes)
    number = {f: k for k, f in enumerate(features)}
    # Neither side is sent to all tasks by way of the driver. The row of a position is the only
    # one that the join holds.
    copies = arrivals.join(rows.hint("merge"), "position")
    of_feature = F.call_function("div", F.col("_copy"), F.lit(repeats))
    return copies.select(
        *[F.when(of_feature == number[c], F.col("_value").cast(types[c])).otherwise(F.col(c))
          .alias(c) if c in number else F.col(c) for c in rows.columns], "_copy")


def _copy_names(features: list[str], repeats: int) -> list[Column]:
    """Feature and repeat of a copy."""
    names = F.array(*[F.lit(f) for f in features])
    return [F.get(names, F.call_function("div", F.col("_copy"), F.lit(repeats)).cast("int"))
            .alias("feature"), (F.col("_copy") % repeats).alias("repeat")]


def shuffle_feature(rows: DataFrame, features: list[str], repeats: int, seed: int) -> DataFrame:
    """All (feature, repeat) copies of ``rows``, each with that feature permuted.

    ``rows`` carries ``position`` 0..n-1 in a random order and ``position_total``. In each copy
    the values of the feature go to the places of a keyed permutation. Only these values travel;
    the row they arrive at is joined once and copied in place.
    """
    return _copies(rows, features, repeats, seed).select(
        *rows.columns, *_copy_names(features, repeats))


def permutation_table(model: PipelineModel, test: DataFrame, features: list[str],
                      n_repeats: int = 10, seed: int = SEED, features_per_job: int = 11,
                      digits: int = 5, read: list[str] | None = None) -> DataFrame:
    """Mean and population spread of the drop in average precision, largest first.

    ``features_per_job`` bounds how many copies of the rows one join holds. ``read`` may name the
    features that the model looks at, if not all: others cannot move a score, so their drop
    is zero and their copies are left out. The numbered rows, with what the model reads, are
    written once. Each copy's scores travel once, to their place on its curve.
    """
    moving = [f for f in features if read is None or f in read]
    chunks = [moving[i:i + features_per_job] for i in range(0, len(moving), features_per_job)]
    used = list(dict.fromkeys([*(features if read is None else read),
                               "customer_id", "cutoff", "label"]))
    rows = materialise(row_positions(test.select(*used), ["customer_id", "cutoff"], seed))
    base = score(model, rows).select(F.lit("base").alias("key"), "label", "score")
    baseline = average_precision(score_curve(base, ["key"]), ["key"]).first()
    before = baseline["pr_auc"] if baseline else None
    drops = [average_precision(score_curve(
        score(model, _copies(rows, chunk, n_repeats, seed)).select("_copy", "label", "score"),
        ["_copy"], combined=False), ["_copy"])
        .select(_copy_names(chunk, n_repeats)[0], (F.lit(before) - F.col("pr_auc")).alias("drop"))
        for chunk in chunks]
    still = [f for f in features if f not in moving]
    if still and before is not None:
        drops.append(test.sparkSession.createDataFrame(
            [(f, 0.0) for f in still], "feature string, drop double"))
    return (
        union_all(drops).groupBy("feature")
        .agg(F.avg("drop").alias("pr_auc_drop"), F.stddev_pop("drop").alias("std"))
        .select("feature", round_half_even("pr_auc_drop", digits).alias("pr_auc_drop"),
                round_half_even("std", digits).alias("std"))
        .orderBy(F.desc("pr_auc_drop"), "feature"))


def top_importances(importance: DataFrame, top_n: int = 15) -> DataFrame:
    """The first rows of the importance table (a top-k report)."""
    return importance.orderBy(F.desc("pr_auc_drop"), "feature").limit(top_n)
