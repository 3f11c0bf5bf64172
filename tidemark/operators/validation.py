"""Splits in time: development and holdout, expanding-window folds, fold scores."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import DEV_CUTOFFS, TEST_CUTOFFS, parse_cutoffs
from tidemark.functions.scalars import day_text, timestamp
from tidemark.operators import metrics
from tidemark.operators.metrics import average_precision
from tidemark.operators.models import fit, medians_by_fold, model_zoo, score
from tidemark.operators.ranking import score_curve, union_all
from tidemark.session import materialise

#: Model fits that are submitted to the cluster at the same time.
FITS_AT_ONCE = 4


def on_day_of(moments) -> Column:
    """Cutoff falls on the day of one of the moments; prunes partitions by cutoff."""
    column = F.col("cutoff").cast("date")
    return column.isin([m.date() for m in moments])


def split_dev_test(snapshots: DataFrame, dev_cutoffs=tuple(DEV_CUTOFFS),
                   test_cutoffs=tuple(TEST_CUTOFFS)) -> tuple[DataFrame, DataFrame]:
    """Development and holdout rows, strictly by cutoff."""
    return (snapshots.filter(on_day_of(parse_cutoffs(dev_cutoffs))),
            snapshots.filter(on_day_of(parse_cutoffs(test_cutoffs))))


def expanding_window_folds(cutoffs, min_train: int = 3) -> list[tuple[list, object]]:
    """(training cutoffs, validation cutoff) pairs growing forward in time."""
    cutoffs = list(cutoffs)
    return [(cutoffs[:i], cutoffs[i]) for i in range(min_train, len(cutoffs))]


def fold_table(spark: SparkSession, cutoffs, min_train: int = 3) -> DataFrame:
    """The folds as data: (fold, role, cutoff)."""
    rows = []
    for fold, (train, valid) in enumerate(
            expanding_window_folds(parse_cutoffs(cutoffs), min_train), start=1):
        rows += [(fold, "train", c) for c in train] + [(fold, "valid", valid)]
    return spark.createDataFrame(rows, "fold int, role string, cutoff timestamp_ntz")


def fold_sizes(snapshots: DataFrame, cutoffs, min_train: int = 3) -> DataFrame:
    """Rows and positives of every fold and role.

    Snapshots are first counted per cutoff, so the join with the folds is between two tables
    of at most one row per cutoff and fold.
    """
    per_cutoff = snapshots.groupBy("cutoff").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("returned"))
    folds = fold_table(snapshots.sparkSession, cutoffs, min_train)
    return (folds.join(per_cutoff, "cutoff").groupBy("fold", "role")
            .agg(F.count(F.lit(1)).alias("n_cutoffs"), F.sum("n_rows").alias("n_rows"),
                 F.sum("returned").alias("returned")))


def fold_scores(snapshots: DataFrame, features: list[str], cutoffs=tuple(DEV_CUTOFFS),
                min_train: int = 3, models: dict | None = None, at_once: int = FITS_AT_ONCE
                ) -> DataFrame:
    """Validation rows of every fold scored by every model fitted on that fold's past.

    Fits are submitted side by side, ``at_once`` at a time, so that the many small jobs of one
    fill the gaps of another; the medians of all folds are found together. The scores stay
    distributed and are stacked, keyed by model and fold. Folds without training or validation
    rows are skipped.
    """
    models = model_zoo(features) if models is None else models
    cutoffs = cutoffs or DEV_CUTOFFS
    sizes = {(r["fold"], r["role"]): r["n_rows"]
             for r in fold_sizes(snapshots, cutoffs, min_train).collect()}
    fits, trained_on = [], {}
    for fold, (train_cuts, valid_cut) in enumerate(
            expanding_window_folds(parse_cutoffs(cutoffs), min_train), start=1):
        n_train, n_valid = sizes.get((fold, "train"), 0), sizes.get((fold, "valid"), 0)
        if not n_train or not n_valid:
            continue
        train = snapshots.filter(on_day_of(train_cuts))
        valid = snapshots.filter(on_day_of([valid_cut]))
        about = [F.lit(fold).alias("fold"), day_text(timestamp(valid_cut)).alias("valid_cutoff"),
                 F.lit(n_train).cast("bigint").alias("n_train"),
                 F.lit(n_valid).cast("bigint").alias("n_valid")]
        trained_on[fold] = [c.date() for c in train_cuts]
        fits += [(name, model, train, valid, fold, about) for name, model in models.items()]
    if not fits:
        raise ValueError("no fold has both training and validation rows")

    medians = medians_by_fold(models.values(), snapshots, F.col("cutoff").cast("date"), trained_on)

    def scored(name, model, train, valid, fold, about) -> DataFrame:
        return score(fit(model, train, medians[fold]), valid).select(
            F.lit(name).alias("model"), *about, "customer_id", "cutoff", "label", "score")

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return union_all([*pool.map(
            inheritable_thread_target(snapshots.sparkSession)(lambda job: scored(*job)), fits)])


def cross_validate(snapshots: DataFrame, features: list[str], cutoffs=tuple(DEV_CUTOFFS),
                   min_train: int = 3, models: dict | None = None) -> DataFrame:
    """Model x fold rows with sizes and the twelve metrics, evaluated in one job."""
    keys = ["model", "fold", "valid_cutoff", "n_train", "n_valid"]
    scored = materialise(fold_scores(snapshots, features, cutoffs, min_train, models))
    return metrics.evaluate(scored, keys)


def summarise_cv(cv: DataFrame, digits: int = 4, share: int = 20) -> DataFrame:
    """Mean and sample spread per model, best mean first."""
    values = {
        "pr_auc_mean": F.avg("pr_auc"), "pr_auc_std": F.stddev_samp("pr_auc"),
        "roc_auc_mean": F.avg("roc_auc"),
        "lift_mean": F.avg(f"lift_at_{share}"), "lift_std": F.stddev_samp(f"lift_at_{share}"),
        f"precision_at_{share}": F.avg(f"precision_at_{share}"),
        "brier_mean": F.avg("brier"), "accuracy_mean": F.avg("accuracy"),
        "majority_accuracy": F.avg("majority_accuracy"),
    }
    summary = cv.groupBy("model").agg(*[v.alias(n) for n, v in values.items()])
    rounded = [(F.rint(F.col(n) * 10 ** digits) / 10 ** digits).alias(n) for n in values]
    return summary.orderBy(F.desc("pr_auc_mean")).select("model", *rounded)


def fold_series(cv: DataFrame) -> DataFrame:
    """Average precision by model and validation cutoff, the series of the fold chart."""
    return cv.select("model", "valid_cutoff", "pr_auc")


def accuracy_against_majority(cv: DataFrame) -> DataFrame:
    """Mean accuracy per model beside that of always predicting the majority class."""
    return cv.groupBy("model").agg(
        F.avg("accuracy").alias("accuracy"),
        F.avg("majority_accuracy").alias("majority_accuracy")).orderBy("accuracy")


def summarise_tuning(folds: DataFrame, params: list[str]) -> DataFrame:
    """Mean and population spread of average precision per configuration, best first."""
    return (folds.groupBy("config", *params)
            .agg(F.avg("pr_auc").alias("pr_auc_mean"), F.stddev_pop("pr_auc").alias("pr_auc_std"))
            .orderBy(F.desc("pr_auc_mean")))


def tune(snapshots: DataFrame, candidates: dict, params: dict, cutoffs=tuple(DEV_CUTOFFS),
         min_train: int = 3) -> DataFrame:
    """Grid search over the expanding-window folds.

    ``candidates`` maps a configuration number to an estimator and ``params`` to its settings.
    """
    models = {str(i): candidate for i, candidate in candidates.items()}
    scored = fold_scores(snapshots, [], cutoffs, min_train, models)
    per_fold = average_precision(score_curve(scored, ["model", "fold"]), ["model", "fold"])
    config = F.col("model").cast("int")
    names = list(next(iter(params.values())))
    settings = [reduce(lambda rest, item: F.when(config == item[0], F.lit(item[1][name]))
                       .otherwise(rest), params.items(), F.lit(None)).alias(name)
                for name in names]
    return summarise_tuning(per_fold.select(config.alias("config"), *settings, "pr_auc"), names)
