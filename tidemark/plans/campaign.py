"""The whole run: transactions, snapshots, validation, holdout, diagnostics, stored results."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import DEV_CUTOFFS, SEED, TEST_CUTOFFS, SnapshotSettings
from tidemark.functions.scalars import money_text
from tidemark.operators import audit, diagnostics, metrics, models, snapshots, validation
from tidemark.session import materialise
from tidemark.sources import tables


@dataclass(frozen=True)
class CampaignSettings:
    snapshot: SnapshotSettings = SnapshotSettings()
    dev_cutoffs: tuple = tuple(DEV_CUTOFFS)
    test_cutoffs: tuple = tuple(TEST_CUTOFFS)
    min_train: int = 3
    sizes: models.ModelSizes = models.ModelSizes()
    repeats: int = 10
    tune: bool = False
    tune_rounds_share: float = 1.0
    seed: int = SEED
    #: (n_rows, hash_sum) of the transactions that the run is for; None takes any.
    pin: tuple[int, int] | None = None


def run_campaign(spark: SparkSession, build_transactions: Callable[[], DataFrame], output: str,
                 settings: CampaignSettings = CampaignSettings(),
                 force: bool = False) -> dict[str, DataFrame]:
    """Run every stage and store its result under ``output``; returns the stored result tables.

    Transactions and snapshots are read back if stored before, unless ``force``. The model kept
    is the best on the pooled holdout, as published; for an unbiased estimate of that model
    look at the cross-validation.
    """
    def at(name: str) -> str:
        return f"{output.rstrip('/')}/{name}"

    transactions = tables.load_or_build(
        spark, at("transactions"), build_transactions, force, write=tables.write_transactions)
    if settings.pin is not None:
        tables.require_fingerprint(transactions, *settings.pin)
    table = tables.load_or_build(
        spark, at("snapshots"),
        lambda: snapshots.build_snapshots(transactions, settings.snapshot), force,
        schema=snapshots.SNAPSHOT_SCHEMA,
        write=lambda df, path: tables.write_table(df, path, "cutoff"))
    features = snapshots.feature_columns(table)
    dev, test = validation.split_dev_test(table, settings.dev_cutoffs, settings.test_cutoffs)
    zoo = models.model_zoo(features, settings.sizes)

    results = {"fingerprint": tables.fingerprint(transactions),
               "leakage_audit": audit.leakage_audit(transactions, settings.snapshot,
                                                    original=table)}
    if settings.tune:
        results["tuning"] = validation.tune(
            table, models.boosting_candidates(features, rounds_share=settings.tune_rounds_share),
            dict(enumerate(models.BOOSTING_GRID)), settings.dev_cutoffs, settings.min_train)
    cv = materialise(validation.cross_validate(
        table, features, settings.dev_cutoffs, settings.min_train, zoo))
    results["cv_folds"] = cv
    results["cv_summary"] = validation.summarise_cv(cv)
    results["cv_accuracy"] = validation.accuracy_against_majority(cv)
    results["cv_fold_series"] = validation.fold_series(cv)

    fitted = diagnostics.fit_all(zoo, dev)
    scored = materialise(diagnostics.score_all(fitted, test))
    holdout = materialise(diagnostics.holdout_metrics(scored))
    results["holdout_metrics"] = holdout
    best = diagnostics.best_model(holdout).first()["model"]
    best_scores = scored.filter(F.col("model") == best)

    results["headline"] = diagnostics.headline(holdout, best)
    results["importance"] = materialise(diagnostics.permutation_table(
        fitted[best], test, features, settings.repeats, settings.seed))
    results["top_importance"] = diagnostics.top_importances(results["importance"])
    results["calibration"] = metrics.calibration_table(scored, ["model"])
    results["capacity_sweep"] = sweep = metrics.capacity_sweep(best_scores)
    results["money"] = sweep.select("k", "contacted", "hits", *[
        money_text(c).alias(c) for c in ("revenue", "cost", "net")])
    results["gains"] = metrics.gains_table(best_scores)
    results["seasonality"] = diagnostics.seasonality(table, settings.test_cutoffs)
    results["stability"] = diagnostics.stability(best_scores)
    results["pr_curve"] = metrics.pr_curve(scored, ["model"])
    results["roc_curve"] = metrics.roc_curve(scored, ["model"])

    models.save_model(fitted[best], best, at("models"))
    for name, result in results.items():
        tables.write_table(result, at(f"results/{name}"))
        results[name] = spark.read.schema(result.schema).parquet(at(f"results/{name}"))
        tables.write_report(results[name], at(f"reports/{name}"))
    return results
