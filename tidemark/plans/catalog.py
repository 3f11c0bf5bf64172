"""Registered queries: every operator over the whole of the provided tables.

Two tables are stored once per application, as in a production run: the transactions, clustered
by customer, and the snapshots, partitioned by cutoff. Later queries read the stored copies.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SEED, SnapshotSettings, parse_cutoffs
from tidemark.functions.scalars import money_text, round_half_even
from tidemark.operators import (audit, clean, diagnostics, metrics, model_tables, models, ranking,
                                validation)
from tidemark.operators import snapshots as snap
from tidemark.plans import oracle
from tidemark.plans.incremental import SnapshotStore
from tidemark.session import materialise, scratch_path, shared_dir
from tidemark.sources import digests, tables, views

RULES = oracle.RULES
ONE_CUTOFF = SnapshotSettings(("2001-03-17T12:00:00",), horizon_days=90, min_history_days=180,
                              home_market=views.HOME)
IMPORTANCE_REPEATS = 10
# The fit whose importances are asked for.
IMPORTANCE_FIT = models.ModelSizes(logistic_iterations=50)


# ---------------------------------------------------------------------------------------------
# Stored tables
# ---------------------------------------------------------------------------------------------
def _path(spark: SparkSession, sf_dir: str, name: str) -> str:
    source = f"{crc32(sf_dir.rstrip('/').encode()):08x}"
    return (f"{shared_dir(spark).rstrip('/')}/tidemark/"
            f"{spark.sparkContext.applicationId}/{source}/{name}")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_or_build(
        spark, _path(spark, sf_dir, "transactions"),
        lambda: views.order_transactions(spark, sf_dir), write=tables.write_transactions)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_or_build(
        spark, _path(spark, sf_dir, "snapshots"),
        lambda: snap.build_snapshots(transactions(spark, sf_dir), views.ORDER_SETTINGS),
        schema=snap.SNAPSHOT_SCHEMA,
        write=lambda df, path: tables.write_table(df, path, "cutoff"))


def _dev_test(spark, sf_dir):
    return validation.split_dev_test(snapshots(spark, sf_dir), views.ORDER_DEV,
                                     views.ORDER_HOLDOUT)


def _rule_models() -> dict:
    return {name: models.recency_rule(column) for name, column in RULES.items()}


def _rule_scores(spark, sf_dir) -> DataFrame:
    """The holdout scored by the two fixed rules."""
    _, test = _dev_test(spark, sf_dir)
    rows = F.array(*[F.struct(F.lit(name).alias("model"), models.rule_score(column).alias("score"))
                     for name, column in RULES.items()])
    return test.select("customer_id", "cutoff", "label", F.inline(rows))


def _rounded(df: DataFrame, digits: dict[str, int] | int) -> DataFrame:
    """Float columns to a fixed number of digits, for comparison across engines."""
    if isinstance(digits, int):
        digits = {name: digits for name, kind in df.dtypes if kind == "double"}
    return df.select(*[round_half_even(c, digits[c]).alias(c) if c in digits else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------------------------
def rule_precision_at_20(spark, sf_dir):
    """Flagship: transactions to snapshots to a rule's precision and lift in the top fifth."""
    top = metrics.top_share(_rule_scores(spark, sf_dir), ["model"], (0.2,))
    return _rounded(top.select("model", F.col("size").alias("contacted"), "hits",
                               F.col("precision_at").alias("precision_at_20"),
                               F.col("lift_at").alias("lift_at_20")), 9)


def cleaned_transactions(spark, sf_dir):
    return clean.build_transactions(views.dirty_extract(spark, sf_dir))


def raw_csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    tables.write_report(views.dirty_extract(spark, sf_dir), path)
    raw = tables.read_raw(spark, path, "csv")
    return raw.groupBy(F.col("Country").alias("country")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("Quantity").alias("units"),
        F.count_if(F.startswith("InvoiceNo", F.lit("C"))).alias("cancelled"),
        F.count_if(F.col("StockCode") != F.trim("StockCode", F.lit("\t "))).alias("padded"),
        F.count("CustomerID").alias("known"), F.min("InvoiceDate").alias("first_date"))


def table_fingerprint(spark, sf_dir):
    return tables.fingerprint(transactions(spark, sf_dir),
                              ["customer_id", "invoice_no", "stock_code", "quantity", "country"])


DIGEST_COLUMNS = ["customer_id", "invoice_no", "stock_code", "quantity", "country"]


def _month(name):
    return F.date_format(name, "yyyy-MM")


def partition_digests(spark, sf_dir):
    """The transactions' digest per month."""
    found = digests.partition_digests(transactions(spark, sf_dir), _month("invoice_date"),
                                      DIGEST_COLUMNS)
    return found.select("part", "n_rows", *[F.col(c).cast("bigint").alias(c)
                                            for c in ("low_sum", "high_sum")])


def changed_partitions(spark, sf_dir):
    """What an older state of the transactions differs in: a few quantities and a month."""
    table = transactions(spark, sf_dir)
    older = (table.filter(_month("invoice_date") != oracle.MISSING_MONTH)
             .withColumn("quantity", F.when(F.expr(oracle.OTHER_QUANTITY), F.col("quantity") + 1)
                         .otherwise(F.col("quantity"))))
    return digests.changed_parts(*[
        digests.partition_digests(t, _month("invoice_date"), DIGEST_COLUMNS)
        for t in (older, table)])


def refreshed_transactions(spark, sf_dir):
    """The clean table, first of an extract with other rows, then brought up to date by month."""
    path = scratch_path(spark, "clean")
    # Written once: each state is read for its digests and again for its rows.
    extract = materialise(views.dirty_extract(spark, sf_dir))
    older = extract.filter("StockCode <> '7' and InvoiceDate < '2001-03-15'")
    for source in (older, extract):
        found = digests.refresh_table(
            spark, path, source, _month("InvoiceDate"), clean.build_transactions,
            _month("invoice_date"))
    return found.table.drop("part")


def incremental_snapshots(spark, sf_dir):
    """Snapshots of the lines up to a day, brought up to date by two batches of later lines."""
    lines = transactions(spark, sf_dir)
    store = SnapshotStore(spark, scratch_path(spark, "store"), views.ORDER_SETTINGS)
    days = [F.lit(d).cast("timestamp_ntz") for d in ("2001-04-10", "2001-06-20")]
    date = F.col("invoice_date")
    store.refresh(lines.filter(date < days[0]))
    store.append(lines.filter((date >= days[0]) & (date < days[1])))
    store.append(lines.filter(date >= days[1]))
    return _rounded(store.snapshots(), oracle.ORDER_DIGITS)


def corrected_snapshots(spark, sf_dir):
    """Snapshots of lines with errors, brought up to date by comparing digests."""
    lines = transactions(spark, sf_dir)
    store = SnapshotStore(spark, scratch_path(spark, "store"), views.ORDER_SETTINGS)
    recent = F.col("invoice_date") >= F.lit("2001-05-10").cast("timestamp_ntz")
    store.refresh(lines.withColumn("quantity", F.when(recent, F.lit(1).cast("bigint"))
                                   .otherwise(F.col("quantity"))))
    store.refresh(lines)
    return _rounded(store.snapshots(), oracle.ORDER_DIGITS)


def _block(name):
    def query(spark, sf_dir):
        block = snap.build_features(transactions(spark, sf_dir), views.ORDER_CUTOFFS,
                                    views.HOME, (name,))
        present = {c: d for c, d in oracle.ORDER_DIGITS.items() if c in block.columns}
        return _rounded(block, present)
    return query


def outcome_labels(spark, sf_dir):
    known = snapshots(spark, sf_dir).select("customer_id", "cutoff")
    return snap.build_labels(transactions(spark, sf_dir), known, views.ORDER_CUTOFFS,
                             views.ORDER_SETTINGS.horizon_days)


def temporal_split(spark, sf_dir):
    dev, test = _dev_test(spark, sf_dir)
    both = dev.withColumn("split", F.lit("development")).unionByName(
        test.withColumn("split", F.lit("holdout")))
    return both.groupBy("split", "cutoff").agg(F.count(F.lit(1)).alias("n_rows"))


def money_report(spark, sf_dir):
    sweep = metrics.capacity_sweep(_rule_scores(spark, sf_dir), ["model"])
    return sweep.select("model", "k", *[money_text(c).alias(c)
                                        for c in ("revenue", "cost", "net")])


def _rule_holdout(spark, sf_dir):
    return diagnostics.holdout_metrics(_rule_scores(spark, sf_dir))


def _rule_cv(spark, sf_dir):
    table = snapshots(spark, sf_dir)
    return validation.cross_validate(table, snap.feature_columns(table), views.ORDER_DEV,
                                     models=_rule_models())


def tuning_summary(spark, sf_dir):
    columns = list(RULES.values())
    return _rounded(validation.tune(
        snapshots(spark, sf_dir), {i: models.recency_rule(c) for i, c in enumerate(columns)},
        {i: {"column_name": c} for i, c in enumerate(columns)}, views.ORDER_DEV), 9)


def permutation_importance(spark, sf_dir):
    dev, test = _dev_test(spark, sf_dir)
    fitted = models.fit(models.expression_rule(oracle.blend({})), dev)
    return diagnostics.permutation_table(fitted, test, snap.FEATURES, IMPORTANCE_REPEATS,
                                         read=list(oracle.BLEND))


def leakage_audit(spark, sf_dir):
    return audit.leakage_audit(transactions(spark, sf_dir), views.ORDER_SETTINGS,
                               original=snapshots(spark, sf_dir))


def feature_medians(spark, sf_dir):
    dev, _ = _dev_test(spark, sf_dir)
    return _rounded(ranking.exact_medians(dev, snap.FEATURES), 3)


def standardised_features(spark, sf_dir):
    dev, test = _dev_test(spark, sf_dir)
    names = snap.FEATURES
    scaled = models.numeric_preparation(names).fit(dev).transform(test)
    values = vector_to_array("scaled")
    return _rounded(scaled.select("customer_id", "cutoff",
                                  *[values[i].alias(c) for i, c in enumerate(names)]),
                    oracle.SCALED_DIGITS)


# Queries around fitted models: rows only, since no SQL engine can fit them.
def zoo_holdout(spark, sf_dir):
    dev, test = _dev_test(spark, sf_dir)
    return diagnostics.evaluate_holdout(models.model_zoo(snap.FEATURES), dev, test)


def zoo_cross_validation(spark, sf_dir):
    return validation.cross_validate(
        snapshots(spark, sf_dir), snap.FEATURES, views.ORDER_DEV,
        models=models.model_zoo(snap.FEATURES))


def zoo_importance(spark, sf_dir):
    dev, test = _dev_test(spark, sf_dir)
    fitted = models.fit(models.logistic_regression(snap.FEATURES, IMPORTANCE_FIT), dev)
    # As one expression over the features: no copy of a row becomes a vector.
    scorer = model_tables.TableModel(model_tables.model_table(spark, fitted).collect())
    table = diagnostics.permutation_table(scorer, test, snap.FEATURES, n_repeats=2)
    return diagnostics.top_importances(table)


def boosting_grid(spark, sf_dir):
    grid = models.BOOSTING_GRID
    return validation.tune(
        snapshots(spark, sf_dir),
        models.boosting_candidates(snap.FEATURES),
        dict(enumerate(grid)), views.ORDER_DEV)


def penalised_leaves(spark, sf_dir):
    """Leaf values of one small tree, and a second one on top of it, under several penalties."""
    dev, _ = _dev_test(spark, sf_dir)
    found = []
    for reg_lambda in oracle.PENALTIES:
        nodes = [Row(kind="boosting", tree=tree, node=node, feature=feature, fill=0.0, flag=False,
                     split=split, left=left, right=right, value=None, tree_weight=1.0)
                 for tree, (name, edge) in enumerate(oracle.STUMPS.items())
                 for node, feature, split, left, right in (
                     (0, name, edge, 1, 2), (1, None, None, None, None),
                     (2, None, None, None, None))]
        refitted = model_tables.refit_leaves(nodes, dev, reg_lambda, oracle.LEAF_STEP)
        found += [(reg_lambda, r["tree"], r["node"], r["value"]) for r in refitted if r["node"]]
    return _rounded(spark.createDataFrame(
        found, "reg_lambda double, tree int, leaf int, value double"), {"value": 9})


def _stored_model(spark, sf_dir):
    """A logistic regression on two features, fitted, stored as a table and read back."""
    dev, _ = _dev_test(spark, sf_dir)
    fitted = models.fit(models.logistic_regression(oracle.FITTED), dev)
    path = scratch_path(spark, "model")
    tables.write_table(model_tables.polished(fitted, dev), path)
    return spark.read.schema(model_tables.MODEL_SCHEMA).parquet(path)


def model_weights(spark, sf_dir):
    return _stored_model(spark, sf_dir).select(
        F.coalesce("feature", F.lit("constant")).alias("feature"), "fill",
        round_half_even("value", 6).alias("weight"))


def stored_model_scores(spark, sf_dir):
    _, test = _dev_test(spark, sf_dir)
    scored = model_tables.score_with_table(_stored_model(spark, sf_dir), test)
    return scored.select("customer_id", "cutoff", "label",
                         round_half_even("score", 6).alias("score"))


def logistic_certificate(spark, sf_dir):
    """Whether the logistic regression of every fold, on all features, is at its minimum."""
    table = snapshots(spark, sf_dir)
    fits = {}
    for fold, (train_cuts, _) in enumerate(validation.expanding_window_folds(
            parse_cutoffs(views.ORDER_DEV)), start=1):
        trained_on = validation.on_day_of(train_cuts)
        fits[fold] = (models.fit(models.logistic_regression(snap.FEATURES),
                                 table.filter(trained_on)), trained_on)
    gradients = model_tables.penalised_gradients(table, fits)
    return gradients.groupBy("fold", "n_train").agg(
        F.count_if(F.col("feature") != "const").alias("features"),
        (F.max(F.abs("gradient")) < 1e-6).alias("at_minimum"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rule_precision_at_20": rule_precision_at_20,
    "transactions": transactions,
    "cleaned_transactions": cleaned_transactions,
    "raw_csv_round_trip": raw_csv_round_trip,
    "transaction_profile": lambda s, d: clean.profile(transactions(s, d)),
    "table_fingerprint": table_fingerprint,
    "partition_digests": partition_digests,
    "changed_partitions": changed_partitions,
    "refreshed_transactions": refreshed_transactions,
    "incremental_snapshots": incremental_snapshots,
    "corrected_snapshots": corrected_snapshots,
    "orders_at_cutoffs":
        lambda s, d: snap.orders_at_cutoffs(transactions(s, d), views.ORDER_CUTOFFS),
    "straddling_orders_at_cutoffs":
        lambda s, d: snap.orders_at_cutoffs(views.session_transactions(s, d),
                                            views.EVENT_SETTINGS.cutoffs),
    **{f"{name}_block": _block(name) for name in snap.FEATURE_BLOCKS},
    "outcome_labels": outcome_labels,
    "snapshots": lambda s, d: _rounded(snapshots(s, d), oracle.ORDER_DIGITS),
    "event_snapshots": lambda s, d: _rounded(
        snap.build_snapshots(views.event_transactions(s, d), views.EVENT_SETTINGS),
        oracle.EVENT_DIGITS),
    "straddling_snapshots": lambda s, d: _rounded(
        snap.build_snapshots(views.session_transactions(s, d), views.EVENT_SETTINGS),
        oracle.EVENT_DIGITS),
    "one_cutoff_snapshot": lambda s, d: _rounded(
        snap.snapshot(transactions(s, d), ONE_CUTOFF.cutoffs[0], ONE_CUTOFF.horizon_days,
                      ONE_CUTOFF.min_history_days, ONE_CUTOFF.home_market), oracle.ORDER_DIGITS),
    "cutoff_history":
        lambda s, d: snap.cutoff_history(transactions(s, d), views.ORDER_CUTOFFS),
    "fold_sizes": lambda s, d: validation.fold_sizes(snapshots(s, d), views.ORDER_DEV),
    "temporal_split": temporal_split,
    "seasonality": lambda s, d: diagnostics.seasonality(snapshots(s, d), views.ORDER_HOLDOUT),
    "rule_scores": lambda s, d: _rounded(
        _rule_scores(s, d).select("model", "customer_id", "cutoff", "label", "score"), 12),
    "global_rank": lambda s, d: ranking.global_rank(_rule_scores(s, d), ["model"]).select(
        "model", "customer_id", "cutoff", "label", "rank"),
    "top_share": lambda s, d: _rounded(
        metrics.top_share(_rule_scores(s, d), ["model"], metrics.CAPACITIES), 9),
    "holdout_metrics": lambda s, d: _rounded(_rule_holdout(s, d), 9),
    "gains_table": lambda s, d: metrics.gains_table(_rule_scores(s, d), ["model"]),
    "expected_value":
        lambda s, d: _rounded(metrics.expected_value(_rule_scores(s, d), ["model"]), 9),
    "capacity_sweep": lambda s, d: metrics.capacity_sweep(_rule_scores(s, d), ["model"]),
    "money_report": money_report,
    "calibration_table":
        lambda s, d: metrics.calibration_table(_rule_scores(s, d), ["model"], digits=6),
    "pr_curve": lambda s, d: _rounded(
        metrics.pr_curve(_rule_scores(s, d), ["model"]),
        {"threshold": 12, "precision": 9, "recall": 9}),
    "roc_curve": lambda s, d: _rounded(
        metrics.roc_curve(_rule_scores(s, d), ["model"]), {"threshold": 12, "fpr": 9, "tpr": 9}),
    "stability": lambda s, d: diagnostics.stability(_rule_scores(s, d)),
    "best_model": lambda s, d: _rounded(diagnostics.best_model(_rule_holdout(s, d)), 9),
    "headline": lambda s, d: _rounded(
        diagnostics.headline(_rule_holdout(s, d), "overdue_rule"), 9),
    "cross_validation": lambda s, d: _rounded(_rule_cv(s, d), 9),
    "cv_summary": lambda s, d: validation.summarise_cv(_rule_cv(s, d)),
    "cv_fold_series": lambda s, d: _rounded(validation.fold_series(_rule_cv(s, d)), 9),
    "cv_accuracy":
        lambda s, d: _rounded(validation.accuracy_against_majority(_rule_cv(s, d)), 9),
    "tuning_summary": tuning_summary,
    "permutation_importance": permutation_importance,
    "leakage_audit": leakage_audit,
    "feature_medians": feature_medians,
    "standardised_features": standardised_features,
    "zoo_holdout": zoo_holdout,
    "zoo_cross_validation": zoo_cross_validation,
    "zoo_importance": zoo_importance,
    "boosting_grid": boosting_grid,
    "penalised_leaves": penalised_leaves,
    "model_weights": model_weights,
    "stored_model_scores": stored_model_scores,
    "logistic_certificate": logistic_certificate,
}

ORACLE_SQL = oracle.statements(
    (diagnostics.ROUNDS, diagnostics.WALK, diagnostics._PRIME, diagnostics._FACTOR),
    IMPORTANCE_REPEATS, SEED, ONE_CUTOFF)
