"""Fitted models as tables: one row per weight or node, scored by a generated column expression.

A table can be read, compared, edited and joined like any other, and scoring needs neither the
library that fitted the model nor a Python process: it is one expression over the features.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce
from operator import add

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassificationModel, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.ml.feature import SQLTransformer, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.session import rewritten, scratch_path

#: ``linear``: a weight per feature, and one row without feature for the constant. ``forest``,
#: ``boosting`` and ``penalised``: inner nodes have a feature, a split and two children, leaves a
#: value.
MODEL_SCHEMA = ("kind string, tree int, node int, feature string, fill double, flag boolean, "
                "split double, left int, right int, value double, tree_weight double")
#: An expression with more nodes would not compile to code; such ensembles are scored as fitted.
MOST_NODES = 20_000
#: Nodes of an expression in an ensemble that is scored piece by piece.
PIECE_NODES = 2_000


# ---------------------------------------------------------------------------------------------
# From fitted models to rows
# ---------------------------------------------------------------------------------------------
def _inputs(model: PipelineModel) -> list[tuple[str, float, bool]]:
    """Feature, filling value and whether only its absence counts, per place of the vector."""
    statement = next(s for s in model.stages if isinstance(s, SQLTransformer)).getStatement()
    fills = {name: float(text) for name, text in re.findall(
        r"coalesce\(cast\(`([^`]+)` AS double\), (\S+?)D\)", statement)}
    columns = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return [(c.removesuffix("_filled"), fills[c.removesuffix("_filled")], False)
            if c.endswith("_filled") else (c.removesuffix("_missing"), None, True)
            for c in columns]


def linear_rows(weights: dict[str, float], constant: float, fills: dict[str, float]
                ) -> list[tuple]:
    rows = [("linear", 0, k, name, float(fills[name]), False, None, None, None, float(weight),
             None) for k, (name, weight) in enumerate(weights.items())]
    return [*rows, ("linear", 0, len(rows), None, None, False, None, None, None, float(constant),
                    None)]


def _scaler(model: PipelineModel) -> StandardScalerModel:
    return next(s for s in model.stages if isinstance(s, StandardScalerModel))


def _scaled_columns(model: PipelineModel) -> list[Column]:
    """The features as the model was fitted on them; one without spread is zero."""
    scaler = _scaler(model)
    return [(F.coalesce(F.col(name).cast("double"), F.lit(fill)) - F.lit(float(mean)))
            / F.lit(float(std)) if std else F.lit(0.0)
            for (name, fill, _), mean, std in zip(_inputs(model), scaler.mean, scaler.std)]


def _logistic_rows(model: PipelineModel, scaled: list[float], constant: float) -> list[tuple]:
    """Weights of the standardised features as weights of the features themselves."""
    scaler, inputs = _scaler(model), _inputs(model)
    weights = [w / s if s else 0.0 for w, s in zip(scaled, scaler.std)]
    constant -= sum(w * m for w, m in zip(weights, scaler.mean))
    return linear_rows({name: w for (name, _, _), w in zip(inputs, weights)}, constant,
                       {name: fill for name, fill, _ in inputs})


def polished(model: PipelineModel, train: DataFrame, c: float = 1.0, steps: int = 2) -> DataFrame:
    """The rows of a logistic regression, after Newton's steps from where its fit has ended.

    A step is one aggregation of the gradient and of all second derivatives, half the square
    of the number of features; only those sums reach the driver. It squares the distance to
    the minimum, which an iterative fit approaches slowly. For some tens of features at most.
    """
    fitted = model.stages[-1]
    x = [F.lit(1.0), *_scaled_columns(model)]
    weights = np.array([fitted.intercept, *fitted.coefficients])
    penalty = np.diag([0.0] + [1.0 / c] * (len(x) - 1))
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    for _ in range(steps):
        margin = reduce(add, [F.lit(float(w)) * column for w, column in zip(weights, x)])
        rows = train.withColumn("_p", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))
        error, curve = F.col("_p") - F.col("label"), F.col("_p") * (F.lit(1.0) - F.col("_p"))
        sums = rows.agg(*[F.sum(error * column) for column in x],
                        *[F.sum(curve * x[i] * x[j]) for i, j in pairs]).first()
        if sums[0] is None:
            break
        second = penalty.copy()
        for (i, j), value in zip(pairs, sums[len(x):]):
            second[i, j] += value
            if i != j:
                second[j, i] += value
        # Features without spread have no curvature but that of the penalty.
        weights = weights - np.linalg.solve(second, np.array(sums[:len(x)]) + penalty @ weights)
    return train.sparkSession.createDataFrame(
        _logistic_rows(model, list(map(float, weights[1:])), float(weights[0])), MODEL_SCHEMA)


def model_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The rows of a fitted logistic regression, forest or boosted ensemble."""
    fitted = model.stages[-1]
    if isinstance(fitted, LogisticRegressionModel):
        return spark.createDataFrame(_logistic_rows(
            model, list(map(float, fitted.coefficients)), float(fitted.intercept)), MODEL_SCHEMA)
    if not isinstance(fitted, (RandomForestClassificationModel, GBTClassificationModel)):
        raise TypeError(f"no table form for {type(fitted).__name__}")
    path = scratch_path(spark, "trees")
    fitted.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").select(
        F.col("_1").alias("treeID"), F.col("_3").alias("tree_weight"))
    names, fills, flags = zip(*_inputs(model))
    place = F.col("split.featureIndex")
    inner = F.col("leftChild") >= 0

    def of_feature(values, kind: str) -> Column:
        known = F.array(*[F.lit(v).cast(kind) for v in values])
        return F.when(inner, F.get(known, place))

    is_forest = isinstance(fitted, RandomForestClassificationModel)
    stats = F.col("impurityStats")
    leaf = stats[1] / (stats[0] + stats[1]) if is_forest else F.col("prediction")
    return nodes.join(weights, "treeID").select(
        F.lit("forest" if is_forest else "boosting").alias("kind"), F.col("treeID").alias("tree"),
        F.col("id").alias("node"), of_feature(names, "string").alias("feature"),
        of_feature(fills, "double").alias("fill"), of_feature(flags, "boolean").alias("flag"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("split"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.when(~inner, leaf).alias("value"), "tree_weight")


# ---------------------------------------------------------------------------------------------
# From rows to scores
# ---------------------------------------------------------------------------------------------
def _value(row: Row) -> Column:
    column = F.col(row["feature"])
    if row["flag"]:
        return column.isNull().cast("double")
    return F.coalesce(column.cast("double"), F.lit(row["fill"]))


def _trees(rows: Iterable[Row]) -> dict[int, dict[int, Row]]:
    trees: dict[int, dict[int, Row]] = {}
    for row in rows:
        trees.setdefault(row["tree"], {})[row["node"]] = row
    return dict(sorted(trees.items()))


def tree_column(nodes: dict[int, Row], leaf: Callable[[Row], Column], node: int = 0) -> Column:
    """What ``leaf`` gives for the leaf that a row comes to."""
    row = nodes[node]
    if row["left"] is None:
        return leaf(row)
    return F.when(_value(row) <= F.lit(row["split"]), tree_column(nodes, leaf, row["left"])) \
        .otherwise(tree_column(nodes, leaf, row["right"]))


def margin_column(rows: list[Row]) -> Column:
    """The weighted sum before it becomes a probability; weights are added in the order of their
    number, the constant last."""
    if len(rows) > MOST_NODES:
        raise ValueError(f"{len(rows)} rows are too many for one expression; score with the "
                         "fitted model")
    if rows[0]["kind"] == "linear":
        ordered = sorted(rows, key=lambda r: r["node"])
        return reduce(add, [F.lit(r["value"]) if r["feature"] is None
                            else _value(r) * F.lit(r["value"]) for r in ordered])
    return reduce(add, [
        tree_column(nodes, lambda r: F.lit(r["value"])) * F.lit(nodes[0]["tree_weight"])
        for nodes in _trees(rows).values()])


def score_column(rows: list[Row]) -> Column:
    """P(class 1) as one expression over the features."""
    return _probability(rows, margin_column(rows))


def _probability(rows: list[Row], margin: Column) -> Column:
    kind = rows[0]["kind"]
    if kind == "forest":
        return margin / F.lit(float(len(_trees(rows))))
    factor = 2.0 if kind == "boosting" else 1.0
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin * F.lit(factor)))


def score_in_pieces(rows: list[Row], df: DataFrame) -> DataFrame:
    """``df`` with ``score``, for any number of trees: their values are added up some trees at a
    time, in the order of ``margin_column``, and the rows written in between."""
    pieces: list[list[Column]] = [[]]
    nodes_in_piece = 0
    for nodes in _trees(rows).values():
        if pieces[-1] and nodes_in_piece + len(nodes) > PIECE_NODES:
            pieces.append([])
            nodes_in_piece = 0
        nodes_in_piece += len(nodes)
        pieces[-1].append(tree_column(nodes, lambda r: F.lit(r["value"]))
                          * F.lit(nodes[0]["tree_weight"]))
    state, before = df.withColumn("_margin", F.lit(0.0)), None
    for k, piece in enumerate(pieces):
        if k:
            state, before = rewritten(state, before)
        state = state.withColumn("_margin", reduce(add, piece, F.col("_margin")))
    return state.withColumn("score", _probability(rows, F.col("_margin"))).drop("_margin")


def score_with_table(table: DataFrame, df: DataFrame) -> DataFrame:
    """``df`` with ``score``. The model's rows reach the driver: at most ``MOST_NODES``."""
    rows = table.limit(MOST_NODES + 1).collect()
    return df.withColumn("score", score_column(rows))


def features_read(table: DataFrame) -> list[str]:
    return [r["feature"] for r in table.where("feature is not null").select("feature")
            .distinct().orderBy("feature").collect()]


# ---------------------------------------------------------------------------------------------
# Leaf values with a penalty
# ---------------------------------------------------------------------------------------------
def refit_leaves(rows: list[Row], train: DataFrame, reg_lambda: float, step: float) -> list[Row]:
    """The trees with new leaf values, ``-step * G / (H + reg_lambda)``, tree after tree.

    G and H are sums of the first and second derivatives of the log loss over the training rows of a
    leaf, given the trees before. Each tree is one aggregation to its leaves; the margins so
    far are written now and then, so that expressions stay short, and replace those before.
    """
    features = sorted({r["feature"] for r in rows if r["feature"] is not None})
    state = train.select(*features, "label", F.lit(0.0).alias("_margin"))
    out: list[Row] = []
    before = None
    for done, (tree, nodes) in enumerate(_trees(rows).items(), start=1):
        leaf = tree_column(nodes, lambda r: F.lit(r["node"]))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        sums = state.groupBy(leaf.alias("leaf")).agg(
            F.sum(p - F.col("label")).alias("g"), F.sum(p * (F.lit(1.0) - p)).alias("h"))
        values = {r["leaf"]: -step * r["g"] / (r["h"] + reg_lambda)
                  for r in sums.collect() if r["h"] + reg_lambda > 0}
        new = {k: Row(**{**r.asDict(), "kind": "penalised", "tree": tree, "tree_weight": 1.0,
                         "value": values.get(k, 0.0) if r["left"] is None else None})
               for k, r in nodes.items()}
        out += new.values()
        state = state.withColumn("_margin", F.col("_margin") + tree_column(
            new, lambda r: F.lit(r["value"])))
        if done % _WRITTEN_EVERY == 0:
            state, before = rewritten(state, before)
    return out


_WRITTEN_EVERY = 20


class TableModel(Transformer):
    """Scores with the rows of a model table."""

    def __init__(self, rows: list[Row]):
        super().__init__()
        self.rows = rows

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if len(self.rows) > PIECE_NODES:
            return score_in_pieces(self.rows, dataset)
        return dataset.withColumn("score", score_column(self.rows))


class PenalisedBoosting(Estimator):
    """Boosted trees whose leaf values are fitted again under an L2 penalty."""

    def __init__(self, boosted: Pipeline, reg_lambda: float, step: float):
        super().__init__()
        self.boosted, self.reg_lambda, self.step = boosted, reg_lambda, step

    def _fit(self, dataset: DataFrame) -> Transformer:
        rows = model_table(dataset.sparkSession, self.boosted.fit(dataset)).collect()
        return TableModel(refit_leaves(rows, dataset, self.reg_lambda, self.step))


# ---------------------------------------------------------------------------------------------
# Certificate of a logistic fit
# ---------------------------------------------------------------------------------------------
def penalised_gradients(rows: DataFrame, fits: dict[int, tuple[PipelineModel, Column]],
                        c: float = 1.0) -> DataFrame:
    """(fold, n_train, feature, gradient): how far each fit is from the minimum of its penalised
    mean log loss, in standardised units; at the minimum all are zero.

    ``fits`` maps a fold to its model and the condition for its training rows. All folds and
    features are sums of one aggregation.
    """
    sums, parts = [], {}
    for fold, (model, trained_on) in fits.items():
        fitted = model.stages[-1]
        inputs, scaled = _inputs(model), _scaled_columns(model)
        margin = reduce(add, [x * F.lit(float(w)) for x, w in zip(scaled, fitted.coefficients)]
                        ) + F.lit(float(fitted.intercept))
        error = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col("label")
        rows = rows.withColumn(f"_error_{fold}", F.when(trained_on, error))
        error = F.col(f"_error_{fold}")
        sums.append(F.count(error).alias(f"n_{fold}"))
        sums.append(F.sum(error).alias(f"g_{fold}_const"))
        sums += [F.sum(error * x).alias(f"g_{fold}_{k}") for k, x in enumerate(scaled)]
        parts[fold] = [("const", 0.0), *zip([i[0] for i in inputs], map(float, fitted.coefficients))]
    found = rows.agg(*sums)

    def gradient(fold: int, name: str, k: int, weight: float) -> Column:
        total = F.col(f"g_{fold}_const") if name == "const" else F.col(f"g_{fold}_{k - 1}")
        return F.struct(F.lit(fold).alias("fold"), F.col(f"n_{fold}").alias("n_train"),
                        F.lit(name).alias("feature"),
                        ((total + F.lit(weight / c)) / F.col(f"n_{fold}")).alias("gradient"))

    return found.select(F.inline(F.array(*[
        gradient(fold, name, k, weight)
        for fold, names in parts.items() for k, (name, weight) in enumerate(names)])))
