"""Rankers: a recency rule and three MLlib pipelines behind one fit/score interface."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import SEED
from tidemark.operators.model_tables import PenalisedBoosting
from tidemark.operators.ranking import medians_by_group
from tidemark.session import cut_lineages

MISSING_RECENCY = 999.0


class MedianImputer(Estimator):
    """Fit the exact median of each feature (0 if all are missing); fill missing values with it.

    Fitted values become part of a plain SQL stage, so the fitted pipeline stays in the JVM.
    ``flags`` are features for which a 0/1 missing indicator is added.
    """

    def __init__(self, features: list[str], flags: tuple[str, ...] = ()):
        super().__init__()
        self.features = list(features)
        self.flags = tuple(f for f in flags if f in self.features)

    @property
    def output_columns(self) -> list[str]:
        return ([f"{f}_filled" for f in self.features] + [f"{f}_missing" for f in self.flags])

    def medians_of(self, dataset: DataFrame) -> dict[str, float]:
        # One row per feature reaches the driver. All rows are one part of one group.
        found = medians_by_group(dataset, self.features, F.lit(0), {0: [0]})[0]
        return {f: float(found.get(f) or 0.0) for f in self.features}

    def filling_with(self, medians: dict[str, float]) -> Transformer:
        filled = [f"coalesce(cast(`{f}` AS double), {medians[f]!r}D) AS `{f}_filled`"
                  for f in self.features]
        flags = [f"CASE WHEN `{f}` IS NULL THEN 1D ELSE 0D END AS `{f}_missing`"
                 for f in self.flags]
        return SQLTransformer(statement=f"SELECT *, {', '.join(filled + flags)} FROM __THIS__")

    def _fit(self, dataset: DataFrame) -> Transformer:
        return self.filling_with(self.medians_of(dataset))


class PenalisedLogisticRegression(Estimator):
    """L2 logistic regression with strength ``c`` on the summed loss, whatever the row count."""

    def __init__(self, features_col: str, c: float = 1.0, max_iter: int = 2000,
                 tolerance: float = 1e-9):
        super().__init__()
        self.features_col, self.c, self.max_iter = features_col, c, max_iter
        self.tolerance = tolerance

    def _fit(self, dataset: DataFrame) -> Transformer:
        rows = dataset.count()
        return LogisticRegression(
            featuresCol=self.features_col, labelCol="label", maxIter=self.max_iter,
            elasticNetParam=0.0, regParam=1.0 / (self.c * max(rows, 1)),
            standardization=False, tol=self.tolerance).fit(dataset)


@dataclass(frozen=True)
class ModelSizes:
    """Size parameters of the zoo; smaller ones make trial runs quick."""

    logistic_iterations: int = 2000
    logistic_tolerance: float = 1e-9
    forest_trees: int = 400
    forest_depth: int = 12
    forest_min_rows: int = 20
    boosting_rounds: int = 300
    boosting_depth: int = 3
    boosting_step: float = 0.05
    # A row adds at most p(1-p), about 0.2, to a child's Hessian sum: weight 10 is some 50 rows.
    boosting_min_rows: int = 50
    boosting_row_share: float = 0.8
    boosting_column_share: float = 0.8
    seed: int = SEED


# The published search grid, in its own parameter names.
BOOSTING_GRID = [
    dict(n_estimators=300, max_depth=3, learning_rate=0.05, min_child_weight=10,
         reg_lambda=5.0, subsample=0.8, colsample_bytree=0.8),
    dict(n_estimators=600, max_depth=3, learning_rate=0.03, min_child_weight=20,
         reg_lambda=5.0, subsample=0.8, colsample_bytree=0.6),
    dict(n_estimators=400, max_depth=4, learning_rate=0.05, min_child_weight=5,
         reg_lambda=2.0, subsample=0.8, colsample_bytree=0.8),
    dict(n_estimators=800, max_depth=2, learning_rate=0.05, min_child_weight=20,
         reg_lambda=10.0, subsample=0.9, colsample_bytree=0.6),
    dict(n_estimators=300, max_depth=6, learning_rate=0.05, min_child_weight=30,
         reg_lambda=5.0, subsample=0.8, colsample_bytree=0.8),
]

# Features that are missing for customers with a single order.
MAYBE_MISSING = ("mean_gap_days", "min_gap_days", "max_gap_days", "gap_cv", "recency_vs_gap")


def recency_rule(column: str = "recency_days", missing: float = MISSING_RECENCY) -> Pipeline:
    """Score 1 / (1 + recency): the order a spreadsheet sort gives. Fits nothing."""
    rule = SQLTransformer(statement=(
        f"SELECT *, 1D / (1D + coalesce(cast(`{column}` AS double), {missing!r}D)) AS score "
        "FROM __THIS__"))
    return Pipeline(stages=[rule])


def expression_rule(score: str) -> Pipeline:
    """A ranker that scores by a SQL expression over the features. Fits nothing."""
    return Pipeline(stages=[SQLTransformer(
        statement=f"SELECT *, {score} AS score FROM __THIS__")])


def rule_score(column="recency_days", missing: float = MISSING_RECENCY):
    """The same rule as a column expression."""
    return F.lit(1.0) / (F.lit(1.0) + F.coalesce(F.col(column).cast("double"), F.lit(missing)))


def _vector(features: list[str], flags: tuple[str, ...] = ()):
    imputer = MedianImputer(features, flags)
    return [imputer, VectorAssembler(inputCols=imputer.output_columns, outputCol="filled")]


def numeric_preparation(features: list[str]) -> Pipeline:
    """Median filling, then mean 0 and deviation 1, as the vector ``scaled``; fitted on the
    training rows only."""
    return Pipeline(stages=[
        *_vector(features),
        StandardScaler(inputCol="filled", outputCol="scaled", withMean=True, withStd=True)])


def logistic_regression(features: list[str], sizes: ModelSizes = ModelSizes()) -> Pipeline:
    return Pipeline(stages=[
        *numeric_preparation(features).getStages(),
        PenalisedLogisticRegression("scaled", 1.0, sizes.logistic_iterations,
                                    sizes.logistic_tolerance)])


def random_forest(features: list[str], sizes: ModelSizes = ModelSizes()) -> Pipeline:
    return Pipeline(stages=[*_vector(features), RandomForestClassifier(
        featuresCol="filled", labelCol="label", numTrees=sizes.forest_trees,
        maxDepth=sizes.forest_depth, minInstancesPerNode=sizes.forest_min_rows,
        featureSubsetStrategy="sqrt", seed=sizes.seed)])


def boosted_trees(features: list[str], sizes: ModelSizes = ModelSizes()) -> Pipeline:
    """Gradient-boosted trees. Missing cadence is filled and flagged; there is no leaf penalty,
    and columns are sampled per node."""
    return Pipeline(stages=[*_vector(features, MAYBE_MISSING), GBTClassifier(
        featuresCol="filled", labelCol="label", maxIter=sizes.boosting_rounds,
        maxDepth=sizes.boosting_depth, stepSize=sizes.boosting_step,
        minInstancesPerNode=sizes.boosting_min_rows, subsamplingRate=sizes.boosting_row_share,
        featureSubsetStrategy=str(sizes.boosting_column_share), seed=sizes.seed)])


def model_zoo(features: list[str], sizes: ModelSizes = ModelSizes()) -> dict[str, Estimator]:
    """Name to unfitted model, from a rule to boosting."""
    return {
        "recency_baseline": recency_rule(),
        "logistic_regression": logistic_regression(features, sizes),
        "random_forest": random_forest(features, sizes),
        "gbt": boosted_trees(features, sizes),
    }


def boosting_candidates(features: list[str], grid=tuple(BOOSTING_GRID),
                        rounds_share: float = 1.0) -> dict[int, Estimator]:
    """The grid as estimators, each with its leaf penalty: one more aggregation per round.
    ``rounds_share`` scales the number of rounds for trial runs."""
    def sizes(p: dict) -> ModelSizes:
        return ModelSizes(
            boosting_rounds=max(1, round(p["n_estimators"] * rounds_share)),
            boosting_depth=p["max_depth"], boosting_step=p["learning_rate"],
            boosting_min_rows=5 * p["min_child_weight"], boosting_row_share=p["subsample"],
            boosting_column_share=p["colsample_bytree"])
    return {i: Pipeline(stages=[PenalisedBoosting(
        boosted_trees(features, sizes(p)), p["reg_lambda"], p["learning_rate"])])
        for i, p in enumerate(grid)}


def _imputers(model: Pipeline) -> Iterator[MedianImputer]:
    for stage in model.getStages():
        if isinstance(stage, MedianImputer):
            yield stage
        elif isinstance(stage, PenalisedBoosting):
            yield from _imputers(stage.boosted)


def _filled_features(models) -> list[str]:
    return list(dict.fromkeys(
        f for model in models for imputer in _imputers(model) for f in imputer.features))


def medians_of(models, train: DataFrame) -> dict[str, float]:
    """The medians that any of the models fills in, found once for all of them."""
    names = _filled_features(models)
    return MedianImputer(names).medians_of(train) if names else {}


def medians_by_fold(models, rows: DataFrame, part: Column, folds: dict
                    ) -> dict[object, dict[str, float]]:
    """Those medians for folds that share parts of the rows, found in one go."""
    names = _filled_features(models)
    found = medians_by_group(rows, names, part, folds)
    return {fold: {f: float(found[fold].get(f) or 0.0) for f in names} for fold in folds}


def _with_medians(model: Pipeline, train: DataFrame, medians: dict[str, float]) -> Pipeline:
    stages = []
    for stage in model.getStages():
        if isinstance(stage, MedianImputer):
            if not set(stage.features) <= set(medians):
                medians.update(stage.medians_of(train))
            stage = stage.filling_with(medians)
        elif isinstance(stage, PenalisedBoosting):
            stage = PenalisedBoosting(_with_medians(stage.boosted, train, medians),
                                      stage.reg_lambda, stage.step)
        stages.append(stage)
    return Pipeline(stages=stages)


def fit(model: Pipeline, train: DataFrame, medians: dict[str, float] | None = None
        ) -> PipelineModel:
    """Fit one model. ``medians`` remembers those of ``train`` between models fitted on it."""
    cut_lineages(train.sparkSession)
    return (model if medians is None else _with_medians(model, train, medians)).fit(train)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the probability of class 1 as ``score``; helper columns are dropped."""
    out = model.transform(df)
    if "score" not in out.columns:
        out = out.withColumn("score", vector_to_array("probability")[1])
    return out.select(*df.columns, "score")


def save_model(model: PipelineModel, name: str, path: str) -> str:
    """Store a fitted model under its name; the feature list travels in the assembler stage."""
    target = f"{path.rstrip('/')}/{name}"
    model.write().overwrite().save(target)
    return target


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    """Feature names of a stored model, read back from its assembler."""
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            return [c.removesuffix("_filled") for c in stage.getInputCols()
                    if c.endswith("_filled")]
    return []
