"""Every registered query at the smallest scale, against its SQL in DuckDB where it has one."""

from datetime import datetime
from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tidemark.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = {"zoo_holdout", "zoo_cross_validation", "zoo_importance", "boosting_grid"}
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(frame: pd.DataFrame) -> list:
    """Rows as sorted text, columns by name, numbers alike whatever their width."""
    columns = []
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(column):
            column = column.astype(float) + 0.0
        columns.append(column.astype(object).where(column.notna(), None).astype(str))
    return sorted(zip(*columns))


def test_every_query_is_checked_or_known_to_be_rows_only():
    assert set(catalog.QUERIES) - set(catalog.ORACLE_SQL) == ROWS_ONLY
    assert set(catalog.QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - ROWS_ONLY))
def test_matches_sql(spark, duck, name):
    got = entry_points.queries()[name](spark, SF_DIR).toPandas()
    want = duck.sql(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    assert comparable(got) == comparable(want)


def test_fitted_models_give_rows(spark):
    assert entry_points.queries()["zoo_holdout"](spark, SF_DIR).count() > 0


def sizes_of(zoo) -> dict:
    forest, boosted = zoo["random_forest"].getStages()[-1], zoo["gbt"].getStages()[-1]
    return {"iterations": zoo["logistic_regression"].getStages()[-1].max_iter,
            "trees": (forest.getNumTrees(), forest.getMaxDepth()),
            "rounds": (boosted.getMaxIter(), boosted.getMaxDepth())}


FULL_SIZES = {"iterations": 2000, "trees": (400, 12), "rounds": (300, 3)}


def test_zoo_holdout_fits_full_sizes(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_dev_test", lambda *_: (None, None))
    monkeypatch.setattr(catalog.diagnostics, "evaluate_holdout", lambda zoo, *_: sizes_of(zoo))
    assert catalog.zoo_holdout(spark, "") == FULL_SIZES


def test_zoo_cross_validation_fits_full_sizes(spark, monkeypatch):
    monkeypatch.setattr(catalog, "snapshots", lambda *_: None)
    monkeypatch.setattr(catalog.validation, "cross_validate",
                        lambda *_, models: sizes_of(models))
    assert catalog.zoo_cross_validation(spark, "") == FULL_SIZES


def test_boosting_grid_fits_all_rounds(spark, monkeypatch):
    monkeypatch.setattr(catalog, "snapshots", lambda *_: None)
    monkeypatch.setattr(catalog.validation, "tune", lambda _, found, *rest: found)
    rounds = [c.getStages()[0].boosted.getStages()[-1].getMaxIter()
              for c in catalog.boosting_grid(spark, "").values()]
    assert rounds == [p["n_estimators"] for p in catalog.models.BOOSTING_GRID]


def test_importance_is_scored_by_an_expression(spark, monkeypatch):
    """And the medians of its fit come from one count, not from a sketch of every value."""
    rows = spark.createDataFrame(
        [(k, datetime(2011, 1, 1), *[float(k * j % 7) for j in range(1, 34)], k % 2)
         for k in range(60)], "customer_id bigint, cutoff timestamp_ntz, "
        + ", ".join(f"{f} double" for f in catalog.snap.FEATURES) + ", label int")
    seen = []

    def importances(scorer, test, features, **_):
        seen.append(scorer)
        return test.select(*[catalog.F.lit(0.0).alias("pr_auc_drop"),
                             catalog.F.lit("a").alias("feature")]).limit(1)

    def sketched(*_):
        raise AssertionError("medians by a sketch")

    monkeypatch.setattr(catalog, "_dev_test", lambda *_: (rows, rows))
    monkeypatch.setattr(catalog.diagnostics, "permutation_table", importances)
    monkeypatch.setattr(catalog.ranking, "brackets_of", sketched)
    assert catalog.zoo_importance(spark, "").count() == 1
    assert isinstance(seen[0], catalog.model_tables.TableModel)
