from datetime import datetime

import numpy as np
import pandas as pd
import pytest

from tidemark.config import DEV_CUTOFFS
from tidemark.operators import diagnostics as D
from tidemark.operators import model_tables as T
from tidemark.operators import models as M
from tidemark.operators import validation as V

SMALL = M.ModelSizes(logistic_iterations=20, forest_trees=5, forest_depth=4, forest_min_rows=2,
                     boosting_rounds=3, boosting_min_rows=2)
NAMES = {"recency_baseline", "logistic_regression", "random_forest", "gbt"}


def test_folds_grow_and_never_train_on_the_future(spark):
    cutoffs = [f"2015-02-{day:02d}" for day in (2, 9, 13, 16, 20, 27)]
    folds = V.expanding_window_folds(cutoffs)
    assert [len(train) for train, _ in folds] == [3, 4, 5]
    assert all(c < valid for train, valid in folds for c in train)
    rows = V.fold_table(spark, cutoffs).collect()
    assert len(rows) == 4 + 5 + 6
    assert {r["cutoff"] for r in rows if r["role"] == "valid"} == \
        {datetime(2015, 2, day) for day in (16, 20, 27)}


@pytest.fixture(scope="module")
def snapshots(spark):
    """150 customers at each of five cutoffs; frequent ones return more often."""
    rng = np.random.default_rng(31)
    rows = []
    for cutoff in DEV_CUTOFFS[:5]:
        for customer in range(150):
            orders = 1 + int(rng.poisson(3))
            rows.append((customer, int(rng.integers(0, 120)) + 0.5, orders,
                         int(rng.random() < (0.55 if orders > 4 else 0.25)), pd.Timestamp(cutoff)))
    frame = pd.DataFrame(rows, columns=["customer_id", *FEATURES, "label", "cutoff"])
    return spark.createDataFrame(frame, "customer_id bigint, recency_days double, "
                                 "frequency bigint, label int, cutoff timestamp_ntz").cache()


FEATURES = ["recency_days", "frequency"]


def test_recency_rule(spark):
    df = spark.createDataFrame([(1.0,), (10.0,), (None,)], "recency_days double")
    rule = M.fit(M.recency_rule(), df)
    scores = [r["score"] for r in M.score(rule, df).collect()]
    assert scores == [1 / 2, 1 / 11, 1 / 1000]
    assert [r[0] for r in df.select(M.rule_score()).collect()] == scores


def test_zoo_gives_probabilities_and_tolerates_missing_values(spark):
    gaps = [None if k % 4 == 0 else float(k * 7 % 41 + 1) for k in range(90)]
    rows = [(float(k * 29 % 90), gaps[k], None, int(k * 29 % 90 < 36)) for k in range(90)]
    df = spark.createDataFrame(
        rows, "recency_days double, mean_gap_days double, gap_cv double, label int")
    features = ["recency_days", "mean_gap_days", "gap_cv"]
    zoo = M.model_zoo(features, SMALL)
    assert set(zoo) == NAMES
    medians = {}
    for name, model in zoo.items():
        fitted = M.fit(model, df, medians)
        scored = M.score(fitted, df).toPandas()
        assert scored.score.between(0, 1).all() and len(scored) == 90, name
        if name == "random_forest":
            assert scored[scored.label == 1].score.mean() > scored[scored.label == 0].score.mean()
    assert medians["gap_cv"] == 0.0
    assert medians["mean_gap_days"] == np.median([g for g in gaps if g])


def test_penalty_follows_the_row_count(spark, snapshots):
    fitted = M.fit(M.logistic_regression(FEATURES, SMALL), snapshots)
    assert fitted.stages[-1].getRegParam() == pytest.approx(1 / 750)


def test_logistic_regression_reaches_its_optimum(spark, snapshots):
    """At the optimum of C * sum(loss) + |w|^2 / 2 the weights equal C * sum((y - p) * x)."""
    table = snapshots.withColumn("label", (D.F.col("recency_days") < 40).cast("int"))
    fitted = M.fit(M.logistic_regression(FEATURES, M.ModelSizes(logistic_iterations=500)), table)
    rows = fitted.transform(table).select("scaled", "label", "probability").collect()
    x = np.array([r["scaled"].toArray() for r in rows])
    residual = np.array([r["label"] - r["probability"][1] for r in rows])
    weights = fitted.stages[-1].coefficients.toArray()
    np.testing.assert_allclose(residual @ x, weights, rtol=1e-2, atol=1e-2)
    assert abs(residual.sum()) < 1e-2
    assert np.allclose(x.mean(axis=0), 0, atol=1e-9)


def test_cross_validation(spark, snapshots):
    cv = V.cross_validate(snapshots, FEATURES, DEV_CUTOFFS[:5],
                          models=M.model_zoo(FEATURES, SMALL)).toPandas()
    assert set(cv.model) == NAMES and len(cv) == 8 and set(cv.fold) == {1, 2}
    assert cv.pr_auc.between(0, 1).all()
    assert set(zip(cv.fold, cv.n_train, cv.n_valid)) == {(1, 450, 150), (2, 600, 150)}
    summary = V.summarise_cv(spark.createDataFrame(cv)).toPandas()
    want = cv.groupby("model").pr_auc.agg(["mean", "std"]).sort_values("mean", ascending=False)
    assert list(summary.model) == list(want.index)
    np.testing.assert_allclose(summary.pr_auc_std, want["std"].round(4), atol=1e-9)
    missing = V.cross_validate(snapshots, FEATURES, [*DEV_CUTOFFS[:4], "2015-01-01"],
                               models={"rule": M.recency_rule()})
    assert missing.count() == 1


def test_tuning_uses_population_spread(spark, snapshots):
    grid = M.BOOSTING_GRID[:2]
    table = V.tune(snapshots, M.boosting_candidates(FEATURES, grid, 0.005), dict(enumerate(grid)),
                   DEV_CUTOFFS[:5]).toPandas()
    assert set(table.config) == {0, 1} and list(table.pr_auc_mean) == \
        sorted(table.pr_auc_mean, reverse=True)
    assert list(table.sort_values("config").n_estimators) == [300, 600]
    two = spark.createDataFrame([(0, 1, 0.2), (0, 1, 0.4)], "config int, p int, pr_auc double")
    assert V.summarise_tuning(two, ["p"]).first()["pr_auc_std"] == pytest.approx(0.1)


def test_holdout_selection_and_reports(spark, snapshots):
    dev, test = V.split_dev_test(snapshots, DEV_CUTOFFS[:3], DEV_CUTOFFS[3:5])
    assert (dev.count(), test.count()) == (450, 300)
    rules = {"recency_baseline": M.recency_rule(), "often": M.recency_rule("frequency")}
    scored = D.score_all(D.fit_all(rules, dev), test)
    holdout = D.holdout_metrics(scored)
    table = holdout.toPandas()
    assert len(table) == 6 and set(table.split) == {"holdout", "2011-06-01", "2011-07-01"}
    best = D.best_model(holdout).first()["model"]
    pooled = table[table.split == "holdout"].set_index("model")
    assert best == pooled.pr_auc.idxmax()
    lines = {r["metric"]: r for r in D.headline(holdout, "often").collect()}
    assert lines["brier"]["difference"] == pytest.approx(
        pooled.brier["often"] - pooled.brier["recency_baseline"])
    assert lines["accuracy"]["difference"] is None
    months = D.stability(scored).toPandas().sort_values(["model", "cutoff"])
    assert list(months.months_after_training) == [1, 2, 1, 2]
    season = D.seasonality(snapshots, DEV_CUTOFFS[3:5]).toPandas().sort_values("cutoff")
    assert list(season.split) == ["development"] * 3 + ["holdout"] * 2
    assert season.customers.sum() == 750


def test_permutation_moves_only_what_the_model_uses(spark, snapshots):
    table = snapshots.withColumn("label", (D.F.col("recency_days") < 30).cast("int"))
    fitted = M.fit(M.recency_rule(), table)
    drops = {r["feature"]: r for r in D.permutation_table(
        fitted, table, FEATURES, n_repeats=4, features_per_job=1).collect()}
    assert drops["frequency"]["pr_auc_drop"] == 0.0 and drops["frequency"]["std"] == 0.0
    assert drops["recency_days"]["pr_auc_drop"] > 0.4


def test_shuffle_is_a_permutation(spark, snapshots):
    rows = D.row_positions(snapshots, ["customer_id", "cutoff"], 42)
    mixed = D.shuffle_feature(rows, FEATURES, 3, 42).toPandas()
    before = snapshots.toPandas()
    assert len(mixed) == 6 * len(before)
    for (feature, _), copy in mixed.groupby(["feature", "repeat"]):
        assert sorted(copy[feature]) == sorted(before[feature])
        joined = copy.merge(before, on=["customer_id", "cutoff"], suffixes=("", "_before"))
        other = next(f for f in FEATURES if f != feature)
        assert (joined[other] == joined[f"{other}_before"]).all()
        assert (joined[feature] != joined[f"{feature}_before"]).mean() > 0.5


def test_model_store(spark, snapshots, tmp_path):
    fitted = M.fit(M.logistic_regression(FEATURES, SMALL), snapshots)
    path = M.save_model(fitted, "logistic_regression", str(tmp_path))
    again = M.load_model(path)
    assert path.endswith("/logistic_regression") and M.model_features(again) == FEATURES
    a = M.score(fitted, snapshots).toPandas().score
    assert np.allclose(a, M.score(again, snapshots).toPandas().score)


@pytest.mark.parametrize("model", [
    lambda: M.logistic_regression(FEATURES, SMALL), lambda: M.random_forest(FEATURES, SMALL),
    lambda: M.boosted_trees(["recency_days", "mean_gap_days"], SMALL)])
def test_model_as_a_table(spark, snapshots, tmp_path, model):
    """Rows written, read back and scored by an expression give the fitted model's scores."""
    table = snapshots.withColumn(
        "label", ((D.F.col("recency_days") < 40) | (D.F.col("customer_id") % 5 == 0)).cast("int")) \
        .withColumn("mean_gap_days", D.F.when(D.F.col("customer_id") % 3 > 0,
                                              D.F.col("customer_id") % 17).cast("double"))
    fitted = M.fit(model(), table)
    T.model_table(spark, fitted).write.parquet(str(tmp_path / "model"))
    stored = spark.read.schema(T.MODEL_SCHEMA).parquet(str(tmp_path / "model"))
    assert set(T.features_read(stored)) <= {*FEATURES, "mean_gap_days"}
    a = M.score(fitted, table).select("customer_id", "cutoff", "score").toPandas()
    b = T.score_with_table(stored, table).select("customer_id", "cutoff", "score").toPandas()
    both = a.merge(b, on=["customer_id", "cutoff"])
    assert np.allclose(both.score_x, both.score_y, atol=1e-12) and both.score_x.nunique() > 1
    with pytest.raises(ValueError, match="too many"):
        T.margin_column(stored.collect() * T.MOST_NODES)


def test_polished_fit_is_at_the_minimum(spark, snapshots):
    table = snapshots.withColumn("flat", D.F.lit(3.0))
    fitted = M.fit(M.logistic_regression([*FEATURES, "flat"], SMALL), table)
    every = D.F.lit(True)
    rough = T.penalised_gradients(table, {1: (fitted, every), 2: (fitted, D.F.col("label") >= 0)})
    assert {(r["fold"], r["n_train"]) for r in rough.collect()} == {
        (1, table.count()), (2, table.count())}
    rows = {r["feature"]: r for r in T.polished(fitted, table).collect()}
    frame = table.toPandas()
    x = frame[FEATURES].astype(float)
    z = (x - x.mean()) / x.std()
    margin = rows[None]["value"] + sum(rows[f]["value"] * x[f] for f in FEATURES)
    error = 1 / (1 + np.exp(-margin)) - frame.label
    weights = {f: rows[f]["value"] * x[f].std() for f in FEATURES}
    assert abs(error.sum()) < 1e-8 and rows["flat"]["value"] == 0
    assert all(abs((error * z[f]).sum() + weights[f]) < 1e-8 for f in FEATURES)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 13, 57, 100, 101, 997, 1000, 4096, 30_011])
def test_keyed_places_are_a_permutation(spark, n):
    keys = D.round_keys(42, "recency_days", 3)
    place = D.keyed_place(D.F.col("id"), D.F.lit(n).cast("bigint"),
                          [D.F.lit(k).cast("bigint") for k in keys])
    got = [r[0] for r in spark.range(n).select(place).collect()]
    assert sorted(got) == list(range(n))
    if n > 900:
        moved = np.array(got) - np.arange(n)
        assert (moved == 0).mean() < 0.01 and len(np.unique(moved)) > n / 3
        assert got != [r[0] for r in spark.range(n).select(D.keyed_place(
            D.F.col("id"), D.F.lit(n).cast("bigint"),
            [D.F.lit(k).cast("bigint") for k in D.round_keys(42, "recency_days", 4)])).collect()]


def test_keyed_places_of_very_many_rows(spark):
    """Beyond ten billion, and at multiples of the primes that once stood for the factors."""
    keys = [D.F.lit(k).cast("bigint") for k in D.round_keys(1, "x", 0)]
    for n in (899_999_963, 10 ** 10 + 19, 899_999_963 * 13, 4 * 10 ** 18):
        ids = spark.range(20_000).select((D.F.xxhash64("id") % n).alias("id")) \
            .select(D.F.pmod("id", D.F.lit(n)).alias("id")).distinct()
        sent = ids.select(D.keyed_place(D.F.col("id"), D.F.lit(n).cast("bigint"), keys)
                          .alias("p"))
        row = sent.agg(D.F.countDistinct("p").alias("d"), D.F.min("p").alias("a"),
                       D.F.max("p").alias("b"), D.F.avg("p").alias("m")).first()
        assert row["d"] == ids.count() and row["a"] >= 0 and row["b"] < n
        assert 0.47 * n < row["m"] < 0.53 * n


def test_leaf_penalty_moves_scores(spark, snapshots):
    """A large penalty shrinks all scores towards one half; the trees stay the same."""
    table = snapshots.withColumn("label", (D.F.col("recency_days") < 40).cast("int"))
    spread = {}
    for reg_lambda in (0.0, 1e6):
        model = T.PenalisedBoosting(M.boosted_trees(FEATURES, SMALL), reg_lambda, 0.3).fit(table)
        scores = M.score(model, table).toPandas().score
        spread[reg_lambda] = scores.max() - scores.min()
        splits = [(r["tree"], r["node"], r["feature"], r["split"]) for r in model.rows]
        assert spread.setdefault("splits", splits) == splits
    assert spread[0.0] > 0.2 and spread[1e6] < 1e-3


def test_ensembles_of_any_size_are_scored(spark, snapshots, monkeypatch):
    """The grid's deepest configuration has more nodes than one expression may hold."""
    table = snapshots.withColumn("label", (D.F.col("recency_days") < 40).cast("int"))
    model = T.PenalisedBoosting(M.boosted_trees(FEATURES, SMALL), 1.0, 0.3).fit(table)
    keys = ["customer_id", "cutoff"]
    want = M.score(model, table).select(*keys, "score").toPandas().sort_values(keys)
    monkeypatch.setattr(T, "MOST_NODES", len(model.rows) - 1)
    monkeypatch.setattr(T, "PIECE_NODES", max(1, len(model.rows) // 2), raising=False)
    got = M.score(model, table)
    assert got.columns == [*table.columns, "score"]
    got = got.select(*keys, "score").toPandas().sort_values(keys)
    assert list(got.score) == list(want.score) and got.score.nunique() > 1
