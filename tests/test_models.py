"""Fitted models learn planted labels, and survive saving."""

import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from millrace.operators import features as FE
from millrace.operators import metrics as E
from millrace.operators import models as M
from millrace.operators.relational import score_batch
from millrace.session import scratch_path


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(3000).select(
        "id", ((F.col("id") * 7919) % 50).cast("double").alias("a"), ((F.col("id") * 104729) % 7).cast("double").alias("b"))
    df = df.withColumn("label", (F.col("a") + 3 * F.col("b") > 40).cast("int"))
    train, test = FE.split(df, ["id"], 0.8)
    pack = lambda d: FE.finalise(FE.assemble(d, ["a", "b"]), "label", keep=["id"])
    return df, pack(train), pack(test)


def share_right(model, test):
    return E.accuracy(model.transform(test)).first().accuracy


def test_classifiers_learn(data):
    _, train, test = data
    weighted = FE.with_class_weight(train, "label")
    for model in (M.fit_logreg(weighted, weight="weight", max_iter=30), M.fit_tree(train), M.fit_forest(train, trees=10, depth=6)):
        assert share_right(model, test) > 0.9


def test_fitting_leaves_nothing_cached(data):
    _, train, _ = data
    M.fit_tree(train)
    assert not train.storageLevel.useMemory


def test_regression_tuning_and_refit(spark, data):
    df, _, _ = data
    df = df.withColumn("y", 2 * F.col("a") + F.col("b"))
    train, test = FE.split(FE.finalise(FE.assemble(df, ["a", "b"]), "y", keep=["id"]), ["id"], 0.8)
    est, grid = RandomForestRegressor(seed=42), {"numTrees": [3, 6], "maxDepth": [2, 6]}
    table = M.tuning_table(spark, M.tune_tvs(est, grid, train), grid, est)
    best = table.orderBy("metric").first()
    assert table.count() == 4 and best.maxDepth == 6
    trials = M.search(spark, lambda p: abs(p["maxDepth"] - 4), {"maxDepth": (3, 5, 1)}, trials=6)
    assert trials.count() == 6 and trials.first().rmse == min(r.rmse for r in trials.collect())
    model = M.refit(est, trials, ["maxDepth"], train)
    assert model.getOrDefault("maxDepth") == trials.first().maxDepth
    assert [r.feature for r in M.importances(spark, model, ["a", "b"], 1).collect()] == ["a"]
    path = scratch_path(spark, "model")
    M.save_model(model, path)
    again = M.load_model(path).transform(test)
    assert E.rmse(again).first() == E.rmse(model.transform(test)).first()


def test_halving_finds_the_best_trial_on_few_rows(spark, data):
    df = data[0].withColumn("y", 2 * F.col("a") + F.col("b"))
    train, test = FE.split(FE.finalise(FE.assemble(df, ["a", "b"]), "y", keep=["id"]), ["id"], 0.8)
    space, seen = {"maxDepth": (1, 8, 1)}, []

    def objective(params, rows):
        seen.append((params["maxDepth"], frozenset(r.id for r in rows.select("id").collect())))
        model = RandomForestRegressor(seed=42, numTrees=4, **params).fit(rows)
        return M.rmse_evaluator().evaluate(model.transform(test))

    found = M.halving_search(train, ["id"], objective, space, trials=12)
    rows, fitted, seen[:] = found.collect(), list(seen), []
    assert [sum(r.round == n for r in rows) for n in (0, 1, 2)] == [12, 4, 2]
    assert [sorted({r.fraction for r in rows if r.round == n}) for n in (0, 1, 2)] == [[pytest.approx(1 / 9)], [pytest.approx(1 / 3)], [1.0]]
    samples = sorted({s for _, s in fitted}, key=len)
    assert len(samples) == 3 and samples[0] < samples[1] < samples[2] and len(samples[2]) == train.count()
    full = M.search(spark, lambda p: objective(p, train), space, trials=12).first()
    assert (rows[0].maxDepth, rows[0].rmse, rows[0].kept) == (full.maxDepth, pytest.approx(full.rmse), True)
    assert sum(len(s) for _, s in fitted) < 0.6 * sum(len(s) for _, s in seen)
    again = M.halving_search(train.repartition(7), ["id"], objective, space, trials=12, parallelism=1).collect()
    assert [(r.trial, r.round, r.kept) for r in again] == [(r.trial, r.round, r.kept) for r in rows]
    model = M.refit(RandomForestRegressor(seed=42, numTrees=4), found.filter("fraction = 1"), ["maxDepth"], train)
    assert model.getOrDefault("maxDepth") == full.maxDepth


def test_scoring_paths_agree(spark, data):
    df, train, test = data
    model = M.fit_logreg(train, max_iter=20)
    by_model = M.score(test, model, ["id"], probability=True)
    udf = M.linear_score_udf(model, spark)
    by_function = df.select("id", udf(F.struct("a", "b")).alias("f"))
    both = by_model.join(by_function, "id")
    assert both.count() == test.count() and both.filter("prediction <> f").count() == 0
    lookup = FE.assemble(df, ["a", "b"]).select("id", "features")
    scored = score_batch(model, test.select("id"), [(lookup, ["id"], ["features"])])
    assert scored.join(by_model.select("id", F.col("prediction").alias("p")), "id").filter("prediction <> p").count() == 0
