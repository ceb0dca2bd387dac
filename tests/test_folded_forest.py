"""Forests on many rows are fitted on weighted groups that hold every row."""

import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from millrace.operators import features as FE
from millrace.operators import metrics as E
from millrace.operators import models as M


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(20_000).select(
        "id", ((F.col("id") * 7919) % 50).cast("double").alias("a"), ((F.col("id") * 104729) % 7).cast("double").alias("b"),
        ((F.col("id") * 31) % 9973 / 7).alias("c"))
    return df.withColumn("y", 2 * F.col("a") + F.col("b")).withColumn("label", (F.col("a") + 3 * F.col("b") > 40).cast("int"))


def packed(df, label, cols=("a", "b")):
    return FE.finalise(FE.assemble(df, list(cols)), label, keep=["id"])


def test_groups_hold_every_row(rows, monkeypatch):
    assert M.fold(packed(rows, "label"), True) is None
    monkeypatch.setattr(M, "FOLD_ROWS", 2_000)
    for classes, label in ((True, "label"), (False, "y")):
        train = packed(rows, label)
        got = M.fold(train, classes)
        n, total, labels = got.agg(F.count("*"), F.sum("weight"), F.sum(F.col("weight") * F.col("label"))).first()
        assert n <= 2_200 and total == 20_000 and labels == pytest.approx(train.agg(F.sum("label")).first()[0])
        # Features of few values stay as they are, each with its rows.
        assert {tuple(r.features): r.w for r in got.groupBy("features").agg(F.sum("weight").alias("w")).collect()} == {
            tuple(r.features): r.w for r in train.groupBy("features").agg(F.count("*").alias("w")).collect()}
    # Nothing to gain where cells hold few rows each.
    assert M.fold(packed(rows, "label", ("a", "b", "c")), True) is None


def test_forests_on_groups_learn(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "FOLD_ROWS", 2_000)
    seen, fold = [], M.fold
    monkeypatch.setattr(M, "fold", lambda *a: seen.append(fold(*a)) or seen[-1])
    train, test = FE.split(packed(rows, "label"), ["id"], 0.8)
    assert E.accuracy(M.fit_forest(train, trees=10, depth=8).transform(test)).first().accuracy > 0.97
    train, test = FE.split(packed(rows, "y"), ["id"], 0.8)
    est, grid = RandomForestRegressor(seed=42), {"numTrees": [3, 6], "maxDepth": [2, 6]}
    tuned = M.tune_tvs(est, grid, train)
    best = M.tuning_table(spark, tuned, grid, est).orderBy("metric").first()
    assert best.maxDepth == 6 and tuned.bestModel.getOrDefault("maxDepth") == 6
    assert E.rmse(tuned.bestModel.transform(test)).first().rmse < 12
    # One fold for all of the grid, one for the last fit.
    assert len(seen) == 3 and all(s is not None and s.count() <= 2_200 for s in seen)
