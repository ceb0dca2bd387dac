"""Queries: MLlib training, tuning, scoring (M-12, M-14 to M-21, M-24, M-25, J-06).

A fitted model has no SQL counterpart. So each query returns what SQL can know of
its result: the exact test rows, the figure a useless model would reach (share of
the larger class, deviation of the label) and whether the fitted model beats it.
The label of the classifiers is planted, so all rows far from its border must come
out right, and SQL counts them.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import features as FE
from millrace.operators import metrics as E
from millrace.operators import models as M
from millrace.operators.relational import score_batch
from millrace.plans.q_features import LINE_HASH, SPLIT, _features
from millrace.plans.registry import query
from millrace.plans.views import KEY, TX, planted
from millrace.session import scratch_path

LABEL_FEATURES = ["l_quantity", "line", "l_extendedprice", "l_discount"]


def _labelled(spark, sf):
    """Train and test rows of the planted label."""
    df = planted(spark, sf)
    train, test = FE.split(df, KEY, 0.8)
    pack = lambda d: FE.finalise(FE.assemble(d, LABEL_FEATURES), "label", keep=KEY)
    return pack(train), pack(test)


TEST_ROWS = f"NOT {LINE_HASH} < 3435973836"

# Rows further than this from the planted border (40) have to be predicted right.
MARGIN = 15
CLEAR = f"abs(l_quantity + 3 * l_linenumber - 40) > {MARGIN}"


def _clear(features="features"):
    v = vector_to_array(features)
    return F.abs(v[0] + 3 * v[1] - 40) > MARGIN


OUTCOME_SQL = f"""
WITH c AS (SELECT CASE WHEN l_quantity + 3 * l_linenumber > 40 THEN 1 ELSE 0 END AS label, count(*) AS n, count(*) FILTER ({CLEAR}) AS clear_right
  FROM lineitem WHERE {TEST_ROWS} GROUP BY 1)
SELECT label, n, clear_right, round(max(n) OVER () / sum(n) OVER (), 4) AS majority, true AS beats_majority FROM c"""


def _outcome(model, test):
    """Per class: test rows, right ones among those far from the border, and whether all in all the larger class is beaten."""
    pred = model.transform(test)
    right = F.col("prediction") == F.col("label")
    every = Window.partitionBy(F.lit(0))
    return (
        pred.groupBy(F.col("label").cast("int").alias("label"))
        .agg(F.count("*").alias("n"), F.count_if(_clear() & right).alias("clear_right"), F.count_if(right).alias("right"))
        .select("label", "n", "clear_right",
                F.round(F.max("n").over(every) / F.sum("n").over(every), 4).alias("majority"),
                (F.sum("right").over(every) > F.max("n").over(every)).alias("beats_majority")))


@query("m_12_logistic_regression", OUTCOME_SQL)
def m_12(spark, sf):
    train, test = _labelled(spark, sf)
    weighted = FE.with_class_weight(train, "label")
    return _outcome(M.fit_logreg(weighted, weight="weight"), test)


@query("m_14_decision_tree", OUTCOME_SQL)
def m_14(spark, sf):
    train, test = _labelled(spark, sf)
    return _outcome(M.fit_tree(train), test)


@query("m_15_random_forest", OUTCOME_SQL)
def m_15(spark, sf):
    train, test = _labelled(spark, sf)
    return _outcome(M.fit_forest(train, trees=100, depth=10), test)


def _fares(spark, sf):
    return FE.split(_features(spark, sf), ["trip_id"], 0.8)


# Rows and label deviation of the test trips, and of the training trips.
FARE_TEST = f"{TX}, dev AS (SELECT count(*) AS n, round(stddev_pop(fare), 4) AS label_dev FROM tx WHERE distance IS NOT NULL AND NOT {SPLIT} < 3435973836)"
FARE_TRAIN = f"{TX}, dev AS (SELECT count(*) AS n, round(stddev_pop(fare), 4) AS label_dev FROM tx WHERE distance IS NOT NULL AND {SPLIT} < 3435973836)"


def _fit_row(error, rows):
    """One row: number of rows, deviation of their label, and whether ``error`` is below half of it."""
    return rows.agg(
        F.count("*").alias("n"), F.round(F.stddev_pop("label"), 4).alias("label_dev"),
        (F.lit(error) < F.stddev_pop("label") / 2).alias("below_half"))


def _dev(rows) -> float:
    return rows.agg(F.stddev_pop("label")).first()[0]


@query("m_16_random_forest_regressor", f"WITH {FARE_TEST} SELECT n, label_dev, true AS below_half FROM dev")
def m_16(spark, sf):
    train, test = _fares(spark, sf)
    return _fit_row(E.rmse(M.fit_forest_reg(train).transform(test)).first().rmse, test)


def _grid_sql(trees: list[int], depths: list[int]) -> str:
    return f"""
WITH {FARE_TRAIN}
SELECT (row_number() OVER (ORDER BY t, d) - 1)::INTEGER AS combination, t::INTEGER AS "numTrees", d::INTEGER AS "maxDepth", label_dev, true AS beats_mean
FROM (SELECT unnest({trees}) AS t), (SELECT unnest({depths}) AS d), dev"""


def _grid_rows(tuned, train):
    """The combinations of a search, and whether each one's error is below the deviation of the training label."""
    dev = _dev(train)
    return tuned.select(
        "combination", "numTrees", "maxDepth", F.round(F.lit(dev), 4).alias("label_dev"), (F.col("metric") < dev).alias("beats_mean"))


GRID = {"numTrees": [20, 50], "maxDepth": [5, 10]}
CV_GRID = {"numTrees": [10, 20], "maxDepth": [3, 5]}


@query("m_17_train_validation_split", _grid_sql(*GRID.values()))
def m_17(spark, sf):
    train, _ = _fares(spark, sf)
    est = RandomForestRegressor(seed=42)
    return _grid_rows(M.tuning_table(spark, M.tune_tvs(est, GRID, train), GRID, est), train)


@query("m_18_cross_validation", _grid_sql(*CV_GRID.values()))
def m_18(spark, sf):
    train, _ = _fares(spark, sf)
    est = RandomForestRegressor(seed=42)
    return _grid_rows(M.tuning_table(spark, M.tune_cv(est, CV_GRID, train), CV_GRID, est), train)


SPACE = {"numTrees": (10, 30, 10), "maxDepth": (3, 5, 1)}


def _trials(spark, train, test):
    def objective(params):
        model = RandomForestRegressor(seed=42, **params).fit(train)
        return M.rmse_evaluator().evaluate(model.transform(test))

    with M.cached(train) as train, M.cached(test) as test:
        return M.search(spark, objective, SPACE, trials=5)


@query("m_19_trial_search", f"""
WITH {FARE_TEST} SELECT t::INTEGER AS trial, true AS in_space, label_dev, true AS beats_mean FROM range(5) r(t), dev""")
def m_19(spark, sf):
    train, test = _fares(spark, sf)
    dev = _dev(test)
    inside = F.lit(True)
    for name, (low, high, step) in SPACE.items():
        inside &= F.col(name).between(low, high) & ((F.col(name) - low) % step == 0)
    return _trials(spark, train, test).select(
        "trial", inside.alias("in_space"), F.round(F.lit(dev), 4).alias("label_dev"), (F.col("rmse") < dev).alias("beats_mean"))


@query("m_19_halving", f"""
WITH {FARE_TEST} SELECT r::INTEGER AS round, CASE r WHEN 0 THEN 0.3333 ELSE 1.0 END::DOUBLE AS fraction, CASE r WHEN 0 THEN 9 ELSE 3 END::BIGINT AS trials,
  CASE r WHEN 0 THEN 3 ELSE 1 END::BIGINT AS kept, label_dev, true AS beat_mean FROM range(2) t(r), dev""")
def m_19_halving(spark, sf):
    """Nine trials on a third of the rows, the best three on all; rounds, and whether every error is below the label's deviation."""
    train, test = _fares(spark, sf)
    dev = _dev(test)

    def objective(params, rows):
        return M.rmse_evaluator().evaluate(RandomForestRegressor(seed=42, **params).fit(rows).transform(held))

    with M.cached(test) as held:
        found = M.halving_search(train, ["trip_id"], objective, SPACE)
    return found.groupBy("round").agg(
        F.round(F.max("fraction"), 4).alias("fraction"), F.count("*").alias("trials"), F.count_if("kept").alias("kept"),
        F.round(F.lit(dev), 4).alias("label_dev"), F.every(F.col("rmse") < dev).alias("beat_mean"))


@query("m_20_refit", f"WITH {FARE_TEST} SELECT n, label_dev, true AS below_half, true AS best_params FROM dev")
def m_20(spark, sf):
    """The refit model on the test rows, and whether its parameters are those of the trial with the least error."""
    train, test = _fares(spark, sf)
    trials = _trials(spark, train, test)
    model = M.refit(RandomForestRegressor(seed=42), trials, list(SPACE), train)
    best = min(trials.collect(), key=lambda r: (r.rmse, r.trial))
    same = (model.getNumTrees, model.getOrDefault("maxDepth")) == (best.numTrees, best.maxDepth)
    return _fit_row(E.rmse(model.transform(test)).first().rmse, test).withColumn("best_params", F.lit(same))


# By SQL, the most telling feature is the one with the largest correlation with the label.
@query("m_21_importances", f"""
WITH t AS (SELECT *, CASE WHEN l_quantity + 3 * l_linenumber > 40 THEN 1 ELSE 0 END AS label FROM lineitem WHERE NOT ({TEST_ROWS})),
c AS (SELECT unnest([{', '.join(f"'{f}'" for f in LABEL_FEATURES)}]) AS feature, unnest([
  abs(corr(l_quantity, label)), abs(corr(l_linenumber, label)), abs(corr(l_extendedprice, label)), abs(corr(l_discount, label))]) AS r FROM t)
SELECT arg_max(feature, r) AS top, count(*) AS features, true AS sums_to_one FROM c""")
def m_21(spark, sf):
    train, _ = _labelled(spark, sf)
    found = M.importances(spark, M.fit_forest(train, trees=20, depth=5), LABEL_FEATURES)
    return found.agg(
        F.max_by("feature", "importance").alias("top"), F.count("*").alias("features"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))


@query("m_24_save_load", f"""
WITH {TX} SELECT count(*) AS n, 0::BIGINT AS different FROM tx WHERE distance IS NOT NULL AND NOT {SPLIT} < 3435973836""")
def m_24(spark, sf):
    train, test = _fares(spark, sf)
    model = M.fit_forest_reg(train, trees=5, depth=5)
    path = scratch_path(spark, "model")
    M.save_model(model, path)
    a = model.transform(test).select("trip_id", F.col("prediction").alias("before"))
    b = M.load_model(path).transform(test).select("trip_id", F.col("prediction").alias("after"))
    return a.join(b, "trip_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("before") != F.col("after")).alias("different"))


def _one_per_key(spark, sf):
    """Labelled line items; of rows that share a key, the one with the largest quantity."""
    row = F.max(F.struct(*LABEL_FEATURES, "label")).alias("row")
    return planted(spark, sf).groupBy(*KEY).agg(row).select(*KEY, "row.*")


UNIQUE_TEST = f"(SELECT {', '.join(KEY)}, max(l_quantity) AS l_quantity FROM lineitem WHERE {TEST_ROWS} GROUP BY ALL)"


@query("m_25_score", f"""
SELECT count(*) AS n, 0::BIGINT AS different, count(*) FILTER ({CLEAR}) AS clear_right FROM {UNIQUE_TEST}""")
def m_25(spark, sf):
    """Scores by the fitted model itself and by the broadcast-coefficients function, compared with each other and the label."""
    train, _ = _labelled(spark, sf)
    model = M.fit_logreg(train)
    _, test = FE.split(_one_per_key(spark, sf), KEY, 0.8)
    rows = FE.assemble(test, LABEL_FEATURES)
    by_model = M.score(rows, model, [*KEY, "label", "features"], probability=True).withColumnRenamed("prediction", "by_model")
    udf = M.linear_score_udf(model, spark)
    by_function = test.select(*KEY, udf(F.struct(*LABEL_FEATURES)).alias("by_function"))
    return by_model.join(by_function, KEY).agg(
        F.count("*").alias("n"), F.count_if(F.col("by_model") != F.col("by_function")).alias("different"),
        F.count_if(_clear() & (F.col("by_function") == F.col("label"))).alias("clear_right"))


@query("j_06_score_batch", f"""
SELECT count(*) AS n, 0::BIGINT AS unscored, count(*) FILTER ({CLEAR}) AS clear_right FROM {UNIQUE_TEST}""")
def j_06(spark, sf):
    train, _ = _labelled(spark, sf)
    model = M.fit_tree(train)
    rows = _one_per_key(spark, sf)
    _, test = FE.split(rows, KEY, 0.8)
    lookup = FE.assemble(rows, LABEL_FEATURES)
    scored = score_batch(model, test.select(*KEY, F.col("label").alias("truth")), [(lookup, KEY, ["features"])])
    return scored.agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction").isNull()).alias("unscored"),
        F.count_if(_clear() & (F.col("prediction") == F.col("truth"))).alias("clear_right"))
