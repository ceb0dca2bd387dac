"""Distributed model training, tuning, scoring and run tables on MLlib."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import hash_below
from millrace.operators.relational import upsert
from millrace.operators.reshape import best, latest
from millrace.session import materialize


#: Rows of a partition of training data. A forest keeps some hundred bytes a row besides.
PARTITION_ROWS = 1 << 18


@contextmanager
def cached(df: DataFrame):
    """Keep training data over an iterative fit, spilling to disk.

    Data that came in fewer partitions than there are cores, or in one of more than
    PARTITION_ROWS rows, is spread before it is kept, so that every pass of the fit uses the whole cluster and
    what a task reads does not grow with the input: no task keeps, or reads again, all that one file split gives.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("at")).count().collect()]
    if len(sizes) < cores or max(sizes) > PARTITION_ROWS:
        df = df.repartition(max(cores, math.ceil(2 * sum(sizes) / PARTITION_ROWS)))
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


#: Groups that a forest is fitted on where there are over twice as many rows; sampled rows for their bounds, features at most.
FOLD_ROWS, FOLD_SAMPLE, FOLD_WIDTH = 1 << 20, 1 << 15, 64


def _levels(values: np.ndarray, most: int) -> list[float]:
    """Splits of a feature: between all sampled values where there are up to ``most``, else that many quantiles."""
    known = np.unique(values)
    if len(known) == 1:
        inner = [known[0], np.nextafter(known[0], np.inf)]
    elif len(known) <= most:
        inner = (known[1:] + known[:-1]) / 2
    else:
        inner = np.quantile(values, np.arange(1, most) / most)
    return [-np.inf, *map(float, np.unique(inner)), np.inf]


def fold(data: DataFrame, classes: bool, levels: int = 128) -> DataFrame | None:
    """Training rows (features, label) as weighted groups of nearly equal rows; None where that does not pay.

    Rows go together that lie in the same of ``levels`` quantiles of every feature (the same value, where a
    feature has no more values) and, with ``classes``, have one label. Groups hold the means of their
    rows and their number as ``weight``, so every row counts; large groups are dealt out by row hash until
    there are about FOLD_ROWS. Where a feature has few values, sums and counts of every node of a tree stay what they were; elsewhere
    a value moves inside its quantile, a quarter of a forest's default bin. A forest then draws
    groups, not rows, for its trees.
    """
    rows = data.count()
    if rows <= 2 * FOLD_ROWS or data.select("features").first()[0].size > FOLD_WIDTH:
        return None
    other = [f.name for f in data.schema.fields if f.name != "features"]
    flat = data.select(*other, vector_to_array("features").alias("_x"))
    drawn = F.pmod(F.xxhash64("_x", *other, F.lit(7)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, FOLD_SAMPLE / rows)))
    found = flat.filter(drawn).select("_x").limit(2 * FOLD_SAMPLE).toArrow().column("_x").combine_chunks()
    if not len(found):
        return None
    x = found.flatten().to_numpy().reshape(len(found), -1)
    width, names = x.shape[1], [f"_f{i}" for i in range(x.shape[1])]
    if not np.isfinite(x).all():
        return None
    cut = Bucketizer(
        inputCols=names, outputCols=[f"_b{n}" for n in names], splitsArray=[_levels(x[:, i], levels) for i in range(width)], handleInvalid="keep")
    in_cell = [*cut.getOutputCols(), *(["label"] if classes else [])]
    wide = cut.transform(flat.select("*", *[F.col("_x")[i].alias(n) for i, n in enumerate(names)])).withColumn("_cell", F.xxhash64(*in_cell))
    cells = wide.agg(F.approx_count_distinct("_cell")).first()[0]
    if 4 * cells > rows:
        return None
    deal = F.pmod(F.xxhash64("_x", *other), F.lit(max(1, FOLD_ROWS // cells)))
    cores = data.sparkSession.sparkContext.defaultParallelism
    groups = wide.groupBy(*(["label"] if classes else []), "_cell", deal.alias("_part")).agg(
        *[F.avg(n).alias(n) for n in names], *([] if classes else [F.avg("label").alias("label")]), F.count("*").cast("double").alias("weight"))
    return materialize(groups.select(array_to_vector(F.array(*names)).alias("features"), "label", "weight").repartition(2 * cores), "folded")


class FoldedForest(Estimator):
    """A forest estimator that is fitted on the groups of :func:`fold`; a search over its parameters folds once."""

    def __init__(self, est):
        super().__init__()
        self.est = est

    def copy(self, extra=None):
        return FoldedForest(self.est.copy(extra or {}))

    def _on(self, dataset: DataFrame):
        if not isinstance(self.est, (RandomForestClassifier, RandomForestRegressor)) or self.est.isSet("weightCol"):
            return self.est, dataset
        groups = fold(dataset, isinstance(self.est, RandomForestClassifier))
        return (self.est, dataset) if groups is None else (self.est.copy().setWeightCol("weight"), groups)

    def _fit(self, dataset):
        est, rows = self._on(dataset)
        return est.fit(rows)

    def fitMultiple(self, dataset, paramMaps):
        est, rows = self._on(dataset)
        return est.fitMultiple(rows, paramMaps)


def fit_logreg(train: DataFrame, rows: int | None = None, c: float = 1.0, weight: str | None = None, max_iter: int = 100):
    """Logistic regression with L2 strength 1 / (c × rows)."""
    with cached(train) as data:
        est = LogisticRegression(maxIter=max_iter, regParam=1.0 / (c * (rows or data.count())))
        return (est.setWeightCol(weight) if weight else est).fit(data)


def fit_tree(train: DataFrame, depth: int = 5, seed: int = 42):
    with cached(train) as data:
        return DecisionTreeClassifier(maxDepth=depth, seed=seed).fit(data)


def fit_forest(train: DataFrame, trees: int = 100, depth: int | None = 10, seed: int = 42):
    """Random forest classifier; an unlimited depth means the supported maximum of 30."""
    with cached(train) as data:
        return FoldedForest(RandomForestClassifier(numTrees=trees, maxDepth=depth or 30, seed=seed)).fit(data)


def fit_forest_reg(train: DataFrame, trees: int = 20, depth: int = 8, seed: int = 42):
    with cached(train) as data:
        return FoldedForest(RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed)).fit(data)


def rmse_evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")


def param_grid(est, grid: dict[str, list]) -> list:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), values)
    return builder.build()


def tune_tvs(est, grid: dict[str, list], train: DataFrame, evaluator=None, ratio: float = 0.8, seed: int = 42, parallelism: int = 2):
    """Grid search on one train/validation split; the fits run side by side."""
    with cached(train) as data:
        return TrainValidationSplit(
            estimator=FoldedForest(est), estimatorParamMaps=param_grid(est, grid), evaluator=evaluator or rmse_evaluator(),
            trainRatio=ratio, seed=seed, parallelism=parallelism).fit(data)


def tune_cv(est, grid: dict[str, list], train: DataFrame, evaluator=None, folds: int = 3, seed: int = 42, parallelism: int = 2):
    """Grid search by k-fold cross-validation."""
    with cached(train) as data:
        return CrossValidator(
            estimator=FoldedForest(est), estimatorParamMaps=param_grid(est, grid), evaluator=evaluator or rmse_evaluator(),
            numFolds=folds, seed=seed, parallelism=parallelism).fit(data)


def tuning_table(spark: SparkSession, model, grid: dict[str, list], est) -> DataFrame:
    """(combination, metric, one column per parameter) of a fitted search."""
    metrics = getattr(model, "validationMetrics", None) or model.avgMetrics
    maps = param_grid(est, grid)
    rows = [
        (i, float(m), *[int(pm[est.getParam(n)]) for n in grid]) for i, (m, pm) in enumerate(zip(metrics, maps))]
    return spark.createDataFrame(
        rows, "combination int, metric double, " + ", ".join(f"{n} int" for n in grid))


def _drawn(space: dict[str, tuple[int, int, int]], trials: int, seed: int) -> list[dict]:
    rng = random.Random(seed)
    return [{n: rng.randrange(lo, hi + 1, step) for n, (lo, hi, step) in space.items()} for _ in range(trials)]


def search(
    spark: SparkSession, objective: Callable[[dict], float], space: dict[str, tuple[int, int, int]],
    trials: int = 5, seed: int = 42,
) -> DataFrame:
    """Seeded random search over integer ranges (low, high, step): one row per trial, best metric first.

    The trials run one after the other; every objective call is a distributed fit.
    """
    rows = [(t, float(objective(params)), *params.values()) for t, params in enumerate(_drawn(space, trials, seed))]
    schema = "trial int, rmse double, " + ", ".join(f"{n} int" for n in space)
    return spark.createDataFrame(rows, schema).orderBy("rmse", "trial")


def halving_search(
    train: DataFrame, keys: list[str], objective: Callable[[dict, DataFrame], float], space: dict[str, tuple[int, int, int]],
    trials: int = 9, eta: int = 3, seed: int = 42, parallelism: int = 2,
) -> DataFrame:
    """Successive halving: all trials on a small sample, the best of each round on ``eta`` times its rows, the last ones on all.

    The rounds follow from the number of trials: each keeps the best 1 / eta of its trials, and the
    last one, with eta trials at most, has all rows. Samples are by hash of the keys with one
    threshold, so each holds the one before it, and the result does not depend on how rows lie or on which trial
    ends first. ``objective(params, rows)`` fits on the rows and gives the error; the trials
    of a round run side by side. Trials of equal parameters are fitted once.

    One row per trial and round: ``trial``, ``round``, ``fraction``, ``rmse``, the parameters, and ``kept``
    (goes on; in the last round, is the best).
    """
    drawn, rounds, left = _drawn(space, trials, seed), [], trials
    while left > eta:
        rounds.append(left)
        left = math.ceil(left / eta)
    rounds.append(left)
    alive, rows = list(range(trials)), []
    for number, size in enumerate(rounds):
        fraction = float(eta) ** (number + 1 - len(rounds))
        sample = train if fraction == 1 else train.filter(hash_below(fraction, *keys, seed=seed))
        different = list({tuple(drawn[t].values()): drawn[t] for t in alive}.values())
        with cached(sample) as data, ThreadPoolExecutor(parallelism) as pool:
            run = inheritable_thread_target(train.sparkSession)(lambda params: float(objective(params, data)))
            errors = dict(zip((tuple(p.values()) for p in different), pool.map(run, different)))
        order = sorted(alive, key=lambda t: (errors[tuple(drawn[t].values())], t))
        going = set(order[: rounds[number + 1] if number + 1 < len(rounds) else 1])
        rows += [(t, number, fraction, errors[tuple(drawn[t].values())], *drawn[t].values(), t in going) for t in alive]
        alive = sorted(going)
    schema = "trial int, round int, fraction double, rmse double, " + ", ".join(f"{n} int" for n in space) + ", kept boolean"
    return train.sparkSession.createDataFrame(rows, schema).orderBy(F.desc("round"), "rmse", "trial")


def refit(est, trials: DataFrame, params: list[str], train: DataFrame):
    """Fit the estimator on all training rows with the parameters of the best trial."""
    row = trials.orderBy("rmse", "trial").first()
    chosen = {est.getParam(p): row[p] for p in params}
    with cached(train) as data:
        return est.copy(chosen).fit(data)


def importances(spark: SparkSession, model, names: list[str], n: int | None = None) -> DataFrame:
    """(feature, importance), most important first."""
    rows = list(zip(names, map(float, model.featureImportances.toArray())))
    out = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return out.limit(n) if n else out


def leaderboard(runs: DataFrame, metric: str = "accuracy", *ties: str) -> DataFrame:
    """Runs by falling metric."""
    return runs.orderBy(F.desc(metric), *ties)


def promote(aliases: DataFrame, name: str, version: int, alias: str = "champion") -> DataFrame:
    """The alias table with (name, alias) pointing at ``version``."""
    spark = aliases.sparkSession
    change = spark.range(1).select(
        F.lit(name).alias("name"), F.lit(alias).alias("alias"), F.lit(version).cast("long").alias("version"))
    return upsert(aliases, change, ["name", "alias"])


def promote_best(aliases: DataFrame, runs: DataFrame, metric: str, alias: str = "champion") -> DataFrame:
    """The alias table with ``alias`` of every name pointing at its best version."""
    change = best(runs, metric, "version", by=["name"]).select("name", F.lit(alias).alias("alias"), "version")
    return upsert(aliases, change, ["name", "alias"])


def resolve(aliases: DataFrame, runs: DataFrame, alias: str = "champion") -> DataFrame:
    """The run every alias points at; a name without alias resolves to its latest version."""
    named = aliases.filter(F.col("alias") == alias).select("name", F.col("version").alias("_v"))
    newest = latest(runs, "name", "version").select("name", F.col("version").alias("_latest"))
    wanted = newest.join(named, "name", "left").select("name", F.coalesce("_v", "_latest").alias("version"))
    return runs.join(wanted, ["name", "version"])


def save_model(model, path: str) -> None:
    """Save a fitted model or pipeline to a folder, replacing what is there."""
    (model if isinstance(model, PipelineModel) else PipelineModel([model])).write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(df: DataFrame, model, keep: list[str], probability: bool = False) -> DataFrame:
    """Apply a fitted model on the executors; the key columns, the prediction, and on request its probability."""
    out = model.transform(df)
    cols = [F.col(c) for c in keep] + [F.col("prediction")]
    if probability:
        cols.append(vector_to_array("probability")[1].alias("score"))
    return out.select(*cols)


def linear_score_udf(model, spark: SparkSession):
    """A fitted binary linear model as a column function over ``struct(*features)``.

    Only its few coefficients are broadcast; rows travel in Arrow batches.
    """
    shared = spark.sparkContext.broadcast(
        (model.coefficients.toArray(), float(model.intercept), float(model.getThreshold())))

    def predict(frame: pd.DataFrame) -> pd.Series:
        w, b, threshold = shared.value
        p = 1.0 / (1.0 + np.exp(-(frame.to_numpy(dtype=float) @ w + b)))
        return pd.Series((p > threshold).astype(float))

    return F.pandas_udf(predict, "double")
