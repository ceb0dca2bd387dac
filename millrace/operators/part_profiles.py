"""Profiles of growing tables: one stored row of figures and sketches per part (day) and column, merged for any range.

A part is profiled once, by one pass over its rows alone. Its row per column (and group) holds
counts, mean and squared deviations, smallest and largest value, a quantile sketch (KLL) and a distinct
sketch (HLL). All of them add up, so the profile of a week, a year or the whole table comes from
the stored rows, without the table: counts, means, deviations and extremes are exact, quantiles and
distinct counts are within the sketches' error (about 1.3 % in rank at ``QUANTILE_K``, about 2 % of
the count at ``DISTINCT_K``).

A part profiled again replaces its rows. NaN is missing, like null. Columns that are no
numbers have counts, extremes as text and distinct values only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import nan_as_null

#: Sizes of the sketches: values kept per level, and the binary logarithm of the registers.
QUANTILE_K, DISTINCT_K = 256, 12
FIGURES = (
    "column string, rows long, known long, mean double, squares double, low double, high double, "
    "first string, last string, quantiles binary, distinct binary")


def profile_parts(df: DataFrame, by: str, cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """``by``, ``keys`` and FIGURES: one row per part, group and column, in one pass."""
    keys = keys or []
    clean = nan_as_null(df.select(by, *keys, *cols))
    kinds = {f.name: f.dataType for f in clean.schema.fields}

    def figures(c: str) -> Column:
        number = isinstance(kinds[c], T.NumericType)
        value = F.col(c).cast("double") if number else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if number else F.col(c).cast("string")
        whole = isinstance(kinds[c], (T.IntegralType, T.StringType))
        return F.struct(
            F.lit(c).alias("column"), F.count("*").alias("rows"), F.count(c).alias("known"), F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("squares"), F.min(value).alias("low"), F.max(value).alias("high"),
            F.min(text).alias("first"), F.max(text).alias("last"),
            F.kll_sketch_agg_double(value, F.lit(QUANTILE_K)).alias("quantiles"),
            F.hll_sketch_agg(F.col(c) if whole else F.col(c).cast("string"), F.lit(DISTINCT_K)).alias("distinct"))

    wide = clean.groupBy(by, *keys).agg(*[figures(c).alias(f"_{i}") for i, c in enumerate(cols)])
    return wide.select(by, *keys, F.explode(F.array(*[f"_{i}" for i in range(len(cols))])).alias("f")).select(by, *keys, "f.*")


def add_part(df: DataFrame, path: str, by: str, part, cols: list[str], keys: list[str] | None = None) -> None:
    """Profile the rows of one part into the store at ``path``; only that part of ``df`` is read."""
    own = df.filter(F.col(by) == F.lit(part))
    profile_parts(own, by, cols, keys).coalesce(1).write.partitionBy(by).option(
        "partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def add_missing_parts(df: DataFrame, path: str, by: str, cols: list[str], keys: list[str] | None = None, stored: DataFrame | None = None) -> None:
    """Profile all parts of ``df`` that the store (as read by :func:`read_parts`, or none yet) does not have."""
    new = df if stored is None else df.join(F.broadcast(stored.select(by).distinct()), by, "left_anti")
    profile_parts(new, by, cols, keys).repartition(by).write.partitionBy(by).option(
        "partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_parts(spark: SparkSession, path: str, by: str, kind: str = "date", keys: str = "") -> DataFrame:
    """The stored rows; ``keys`` is the schema text of the groups. A range of parts is a filter on ``by``, which prunes folders."""
    return spark.read.schema(f"{f'{keys}, ' if keys else ''}{FIGURES}, {by} {kind}").parquet(path)


def _merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group and column over all given parts."""
    group = [*keys, "column"]
    known = F.col("known").cast("double")
    # The mean of all parts first, so that squares are moved by small differences.
    middle = F.sum(known * F.coalesce("mean", F.lit(0.0))).over(Window.partitionBy(*group)) / F.nullif(F.sum(known).over(Window.partitionBy(*group)), F.lit(0.0))
    return parts.withColumn("_middle", middle).groupBy(*group).agg(
        F.sum("rows").alias("rows"), F.sum("known").alias("known"),
        F.max(F.when(F.col("mean").isNotNull(), F.col("_middle"))).alias("mean"),
        F.sum(F.col("squares") + known * (F.col("mean") - F.col("_middle")) ** 2).alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"))


def _quantile(p: Column | float) -> Column:
    """Null where the sketch has seen nothing."""
    rank = F.lit(p) if isinstance(p, float) else p
    return F.when(F.kll_sketch_get_n_double("quantiles") > 0, F.kll_sketch_get_quantile_double("quantiles", rank))


def describe_parts(parts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Profile of all given parts: rows, known, missing, mean, sample std, extremes, quartiles and distinct values per column."""
    keys = keys or []
    quartiles = {n: _quantile(p).alias(n) for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    return _merged(parts, keys).select(
        *keys, "column", "rows", "known", (F.col("rows") - F.col("known")).alias("missing"), "mean",
        F.sqrt(F.col("squares") / F.nullif(F.col("known") - 1, F.lit(0))).alias("std"), "low", "high", "first", "last",
        *quartiles.values(), F.hll_sketch_estimate("distinct").alias("n_distinct"))


def box_parts(parts: DataFrame, c: str, keys: list[str] | None = None) -> DataFrame:
    """Box-plot numbers of one column over all given parts: quartiles, fences at 1.5 IQR, and about how many values lie beyond.

    The extremes are exact; without any value outside, the fences stop at them.
    """
    keys = keys or []
    box = _merged(parts.filter(F.col("column") == c), keys).filter("known > 0").select(
        *keys, "known", "low", "high", "quantiles", *[_quantile(p).alias(n) for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fenced = box.withColumns({"fence_low": F.greatest("low", F.col("q1") - reach), "fence_high": F.least("high", F.col("q3") + reach)})
    # The sketch answers ranks for given numbers only, so the fences are placed among its per mille.
    steps = 1000
    every = F.kll_sketch_get_quantile_double("quantiles", F.array(*[F.lit((i + 0.5) / steps) for i in range(steps)]))
    outside = F.size(F.filter(every, lambda v: (v < F.col("fence_low")) | (v > F.col("fence_high"))))
    return fenced.select(*keys, "low", "q1", "median", "q3", "high", "fence_low", "fence_high",
                         F.round(outside * F.col("known") / steps).cast("long").alias("outliers"))
