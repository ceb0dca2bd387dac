"""Order, top-k, set operations, windows over periods, and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import month_no, pct_change, trend_label
from millrace.operators.profile import WIDE, corr_with, domains, top_variance
from millrace.operators.ranking import label_codes
from millrace.session import materialize


def sort_by_month(df: DataFrame, c: str) -> DataFrame:
    """Calendar order of English month names; adds ``month_no``."""
    return df.withColumn("month_no", month_no(c)).orderBy("month_no")


def nlargest(df: DataFrame, c: str, n: int, *ties: str) -> DataFrame:
    """The n rows with the largest known ``c``, ties broken by the given columns."""
    return df.filter(F.col(c).isNotNull()).orderBy(F.desc(c), *ties).limit(n)


def best(df: DataFrame, metric: str, *ties: str, by: list[str] | None = None) -> DataFrame:
    """The row with the largest metric, overall or per group; ties go to the smallest tie columns."""
    rank = F.struct((-F.col(metric)).alias("_m"), *[F.col(t) for t in ties])
    known = df.filter(F.col(metric).isNotNull())
    picked = known.groupBy(*(by or [])).agg(F.min_by(F.struct(*df.columns), rank).alias("_best"))
    return picked.filter(F.col("_best").isNotNull()).select("_best.*")


def lowest(df: DataFrame, pred: Column, c: str, key: str) -> DataFrame:
    """The single row with the smallest ``c`` among those that satisfy ``pred``."""
    return df.filter(pred & F.col(c).isNotNull()).orderBy(c, key).limit(1)


def latest(df: DataFrame, name: str, version: str) -> DataFrame:
    """The row of the highest version per name; versions compare as numbers."""
    return (
        df.groupBy(name).agg(F.max_by(F.struct(*df.columns), F.col(version).cast("long")).alias("_row"))
        .select("_row.*")
    )


def trend(df: DataFrame, keys: list[str], period: str, c: str) -> DataFrame:
    """Change of ``c`` against the previous period, one input row per key and period.

    ``trend`` says 'decreased' for an unchanged value as well; ``unchanged`` tells
    the two apart. Feed it aggregated periods: a key then has one row per period.
    """
    w = Window.partitionBy(*keys).orderBy(period)
    change = pct_change(c, "from_value")
    return (
        df.withColumn("from_value", F.lag(c).over(w).cast("double"))
        .filter(F.col("from_value").isNotNull())
        .withColumn("to_value", F.col(c).cast("double"))
        .withColumns({
            "trend": trend_label(change),
            "percentage_change": F.round(F.abs(change), 1),
            "unchanged": F.col("to_value") == F.col("from_value"),
        })
    )


def ranked(df: DataFrame, q: str, score: str, *ties: str, k: int | None = None) -> DataFrame:
    """Rank 1.. by falling score within each query; with ``k``, only the first k.

    The rank filter lets Spark cut every task to k rows per query before the
    shuffle.
    """
    w = Window.partitionBy(q).orderBy(F.desc(score), *ties)
    out = df.withColumn("rank", F.row_number().over(w))
    return out.filter(F.col("rank") <= k) if k else out


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def dedupe(df: DataFrame) -> DataFrame:
    """One copy of every distinct row; nulls are equal."""
    return df.dropDuplicates()


def select_features(df: DataFrame, target: str, cols: list[str], n: int) -> DataFrame:
    """Names among the n largest variances or the n strongest correlations with the target."""
    strongest = corr_with(df, target, cols).withColumn("r", F.abs("r"))
    return (
        top_variance(df, cols, n).select("column")
        .union(nlargest(strongest, "r", n, "column").select("column")).distinct()
    )


def melt(df: DataFrame, ids: list[str], values: list[str], var: str, value: str) -> DataFrame:
    """Wide to long."""
    return df.unpivot(ids, values, var, value)


def one_hot(df: DataFrame, cols: list[str], limit: int = WIDE) -> DataFrame:
    """Replace each column by 0/1 columns ``<col>_<value>``, values sorted, none left out.

    Null gives 0 everywhere. Where a column has more than ``limit`` values, all become one
    sparse vector instead, see :func:`one_hot_sparse`.
    """
    values = domains(df, cols, limit)
    if None in values.values():
        return one_hot_sparse(df, cols)[0]
    dummies = [
        F.when(F.col(c) == v, 1).otherwise(0).alias(f"{c}_{v}") for c in cols for v in values[c]
    ]
    return df.select(*[c for c in df.columns if c not in cols], *dummies)


def one_hot_sparse(df: DataFrame, cols: list[str], out: str = "features") -> tuple[DataFrame, DataFrame]:
    """Replace the columns by one 0/1 vector, sparse unless it is short, and the dictionary (``column``, ``value``, ``index``) of its places.

    The places of a column's values, in order, follow those of the columns before it; null
    sets none. Values are numbered and looked up as stored tables, so there may be as many
    as a vector can be long.
    """
    coded, words, at, numbers = df, None, 0, []
    for i, c in enumerate(cols):
        codes = materialize(label_codes(df, c), "codes")
        size = codes.count()
        own = codes.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), (F.col("code") + at).alias("index"))
        words = own if words is None else words.unionByName(own)
        coded = coded.join(codes.toDF(f"_value{i}", f"_code{i}"), F.col(c) == F.col(f"_value{i}"), "left")
        # One place past the last stands for null; the encoder leaves it out.
        coded = coded.withColumn(f"_code{i}", F.coalesce(f"_code{i}", F.lit(size)).cast("double")).drop(f"_value{i}")
        numbers.append(float(size))
        at += size
    names, vectors = ([f"_{kind}{i}" for i in range(len(cols))] for kind in ("code", "one"))
    last = df.sparkSession.createDataFrame([numbers], ", ".join(f"{n} double" for n in names))
    encoded = OneHotEncoder(inputCols=names, outputCols=vectors, dropLast=True).fit(last).transform(coded)
    vector = VectorAssembler(inputCols=vectors, outputCol=out).transform(encoded.drop(*cols))
    return vector.select(*[c for c in df.columns if c not in cols], out), words


def explode_numbered(df: DataFrame, c: str, pos: str, value: str) -> DataFrame:
    """One row per array element with its position from 0; rows without elements vanish.

    The outer form with a filter behind it: for the inner form Spark adds a
    filter that computes the array a second time.
    """
    keep = [x for x in df.columns if x != c]
    return df.select(*keep, F.posexplode_outer(c).alias(pos, value)).filter(F.col(pos).isNotNull())
