"""Deterministic feature engineering: encoding, imputing, scaling, splitting, pruning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import hash_below
from millrace.functions.scalars import nan_as_null
from millrace.operators.profile import corr_matrix, domains
from millrace.operators.ranking import label_codes
from millrace.session import materialize


MAP_DOMAIN = 256


def label_encode(df: DataFrame, c: str, out: str | None = None, buckets: int = 64) -> DataFrame:
    """Replace (or add as ``out``) the sorted-order code of a column; null stays null.

    Spark orders the values in either case (NaN last). A domain measured to be small
    becomes a literal map, with no join. A larger one is numbered as a distributed table and joined.
    """
    found = df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).limit(MAP_DOMAIN + 1).collect()
    if len(found) <= MAP_DOMAIN:
        pairs = [F.lit(x) for i, v in enumerate(r[0] for r in found) for x in (v, i)]
        code = F.try_element_at(F.create_map(*pairs), F.col(c)) if pairs else F.lit(None)
        return df.withColumn(out or c, code.cast("long"))
    # Stored, so that Spark knows its true size and broadcasts it only when it is small.
    codes = materialize(label_codes(df, c, buckets).withColumnsRenamed({c: "_value", "code": "_code"}), "codes")
    joined = df.join(codes, F.col(c) == F.col("_value"), "left")
    return joined.withColumn(out or c, F.col("_code")).drop("_value", "_code")


def label_encode_all(df: DataFrame, cols: list[str], buckets: int = 64) -> DataFrame:
    """:func:`label_encode` of several columns; small domains are found by one job."""
    known = domains(df, cols, MAP_DOMAIN)
    out = df
    for c, values in known.items():
        # Spark's order of text and numbers is Python's; NaN and other kinds go the long way.
        if values is None or not all(isinstance(v, (str, int)) for v in values):
            out = label_encode(out, c, buckets=buckets)
            continue
        pairs = [F.lit(x) for i, v in enumerate(values) for x in (v, i)]
        code = F.try_element_at(F.create_map(*pairs), F.col(c)) if pairs else F.lit(None)
        out = out.withColumn(c, code.cast("long"))
    return out


def index_categories(df: DataFrame, cols: list[str], suffix: str = "_index"):
    """Frequency-order index per column, ties alphabetical, unseen values kept.

    Returns the fitted model; its ``transform`` adds the index columns.
    """
    return StringIndexer(
        inputCols=cols, outputCols=[c + suffix for c in cols], handleInvalid="keep",
        stringOrderType="frequencyDesc",
    ).fit(df)


def encode_categories(df: DataFrame, cols: list[str], suffix: str = "_vec"):
    """Fitted one-hot vector encoder over index columns, unseen values kept."""
    return OneHotEncoder(
        inputCols=cols, outputCols=[c + suffix for c in cols], handleInvalid="keep",
    ).fit(df)


def assemble(df: DataFrame, cols: list[str], out: str = "features", invalid: str = "skip") -> DataFrame:
    """Feature vector of the columns; rows with a null are skipped."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=invalid).transform(df)


def finalise(df: DataFrame, label: str, features: str = "features", keep: list[str] | None = None) -> DataFrame:
    """Only the columns a model needs: features, label, and any key to keep."""
    return df.select(*(keep or []), F.col(features).alias("features"), F.col(label).cast("double").alias("label"))


@dataclass
class MeanImputer:
    """Column means of the known values, as doubles; ``empty`` lists the columns that had none. NaN is missing, like null."""

    means: dict[str, float]
    empty: list[str]

    @classmethod
    def fit(cls, df: DataFrame, cols: list[str]) -> "MeanImputer":
        row = nan_as_null(df.select(*cols)).agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
        return cls({c: v for c, v in row.items() if v is not None}, [c for c, v in row.items() if v is None])

    def transform(self, df: DataFrame) -> DataFrame:
        filled = nan_as_null(df, list(self.means)).withColumns({
            c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in self.means.items()})
        return filled.drop(*self.empty)


@dataclass
class StandardScale:
    """Zero mean and unit population deviation; a constant column is only centred. Missing values, null or NaN, stay null."""

    mean: dict[str, float]
    scale: dict[str, float]

    @classmethod
    def fit(cls, train: DataFrame, cols: list[str]) -> "StandardScale":
        row = nan_as_null(train.select(*cols)).agg(
            *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
        return cls({c: row[f"m_{c}"] for c in cols}, {c: row[f"s_{c}"] or 1.0 for c in cols})

    def transform(self, df: DataFrame) -> DataFrame:
        return nan_as_null(df, list(self.mean)).withColumns({
            c: (F.col(c).cast("double") - F.lit(m)) / F.lit(self.scale[c]) for c, m in self.mean.items()})


def split(df: DataFrame, keys: list[str], fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash: disjoint, complete, and stable under repartitioning."""
    inside = hash_below(fraction, *keys, seed=seed)
    return df.filter(inside), df.filter(~inside)


def sample(df: DataFrame, keys: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """Key-determined sample of about ``fraction`` of the rows."""
    return df.filter(hash_below(fraction, *keys, seed=seed))


def prune_list(df: DataFrame, cols: list[str], threshold: float = 0.85) -> DataFrame:
    """Columns with |r| at or above the threshold against any earlier column.

    The earlier column counts even if it is dropped itself; unknown r never drops.
    """
    return (
        corr_matrix(df, cols, absolute=True).filter(F.col("r") >= threshold)
        .select(F.col("col_i").alias("column")).distinct()
    )


def prune_correlated(df: DataFrame, cols: list[str], threshold: float = 0.85) -> DataFrame:
    """The frame without the columns of ``prune_list``."""
    names = [r[0] for r in prune_list(df, cols, threshold).limit(len(cols)).collect()]
    return df.drop(*names)


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight per class, rows / (classes × rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    return counts.withColumn(
        "weight",
        totals.select("rows").scalar() / (totals.select("classes").scalar() * F.col("n")),
    )


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add the balanced class weight to every labelled row.

    A number of classes measured to be small becomes a literal map: a class of half the
    rows then costs no shuffle. More classes are joined as a stored table.
    """
    weights = balanced_weights(df, label)
    rows = weights.limit(MAP_DOMAIN + 1).collect()
    if len(rows) <= MAP_DOMAIN:
        pairs = [F.lit(v) for r in rows for v in (r[label], r["weight"])]
        if not pairs:
            return df.withColumn(name, F.lit(None).cast("double")).filter(F.lit(False))
        return df.withColumn(name, F.try_element_at(F.create_map(*pairs), F.col(label))).filter(F.col(name).isNotNull())
    stored = materialize(weights.select(F.col(label).alias("_class"), F.col("weight").alias("_weight")), "weights")
    return df.join(stored, F.col(label) == F.col("_class")).select(*[df[c] for c in df.columns if c != name], F.col("_weight").alias(name))
