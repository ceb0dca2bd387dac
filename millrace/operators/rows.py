"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mismatch(a: str, b: str) -> Column:
    """``a`` differs from ``b``; a null on one side is a difference, on both it is not."""
    return ~F.col(a).eqNullSafe(F.col(b))


def in_range(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Keep rows with lo < c <= hi for every column; null values are dropped."""
    for c, (lo, hi) in ranges.items():
        df = df.filter((F.col(c) > lo) & (F.col(c) <= hi))
    return df


def drop_where(df: DataFrame, pred: Column) -> DataFrame:
    """Drop the rows where ``pred`` is true; rows where it is unknown stay."""
    return df.filter(~F.coalesce(pred, F.lit(False)))


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns and fail if one is still there or never was."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    return df.drop(*cols)


def cast_all(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast several columns in one projection."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def to_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns as double; text that is not a number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names: text and booleans, then numbers."""
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return cat, num


def hcat(df: DataFrame, *groups: list) -> DataFrame:
    """Put column groups of the same row side by side, in one projection."""
    return df.select(*[c for group in groups for c in group])


def count_where(df: DataFrame, pred: Column, name: str = "n") -> DataFrame:
    """Number of rows for which ``pred`` is true."""
    return df.agg(F.count_if(pred).alias(name))


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Blanks and slashes in names to ``_``; byte and boolean columns to int."""
    narrow = (T.ByteType, T.BooleanType)
    return df.select([
        (F.col(f"`{f.name}`").cast("int") if isinstance(f.dataType, narrow) else F.col(f"`{f.name}`"))
        .alias(f.name.replace(" ", "_").replace("/", "_"))
        for f in df.schema.fields
    ])
