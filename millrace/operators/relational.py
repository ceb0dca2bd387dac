"""Joins, keyed upserts, feature lookups and prediction comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(a: DataFrame, b: DataFrame, on: list[str], names: tuple[dict, dict]) -> DataFrame:
    """Inner join of two aggregates after giving their value columns separate names."""
    return a.withColumnsRenamed(names[0]).join(b.withColumnsRenamed(names[1]), on)


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fail if a key occurs twice; returns the frame."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"key {keys} is not unique, e.g. {twice[0]}")
    return df


def training_set(
    labels: DataFrame, lookups: list[tuple[DataFrame, list[str], list[str]]],
    label: str, exclude: list[str] | None = None, check: bool = True,
) -> DataFrame:
    """Label frame with feature columns looked up by key.

    Each lookup is (feature table, key columns, feature columns). Labels without
    features keep nulls; a feature table must hold each key once, so the label
    rows are never multiplied.
    """
    out = labels
    for table, keys, features in lookups:
        table = table.select(*keys, *features)
        out = out.join(assert_unique(table, keys) if check else table, keys, "left")
    out = out.drop(*(exclude or []))
    return out.select(*[c for c in out.columns if c != label], label)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Merge ``source`` into ``target`` by key.

    A source that holds a key twice is refused, because it would multiply the
    target's rows; ``check=False`` saves that pass where the key is known to be
    unique. A matched row takes every source value, nulls included, and keeps the
    target's other columns; new keys are added; new columns are null on rows the
    source does not have.
    """
    if check:
        assert_unique(source.select(*keys).dropna(), keys)
    t, s = target.alias("t"), source.withColumn("_in_source", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "full_outer")
    hit = F.col("s._in_source").isNotNull()
    out = [F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in keys]
    for c in dict.fromkeys([*target.columns, *source.columns]):
        if c in keys:
            continue
        if c not in target.columns:
            out.append(F.col(f"s.{c}").alias(c))
        elif c not in source.columns:
            out.append(F.col(f"t.{c}").alias(c))
        else:
            out.append(F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return joined.select(*out)


def compare_predictions(a: DataFrame, b: DataFrame, keys: list[str], c: str = "prediction") -> DataFrame:
    """Two scorers' predictions aligned by key, with a mismatch flag."""
    left = a.select(*keys, F.col(c).alias("prediction_a"))
    right = b.select(*keys, F.col(c).alias("prediction_b"))
    return left.join(right, keys).withColumn(
        "mismatch", ~F.col("prediction_a").eqNullSafe(F.col("prediction_b")))


def score_batch(model, rows: DataFrame, lookups: list, label: str | None = None) -> DataFrame:
    """Look up the features of the given keys and apply a fitted model; a feature key that occurs twice is refused."""
    out = rows
    for table, keys, features in lookups:
        out = out.join(assert_unique(table.select(*keys, *features), keys), keys, "left")
    return model.transform(out.drop(label) if label else out)
