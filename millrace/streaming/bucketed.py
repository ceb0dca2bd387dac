"""Incremental keyed sync into a bucketed table: reads merge bucket by bucket, without shuffling the history.

All changes go into one table, partitioned by batch and bucketed by key; a compaction
writes the state up to some batch as a base with the same buckets. Base and later
changes of a key therefore lie in buckets of the same number, and a reader takes the newest row per key
inside each bucket, where the rows are.

A compaction does not stop the sync. It covers the batches that were complete when it
began, and becomes the base in one step, by a property of the table that names base and
last batch covered; batches that come in meanwhile lie beyond it. A reader that began before goes on with
the old base, which is left in place. A batch repeated after a failure is written over its
first attempt. A change without a key is refused, since no bucket merge would find its like.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import setting
from millrace.streaming.sync import _newest

BASE, UPTO = "millrace.base", "millrace.upto"


def create_index(spark: SparkSession, name: str, schema, keys: list[str], buckets: int = 64) -> None:
    """An empty index table, if there is none yet. The number of buckets stays; give one per few hundred MB of state."""
    if not spark.catalog.tableExists(name):
        empty = spark.createDataFrame([], schema).withColumn("epoch", F.lit(0).cast("long"))
        empty.write.partitionBy("epoch").bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(name)


def sync_bucketed(
    changes: DataFrame, name: str, checkpoint: str, keys: list[str], order: str, *,
    deleted: str | None = None, continuous: str | None = None,
):
    """Start the sync into the table of :func:`create_index` and return the streaming query; arguments as in ``sync_index``."""

    def store(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        known = batch.withColumns({k: F.coalesce(k, F.raise_error(F.lit(f"null in the key {k}"))) for k in keys})
        rows = _newest(known, keys, [order], deleted).withColumn("epoch", F.lit(epoch).cast("long"))
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        changes.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger).start())


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _state(spark: SparkSession, name: str, keys: list[str], order: str | None, deleted: str | None, upto: int | None = None) -> DataFrame:
    """The newest row per key of the base and the batches beyond it (up to ``upto``)."""
    spark.catalog.refreshTable(name)
    found = _properties(spark, name)
    batches, covered = spark.table(name), int(found.get(UPTO, -1))
    batches = batches.filter(F.col("epoch") > covered) if upto is None else batches.filter(F.col("epoch").between(covered + 1, upto))
    by = [*([order] if order else []), "epoch"]
    if BASE not in found:
        return _newest(batches, keys, by, deleted)
    # Both sides have one row per key, so each bucket of the base meets its own by a merge join.
    gone = [F.coalesce(F.col(deleted), F.lit(False))] if deleted else []
    columns = [c for c in batches.columns if c != "epoch"]
    packed = lambda df, field, epoch, row, rank: df.select(
        *[F.col(k).alias(f"_{row}_{k}") for k in keys], F.struct(*[field(c).alias(c) for c in columns]).alias(row),
        F.struct(*[field(c).alias(c) for c in ([order] if order else [])], epoch.alias("epoch"),
                 *[F.coalesce(field(c), F.lit(False)).alias("gone") for c in ([deleted] if deleted else [])]).alias(rank))
    # The grouping keys are carried along, as Spark knows by them that the buckets still hold.
    fresh = batches.groupBy(*keys).agg(F.max_by(F.struct(*batches.columns), F.struct(*by, *gone, F.lit(0))).alias("_row"))
    new = packed(fresh, lambda c: F.col("_row")[c], F.col("_row.epoch"), "_new", "_newer")
    old = packed(spark.table(found[BASE]), F.col, F.lit(-1).cast("long"), "_old", "_older")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"__new_{k}") == F.col(f"__old_{k}"))
    newest = F.when(F.col("_old").isNull() | (F.col("_newer") >= F.col("_older")), F.col("_new")).otherwise(F.col("_old"))
    return old.hint("merge").join(new, same, "full").select(newest.alias("_row")).select("_row.*")


def read_bucketed(spark: SparkSession, name: str, keys: list[str], order: str | None = None, deleted: str | None = None) -> DataFrame:
    """The newest row per key, without the keys whose newest change is a delete; rules as in ``read_index``."""
    state = _state(spark, name, keys, order, deleted)
    return state.filter(~F.coalesce(F.col(deleted), F.lit(False))) if deleted else state


def compact_bucketed(
    spark: SparkSession, name: str, keys: list[str], order: str | None = None, deleted: str | None = None, buckets: int = 64,
) -> str:
    """Make the state up to the newest batch the base, flagged rows included; returns the base's name. ``buckets`` as in the index."""
    spark.catalog.refreshTable(name)
    newest = spark.table(name).agg(F.max("epoch")).first()[0]
    covered = int(_properties(spark, name).get(UPTO, -1))
    upto = max(covered, -1 if newest is None else newest)
    base = f"{name}_base_{uuid.uuid4().hex[:12]}"
    state = _state(spark, name, keys, order, deleted, upto)
    state.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(base)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{BASE}' = '{base}', '{UPTO}' = '{upto}')")
    return base
