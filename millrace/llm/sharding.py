"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly, by seeded hashes, into buckets that fit
into memory, one shuffle partition each; every bucket is put in random order by a
seeded Fisher-Yates shuffle and written to the shared folder. Pass two counts the
buckets, lays them end to end, cuts the line into shards of equal row counts (at
most one apart) and writes each shard's rows in that order.

Only two numbers (rows and bytes) and one count per bucket reach the driver or a
window. A bucket holds about ``bucket_bytes``, whatever the size of the input; a
single longer text makes its bucket that much larger.

Defined cases: null texts have size 8 and are kept; repeated rows are scattered on
their own, because the hash takes each row's place in the scan, so no
key can fill a bucket; an empty table gives no rows and no shards; columns may have
any name, as the records travel inside one struct. A run over the same files with
the same split settings and seed gives the same shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.common import text_of, with_place
from millrace.session import scratch_path


def size_of(df: DataFrame, column: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.octet_length(text_of(df, column)) + 8).cast("long")


def _fisher_yates(seed: int):
    def shuffle(batches):
        import numpy as np
        import pyarrow as pa

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        buckets = rows.column("bucket").to_numpy()
        for number in np.unique(buckets):
            # Generator.permutation is a Fisher-Yates shuffle.
            order = np.random.default_rng([seed, number]).permutation(np.flatnonzero(buckets == number))
            for at in range(0, len(order), 4096):
                part = rows.take(order[at : at + 4096])
                place = np.arange(at, at + part.num_rows, dtype="int64")
                yield from part.append_column("place", pa.array(place)).combine_chunks().to_batches()

    return shuffle


def shuffled(df: DataFrame, seed: int = 17, bucket_bytes: int = 32 << 20, column: str = "text") -> DataFrame:
    """Pass one: the records as struct ``record`` with their ``bucket`` and random ``place`` in it, stored."""
    spark = df.sparkSession
    total = df.select(size_of(df, column).alias("size")).agg(F.sum("size"), F.count("*")).first()
    n = max(spark.sparkContext.defaultParallelism, math.ceil((total[0] or 0) / bucket_bytes))
    # By its place in the files a row falls into the same bucket again when a task is repeated.
    placed, place = with_place(df)
    scattered = placed.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(place)), F.lit(n)).cast("int").alias("bucket"))
    dealt = scattered.repartitionById(n, F.col("bucket"))
    mixed = dealt.mapInArrow(_fisher_yates(seed), StructType([*dealt.schema, StructField("place", LongType())]))
    path = scratch_path(spark, "buckets")
    mixed.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(mixed.schema).parquet(path)


def shard(
    df: DataFrame, shards: int = 24, seed: int = 17, bucket_bytes: int = 32 << 20, column: str = "text",
) -> DataFrame:
    """The records in shuffled order with ``shard`` (0 to shards - 1) and gapless ``slot``."""
    stored = shuffled(df, seed, bucket_bytes, column)
    counts = stored.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rows = counts.agg(F.sum("n")).first()[0] or 0
    base, longer = divmod(rows, shards)
    # The first ``longer`` shards hold base + 1 rows, the others base.
    edge = longer * (base + 1)
    at = F.col("start") + F.col("place")
    # 16 bytes for each bucket of bucket_bytes, so this side is bounded by the input's size / 2,000,000.
    placed = stored.join(F.broadcast(starts), "bucket").withColumn("_at", at)
    if base:
        number = F.when(F.col("_at") < edge, F.floor(F.col("_at") / (base + 1))).otherwise(
            longer + F.floor((F.col("_at") - edge) / base))
    else:
        number = F.col("_at")
    placed = placed.withColumn("shard", number.cast("int"))
    first = F.col("shard") * base + F.least(F.col("shard"), F.lit(longer))
    return placed.select("record", "shard", (F.col("_at") - first).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int = 24, seed: int = 17, **options) -> DataFrame:
    """Pass two: one folder per shard, rows in slot order; returns what was written.

    A bucket covers a run of at most a few shards, so a task opens few files.
    """
    placed = shard(df, shards, seed, **options)
    placed.write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.parquet(path)


def query(spark, docs: DataFrame) -> DataFrame:
    """Digest of every document's place after the shuffle into 24 shards of equal row counts."""
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return shard(docs.select("doc_id", "text")).select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
