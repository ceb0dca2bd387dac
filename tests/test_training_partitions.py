"""Training data lies in partitions of bounded size, whatever the files give."""

from pyspark.sql import functions as F

from millrace.operators import models as M


def test_a_large_partition_is_spread(spark, monkeypatch):
    monkeypatch.setattr(M, "PARTITION_ROWS", 1000, raising=False)
    cores = spark.sparkContext.defaultParallelism
    uneven = spark.range(20_000, numPartitions=1).union(spark.range(20_000, 20_000 + 3 * cores, numPartitions=3 * cores))
    with M.cached(uneven) as data:
        sizes = [r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 1000 and data.agg(F.sum("id")).first()[0] == sum(range(20_000 + 3 * cores))
    even = spark.range(900 * 4 * cores, numPartitions=4 * cores)
    with M.cached(even) as data:
        assert data.rdd.getNumPartitions() == 4 * cores
    with M.cached(spark.range(0)) as data:
        assert data.count() == 0


def test_nothing_is_kept_before_it_is_spread(spark, monkeypatch):
    monkeypatch.setattr(M, "PARTITION_ROWS", 1000)
    kept, persist = [], type(spark.range(0)).persist
    monkeypatch.setattr(type(spark.range(0)), "persist", lambda df, *a: kept.append(df) or persist(df, *a))
    with M.cached(spark.range(20_000, numPartitions=1)) as data:
        assert data.count() == 20_000
    sizes = [r["count"] for df in kept for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 1000
