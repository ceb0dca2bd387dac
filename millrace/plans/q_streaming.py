"""Queries: Structured Streaming jobs (T-*), each drained over the available files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.plans.views import SS, table
from millrace.session import scratch_path, setting
from millrace.streaming import bucketed as B
from millrace.streaming import events as T
from millrace.streaming import sync as Y

DROPS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@query("t_01_ingest", """
SELECT event_type, ts::DATE AS day, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1, 2""")
def t_01(spark, sf):
    bronze = T.run_to_table(T.stream_events(spark, f"{sf}/events*.parquet"), "bronze")
    return bronze.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))


SYNCED = """
SELECT vec_id, CASE WHEN label >= 5 THEN label + 100 ELSE label END AS label, round(embedding[1]::DOUBLE, 5) AS first, len(embedding)::INTEGER AS dims
FROM embeddings WHERE vec_id % 10 <> 3"""


@query("t_02_sync_index", SYNCED)
def t_02(spark, sf):
    target, state = scratch_path(spark, "index"), scratch_path(spark, "index-state")
    for changes, schema in _drops(spark, sf):
        Y.sync_index(changes, target, state, ["vec_id"], "version", deleted="gone").awaitTermination()
    return _synced(Y.read_index(spark, target, schema, ["vec_id"], "version", "gone"))


@query("t_02_sync_bucketed", SYNCED)
def t_02_bucketed(spark, sf):
    """The same drops into a bucketed table, compacted after the second."""
    name, state = f"index_{uuid.uuid4().hex[:12]}", scratch_path(spark, "index-state")
    for n, (changes, schema) in enumerate(_drops(spark, sf)):
        B.create_index(spark, name, schema, ["vec_id"], buckets=8)
        B.sync_bucketed(changes, name, state, ["vec_id"], "version", deleted="gone").awaitTermination()
        if n == 1:
            B.compact_bucketed(spark, name, ["vec_id"], "version", "gone", buckets=8)
    return _synced(B.read_bucketed(spark, name, ["vec_id"], "version", "gone"))


def _synced(index):
    return index.select("vec_id", "label", F.round(F.col("embedding")[0].cast("double"), 5).alias("first"), F.size("embedding").alias("dims"))


def _drops(spark, sf):
    """Four drops: all vectors, new labels from 5 up, deletes of some keys, and late old versions of everything."""
    drops = scratch_path(spark, "drops")
    base = table(spark, sf, "embeddings").withColumn("gone", F.lit(False))
    changed = base.filter("label >= 5").withColumn("label", F.col("label") + 100)
    removed = base.filter("vec_id % 10 = 3").withColumn("gone", F.lit(True))
    late = base.withColumn("label", F.lit(-1).cast("int"))
    schema = base.withColumn("version", F.lit(1)).schema
    for version, rows in ((1, base), (2, changed), (3, removed), (0, late)):
        rows.withColumn("version", F.lit(version)).write.mode("append").parquet(drops)
        changes = spark.readStream.schema(schema).parquet(drops)
        yield changes, schema


# A session is closed when the newest event is more than gap and delay (7 hours) after its last one.
@query("t_03_sessions", f"""
WITH {SS} SELECT user_id, session_start::VARCHAR AS session_start, session_end::VARCHAR AS session_end, events, converted FROM ss
WHERE session_end + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def t_03(spark, sf):
    with setting(spark, T.MERGE_SESSIONS, "true"):
        out = T.run_to_table(T.stream_sessions(T.stream_events(spark, f"{sf}/events*.parquet")), "sessions")
    return out.select("user_id", F.col("session_start").cast("string").alias("session_start"),
                      F.col("session_end").cast("string").alias("session_end"), "events", "converted")


@query("t_04_counts", """
SELECT ts::DATE AS day, event_type, count(*) AS n, round(sum(value), 2) AS value FROM events
GROUP BY 1, 2 HAVING ts::DATE + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def t_04(spark, sf):
    out = T.run_to_table(T.stream_counts(T.stream_events(spark, f"{sf}/events*.parquet")), "counts")
    return out.select(F.col("window_start").cast("date").alias("day"), "event_type", "n", F.round("value", 2).alias("value"))


@query("t_05_funnel", """
WITH v AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS n_view, count(*) FILTER (event_type = 'click') AS n_click,
  count(*) FILTER (event_type = 'purchase') AS n_purchase, epoch_us(max(ts)) AS last_us,
  min(ts) FILTER (event_type = 'view') AS viewed FROM events GROUP BY 1),
c AS (SELECT user_id, min(ts) AS clicked FROM events JOIN v USING (user_id) WHERE event_type = 'click' AND ts >= viewed GROUP BY 1),
p AS (SELECT user_id, min(ts) AS bought FROM events JOIN c USING (user_id) WHERE event_type = 'purchase' AND ts >= clicked GROUP BY 1)
SELECT user_id, n_view, n_click, n_purchase, last_us,
  CASE WHEN viewed IS NULL THEN 0 WHEN clicked IS NULL THEN 1 WHEN bought IS NULL THEN 2 ELSE 3 END AS step
FROM v LEFT JOIN c USING (user_id) LEFT JOIN p USING (user_id)""")
def t_05(spark, sf):
    out = T.run_to_table(T.stream_funnel(T.stream_events(spark, f"{sf}/events*.parquet")), "funnel", mode="update")
    newest = F.max_by(F.struct("n_view", "n_click", "n_purchase", "step", "last_us"), F.col("epoch"))
    return out.groupBy("user_id").agg(newest.alias("r")).select("user_id", "r.*")
