"""Streams give what the batch gives, over several drops of files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.medallion import sessionize
from millrace.session import scratch_path
from millrace.streaming import events as E
from millrace.streaming import sync as Y
from tests.conftest import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def drops(spark):
    """The events in three files, in time order, with one file read per trigger."""
    path = scratch_path(spark, "drops")
    events = spark.read.parquet(f"{SF}/events.parquet")
    for lo, hi in ((1, 11), (11, 21), (21, 32)):
        events.filter((F.dayofmonth("ts") >= lo) & (F.dayofmonth("ts") < hi)).coalesce(1).write.mode("append").parquet(path)
    return path, events


def stream(spark, path):
    one = spark.readStream.schema(E.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    return one.withColumn("ts", F.col("ts").cast("timestamp"))


def test_ingest_takes_every_event(spark, drops):
    path, events = drops
    out = E.run_to_table(stream(spark, path), "bronze")
    assert out.select("epoch").distinct().count() >= 3
    assert rows_of(out, "event_id") == rows_of(events, "event_id")


def test_closed_windows_equal_batch(spark, drops):
    path, events = drops
    out = E.run_to_table(E.stream_counts(stream(spark, path)), "counts")
    batch = events.groupBy(F.date_trunc("day", "ts").alias("window_start"), "event_type").agg(F.count("*").alias("n"))
    last = events.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    want = [r for r in rows_of(batch) if r[0].replace(tzinfo=None) + dt.timedelta(days=1) <= last]
    assert rows_of(out, "window_start", "event_type", "n") == want


def test_closed_sessions_equal_batch(spark, drops):
    path, events = drops
    out = E.run_to_table(E.stream_sessions(stream(spark, path)), "sessions")
    last = events.agg(F.max("ts")).first()[0] - dt.timedelta(hours=7)
    batch = sessionize(events, 6 * 3600).filter(F.col("session_end") <= F.lit(last).cast("timestamp_ntz"))
    as_text = lambda df: df.select("user_id", F.col("session_start").cast("string"), F.col("session_end").cast("string"), "events", "converted")
    assert rows_of(as_text(out)) == rows_of(as_text(batch))


def test_late_events_are_left_out(spark):
    path = scratch_path(spark, "late")
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    row = lambda i, t: (i, t, 1, "view", 1.0, "{}")
    schema = E.EVENT_SCHEMA
    parts = [[row(1, at(1, 1)), row(2, at(5, 1))], [row(3, at(9, 1))], [row(4, at(1, 2))], [row(5, at(12, 1))]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    out = E.run_to_table(E.stream_counts(stream(spark, path)), "late-out")
    # The second event of the first day comes after its window was closed.
    assert [(r[0].day, r[1]) for r in rows_of(out, "window_start", "n")] == [(1, 1), (5, 1), (9, 1)]


def newest_steps(out):
    newest = F.max_by(F.struct("n_view", "n_click", "n_purchase", "step"), "epoch").alias("r")
    return out.groupBy("user_id").agg(newest).select("user_id", "r.*")


def test_funnel_runs_over_triggers(spark, drops):
    path, events = drops
    out = E.run_to_table(E.stream_funnel(stream(spark, path)), "funnel", mode="update")
    want = {}
    for user, kind in [(r.user_id, r.event_type) for r in events.orderBy("user_id", "ts").collect()]:
        own = want.setdefault(user, [0, 0, 0, 0])
        if kind in E.FUNNEL:
            own[E.FUNNEL.index(kind)] += 1
            own[3] += E.FUNNEL.index(kind) == own[3]
    assert rows_of(newest_steps(out)) == sorted((u, *own) for u, own in want.items())


def funnel_of(spark, parts, **how):
    path = scratch_path(spark, "funnel-drops")
    for n, part in enumerate(parts):
        rows = [(n, dt.datetime(2024, 1, d, h), user, kind, 1.0, "{}") for user, kind, d, h in part]
        spark.createDataFrame(rows, E.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return E.run_to_table(E.stream_funnel(stream(spark, path), **how), "funnel", mode="update")


def test_funnel_goes_by_event_time(spark):
    out = funnel_of(spark, [
        # 1 in order, 2 backwards, 3 with a click before the view only, 4 with its view yet to come.
        [(1, "view", 1, 1), (2, "purchase", 1, 1), (3, "click", 1, 1), (4, "click", 1, 20), (None, "view", 1, 1)],
        [(1, "click", 1, 21), (2, "click", 1, 21), (3, "view", 1, 21), (4, "purchase", 1, 21)],
        [(1, "purchase", 1, 22), (2, "view", 1, 22), (3, "purchase", 1, 22), (4, "view", 1, 19), (4, "other", 1, 22)],
    ], delay="1 day")
    assert {r["user_id"]: r["step"] for r in newest_steps(out).collect()} == {1: 3, 2: 1, 3: 1, 4: 3, None: 1}


def test_funnel_forgets_idle_users(spark):
    out = funnel_of(spark, [
        [(1, "view", 1, 1)], [(2, "view", 9, 1)], [(2, "view", 9, 2)], [(1, "click", 10, 1)],
    ], idle=dt.timedelta(days=2))
    assert rows_of(newest_steps(out).filter("user_id = 1")) == [(1, 0, 1, 0, 0)]



def test_sync_takes_newest_change_and_can_be_compacted(spark, frame):
    source, target, state = (scratch_path(spark, n) for n in ("src", "dst", "state"))
    schema = T.StructType.fromDDL("id int, v string, seq int")
    for rows in [[(1, "a", 1), (2, "b", 1)], [(2, "c", 3), (2, "old", 2), (3, "d", 1)], []]:
        if rows:
            frame(schema, *rows).coalesce(1).write.mode("append").parquet(source)
        changes = spark.readStream.schema(schema).parquet(source)
        Y.sync_index(changes, target, state, ["id"], "seq").awaitTermination()
    late = frame(schema, (2, "late", 0))
    late.coalesce(1).write.mode("append").parquet(source)
    Y.sync_index(spark.readStream.schema(schema).parquet(source), target, state, ["id"], "seq").awaitTermination()
    want = [(1, "a"), (2, "c"), (3, "d")]
    assert rows_of(Y.read_index(spark, target, schema, ["id"], "seq"), "id", "v") == want
    folded = Y.compact_index(spark, target, schema, ["id"], "seq")
    assert rows_of(Y.read_index(spark, folded, schema, ["id"], "seq"), "id", "v") == want
    frame(schema, (3, "e", 9)).coalesce(1).write.mode("append").parquet(source)
    Y.sync_index(spark.readStream.schema(schema).parquet(source), folded, state, ["id"], "seq").awaitTermination()
    assert rows_of(Y.read_index(spark, folded, schema, ["id"], "seq"), "id", "v") == [(1, "a"), (2, "c"), (3, "e")]


def test_sync_follows_deletes(spark, frame):
    source, target, state = (scratch_path(spark, n) for n in ("del-src", "del-dst", "del-state"))
    schema = T.StructType.fromDDL("id int, v string, seq int, gone boolean")

    def drop(into, *rows):
        frame(schema, *rows).coalesce(1).write.mode("append").parquet(source)
        changes = spark.readStream.schema(schema).parquet(source)
        Y.sync_index(changes, into, state, ["id"], "seq", deleted="gone").awaitTermination()

    read = lambda at: rows_of(Y.read_index(spark, at, schema, ["id"], "seq", "gone"), "id", "v")
    drop(target, (1, "a", 1, False), (2, "b", 1, None), (3, "c", 1, False), (4, "tie", 1, False), (4, None, 1, True))
    drop(target, (1, None, 3, True))
    drop(target, (1, "late", 2, False), (3, "unordered", None, False))
    assert read(target) == [(2, "b"), (3, "c")]
    folded = Y.compact_index(spark, target, schema, ["id"], "seq", "gone")
    drop(folded, (1, "later", 2, False))
    assert read(folded) == [(2, "b"), (3, "c")]
    drop(folded, (1, "back", 4, False))
    assert read(folded) == [(1, "back"), (2, "b"), (3, "c")]
