"""Structured Streaming over the raw event table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.session import scratch_path

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"

# The steps of the purchase funnel, in order.
FUNNEL = ("view", "click", "purchase")


def stream_events(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA) -> DataFrame:
    """Events as a stream of parquet files; ``ts`` becomes a zoned timestamp, as watermarks need."""
    return spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def stream_counts(events: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Events and value sum per tumbling window and event type, once the window is closed."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", window).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("value"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "value")
    )


MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def stream_sessions(events: DataFrame, gap: str = "6 hours", delay: str = "1 hour", goal: str = "purchase") -> DataFrame:
    """Closed sessions per user; events later than ``delay`` are not taken up.

    Run it with the setting MERGE_SESSIONS on (see ``session.setting``): then the
    events of a user are merged into session pieces inside each input partition
    before the shuffle, so a busy user sends pieces and not events. Either way
    an open session costs one state row.
    """
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.session_window("ts", gap).alias("w"), "user_id")
        .agg(F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("events"),
             F.max(F.col("event_type") == goal).alias("converted"))
        .select("user_id", "session_start", "session_end", "events", "converted")
    )


FUNNEL_ROWS = "user_id long, n_view long, n_click long, n_purchase long, first_view long, last_purchase long, last_us long, clicks array<long>"
FUNNEL_STATE = "users array<long>, nulls array<boolean>, sums array<long>, clicks array<long>, owners array<int>"
#: Stand for "no view yet" and "no purchase yet".
NEVER, EVER = 2**63 - 1, -(2**63)


def _folding():
    """``fold``: all users of a block at once, as arrays; returned as a closure that ships by value."""
    never, ever = NEVER, EVER

    def fold(users, nulls, sums, owners, clicks):
        """One row per user: counts added up, first view, last purchase, last event, deepest step, and clicks that may still pair.

        ``sums`` has the columns n_view, n_click, n_purchase, first_view, last_purchase,
        last_us, step, and 1 where the row is of this batch. A click can still pair if it is the earliest one at or after the first
        view, or before it. Returns the same five arrays, users in order, owners as
        their places, and each user's paired click (or ``never``).
        """
        import numpy as np

        order = np.lexsort((users, nulls))
        new = np.r_[True, (users[order][1:] != users[order][:-1]) | (nulls[order][1:] != nulls[order][:-1])][: len(users)]
        place = np.empty(len(users), "i8")
        place[order] = np.cumsum(new) - 1
        size = int(new.sum())
        total = np.zeros((size, 8), "i8")
        total[:, 3], total[:, 4], total[:, 5] = never, ever, ever
        for c, add in enumerate((np.add, np.add, np.add, np.minimum, np.maximum, np.maximum, np.maximum, np.maximum)):
            add.at(total[:, c], place, sums[:, c])
        owners = place[owners]
        at = np.lexsort((clicks, owners))
        owners, clicks = owners[at], clicks[at]
        once = np.r_[True, (owners[1:] != owners[:-1]) | (clicks[1:] != clicks[:-1])][: len(clicks)]
        owners, clicks = owners[once], clicks[once]
        after = clicks >= total[owners, 3]
        first = after & ~np.r_[False, after[:-1] & (owners[1:] == owners[:-1])][: len(after)]
        paired = np.full(size, never, "i8")
        paired[owners[first]] = clicks[first]
        kept = first | ~after
        return users[order][new], nulls[order][new], total, owners[kept], clicks[kept], paired

    return fold


def stream_funnel(events: DataFrame, delay: str = "1 hour", idle: dt.timedelta = dt.timedelta(days=30), buckets: int = 200) -> DataFrame:
    """Running funnel per user: events seen per step, the deepest step reached in order, last event time.

    A click counts at or after a view, a purchase at or after such a click, in event
    time; events up to ``delay`` late are put into their place, whichever trigger they
    come in. A user without events for ``idle`` is forgotten and starts anew.

    Events are folded per user inside every Arrow batch before they are grouped, so a
    busy user sends sums and click times and not events. Users live in ``buckets`` by
    hash, and a bucket is one state: all its users are brought forward together as
    arrays. A bucket's state is written whole when one of its users has events, so give
    about as many buckets as keep it at some thousand users; the number is part of the
    state and stays with the stream. A user costs sums, the first view, the last purchase, and
    clicks: one after the first view, and those before it that are younger than the
    watermark, as a late view may still precede them.
    """
    steps, idle_ms, fold, never, ever = FUNNEL, int(idle.total_seconds() * 1000), _folding(), NEVER, EVER

    def combine(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            users, us = batch.column(0), batch.column(2).to_numpy()
            kind = [pc.fill_null(pc.equal(batch.column(1), s), False).to_numpy(zero_copy_only=False) for s in steps]
            sums = np.stack([*(k.astype("i8") for k in kind), np.where(kind[0], us, never), np.where(kind[2], us, ever), us, *np.zeros((2, len(us)), "i8")], 1)
            click = np.flatnonzero(kind[1])
            users, nulls, total, owners, clicks, _ = fold(
                users.fill_null(0).to_numpy(), users.is_null().to_numpy(zero_copy_only=False), sums, click, us[click])
            ends = np.r_[0, np.cumsum(np.bincount(owners, minlength=len(users)))].astype("i4")
            yield pa.RecordBatch.from_arrays(
                [pa.array(users, mask=nulls), *(pa.array(total[:, c].copy()) for c in range(6)), pa.ListArray.from_arrays(pa.array(ends), pa.array(clicks))],
                names=["user_id", "n_view", "n_click", "n_purchase", "first_view", "last_purchase", "last_us", "clicks"])

    def advance(key, batches: Iterator, state: GroupState) -> Iterator:
        import numpy as np
        import pandas as pd

        held = state.get if state.exists else ([], [], [], [], [])
        users, nulls = [np.array(held[0], "i8")], [np.array(held[1], bool)]
        before = np.array(held[2], "i8").reshape(-1, 7)
        sums, clicks, owners = [np.c_[before, np.zeros(len(before), "i8")]], [np.array(held[3], "i8")], [np.array(held[4], "i8")]
        touched, old = 0, len(users[0])
        for pdf in [] if state.hasTimedOut else batches:
            nulls.append(pdf.user_id.isna().to_numpy())
            users.append(pdf.user_id.fillna(0).to_numpy("i8"))
            sums.append(np.column_stack([pdf[c].to_numpy("i8") for c in (
                "n_view", "n_click", "n_purchase", "first_view", "last_purchase", "last_us")] + [np.zeros(len(pdf), "i8"), np.ones(len(pdf), "i8")]))
            sizes = pdf.clicks.map(len).to_numpy("i8")
            owners.append(old + touched + np.repeat(np.arange(len(pdf)), sizes))
            clicks.append(np.concatenate([*pdf.clicks, np.zeros(0, "i8")]).astype("i8"))
            touched += len(pdf)
        users, nulls, sums, owners, clicks = (np.concatenate(x) for x in (users, nulls, sums, owners, clicks))
        users, nulls, sums, owners, clicks, paired = fold(users, nulls, sums, owners, clicks)
        viewed, bought = sums[:, 3] < never, sums[:, 4]
        now_step = np.where(~viewed, 0, np.where(paired == never, 1, np.where(bought < paired, 2, 3)))
        sums[:, 6] = np.maximum(sums[:, 6], now_step)
        now = state.getCurrentWatermarkMs()
        new = sums[:, 7] > 0
        stays = new | (sums[:, 5] // 1000 + idle_ms > now)
        kept = stays[owners] & (sums[owners, 6] < 3) & ((clicks == paired[owners]) | (clicks >= now * 1000))
        if stays.any():
            renumbered = np.cumsum(stays) - 1
            state.update((users[stays].tolist(), nulls[stays].tolist(), sums[stays, :7].ravel().tolist(), clicks[kept].tolist(),
                          renumbered[owners[kept]].astype("i4").tolist()))
            state.setTimeoutTimestamp(int(max((sums[stays, 5] // 1000).min() + idle_ms, now + 1)))
        else:
            state.remove()
        if not new.any():
            return
        user = pd.array(users[new], "Int64")
        user[nulls[new]] = pd.NA
        own = sums[new]
        yield pd.DataFrame({
            "user_id": user, "n_view": own[:, 0], "n_click": own[:, 1], "n_purchase": own[:, 2], "step": own[:, 6].astype("i4"), "last_us": own[:, 5]})

    known = events.filter("ts is not null").select("user_id", "event_type", F.unix_micros("ts").alias("us"))
    folded = known.mapInArrow(combine, FUNNEL_ROWS).withColumn("ts", F.timestamp_micros("last_us"))
    return (
        folded.withWatermark("ts", delay).withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets))).groupBy("bucket")
        .applyInPandasWithState(
            advance, "user_id long, n_view long, n_click long, n_purchase long, step int, last_us long",
            FUNNEL_STATE, "update", GroupStateTimeout.EventTimeTimeout)
    )


def with_epoch(schema: T.StructType) -> T.StructType:
    """The schema of micro-batch folders: the batch columns and the folder number."""
    return T.StructType([*schema.fields, T.StructField("epoch", T.IntegerType())])


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drain the available input into a new folder of the shared directory and read it back.

    Every micro-batch is a folder of its own, written with overwrite, so a
    repeated batch after a failure replaces its first attempt. Adds ``epoch``.
    """
    spark = stream.sparkSession
    out = scratch_path(spark, name)

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    query = (
        stream.writeStream.outputMode(mode).foreachBatch(store)
        .option("checkpointLocation", scratch_path(spark, f"{name}-state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(with_epoch(stream.schema)).parquet(out)
