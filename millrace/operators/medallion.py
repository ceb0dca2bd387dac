"""Sessions, cohort roll-ups and period diagnosis over layered tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import pct_change, trend_label


def sessionize(
    events: DataFrame, gap_seconds: int, *, user: str = "user_id", ts: str = "ts",
    event: str = "event_type", goal: str = "purchase",
) -> DataFrame:
    """Session summaries: a pause of at least ``gap_seconds`` starts a new session.

    Events are first folded into one row per user and time bucket one gap wide:
    two events of a bucket are always closer than the gap, so no session border
    is lost. The ordered window then runs over buckets, whose number per user is
    bounded by the time span and not by the events of a busy user.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = gap_seconds * 1_000_000
    buckets = events.filter(F.col(ts).isNotNull() & F.col(user).isNotNull()).groupBy(
        F.col(user).alias("user_id"), (us - F.pmod(us, F.lit(gap))).alias("_bucket")
    ).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.min(us).alias("_us0"), F.max(us).alias("_us1"),
        F.count("*").alias("_n"), F.max(F.col(event) == goal).alias("_goal"),
    )
    w = Window.partitionBy("user_id").orderBy("_bucket")
    opens = F.coalesce(F.col("_us0") - F.lag("_us1").over(w) >= gap, F.lit(True))
    numbered = buckets.withColumn("_open", opens.cast("long")).withColumn("session_no", F.sum("_open").over(w))
    return numbered.groupBy("user_id", "session_no").agg(
        F.min("_first").alias("session_start"), F.max("_last").alias("session_end"),
        ((F.max("_us1") - F.min("_us0")) / 60e6).alias("duration_minutes"),
        F.sum("_n").alias("events"),
        F.coalesce(F.max("_goal"), F.lit(False)).alias("converted"),
    )


def _cohort_sums(sessions: DataFrame, dims: DataFrame, key: str, tier: str, period: Column) -> DataFrame:
    """Sums per period and tier; facts fold per customer before the join, so no hot customer crosses it."""
    per_user = sessions.groupBy("user_id", period.alias("period")).agg(
        F.sum("duration_minutes").alias("_minutes"), F.count("duration_minutes").alias("_timed"),
        F.sum(F.col("converted").cast("long")).alias("_converted"), F.count("*").alias("sessions"),
    )
    joined = per_user.join(dims.select(F.col(key).alias("user_id"), F.col(tier).alias("tier")), "user_id")
    return joined.groupBy("period", "tier").agg(*[
        F.sum(c).alias(c) for c in ("_minutes", "_timed", "_converted", "sessions")])


def cohort_by_period(
    sessions: DataFrame, dims: DataFrame, *, key: str, tier: str = "tier", only: str | None = None, unit: str = "month",
) -> DataFrame:
    """Average duration, conversion rate and session count per period and tier."""
    if only is not None:
        dims = dims.filter(F.col(tier) == only)
    return _cohort_sums(sessions, dims, key, tier, F.date_trunc(unit, "session_start").cast("date")).select(
        "period", "tier", (F.col("_minutes") / F.col("_timed")).alias("avg_duration"),
        (F.col("_converted") / F.col("sessions")).alias("conversion_rate"), "sessions",
    )


def session_metrics(sessions: DataFrame, unit: str = "month") -> DataFrame:
    """The same measures per period over all sessions."""
    return sessions.groupBy(F.date_trunc(unit, "session_start").cast("date").alias("period")).agg(
        F.avg("duration_minutes").alias("avg_duration"),
        F.avg(F.when(F.col("converted"), 1.0).otherwise(0.0)).alias("conversion_rate"),
        F.count("*").alias("sessions"),
    )


def gold_monthly(
    sessions: DataFrame, dims: DataFrame, sales: DataFrame, *, key: str, sale_ts: str, sale_value: str,
    tier: str = "tier", tiers: tuple[str, str] = ("premium", "standard"), unit: str = "month",
) -> DataFrame:
    """Engagement per tier as columns, revenue, and the number of premium customers seen, per period."""
    period = F.date_trunc(unit, "session_start").cast("date")
    per_user = sessions.groupBy("user_id", period.alias("period")).agg(
        F.sum("duration_minutes").alias("_minutes"), F.count("duration_minutes").alias("_timed"))
    joined = per_user.join(dims.select(F.col(key).alias("user_id"), F.col(tier).alias("tier")), "user_id")
    mean = lambda t: F.try_divide(
        F.sum(F.when(F.col("tier") == t, F.col("_minutes"))), F.sum(F.when(F.col("tier") == t, F.col("_timed"))))
    engagement = joined.groupBy("period").agg(
        *[mean(t).alias(f"avg_engagement_{t}") for t in tiers],
        F.count_if(F.col("tier") == tiers[0]).alias(f"{tiers[0]}_customer_count"),
    )
    revenue = sales.groupBy(F.date_trunc(unit, sale_ts).cast("date").alias("period")).agg(
        F.sum(sale_value).alias("total_revenue"))
    return engagement.join(revenue, "period", "left")


def diagnose(
    facts: DataFrame, dims: DataFrame, before: Column, after: Column, *, key: str, tier: str = "tier",
) -> DataFrame:
    """Two periods compared per cohort: one row per (tier, metric) with the change.

    ``before`` and ``after`` are predicates on the facts (session summaries).
    """
    side = F.when(before, "before").when(after, "after")
    sums = _cohort_sums(facts.filter(before | after), dims, key, tier, side)
    metrics = sums.select(
        "tier", "period", F.try_divide("_minutes", "_timed").alias("avg_duration"),
        F.try_divide("_converted", "sessions").alias("conversion_rate"),
        F.col("sessions").cast("double").alias("sessions"),
    ).unpivot(["tier", "period"], ["avg_duration", "conversion_rate", "sessions"], "metric", "value")
    wide = metrics.groupBy("tier", "metric").agg(
        F.max(F.when(F.col("period") == "before", F.col("value"))).alias("from_value"),
        F.max(F.when(F.col("period") == "after", F.col("value"))).alias("to_value"),
    )
    change = pct_change("to_value", "from_value")
    return wide.withColumns({
        "trend": trend_label(change), "percentage_change": F.round(F.abs(change), 1),
        "unchanged": F.col("to_value") == F.col("from_value"),
    })
