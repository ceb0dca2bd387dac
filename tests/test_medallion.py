"""Sessions and cohort jobs: golden numbers, borders, hot users."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.scalars import pct_change, trend_label
from millrace.operators import medallion as D
from millrace.operators.reshape import lowest
from tests.conftest import rows_of

# Duration pattern and conversion step per cohort and month.
COHORTS = [
    ("premium", 6, list(range(20, 29)), 3), ("premium", 7, list(range(10, 17)), 6),
    ("standard", 6, list(range(14, 20)), 5), ("standard", 7, list(range(14, 20)), 5),
]
# Engagement score and lifetime value of customers 101 to 110.
SCORES = [71, 45, 83, 50, 68, 42, 79, 55, 62, 48]
VALUES = [500 + 100 * i for i in range(10)]


@pytest.fixture(scope="module")
def customers(spark):
    rows = [(101 + i, ["premium", "standard"][i % 2], s, v) for i, (s, v) in enumerate(zip(SCORES, VALUES))]
    return spark.createDataFrame(rows, "customer_id long, tier string, engagement_score int, lifetime_value int")


@pytest.fixture(scope="module")
def summaries(spark):
    rows = []
    for tier, month, minutes, step in COHORTS:
        ids = range(101 if tier == "premium" else 102, 111, 2)
        for i in range(60):
            day = dt.datetime(2025, month, 1) + dt.timedelta(days=i % 28)
            rows.append((ids[i % 5], i, day, float(minutes[i % len(minutes)]), i % step == 0))
    return spark.createDataFrame(
        rows, "user_id long, session_no long, session_start timestamp_ntz, duration_minutes double, converted boolean")


def test_golden_cohorts(summaries, customers):
    assert summaries.count() == 240
    got = {(r.period.month, r.tier): r for r in D.cohort_by_period(summaries, customers, key="customer_id").collect()}
    want = {(6, "premium"): (23.85, 20), (7, "premium"): (12.90, 10), (6, "standard"): (16.5, 12), (7, "standard"): (16.5, 12)}
    for k, (duration, conversions) in want.items():
        assert got[k].avg_duration == pytest.approx(duration)
        assert got[k].conversion_rate * 60 == pytest.approx(conversions) and got[k].sessions == 60


def test_golden_diagnosis(summaries, customers):
    june, july = F.month("session_start") == 6, F.month("session_start") == 7
    got = {(r.tier, r.metric): r for r in D.diagnose(summaries, customers, june, july, key="customer_id").collect()}
    assert len(got) == 6
    assert got["premium", "avg_duration"].percentage_change == pytest.approx(45.9)
    assert got["premium", "conversion_rate"].trend == "decreased"
    flat = got["standard", "avg_duration"]
    assert flat.unchanged and flat.percentage_change == 0.0 and flat.trend == "decreased"


def test_golden_gold_trend_and_lowest(frame, customers):
    change = frame("cur double, prev double", (71.0, 83.0)).withColumn("c", pct_change("cur", "prev"))
    assert change.select(F.round(F.abs("c"), 1), trend_label("c")).first() == (14.5, "decreased")
    who = lowest(customers, F.col("tier") == "premium", "engagement_score", "customer_id").first()
    assert (who.customer_id, who.engagement_score, who.lifetime_value) == (109, 62, 1300)


def test_gold_roll_up(summaries, customers, spark):
    sales = spark.createDataFrame([(dt.datetime(2025, 6, 3), 10.0), (dt.datetime(2025, 6, 4), 5.5)], "ts timestamp_ntz, v double")
    got = {r.period.month: r for r in D.gold_monthly(summaries, customers, sales, key="customer_id", sale_ts="ts", sale_value="v").collect()}
    assert got[6].total_revenue == 15.5 and got[7].total_revenue is None
    assert got[7].avg_engagement_premium == pytest.approx(12.9) and got[6].premium_customer_count == 5


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def test_session_borders(spark):
    gap = 100
    rows = [(1, at(s), k) for s, k in [(0, "view"), (99, "view"), (198, "purchase"), (298, "view"), (500, "click")]]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_type string")
    got = D.sessionize(df, gap).orderBy("session_no").collect()
    assert [(r.session_start, r.session_end, r.events, r.converted) for r in got] == [
        (at(0), at(198), 3, True), (at(298), at(298), 1, False), (at(500), at(500), 1, False)]
    assert got[0].duration_minutes == pytest.approx(3.3)


def test_sessions_against_plain_loop(spark):
    import random

    rng = random.Random(4)
    # User 0 is hot: it has most of the events.
    rows = [(0 if rng.random() < 0.6 else rng.randrange(1, 9), at(rng.randrange(200_000)), "view") for _ in range(4000)]
    want = []
    for user in range(9):
        times = sorted(t for u, t, _ in rows if u == user)
        start = prev = times[0]
        n = 0
        for t in [*times, None]:
            if t is None or (t - prev).total_seconds() >= 900:
                if n:
                    want.append((user, start, prev, n))
                start, n = t, 0
            n, prev = n + 1, t
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_type string").repartition(5)
    got = D.sessionize(df, 900).select("user_id", "session_start", "session_end", "events")
    assert rows_of(got) == sorted(want)
