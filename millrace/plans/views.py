"""Test-table views in the shapes the jobs work on, for Spark and as check SQL.

bk  bookings   lineitem with its order, customer, nation and part
ln  loans      orders with text rates and a status
tx  trips      events as trips
ss  sessions   events per user, split at pauses of six hours
runs           model runs: one per event type (name) and day (version)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.medallion import sessionize
from millrace.session import spread

GAP_SECONDS = 6 * 3600


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str = "documents") -> DataFrame:
    """A table of texts, over enough partitions for work that is heavy per row."""
    return spread(table(spark, sf, name))


KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

_LINE = {
    **{k: k for k in KEY},
    "l_extendedprice": "l_extendedprice",
    "is_canceled": "CASE WHEN l_returnflag = 'R' THEN 'yes' ELSE 'no' END",
    "hotel": "CASE WHEN l_linestatus = 'O' THEN 'City Hotel' ELSE 'Resort Hotel' END",
    "arrival_date_month": "date_format(l_shipdate, 'MMMM')",
    "adults": "l_linenumber % 3",
    "children": "nullif(l_quantity % 4, 3.0D)",
    "babies": "l_partkey % 2",
    "agent": "nullif(l_suppkey % 5, 4)",
    "company": "CASE WHEN l_suppkey % 20 = 0 THEN l_suppkey END",
    "adr": "l_extendedprice / l_quantity",
    "stays_in_week_nights": "l_quantity",
    "stays_in_weekend_nights": "l_linenumber",
    "net_price": "l_extendedprice * (1 - l_discount)",
}
_ORDER = {
    "lead_time": "datediff(l_shipdate, o_orderdate)",
    "deposit_type": "o_orderpriority",
    "reservation_status": "o_orderstatus",
}
_PART = {
    "reserved_room_type": "p_type",
    "assigned_room_type": "CASE WHEN l_discount < 0.03 THEN 'PROMO' ELSE p_type END",
}
_CUSTOMER = {"market_segment": "c_mktsegment"}
_NATION = {"country": "nullif(n_name, 'NATION_2')"}
BOOKING_COLUMNS = [*_LINE, *_ORDER, *_PART, *_CUSTOMER, *_NATION]


def bookings(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """The named booking columns (all by default), joining only the tables they need."""
    cols = cols or tuple(BOOKING_COLUMNS)
    df = table(spark, sf, "lineitem")
    nation = any(c in _NATION for c in cols)
    customer = nation or any(c in _CUSTOMER for c in cols)
    if customer or any(c in _ORDER for c in cols):
        df = df.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if customer:
        df = df.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if nation:
        df = df.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    if any(c in _PART for c in cols):
        df = df.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    exprs = {**_LINE, **_ORDER, **_PART, **_CUSTOMER, **_NATION}
    return df.select(*[F.expr(exprs[c]).alias(c) for c in cols])


BK = """bk AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    CASE WHEN l_returnflag = 'R' THEN 'yes' ELSE 'no' END AS is_canceled,
    CASE WHEN l_linestatus = 'O' THEN 'City Hotel' ELSE 'Resort Hotel' END AS hotel,
    monthname(l_shipdate) AS arrival_date_month,
    l_linenumber % 3 AS adults, nullif(l_quantity % 4, 3.0) AS children, l_partkey % 2 AS babies,
    nullif(l_suppkey % 5, 4) AS agent, CASE WHEN l_suppkey % 20 = 0 THEN l_suppkey END AS company,
    l_extendedprice / l_quantity AS adr,
    l_quantity AS stays_in_week_nights, l_linenumber AS stays_in_weekend_nights,
    l_extendedprice * (1 - l_discount) AS net_price,
    date_diff('day', o_orderdate, l_shipdate)::INTEGER AS lead_time,
    o_orderpriority AS deposit_type, o_orderstatus AS reservation_status,
    p_type AS reserved_room_type,
    CASE WHEN l_discount < 0.03 THEN 'PROMO' ELSE p_type END AS assigned_room_type,
    c_mktsegment AS market_segment, nullif(n_name, 'NATION_2') AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""


def loans(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as loans: text rates with some bad ones, a status that is null at times."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS loan_id", "o_custkey AS member_id", "o_totalprice AS loan_amnt",
        "CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE concat(' ', o_orderkey % 25, '.5%') END AS int_rate",
        "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 40 END AS dti",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderstatus END AS loan_status",
    )


LN = """ln AS (
  SELECT o_orderkey AS loan_id, o_custkey AS member_id, o_totalprice AS loan_amnt,
    CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE ' ' || (o_orderkey % 25) || '.5%' END AS int_rate,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 40 END AS dti,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderstatus END AS loan_status
  FROM orders)"""


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """Events as trips. The dropoff lies a fixed function of the id after the pickup."""
    return table(spark, sf, "events").selectExpr(
        "event_id AS trip_id", "user_id", "event_type AS payment_type", "ts AS pickup",
        "ts + make_dt_interval(0, 0, 0, event_id * 37 % 5400) AS dropoff",
        "CASE WHEN event_id % 33 = 0 THEN NULL ELSE value END AS distance",
        "cast(user_id % 20 AS int) AS location", "2 * value + hour(ts) AS fare",
    )


TX = """tx AS (
  SELECT event_id AS trip_id, user_id, event_type AS payment_type, ts AS pickup,
    ts + to_seconds(event_id * 37 % 5400) AS dropoff,
    CASE WHEN event_id % 33 = 0 THEN NULL ELSE value END AS distance,
    (user_id % 20)::INTEGER AS location, 2 * value + hour(ts) AS fare
  FROM events)"""


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return sessionize(table(spark, sf, "events"), GAP_SECONDS)


SS = """gaps AS (
  SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pause FROM events),
numbered AS (
  SELECT *, sum(CASE WHEN pause IS NULL OR pause >= 21600000000 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM gaps),
ss AS (
  SELECT user_id, session_no::BIGINT AS session_no, min(ts) AS session_start, max(ts) AS session_end,
    (max(epoch_us(ts)) - min(epoch_us(ts))) / 60e6 AS duration_minutes, count(*) AS events,
    bool_or(event_type = 'purchase') AS converted
  FROM numbered GROUP BY 1, 2)"""


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their tier."""
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "c_acctbal",
        "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'premium' ELSE 'standard' END AS tier")


CP = """cp AS (
  SELECT c_custkey, c_name, c_acctbal,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'premium' ELSE 'standard' END AS tier
  FROM customer)"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Model runs: the event type is the name, the day of month the version, with metrics from the events."""
    return table(spark, sf, "events").groupBy(
        F.col("event_type").alias("name"), F.dayofmonth("ts").cast("long").alias("version")
    ).agg(
        F.round(F.avg("value") / 100, 2).alias("accuracy"), F.round(F.stddev_pop("value"), 4).alias("rmse"),
    ).withColumn("run_id", F.concat("name", F.lit("-"), F.col("version").cast("string")))


RUNS = """runs AS (
  SELECT event_type AS name, day(ts)::BIGINT AS version, round(avg(value) / 100, 2) AS accuracy,
    round(stddev_pop(value), 4) AS rmse, event_type || '-' || day(ts) AS run_id
  FROM events GROUP BY 1, 2, 5)"""


def planted(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a label that is a function of two columns, and a score that nearly orders it."""
    return table(spark, sf, "lineitem").selectExpr(
        *KEY, "l_quantity", "cast(l_linenumber AS double) AS line", "l_extendedprice", "l_discount",
        "CASE WHEN l_quantity + 3 * l_linenumber > 40 THEN 1 ELSE 0 END AS label",
        "l_quantity + l_linenumber AS score",
        "CASE WHEN l_quantity > 28 THEN 1 ELSE 0 END AS prediction")


PL = """pl AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_linenumber::DOUBLE AS line, l_extendedprice, l_discount,
    CASE WHEN l_quantity + 3 * l_linenumber > 40 THEN 1 ELSE 0 END AS label,
    l_quantity + l_linenumber AS score,
    CASE WHEN l_quantity > 28 THEN 1 ELSE 0 END AS prediction
  FROM lineitem)"""


def quality(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with their length as score and a length rule as prediction."""
    return (
        table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
        .selectExpr("doc_id", "quality AS label", "toxic", "cast(n_chars AS double) AS score",
                    "CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS prediction",
                    "CASE WHEN n_chars > 800 THEN 1 ELSE 0 END AS other"))


QL = """ql AS (
  SELECT doc_id, quality AS label, toxic, n_chars::DOUBLE AS score,
    CASE WHEN n_chars > 400 THEN 1 ELSE 0 END AS prediction,
    CASE WHEN n_chars > 800 THEN 1 ELSE 0 END AS other
  FROM labels JOIN documents USING (doc_id))"""
