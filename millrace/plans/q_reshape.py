"""Queries: order, top-k, windows, set operations, reshaping (O-*, W-*, U-*, R-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import tokens
from millrace.operators import reshape as R
from millrace.operators.models import leaderboard
from millrace.plans.q_profile import NARROW, VAR
from millrace.plans.registry import query
from millrace.plans.views import BK, CP, KEY, RUNS, TX, bookings, profiles, runs, table, texts, trips


@query("o_01_sort_by_month", f"""
WITH {BK} SELECT arrival_date_month, round(avg(adr), 4) AS mean, month(strptime(arrival_date_month, '%B'))::INTEGER AS month_no
FROM bk GROUP BY 1 ORDER BY 3""")
def o_01(spark, sf):
    means = bookings(spark, sf, "arrival_date_month", "adr").groupBy("arrival_date_month").agg(F.round(F.avg("adr"), 4).alias("mean"))
    return R.sort_by_month(means, "arrival_date_month")


@query("o_02_sort_desc", f"WITH {RUNS} SELECT name, version, accuracy, rmse, run_id FROM runs ORDER BY accuracy DESC, run_id")
def o_02(spark, sf):
    return leaderboard(runs(spark, sf), "accuracy", "run_id")


@query("o_03_head", f"""
WITH {BK} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, hotel, adr FROM bk
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, adr LIMIT 10""")
def o_03(spark, sf):
    return bookings(spark, sf, *KEY, "hotel", "adr").orderBy(*KEY, "adr").limit(10)


@query("o_04_nlargest", f"WITH {TX} SELECT trip_id, distance FROM tx WHERE distance IS NOT NULL ORDER BY distance DESC, trip_id LIMIT 20")
def o_04(spark, sf):
    return R.nlargest(trips(spark, sf).select("trip_id", "distance"), "distance", 20, "trip_id")


@query("o_05_best", f"""
WITH {RUNS} SELECT name, version, accuracy, rmse, run_id FROM runs
QUALIFY row_number() OVER (PARTITION BY name ORDER BY accuracy DESC, version) = 1""")
def o_05(spark, sf):
    return R.best(runs(spark, sf), "accuracy", "version", by=["name"])


@query("o_06_lowest", f"WITH {CP} SELECT c_custkey, c_name, c_acctbal, tier FROM cp WHERE tier = 'premium' ORDER BY c_acctbal, c_custkey LIMIT 1")
def o_06(spark, sf):
    return R.lowest(profiles(spark, sf), F.col("tier") == "premium", "c_acctbal", "c_custkey")


@query("o_07_latest", f"""
WITH {RUNS} SELECT name, version::VARCHAR AS version, accuracy, rmse, run_id FROM runs
QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1""")
def o_07(spark, sf):
    # Versions as text, as registries return them: "10" must come after "9".
    return R.latest(runs(spark, sf).withColumn("version", F.col("version").cast("string")), "name", "version")


@query("w_01_trend", """
WITH m AS (SELECT o_orderpriority, date_trunc('month', o_orderdate)::DATE AS month, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2),
l AS (SELECT *, lag(total) OVER (PARTITION BY o_orderpriority ORDER BY month) AS from_value FROM m)
SELECT o_orderpriority, month, total, from_value, total AS to_value,
  CASE WHEN total > from_value THEN 'increased' ELSE 'decreased' END AS trend,
  round(abs((total - from_value) / from_value * 100), 1) AS percentage_change, total = from_value AS unchanged
FROM l WHERE from_value IS NOT NULL""")
def w_01(spark, sf):
    monthly = table(spark, sf, "orders").groupBy(
        "o_orderpriority", F.date_trunc("month", "o_orderdate").cast("date").alias("month")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return R.trend(monthly, ["o_orderpriority"], "month", "total")


@query("w_02_ranked", """
SELECT c_nationkey, c_custkey, c_acctbal, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)::INTEGER AS rank FROM customer) WHERE rank <= 5""")
def w_02(spark, sf):
    df = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return R.ranked(df, "c_nationkey", "c_acctbal", "c_custkey", k=5)


@query("u_01_union", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def u_01(spark, sf):
    orders = table(spark, sf, "orders")
    done, rest = orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'")
    return R.union_all([done, rest.select(*reversed(rest.columns))]).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("u_02_dedupe", f"WITH {BK} SELECT DISTINCT {', '.join(NARROW)} FROM bk")
def u_02(spark, sf):
    return R.dedupe(bookings(spark, sf, *NARROW))


@query("u_03_select_features", f"""
WITH {TX}, v AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", var_samp({c}) AS v, abs(corr({c}, y)) AS r FROM (SELECT *, (payment_type = 'purchase')::INTEGER AS y FROM tx)" for c in VAR) + """))
(SELECT "column" FROM v ORDER BY v DESC, 1 LIMIT 2) UNION (SELECT "column" FROM v ORDER BY r DESC, 1 LIMIT 2)""")
def u_03(spark, sf):
    tx = trips(spark, sf).withColumn("y", (F.col("payment_type") == "purchase").cast("int"))
    return R.select_features(tx, "y", VAR, 2)


@query("r_01_melt", f"""
WITH {BK}, m AS (SELECT hotel, arrival_date_month, round(avg(adr), 4) AS rate, round(avg(lead_time), 4) AS lead FROM bk GROUP BY 1, 2)
SELECT hotel, arrival_date_month, 'rate' AS measure, rate AS value FROM m UNION ALL SELECT hotel, arrival_date_month, 'lead', lead FROM m""")
def r_01(spark, sf):
    m = bookings(spark, sf, "hotel", "arrival_date_month", "adr", "lead_time").groupBy("hotel", "arrival_date_month").agg(
        F.round(F.avg("adr"), 4).alias("rate"), F.round(F.avg("lead_time"), 4).alias("lead"))
    return R.melt(m, ["hotel", "arrival_date_month"], ["rate", "lead"], "measure", "value")


@query("r_02_one_hot", f"""
WITH {BK} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, adr,
  coalesce(reservation_status = 'F', FALSE)::INTEGER AS reservation_status_F, coalesce(reservation_status = 'O', FALSE)::INTEGER AS reservation_status_O,
  coalesce(reservation_status = 'P', FALSE)::INTEGER AS reservation_status_P,
  (hotel = 'City Hotel')::INTEGER AS "hotel_City Hotel", (hotel = 'Resort Hotel')::INTEGER AS "hotel_Resort Hotel" FROM bk""")
def r_02(spark, sf):
    return R.one_hot(bookings(spark, sf, *KEY, "adr", "reservation_status", "hotel"), ["reservation_status", "hotel"])


@query("r_03_explode", r"""
WITH w AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(text, '[\s\x{00A0}]+', ' ', 'g')), ' '), lambda t: t <> '') AS words FROM documents),
e AS (SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS pos FROM w)
SELECT word, count(*) AS n, min(pos)::INTEGER AS first_pos FROM e GROUP BY 1""")
def r_03(spark, sf):
    docs = texts(spark, sf).select("doc_id", tokens("text").alias("words"))
    return R.explode_numbered(docs, "words", "pos", "word").groupBy("word").agg(
        F.count("*").alias("n"), F.min("pos").alias("first_pos"))
