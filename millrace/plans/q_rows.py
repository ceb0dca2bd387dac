"""Queries: projections, filters, predicates (P-*) and scalar functions (F-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import rows as R
from millrace.operators.profile import info
from millrace.plans.registry import query
from millrace.plans.views import BK, KEY, LN, SS, TX, bookings, loans, sessions, table, texts, trips

K = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("p_01_equality", f"WITH {BK} SELECT {K}, hotel, adr FROM bk WHERE is_canceled = 'yes'")
def p_01(spark, sf):
    return bookings(spark, sf, *KEY, "hotel", "adr", "is_canceled").filter(F.col("is_canceled") == "yes").drop("is_canceled")


@query("p_02_conjunction", f"""
WITH {BK} SELECT {K}, adr FROM bk WHERE hotel = 'City Hotel' AND is_canceled = 'no' AND adr > 1500""")
def p_02(spark, sf):
    bk = bookings(spark, sf, *KEY, "adr", "hotel", "is_canceled")
    return bk.filter((F.col("hotel") == "City Hotel") & (F.col("is_canceled") == "no") & (F.col("adr") > 1500)).select(*KEY, "adr")


@query("p_03_mismatch", f"""
WITH {BK} SELECT is_canceled, count(*) AS n FROM bk
WHERE nullif(reserved_room_type, 'PROMO') IS DISTINCT FROM assigned_room_type GROUP BY 1""")
def p_03(spark, sf):
    bk = bookings(spark, sf, "is_canceled", "reserved_room_type", "assigned_room_type")
    bk = bk.withColumn("reserved_room_type", F.nullif("reserved_room_type", F.lit("PROMO")))
    return bk.filter(R.mismatch("reserved_room_type", "assigned_room_type")).groupBy("is_canceled").agg(F.count("*").alias("n"))


@query("p_04_ranges", f"""
WITH {TX} SELECT trip_id, distance, fare FROM tx WHERE distance > 0 AND distance <= 100 AND fare > 2 AND fare <= 150""")
def p_04(spark, sf):
    return R.in_range(trips(spark, sf), {"distance": (0, 100), "fare": (2, 150)}).select("trip_id", "distance", "fare")


@query("p_05_drop_where", f"""
WITH {BK} SELECT {K}, adults::INTEGER AS adults, children, babies FROM bk
WHERE NOT coalesce(adults = 0 AND children = 0 AND babies = 0, FALSE)""")
def p_05(spark, sf):
    bk = bookings(spark, sf, *KEY, "adults", "children", "babies")
    return R.drop_where(bk, (F.col("children") == 0) & (F.col("adults") == 0) & (F.col("babies") == 0))


@query("p_06_drop_value", f"""
WITH {BK} SELECT country, count(*) AS n FROM bk WHERE country IS DISTINCT FROM 'NATION_7' GROUP BY 1""")
def p_06(spark, sf):
    return R.drop_where(bookings(spark, sf, "country"), F.col("country") == "NATION_7").groupBy("country").agg(F.count("*").alias("n"))


@query("p_07_select_drop", f"WITH {BK} SELECT {K}, hotel, lead_time, country, adr FROM bk")
def p_07(spark, sf):
    bk = bookings(spark, sf, *KEY, "hotel", "lead_time", "country", "adr", "company", "agent")
    return R.drop_columns(bk, "company", "agent")


@query("p_08_derived", f"""
WITH {BK} SELECT {K}, stays_in_week_nights + stays_in_weekend_nights AS total_nights FROM bk""")
def p_08(spark, sf):
    bk = bookings(spark, sf, *KEY, "stays_in_week_nights", "stays_in_weekend_nights")
    return bk.withColumn("total_nights", F.col("stays_in_week_nights") + F.col("stays_in_weekend_nights")).select(*KEY, "total_nights")


@query("p_09_rename", f"WITH {BK} SELECT {K}, adr AS daily_rate, arrival_date_month AS month FROM bk")
def p_09(spark, sf):
    return bookings(spark, sf, *KEY, "adr", "arrival_date_month").withColumnsRenamed(
        {"adr": "daily_rate", "arrival_date_month": "month"})


@query("p_10_label", f"WITH {LN} SELECT loan_id, loan_status = 'F' AS defaulted FROM ln")
def p_10(spark, sf):
    return loans(spark, sf).select("loan_id", S.label_eq("loan_status", "F", "defaulted"))


@query("p_11_cast_all", f"""
WITH {TX} SELECT trip_id::DOUBLE AS trip_id, user_id::DOUBLE AS user_id, location::BIGINT AS location,
  trunc(fare)::INTEGER AS fare FROM tx""")
def p_11(spark, sf):
    df = trips(spark, sf).select("trip_id", "user_id", "location", "fare")
    return R.cast_all(df, {"trip_id": "double", "user_id": "double", "location": "bigint", "fare": "int"})


@query("p_12_dropna", f"WITH {BK} SELECT {K}, children, agent FROM bk WHERE children IS NOT NULL AND agent IS NOT NULL")
def p_12(spark, sf):
    return bookings(spark, sf, *KEY, "children", "agent").dropna(subset=["children", "agent"])


@query("p_13_fillna", f"""
WITH {BK} SELECT {K}, coalesce(children, 0) AS children, coalesce(agent, 0) AS agent, coalesce(country, 'OTHER') AS country FROM bk""")
def p_13(spark, sf):
    return bookings(spark, sf, *KEY, "children", "agent", "country").fillna({"children": 0.0, "agent": 0, "country": "OTHER"})


@query("p_14_to_numeric", f"""
WITH {LN} SELECT loan_id, try_cast(replace(trim(int_rate), '%', '') AS DOUBLE) AS int_rate FROM ln""")
def p_14(spark, sf):
    ln = loans(spark, sf).select("loan_id", F.replace("int_rate", F.lit("%"), F.lit("")).alias("int_rate"))
    return R.to_numeric(ln, ["int_rate"])


TYPED = ["hotel", "country", "arrival_date_month", "lead_time", "adr", "children"]


@query("p_15_by_type", f"""
WITH {BK} SELECT * FROM (
  SELECT 'categorical' AS kind, 'hotel' AS "column", count(hotel) AS non_null FROM bk
  UNION ALL SELECT 'categorical', 'country', count(country) FROM bk
  UNION ALL SELECT 'categorical', 'arrival_date_month', count(arrival_date_month) FROM bk
  UNION ALL SELECT 'numeric', 'lead_time', count(lead_time) FROM bk
  UNION ALL SELECT 'numeric', 'adr', count(adr) FROM bk
  UNION ALL SELECT 'numeric', 'children', count(children) FROM bk)""")
def p_15(spark, sf):
    bk = bookings(spark, sf, *TYPED)
    cat, _ = R.by_type(bk)
    kind = F.when(F.col("column").isin(cat), "categorical").otherwise("numeric")
    return info(bk).select(kind.alias("kind"), "column", "non_null")


@query("p_16_hcat", f"""
WITH {BK} SELECT {K}, lead_time, adr, hotel, country FROM bk""")
def p_16(spark, sf):
    bk = bookings(spark, sf, *KEY, "hotel", "lead_time", "country", "adr")
    cat, num = R.by_type(bk)
    return R.hcat(bk, num, cat)


@query("p_17_count_where", f"WITH {BK} SELECT count(*) FILTER (adults = 0) AS n FROM bk")
def p_17(spark, sf):
    return R.count_where(bookings(spark, sf, "adults"), F.col("adults") == 0)


@query("f_01_pct_to_double", f"""
WITH {LN} SELECT loan_id, try_cast(replace(trim(int_rate), '%', '') AS DOUBLE) AS rate FROM ln""")
def f_01(spark, sf):
    return loans(spark, sf).select("loan_id", S.pct_to_double("int_rate").alias("rate"))


@query("f_02_month_no", f"""
WITH {BK} SELECT arrival_date_month AS month, month(strptime(arrival_date_month, '%B'))::INTEGER AS month_no, count(*) AS n
FROM bk GROUP BY 1""")
def f_02(spark, sf):
    return bookings(spark, sf, "arrival_date_month").groupBy(
        F.col("arrival_date_month").alias("month"), S.month_no("arrival_date_month").alias("month_no")
    ).agg(F.count("*").alias("n"))


@query("f_03_yes_no", f"""
WITH {BK} SELECT {K}, CASE is_canceled WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS is_canceled FROM bk""")
def f_03(spark, sf):
    return bookings(spark, sf, *KEY, "is_canceled").withColumn("is_canceled", S.yes_no("is_canceled"))


@query("f_04_minutes_between", f"""
WITH {TX} SELECT trip_id, (floor(epoch(dropoff)) - floor(epoch(pickup))) / 60 AS minutes FROM tx""")
def f_04(spark, sf):
    return trips(spark, sf).select("trip_id", S.minutes_between("pickup", "dropoff").alias("minutes"))


@query("f_05_calendar_parts", f"""
WITH {TX} SELECT hour(pickup)::INTEGER AS pickup_hour, (dayofweek(pickup) + 1)::INTEGER AS pickup_dayofweek,
  month(pickup)::INTEGER AS pickup_month, year(pickup)::INTEGER AS pickup_year, count(*) AS n FROM tx GROUP BY 1, 2, 3, 4""")
def f_05(spark, sf):
    parts = ["pickup_hour", "pickup_dayofweek", "pickup_month", "pickup_year"]
    return S.calendar_parts(trips(spark, sf), "pickup").groupBy(*parts).agg(F.count("*").alias("n"))


@query("f_06_month_bucket", """
SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n FROM orders GROUP BY 1""")
def f_06(spark, sf):
    return table(spark, sf, "orders").groupBy(F.date_trunc("month", "o_orderdate").cast("date").alias("month")).agg(
        F.count("*").alias("n"))


@query("f_07_clean_text", r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(
    '== Head == ' || text || ' [12]' || chr(160) || ' end', '\[\d+\]', '', 'g'), '[\s\x{00A0}]+', ' ', 'g'),
    '={2,}.*?={2,}', '', 'g')) AS clean FROM documents""")
def f_07(spark, sf):
    marked = F.concat(F.lit("== Head == "), "text", F.lit(" [12]\u00a0 end"))
    return texts(spark, sf).select("doc_id", S.clean_text(marked).alias("clean"))


@query("f_08_length", "SELECT doc_id, length(text)::INTEGER AS n FROM documents")
def f_08(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length("text").alias("n"))


@query("f_09_snippet", r"""
WITH t AS (SELECT doc_id, trim(regexp_replace(text, '[\s\x{00A0}]+', ' ', 'g')) AS text FROM documents)
SELECT doc_id, CASE WHEN length(text) <= 180 THEN text
  ELSE rtrim(regexp_extract(text, '^(.{1,179})(?: .*)?$', 1)) || '…' END AS snippet FROM t""")
def f_09(spark, sf):
    return texts(spark, sf).select("doc_id", S.snippet("text").alias("snippet"))


@query("f_10_json_row", """
SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d')
  || '","o_orderpriority":"' || o_orderpriority || '"}' AS json FROM orders""")
def f_10(spark, sf):
    return S.to_json_row(table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority"))


@query("f_12_sanitize_id", r"""
WITH t AS (SELECT c_custkey, regexp_replace(replace(lower(raw), '.', '_'), '[^a-z0-9_]', '', 'g') AS s FROM (
  SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN c_custkey || '.' || c_name WHEN 2 THEN '#!' ELSE NULL END AS raw FROM customer))
SELECT c_custkey, CASE WHEN coalesce(s, '') = '' THEN 'anonymous' WHEN regexp_matches(s, '^[0-9]') THEN 'user_' || s ELSE s END AS id FROM t""")
def f_12(spark, sf):
    raw = F.expr("CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN concat(c_custkey, '.', c_name) WHEN 2 THEN '#!' END")
    return table(spark, sf, "customer").select("c_custkey", S.sanitize_id(raw).alias("id"))


@query("f_13_valid_id", r"""
SELECT c_custkey, regexp_matches(raw, '^[a-zA-Z0-9_]+$') AND length(raw) BETWEEN 1 AND 255 AS valid FROM (
  SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN replace(c_name, '#', '_') ELSE repeat('x', 200 + c_custkey % 100) END AS raw FROM customer)""")
def f_13(spark, sf):
    raw = F.expr("CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN replace(c_name, '#', '_') ELSE repeat('x', cast(200 + c_custkey % 100 AS int)) END")
    return table(spark, sf, "customer").select("c_custkey", S.is_valid_id(raw).alias("valid"))


@query("f_14_struct_first", "SELECT vec_id, embedding[1] AS first_value, label AS scalar_value FROM embeddings")
def f_14(spark, sf):
    packed = table(spark, sf, "embeddings").select(F.struct("*").alias("row"))
    df = packed.select("row.*")
    return df.select("vec_id", S.first_pred(df, "embedding").alias("first_value"), S.first_pred(df, "label").alias("scalar_value"))


@query("f_15_pct_change", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(abs(CASE WHEN p = 0 THEN CASE WHEN c > 0 THEN 9e9 ELSE 0 END
    ELSE (c - p) / p * 100 END), 1) AS change,
  CASE WHEN (CASE WHEN p = 0 THEN CASE WHEN c > 0 THEN 9e9 ELSE 0 END ELSE (c - p) / p * 100 END) > 0
    THEN 'increased' ELSE 'decreased' END AS trend
FROM (SELECT *, l_quantity AS c, (l_discount * 100)::INTEGER::DOUBLE AS p FROM lineitem)""")
def f_15(spark, sf):
    change = S.pct_change("l_quantity", F.round(F.col("l_discount") * 100))
    shown = F.when(change == float("inf"), 9e9).otherwise(F.round(F.abs(change), 1))
    return table(spark, sf, "lineitem").select(*KEY, shown.alias("change"), S.trend_label(change).alias("trend"))


@query("f_16_conditional", f"""
WITH {SS} SELECT user_id, session_no, CASE WHEN converted THEN 1.0::DOUBLE ELSE 0.0 END AS converted FROM ss""")
def f_16(spark, sf):
    return sessions(spark, sf).select("user_id", "session_no", F.when(F.col("converted"), 1.0).otherwise(0.0).alias("converted"))
