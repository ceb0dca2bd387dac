"""Queries: aggregates and profiles (A-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import medallion as M
from millrace.operators import profile as A
from millrace.operators.gram import corr_tiled
from millrace.plans.registry import query
from millrace.plans.views import BK, CP, QL, SS, TX, bookings, profiles, quality, sessions, table, trips


def rounded(df, digits: int = 4):
    """Doubles of a result rounded, so that engines can be compared."""
    return df.select([
        F.round(f"`{n}`", digits).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes])


@query("a_01_value_counts", f"WITH {BK} SELECT country, count(*) AS n FROM bk WHERE country IS NOT NULL GROUP BY 1")
def a_01(spark, sf):
    return A.value_counts(bookings(spark, sf, "country"), "country")


@query("a_02_value_pct", f"""
WITH {BK} SELECT market_segment, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4)::DOUBLE AS pct
FROM bk GROUP BY 1""")
def a_02(spark, sf):
    return rounded(A.value_pct(bookings(spark, sf, "market_segment"), "market_segment"))


@query("a_03_group_mean", f"""
WITH {BK} SELECT hotel, arrival_date_month, round(avg(adr), 4) AS mean FROM bk GROUP BY 1, 2""")
def a_03(spark, sf):
    return rounded(A.group_mean(bookings(spark, sf, "hotel", "arrival_date_month", "adr"), ["hotel", "arrival_date_month"], "adr"))


@query("a_04_group_count", f"""
WITH {BK} SELECT country, hotel, count(children) AS n FROM bk WHERE country IS NOT NULL GROUP BY 1, 2""")
def a_04(spark, sf):
    return A.group_count(bookings(spark, sf, "country", "hotel", "children"), ["country", "hotel"], "children")


@query("a_05_crosstab", f"""
WITH {BK} SELECT deposit_type, count(*) FILTER (is_canceled = 'no') AS no, count(*) FILTER (is_canceled = 'yes') AS yes
FROM bk GROUP BY 1""")
def a_05(spark, sf):
    return A.crosstab(bookings(spark, sf, "deposit_type", "is_canceled"), "deposit_type", "is_canceled")


@query("a_06_rate", f"""
WITH {BK} SELECT hotel, round(avg((is_canceled = 'yes')::INTEGER) * 100, 4) AS rate FROM bk GROUP BY 1
UNION ALL SELECT 'all', round(avg((is_canceled = 'yes')::INTEGER) * 100, 4) FROM bk""")
def a_06(spark, sf):
    bk = bookings(spark, sf, "hotel", "is_canceled")
    yes = F.col("is_canceled") == "yes"
    overall = A.rate(bk, yes).select(F.lit("all").alias("hotel"), "rate")
    return rounded(A.rate(bk, yes, ["hotel"]).unionByName(overall))


@query("a_07_box_stats", f"""
WITH {BK}, box AS (SELECT market_segment, quantile_cont(adr, 0.25) AS q1, quantile_cont(adr, 0.5) AS median,
  quantile_cont(adr, 0.75) AS q3 FROM bk GROUP BY 1)
SELECT market_segment, round(min(adr), 10) AS min, round(any_value(q1), 10) AS q1, round(any_value(median), 10) AS median,
  round(any_value(q3), 10) AS q3, round(max(adr), 10) AS max,
  round(min(adr) FILTER (adr BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 10) AS whisker_low,
  round(max(adr) FILTER (adr BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 10) AS whisker_high,
  count(*) FILTER (adr NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM bk JOIN box USING (market_segment) GROUP BY 1""")
def a_07(spark, sf):
    return rounded(A.box_stats(bookings(spark, sf, "market_segment", "adr"), ["market_segment"], "adr"), 10)


@query("a_08_histogram", f"""
WITH {BK}, r AS (SELECT min(lead_time)::DOUBLE AS lo, max(lead_time)::DOUBLE AS hi FROM bk)
SELECT is_canceled, least(floor((lead_time - lo) / ((hi - lo) / 30)), 29)::INTEGER AS bin, count(*) AS n,
  round(any_value(lo) + least(floor((lead_time - lo) / ((hi - lo) / 30)), 29) * any_value((hi - lo) / 30), 4) AS bin_start
FROM bk, r GROUP BY 1, 2, least(floor((lead_time - lo) / ((hi - lo) / 30)), 29)""")
def a_08(spark, sf):
    return rounded(A.histogram(bookings(spark, sf, "lead_time", "is_canceled"), "lead_time", 30, ["is_canceled"]))


@query("a_09_density", f"""
WITH {TX}, s AS (SELECT count(distance) AS n, stddev_samp(distance) AS sd, min(distance) AS lo, max(distance) AS hi FROM tx),
g AS (SELECT i AS point, lo - 0.5 * (hi - lo) + i * (2 * (hi - lo) / 31) AS x, sd * pow(n, -0.2) AS h, n
  FROM s, range(0, 32) t(i))
SELECT point::INTEGER AS point, round(any_value(x), 4) AS x,
  round(sum(exp(-0.5 * pow((distance - x) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 8) AS density
FROM tx, g WHERE distance IS NOT NULL GROUP BY 1""")
def a_09(spark, sf):
    d = A.density(trips(spark, sf), "distance", 32)
    return d.select("point", F.round("x", 4).alias("x"), F.round("density", 8).alias("density"))


NUM = ["lead_time", "adr", "children", "stays_in_week_nights", "agent"]


def _describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(min({c})::DOUBLE, 10) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 10) AS q1,
  round(quantile_cont({c}::DOUBLE, 0.5), 10) AS median, round(quantile_cont({c}::DOUBLE, 0.75), 10) AS q3,
  round(max({c})::DOUBLE, 10) AS max FROM bk"""


@query("a_10_describe", f"WITH {BK} " + " UNION ALL ".join(map(_describe_sql, NUM)))
def a_10(spark, sf):
    stats = A.describe(bookings(spark, sf, *NUM), NUM)
    return rounded(stats, 10).withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query("a_11_info", f"""
WITH {BK} SELECT 'country' AS "column", count(country) AS non_null, 'string' AS type FROM bk
UNION ALL SELECT 'children', count(children), 'double' FROM bk
UNION ALL SELECT 'agent', count(agent), 'bigint' FROM bk
UNION ALL SELECT 'company', count(company), 'bigint' FROM bk
UNION ALL SELECT 'adults', count(adults), 'int' FROM bk""")
def a_11(spark, sf):
    return A.info(bookings(spark, sf, "country", "children", "agent", "company", "adults"))


@query("a_12_missing", f"""
WITH {BK} SELECT * FROM (
SELECT 'country' AS "column", count(*) - count(country) AS total, round((count(*) - count(country)) * 100.0 / count(*), 4)::DOUBLE AS pct FROM bk
UNION ALL SELECT 'children', count(*) - count(children), round((count(*) - count(children)) * 100.0 / count(*), 4) FROM bk
UNION ALL SELECT 'agent', count(*) - count(agent), round((count(*) - count(agent)) * 100.0 / count(*), 4) FROM bk
UNION ALL SELECT 'company', count(*) - count(company), round((count(*) - count(company)) * 100.0 / count(*), 4) FROM bk)""")
def a_12(spark, sf):
    return rounded(A.missing(bookings(spark, sf)))


@query("a_13_nunique", f"WITH {BK} SELECT count(DISTINCT country) AS n_distinct FROM bk")
def a_13(spark, sf):
    return A.nunique(bookings(spark, sf, "country"), "country")


@query("a_14_uniques", f"""
WITH {BK} SELECT DISTINCT 'country' AS "column", country AS value FROM bk
UNION SELECT 'hotel', hotel FROM bk UNION SELECT 'deposit_type', deposit_type FROM bk""")
def a_14(spark, sf):
    cols = ["country", "hotel", "deposit_type"]
    return A.uniques(bookings(spark, sf, *cols), cols)


NARROW = ["hotel", "is_canceled", "arrival_date_month", "adults", "children", "deposit_type"]


@query("a_15_duplicates", f"""
WITH {BK} SELECT {', '.join(NARROW)}, count(*) - 1 AS extra FROM bk GROUP BY ALL HAVING count(*) > 1""")
def a_15(spark, sf):
    return A.duplicates(bookings(spark, sf, *NARROW))


@query("a_15_duplicate_count", f"""
WITH {BK} SELECT sum(n - 1)::BIGINT AS duplicates FROM (SELECT count(*) AS n FROM bk GROUP BY {', '.join(NARROW)})""")
def a_15_count(spark, sf):
    return A.duplicate_count(bookings(spark, sf, *NARROW))


CORR = ["lead_time", "adr", "children", "adults", "stays_in_week_nights", "l_extendedprice", "net_price"]
CORR_SQL = " UNION ALL ".join(
    f"SELECT '{CORR[i]}' AS col_i, '{CORR[j]}' AS col_j, round(abs(corr({CORR[i]}, {CORR[j]})), 6) AS r FROM bk"
    for i in range(len(CORR)) for j in range(i))


@query("a_16_corr_matrix", f"WITH {BK} {CORR_SQL}")
def a_16(spark, sf):
    return rounded(A.corr_matrix(bookings(spark, sf, *CORR), CORR, absolute=True), 6)


@query("a_16_corr_tiled", f"WITH {BK} {CORR_SQL}")
def a_16_tiled(spark, sf):
    """The same by tiles of three columns and one tile a pass."""
    return rounded(corr_tiled(bookings(spark, sf, *CORR), CORR, absolute=True, tile=3, strip=2, task_bytes=1), 6)


@query("a_17_corr_with", f"WITH {BK}, b AS (SELECT *, (is_canceled = 'yes')::INTEGER AS y FROM bk) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, y), 6) AS r FROM b" for c in CORR))
def a_17(spark, sf):
    bk = bookings(spark, sf, *CORR, "is_canceled").withColumn("y", (F.col("is_canceled") == "yes").cast("int"))
    return rounded(A.corr_with(bk, "y", CORR), 6)


VAR = ["distance", "fare", "location", "trip_id"]


@query("a_18_top_variance", f"WITH {TX} SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(var_samp({c}), 4) AS variance FROM tx" for c in VAR) + ") ORDER BY variance DESC LIMIT 3")
def a_18(spark, sf):
    return rounded(A.top_variance(trips(spark, sf), VAR, 3))


@query("a_19_shape", f"WITH {BK} SELECT count(*) AS n_rows, 24 AS n_cols FROM bk")
def a_19(spark, sf):
    return A.shape(bookings(spark, sf))


@query("a_20_estimate_count", """
SELECT count(*) AS sampled, round(count(*) / 0.1)::BIGINT AS estimate FROM lineitem
WHERE ('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|42'), 1, 8))::BIGINT
  < 429496729""")
def a_20(spark, sf):
    return A.estimate_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 0.1)


@query("a_21_session_metrics", f"""
WITH {SS} SELECT date_trunc('week', session_start)::DATE AS period, round(avg(duration_minutes), 4) AS avg_duration,
  round(avg(converted::INTEGER), 6) AS conversion_rate, count(*) AS sessions FROM ss GROUP BY 1""")
def a_21(spark, sf):
    m = M.session_metrics(sessions(spark, sf), "week")
    return m.select("period", F.round("avg_duration", 4).alias("avg_duration"),
                    F.round("conversion_rate", 6).alias("conversion_rate"), "sessions")


@query("a_22_gold_roll_up", f"""
WITH {SS}, {CP}, e AS (
  SELECT date_trunc('week', session_start)::DATE AS period,
    avg(duration_minutes) FILTER (tier = 'premium') AS avg_engagement_premium,
    avg(duration_minutes) FILTER (tier = 'standard') AS avg_engagement_standard,
    count(DISTINCT user_id) FILTER (tier = 'premium') AS premium_customer_count
  FROM ss JOIN cp ON user_id = c_custkey GROUP BY 1),
v AS (SELECT date_trunc('week', ts)::DATE AS period, sum(value) AS total_revenue FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT period, round(avg_engagement_premium, 4) AS avg_engagement_premium, round(avg_engagement_standard, 4) AS avg_engagement_standard,
  premium_customer_count, round(total_revenue, 2) AS total_revenue FROM e LEFT JOIN v USING (period)""")
def a_22(spark, sf):
    sales = table(spark, sf, "events").filter("event_type = 'purchase'")
    gold = M.gold_monthly(sessions(spark, sf), profiles(spark, sf), sales,
                          key="c_custkey", sale_ts="ts", sale_value="value", unit="week")
    return rounded(gold).withColumn("total_revenue", F.round("total_revenue", 2))


@query("a_23_pred_distribution", f"""
WITH {QL} SELECT prediction, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4)::DOUBLE AS share FROM ql GROUP BY 1""")
def a_23(spark, sf):
    return rounded(A.pred_distribution(quality(spark, sf)))
