"""Queries: joins (J-01 to J-06), features (M-01 to M-11), evaluation (E-*), run tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions.scalars import month_no, pct_to_double, yes_no
from millrace.operators import features as M
from millrace.operators import metrics as E
from millrace.operators import models as ML
from millrace.operators import relational as J
from millrace.operators.medallion import cohort_by_period, diagnose
from millrace.operators.reshape import one_hot, ranked, trend
from millrace.plans.q_profile import CORR, rounded
from millrace.plans.registry import query
from millrace.plans.views import (
    BK, CP, KEY, LN, PL, QL, RUNS, SS, TX, bookings, loans, planted, profiles, quality, runs, sessions, table, trips,
)
from millrace.session import materialize

HASH = "('0x' || substr(md5({}), 1, 8))::BIGINT"


@query("j_01_side_by_side", f"""
WITH {BK}, c AS (SELECT arrival_date_month, count(*) AS city FROM bk WHERE hotel = 'City Hotel' GROUP BY 1),
r AS (SELECT arrival_date_month, count(*) AS resort FROM bk WHERE hotel = 'Resort Hotel' GROUP BY 1)
SELECT arrival_date_month, city, resort FROM c JOIN r USING (arrival_date_month)""")
def j_01(spark, sf):
    bk = bookings(spark, sf, "hotel", "arrival_date_month")
    counts = lambda h: bk.filter(F.col("hotel") == h).groupBy("arrival_date_month").count()
    return J.side_by_side(counts("City Hotel"), counts("Resort Hotel"), ["arrival_date_month"],
                          ({"count": "city"}, {"count": "resort"}))


COHORT = f"""{SS}, {CP}, cohort AS (
  SELECT date_trunc('week', session_start)::DATE AS period, tier, avg(duration_minutes) AS avg_duration,
    avg(converted::INTEGER) AS conversion_rate, count(*) AS sessions
  FROM ss JOIN cp ON user_id = c_custkey GROUP BY 1, 2)"""


@query("j_02_cohort_by_period", f"""
WITH {COHORT} SELECT period, tier, round(avg_duration, 4) AS avg_duration, round(conversion_rate, 4) AS conversion_rate, sessions
FROM cohort WHERE tier = 'premium'""")
def j_02(spark, sf):
    return rounded(cohort_by_period(
        sessions(spark, sf), profiles(spark, sf), key="c_custkey", only="premium", unit="week"))


@query("entry_weekly_trend", f"""
WITH {COHORT}, l AS (SELECT *, lag(avg_duration) OVER (PARTITION BY tier ORDER BY period) AS p FROM cohort)
SELECT period, tier, round(avg_duration, 4) AS avg_duration, round(conversion_rate, 4) AS conversion_rate, sessions,
  round(p, 4) AS from_value, round(avg_duration, 4) AS to_value, CASE WHEN avg_duration > p THEN 'increased' ELSE 'decreased' END AS trend,
  round(abs((avg_duration - p) / p * 100), 1) AS percentage_change, avg_duration = p AS unchanged
FROM l WHERE p IS NOT NULL""")
def entry_weekly_trend(spark, sf):
    cohort = cohort_by_period(sessions(spark, sf), profiles(spark, sf), key="c_custkey", unit="week")
    return rounded(trend(cohort, ["tier"], "period", "avg_duration"))


@query("j_03_training_set", f"""
WITH {LN}, m AS (SELECT o_custkey AS member_id, count(*) AS n_loans, round(avg(o_totalprice), 4) AS avg_loan FROM orders
  WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT loan_id, loan_amnt, n_loans, avg_loan, c_acctbal, c_mktsegment, loan_status = 'F' AS defaulted
FROM ln LEFT JOIN m USING (member_id) LEFT JOIN customer ON c_custkey = member_id WHERE loan_status IS NOT NULL""")
def j_03(spark, sf):
    labels = loans(spark, sf).select("loan_id", "member_id", "loan_amnt", (F.col("loan_status") == "F").alias("defaulted"))
    member = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("member_id")).agg(
        F.count("*").alias("n_loans"), F.round(F.avg("o_totalprice"), 4).alias("avg_loan"))
    customer = table(spark, sf, "customer").withColumnRenamed("c_custkey", "member_id")
    return J.training_set(
        labels.dropna(subset=["defaulted"]),
        [(member, ["member_id"], ["n_loans", "avg_loan"]), (customer, ["member_id"], ["c_acctbal", "c_mktsegment"])],
        "defaulted", exclude=["member_id"])


@query("j_04_upsert", f"""
WITH {LN}, t AS (SELECT loan_id, loan_amnt, dti FROM ln WHERE loan_status IS NOT NULL),
s AS (SELECT loan_id, dti * 2 AS dti, loan_status FROM ln WHERE dti IS NULL OR dti >= 10)
SELECT coalesce(t.loan_id, s.loan_id) AS loan_id, t.loan_amnt, CASE WHEN s.loan_id IS NOT NULL THEN s.dti ELSE t.dti END AS dti, s.loan_status
FROM t FULL JOIN s ON t.loan_id = s.loan_id""")
def j_04(spark, sf):
    ln = loans(spark, sf)
    target = ln.filter("loan_status IS NOT NULL").select("loan_id", "loan_amnt", "dti")
    source = ln.filter("dti IS NULL OR dti >= 10").select("loan_id", (F.col("dti") * 2).alias("dti"), "loan_status")
    return J.upsert(target, source, ["loan_id"])


@query("j_05_compare_predictions", f"""
WITH {QL} SELECT doc_id, prediction AS prediction_a, other AS prediction_b, prediction <> other AS mismatch FROM ql""")
def j_05(spark, sf):
    ql = quality(spark, sf)
    a, b = ql.select("doc_id", "prediction"), ql.select("doc_id", F.col("other").alias("prediction"))
    return J.compare_predictions(a, b, ["doc_id"])


@query("m_01_label_encode", f"""
WITH {BK}, d AS (SELECT country, (dense_rank() OVER (ORDER BY country) - 1)::BIGINT AS code FROM (SELECT DISTINCT country FROM bk WHERE country IS NOT NULL))
SELECT bk.country, d.code, count(*) AS n FROM bk LEFT JOIN d ON bk.country = d.country GROUP BY 1, 2""")
def m_01(spark, sf):
    coded = M.label_encode(bookings(spark, sf, "country"), "country", "code")
    return coded.groupBy("country", "code").agg(F.count("*").alias("n"))


@query("m_01_label_encode_wide", """
SELECT c_name, (dense_rank() OVER (ORDER BY c_name) - 1)::BIGINT AS code FROM customer""")
def m_01_wide(spark, sf):
    return M.label_encode(table(spark, sf, "customer").select("c_name"), "c_name", "code")


@query("m_02_index_categories", f"""
WITH {TX}, d AS (SELECT payment_type, (row_number() OVER (ORDER BY count(*) DESC, payment_type) - 1)::DOUBLE AS payment_type_index FROM tx GROUP BY 1)
SELECT trip_id, payment_type_index FROM tx JOIN d USING (payment_type)""")
def m_02(spark, sf):
    tx = trips(spark, sf).select("trip_id", "payment_type")
    return M.index_categories(tx, ["payment_type"]).transform(tx).select("trip_id", "payment_type_index")


def _indexed(spark, sf):
    tx = trips(spark, sf).select("trip_id", "payment_type", F.col("location").cast("string").alias("location"), "distance", "fare", "pickup")
    return M.index_categories(tx, ["payment_type", "location"]).transform(tx)


@query("m_03_encode_categories", f"""
WITH {TX}, d AS (SELECT payment_type, row_number() OVER (ORDER BY count(*) DESC, payment_type) - 1 AS i FROM tx GROUP BY 1)
SELECT trip_id, i::INTEGER AS hot, 1.0::DOUBLE AS total, (SELECT count(*) FROM d)::INTEGER + 1 AS width FROM tx JOIN d USING (payment_type)""")
def m_03(spark, sf):
    df = _indexed(spark, sf)
    encoder = M.encode_categories(df, ["payment_type_index", "location_index"])
    v = vector_to_array("payment_type_index_vec")
    return encoder.transform(df).select(
        "trip_id", (F.array_position(v, 1.0) - 1).cast("int").alias("hot"),
        F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("total"), F.size(v).alias("width"))


def _features(spark, sf):
    """(trip_id, features, label): distance, hour and categories; the label is the fare."""
    df = _indexed(spark, sf).withColumn("hour", F.hour("pickup").cast("double"))
    df = M.encode_categories(df, ["payment_type_index", "location_index"]).transform(df)
    names = ["distance", "hour", "payment_type_index_vec", "location_index_vec"]
    return M.finalise(M.assemble(df, names), "fare", keep=["trip_id"])


@query("m_04_assemble", f"""
WITH {TX} SELECT trip_id, distance AS f0, hour(pickup)::DOUBLE AS f1, 2 AS width FROM tx WHERE distance IS NOT NULL""")
def m_04(spark, sf):
    tx = trips(spark, sf).withColumn("hour", F.hour("pickup"))
    v = vector_to_array("features")
    return M.assemble(tx, ["distance", "hour"]).select("trip_id", v[0].alias("f0"), v[1].alias("f1"), F.size(v).alias("width"))


@query("m_05_finalise", f"""
WITH {TX}, w AS (SELECT 2 + count(DISTINCT payment_type) + 1 + count(DISTINCT location) + 1 AS width FROM tx)
SELECT trip_id, round(fare, 4) AS label, (SELECT width FROM w)::INTEGER AS width FROM tx WHERE distance IS NOT NULL""")
def m_05(spark, sf):
    return _features(spark, sf).select(
        "trip_id", F.round("label", 4).alias("label"), F.size(vector_to_array("features")).alias("width"))


@query("m_06_impute_mean", f"""
WITH {LN}, r AS (SELECT loan_id, try_cast(replace(trim(int_rate), '%', '') AS DOUBLE) AS rate, dti FROM ln)
SELECT loan_id, round(coalesce(rate, (SELECT avg(rate) FROM r)), 6) AS rate, round(coalesce(dti::DOUBLE, (SELECT avg(dti) FROM r)), 6) AS dti FROM r""")
def m_06(spark, sf):
    r = loans(spark, sf).select("loan_id", pct_to_double("int_rate").alias("rate"), "dti", F.lit(None).cast("double").alias("nothing"))
    return rounded(M.MeanImputer.fit(r, ["rate", "dti", "nothing"]).transform(r), 6)


SPLIT = HASH.format("trip_id || '|42'")


@query("m_07_standard_scale", f"""
WITH {TX}, t AS (SELECT *, 7 AS same FROM tx), f AS (SELECT avg(distance) AS md, stddev_pop(distance) AS sd, avg(fare) AS mf, stddev_pop(fare) AS sf
  FROM t WHERE {SPLIT} < 3435973836)
SELECT trip_id, round((distance - md) / sd, 6) AS distance, round((fare - mf) / sf, 6) AS fare, 0.0::DOUBLE AS same
FROM t, f WHERE NOT {SPLIT} < 3435973836""")
def m_07(spark, sf):
    tx = trips(spark, sf).select("trip_id", "distance", "fare", F.lit(7).alias("same"))
    train, test = M.split(tx, ["trip_id"], 0.8)
    return rounded(M.StandardScale.fit(train, ["distance", "fare", "same"]).transform(test), 6)


LINE_HASH = HASH.format("l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|42'")


@query("m_08_split", f"""
SELECT CASE WHEN {LINE_HASH} < 3435973836 THEN 'train' ELSE 'test' END AS part, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1""")
def m_08(spark, sf):
    train, test = M.split(table(spark, sf, "lineitem"), KEY, 0.8)
    total = lambda df, part: df.agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")).withColumn("part", F.lit(part))
    return total(train, "train").unionByName(total(test, "test"))


@query("m_09_sample", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE {LINE_HASH} < 858993459""")
def m_09(spark, sf):
    return M.sample(table(spark, sf, "lineitem"), KEY, 0.2).select(*KEY, "l_quantity")


def _encoded(spark, sf):
    """The booking table fully numeric: codes for country and hotel, 0/1 columns for the rest.

    The joined bookings are stored first, because the encoders and the
    correlations read them several times.
    """
    cols = [*CORR, "is_canceled", "arrival_date_month", "country", "hotel", "deposit_type", "reservation_status"]
    bk = materialize(bookings(spark, sf, *cols), "bookings").fillna({"children": 0.0, "country": "OTHER"})
    bk = bk.withColumns({"is_canceled": yes_no("is_canceled"), "arrival_date_month": month_no("arrival_date_month")})
    bk = M.label_encode_all(bk, ["country", "hotel"])
    return one_hot(bk, ["deposit_type", "reservation_status"])


def _prune_sql() -> str:
    dep = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    base = [*CORR, "is_canceled", "arrival_date_month", "country", "hotel"]
    cols = [*base, *[f"deposit_type_{d}" for d in dep], *[f"reservation_status_{s}" for s in "FOP"]]
    enc = f"""WITH {BK}, filled AS (SELECT *, coalesce(country, 'OTHER') AS land FROM bk),
lands AS (SELECT land, dense_rank() OVER (ORDER BY land) - 1 AS land_no FROM (SELECT DISTINCT land FROM filled)),
enc AS (SELECT lead_time, adr, coalesce(children, 0) AS children, adults, stays_in_week_nights, l_extendedprice, net_price,
  (is_canceled = 'yes')::INTEGER AS is_canceled, month(strptime(arrival_date_month, '%B')) AS arrival_date_month,
  land_no AS country, (hotel = 'Resort Hotel')::INTEGER AS hotel, """
    enc += ", ".join([f"(deposit_type = '{d}')::INTEGER AS \"deposit_type_{d}\"" for d in dep]
                     + [f"(reservation_status = '{s}')::INTEGER AS \"reservation_status_{s}\"" for s in "FOP"])
    enc += " FROM filled JOIN lands USING (land))\n"
    parts = [f"SELECT '{cols[i]}' AS \"column\", corr(\"{cols[i]}\", \"{cols[j]}\") AS r FROM enc"
             for i in range(len(cols)) for j in range(i)]
    return enc + "SELECT DISTINCT \"column\" FROM (" + " UNION ALL ".join(parts) + ") WHERE abs(r) >= 0.85"


@query("m_10_prune_correlated", _prune_sql())
def m_10(spark, sf):
    enc = _encoded(spark, sf)
    return M.prune_list(enc, enc.columns)


@query("m_11_balanced_weights", """
SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels) / (2.0 * count(*)), 6)::DOUBLE AS weight FROM labels GROUP BY 1""")
def m_11(spark, sf):
    return rounded(M.balanced_weights(table(spark, sf, "labels"), "quality"), 6)


@query("m_22_leaderboard", f"""
WITH {RUNS} SELECT name, version, accuracy, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY accuracy DESC, version)::INTEGER AS rank FROM runs) WHERE rank <= 3""")
def m_22(spark, sf):
    return ranked(runs(spark, sf).select("name", "version", "accuracy"), "name", "accuracy", "version", k=3)


@query("m_23_promote", f"""
WITH {RUNS}, champ AS (SELECT name, version FROM runs QUALIFY row_number() OVER (PARTITION BY name ORDER BY accuracy DESC, version) = 1)
SELECT name, CASE WHEN name = 'click' THEN 2 ELSE version END AS version, accuracy, rmse, run_id FROM (
  SELECT r.* FROM runs r JOIN champ c ON r.name = c.name AND r.version = CASE WHEN r.name = 'click' THEN 2 ELSE c.version END)""")
def m_23(spark, sf):
    r = runs(spark, sf)
    first = r.groupBy("name").agg(F.min("version").alias("version")).select("name", F.lit("champion").alias("alias"), "version")
    aliases = ML.promote(ML.promote_best(first, r, "accuracy"), "click", 2)
    return ML.resolve(aliases, r)


@query("e_01_accuracy", f"WITH {QL} SELECT round(avg((label = prediction)::INTEGER), 6) AS accuracy FROM ql")
def e_01(spark, sf):
    return rounded(E.accuracy(quality(spark, sf)), 6)


@query("e_02_confusion", f"""
WITH {QL}, g AS (SELECT * FROM (VALUES (0), (1), (2)) a(label), (VALUES (0), (1), (2)) b(prediction)),
c AS (SELECT label, prediction, count(*) AS n FROM ql GROUP BY 1, 2)
SELECT g.label, g.prediction, coalesce(n, 0) AS n FROM g LEFT JOIN c ON g.label = c.label AND g.prediction = c.prediction""")
def e_02(spark, sf):
    return E.confusion(quality(spark, sf), classes=[0, 1, 2])


@query("e_03_class_report", f"""
WITH {QL}, k AS (SELECT unnest([0, 1, 2]) AS c), s AS (
  SELECT c, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted
  FROM k, ql GROUP BY 1),
p AS (SELECT c::VARCHAR AS class, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
  CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
  CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END AS f1, support FROM s)
SELECT class, round(precision::DOUBLE, 6) AS precision, round(recall::DOUBLE, 6) AS recall, round(f1::DOUBLE, 6) AS f1, support FROM p
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM p
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM p""")
def e_03(spark, sf):
    return rounded(E.class_report(quality(spark, sf), classes=[0, 1, 2]), 6)


STEPS = """steps AS (SELECT score::DOUBLE AS score, count(*) FILTER (label = 1) AS tp, count(*) FILTER (label <> 1) AS fp FROM {0} GROUP BY 1),
cum AS (SELECT score, tp AS own_tp, fp AS own_fp, sum(tp) OVER w AS tp, sum(fp) OVER w AS fp, sum(tp) OVER () AS p, sum(fp) OVER () AS n
  FROM steps WINDOW w AS (ORDER BY score DESC))"""


@query("e_04_roc_points", f"""
WITH {QL}, {STEPS.format('ql')} SELECT score, round((fp / n)::DOUBLE, 6) AS fpr, round((tp / p)::DOUBLE, 6) AS tpr FROM cum""")
def e_04(spark, sf):
    return rounded(E.roc_points(quality(spark, sf)), 6)


@query("e_04_roc_auc", f"""
WITH {PL}, {STEPS.format('pl')} SELECT round((sum(own_fp * (tp - own_tp + own_tp / 2.0)) / max(p * n))::DOUBLE, 6) AS auc FROM cum""")
def e_04_auc(spark, sf):
    return rounded(E.roc_auc(planted(spark, sf)), 6)


@query("e_05_pr_points", f"""
WITH {QL}, {STEPS.format('ql')} SELECT score, round((tp / (tp + fp))::DOUBLE, 6) AS precision, round((tp / p)::DOUBLE, 6) AS recall FROM cum
UNION ALL SELECT NULL, 1.0, 0.0""")
def e_05(spark, sf):
    return rounded(E.pr_points(quality(spark, sf)), 6)


@query("e_05_pr_auc", f"""
WITH {PL}, {STEPS.format('pl')}, pts AS (SELECT score, tp / (tp + fp) AS precision, tp / p AS recall FROM cum),
l AS (SELECT *, lag(precision, 1, 1.0) OVER (ORDER BY score DESC) AS p0, lag(recall, 1, 0.0) OVER (ORDER BY score DESC) AS r0 FROM pts)
SELECT round(sum((recall - r0) * (precision + p0) / 2)::DOUBLE, 6) AS pr_auc FROM l""")
def e_05_auc(spark, sf):
    return rounded(E.pr_auc(planted(spark, sf)), 6)


@query("e_06_rmse", f"WITH {TX} SELECT round(sqrt(avg(pow(fare - (1.9 * distance + 12), 2))), 6) AS rmse FROM tx WHERE distance IS NOT NULL")
def e_06(spark, sf):
    tx = trips(spark, sf).select(F.col("fare").alias("label"), (1.9 * F.col("distance") + 12).alias("prediction"))
    return rounded(E.rmse(tx), 6)


@query("d_03_sessionize", f"""
WITH {SS} SELECT user_id, session_no, session_start::VARCHAR AS session_start, session_end::VARCHAR AS session_end,
  round(duration_minutes * 60e6)::BIGINT AS duration_us, events, converted FROM ss""")
def d_03(spark, sf):
    # Both engines print microseconds without trailing zeros.
    return sessions(spark, sf).withColumns({
        "session_start": F.col("session_start").cast("string"), "session_end": F.col("session_end").cast("string"),
        "duration_us": F.round(F.col("duration_minutes") * 60e6).cast("long")}).drop("duration_minutes")


BEFORE, AFTER = "session_start < TIMESTAMP '2024-01-15'", "session_start >= TIMESTAMP '2024-01-15'"


@query("d_05_diagnose", f"""
WITH {SS}, {CP}, p AS (SELECT tier, session_start >= TIMESTAMP '2024-01-15' AS late, avg(duration_minutes) AS avg_duration,
  avg(converted::INTEGER) AS conversion_rate, count(*)::DOUBLE AS sessions FROM ss JOIN cp ON user_id = c_custkey GROUP BY 1, 2),
m AS (SELECT tier, late, 'avg_duration' AS metric, avg_duration AS v FROM p UNION ALL SELECT tier, late, 'conversion_rate', conversion_rate FROM p
  UNION ALL SELECT tier, late, 'sessions', sessions FROM p),
w AS (SELECT tier, metric, max(v) FILTER (NOT late) AS a, max(v) FILTER (late) AS b FROM m GROUP BY 1, 2)
SELECT tier, metric, round(a, 6) AS from_value, round(b, 6) AS to_value, CASE WHEN b > a THEN 'increased' ELSE 'decreased' END AS trend,
  round(abs((b - a) / a * 100), 1) AS percentage_change, a = b AS unchanged FROM w""")
def d_05(spark, sf):
    before, after = (F.expr(p.replace("TIMESTAMP", "TIMESTAMP_NTZ")) for p in (BEFORE, AFTER))
    return rounded(diagnose(sessions(spark, sf), profiles(spark, sf), before, after, key="c_custkey"), 6)
