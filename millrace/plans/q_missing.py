"""Queries: NaN as a missing value, and wide categories in sparse form (A-05, A-10 to A-12, A-17, A-18, M-06, M-07, M-11, R-02, U-03)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import features as M
from millrace.operators import profile as A
from millrace.operators import reshape as R
from millrace.plans.q_profile import rounded
from millrace.plans.registry import query
from millrace.plans.views import table

# Line items of which some discounts, taxes and quantities are null and some NaN. SQL has null for both.
_GAPS = {
    "quantity": "CASE WHEN l_linenumber = 1 THEN CAST('NaN' AS DOUBLE) WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END",
    "discount": "CASE WHEN l_partkey % 7 = 0 THEN CAST('NaN' AS FLOAT) ELSE CAST(l_discount AS FLOAT) END",
    "price": "l_extendedprice",
    "none": "CAST('NaN' AS DOUBLE)",
}
GAPS = """gaps AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber > 2 THEN l_quantity END AS quantity,
  CASE WHEN l_partkey % 7 <> 0 THEN l_discount::FLOAT::DOUBLE END AS discount, l_extendedprice AS price, NULL::DOUBLE AS "none" FROM lineitem)"""
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NUM = ["quantity", "discount", "price"]


def gaps(spark, sf):
    return table(spark, sf, "lineitem").select(*KEY, *[F.expr(e).alias(n) for n, e in _GAPS.items()])


@query("a_10_describe_nan", f"WITH {GAPS} " + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 6) AS min,
  round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3, round(max({c}), 6) AS max FROM gaps""" for c in NUM))
def a_10_nan(spark, sf):
    stats = A.describe(gaps(spark, sf).select(*NUM, "none"), [*NUM, "none"])
    return rounded(stats, 6).withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query("a_11_info_nan", f"WITH {GAPS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count("{c}") AS non_null, '{k}' AS type FROM gaps""" for c, k in zip(_GAPS, ("double", "float", "double", "double"))))
def a_11_nan(spark, sf):
    return A.info(gaps(spark, sf).select(*_GAPS))


@query("a_12_missing_nan", f"WITH {GAPS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS total, round((count(*) - count("{c}")) * 100.0 / count(*), 4)::DOUBLE AS pct FROM gaps"""
    for c in ("quantity", "discount", "none")))
def a_12_nan(spark, sf):
    return rounded(A.missing(gaps(spark, sf)))


@query("a_17_corr_with_nan", f"WITH {GAPS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, price), 6) AS r FROM gaps" for c in ("quantity", "discount")))
def a_17_nan(spark, sf):
    return rounded(A.corr_with(gaps(spark, sf), "price", ["quantity", "discount"]), 6)


@query("a_18_top_variance_nan", f"WITH {GAPS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(var_samp({c}), 4) AS variance FROM gaps" for c in ("quantity", "price")))
def a_18_nan(spark, sf):
    return rounded(A.top_variance(gaps(spark, sf), [*NUM, "none"], 2))


@query("u_03_select_features_nan", f"WITH {GAPS}, f AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", var_samp({c}) AS v, abs(corr({c}, price * 2)) AS r FROM gaps" for c in NUM) + """)
SELECT "column" FROM f QUALIFY row_number() OVER (ORDER BY v DESC) <= 2 OR row_number() OVER (ORDER BY r DESC) <= 2""")
def u_03_nan(spark, sf):
    return R.select_features(gaps(spark, sf).withColumn("y", F.col("price") * 2), "y", ["quantity", "discount", "none", "price"], 2)


@query("m_06_impute_mean_nan", f"""WITH {GAPS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price,
  round(coalesce(quantity, (SELECT avg(quantity) FROM gaps)), 6) AS quantity, round(coalesce(discount, (SELECT avg(discount) FROM gaps)), 6) AS discount FROM gaps""")
def m_06_nan(spark, sf):
    rows = gaps(spark, sf)
    return rounded(M.MeanImputer.fit(rows, ["quantity", "discount", "none"]).transform(rows), 6)


@query("m_07_standard_scale_nan", f"""WITH {GAPS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round((quantity - avg(quantity) OVER ()) / stddev_pop(quantity) OVER (), 6) AS quantity,
  round((discount - avg(discount) OVER ()) / stddev_pop(discount) OVER (), 6) AS discount FROM gaps""")
def m_07_nan(spark, sf):
    rows = gaps(spark, sf).select(*KEY, "quantity", "discount")
    return rounded(M.StandardScale.fit(rows, ["quantity", "discount"]).transform(rows), 6)


@query("a_05_crosstab_sparse", """
WITH codes AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS code FROM (SELECT DISTINCT l_partkey FROM lineitem)),
pairs AS (SELECT l_returnflag, code, count(*) AS n FROM lineitem JOIN codes USING (l_partkey) GROUP BY 1, 2)
SELECT l_returnflag, code // 64 AS block, string_agg(code || ':' || n, ',' ORDER BY code) AS cells, sum(n)::BIGINT AS total FROM pairs GROUP BY 1, 2""")
def a_05_sparse(spark, sf):
    """Return flag by part, one sparse row for 64 parts; as text, so that engines can be compared."""
    rows, _ = A.crosstab_sparse(table(spark, sf, "lineitem").select("l_returnflag", "l_partkey"), "l_returnflag", "l_partkey", span=64)
    cells = F.array_join(F.zip_with("codes", "counts", lambda c, n: F.concat_ws(":", c, n)), ",")
    return rows.select("l_returnflag", "block", cells.alias("cells"), "total")


@query("a_05_crosstab_margins", """
SELECT l_returnflag, l_suppkey, count(*) AS n, CASE grouping(l_returnflag, l_suppkey) WHEN 0 THEN 'none' WHEN 1 THEN 'a' WHEN 2 THEN 'b' ELSE 'all' END AS margin
FROM lineitem GROUP BY CUBE (l_returnflag, l_suppkey)""")
def a_05_margins(spark, sf):
    return A.crosstab_long(table(spark, sf, "lineitem").select("l_returnflag", "l_suppkey"), "l_returnflag", "l_suppkey")


@query("r_02_one_hot_sparse", """
WITH p AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS i FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey % 5 <> 0)),
f AS (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 + (SELECT count(*) FROM p) AS j FROM (SELECT DISTINCT l_returnflag FROM lineitem))
SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(i || ',', '') || j AS ones
FROM lineitem LEFT JOIN p USING (l_partkey) JOIN f USING (l_returnflag)""")
def r_02_sparse(spark, sf):
    """Part (some unknown) and return flag as one sparse vector; its places as text."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.expr("CASE WHEN l_partkey % 5 <> 0 THEN l_partkey END").alias("part"), "l_returnflag")
    vectors, _ = R.one_hot_sparse(rows, ["part", "l_returnflag"])
    return vectors.select("l_orderkey", "l_linenumber", "l_suppkey", F.array_join(F.unwrap_udt("features")["indices"], ",").alias("ones"))


@query("m_11_class_weight_many", """
WITH n AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, round((SELECT sum(n) FROM n) / ((SELECT count(*) FROM n)::DOUBLE * n), 6)::DOUBLE AS weight
FROM lineitem JOIN n USING (l_partkey)""")
def m_11_many(spark, sf):
    """Balanced weights where the classes are the parts."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return rounded(M.with_class_weight(rows, "l_partkey"), 6)
