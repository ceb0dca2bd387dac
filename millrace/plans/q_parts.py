"""Queries: profiles merged from stored parts (A-07, A-10, A-13 over growing tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import part_profiles as P
from millrace.plans.q_profile import rounded
from millrace.plans.registry import query
from millrace.plans.views import table
from millrace.session import scratch_path

COLS = ["l_quantity", "l_extendedprice", "l_suppkey", "l_returnflag"]
NUM = COLS[:3]
RANGE = "year BETWEEN 1993 AND 1996"


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", *COLS, F.year("l_shipdate").alias("year"))


def _store(spark, sf, keys=None):
    """The years as parts: two added one by one, then all that are missing, then one of them again."""
    lines, path = _lines(spark, sf), scratch_path(spark, "parts")
    read = lambda: P.read_parts(spark, path, "year", "int", "l_returnflag string" if keys else "")
    cols = [c for c in COLS if c not in (keys or [])]
    for year in (1994, 1995):
        P.add_part(lines, path, "year", year, cols, keys)
    P.add_missing_parts(lines, path, "year", cols, keys, stored=read())
    P.add_part(lines, path, "year", 1996, cols, keys)
    return lines, read()


@query("a_10_describe_parts", "WITH l AS (SELECT *, year(l_shipdate) AS year FROM lineitem) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS known, round(avg({c}), 4)::DOUBLE AS mean, round(stddev_samp({c}), 4) AS std,
  min({c})::DOUBLE AS low, max({c})::DOUBLE AS high FROM l WHERE {RANGE}""" for c in NUM))
def a_10_parts(spark, sf):
    """Four years out of the stored parts; the exact figures."""
    _, parts = _store(spark, sf)
    found = P.describe_parts(parts.filter(RANGE)).filter("mean IS NOT NULL")
    return rounded(found.select("column", "rows", "known", "mean", "std", "low", "high"))


@query("a_13_nunique_parts", "WITH l AS (SELECT *, year(l_shipdate) AS year FROM lineitem) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct, TRUE AS near FROM l WHERE {RANGE}""" for c in COLS))
def a_13_parts(spark, sf):
    """Exact distinct counts, and whether the stored sketches come within 5 % of them (or 1)."""
    lines, parts = _store(spark, sf)
    exact = lines.filter(RANGE).agg(*[F.count_distinct(c).alias(c) for c in COLS]).unpivot([], COLS, "column", "n_distinct")
    about = P.describe_parts(parts.filter(RANGE)).select("column", F.col("n_distinct").alias("about"))
    near = F.abs(F.col("about") - F.col("n_distinct")) <= F.greatest(F.col("n_distinct") * 0.05, F.lit(1))
    return exact.join(about, "column").select("column", "n_distinct", near.alias("near"))


@query("a_07_box_parts", f"""
SELECT l_returnflag, min(l_quantity)::DOUBLE AS low, max(l_quantity)::DOUBLE AS high, count(*) AS n, TRUE AS near
FROM (SELECT *, year(l_shipdate) AS year FROM lineitem) WHERE {RANGE} GROUP BY 1""")
def a_07_parts(spark, sf):
    """Box numbers per return flag; whether each quartile's true rank is within 3 % of what it should be."""
    lines, parts = _store(spark, sf, ["l_returnflag"])
    box = P.box_parts(parts.filter(RANGE), "l_quantity", ["l_returnflag"])
    rows = lines.filter(RANGE).join(F.broadcast(box), "l_returnflag")
    hits = [F.avg((F.col("l_quantity") < F.col(q)).cast("double")) <= p + 0.03 for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
    hits += [F.avg((F.col("l_quantity") <= F.col(q)).cast("double")) >= p - 0.03 for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
    near = hits[0]
    for h in hits[1:]:
        near = near & h
    return rows.groupBy("l_returnflag").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.count("*").alias("n"), near.alias("near"))
