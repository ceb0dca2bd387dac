"""Aggregates, quantiles, reshaping and their corners."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import profile as A
from millrace.operators import ranking as K
from millrace.operators import reshape as R
from tests.conftest import rows_of

FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_value_counts_drop_nulls(frame):
    df = frame("v string", ("a",), ("b",), ("a",), (None,))
    assert [tuple(r) for r in A.value_counts(df, "v").collect()] == [("a", 2), ("b", 1)]
    assert rows_of(A.value_pct(df, "v"), "v", "pct") == [("a", pytest.approx(200 / 3)), ("b", pytest.approx(100 / 3))]


def test_group_count_counts_known_values(frame):
    df = frame("k string, j int, v int", ("a", 1, 1), ("a", 1, None), (None, 1, 1))
    assert rows_of(A.group_count(df, ["k", "j"], "v")) == [("a", 1, 1)]


def test_crosstab_and_rate(frame):
    df = frame("a string, y string", ("x", "yes"), ("x", "no"), ("z", "no"))
    assert rows_of(A.crosstab(df, "a", "y")) == [("x", 1, 1), ("z", 1, 0)]
    assert rows_of(A.rate(df, F.col("y") == "yes", ["a"])) == [("x", 50.0), ("z", 0.0)]


def test_crosstab_of_many_values(spark, frame):
    df = frame("a string, v int", *[("x", i) for i in range(5)], ("x", 3), ("y", 4), ("x", None), (None, 2))
    rows, codes = A.crosstab_sparse(df, "a", "v", span=3)
    assert rows_of(codes) == [(i, i) for i in range(5)]
    want = [("x", 0, [0, 1, 2], [1, 1, 1], 3), ("x", 1, [3, 4], [2, 1], 3), ("y", 1, [4], [1], 1)]
    assert rows_of(rows) == want
    assert A.domain(df, "v", limit=4) is None
    assert A.crosstab(df, "a", "v", limit=4).columns == ["a", "block", "codes", "counts", "total"]
    assert [r for r in rows_of(A.crosstab_long(df, "a", "v")) if r[3] != "none"] == [
        (None, None, 7, "all"), *[(None, i, n, "b") for i, n in enumerate([1, 1, 1, 2, 2])], ("x", None, 6, "a"), ("y", None, 1, "a")]
    wide = spark.range(100_000).selectExpr("id % 3 as a", "id as v")
    rows, codes = A.crosstab_sparse(wide, "a", "v")
    assert codes.count() == 100_000 and rows.agg(F.sum("total"), F.max(F.size("codes"))).first()[0] == 100_000
    empty = df.limit(0)
    assert not A.crosstab_sparse(empty, "a", "v")[0].count() and not A.crosstab_long(empty, "a", "v").filter("n > 0").count()


def test_nan_is_missing(spark):
    """The figures of pandas, for which NaN and None are one."""
    nan = float("nan")
    rows = [(1.0, nan, 2.0, 1.0), (2.0, 3.0, None, 2.5), (3.0, nan, 7.0, 2.0), (nan, 5.0, 1.0, 4.0), (None, 9.0, 4.0, 3.5)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").withColumn("f", F.col("b").cast("float"))
    pdf = df.toPandas().astype(float)
    cols = ["a", "b", "c", "f"]
    told = {r["column"]: r for r in A.describe(df, cols).collect()}
    for c, want in pdf[cols].describe().items():
        assert [told[c][n] for n in ("count", "mean", "std", "min", "q1", "median", "q3", "max")] == pytest.approx(want.tolist())
    assert {r["column"]: r["total"] for r in A.missing(df).collect()} == {c: n for c, n in pdf.isna().sum().items() if n}
    assert {r["column"]: r["non_null"] for r in A.info(df).collect()} == pdf.count().to_dict()
    assert {r["column"]: r["r"] for r in A.corr_with(df, "y", cols).collect()} == pytest.approx({c: pdf[c].corr(pdf["y"]) for c in cols})
    variances = pdf[cols].var().sort_values(ascending=False, kind="stable")
    assert [r["variance"] for r in A.top_variance(df, cols, 3).collect()] == pytest.approx(variances[:3].tolist())


def test_histogram_edges_and_constant(frame):
    df = frame("v double", *[(float(i),) for i in range(11)])
    assert rows_of(A.histogram(df, "v", 5), "bin", "n") == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]
    flat = A.histogram(frame("v double", (3.0,), (3.0,)), "v", 4)
    assert sum(r.n for r in flat.collect()) == 2


def test_density_integrates_to_one(frame):
    rng = np.random.default_rng(1)
    df = frame("v double", *[(float(x),) for x in rng.normal(size=300)])
    rows = A.density(df, "v", 64).orderBy("point").collect()
    assert np.trapezoid([r.density for r in rows], [r.x for r in rows]) == pytest.approx(1, abs=0.02)


def test_missing_and_info(frame):
    df = frame("a int, b string, c int", (1, None, None), (2, "x", None))
    assert [tuple(r) for r in A.missing(df).collect()] == [("c", 2, 100.0), ("b", 1, 50.0)]
    assert rows_of(A.info(df), "column", "non_null", "type") == [("a", 2, "int"), ("b", 1, "string"), ("c", 0, "int")]


def test_duplicates_treat_nulls_as_equal(frame):
    df = frame("a int, b string", (1, None), (1, None), (1, None), (2, "x"))
    assert rows_of(A.duplicates(df)) == [(1, None, 2)]
    assert A.duplicate_count(df).first()[0] == 2
    assert R.dedupe(df).count() == 2
    assert A.duplicate_count(df.filter("a = 2")).first()[0] == 0


def test_corr_matrix_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(200, 4)), columns=list("abcd"))
    pdf["b"] = pdf.a * 2 + rng.normal(size=200) * 0.1 + 1e6
    pdf.loc[::7, "c"] = None
    pdf["e"] = 5.0
    want = pdf.corr()
    df = spark.createDataFrame([tuple(None if x != x else float(x) for x in r) for r in pdf.itertuples(index=False)],
                               "a double, b double, c double, d double, e double")
    got = {(r.col_i, r.col_j): r.r for r in A.corr_matrix(df.repartition(5), list("abcde")).collect()}
    assert len(got) == 10
    for (i, j), r in got.items():
        if "e" in (i, j):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[i, j], abs=1e-9)
    assert {r["column"]: r.r for r in A.corr_with(df, "a", ["b", "e"]).collect()}["e"] is None


def test_describe_against_pandas(spark):
    rng = np.random.default_rng(5)
    values = [float(v) for v in rng.gamma(2, 10, 500)]
    df = spark.createDataFrame([(v, int(v) if i % 9 else None) for i, v in enumerate(values)], "x double, n int")
    want = df.toPandas().describe()
    for r in A.describe(df.repartition(4), ["x", "n"]).collect():
        have = [r["count"], r["mean"], r["std"], r["min"], r["q1"], r["median"], r["q3"], r["max"]]
        assert have == pytest.approx(list(want[r["column"]]), rel=1e-9)


@pytest.mark.parametrize("accuracy, buckets", [(10_000, 64), (20, 4), (50, 1)])
def test_quantiles_exact_for_skewed_groups(spark, accuracy, buckets):
    rng = np.random.default_rng(7)
    rows = [("hot", float(v)) for v in rng.normal(size=900)] + [("hot", 0.25)] * 600
    rows += [("small", float(v)) for v in range(3)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    probs = {"p0": 0.0, "p1": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}
    got = {r.k: r for r in K.quantiles(df, ["k"], "v", probs, buckets=buckets, accuracy=accuracy).collect()}
    assert set(got) == {"hot", "small", "one"}
    for k in got:
        values = [v for g, v in rows if g == k]
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), abs=1e-12), (k, name)


def test_quantiles_redone_when_an_enclosure_misses(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    broken = lambda *a: spark.sql("SELECT 1000L AS _size, 1.0D AS _lo_m, 2.0D AS _hi_m")
    monkeypatch.setattr(K, "_brackets", broken)
    assert K.quantiles(df, [], "v", {"m": 0.5}).first().m == 499.5


def test_quantiles_without_rows(frame):
    df = frame("v double", (None,))
    assert K.quantiles(df, [], "v", {"m": 0.5}).first().m is None


def test_box_stats(frame):
    df = frame("k string, v double", *[("a", float(v)) for v in [1, 2, 3, 4, 100]], ("b", None))
    r = A.box_stats(df, ["k"], "v").first()
    assert (r["min"], r.q1, r.median, r.q3, r["max"]) == (1.0, 2.0, 3.0, 4.0, 100.0)
    assert (r.whisker_low, r.whisker_high, r.outliers) == (1.0, 4.0, 1)


@FEW
@given(values=st.lists(st.integers(-50, 50), min_size=1, max_size=60), buckets=st.integers(1, 9))
def test_running_total_is_prefix_sum(spark, values, buckets):
    counts = pd.Series(values).value_counts().sort_index()
    df = spark.createDataFrame([(int(v), int(n)) for v, n in counts.items()], "v long, n long")
    got = {r.v: r.n_before for r in K.running_total(df, "v", ["n"], buckets=buckets).collect()}
    assert got == {int(v): int(b) for v, b in zip(counts.index, counts.cumsum() - counts)}


def test_running_total_text_and_groups(spark):
    rows = [(g, f"w{i:03d}", 1) for g in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, "g string, w string, n long")
    got = K.running_total(df, "w", ["n"], by=["g"], buckets=7).collect()
    assert len(got) == 80 and all(r.n_before == int(r.w[1:]) for r in got)


def test_months_in_calendar_order(frame):
    df = R.sort_by_month(frame("m string", ("March",), ("January",), ("December",)), "m")
    assert [r.m for r in df.collect()] == ["January", "March", "December"]


def test_best_latest_lowest(frame):
    runs = frame("name string, version string, acc double", ("a", "2", 0.9), ("a", "10", 0.9), ("b", "1", None))
    assert rows_of(R.best(runs, "acc", "version")) == [("a", "10", 0.9)]
    assert rows_of(R.latest(runs, "name", "version"), "name", "version") == [("a", "10"), ("b", "1")]
    assert R.lowest(runs, F.col("name") == "a", "acc", "version").first().version == "10"


def test_trend_rules(frame):
    df = frame("k string, p int, v double", ("a", 1, 4.0), ("a", 2, 4.0), ("a", 3, 0.0), ("a", 4, 2.0))
    got = [tuple(r) for r in R.trend(df, ["k"], "p", "v").orderBy("p").select("trend", "percentage_change", "unchanged").collect()]
    assert got == [("decreased", 0.0, True), ("decreased", 100.0, False), ("increased", float("inf"), False)]


def test_one_hot_and_melt(frame):
    df = frame("id int, c string", (1, "b"), (2, "a"), (3, None))
    hot = R.one_hot(df, ["c"])
    assert hot.columns == ["id", "c_a", "c_b"]
    assert rows_of(hot) == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]
    long = R.melt(hot, ["id"], ["c_a", "c_b"], "var", "value")
    back = long.groupBy("id").pivot("var", ["c_a", "c_b"]).agg(F.first("value"))
    assert rows_of(back) == rows_of(hot)


def test_one_hot_of_many_values(spark, frame):
    df = frame("id int, c string, d int", (1, "b", 7), (2, "a", None), (3, None, 9))
    hot, words = R.one_hot_sparse(df, ["c", "d"])
    places = lambda rows: {r["id"]: (r["features"].size, r["features"].toArray().nonzero()[0].tolist()) for r in rows.collect()}
    assert places(hot) == {1: (4, [1, 2]), 2: (4, [0]), 3: (4, [3])} and hot.columns == ["id", "features"]
    assert rows_of(words) == [("c", "a", 0), ("c", "b", 1), ("d", "7", 2), ("d", "9", 3)]
    assert places(R.one_hot(df, ["c", "d"], limit=1)) == places(hot)
    wide = spark.range(100_000).selectExpr("id", "concat('v', id) as c")
    hot, words = R.one_hot_sparse(wide, ["c"])
    assert words.count() == 100_000 and {v.features.size for v in hot.limit(5).collect()} == {100_000}


def test_ranked_breaks_ties(frame):
    df = frame("q int, s double, id int", (1, 0.5, 3), (1, 0.5, 2), (1, 0.9, 7))
    assert rows_of(R.ranked(df, "q", "s", "id", k=2), "id", "rank") == [(2, 2), (7, 1)]


def test_union_by_name(frame):
    a, b = frame("x int, y string", (1, "a")), frame("y string, x int", ("b", 2))
    assert rows_of(R.union_all([a, b])) == [(1, "a"), (2, "b")]


def test_select_features(frame):
    df = frame("y int, a double, b double, c double", (0, 0.0, 100.0, 5.0), (1, 1.0, -100.0, 5.0), (0, 0.0, -90.0, 5.0), (1, 1.0, 95.0, 5.0))
    assert rows_of(R.select_features(df, "y", ["a", "b", "c"], 1)) == [("a",), ("b",)]


def test_estimate_count_is_stable(spark):
    df = spark.range(20000)
    a, b = (A.estimate_count(df.repartition(n), ["id"], 0.1).first() for n in (1, 7))
    assert a == b and abs(a.estimate - 20000) < 1500
