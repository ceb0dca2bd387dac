"""Null, tie and text corners of filters and scalar functions."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import rows as R
from tests.conftest import rows_of


def test_mismatch_counts_one_sided_null(frame):
    df = frame("a string, b string", ("x", "x"), ("x", "y"), (None, "y"), ("x", None), (None, None))
    assert rows_of(df.filter(R.mismatch("a", "b"))) == [(None, "y"), ("x", None), ("x", "y")]


def test_drop_where_keeps_unknown(frame):
    df = frame("children double, adults int", (0.0, 0), (None, 0), (0.0, 1))
    kept = R.drop_where(df, (F.col("children") == 0) & (F.col("adults") == 0))
    assert rows_of(kept) == [(None, 0), (0.0, 1)]


def test_in_range_is_open_below_closed_above(frame):
    df = frame("v double", (0.0,), (0.1,), (5.0,), (5.1,), (None,))
    assert rows_of(R.in_range(df, {"v": (0, 5)})) == [(0.1,), (5.0,)]


def test_drop_columns_fails_on_absent(frame):
    df = frame("a int, b int", (1, 2))
    assert R.drop_columns(df, "b").columns == ["a"]
    with pytest.raises(ValueError):
        R.drop_columns(df, "c")


def test_by_type_and_hcat(frame):
    df = frame("a string, b int, c boolean, d double", ("x", 1, True, 2.0))
    cat, num = R.by_type(df)
    assert (cat, num) == (["a", "c"], ["b", "d"])
    assert R.hcat(df, num, cat).columns == ["b", "d", "a", "c"]


def test_sanitize_columns(frame):
    df = R.sanitize_columns(frame("`Undefined/Other x` boolean, `b` tinyint, ok string", (True, 3, "s")))
    assert df.dtypes == [("Undefined_Other_x", "int"), ("b", "int"), ("ok", "string")]
    assert rows_of(df) == [(1, 3, "s")]


def test_to_numeric_bad_text_is_null(frame):
    df = frame("v string", ("1.5",), ("x",), (None,), (" 2 ",))
    assert rows_of(R.to_numeric(df, ["v"])) == [(None,), (None,), (1.5,), (2.0,)]


def test_percent_text(frame):
    df = frame("v string", (" 13.56%",), ("n/a",), (None,), ("7",))
    assert rows_of(df.select(S.pct_to_double("v"))) == [(None,), (None,), (7.0,), (13.56,)]


def test_month_and_yes_no(frame):
    df = frame("m string, y string", ("January", "yes"), ("December", "no"), ("Foo", "maybe"), (None, None))
    assert rows_of(df.select(S.month_no("m"), S.yes_no("y"))) == [(None, None), (None, None), (1, 1), (12, 0)]


def test_clean_text_order_and_unicode(frame):
    df = frame(
        "t string", ("a [1] b[23]",), ("x  y\n\nz",), ("one == Head == two",), (None,), ("",), ("  s  ",),
        ("== A == b === C ===",))
    got = [r[0] for r in df.select(S.clean_text("t")).collect()]
    assert got == ["a b", "x y z", "one  two", "", "", "s", "b"]


@pytest.mark.parametrize("text, width, want", [
    ("short text", 20, "short text"), ("one two three", 9, "one two…"), ("one two three", 8, "one two…"),
    ("one two three", 7, "one…"), ("a   b\n c", 5, "a b c"), ("unbreakable", 5, "…"),
])
def test_snippet(frame, text, width, want):
    assert frame("t string", (text,)).select(S.snippet("t", width)).first()[0] == want


def test_identifiers(frame):
    df = frame("v string", ("Jo.Ann-X",), ("9lives",), ("..",), ("#",), ("",), (None,))
    got = [r[0] for r in df.select(S.sanitize_id("v")).collect()]
    assert got == ["jo_ann" + "x", "user_9lives", "__", "anonymous", "anonymous", "anonymous"]
    df = frame("v string", ("ok_1",), ("no-dash",), ("",), (None,), ("x" * 255,), ("x" * 256,))
    assert [r[0] for r in df.select(S.is_valid_id("v")).collect()] == [True, False, False, False, True, False]


@pytest.mark.parametrize("cur, prev, want, label", [
    (71.0, 83.0, -14.4578, "decreased"), (5.0, 0.0, math.inf, "increased"), (0.0, 0.0, 0.0, "decreased"),
    (4.0, 4.0, 0.0, "decreased"), (3.0, 2.0, 50.0, "increased"), (-1.0, 0.0, 0.0, "decreased"),
])
def test_pct_change(frame, cur, prev, want, label):
    df = frame("c double, p double", (cur, prev)).withColumn("x", S.pct_change("c", "p"))
    value, name = df.select("x", S.trend_label("x")).first()
    assert value == pytest.approx(want, abs=1e-3) and name == label


def test_pct_change_unknown(frame):
    df = frame("c double, p double", (None, 1.0), (1.0, None)).withColumn("x", S.pct_change("c", "p"))
    assert rows_of(df.select("x", S.trend_label("x"))) == [(None, None), (None, None)]


def test_json_rows_keep_nulls_and_iso_days(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS string) AS b, TIMESTAMP '2024-05-06 07:08:09' AS t")
    assert S.to_json_row(df).first()[0] == '{"a":1,"b":null,"t":"2024-05-06"}'


def test_first_pred_by_type(frame):
    df = frame("a array<double>, s double", ([3.0, 4.0], 5.0), ([], 6.0))
    assert rows_of(df.select(S.first_pred(df, "a"), S.first_pred(df, "s"))) == [(None, 6.0), (3.0, 5.0)]


def test_tokens(frame):
    df = frame("t string", ("  a \n b c ",), ("   ",), (None,))
    assert [r[0] for r in df.select(S.tokens("t")).collect()] == [["a", "b", "c"], [], []]
