"""Joins, encoders, scaling, splits, pruning and metrics."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import features as M
from millrace.operators import metrics as E
from millrace.operators import models as ML
from millrace.operators import relational as J
from tests.conftest import rows_of

FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_upsert_rules(frame):
    target = frame("k int, a int, b int", (1, 10, 100), (2, 20, 200))
    source = frame("k int, a int, c int", (2, None, 7), (3, 30, 8))
    got = J.upsert(target, source, ["k"])
    assert got.columns == ["k", "a", "b", "c"]
    assert rows_of(got) == [(1, 10, 100, None), (2, None, 200, 7), (3, 30, None, 8)]
    assert rows_of(J.upsert(got, source, ["k"])) == rows_of(got)


def test_training_set(frame):
    labels = frame("id int, k int, y boolean", (1, 5, True), (2, 6, False), (3, 5, False))
    feats = frame("k int, f int, g int", (5, 50, 0), (7, 70, 0))
    got = J.training_set(labels, [(feats, ["k"], ["f"])], "y", exclude=["k"])
    assert got.columns == ["id", "f", "y"]
    assert rows_of(got) == [(1, 50, True), (2, None, False), (3, 50, False)]
    with pytest.raises(ValueError):
        J.training_set(labels, [(feats.unionByName(feats), ["k"], ["f"])], "y")


def test_compare_predictions(frame):
    a = frame("id int, prediction double", (1, 1.0), (2, 0.0), (3, None))
    b = frame("id int, prediction double", (1, 1.0), (2, 1.0), (3, None))
    assert rows_of(J.compare_predictions(a, b, ["id"]), "id", "mismatch") == [(1, False), (2, True), (3, False)]


@pytest.mark.parametrize("limit", [256, 1])
def test_label_encode_is_sorted(frame, monkeypatch, limit):
    monkeypatch.setattr(M, "MAP_DOMAIN", limit)
    df = frame("v string", ("b",), ("a",), ("c",), ("b",), (None,))
    assert rows_of(M.label_encode(df, "v", "code")) == [(None, None), ("a", 0), ("b", 1), ("b", 1), ("c", 2)]


def test_label_encode_only_nulls(frame):
    assert rows_of(M.label_encode(frame("v string", (None,)), "v")) == [(None,)]


def test_index_and_encode_keep_unseen(frame):
    df = frame("v string", ("b",), ("b",), ("c",), ("a",))
    model = M.index_categories(df, ["v"])
    new = model.transform(frame("v string", ("a",), ("b",), ("z",)))
    assert rows_of(new) == [("a", 1.0), ("b", 0.0), ("z", 3.0)]
    vec = M.encode_categories(model.transform(df), ["v_index"]).transform(new)
    assert {len(r.v_index_vec) for r in vec.collect()} == {4}


def test_encoding_several_columns_at_once(frame):
    df = frame("a string, b int, c double", ("x", 3, 0.5), ("w", 1, float("nan")), (None, 3, 0.5), ("é", None, None))
    want = df
    for c in df.columns:
        want = M.label_encode(want, c)
    assert rows_of(M.label_encode_all(df, df.columns)) == rows_of(want)
    many = df.sparkSession.range(600).selectExpr("id as k", "id % 7 as few")
    assert rows_of(M.label_encode_all(many, ["k", "few"])) == [(i, i % 7) for i in range(600)]


def test_nan_is_missing_to_imputer_and_scale(frame):
    nan = float("nan")
    df = frame("a double, b double", (1.0, nan), (2.0, nan), (3.0, nan), (nan, nan))
    imp = M.MeanImputer.fit(df, ["a", "b"])
    assert imp.empty == ["b"] and rows_of(imp.transform(df)) == [(1.0,), (2.0,), (2.0,), (3.0,)]
    scaled = rows_of(M.StandardScale.fit(df, ["a"]).transform(df), "a")
    assert scaled == [(None,), (pytest.approx(-1.5 ** 0.5),), (0.0,), (pytest.approx(1.5 ** 0.5),)]


def test_weights_of_many_classes(spark):
    df = spark.range(30_000).selectExpr("id", "id % 3000 as y").unionByName(spark.sql("SELECT 1L AS id, NULL AS y"))
    got = M.with_class_weight(df, "y")
    assert got.columns == ["id", "y", "weight"] and got.count() == 30_000 and {r[0] for r in got.select("weight").distinct().collect()} == {1.0}
    assert M.with_class_weight(df.limit(0), "y").count() == 0


def test_impute_keeps_doubles_and_reports_empty(frame):
    df = frame("a int, b double, c double", (1, None, None), (2, 4.0, None), (None, 6.0, None))
    imp = M.MeanImputer.fit(df, ["a", "b", "c"])
    assert imp.empty == ["c"]
    assert rows_of(imp.transform(df)) == [(1.0, 5.0), (1.5, 6.0), (2.0, 4.0)]


def test_scale_uses_population_std_of_train(frame):
    train, test = frame("x double, k int", (1.0, 7), (3.0, 7)), frame("x double, k int", (5.0, 9))
    assert rows_of(M.StandardScale.fit(train, ["x", "k"]).transform(test)) == [(3.0, 2.0)]


@FEW
@given(fraction=st.floats(0.05, 0.95), seed=st.integers(0, 9))
def test_split_disjoint_complete_and_stable(spark, fraction, seed):
    df = spark.range(3000)
    train, test = M.split(df, ["id"], fraction, seed)
    a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert not a & b and len(a | b) == 3000
    assert abs(len(a) / 3000 - fraction) < 0.06
    assert {r.id for r in M.split(df.repartition(13), ["id"], fraction, seed)[0].collect()} == a


def test_sample_stable_under_repartition(spark):
    df = spark.range(5000)
    assert rows_of(M.sample(df, ["id"], 0.2)) == rows_of(M.sample(df.repartition(9), ["id"], 0.2))


def test_prune_looks_at_every_earlier_column(frame):
    rng = np.random.default_rng(2)
    x = rng.normal(size=400)
    rows = [(float(v), float(v + e), float(v + e + g), float(n), 1.0) for v, e, g, n in zip(
        x, rng.normal(size=400) * 0.3, rng.normal(size=400) * 0.3, rng.normal(size=400))]
    df = frame("a double, b double, c double, d double, flat double", *rows)
    names = df.columns
    r = np.corrcoef(np.array(rows)[:, :4].T)
    want = {names[i] for i in range(4) for j in range(i) if abs(r[i, j]) >= 0.85}
    assert {x["column"] for x in M.prune_list(df, names).collect()} == want == {"b", "c"}
    assert M.prune_correlated(df, names).columns == ["a", "d", "flat"]


def test_balanced_weights(frame):
    df = frame("y int", (0,), (0,), (0,), (1,), (None,))
    assert rows_of(M.balanced_weights(df, "y"), "y", "weight") == [(0, pytest.approx(4 / 6)), (1, 2.0)]
    assert rows_of(M.with_class_weight(df, "y"))[-1] == (1, 2.0)
    assert M.with_class_weight(df, "y").count() == 4


def sk_roc_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_auc_against_pair_counting(spark, buckets):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.normal(size=300) + y, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    assert E.roc_auc(df, buckets=buckets).first().auc == pytest.approx(sk_roc_auc(y, s))
    pts = sorted([(r.recall, r.precision) for r in E.pr_points(df, buckets=buckets).collect()], key=lambda t: (t[0], -t[1]))
    order = np.argsort(-s, kind="stable")
    cuts = np.r_[np.where(np.diff(s[order]))[0], len(s) - 1]
    tp = np.cumsum(y[order])[cuts]
    recall, precision = np.r_[0, tp / y.sum()], np.r_[1, tp / (cuts + 1)]
    want = np.sum(np.diff(recall) * (precision[1:] + precision[:-1]) / 2)
    assert E.pr_auc(df, buckets=buckets).first().pr_auc == pytest.approx(want)
    assert len(pts) == len(cuts) + 1
    assert E.roc_points(df).count() == len(cuts)


def test_auc_of_one_class_is_null(frame):
    df = frame("label int, score double", (1, 0.1), (1, 0.2))
    assert E.roc_auc(df).first().auc is None


def test_hot_score_folds_to_one_step(spark):
    df = spark.range(6000).select((F.col("id") % 2).cast("int").alias("label"), F.lit(0.5).alias("score"))
    assert E.roc_points(df).count() == 1 and E.roc_auc(df).first().auc == 0.5


def test_class_report_empty_class_is_zero(frame):
    df = frame("label int, prediction int", (0, 0), (0, 1), (1, 1))
    got = {r["class"]: r for r in E.class_report(df, classes=[0, 1, 2]).collect()}
    assert (got["0"].precision, got["0"].recall, got["0"].support) == (1.0, 0.5, 2)
    assert (got["2"].precision, got["2"].recall, got["2"].f1) == (0.0, 0.0, 0.0)
    assert got["macro avg"].precision == pytest.approx(0.5) and got["macro avg"].support == 3
    assert E.accuracy(df).first().accuracy == pytest.approx(2 / 3)
    assert rows_of(E.confusion(df)) == [(0, 0, 1), (0, 1, 1), (1, 0, 0), (1, 1, 1)]


def test_class_report_counts_rows_outside_the_classes_shown(frame):
    df = frame("label int, prediction int", (0, 0), (0, 5), (1, 1), (1, None))
    got = {r["class"]: r for r in E.class_report(df, classes=[0, 1]).collect()}
    assert [(got[c].support, got[c].recall) for c in ("0", "1")] == [(2, 0.5), (2, 0.5)]


def test_label_encode_orders_nan_alike_at_any_size(frame):
    nan = float("nan")
    small = M.label_encode(frame("v double", (3.0,), (nan,), (1.0,), (2.0,)), "v", "c").collect()
    assert {str(r.v): r.c for r in small} == {"1.0": 0, "2.0": 1, "3.0": 2, "nan": 3}
    large = M.label_encode(frame("v double", (nan,), *[(float(i),) for i in range(300)]), "v", "c").collect()
    assert {str(r.v): r.c for r in large}["nan"] == 300


def test_rmse(frame):
    assert E.rmse(frame("label double, prediction double", (1.0, 1.0), (2.0, 4.0))).first().rmse == pytest.approx(2 ** 0.5)


def test_promote_and_resolve(frame):
    runs = frame("name string, version long, accuracy double", ("m", 2, 0.8), ("m", 10, 0.7), ("n", 1, 0.5))
    aliases = frame("name string, alias string, version long", ("m", "champion", 10))
    assert rows_of(ML.resolve(aliases, runs), "name", "version") == [("m", 10), ("n", 1)]
    better = ML.promote_best(aliases, runs, "accuracy")
    assert rows_of(better) == [("m", "champion", 2), ("n", "champion", 1)]
    assert rows_of(ML.promote(better, "m", 10))[0] == ("m", "champion", 10)


def test_upsert_refuses_a_repeated_source_key(frame):
    target, source = frame("k int, a int", (1, 10)), frame("k int, a int", (1, 1), (1, 2))
    with pytest.raises(ValueError, match="not unique"):
        J.upsert(target, source, ["k"])
