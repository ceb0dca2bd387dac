"""The two-level index of product codes against exact neighbours."""

import numpy as np
import pytest

from millrace.operators import ann_index, neighbours
from tests.conftest import rows_of


def frame_of(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [float(c) for c in v]) for i, v in zip(ids, x)], "id long, v array<float>")


def clustered(n, width, seed=1, inner=6, centres=40, noise=0.05):
    """Points on low-dimensional sheets round some centres, as embeddings lie."""
    r = np.random.default_rng(seed)
    at = r.normal(size=(centres, width))
    sheets = r.normal(size=(centres, inner, width)) / np.sqrt(inner)
    own = r.integers(0, centres, n)
    x = at[own] + np.einsum("ni,niw->nw", r.normal(size=(n, inner)), sheets[own]) + noise * r.normal(size=(n, width))
    return x.astype("f4").astype("f8")


def nearest(x, k, metric):
    if metric == "cosine":
        u = x / np.sqrt((x * x).sum(1))[:, None]
        s = u @ u.T
    else:
        s = -np.sqrt(np.maximum(((x[:, None, :] - x[None, :, :]) ** 2).sum(2), 0)) if len(x) < 1500 else -np.sqrt(
            np.maximum((x * x).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * x @ x.T, 0))
    np.fill_diagonal(s, -np.inf)
    order = np.argsort(-np.round(s, 9), axis=1, kind="stable")[:, :k]
    return order, np.take_along_axis(s, order, 1)


def recall(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], set()).add(r["neighbour_id"])
    return np.mean([len(got.get(i, set()) & set(w)) / len(w) for i, w in enumerate(want)])


@pytest.mark.parametrize("n, width, metric", [(3000, 64, "cosine"), (1200, 64, "l2"), (1500, 1024, "cosine")])
def test_recall_and_exact_scores(spark, n, width, metric):
    x = clustered(n, width)
    df = frame_of(spark, x).repartition(4)
    index = ann_index.build(df, key="id", vec="v", metric=metric)
    rows = ann_index.search(index, df, 5, key="id", vec="v", exclude_self=True).collect()
    want, score = nearest(x, 5, metric)
    assert recall(rows, want) >= 0.9
    true = {(i, int(j)): s for i, (js, ss) in enumerate(zip(want, score)) for j, s in zip(js, ss)}
    assert all(r["score"] == pytest.approx(true[r["query_id"], r["neighbour_id"]], abs=1e-6) for r in rows if (r["query_id"], r["neighbour_id"]) in true)
    assert {r["rank"] for r in rows} == set(range(1, 6)) and all(r["query_id"] != r["neighbour_id"] for r in rows)


def test_searched_share_falls_as_the_base_grows(spark):
    shares = []
    for n in (500, 8000):
        index = ann_index.build(frame_of(spark, clustered(n, 32)), key="id", vec="v", metric="l2")
        assert index.rows == n and index.cells <= 5 * np.sqrt(n) + 100
        shares.append(index.probes / index.cells)
    assert shares[1] < 0.5 * shares[0]


def test_every_vector_has_one_code_in_its_nearest_cell(spark):
    x = clustered(2000, 16)
    index = ann_index.build(frame_of(spark, x), key="id", vec="v", metric="l2", cells=300)
    codes = index.codes.join(index.centres, "cell").collect()
    assert sorted(r["id"] for r in codes) == list(range(2000)) and {len(r["code"]) for r in codes} == {4}
    assert index.cells > 150
    per = {}
    for r in index.centres.collect():
        per.setdefault(r["coarse"], []).append(r["centre"])
    for r in codes[:200]:
        far = ((np.array(per[r["coarse"]]) - x[r["id"]]) ** 2).sum(1)
        assert ((np.array(r["centre"]) - x[r["id"]]) ** 2).sum() == pytest.approx(far.min())


def test_visiting_everything_is_exact(spark):
    x = clustered(400, 8)
    df = frame_of(spark, x)
    index = ann_index.build(df, key="id", vec="v", cells=20)
    names = dict(q_id="id", q_vec="v", b_id="id", b_vec="v", exclude_self=True)
    got = ann_index.search(index, df, 4, key="id", vec="v", exclude_self=True, probes=index.cells, near=len(index.coarse), short=400)
    assert rows_of(got, "query_id", "neighbour_id", "rank") == rows_of(neighbours.knn(df, df, 4, **names), "query_id", "neighbour_id", "rank")


def test_many_copies_are_cut_into_blocks(spark, monkeypatch):
    """A third of the base is one vector; it fills a cell of many blocks, and the smallest ids come first."""
    monkeypatch.setattr(ann_index, "BLOCK", 64)
    monkeypatch.setattr(ann_index, "QUERIES", 32)
    x = np.concatenate([clustered(600, 8), np.repeat(clustered(1, 8, seed=9), 300, 0)])
    df = frame_of(spark, x).repartition(3)
    index = ann_index.build(df, key="id", vec="v", metric="l2")
    rows = ann_index.search(index, df.filter("id >= 590"), 3, key="id", vec="v", exclude_self=True).collect()
    own = {q: sorted(r["neighbour_id"] for r in rows if r["query_id"] == q) for q in range(600, 900)}
    assert all(v == [i for i in (600, 601, 602, 603) if i != q][:3] for q, v in own.items())


def test_odd_vectors_and_tables(spark):
    df = frame_of(spark, [[1, 0], [0, 0], None, [1, 1], [-1, 0]])
    index = ann_index.build(df, key="id", vec="v")
    rows = ann_index.search(index, df, 5, key="id", vec="v", exclude_self=True)
    assert rows_of(rows, "query_id", "neighbour_id", "rank") == [(0, 3, 1), (0, 4, 2), (3, 0, 1), (3, 4, 2), (4, 3, 1), (4, 0, 2)] or {
        (r["query_id"], r["neighbour_id"]) for r in rows.collect()} == {(a, b) for a in (0, 3, 4) for b in (0, 3, 4) if a != b}
    empty = ann_index.build(df.limit(0), key="id", vec="v")
    assert not ann_index.search(empty, df, 5, key="id", vec="v").count()
    assert not ann_index.search(index, df.limit(0), 5, key="id", vec="v").count()
