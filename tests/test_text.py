"""Chunks, embeddings, neighbours, re-ranking and prompts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import neighbours as N
from millrace.operators import text as X
from tests.conftest import rows_of


def test_chunk_windows(frame):
    words = [f"w{i:04d}" for i in range(1000)]
    df = frame("id int, t string", (1, " ".join(words)), (2, "too short"), (3, None), (4, " ".join(words[:500])), (5, " ".join(words[:551])))
    got = X.chunk(df, "t").collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append((r.chunk_no, r.content.split()))
    assert set(by) == {1, 4, 5}
    assert [(n, c[0], c[-1]) for n, c in sorted(by[1])] == [(0, "w0000", "w0499"), (1, "w0450", "w0949"), (2, "w0900", "w0999")]
    assert len(by[4]) == 1 and len(by[5]) == 2
    assert sorted(set(w for _, c in by[1] for w in c)) == words


def test_chunk_sentences_cover_and_bound(frame):
    body = " ".join(f"This is sentence number {i} of the text." for i in range(60))
    got = X.chunk_sentences(frame("id int, t string", (1, body), (2, "x"), (3, None)), "t", 40, 10, 20).orderBy("chunk_no").collect()
    chunks = [r.content for r in got]
    assert all(len(c.split()) <= 40 for c in chunks) and {r.id for r in got} == {1}
    assert all(c.endswith(".") and c.startswith("This") for c in chunks)
    seen = " ".join(chunks)
    assert all(f"number {i} of" in seen for i in range(60))
    # The last sentence of a chunk opens the next one.
    assert all(a.split(". ")[-1].rstrip(".") in b for a, b in zip(chunks, chunks[1:]))


def test_long_sentence_is_cut_whole(frame):
    body = " ".join(f"w{i}" for i in range(95))
    chunks = [r.content for r in X.chunk_sentences(frame("t string", (body,)), "t", 30, 5, 1).orderBy("chunk_no").collect()]
    assert " ".join(chunks) == body and all(len(c.split()) <= 30 for c in chunks)


def test_embed_blank_is_zero_and_norm_is_one(frame):
    df = frame("id int, t string", (1, "some words here"), (2, "  "), (3, None), (4, "Some WORDS here"))
    v = {r.id: np.array(r.embedding) for r in X.embed(df, "t", 64).collect()}
    assert np.linalg.norm(v[1]) == pytest.approx(1) and not v[2].any() and not v[3].any()
    assert (v[1] == v[4]).all() and len(v[1]) == 64


def test_failed_embeddings_are_told_from_blank_texts(frame):
    def own(texts):
        if any("bad" in t for t in texts):
            raise ValueError("bad")
        return [[1.0, 0.0] for _ in texts]

    df = X.embed(frame("t string", ("good",), ("bad",), ("  ",), (None,)), "t", 2, fn=own, out="v")
    got = {r["t"]: r["f"] for r in df.select("t", X.embedding_failed("t", "v").alias("f")).collect()}
    assert got == {"good": False, "bad": True, "  ": False, None: False}


def test_embed_with_own_function(frame):
    df = frame("id int, t string", (1, "ab"), (2, ""), (3, "abc")).coalesce(1)
    got = {r.id: r.e for r in X.embed(df, "t", 2, lambda texts: [[len(t), 1] for t in texts], "e").collect()}
    assert got == {1: [2.0, 1.0], 2: [0.0, 0.0], 3: [3.0, 1.0]}

    def broken(texts):
        raise RuntimeError("no service")

    assert {tuple(r.e) for r in X.embed(df, "t", 2, broken, "e").collect()} == {(0.0, 0.0)}

    def picky(texts):
        return [[len(t), 1] if t != "ab" else [] + [None] for t in texts]

    got = {r.id: r.e for r in X.embed(df, "t", 2, picky, "e").collect()}
    assert got == {1: [0.0, 0.0], 2: [0.0, 0.0], 3: [3.0, 1.0]}


def brute(q, x, k, metric, self_join=False):
    out = {}
    for qi, qv in q:
        scored = []
        for xi, xv in x:
            if self_join and xi == qi:
                continue
            if metric == "cosine":
                n = np.linalg.norm(qv) * np.linalg.norm(xv)
                if n == 0:
                    continue
                s = float(np.dot(qv, xv) / n)
            else:
                s = -float(np.linalg.norm(np.subtract(qv, xv)))
            scored.append((-round(s, 9), xi))
        out[qi] = [i for _, i in sorted(scored)[:k]]
    return out


def vectors(seed, n, dim=8, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in rng.normal(size=dim)]) for i in range(n)]
    hot = rows[0][1]
    return rows + [(n + i, hot) for i in range(copies)]


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.neighbour_id)
    return out


WAYS = [dict(), dict(broadcast_bytes=0, cells=5), dict(broadcast_bytes=0, cells=1)]


@pytest.mark.parametrize("options", WAYS)
@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_knn_equals_brute_force(spark, monkeypatch, metric, options):
    monkeypatch.setattr(N, "BLOCK_BASE", 40)
    monkeypatch.setattr(N, "BLOCK_QUERY", 7)
    # A third of the base are copies of one vector.
    q, x = vectors(1, 30), vectors(2, 120, copies=60)
    qd = spark.createDataFrame(q, "id long, v array<double>").repartition(3)
    xd = spark.createDataFrame(x, "id long, v array<double>").repartition(4)
    got = N.knn(qd, xd, 6, q_id="id", q_vec="v", b_id="id", b_vec="v", metric=metric, **options)
    assert found(got) == brute(q, x, 6, metric)


@pytest.mark.parametrize("options", WAYS)
def test_knn_corners(spark, options):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [0.5, 0.5]), (5, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = found(N.knn(df, df, 10, q_id="id", q_vec="v", b_id="id", b_vec="v", exclude_self=True, **options))
    assert got == {1: [5, 4], 4: [1, 5], 5: [1, 4]}


@pytest.mark.parametrize("options", WAYS)
def test_knn_without_rows(spark, options):
    df = spark.createDataFrame([(1, [1.0, 0.0])], "id long, v array<double>")
    none = df.filter("id > 1")
    for q, b in ((none, df), (df, none)):
        assert N.knn(q, b, 2, q_id="id", q_vec="v", b_id="id", b_vec="v", **options).count() == 0


def test_ann_recall(spark):
    x = vectors(5, 400)
    df = spark.createDataFrame(x, "id long, v array<double>")
    names = dict(q_id="id", q_vec="v", b_id="id", b_vec="v", exclude_self=True)
    exact, near = found(N.knn(df, df, 5, **names)), found(N.ann(df, df, 5, cells=20, probes=8, **names))
    recall = np.mean([len(set(exact[i]) & set(near.get(i, []))) / 5 for i in exact])
    assert recall > 0.75
    every = found(N.ann(df, df, 5, cells=20, probes=20, **names))
    assert every == exact


def test_knn_classify_tie_goes_to_smallest_label(spark):
    train = spark.createDataFrame([(1, [0.0], 9), (2, [1.0], 3), (3, [10.0], 4), (4, [10.1], 4)], "id long, v array<double>, y int")
    test = spark.createDataFrame([(7, [0.4], 0), (8, [10.0], 0)], "id long, v array<double>, y int")
    assert rows_of(N.knn_classify(train, test, 2, key="id", vec="v", label="y")) == [(7, 3), (8, 4)]


def test_similarity_search_skips_zero(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.0, 0.0], "b"), (3, [1.0, 1.0], "c")], "id long, v array<float>, t string")
    got = [(r.id, round(r.score, 6)) for r in N.similarity_search(df, [1.0, 0.0], ["t"], 5, vec="v", key="id").collect()]
    assert got == [(1, 1.0), (3, round(math.sqrt(0.5), 6))]


def test_rerank_and_prompts(frame):
    docs = frame("doc_id int, text string", (1, "red fox red"), (2, "blue fox"), (3, "green tree"), (4, "red"))
    queries = frame("q int, question string", (1, "red Fox"), (2, "nothing matches"))
    cands = docs.crossJoin(queries.select("q"))
    top = X.rerank(cands, queries, docs, 2, q_id="q", query="question", text="text")
    got = {r.new_rank: r for r in top.filter("q = 1").collect()}
    n, avg = 4, 2.0
    idf = lambda df: math.log(1 + (n - df + 0.5) / (df + 0.5))
    part = lambda df, tf, size: idf(df) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / avg))
    assert got[1].doc_id == 1 and got[1].bm25 == pytest.approx(part(2, 2, 3) + part(2, 1, 3))
    assert got[2].doc_id == 4 and got[2].bm25 == pytest.approx(part(2, 1, 1))
    assert {r.bm25 for r in top.filter("q = 2").collect()} == {0.0}
    prompt = X.build_prompts(top, queries, "C:\n{context}\nQ: {question}", q_id="q", query="question", rank="new_rank",
                             source="doc_id", text="text").filter("q = 1").first().prompt
    assert prompt == "C:\nSource: 1\nred fox red\n\nSource: 4\nred\nQ: red Fox"


def test_ann_default_cells_recall(spark):
    """The default share of cells at 64 numbers finds most neighbours of clustered vectors."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(25, 64))
    x = [(i, list(map(float, centres[i % 25] + 0.3 * rng.normal(size=64)))) for i in range(1000)]
    df = spark.createDataFrame(x, "id long, v array<double>")
    names = dict(q_id="id", q_vec="v", b_id="id", b_vec="v", exclude_self=True)
    exact, near = found(N.knn(df, df, 5, **names)), found(N.ann(df, df, 5, **names))
    recall = np.mean([len(set(exact[i]) & set(near.get(i, []))) / 5 for i in exact])
    assert recall > 0.75


def test_wide_vectors_over_many_cells(spark):
    x = vectors(7, 300, dim=1024)
    df = spark.createDataFrame(x, "id long, v array<double>")
    names = dict(q_id="id", q_vec="v", b_id="id", b_vec="v", exclude_self=True)
    assert found(N.knn(df, df, 3, **names)) == found(N.knn(df, df, 3, broadcast_bytes=0, cells=256, **names))
