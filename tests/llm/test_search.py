"""Lexical search, Merkle manifest and k-means tree search against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import kmeans_tree, lexical_search, merkle
from tests.llm.helpers import SCHEMA, documents, odd, scanned
from tests.llm.test_measures import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def ranked(docs, items, best):
    """(item, rank, doc, score) by counting terms."""
    terms = [TERM.findall(ascii_lower(t or "")) for _, t in docs]
    n_all, l_all = sum(bool(t) for t in terms), sum(map(len, terms))
    out = []
    for item, text in items:
        own, scores = TERM.findall(ascii_lower(text or "")), []
        for (doc, _), held in zip(docs, terms):
            score = 0
            for t in own:
                if tf := held.count(t):
                    df = sum(t in h for h in terms)
                    m = 100 - 25 + (25 * len(held) * n_all) // l_all
                    score += math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, k, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=str)


def searched(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


EDGES = [
    "Boundary-guarded: on, ONE; one's own 'one' (one)one", "one one", " one ", "ones", "öne ONE Öne", "x1 1x 11", "\x80 é\x7fé", "one\none\tone",
]


@pytest.mark.parametrize("blocks", [1, 3])
def test_lexical_search_against_brute_force(spark, blocks):
    texts = [prose(i, 5 + 7 * i) for i in range(40)] + EDGES + [None, "", "  ?!", prose(1, 12), prose(1, 12)]
    ids = [*range(len(texts) - 1), None]
    docs = list(zip(ids, texts))
    items = [(f"item {i}", t) for i, t in enumerate([prose(3, 8), "one öne ones", "One one ONE é", prose(1, 12), "missing words", None, "", "11 x1"])]
    items += [items[0]]
    frame = spark.createDataFrame(items, "item_id string, text string")
    size = sum(len((t or "").encode()) for _, t in items)
    got = lexical_search.search(documents(spark, *texts, ids=ids).repartition(3), frame, best=5, block_bytes=-(-size // blocks))
    assert searched(got) == ranked(docs, items, 5)


def test_lexical_search_keeps_the_best_of_many(spark):
    texts = [" ".join(["one"] * (1 + i % 9) + ["two"] * (i % 4) + ["three"] * (i % 7)) for i in range(3000)]
    items = [(i, t) for i, t in enumerate(["one two", "three", "two two one"])]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.search(documents(spark, *texts).repartition(2), frame)
    assert searched(got) == ranked(list(enumerate(texts)), items, 20)


def test_lexical_search_odd_tables(spark):
    items = spark.createDataFrame([(1, "word ab"), (None, "ab"), (3, None)], "item_id long, text string")
    rows = searched(lexical_search.search(odd(spark), items))
    assert {r[0] for r in rows} == {1, None} and {r[2] for r in rows if r[0] == 1} == {3, 5}
    assert not lexical_search.search(spark.createDataFrame([], SCHEMA), items).count()
    assert not lexical_search.search(odd(spark), items.limit(0)).count()


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves, fan):
    """Root and, for each leaf, the (left, right) siblings of each level."""
    paths, place, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        runs = [level[i : i + fan] for i in range(0, len(level), fan)]
        for k, at in enumerate(place):
            run = runs[at // fan]
            paths[k].append(("".join(run[: at % fan]), "".join(run[at % fan + 1 :])))
            place[k] = at // fan
        level = [digest(*r) for r in runs]
    return level[0], paths


def brute_manifest(rows, fan):
    """rows: (doc_id, source, lang, n_chars, text)"""
    of, subs = {}, {}
    for r in rows:
        of.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, digest(*map(field, r)), r))
    for s, own in of.items():
        own.sort(key=lambda x: x[:3])
        subs[s] = tree([x[2] for x in own], fan)
    order = sorted(subs, key=lambda s: (s is not None, (s or "").encode()))
    root, above = tree([subs[s][0] for s in order], fan)
    out = []
    for k, s in enumerate(order):
        for x, path in zip(of[s], subs[s][1]):
            r, whole = x[3], path + above[k]
            folded = x[2]
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0:
                folded = digest(*map(field, (*r[:4], None if r[4] is None else ascii_lower(r[4]))))
            for a, b in whole:
                folded = digest(a, folded, b)
            out.append((r[0], x[2], subs[s][0], root, digest(*(a + b for a, b in whole)), folded, folded == root))
    return sorted(out, key=str)


def corpus(n, sources=4):
    r = random.Random(5)
    rows = [(i, r.choice(["a", None, "", *map(str, range(sources))]) if i % 3 else "hot", r.choice(["en", None]), r.choice([None, i]),
             r.choice([None, "", f"Text {i} É", f"text {i}"])) for i in r.sample(range(10 * n), n)]
    return rows + [rows[0], rows[0], (None, "a", None, None, "Null id"), (None, None, None, None, None), (7, "alone", "en", 1, "One"), (7, "aé", "en", 1, "One")]


@pytest.mark.parametrize("fan, span, n", [(16, 3, 300), (2, 2, 90), (3, 1, 60)])
def test_manifest_against_brute_force(spark, tmp_path, monkeypatch, fan, span, n):
    for name, value in (("FAN", fan), ("SPAN", span), ("BLOCK", fan**span)):
        monkeypatch.setattr(merkle, name, value)
    rows = corpus(n)
    frame = scanned(spark, spark.createDataFrame(
        [(r[0], r[4], r[2], r[1], r[3]) for r in rows], SCHEMA).repartition(3), tmp_path / "docs")
    got = sorted((tuple(x) for x in merkle.query(spark, frame).select(*merkle.OUTPUT).collect()), key=str)
    assert got == brute_manifest(rows, fan)


def test_positions_are_those_of_a_postorder_log():
    for n in [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4097, 5000]:
        at, seen = 0, {}

        def write(level, index):
            nonlocal at
            if level:
                below = -(-n // 16 ** (level - 1))
                for child in range(16 * index, min(16 * index + 16, below)):
                    write(level - 1, child)
            seen[level, index] = at
            at += 1

        write(merkle.height(n), 0)
        assert all(merkle.position(level, index, n) == place for (level, index), place in seen.items())


def test_builders_write_postorder_logs(spark, tmp_path):
    frame = scanned(spark, spark.range(9000).selectExpr("id as doc_id", "'t' as text", "'en' as lang", "'s' as source", "1L as n_chars"), tmp_path / "docs")
    made = merkle.manifest(frame)
    places = [r[0] for r in made.log.select("position").collect()]
    assert sorted(places) == list(range(9000 + 563 + 36 + 3 + 1))
    part = made.log.filter("level < 3 and index div cast(power(16, 3 - level) as int) = 1").select("position").collect()
    assert [r[0] for r in part] == list(range(part[0][0], part[0][0] + len(part)))


def test_manifest_odd_tables(spark):
    rows = merkle.query(spark, odd(spark)).collect()
    assert len(rows) == 9 and len({r["root"] for r in rows}) == 1 and {r["verified"] for r in rows} == {True}
    empty = merkle.query(spark, spark.createDataFrame([], SCHEMA))
    assert empty.columns == merkle.OUTPUT and not empty.count()


def embeddings(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def exact(rows, k, asks):
    """(query, rank, id, distance) by all distances; rows are (id, vector)."""
    out = []
    for q, (own, v) in enumerate(rows):
        if own is not None and asks(own):
            far = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), i) for at, (i, w) in enumerate(rows) if at != q and len(w) == len(v))
            out += [(own, rank, i, round(d, 9)) for rank, (d, i) in enumerate(far[:k], 1)]
    return sorted(out)


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in df.collect())


def points(n, width=6, seed=2, copies=0):
    r = np.random.default_rng(seed)
    made = np.round(r.normal(size=(n, width)) + 4 * r.integers(0, 2, size=(n, width)), 3).astype("f4").astype("f8").tolist()
    return made + [made[0]] * copies


def test_tree_visiting_everything_is_exact(spark):
    rows = list(enumerate(points(1200, copies=400)))
    rows += [(1600, rows[7][1]), (7, rows[7][1]), (1601, rows[100][1][:3]), (1700, rows[200][1][:3])]
    df = embeddings(spark, [v for _, v in rows], [i for i, _ in rows]).repartition(4)
    got = kmeans_tree.neighbours(df, F.col("id") % 100 == 0, recall=1.1, leaf_rows=20, page=150, block=16)
    assert found(got) == exact(rows, 10, lambda i: i % 100 == 0)


def test_tree_reaches_its_recall(spark):
    rows = list(enumerate(points(6000, width=12)))
    df = embeddings(spark, [v for _, v in rows]).repartition(4)
    got = found(kmeans_tree.neighbours(df, F.col("id") % 50 == 0, leaf_rows=40, sample=3000, page=500))
    want = exact(rows, 10, lambda i: i % 50 == 0)
    share = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) / len(want)
    assert share >= 0.9
    true = {(q, i): d for q, _, i, d in exact(rows, 6000, lambda i: i % 50 == 0)}
    assert all(true[q, i] == d for q, _, i, d in got)


def test_tree_searches_best_bin_first():
    x = np.array(points(2000, width=4))
    tree = kmeans_tree.fit(x, 20)
    leaf = tree.descend(x)
    assert tree.leaves > 50 and set(leaf) <= set(range(tree.leaves))
    for q in range(0, 2000, 97):
        order = list(tree.visit(x[q]))
        assert order[0] == leaf[q] and sorted(order) == list(range(tree.leaves))


def test_tree_odd_vectors(spark):
    good = points(30)
    odd_ones = [None, [], [0] * 6, [1, None, 0, 0, 0, 0], [float("nan")] + [1] * 5, [float("inf")] + [1] * 5]
    rows = embeddings(spark, [*good, *odd_ones], [*range(30), 100, 200, 300, 400, 500, 600]).selectExpr(
        "*", "1 as rank", "'x' as v", "2 as leaf", "3 as page", "4 as row")
    got = found(kmeans_tree.query(spark, rows))
    assert got == exact(list(enumerate(good)), 10, lambda i: i % 100 == 0)
    assert not kmeans_tree.query(spark, rows.limit(0)).count()
    assert not kmeans_tree.query(spark, rows.filter("vec_id >= 100")).count()
    assert [r[:3] for r in found(kmeans_tree.query(spark, embeddings(spark, [good[0], good[1], good[0]])))] == [(0, 1, 2), (0, 2, 1)]
