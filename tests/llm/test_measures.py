"""Quality rules, quality trees, token lengths and toxicity."""

import random
import zlib

import numpy as np
import pytest

from millrace.llm import quality_model, quality_rules, token_lengths, toxicity
from millrace.llm.common import ChunkEncoder
from tests.llm.helpers import ODD, documents, odd

WORDS = "the of and house tree river stone light cloud green walk speak quiet early paper".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) * (r.random() < 0.4) for _ in range(n))


def brute_repeats(text):
    words, seen, hit = text.split(), {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            hit |= {j for i in places for j in range(i, i + 8)}
    return len(hit)


def test_rules_against_brute_force(spark):
    texts = [prose(i, n) for i, n in enumerate((5, 19, 20, 40, 300))]
    texts += [prose(7, 30) + " " + prose(8, 9) + " " + prose(7, 30), "go " * 50, "a b\n\na b\nc\n a b\n" * 3, "Ünï #tag <b> %" * 9]
    got = {r["doc_id"]: r for r in quality_rules.query(spark, documents(spark, *texts)).collect()}
    for i, text in enumerate(texts):
        row, words = got[i], text.split()
        lines = [x for x in text.split("\n") if x.strip()]
        assert row["n_words"] == len(words) and row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == sum(c in quality_rules.SYMBOLS for c in text)
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == brute_repeats(text)
        assert row["base_failed"] == (len(words) < 20 or 100 * brute_repeats(text) > 30 * len(words))
        assert not (row["base_failed"] and row["kept"])
    assert got[4]["kept"]


def test_rules_name_what_is_broken(spark):
    loud = " ".join(w.upper() + "!!" for w in prose(1, 60).split())
    rows = quality_rules.query(spark, documents(spark, loud, " | ".join(prose(2, 60).split()))).orderBy("doc_id").collect()
    assert "upper_case" in rows[0]["broken"] and "marks" in rows[0]["broken"] and not rows[0]["kept"]
    assert "symbols" in rows[1]["broken"]


def test_rules_on_odd_and_empty_tables(spark):
    rows = quality_rules.query(spark, odd(spark)).collect()
    assert len(rows) == 9 and all(r["n_words"] == 0 and r["base_failed"] for r in rows if r["doc_id"] in (0, 1, 2))
    assert next(r for r in rows if r["doc_id"] == 5)["n_repeat_words"] == 60_000
    assert quality_rules.query(spark, odd(spark).limit(0)).collect() == []


def test_chunk_encoder_equals_the_tokenizer():
    encoder = ChunkEncoder(memo=50)
    texts = ["", " ", "it's 'SAID' don't. a'b.", "İ. İ, ΑΣ. ß ﬁ é.", "x<|endoftext|> <|STARTOFTEXT|>", "日本語。テスト, 12.5 ²,a.", "a\x0bb\x85c"]
    r = random.Random(5)
    texts += ["".join(r.choice("aBé É.,'İßΣσς1-ñ中 ́ﬁ") for _ in range(12)) for _ in range(500)]
    for text, got in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_lengths_against_brute_force(spark):
    texts = [prose(i, n) for i, n in enumerate((0, 1, 7, 7, 400, 2000))] + [None, ""]
    encoder = ChunkEncoder()
    sizes = np.array([len(x) // 4 for x in encoder.encode([(t or "").encode() for t in texts])])
    hist = token_lengths.histogram(documents(spark, *texts))
    rows = token_lengths.limits(hist).collect()
    assert sorted(r["context_limit"] for r in rows) == sorted(set(sizes))
    for r in rows:
        limit = r["context_limit"]
        assert (r["n_docs"], r["docs_over"]) == ((sizes == limit).sum(), (sizes > limit).sum())
        assert r["tokens_over"] == sizes[sizes > limit].sum()
        assert r["tokens_kept"] == np.minimum(sizes, limit).sum() and r["tokens_cut"] == (sizes - np.minimum(sizes, limit)).sum()
    assert token_lengths.quantile(hist, 0.5) == np.sort(sizes)[int(np.ceil(0.5 * len(sizes))) - 1]


def test_any_limit_is_answered(spark):
    lengths = [0, 3, 3, 10, 700, 5000]
    hist = spark.createDataFrame([(n, lengths.count(n)) for n in set(lengths)], "n_tokens long, n_docs long")
    rows = {r["context_limit"]: r for r in token_lengths.answer(hist, [1, 3, 2048, 4096, 9999, 2048]).collect()}
    assert set(rows) == {1, 3, 2048, 4096, 9999}
    for limit, r in rows.items():
        kept = sum(min(n, limit) for n in lengths)
        assert (r["n_docs"], r["docs_over"], r["tokens_kept"], r["tokens_cut"]) == (
            lengths.count(limit), sum(n > limit for n in lengths), kept, sum(lengths) - kept)
        assert r["share_whole"] == pytest.approx(sum(n <= limit for n in lengths) / len(lengths))
    assert token_lengths.answer(hist.limit(0), [5]).first()["share_whole"] is None


def test_lengths_on_odd_and_empty_tables(spark):
    assert sum(r["n_docs"] for r in token_lengths.query(spark, odd(spark)).collect()) == 9
    assert token_lengths.query(spark, odd(spark).limit(0)).collect() == []


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_are_those_of_the_rules(spark):
    texts = [prose(i, 9 * i) for i in range(40)] + ODD + [
        prose(1, 30) * 3, "a b c d e f g h " * 3, "one " * 9, "The, THE. the f\u00fcr F\u00dcR de.,., \u00c9T\u00c9 \u03a3 \u0130",
        "- a\n  * b\n\u2022 c\n-d\n\n \t\n- a", "open...\nso\u2026  \nno.. .\nend...\r\nx...\u2028", "1!2?3#*$%&|<>\x0b\x0c\x1c\xa0.,", "\U0001f600 \x85 x"]
    want = quality_rules.measure(documents(spark, *texts), "text", ["doc_id"]).select("doc_id", *quality_model.COUNTS)
    got = quality_model.counted(documents(spark, *texts), "doc_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_splits_are_the_best_of_an_exhaustive_search():
    """One tree of one split against all statistics and cuts between their values."""
    r = np.random.default_rng(3)
    for seed in range(20):
        x = r.integers(0, 12, size=(80, 3)).astype(float)
        y = (x[:, seed % 3] + r.normal(size=80) * 3 > 6).astype(float)
        model = quality_model.fit_trees(x, y, trees=1, depth=1, least=1)
        slope, bend = y - y.mean(), np.full(80, y.mean() * (1 - y.mean()))
        gain = lambda own: slope[own].sum() ** 2 / (bend[own].sum() + 1)
        best = max((gain(x[:, j] <= c) + gain(x[:, j] > c), -j, -c) for j in range(3) for c in np.unique(x[:, j])[:-1])
        j, c = model.feature[model.roots[0]], model.bound[model.roots[0]]
        assert gain(x[:, j] <= c) + gain(x[:, j] > c) == pytest.approx(best[0])


def test_trees_equal_a_walk_node_by_node():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.fit_trees(x, y, trees=20)
    assert (model.depth, len(model.left)) == (4, len(model.value))
    for i in range(50):
        total = model.start
        for node in model.roots:
            while model.left[node] != node:
                node = model.left[node] + int(x[i, model.feature[node]] > model.bound[node])
            total += model.value[node]
        assert model.score(x[i : i + 1])[0] == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_quality_learns_and_never_reads_held_out_labels(spark):
    texts = [prose(i, 60) if i % 2 else " | ".join(prose(i, 60).split()) for i in range(120)]
    docs = documents(spark, *texts)
    known = [(i, i % 2, 0) for i in range(120)]
    rows = quality_model.query(spark, docs, labels(spark, known)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    lied = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in known]
    again = quality_model.query(spark, docs, labels(spark, lied)).collect()
    assert {r["doc_id"]: r["score"] for r in rows} == {r["doc_id"]: r["score"] for r in again}


@pytest.mark.parametrize("query", [quality_model.query, toxicity.query])
def test_classifiers_on_odd_tables(spark, query):
    empty = labels(spark, [])
    assert [r["score"] for r in query(spark, odd(spark), empty).collect()] == [0.0] * 9
    one = labels(spark, [(i, 1, 1) for i in range(7)] + [(None, 0, 0), (6, None, None)])
    assert {r["score"] for r in query(spark, odd(spark), one).collect()} == {1.0}
    both = labels(spark, [(i, i % 2, i % 2) for i in range(9)])
    rows = query(spark, odd(spark), both).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert query(spark, odd(spark).limit(0), both).collect() == []


def test_toxicity_learns_words(spark):
    r = random.Random(4)
    bad = ["scumbag", "wretched", "vermin"]
    texts = [prose(i, 60) + (" " + " ".join(r.choice(bad) for _ in range(4)) if i % 4 == 0 else "") for i in range(200)]
    docs = documents(spark, *texts)
    rows = toxicity.query(spark, docs, labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(200)])).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]) > 0.97


def test_label_model_weighs_copies_of_a_voter_as_one():
    r = np.random.default_rng(2)
    y = r.random(4000) < 0.3
    table = np.where(r.random((4000, toxicity.VOTERS)) < 0.85, np.where(y, 1, -1)[:, None], np.where(y, -1, 1)[:, None])
    table[:, 1:4] = table[:, :1]
    model = toxicity.fit_label_model(table[500:], np.ones(3500), table[:500], y[:500].astype(int))
    assert model.weights[:4].max() < 0.5 * model.weights[4:].min()
    assert ((model.posterior(table) > 0.5) == y).mean() > 0.97
