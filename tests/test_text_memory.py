"""Python tasks on texts hold a few hundred rows at a time, whatever the size of an Arrow batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.operators import postings as PO
from millrace.operators import text as X


def taken(monkeypatch, make):
    """The Arrow function that ``make`` hands to Spark."""
    got = []
    monkeypatch.setattr(X, "_once_arrow", lambda fn, kind: got.append(fn) or (lambda c: F.lit(None).cast(kind)))
    make()
    return got[0]


def test_embedding_of_a_large_batch(spark, monkeypatch):
    df = spark.createDataFrame([("a",)], "text string")
    fn = taken(monkeypatch, lambda: X.embed(df, "text", 64))
    hashes = [None, []] + [[i, 64 + i, 3 * i] for i in range(9_998)]
    tracemalloc.start()
    (out,) = list(fn(iter([pa.array(hashes, pa.list_(pa.int64()))])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = out.to_pylist()
    assert peak < 8e6 and len(got) == 10_000 and not any(got[0]) and not any(got[1])
    want = np.zeros(64)
    np.add.at(want, np.array(hashes[50]) % 64, 1.0 - 2.0 * ((np.array(hashes[50]) // 64) % 2))
    assert np.allclose(got[50], want / np.sqrt((want * want).sum()))


def test_sentences_of_a_large_batch(spark, monkeypatch):
    df = spark.createDataFrame([("a",)], "text string")
    fn = taken(monkeypatch, lambda: X.chunk_sentences(df, "text", size=20, overlap=5, min_chars=1))
    texts = [None, ""] + [f"Number {i} is here. " * 20 for i in range(2_000)]
    tracemalloc.start()
    (out,) = list(fn(iter([pa.array(texts)])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = out.to_pylist()
    assert peak < 2e6 and len(got) == 2_002 and got[:2] == [[], []] and all(c.startswith("Number 7 ") for c in got[9])


def test_postings_of_a_large_batch():
    run, _ = PO._counted("bigint")
    batch = pa.RecordBatch.from_arrays([pa.array(range(1_000)), pa.array([["a", "b", "a"]] * 1_000)], names=["key", "words"])
    out = list(run(iter([batch])))
    assert max(b.num_rows for b in out) <= 256 * 3 and sum(b.num_rows for b in out) == 3_000
    assert out[0].slice(0, 3).to_pylist() == [{"key": 0, "term": None, "tf": 3}, {"key": 0, "term": "a", "tf": 2}, {"key": 0, "term": "b", "tf": 1}]


def test_few_bytes_of_a_text_are_sent_and_held(spark, monkeypatch):
    df, sent = spark.createDataFrame([("Some words, some more",)], "text string"), []
    with monkeypatch.context() as m:
        m.setattr(X, "_once_arrow", lambda fn, kind: lambda c: sent.append(df.select(c.alias("h"))) or F.lit(None).cast(kind))
        X.embed(df, "text", 1024)
    # Two bytes a word; the hash itself has eight.
    assert sent[0].dtypes == [("h", "array<smallint>")]
    fn = taken(monkeypatch, lambda: X.embed(df, "text", 1024))
    batch = pa.array([[i % 2048] * (i % 3) for i in range(10_000)], pa.list_(pa.int16()))
    rows, tops = 0, []
    tracemalloc.start()
    for out in fn(iter([batch, batch.slice(0, 0)])):
        rows += len(out)
        tops += [np.abs(out.slice(i, 1).flatten().to_numpy()).argmax() for i in range(0, len(out), 1000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All vectors of the batch are 41 MB.
    assert rows == 10_000 and peak < 20e6
    whole = np.concatenate([o.flatten().to_numpy() for o in fn(iter([batch]))]).reshape(-1, 1024)
    at = np.arange(10_000)
    assert np.array_equal(whole.any(1), at % 3 > 0)
    full = at[at % 3 > 0]
    assert np.array_equal(whole[full, full % 1024], np.where(full % 2048 < 1024, 1.0, -1.0))


def test_sentences_of_a_batch_of_long_texts(spark, monkeypatch):
    df = spark.createDataFrame([("a",)], "text string")
    fn = taken(monkeypatch, lambda: X.chunk_sentences(df, "text", size=200, overlap=5, min_chars=1))
    texts, rows = pa.array([f"Number {i} is here. " * 2_000 for i in range(1_000)]), 0
    for out in fn(iter([texts])):
        # One batch gave all of its chunks, over 40 MB, at once.
        assert out.nbytes < 16e6 and out[0][0].as_py().startswith(f"Number {rows} ")
        rows += len(out)
    assert rows == 1_000
