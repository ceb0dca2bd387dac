"""Chunking, embedding, re-ranking and prompt assembly."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import hash32
from millrace.functions.scalars import clean_text, tokens
from millrace.session import materialize
from millrace.sources.tables import append_table, with_surrogate_id


def chunk(
    df: DataFrame, text: str, size: int = 500, overlap: int = 50, min_chars: int = 100, out: str = "content",
) -> DataFrame:
    """Windows of ``size`` whitespace tokens, each sharing ``overlap`` with the one before.

    Windows start every ``size - overlap`` tokens as long as more than
    ``overlap`` tokens are left; a window of at most ``min_chars`` characters is
    dropped, and so is a document without windows. Adds ``chunk_no`` from 0.
    """
    step = size - overlap
    words = tokens(F.col(text))
    last = F.greatest(F.size("_words") - overlap - 1, F.lit(0))
    starts = F.sequence(F.lit(0), last, F.lit(step))
    windows = F.transform(starts, lambda s: F.array_join(F.slice("_words", s + 1, size), " "))
    keep = [c for c in df.columns if c != text]
    # The outer form: for the inner one Spark adds a filter that makes all windows a second time.
    return (
        df.withColumn("_words", words).select(*keep, F.posexplode_outer(windows).alias("chunk_no", out))
        .filter(F.length(out) > min_chars)
    )


def _once(fn: Callable, kind: T.DataType):
    """Pandas function that Spark does not copy into pushed-down filters, so every row is computed once."""
    return F.pandas_udf(fn, kind).asNondeterministic()


# Rows of an Arrow batch that are held as Python objects or in double at a time, and bytes of results that are given back at a time.
AT_ONCE, OUT_BYTES = 256, 4 << 20


def _once_arrow(fn: Callable, kind: T.DataType):
    """:func:`_once` for a function over Arrow arrays, whose rows never become pandas objects."""
    return F.arrow_udf(fn, kind).asNondeterministic()


def chunk_sentences(
    df: DataFrame, text: str, size: int = 500, overlap: int = 50, min_chars: int = 100, out: str = "content",
) -> DataFrame:
    """Pack whole sentences into chunks of at most ``size`` tokens.

    The next chunk starts with the last sentences of the one before as far as
    they fit into ``overlap`` tokens. A sentence longer than ``size`` is cut into
    pieces of ``size`` tokens first. The cleaning runs as column expressions;
    only the packing of one document's sentences is Python.
    """

    step, most = AT_ONCE, OUT_BYTES

    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def one(body: str) -> list[str]:
            pieces = []
            for sentence in re.split(r"(?<=[.!?])\s+", body):
                words = sentence.split()
                pieces += [words[i:i + size] for i in range(0, len(words), size)]
            chunks, current, count, fresh = [], [], 0, False
            for words in pieces:
                if fresh and count + len(words) > size:
                    chunks.append(current)
                    tail, room = [], min(overlap, size - len(words))
                    for prev in reversed(current):
                        room -= len(prev)
                        if room < 0:
                            break
                        tail.insert(0, prev)
                    current, count = tail, sum(map(len, tail))
                current, count, fresh = [*current, words], count + len(words), True
            if current:
                chunks.append(current)
            return [" ".join(w for s in c for w in s) for c in chunks]

        kind = pa.list_(pa.string())
        for bodies in batches:
            made = []
            for at in range(0, max(1, len(bodies)), step):
                part = bodies.slice(at, step).to_pylist()
                made.append(pa.array([[c for c in one(b) if len(c) > min_chars] if b else [] for b in part], kind))
                if at + step >= len(bodies) or sum(m.nbytes for m in made) >= most:
                    yield pa.concat_arrays(made)
                    made = []

    pack_udf = _once_arrow(pack, T.ArrayType(T.StringType()))
    keep = [c for c in df.columns if c != text]
    return (
        df.withColumn("_chunks", pack_udf(clean_text(F.col(text))))
        .select(*keep, F.posexplode_outer("_chunks").alias("chunk_no", out)).filter(F.col(out).isNotNull())
    )


def embed(df: DataFrame, text: str, dim: int = 1024, fn: Callable | None = None, out: str = "embedding") -> DataFrame:
    """Add an embedding of ``dim`` floats; blank text gives the zero vector.

    By default every lower-cased token adds ±1 at its md5-hashed position and
    the sum is scaled to length 1; hashing runs in the JVM, adding up runs per
    Arrow batch. Of a hash only what gives position and sign is sent to Python. ``fn`` (list of texts → list of vectors) is called per batch
    instead; when it fails, the texts are tried one by one and those that fail
    get the zero vector, which :func:`embedding_failed` tells from blank texts.
    """
    if fn is not None:
        def one(text: str) -> list[float]:
            try:
                return list(map(float, fn([text])[0]))
            except Exception:
                return [0.0] * dim

        def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                full = [t for t in texts if t and t.strip()]
                try:
                    vectors = [list(map(float, v)) for v in (fn(full) if full else [])]
                    if len(vectors) != len(full):
                        raise ValueError("one vector per text is needed")
                except Exception:
                    vectors = [one(t) for t in full]
                found = iter(vectors)
                yield pd.Series([next(found) if t and t.strip() else [0.0] * dim for t in texts])

        call_udf = _once(call, T.ArrayType(T.FloatType()))
        return df.withColumn(out, call_udf(F.col(text)))

    step, most = AT_ONCE, max(AT_ONCE, OUT_BYTES // (4 * dim))

    def add_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for hashes in (whole.slice(at, most) for whole in batches for at in range(0, max(1, len(whole)), most)):
            vectors = np.zeros((len(hashes), dim), np.float32)
            for at in range(0, len(hashes), step):
                part = hashes.slice(at, step)
                lengths = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                h, rows = part.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(part)), lengths)
                v = np.bincount(rows * dim + h % dim, weights=1.0 - 2.0 * ((h // dim) % 2), minlength=len(part) * dim).reshape(-1, dim)
                norm = np.sqrt((v * v).sum(1))
                vectors[at : at + step] = v / np.where(norm > 0, norm, 1.0)[:, None]
            offsets = pa.array(np.arange(len(hashes) + 1, dtype=np.int32) * dim)
            yield pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))

    add_udf = _once_arrow(add_up, T.ArrayType(T.FloatType()))
    kind = "smallint" if 2 * dim <= 1 << 15 else "bigint"
    return df.withColumn(out, add_udf(F.transform(tokens(F.lower(F.col(text))), lambda t: (hash32(t) % (2 * dim)).cast(kind))))


def embedding_failed(text: str, vector: str) -> Column:
    """True where a text that is not blank has no vector or the zero vector: its embedding failed."""
    said = F.size(tokens(F.col(text))) > 0
    return said & F.coalesce(F.forall(vector, lambda v: v == 0), F.lit(True))


def build_embedding_table(docs: DataFrame, table: str, keys: list[str], text: str, dim: int = 1024) -> DataFrame:
    """Clean, chunk, embed and store (id, keys, chunk_no, content, embedding) once; returns the table.

    The text chunks are stored and numbered where they lie; each is then
    embedded on its way into the table. Texts and vectors cross no shuffle.
    """
    chunks = chunk(docs.withColumn(text, clean_text(F.col(text))).select(*keys, text), text)
    embedded = embed(with_surrogate_id(chunks), "content", dim)
    rows = embedded.select("id", *keys, "chunk_no", "content", "embedding")
    append_table(rows, table, rows.schema)
    return docs.sparkSession.table(table)


# Distinct terms that are sent to all tasks; some tens of megabytes.
FEW_TERMS = 500_000


def term_stats(docs: DataFrame, text: str, wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(term, df) and the one-row (n_docs, avg_len) of a corpus, for BM25, from one pass over it.

    Each document contributes each of its terms once, and its length under the
    null term; counts are combined before the shuffle, so a word of every
    document is no hot key. With ``wanted``, one column ``term`` of distinct
    terms, only those are counted: before the shuffle where they are few enough
    to be sent to all tasks, else after it.
    """
    words = tokens(F.lower(F.col(text)))
    kind = "struct<term: string, words: bigint>"
    own = F.struct(F.lit(None).cast("string").alias("term"), F.size(words).cast("long").alias("words")).cast(kind)
    each = F.transform(F.array_distinct(words), lambda t: F.struct(t.alias("term"), F.lit(None).cast("long").alias("words")).cast(kind))
    entries = docs.select(F.explode(F.concat(F.array(own), F.coalesce(each, F.array().cast(f"array<{kind}>")))).alias("e")).select("e.*")
    few = wanted is not None and wanted.count() <= FEW_TERMS
    if few:
        asked = F.broadcast(wanted.withColumn("_asked", F.lit(True)))
        entries = entries.join(asked, "term", "left").filter(F.col("term").isNull() | F.col("_asked"))
    counted = entries.groupBy("term").agg(F.count("*").alias("df"), F.avg("words").alias("avg_len"))
    if wanted is not None and not few:
        counted = counted.join(wanted.withColumn("_asked", F.lit(True)), "term", "left").filter(F.col("term").isNull() | F.col("_asked"))
    counted = materialize(counted, "term-stats")
    freq = counted.filter(F.col("term").isNotNull()).select("term", "df")
    size = counted.filter(F.col("term").isNull()).agg(
        F.coalesce(F.max("df"), F.lit(0)).alias("n_docs"), F.max("avg_len").alias("avg_len"))
    return freq, size


def rerank(
    cands: DataFrame, queries: DataFrame, docs: DataFrame, k: int = 3, *, q_id: str, query: str, text: str,
    k1: float = 1.2, b: float = 0.75,
) -> DataFrame:
    """Keep the k candidates per query with the largest BM25 score.

    ``cands`` has the query id and the candidate's text; ``docs`` is the corpus
    the statistics come from. Each query carries its own terms with their
    inverse document frequencies, so a candidate is scored in one row.
    """
    asked = materialize(
        queries.select(q_id, F.explode(F.array_distinct(tokens(F.lower(F.col(query))))).alias("term")), "asked")
    freq, size = term_stats(docs, text, asked.select("term").distinct())
    n_docs, avg_len = size.first()
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = asked.join(freq, "term").groupBy(q_id).agg(
        F.map_from_entries(F.collect_list(F.struct("term", idf.alias("idf")))).alias("_idf"))
    words = F.col("_words")
    scale = k1 * (1 - b + b * F.size(words) / avg_len)

    def add(total, term):
        tf = F.size(F.filter(words, lambda w: w == term))
        return total + F.element_at("_idf", term) * tf * (k1 + 1) / (tf + scale)

    # Only the query terms that occur in the candidate are counted in it.
    score = F.aggregate(F.array_intersect(words, F.map_keys("_idf")), F.lit(0.0), add)
    scored = (
        cands.join(terms, q_id, "left").withColumn("_words", tokens(F.lower(F.col(text))))
        .withColumn("bm25", F.coalesce(score, F.lit(0.0))).drop("_idf", "_words")
    )
    ties = [c for c in cands.columns if c not in (q_id, text)]
    w = Window.partitionBy(q_id).orderBy(F.desc(F.round("bm25", 9)), *ties)
    return scored.withColumn("new_rank", F.row_number().over(w)).filter(F.col("new_rank") <= k)


TEMPLATE = "Use only these passages to answer.\n\n{context}\n\nQuestion: {question}\n\nAnswer:"


def build_prompts(
    hits: DataFrame, queries: DataFrame, template: str = TEMPLATE, *,
    q_id: str, query: str, rank: str, source: str, text: str,
) -> DataFrame:
    """One prompt per query: the template with its passages in rank order and the question.

    ``hits`` holds the few kept passages per query, each shown with its source.
    """
    passage = F.concat(
        F.lit("Source: "), F.coalesce(F.col(source).cast("string"), F.lit("(not stated)")),
        F.lit("\n"), F.coalesce(F.col(text), F.lit("")))
    context = hits.groupBy(q_id).agg(
        F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"), passage.alias("p")))).alias("_ps"))
    joined = F.array_join(F.transform("_ps", lambda p: p.p), "\n\n")
    head, rest = template.split("{context}")
    middle, tail = rest.split("{question}")
    return queries.select(q_id, query).join(context, q_id).select(
        q_id,
        F.concat(F.lit(head), joined, F.lit(middle), F.col(query), F.lit(tail)).alias("prompt"))
