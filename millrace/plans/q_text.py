"""Queries: chunking, embedding, retrieval (X-*) and nearest neighbours (J-07, J-08, M-13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import ann_index
from millrace.operators import neighbours as N
from millrace.operators import postings as PO
from millrace.operators import text as X
from millrace.operators import vector_store as VS
from millrace.operators.features import split
from millrace.operators.reshape import ranked
from millrace.plans.q_sources import DOC_CHUNKS, scratch_schema
from millrace.plans.registry import query
from millrace.plans.views import table, texts
from millrace.session import scratch_path

# Lower-cased whitespace tokens per document and per question.
TOKENS = r"""dtok AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(text), '[\s\x{00A0}]+', ' ', 'g')), ' '), lambda t: t <> '') AS w FROM documents),
qtok AS (SELECT item_id, list_filter(string_split(trim(regexp_replace(lower(text), '[\s\x{00A0}]+', ' ', 'g')), ' '), lambda t: t <> '') AS w FROM benchmark)"""
# Documents without citations, runs of blanks and headers.
CLEAN_DOCS = r"""clean AS (SELECT doc_id, lang, source, trim(regexp_replace(regexp_replace(regexp_replace(text, '\[\d+\]', '', 'g'),
  '[\s\x{00A0}]+', ' ', 'g'), '={2,}.*?={2,}', '', 'g')) AS text FROM documents)"""
DIM = 1024
# Signed feature hashing: position h % dim, sign by the next bit.
HASHED = """{0}h AS (SELECT {1} AS id, ('0x' || substr(md5(t), 1, 8))::BIGINT AS h FROM (SELECT {1}, unnest(w) AS t FROM {0}tok)),
{0}c AS (SELECT id, h % 1024 AS b, sum(1 - 2 * ((h // 1024) % 2))::DOUBLE AS v FROM {0}h GROUP BY 1, 2),
{0}e AS (SELECT id, b, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS v FROM {0}c WHERE v <> 0)"""
EMBEDDED = f"{TOKENS}, {HASHED.format('d', 'doc_id')}, {HASHED.format('q', 'item_id')}"


@query("x_02_chunk", f"WITH {DOC_CHUNKS} SELECT doc_id, chunk_no, content FROM chunks")
def x_02(spark, sf):
    return X.chunk(texts(spark, sf).select("doc_id", "text"), "text")


# Pieces are sentences, cut at 500 words; cum holds the words before each piece. A chunk is a run of pieces (s, e):
# as many as fit into 500 words, beginning with those last pieces of the chunk before that fit into 50.
@query("x_03_chunk_sentences", rf"""
WITH RECURSIVE {CLEAN_DOCS},
sents AS (SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) AS si
  FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS l FROM clean)),
words AS (SELECT doc_id, si, list_filter(string_split(sentence, ' '), lambda t: t <> '') AS w FROM sents),
pieces AS (SELECT doc_id, si, len(w) AS n, unnest(range(0, len(w), 500)) AS pos FROM words),
ends AS (SELECT doc_id, si, pos, sum(least(500, n - pos)) OVER (PARTITION BY doc_id ORDER BY si, pos)::BIGINT AS c FROM pieces),
docs AS MATERIALIZED (SELECT doc_id, cum, w FROM (SELECT doc_id, list_prepend(0, list(c ORDER BY si, pos)) AS cum FROM ends GROUP BY 1)
  JOIN (SELECT doc_id, flatten(list(w ORDER BY si)) AS w FROM words GROUP BY 1) USING (doc_id)),
runs AS (
  SELECT doc_id, 0::BIGINT AS s, len(list_filter(cum, lambda x: x <= 500)) - 1 AS e FROM docs
  UNION ALL
  SELECT doc_id, s2, len(list_filter(cum, lambda x: x <= cum[s2 + 1] + 500)) - 1
  FROM (SELECT doc_id, cum, greatest(s, len(list_filter(cum, lambda x: x < cum[e + 1] - least(50, 500 - (cum[e + 2] - cum[e + 1]))))) AS s2
    FROM runs JOIN docs USING (doc_id) WHERE e < len(cum) - 1)),
filled AS (SELECT doc_id, e, array_to_string(w[cum[s + 1] + 1 : cum[e + 1]], ' ') AS content FROM runs JOIN docs USING (doc_id))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY e) - 1)::INTEGER AS chunk_no, content FROM filled WHERE length(content) > 100""")
def x_03(spark, sf):
    return X.chunk_sentences(texts(spark, sf).select("doc_id", "text"), "text")


@query("x_04_embed", f"""
WITH {EMBEDDED} SELECT id AS doc_id, b::INTEGER AS pos, round(v::FLOAT::DOUBLE, 5) AS weight FROM de""")
def x_04(spark, sf):
    docs = X.embed(texts(spark, sf).select("doc_id", "text"), "text", DIM)
    return docs.select("doc_id", F.posexplode("embedding").alias("pos", "weight")).filter("weight <> 0").select(
        "doc_id", "pos", F.round(F.col("weight").cast("double"), 5).alias("weight"))


@query("x_05_embedding_table", rf"""
WITH {CLEAN_DOCS},
{DOC_CHUNKS.replace('FROM documents', 'FROM clean')}
SELECT doc_id, chunk_no, length(content)::INTEGER AS chars, 1024 AS dims, 1.0::DOUBLE AS norm, TRUE AS ids_dense FROM chunks""")
def x_05(spark, sf):
    name = f"{scratch_schema(spark)}.embeddings"
    stored = X.build_embedding_table(texts(spark, sf).select("doc_id", "text"), name, ["doc_id"], "text", DIM)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    dense = stored.agg(
        (F.count_distinct("id") == F.count("*")) & (F.min("id") == 1) & (F.max("id") == F.count("*"))).scalar()
    return stored.select("doc_id", "chunk_no", F.length("content").alias("chars"), F.size("embedding").alias("dims"),
                         F.round(norm, 4).alias("norm"), dense.alias("ids_dense"))


DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"
COS = f"{DOT.format('a.embedding', 'b.embedding')} / (sqrt({DOT.format('a.embedding', 'a.embedding')}) * sqrt({DOT.format('b.embedding', 'b.embedding')}))"


@query("x_06_similarity_search", f"""
WITH s AS (SELECT b.vec_id, b.label, round({COS}, 9) AS score FROM embeddings a, embeddings b WHERE a.vec_id = 0)
SELECT vec_id, label, round(score, 6) AS score FROM s ORDER BY s.score DESC, vec_id LIMIT 5""")
def x_06(spark, sf):
    base = table(spark, sf, "embeddings")
    question = base.filter("vec_id = 0").first().embedding
    return N.similarity_search(base, question, ["label"], 5, vec="embedding", key="vec_id").withColumn("score", F.round("score", 6))


@query("x_06_search_stored", f"""
WITH s AS (SELECT b.vec_id, b.label, round({COS}, 9) AS score FROM embeddings a, embeddings b WHERE a.vec_id = 0)
SELECT vec_id AS id, label, round(score, 6) AS score FROM s ORDER BY s.score DESC, vec_id LIMIT 5""")
def x_06_stored(spark, sf):
    """The same from vectors stored by cell, of which the cells in reach are read."""
    base, path = table(spark, sf, "embeddings"), scratch_path(spark, "vectors")
    question = base.filter("vec_id = 0").first().embedding
    VS.store_by_cell(base, path, key="vec_id", vec="embedding", cols=["label"])
    found = VS.search_stored(spark, path, list(map(float, question)), 5, cols=["label"])
    return found.withColumn("score", F.round("score", 6))


@query("j_07_knn", f"""
WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, round({COS}, 9) AS score FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id)
SELECT query_id, neighbour_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbour_id)::INTEGER AS rank FROM s) WHERE rank <= 5""")
def j_07(spark, sf):
    base = table(spark, sf, "embeddings")
    return N.knn(base, base, 5, q_id="vec_id", q_vec="embedding", b_id="vec_id", b_vec="embedding",
                 exclude_self=True).withColumn("score", F.round("score", 6))


@query("j_07_knn_partitioned", f"""
WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, round({COS}, 9) AS score FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id)
SELECT query_id, neighbour_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbour_id)::INTEGER AS rank FROM s) WHERE rank <= 5""")
def j_07_partitioned(spark, sf):
    """The way for query sets too large to broadcast."""
    base = table(spark, sf, "embeddings")
    return N.knn(base, base, 5, q_id="vec_id", q_vec="embedding", b_id="vec_id", b_vec="embedding",
                 exclude_self=True, broadcast_bytes=0, cells=16).withColumn("score", F.round("score", 6))


@query("j_08_ann", f"""
WITH pivots AS (SELECT vec_id, embedding FROM embeddings ORDER BY ('0x' || substr(md5(vec_id::VARCHAR), 1, 8))::BIGINT, vec_id LIMIT 16),
near AS (SELECT a.vec_id, b.vec_id AS pivot, row_number() OVER (PARTITION BY a.vec_id ORDER BY {COS} DESC) AS place FROM embeddings a, pivots b),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, round({COS}, 9) AS score
  FROM near probe JOIN near cell ON probe.pivot = cell.pivot AND probe.place <= 6 AND cell.place = 1 AND probe.vec_id <> cell.vec_id
  JOIN embeddings a ON a.vec_id = probe.vec_id JOIN embeddings b ON b.vec_id = cell.vec_id)
SELECT query_id, neighbour_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbour_id)::INTEGER AS rank FROM s) WHERE rank <= 5""")
def j_08(spark, sf):
    base = table(spark, sf, "embeddings")
    return N.ann(base, base, 5, q_id="vec_id", q_vec="embedding", b_id="vec_id", b_vec="embedding",
                 exclude_self=True, cells=16, probes=6).withColumn("score", F.round("score", 6))


@query("j_08_ann_index", f"""
WITH s AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, round({COS}, 9) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT query_id, neighbour_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbour_id)::INTEGER AS rank FROM s) WHERE rank <= 5""")
def j_08_index(spark, sf):
    """The stored index with every cell visited and long short lists: the exact neighbours, so that SQL can say them."""
    base = table(spark, sf, "embeddings")
    index = ann_index.build(base, key="vec_id", vec="embedding", cells=64)
    found = ann_index.search(index, base, 5, key="vec_id", vec="embedding", exclude_self=True, probes=index.cells, near=64, short=400)
    return found.withColumn("score", F.round("score", 6))


@query("j_08_ann_measured")
def j_08_measured(spark, sf):
    """The stored index as it is meant to be used, with the measured number of visited cells."""
    base = table(spark, sf, "embeddings")
    return N.ann(base, base, 5, q_id="vec_id", q_vec="embedding", b_id="vec_id", b_vec="embedding", exclude_self=True)


VEC_HASH = "('0x' || substr(md5(vec_id || '|42'), 1, 8))::BIGINT < 3435973836"


@query("m_13_knn_classify", f"""
WITH d AS (SELECT a.vec_id, b.vec_id AS n, b.label, round(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: pow(p[1]::DOUBLE - p[2]::DOUBLE, 2)))), 9) AS dist
  FROM (SELECT * FROM embeddings WHERE NOT {VEC_HASH}) a, (SELECT * FROM embeddings WHERE {VEC_HASH}) b),
k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, n) <= 5),
v AS (SELECT vec_id, label, count(*) AS votes FROM k GROUP BY 1, 2)
SELECT vec_id, label AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, label) = 1""")
def m_13(spark, sf):
    train, test = split(table(spark, sf, "embeddings"), ["vec_id"], 0.8)
    return N.knn_classify(train, test, 5, key="vec_id", vec="embedding", label="label")


def _candidates(spark, sf):
    """The five most similar documents per question, with their texts."""
    docs, questions = texts(spark, sf), table(spark, sf, "benchmark")
    hits = N.knn(X.embed(questions, "text", DIM), X.embed(docs.select("doc_id", "text"), "text", DIM), 5,
                 q_id="item_id", q_vec="embedding", b_id="doc_id", b_vec="embedding")
    hits = hits.select(F.col("query_id").alias("item_id"), F.col("neighbour_id").alias("doc_id"), "score", "rank")
    return hits.join(docs.select("doc_id", "text"), "doc_id"), docs, questions


def _reranked(spark, sf):
    hits, docs, questions = _candidates(spark, sf)
    return X.rerank(hits.select("item_id", "doc_id", "text"), questions.select("item_id", F.col("text").alias("question")),
                    docs, 3, q_id="item_id", query="question", text="text"), questions


# Stored vectors are single precision, so similarities are too.
HITS_SQL = f"""{EMBEDDED},
qf AS (SELECT id, b, v::FLOAT::DOUBLE AS v FROM qe), df AS (SELECT id, b, v::FLOAT::DOUBLE AS v FROM de),
qn AS (SELECT id, sqrt(sum(v * v)) AS n FROM qf GROUP BY 1), dn AS (SELECT id, sqrt(sum(v * v)) AS n FROM df GROUP BY 1),
dots AS (SELECT q.id AS item_id, d.id AS doc_id, sum(q.v * d.v) AS dot FROM qf q JOIN df d USING (b) GROUP BY 1, 2),
cos AS (SELECT qn.id AS item_id, dn.id AS doc_id, round(coalesce(dot, 0) / (qn.n * dn.n), 9) AS score
  FROM qn CROSS JOIN dn LEFT JOIN dots ON dots.item_id = qn.id AND dots.doc_id = dn.id),
hits AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM cos QUALIFY rank <= 5)"""

BM25_SQL = f"""{HITS_SQL},
corpus AS (SELECT count(*) AS n_docs, avg(len(w)) AS avg_len FROM dtok),
freq AS (SELECT t, count(*) AS df FROM (SELECT unnest(list_distinct(w)) AS t FROM dtok) GROUP BY 1),
qt AS (SELECT item_id, unnest(list_distinct(w)) AS t FROM qtok),
scored AS (SELECT hits.item_id, hits.doc_id, sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS bm25
  FROM (SELECT hits.item_id, hits.doc_id, qt.t, len(list_filter(dtok.w, lambda x: x = qt.t)) AS tf, len(dtok.w) AS len
    FROM hits JOIN dtok USING (doc_id) JOIN qt ON qt.item_id = hits.item_id) hits JOIN freq ON freq.t = hits.t, corpus GROUP BY 1, 2),
top AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(bm25, 9) DESC, doc_id)::INTEGER AS new_rank FROM scored QUALIFY new_rank <= 3)"""


@query("w_02_ranked_hits", f"WITH {HITS_SQL} SELECT item_id, doc_id, round(score, 6) AS score, rank FROM hits")
def w_02_hits(spark, sf):
    hits, _, _ = _candidates(spark, sf)
    return ranked(hits.select("item_id", "doc_id", F.round("score", 9).alias("score")), "item_id", "score", "doc_id").withColumn(
        "score", F.round("score", 6))


@query("x_07_rerank", f"WITH {BM25_SQL} SELECT item_id, doc_id, round(bm25, 6) AS bm25, new_rank FROM top")
def x_07(spark, sf):
    top, _ = _reranked(spark, sf)
    return top.select("item_id", "doc_id", F.round("bm25", 6).alias("bm25"), "new_rank")


@query("x_07_rerank_indexed", f"WITH {BM25_SQL} SELECT item_id, doc_id, round(bm25, 6) AS bm25, new_rank FROM top")
def x_07_indexed(spark, sf):
    """The same ranks from a stored index, to which the corpus came in three batches, one of them twice."""
    hits, docs, questions = _candidates(spark, sf)
    path = scratch_path(spark, "postings")
    for batch in (0, 1, 2, 1):
        PO.add_documents(docs.filter(F.col("doc_id") % 3 == batch), path, batch, "doc_id", "text")
    top = PO.rerank_indexed(hits.select("item_id", "doc_id"), questions.select("item_id", F.col("text").alias("question")), path, 3,
                            q_id="item_id", key="doc_id", query="question")
    return top.select("item_id", "doc_id", F.round("bm25", 6).alias("bm25"), "new_rank")


@query("x_08_build_prompts", f"""
WITH {BM25_SQL}, ctx AS (
  SELECT item_id, string_agg('Source: ' || doc_id || chr(10) || documents.text, chr(10) || chr(10) ORDER BY new_rank) AS context
  FROM top JOIN documents USING (doc_id) GROUP BY 1)
SELECT item_id, 'Use only these passages to answer.' || chr(10) || chr(10) || context || chr(10) || chr(10) || 'Question: ' || text
  || chr(10) || chr(10) || 'Answer:' AS prompt FROM ctx JOIN benchmark USING (item_id)""")
def x_08(spark, sf):
    top, questions = _reranked(spark, sf)
    return X.build_prompts(top, questions, q_id="item_id", query="text", rank="new_rank", source="doc_id", text="text")
