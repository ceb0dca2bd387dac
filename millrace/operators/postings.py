"""A stored inverted index of a corpus: postings, document lengths and term totals, kept up by append.

Each batch of documents is tokenised once, when it is added. Its folder holds a row
(``term``, ``key``, ``tf``) for every term of a document, in parts by hash of the term and sorted by
it, and a row with a null term and the document's length; a second folder holds how many documents
have each term. Re-ranking then needs the rows of the questions' terms and the candidates'
lengths only: parts and file statistics rule out the rest, and no text is read.

A batch added again replaces its rows. A document belongs to one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import tokens
from millrace.session import materialize

#: Parts by hash of the term; the lengths have a part of their own. Pieces that a part is written in.
PARTS, PIECES = 32, 8
LENGTHS = -1
#: Documents whose words are held at a time.
AT_ONCE = 256
TOTALS = "term string, df long, words long, batch int"


def _part(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(PARTS)).cast("int")


def _counted(kind: str):
    """Rows of one document: each term with its count, and its length under the null term."""
    step = AT_ONCE

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        for batch in (whole.slice(at, step) for whole in batches for at in range(0, whole.num_rows, step)):
            rows, terms, counts = [], [], []
            for row, words in enumerate(batch.column(1).to_pylist()):
                found = Counter(words or ())
                rows += [row] * (len(found) + 1)
                terms += [None, *found]
                counts += [len(words or ()), *found.values()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(terms, pa.string()), pa.array(counts, pa.int64())],
                names=["key", "term", "tf"])

    return run, f"key {kind}, term string, tf long"


def add_documents(docs: DataFrame, path: str, batch: int, key: str, text: str) -> None:
    """Add (or replace) a batch of documents. The texts are read once."""
    spark = docs.sparkSession
    run, schema = _counted(docs.schema[key].dataType.simpleString())
    words = docs.select(F.col(key).alias("key"), tokens(F.lower(F.col(text))).alias("words"))
    rows = words.mapInArrow(run, schema).withColumn("part", F.when(F.col("term").isNull(), LENGTHS).otherwise(_part(F.col("term"))))
    # A word of every document is spread over the pieces of its part.
    at = f"{path}/postings/batch={batch}"
    rows.repartition("part", F.pmod(F.xxhash64("key"), F.lit(PIECES))).sortWithinPartitions("part", "term").write.partitionBy(
        "part").mode("overwrite").parquet(at)
    stored = spark.read.schema(f"{schema}, part int").parquet(at)
    stored.groupBy("term").agg(F.count("*").alias("df"), F.sum(F.when(F.col("term").isNull(), F.col("tf"))).alias("words")).repartitionByRange(
        "term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms/batch={batch}")


def read_postings(spark: SparkSession, path: str, key_type: str = "long") -> tuple[DataFrame, DataFrame]:
    """(``key``, ``term``, ``tf``, ``part``, ``batch``) and (``term``, ``df``, ``words``, ``batch``) of all batches."""
    return (spark.read.schema(f"key {key_type}, term string, tf long, batch int, part int").parquet(f"{path}/postings"),
            spark.read.schema(TOTALS).parquet(f"{path}/terms"))


def rerank_indexed(
    cands: DataFrame, queries: DataFrame, path: str, k: int = 3, *, q_id: str, key: str, query: str, k1: float = 1.2, b: float = 0.75,
) -> DataFrame:
    """Keep the k candidates (``q_id``, ``key``) per query with the largest BM25 score, ties by the smaller key.

    Statistics are those of all documents in the index; a candidate that is not in it scores 0.
    """
    spark = cands.sparkSession
    postings, totals = read_postings(spark, path, cands.schema[key].dataType.simpleString())
    asked = materialize(
        queries.select(q_id, F.explode(F.array_distinct(tokens(F.lower(F.col(query))))).alias("term")), "asked")
    n_docs, words = totals.filter(F.col("term").isNull()).agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    freq = totals.join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    pairs = cands.join(asked, q_id).join(freq.select("term", idf.alias("idf")), "term").select(
        q_id, F.col(key).alias("key"), "term", "idf", _part(F.col("term")).alias("part"))
    lengths = postings.filter(F.col("part") == LENGTHS).select("key", F.col("tf").alias("length"))
    average = words / n_docs if n_docs and words else 1.0
    gain = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / average))
    hits = pairs.join(postings.filter(F.col("part") != LENGTHS).drop("batch"), ["part", "term", "key"]).join(lengths, "key")
    scores = hits.groupBy(q_id, "key").agg(F.sum(gain).alias("_bm25")).withColumnRenamed("key", key)
    scored = cands.join(scores, [q_id, key], "left").withColumn("bm25", F.coalesce("_bm25", F.lit(0.0))).drop("_bm25")
    order = Window.partitionBy(q_id).orderBy(F.desc(F.round("bm25", 9)), key)
    return scored.withColumn("new_rank", F.row_number().over(order)).filter(F.col("new_rank") <= k)
