"""Exact length histogram: what every context limit keeps, cuts and fills.

Documents are encoded once and only their lengths are kept and counted, combined
before the shuffle, so a length that a third of all documents share costs one row
per task. Suffix sums over the histogram then answer, for each length taken as a
context limit, the totals of what fits and of what is cut, without another look at
the documents.

Defined cases: a null, empty or blank text has length 0 and is counted; repeated rows
count each; an empty table gives an empty histogram; only the text column is read, so
other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import shared_encoder, utf8
from millrace.session import materialize

#: Lengths summed in one sorted group; the groups' totals are summed up after that.
STEP = 64


def _lengths(tokenizer: str | None):
    def run(batches):
        import pyarrow as pa

        encoder = shared_encoder(tokenizer)
        for batch in batches:
            found = [len(ids) // 4 for ids in encoder.encode(utf8(batch.column(0)))]
            yield pa.RecordBatch.from_arrays([pa.array(found, "i8")], names=["n_tokens"])

    return run


def histogram(df: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``n_tokens`` and ``n_docs``, the number of texts of that encoded length; stored."""
    lengths = df.select(df[text].cast("string").alias("text")).mapInArrow(_lengths(tokenizer), "n_tokens long")
    return materialize(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")


def limits(hist: DataFrame) -> DataFrame:
    """One row per length L of the histogram, with the totals for the context limit L.

    ``docs_over`` and ``tokens_over`` are suffix sums over longer documents;
    ``tokens_kept`` counts min(length, L) of every document, ``tokens_cut`` the rest,
    and ``share_whole`` is the share of documents that fit, so the q-quantile of the
    lengths is the least L with share_whole >= q.
    """
    cells = hist.select(
        "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / STEP).alias("step"))
    later = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    steps = cells.groupBy("step").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t")).select(
        F.col("step").alias("_step"),
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("_d"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("_t"))
    longer = Window.partitionBy("step").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    over = cells.withColumns({
        "_docs": F.coalesce(F.sum("n_docs").over(longer), F.lit(0)),
        "_tokens": F.coalesce(F.sum("tokens").over(longer), F.lit(0)),
    }).join(steps, F.col("step") == F.col("_step")).select(
        "n_tokens", "n_docs", (F.col("_docs") + F.col("_d")).alias("docs_over"),
        (F.col("_tokens") + F.col("_t")).alias("tokens_over"))
    total = hist.agg(F.sum("n_docs").alias("docs"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("tokens"))
    docs, tokens = total.select("docs").scalar(), total.select("tokens").scalar()
    kept = tokens - F.col("tokens_over") + F.col("n_tokens") * F.col("docs_over")
    return over.select(
        F.col("n_tokens").alias("context_limit"), "n_docs", "docs_over", "tokens_over",
        kept.alias("tokens_kept"), (tokens - kept).alias("tokens_cut"),
        F.try_divide(docs - F.col("docs_over"), docs).alias("share_whole"))


def answer(hist: DataFrame, context_limits: list[int]) -> DataFrame:
    """The totals of :func:`limits` for any given limits, whether or not a document has such a length.

    The limits join the histogram as lengths of no documents, so nothing else changes;
    an empty histogram keeps no tokens and has no share.
    """
    wanted = hist.sparkSession.createDataFrame([(int(x),) for x in sorted(set(context_limits))], "n_tokens long")
    cells = hist.select("n_tokens", "n_docs").unionByName(wanted.withColumn("n_docs", F.lit(0).cast("long")))
    found = limits(cells.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")))
    return found.join(F.broadcast(wanted), F.col("context_limit") == F.col("n_tokens"), "left_semi")


def quantile(hist: DataFrame, q: float):
    """The least length that a share ``q`` of the documents does not exceed; null for an empty histogram."""
    row = limits(hist).filter(F.col("share_whole") >= q).agg(F.min("context_limit")).first()
    return row[0]


def query(spark, docs: DataFrame) -> DataFrame:
    """Totals, cuts and the share of whole documents for every encoded length of the corpus as context limit."""
    return limits(histogram(docs))
