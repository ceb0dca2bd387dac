"""Re-ranking from the stored index against re-ranking from the texts."""

from pyspark.sql import functions as F

from millrace.operators import postings as P
from millrace.operators import text as X
from millrace.session import scratch_path
from tests.conftest import rows_of

WORDS = "river stone light the of a Mill wheel water grain flour bread oven fire smoke".split()


def corpus(spark, n=90):
    rows = [(i, " ".join(WORDS[(i * k + k * k) % len(WORDS)] for k in range(1, 4 + i % 11))) for i in range(n)]
    return spark.createDataFrame(rows + [(n, ""), (n + 1, None)], "id long, text string")


def asked(spark):
    return spark.createDataFrame([(1, "the water of the mill"), (2, "smoke Oven unheard"), (3, ""), (4, "nothing known")], "q long, question string")


def ranks(df):
    return rows_of(df.withColumn("bm25", F.round("bm25", 8)), "q", "id", "bm25", "new_rank")


def test_same_scores_as_from_the_texts(spark):
    docs, questions, path = corpus(spark), asked(spark), scratch_path(spark, "postings")
    cands = questions.select("q").crossJoin(docs.select("id").filter("id % 4 = 1 OR id >= 90"))
    want = X.rerank(cands.join(docs, "id"), questions, docs, 5, q_id="q", query="question", text="text")
    for batch in (0, 1, 1):
        P.add_documents(docs.filter(F.col("id") % 2 == batch), path, batch, "id", "text")
    got = P.rerank_indexed(cands, questions, path, 5, q_id="q", key="id", query="question")
    assert ranks(got) == ranks(want.select("q", "id", "bm25", "new_rank"))


def test_appended_documents_change_the_statistics(spark):
    docs, questions, path = corpus(spark), asked(spark), scratch_path(spark, "postings")
    cands = questions.select("q").crossJoin(docs.select("id").filter("id < 20"))
    for n, part in enumerate((docs.filter("id < 30"), docs.filter("id >= 30"))):
        P.add_documents(part, path, n, "id", "text")
        so_far = docs.filter("id < 30") if n == 0 else docs
        want = X.rerank(cands.join(docs, "id"), questions, so_far, 3, q_id="q", query="question", text="text")
        assert ranks(P.rerank_indexed(cands, questions, path, 3, q_id="q", key="id", query="question")) == ranks(want.select("q", "id", "bm25", "new_rank"))


def test_reads_no_text_and_knows_strangers(spark):
    docs, path = corpus(spark), scratch_path(spark, "postings")
    P.add_documents(docs, path, 0, "id", "text")
    got = P.rerank_indexed(asked(spark).select("q", F.lit(999).cast("long").alias("id")), asked(spark), path, 3, q_id="q", key="id", query="question")
    assert rows_of(got, "q", "id", "bm25") == [(q, 999, 0.0) for q in (1, 2, 3, 4)]
    assert all("/postings-" in f or "/asked-" in f for f in got.inputFiles())
    postings, totals = P.read_postings(spark, path)
    assert totals.filter("term = 'mill'").first()["df"] == postings.filter("term = 'mill'").count() > 0


def test_an_index_without_documents(spark):
    path = scratch_path(spark, "postings")
    P.add_documents(corpus(spark).limit(0), path, 0, "id", "text")
    got = P.rerank_indexed(asked(spark).select("q", F.lit(1).cast("long").alias("id")), asked(spark), path, 3, q_id="q", key="id", query="question")
    assert rows_of(got, "q", "bm25") == [(q, 0.0) for q in (1, 2, 3, 4)]
