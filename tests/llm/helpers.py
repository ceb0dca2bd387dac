"""Small tables for the tests of the training-text operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, *texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def scanned(spark, df, path):
    """The frame as a scan of files, the way the pipeline hands documents on."""
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


#: Null, empty, blank, repeated and very long texts, in a table with clashing column names.
ODD = [None, "", " \n\t ", "word", "word", "ab " * 60_000, "x" * 200_000, "1" * 50_000 + "@" + "." * 100]


def odd(spark):
    df = documents(spark, *ODD, None, ids=[0, 1, 2, 3, 3, 5, 6, None, None])
    return df.selectExpr("doc_id", "text", "lang", "source", "n_chars", "1 as score", "2 as fp", "3 as rank", "4 as bucket")
