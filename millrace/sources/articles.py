"""Article corpus from raw web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

# The named character references that are decoded, in order.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def html_text(c) -> Column:
    """Visible text: comments, scripts and styles out, tags to blanks, entities decoded."""
    text = F.regexp_replace(c, r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def ingest_articles(pages: DataFrame, fetch_time: Column | None = None) -> DataFrame:
    """(page_id, title, content, url, fetch_time, content_length), one article per title.

    Content is the text of the ``article`` element. Pages without title or
    content are left out; of pages with the same title the smallest page_id
    stays. Pages are parsed once and stored; the kept ids are then found on
    (title, id) alone, so equal titles fold before any shuffle.
    """
    parsed = materialize(pages.select(
        "page_id",
        html_text(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        html_text(F.regexp_extract("html", r"(?is)<article[^>]*>(.*?)</article>", 1)).alias("content"),
        "url",
        (fetch_time if fetch_time is not None else F.current_timestamp()).alias("fetch_time"),
    ), "articles").filter((F.col("title") != "") & (F.col("content") != ""))
    kept = parsed.groupBy("title").agg(F.min("page_id").alias("page_id")).select("page_id")
    return parsed.join(kept, "page_id", "left_semi").withColumn("content_length", F.length("content").cast("long"))
