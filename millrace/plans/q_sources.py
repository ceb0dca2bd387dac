"""Queries: sources and sinks (S-*)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.rows import sanitize_columns
from millrace.operators.text import chunk
from millrace.plans.registry import query
from millrace.plans.views import BK, bookings, table, texts
from millrace.session import scratch_path
from millrace.sources import tables as io
from millrace.sources.articles import ingest_articles


def scratch_schema(spark) -> str:
    """A schema of its own in the shared folder, for queries that write tables."""
    path = scratch_path(spark, "schema")
    name = "millrace_" + path.rsplit("-", 1)[1]
    io.ensure_schema(spark, name, path)
    return name


@query("s_01_read_csv", """
SELECT p_brand, p_type, count(*) AS n, sum(p_size)::BIGINT AS size, round(sum(p_retailprice), 2) AS price
FROM part GROUP BY 1, 2""")
def s_01(spark, sf):
    path = scratch_path(spark, "csv")
    part = table(spark, sf, "part")
    part.write.option("header", True).csv(path)
    return io.read_csv(spark, path, part.schema).groupBy("p_brand", "p_type").agg(
        F.count("*").alias("n"), F.sum("p_size").alias("size"), F.round(F.sum("p_retailprice"), 2).alias("price"))


@query("s_02_read_parquet", """
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1""")
def s_02(spark, sf):
    return io.read_parquet(spark, f"{sf}/lineitem.parquet").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("s_03_read_many", """
SELECT month(o_orderdate)::INTEGER AS month, count(*) AS n, sum(o_custkey)::BIGINT AS custkeys,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def s_03(spark, sf):
    root = scratch_path(spark, "monthly")
    orders = table(spark, sf, "orders").withColumn("m", F.month("o_orderdate"))
    odd = F.col("m") % 2 == 1
    orders.filter(odd).write.partitionBy("m").parquet(f"{root}/odd")
    # The even months carry a narrower key type, as yearly drops of one source do.
    narrow = orders.filter(~odd).withColumn("o_custkey", F.col("o_custkey").cast("int"))
    narrow.write.partitionBy("m").parquet(f"{root}/even")
    paths = [f"{root}/{'odd' if m % 2 else 'even'}/m={m}" for m in range(1, 13)]
    df = io.read_many(spark, paths, {"o_custkey": "bigint", "o_totalprice": "double"})
    return df.groupBy(F.month("o_orderdate").alias("month")).agg(
        F.count("*").alias("n"), F.sum("o_custkey").alias("custkeys"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s_04_read_table", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def s_04(spark, sf):
    name = f"{scratch_schema(spark)}.customer"
    io.write_table(table(spark, sf, "customer"), name)
    return io.read_table(spark, name).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("s_05_read_path", "SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1")
def s_05(spark, sf):
    path = scratch_path(spark, "supplier")
    io.write_path(table(spark, sf, "supplier"), path)
    return io.read_path(spark, path).groupBy("s_nationkey").agg(F.count("*").alias("n"))


@query("s_06_from_rows", """
SELECT v.tier, count(*) AS n, round(avg(c_acctbal), 4) AS balance
FROM customer JOIN (VALUES ('BUILDING', 'premium'), ('MACHINERY', 'premium'), ('AUTOMOBILE', 'standard'),
  ('FURNITURE', 'standard'), ('HOUSEHOLD', 'standard')) v(segment, tier) ON c_mktsegment = v.segment
GROUP BY 1""")
def s_06(spark, sf):
    rows = [("BUILDING", "premium"), ("MACHINERY", "premium"), ("AUTOMOBILE", "standard"),
            ("FURNITURE", "standard"), ("HOUSEHOLD", "standard")]
    tiers = io.from_rows(spark, rows, "segment string, tier string")
    customer = table(spark, sf, "customer")
    return customer.join(F.broadcast(tiers), F.col("c_mktsegment") == F.col("segment")).groupBy("tier").agg(
        F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("balance"))


@query("s_07_write_table", """
SELECT p_brand, count(*) AS n, round(max(p_retailprice), 2) AS top_price FROM part GROUP BY 1""")
def s_07(spark, sf):
    name = f"{scratch_schema(spark)}.part"
    part = table(spark, sf, "part")
    io.write_table(part.select("p_partkey"), name)
    io.write_table(part, name)
    return io.read_table(spark, name).groupBy("p_brand").agg(
        F.count("*").alias("n"), F.round(F.max("p_retailprice"), 2).alias("top_price"))


@query("s_08_write_path", """
SELECT event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1""")
def s_08(spark, sf):
    path = scratch_path(spark, "events")
    io.write_path(table(spark, sf, "events"), path)
    return io.read_path(spark, path).groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))


# One chunk per window of 500 tokens with 50 shared, at more than 100 characters.
CHUNKS = r"""words AS (
  SELECT doc_id, lang, source, list_filter(string_split(trim(regexp_replace(text, '[\s\x{{00A0}}]+', ' ', 'g')), ' '), lambda t: t <> '') AS w
  FROM {source}),
chunks AS (
  SELECT doc_id, lang, source, ((s) / 450)::INTEGER AS chunk_no, array_to_string(w[s + 1 : s + 500], ' ') AS content
  FROM (SELECT *, unnest(range(0, greatest(len(w) - 51, 0) + 1, 450)) AS s FROM words WHERE len(w) > 0)
  WHERE length(array_to_string(w[s + 1 : s + 500], ' ')) > 100)"""
DOC_CHUNKS = CHUNKS.format(source="documents")


@query("s_09_append_table", f"""
WITH {DOC_CHUNKS}
SELECT lang, (2 * count(*))::BIGINT AS n, (2 * sum(length(content)))::BIGINT AS chars FROM chunks GROUP BY 1""")
def s_09(spark, sf):
    name = f"{scratch_schema(spark)}.chunks"
    schema = T.StructType.fromDDL("doc_id bigint, lang string, chunk_no int, content string")
    chunks = chunk(texts(spark, sf).select("doc_id", "lang", "text"), "text")
    io.append_table(chunks, name, schema)
    io.append_table(chunks.select("content", "chunk_no", "lang", "doc_id"), name, schema)
    return io.read_table(spark, name).groupBy("lang").agg(
        F.count("*").alias("n"), F.sum(F.length("content")).alias("chars"))


@query("s_10_table_ddl", "SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def s_10(spark, sf):
    schema = scratch_schema(spark)
    io.ensure_schema(spark, schema)
    for name in ("nation", "region"):
        io.drop_table(spark, f"{schema}.{name}")
        io.write_table(table(spark, sf, name), f"{schema}.{name}")
    nation, region = spark.table(f"{schema}.nation"), spark.table(f"{schema}.region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(
        F.count("*").alias("nations"))


@query("s_11_compact", """
SELECT user_id, count(*) AS n, round(sum(value), 2) AS value, TRUE AS compacted FROM events GROUP BY 1""")
def s_11(spark, sf):
    path = scratch_path(spark, "small-files")
    table(spark, sf, "events").repartition(32).write.parquet(path)
    before = io.file_count(spark.read.parquet(path))
    df = io.compact(spark, path, 2)
    fewer = io.file_count(df) < before
    return df.groupBy("user_id").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value")).withColumn("compacted", F.lit(fewer))


@query("s_12_surrogate_id", """
SELECT doc_id, row_number() OVER (ORDER BY ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 256, doc_id) AS id
FROM documents""")
def s_12(spark, sf):
    return io.with_surrogate_id(table(spark, sf, "documents").select("doc_id"), ["doc_id"])


@query("s_12_surrogate_id_unkeyed", """
SELECT count(*) AS n, count(*) AS n_ids, 1::BIGINT AS first_id, count(*) AS last_id FROM events""")
def s_12_unkeyed(spark, sf):
    ids = io.with_surrogate_id(table(spark, sf, "events").select("user_id", "event_type"))
    return ids.agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"),
        F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("s_13_sanitize_columns", f"""
WITH {BK} SELECT hotel, assigned_room_type AS Room_Type, (is_canceled = 'yes')::INTEGER AS is_canceled_yes, count(*) AS n
FROM bk GROUP BY 1, 2, 3""")
def s_13(spark, sf):
    bk = bookings(spark, sf, "hotel", "assigned_room_type", "is_canceled")
    wide = bk.select("hotel", F.col("assigned_room_type").alias("Room Type"),
                     (F.col("is_canceled") == "yes").alias("is_canceled/yes"))
    df = sanitize_columns(wide)
    return df.groupBy(*df.columns).agg(F.count("*").alias("n"))


# The columns and types of the test tables that form the catalog.
CATALOG = {
    "bronze": {"events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
                          ("event_type", "string"), ("value", "double"), ("props", "string")]},
    "silver": {"customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                            ("c_acctbal", "double"), ("c_mktsegment", "string")]},
    "gold": {"nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")]},
}
CATALOG_SQL = "\nUNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{t}' AS \"table\", '{c}' AS \"column\", '{k}' AS type, count({c}) AS non_null FROM {t}"
    for layer, ts in CATALOG.items() for t, cols in ts.items() for c, k in cols)


@query("s_14_describe_catalog", CATALOG_SQL)
def s_14(spark, sf):
    layers = {}
    for layer, names in CATALOG.items():
        layers[layer] = scratch_schema(spark)
        for name in names:
            spark.sql(f"CREATE TABLE {layers[layer]}.{name} USING parquet OPTIONS (path '{sf}/{name}.parquet')")
    return io.describe_catalog(spark, layers, counts=True)


@query("s_15_sql_json", """
SELECT '{"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","o_orderstatus":"' || o_orderstatus
  || '","n":' || count(*) || '}' AS json FROM orders GROUP BY o_orderdate, o_orderstatus""")
def s_15(spark, sf):
    return io.sql_rows(spark, f"""```sql
SELECT o_orderdate, o_orderstatus, count(*) AS n FROM parquet.`{sf}/orders.parquet` GROUP BY o_orderdate, o_orderstatus
```""")


@query("s_16_verify_table", "SELECT count(*) AS n_rows, 6 AS n_cols FROM orders")
def s_16(spark, sf):
    name = f"{scratch_schema(spark)}.orders"
    io.write_table(table(spark, sf, "orders"), name)
    return io.verify_table(spark, name)


@query("s_17_ingest_articles", r"""
WITH raw AS (
  SELECT page_id, url, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS t,
    regexp_extract(html, '(?is)<article[^>]*>(.*?)</article>', 1) AS c FROM pages),
plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(t, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') AS t,
    regexp_replace(regexp_replace(c, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') AS c FROM raw),
decoded AS (
  SELECT page_id, url,
    trim(regexp_replace(replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[\s\x{00A0}]+', ' ', 'g')) AS title,
    trim(regexp_replace(replace(replace(replace(replace(replace(replace(c, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[\s\x{00A0}]+', ' ', 'g')) AS content
  FROM plain)
SELECT page_id, title, content, url, length(content)::BIGINT AS content_length FROM decoded
WHERE title <> '' AND content <> '' QUALIFY row_number() OVER (PARTITION BY title ORDER BY page_id) = 1""")
def s_17(spark, sf):
    return ingest_articles(texts(spark, sf, "pages")).drop("fetch_time")
