"""Reads, writes, ids, compaction, catalog, ad-hoc SQL and articles."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session as S
from millrace.sources import tables as io
from millrace.sources.articles import ingest_articles
from tests.conftest import rows_of


@pytest.fixture
def db(spark):
    path = S.scratch_path(spark, "db")
    name = "t_" + path.rsplit("-", 1)[1]
    io.ensure_schema(spark, name, path)
    io.ensure_schema(spark, name)
    return name


def test_shared_dir_follows_the_session(spark):
    assert S.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert S.scratch_path(spark, "x") != S.scratch_path(spark, "x")


def test_spread_leaves_wide_input_alone(spark):
    assert S.spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 8
    wide = spark.range(0, 100, 1, 20)
    assert S.spread(wide) is wide


def test_csv_round_trip(spark, frame):
    path = S.scratch_path(spark, "csv")
    df = frame("a int, b string", (1, "x,y"), (2, None))
    df.write.option("header", True).csv(path)
    assert rows_of(io.read_csv(spark, path, df.schema)) == rows_of(df)


def test_read_many_unions_by_name_and_casts(spark, frame):
    paths = [S.scratch_path(spark, n) for n in "abc"]
    frame("k int, v string", (1, "a")).write.parquet(paths[0])
    frame("v string, k long", ("b", 2)).write.parquet(paths[1])
    frame("k long", (3,)).write.parquet(paths[2])
    got = io.read_many(spark, paths, {"k": "bigint"})
    assert rows_of(got, "k", "v") == [(1, "a"), (2, "b"), (3, None)]


def test_tables(spark, frame, db):
    name = f"{db}.t"
    io.write_table(frame("a int", (1,)), name)
    io.write_table(frame("a int, b string", (1, "x"), (2, "y")), name)
    assert tuple(io.verify_table(spark, name).first()) == (2, 2)
    schema = T.StructType.fromDDL("id bigint, tags array<string>")
    for _ in range(2):
        io.append_table(frame("tags array<string>, id int, extra int", (["a"], 1, 0)), f"{db}.log", schema)
    assert rows_of(io.read_table(spark, f"{db}.log"), "id") == [(1,), (1,)]
    assert spark.table(f"{db}.log").schema["tags"].dataType == T.ArrayType(T.StringType())
    io.drop_table(spark, name)
    io.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_compaction_keeps_rows(spark):
    path = S.scratch_path(spark, "many")
    spark.range(1000).repartition(16).write.parquet(path)
    out = io.compact(spark, path, 2)
    assert io.file_count(out) <= 2 and out.count() == 1000 and out.distinct().count() == 1000
    spark.sql("CREATE DATABASE t_durable")  # in the warehouse, not in scratch
    io.write_table(spark.range(100).repartition(9), "t_durable.wide")
    io.compact_table(spark, "t_durable.wide", 1)
    S.clear_scratch(spark)
    assert spark.table("t_durable.wide").count() == 100 and io.file_count(spark.table("t_durable.wide")) == 1
    spark.sql("DROP DATABASE t_durable CASCADE")


def test_surrogate_ids(spark):
    df = spark.range(500).select((F.col("id") * 31).alias("k"))
    one = io.with_surrogate_id(df, ["k"], buckets=16)
    two = io.with_surrogate_id(df.repartition(11), ["k"], buckets=16)
    assert rows_of(one) == rows_of(two)
    assert sorted(r.id for r in one.collect()) == list(range(1, 501))
    copies = spark.range(300).select(F.lit("same").alias("v")).repartition(7)
    loose = io.with_surrogate_id(copies)
    assert loose.columns == ["v", "id"] and sorted(r.id for r in loose.collect()) == list(range(1, 301))


def test_catalog(spark, frame, db):
    io.write_table(frame("a int, b string", (1, None)), f"{db}.t")
    got = io.describe_catalog(spark, {"gold": db}, counts=True)
    assert rows_of(got) == [("gold", "t", "a", "int", 1), ("gold", "t", "b", "string", 0)]
    assert io.describe_catalog(spark, {"gold": db}).count() == 2


def test_catalog_skips_temp_views_and_empty_schemas(spark, frame, db):
    frame("a int", (1,)).createOrReplaceTempView("a_temp_view")
    assert io.describe_catalog(spark, {"gold": db}, counts=True).collect() == []
    spark.catalog.dropTempView("a_temp_view")


def test_sql_json(spark):
    assert io.strip_sql("```sql\nSELECT 1\n```") == "SELECT 1"
    assert io.strip_sql("x ``` SELECT 2 ``` y") == "SELECT 2"
    assert io.strip_sql("  \"SELECT 3\" ") == "SELECT 3"
    assert io.strip_sql("SELECT 1 WHERE 'x' = 'x'") == "SELECT 1 WHERE 'x' = 'x'"
    assert json.loads(io.sql_json(spark, "SELECT 1 AS a WHERE 'x' = 'x'")) == [{"a": 1}]
    assert len(json.loads(io.sql_json(spark, "SELECT * FROM range(1500)"))) == 1500
    assert json.loads(io.sql_json(spark, "'SELECT 1 AS a, DATE '2024-02-03' AS d'")) == [{"a": 1, "d": "2024-02-03"}]
    assert io.sql_json(spark, "SELECT 1 WHERE false") == "Query returned no results."
    assert io.sql_json(spark, "SELEC 1").startswith("Error executing query")
    assert "more than 3 rows" in io.sql_json(spark, "SELECT * FROM range(5)", max_rows=3)
    assert io.sql_rows(spark, "SELECT * FROM range(5)").count() == 5


def test_articles(frame):
    page = lambda t, b: f"<html><title>{t}</title><body><nav>no</nav><article>{b}</article></body></html>"
    df = frame(
        "page_id long, url string, html string",
        (3, "u3", page("One", "later copy")), (1, "u1", page("One", "<p>a &amp; b</p><script>x()</script><!-- c -->")),
        (2, "u2", page("", "no title")), (4, "u4", page("Empty", "<p> </p>")), (5, "u5", "<p>nothing</p>"), (6, "u6", None))
    got = ingest_articles(df).collect()
    assert [(r.page_id, r.title, r.content, r.content_length) for r in got] == [(1, "One", "a & b", 5)]
    assert got[0].fetch_time is not None


def test_read_many_paths_by_schema(spark, tmp_path):
    """10,000 files of two schemas: one scan each, and Spark is asked for two schemas only."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    tables = [pa.table({"id": pa.array([1], pa.int64()), "v": pa.array([0.5])}), pa.table({"id": pa.array([1], pa.int32()), "w": pa.array(["x"])})]
    paths = []
    for i in range(10_000):
        paths.append(str(tmp_path / f"{i}.parquet"))
        pq.write_table(tables[i % 5 == 0], paths[-1])
    groups = io.schema_groups(spark, paths)
    assert [len(members) for _, members in groups] == [2000, 8000]
    assert groups[0][0].simpleString() == "struct<id:int,w:string>"
    df = io.read_many(spark, paths, {"id": "long"})
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    assert df.groupBy("w").agg(F.sum("id")).count() == 2 and df.columns == ["id", "w", "v"]


def test_read_many_takes_folders_and_repeats(spark, tmp_path):
    a, b, c = (str(tmp_path / n) for n in "abc")
    spark.range(4).selectExpr("id", "id % 2 as p").write.partitionBy("p").parquet(a)
    spark.range(3).write.parquet(b)
    spark.range(2).selectExpr("cast(id as string) as id").coalesce(1).write.parquet(c)
    got = io.read_many(spark, [a, b, c, f"file:{b}"], {"id": "long"})
    assert got.count() == 4 + 3 + 2 + 3 and set(got.columns) == {"id", "p"}
