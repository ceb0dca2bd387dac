"""Scans, writes, table DDL, compaction, and catalog listings."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from millrace.functions.hashing import hash32
from millrace.functions.scalars import to_json_row
from millrace.session import materialize


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line and a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """A table that is only a path."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _footer_marks():
    """Mapper of paths to a text that is equal for parquet files of equal schema, null for what is no such file here; a closure, so that it ships by value."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def mark(path):
            try:
                system, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
                if system.get_file_info(at).type != fs.FileType.File:
                    return None
                footer = pq.read_metadata(at, filesystem=system)
                return f"{footer.schema}{(footer.metadata or {}).get(b'org.apache.spark.sql.parquet.row.metadata')}"
            except (OSError, ValueError, ImportError, pa.ArrowException):
                return None

        for batch in batches:
            paths = batch.column(0)
            yield pa.RecordBatch.from_arrays([paths, pa.array([mark(p) for p in paths.to_pylist()], pa.string())], names=["path", "mark"])

    return run


def schema_groups(spark: SparkSession, paths: list[str], files_per_task: int = 64) -> list[tuple[T.StructType, list[str]]]:
    """The paths by schema, in order of first appearance.

    Footers are read by tasks, many files each, and only compared; Spark then infers the schema of
    one path of every kind. Folders, and paths in stores that only Spark opens, are
    inferred by Spark one by one, a few at a time.
    """
    distinct = list(dict.fromkeys(paths))
    tasks = max(1, -(-len(distinct) // files_per_task))
    marks = spark.createDataFrame([(p,) for p in distinct], "path string").repartition(tasks).mapInArrow(
        _footer_marks(), "path string, mark string")
    kind = {r["path"]: r["mark"] for r in marks.collect()}
    first = {m: p for p in reversed(distinct) if (m := kind[p]) is not None}
    asked = [*first.values(), *[p for p in distinct if kind[p] is None]]
    with ThreadPoolExecutor(8) as pool:
        known = dict(zip(asked, pool.map(lambda p: spark.read.parquet(p).schema, asked)))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for path in paths:
        schema = known[path if kind[path] is None else first[kind[path]]]
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return list(groups.values())


def read_many(spark: SparkSession, paths: list[str], casts: dict[str, str] | None = None) -> DataFrame:
    """Several parquet paths as one frame, columns cast and matched by name.

    Paths that share a schema are read by one scan, so the plan, and the calls on the
    driver, grow with the number of different schemas and not with the number of files.
    """
    out = None
    for schema, members in schema_groups(spark, paths):
        df = spark.read.schema(schema).parquet(*members)
        df = df.withColumns({c: F.col(c).cast(t) for c, t in (casts or {}).items() if c in df.columns})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def from_rows(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """Driver rows under a declared schema."""
    return spark.createDataFrame(rows, schema)


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a schema unless it exists, in a given folder if one is named."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{where}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Replace a managed table including its schema."""
    df.write.format("parquet").mode(mode).option("overwriteSchema", "true").saveAsTable(name)


def write_path(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, name: str, schema: T.StructType) -> None:
    """Append to a table of a declared schema, created on first use; columns go by name."""
    spark = df.sparkSession
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")
    ordered = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    ordered.write.mode("append").format("parquet").saveAsTable(name)


def verify_table(spark: SparkSession, name: str) -> DataFrame:
    """Row and column count of a table as read back."""
    df = spark.table(name)
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def _beside(path: str) -> str:
    """A new folder next to the one given, so that it lives as long as its neighbour."""
    return f"{path.rstrip('/')}-compact-{uuid.uuid4().hex[:12]}"


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def compact(spark: SparkSession, path: str, target_files: int, location: str | None = None) -> DataFrame:
    """Rewrite a path into at most ``target_files`` files in a new folder (by default beside it) and return that table.

    Scan tasks already pack small files to about equal size; joining them needs
    no shuffle. The old files stay untouched, so readers of the old path are not
    disturbed.
    """
    out = location or _beside(path)
    spark.read.parquet(path).coalesce(target_files).write.parquet(out)
    return spark.read.parquet(out)


def compact_table(spark: SparkSession, name: str, target_files: int, location: str | None = None) -> None:
    """Compact a table into a new folder (by default beside its own), then point the table at it.

    Never into scratch: that folder goes when the application's intermediates do.
    """
    out = location or _beside(table_location(spark, name))
    spark.table(name).coalesce(target_files).write.parquet(out)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{out}'")
    spark.catalog.refreshTable(name)


def file_count(df: DataFrame) -> int:
    return len(df.inputFiles())


ROWS_PER_BUCKET = 1 << 20


def with_surrogate_id(df: DataFrame, keys: list[str] | None = None, buckets: int | None = None, name: str = "id") -> DataFrame:
    """Add ids 1..n without gaps.

    With unique ``keys`` the id follows (key hash bucket, keys), so it does not
    depend on partitioning: the buckets are counted first, and each is numbered
    on its own from its offset. Their number follows the number of rows, about
    a million in each, unless it is given. Without keys the frame is materialised and each
    stored partition is numbered from its offset, with no shuffle at all.
    """
    if keys is None:
        df = materialize(df.withColumns({
            "_part": F.spark_partition_id(),
            "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }), "ids")
        rank = F.col("_at") + 1
    else:
        buckets = buckets or max(256, -(-df.count() // ROWS_PER_BUCKET))
        df = df.withColumn("_part", (hash32(*keys) % buckets).cast("int"))
        rank = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket or stored partition: a small frame by construction.
    offsets = df.groupBy("_part").agg(F.count("*").alias("_n")).select(
        F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = df.withColumn("_rank", rank)
    return (
        numbered.join(F.broadcast(offsets), F.col("_part") == F.col("_p"))
        .withColumn(name, (F.col("_offset") + F.col("_rank")).cast("long"))
        .drop("_part", "_p", "_offset", "_rank", "_at")
    )


def describe_catalog(spark: SparkSession, schemas: dict[str, str], counts: bool = False) -> DataFrame:
    """(layer, table, column, type) of the tables of each layer's schema.

    ``counts`` adds the number of non-null values per column, read in one pass
    per table.
    """
    parts, rows = [], []
    for layer, schema in schemas.items():
        for t in spark.catalog.listTables(schema):
            if t.isTemporary:
                continue
            df = spark.table(f"`{schema}`.`{t.name}`")
            rows += [(layer, t.name, f.name, f.dataType.simpleString()) for f in df.schema.fields]
            if counts:
                parts.append(
                    df.agg(*[F.count(c).alias(c) for c in df.columns])
                    .unpivot([], df.columns, "column", "non_null")
                    .select(F.lit(layer).alias("layer"), F.lit(t.name).alias("table"), "column", "non_null"))
    listing = spark.createDataFrame(rows, "layer string, table string, column string, type string")
    if not counts:
        return listing
    if not parts:
        return listing.withColumn("non_null", F.lit(None).cast("long"))
    counted = parts[0]
    for p in parts[1:]:
        counted = counted.unionByName(p)
    return listing.join(counted, ["layer", "table", "column"])


# The code fence a statement may come in, the answer for no rows, and how an error begins.
SQL_FENCE = r"```(?:sql)?\s*(.*?)\s*```"
NO_ROWS = "Query returned no results."
FAILED = "Error executing query: "


def strip_sql(text: str) -> str:
    """The statement inside a code fence, or the text without one pair of quotes round all of it."""
    fenced = re.search(SQL_FENCE, text, re.DOTALL)
    bare = (fenced[1] if fenced else text).strip()
    if not fenced and len(bare) > 1 and bare[0] == bare[-1] and bare[0] in "\"'":
        bare = bare[1:-1].strip()
    return bare


def sql_rows(spark: SparkSession, text: str) -> DataFrame:
    """One JSON text per result row, made on the executors, dates as ISO days."""
    return to_json_row(spark.sql(strip_sql(text)))


def sql_json(spark: SparkSession, text: str, max_rows: int | None = None) -> str:
    """Result of an ad-hoc statement as JSON records; messages for no rows and for errors.

    This is the interactive form: it answers with one text. A caller may have
    results above ``max_rows`` refused with a message; none is ever cut.
    ``sql_rows`` is the form for large results.
    """
    try:
        found = sql_rows(spark, text)
        rows = [r[0] for r in (found if max_rows is None else found.limit(max_rows + 1)).collect()]
    except Exception as e:
        return f"{FAILED}{e}"
    if not rows:
        return NO_ROWS
    if max_rows is not None and len(rows) > max_rows:
        return f"{FAILED}more than {max_rows} rows. Aggregate the result or write it to a table."
    return "[" + ",".join(rows) + "]"
