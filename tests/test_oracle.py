"""Every registered query against its check SQL, run by DuckDB on the same files."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [f[:-8] for f in os.listdir(SF) if f.endswith(".parquet")]
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    text = lambda v: None if v is None or v != v else (f"{v:.9g}" if isinstance(v, float) else str(v))
    return names, sorted(([text(v) for v in row] for row in zip(*columns)), key=str)


def kinds(table):
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_check_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toArrow(), duck.sql(CHECKS[name]).to_arrow_table()
    assert kinds(got) == kinds(want)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    for field in df.schema.fields:
        if field.dataType.simpleString() == "double":
            assert all(r[field.name] is None or math.isfinite(r[field.name]) for r in rows)


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["period", "tier"]
