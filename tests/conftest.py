import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame(schema, rows...) builds a small DataFrame."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def rows_of(df, *cols):
    """Sorted tuples of the result, nulls first."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda t: [(v is not None, str(type(v)), v) for v in t])
