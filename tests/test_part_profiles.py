"""Stored part profiles against the table they were made from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import part_profiles as P
from millrace.session import scratch_path
from tests.conftest import rows_of


@pytest.fixture
def table(spark):
    rng = np.random.default_rng(5)
    rows = [(int(d), None if i % 50 == 0 else float("nan") if i % 51 == 0 else float(rng.gamma(2.0) * 1e6 + d), int(rng.integers(0, 3000)), f"g{i % 3}")
            for i, d in enumerate(rng.integers(0, 8, 20_000))]
    return spark.createDataFrame(rows, "day int, x double, k int, g string").repartition(4)


def test_merged_parts_equal_the_whole(spark, table):
    path = scratch_path(spark, "profiles")
    P.add_missing_parts(table, path, "day", ["x", "k", "g"])
    parts = P.read_parts(spark, path, "day", "int")
    for low, high in ((0, 7), (2, 5), (3, 3)):
        pdf = table.filter(F.col("day").between(low, high)).toPandas()
        got = {r["column"]: r for r in P.describe_parts(parts.filter(F.col("day").between(low, high))).collect()}
        x = pdf.x.dropna()
        assert (got["x"]["rows"], got["x"]["known"], got["x"]["missing"]) == (len(pdf), len(x), len(pdf) - len(x))
        assert [got["x"][n] for n in ("mean", "std", "low", "high")] == pytest.approx([x.mean(), x.std(), x.min(), x.max()], rel=1e-9)
        for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            assert abs((x < got["x"][n]).mean() - p) < 0.02
        assert got["k"]["n_distinct"] == pytest.approx(pdf.k.nunique(), rel=0.05)
        assert got["x"]["n_distinct"] == pytest.approx(x.nunique(), rel=0.05)
        assert (got["g"]["first"], got["g"]["last"], got["g"]["mean"], got["g"]["median"], got["g"]["n_distinct"]) == ("g0", "g2", None, None, 3)


def test_a_new_part_reads_that_part_only_and_may_be_repeated(spark, table):
    path = scratch_path(spark, "profiles")
    P.add_part(table, path, "day", 1, ["x"])
    poisoned = table.withColumn("x", F.when(F.col("day") != 2, F.raise_error(F.lit("read"))).otherwise(F.col("x")))
    for _ in range(2):
        P.add_part(poisoned, path, "day", 2, ["x"])
    stored = P.read_parts(spark, path, "day", "int")
    assert rows_of(stored, "day", "column") == [(1, "x"), (2, "x")]
    known = table.withColumn("x", F.when(F.col("day").isin(1, 2), F.raise_error(F.lit("read"))).otherwise(F.col("x")))
    P.add_missing_parts(known, path, "day", ["x"], stored=stored)
    again = P.read_parts(spark, path, "day", "int")
    assert rows_of(again, "day") == [(d,) for d in range(8)]
    assert again.filter("day = 3").inputFiles() and "PartitionFilters" in again.filter("day = 3")._jdf.queryExecution().toString()


def test_box_by_group(spark, table):
    parts = P.profile_parts(table, "day", ["x"], ["g"])
    for r in P.box_parts(parts, "x", ["g"]).collect():
        x = table.filter(F.col("g") == r["g"]).toPandas().x.dropna()
        assert (r["low"], r["high"]) == (x.min(), x.max())
        assert abs(((x < r["fence_low"]) | (x > r["fence_high"])).sum() - r["outliers"]) <= 0.03 * len(x)
        assert r["fence_low"] <= r["q1"] <= r["median"] <= r["q3"] <= r["fence_high"]


def test_empty_and_unknown_columns(spark, table):
    blank = table.withColumn("x", F.lit(None).cast("double"))
    row = P.describe_parts(P.profile_parts(blank, "day", ["x"])).first()
    assert (row["known"], row["mean"], row["std"], row["median"], row["n_distinct"]) == (0, None, None, None, 0)
    assert not P.box_parts(P.profile_parts(blank, "day", ["x"]), "x").count()
    assert not P.describe_parts(P.profile_parts(table.limit(0), "day", ["x"])).count()
