"""Exact single searches over vectors stored by cell."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import neighbours as N
from millrace.operators import vector_store as V
from millrace.session import scratch_path
from tests.test_ann_index import frame_of


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_exact_answers_from_few_folders(spark, metric):
    r = np.random.default_rng(3)
    x = (4 * r.normal(size=(60, 16))[r.integers(0, 60, 3000)] + 0.5 * r.normal(size=(3000, 16))).astype("f4").astype("f8")
    df = frame_of(spark, x).withColumn("name", F.concat(F.lit("n"), F.col("id"))).repartition(4)
    path = scratch_path(spark, "vectors")
    cells = V.store_by_cell(df, path, key="id", vec="v", cols=["name"], metric=metric)
    assert 20 < cells <= 60
    read = []
    for i in (0, 17, 1234, 2999):
        q = (x[i] + 0.01).tolist()
        got = V.search_stored(spark, path, q, 5, cols=["name"], metric=metric)
        read.append(len(V.cells_in_reach(spark, path, q, 5, metric)))
        assert re.search(r"PartitionFilters: \[[^\]]*cell", got._jdf.queryExecution().executedPlan().toString())
        rows = [(r["id"], r["name"], round(r["score"], 6)) for r in got.collect()]
        if metric == "cosine":
            want = [(r["id"], r["name"], round(r["score"], 6)) for r in N.similarity_search(df, q, ["name"], 5, vec="v", key="id").collect()]
        else:
            far = np.sqrt(((x - np.array(q)) ** 2).sum(1))
            want = [(int(j), f"n{j}", round(-far[j], 6)) for j in np.argsort(far)[:5]]
        assert rows == want
    assert max(read) < cells and min(read) <= cells // 3, (read, cells)


def test_small_and_odd_stores(spark):
    path = scratch_path(spark, "vectors")
    V.store_by_cell(frame_of(spark, [[1, 0], [0, 0], None, [1, 1], [1, 1]]), path, key="id", vec="v")
    got = [(r["id"], round(r["score"], 6)) for r in V.search_stored(spark, path, [2.0, 0.0], 9).collect()]
    assert got == [(0, 1.0), (3, 0.707107), (4, 0.707107)]
    assert V.search_stored(spark, path, [0.0, 0.0], 3).collect() == []
    empty = scratch_path(spark, "vectors")
    assert V.store_by_cell(frame_of(spark, [[1, 0]]).limit(0), empty, key="id", vec="v") == 0
    assert V.search_stored(spark, empty, [1.0, 0.0], 3).collect() == []
