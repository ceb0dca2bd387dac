"""Exact neighbours by blocks: few copies of the vectors are moved, and a task holds few products."""

import tracemalloc

import numpy as np
import pyarrow as pa

from millrace.operators import neighbours as N
from tests.conftest import rows_of
from tests.moved import shuffled


def test_blocks_do_not_multiply_the_vectors(spark):
    n = 20_000
    x = np.random.default_rng(5).normal(size=(n, 8))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, v array<double>").repartition(8)
    names = dict(q_id="id", q_vec="v", b_id="id", b_vec="v", exclude_self=True)
    got = N.knn(df, df, 3, broadcast_bytes=0, cells=16, **names)
    assert got.count() == 3 * n
    got.collect()
    # Small blocks made 20 copies of the base.
    assert shuffled(got) < 30 * n
    some = df.filter("id < 50")
    near = N.knn(some, df, 3, **names)
    assert rows_of(near, "query_id", "neighbour_id", "rank") == rows_of(got.filter("query_id < 50"), "query_id", "neighbour_id", "rank")


class _Taken:
    """Stands in for a frame and gives back the function it is mapped with."""

    def mapInArrow(self, fn, schema):
        return fn


def test_a_task_holds_few_products(spark):
    r = np.random.default_rng(6)
    q = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(r.normal(size=(1500, 8)))], "id long, v array<double>")
    x = r.normal(size=(20_000, 8))
    x[19_000:] = x[0]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(10_001, dtype="i4") * 8), pa.array(x[:10_000].ravel()))
    more = pa.ListArray.from_arrays(pa.array(np.arange(10_001, dtype="i4") * 8), pa.array(x[10_000:].ravel()))
    ids = [pa.array(np.arange(10_000)), pa.array(np.arange(10_000, 20_000))]
    run = N._small_side(q, _Taken(), 4, "l2")
    tracemalloc.start()
    (hits,) = list(run(iter([pa.RecordBatch.from_arrays([i, v], names=["id", "v"]) for i, v in zip(ids, (lists, more))])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # One product of 1,024 queries and 10,000 vectors alone is 82 MB.
    assert peak < 120e6
    asked = np.array([row.v for row in q.orderBy("id").collect()])
    far = np.round(np.sqrt(((asked[:, None, :] - x[None, :2000]) ** 2).sum(2)), 9)
    got = hits.to_pandas().sort_values(["query_id", "score", "neighbour_id"], ascending=[True, False, True])
    assert len(got) == 6000 and (got.groupby("query_id").size() == 4).all()
    best = got.groupby("query_id").score.max().to_numpy()
    assert (-best <= far.min(1) + 1e-9).all()
