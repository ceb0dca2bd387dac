"""The bucketed index: merging in place, compaction beside a running sync, repeats and deletes."""

import uuid

import pytest
from pyspark.errors import StreamingQueryException

from millrace.session import scratch_path
from millrace.streaming import bucketed as B
from tests.conftest import rows_of

SCHEMA = "id long, v string, seq int, gone boolean"


class Index:
    def __init__(self, spark):
        self.spark, self.name = spark, f"idx_{uuid.uuid4().hex[:8]}"
        self.source, self.state = scratch_path(spark, "src"), scratch_path(spark, "state")
        B.create_index(spark, self.name, SCHEMA, ["id"], buckets=4)

    def drop(self, *rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)
        changes = self.spark.readStream.schema(SCHEMA).parquet(self.source)
        B.sync_bucketed(changes, self.name, self.state, ["id"], "seq", deleted="gone").awaitTermination()

    def read(self):
        return B.read_bucketed(self.spark, self.name, ["id"], "seq", "gone")

    def compact(self):
        return B.compact_bucketed(self.spark, self.name, ["id"], "seq", "gone", buckets=4)


def test_newest_change_wins_across_base_and_batches(spark):
    index = Index(spark)
    assert rows_of(index.read()) == []
    index.drop((1, "a", 1, False), (2, "b", 1, None), (3, "c", 1, False))
    index.drop((2, "c", 3, False), (2, "old", 2, False), (3, None, 5, True))
    want = [(1, "a"), (2, "c")]
    assert rows_of(index.read(), "id", "v") == want
    index.compact()
    assert rows_of(index.read(), "id", "v") == want
    index.drop((1, "late", 0, False), (2, "d", 4, False), (3, "late", 4, False), (4, "new", 1, False))
    assert rows_of(index.read(), "id", "v") == [(1, "a"), (2, "d"), (4, "new")]
    index.compact()
    index.drop((4, None, 2, True))
    assert rows_of(index.read(), "id", "v") == [(1, "a"), (2, "d")]


def test_reading_shuffles_neither_base_nor_batches(spark):
    index = Index(spark)
    index.drop(*[(i, f"v{i}", 1, False) for i in range(500)])
    index.drop(*[(i, f"w{i}", 2, False) for i in range(0, 500, 7)])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(index.read())
    index.compact()
    index.drop(*[(i, f"x{i}", 3, False) for i in range(0, 500, 11)])
    assert "Exchange" not in plan(index.read()) and "Bucketed: true" in plan(index.read())
    want = {i: "x" if i % 11 == 0 else "w" if i % 7 == 0 else "v" for i in range(500)}
    assert {r["id"]: r["v"] for r in index.read().collect()} == {i: f"{c}{i}" for i, c in want.items()}


def test_compaction_while_a_sync_goes_on(spark, monkeypatch):
    """A batch that comes in between reading the state and naming the base is not lost."""
    index = Index(spark)
    index.drop((1, "a", 1, False), (2, "b", 1, False))
    state = B._state

    def interrupted(rows, *how):
        out = state(rows, *how)
        index.drop((2, "meanwhile", 2, False), (3, "new", 1, False))
        return out

    monkeypatch.setattr(B, "_state", interrupted)
    base = index.compact()
    monkeypatch.setattr(B, "_state", state)
    assert rows_of(spark.table(base), "id", "v") == [(1, "a"), (2, "b")]
    assert rows_of(index.read(), "id", "v") == [(1, "a"), (2, "meanwhile"), (3, "new")]


def test_a_null_key_is_refused(spark):
    with pytest.raises(StreamingQueryException):
        Index(spark).drop((None, "a", 1, False))


def test_without_order_the_later_batch_wins(spark):
    index = Index(spark)
    index.drop((1, "a", 5, False), (2, "b", 5, False))
    index.compact()
    index.drop((1, "c", 1, False))
    assert rows_of(B.read_bucketed(spark, index.name, ["id"]), "id", "v") == [(1, "c"), (2, "b")]


def test_a_repeated_batch_replaces_itself(spark):
    index = Index(spark)
    index.drop((1, "a", 1, False))
    index.state = scratch_path(spark, "state")  # the checkpoint is lost: the first batch comes again, with more in it
    index.drop((2, "b", 1, False))
    assert spark.table(index.name).count() == 2 and rows_of(index.read(), "id", "v") == [(1, "a"), (2, "b")]
