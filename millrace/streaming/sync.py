"""Incremental keyed sync of a table from a change stream.

The target is a folder of change batches, ``epoch=N``. A sync appends only the
changed rows; a reader takes the newest row per key. So a small change to a
huge table costs what the change costs, and a repeated batch replaces its own
folder. ``compact_index`` folds the batches into one from time to time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.streaming.events import with_epoch


def _newest(rows: DataFrame, keys: list[str], by: list[str], deleted: str | None) -> DataFrame:
    """One row per key: the largest in ``by``, nulls smallest; between equal ones a delete wins."""
    gone = [F.coalesce(F.col(deleted), F.lit(False))] if deleted else []
    kept = F.struct(*[c for c in rows.columns if c != "epoch"])
    return rows.groupBy(*keys).agg(F.max_by(kept, F.struct(*by, *gone, F.lit(0))).alias("_row")).select("_row.*")


def sync_index(
    changes: DataFrame, target: str, checkpoint: str, keys: list[str], order: str, *,
    deleted: str | None = None, continuous: str | None = None,
):
    """Start the sync and return the streaming query.

    ``order`` says which of two changes to a key inside a batch is newer, and
    ``deleted`` names the flag column of changes that remove their key. A removed
    key keeps its flagged row in the target, so that an older change that comes
    late does not bring it back. Without ``continuous`` all available changes are
    taken up once; with it (for example "30 seconds") the sync goes on.
    """
    def store(batch: DataFrame, epoch: int) -> None:
        _newest(batch, keys, [order], deleted).write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        changes.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger).start())


def _state(spark: SparkSession, target: str, schema, keys: list[str], order: str | None, deleted: str | None) -> DataFrame:
    rows = spark.read.schema(with_epoch(schema)).parquet(target)
    return _newest(rows, keys, [*([order] if order else []), "epoch"], deleted)


def read_index(
    spark: SparkSession, target: str, schema, keys: list[str], order: str | None = None, deleted: str | None = None,
) -> DataFrame:
    """The newest row per key over all batches, without the keys whose newest change is a delete.

    With ``order`` a late old version loses, whatever batch it came in; the batch
    number decides between equal ones. Without it the latest batch wins.
    """
    state = _state(spark, target, schema, keys, order, deleted)
    return state.filter(~F.coalesce(F.col(deleted), F.lit(False))) if deleted else state


def compact_index(
    spark: SparkSession, target: str, schema, keys: list[str], order: str | None = None, deleted: str | None = None,
) -> str:
    """Write the current state, flagged rows included, as a single batch to a new folder beside the old one and return its path."""
    out = f"{target.rstrip('/')}-compact-{uuid.uuid4().hex[:12]}"
    _state(spark, target, schema, keys, order, deleted).write.parquet(f"{out}/epoch=-1")
    return out
