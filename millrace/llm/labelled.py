"""Bounded samples of labelled documents, for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_remainder


def label_sample(labels: DataFrame, column: str, divisor: int, held: int, bound: int) -> DataFrame:
    """``_id``, ``_label`` of at most ``bound`` ids outside the held-out remainder.

    Ids are taken by hash, so the sample is uniform and the same in every run. Null
    ids and labels are left out; an id with several labels has the largest.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)).filter(
        id_remainder("doc_id", divisor) != held)
    one = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max(column).cast("int").alias("_label"))
    return one.orderBy(F.xxhash64("_id"), "_id").limit(bound)


def labelled_documents(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The documents of the sample with ``_label``; the sample's bound makes the broadcast safe."""
    return docs.join(F.broadcast(sample), docs["doc_id"] == sample["_id"]).drop("_id")
