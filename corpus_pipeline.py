"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the session, the documents its predecessor kept, and the folder
of the input tables; its result is written as Parquet and read again as the next
stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, packing, pii, simhash, toxicity
from millrace.llm.common import read
from millrace.session import materialize, prepare

STAGES = [
    ("toxicity", toxicity.stage),
    ("simhash near-dedup", simhash.keep_one),
    ("benchmark decontamination", decontaminate.stage),
    ("personal data", pii.stage),
    ("best-fit packing", packing.stage),
]

#: Models, fingerprints and token ids are not SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table: the packed pieces of the documents that stay."""
    at = sf_dir.rstrip("/")
    docs = read(prepare(spark), at, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, at), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, at)
