"""The registered queries of this subpackage, each over its whole table, with check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    decontaminate, kmeans_tree, lexical_search, merkle, packing, pii, quality_model, quality_rules, quotes, sharding, simhash,
    token_lengths, toxicity,
)
from millrace.llm.common import read
from millrace.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _register(name: str, fn, *tables: str, sql: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = sf_dir.rstrip("/")
        return fn(prepare(spark), *[read(spark, at, t) for t in tables])

    run.__name__, run.__doc__ = name, fn.__doc__
    QUERIES[name] = run
    if sql is not None:
        CHECKS[name] = sql


_register("op1_quality_rules", quality_rules.query, "documents", sql=quality_rules.check_sql())
_register("op6_two_pass_shuffle", sharding.query, "documents")
_register("op8_simhash", simhash.query, "documents")
_register("op5_best_fit_packing", packing.query, "documents")
_register("op10_token_lengths", token_lengths.query, "documents")
_register("op3_quality_classifier", quality_model.query, "documents", "labels")
_register("op9_toxicity", toxicity.query, "documents", "labels")
_register("op2_pii", pii.query, "documents")
_register("op4_decontamination", decontaminate.query, "documents", "benchmark")
_register("op7_quote_linking", quotes.query, "conversations")
_register("op11_lexical_search", lexical_search.query, "documents", "benchmark", sql=lexical_search.check_sql())
_register("op12_merkle_manifest", merkle.query, "documents", sql=merkle.check_sql())
_register("op13_kmeans_tree", kmeans_tree.query, "embeddings")
