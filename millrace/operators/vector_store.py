"""Vectors stored by cell, for single exact searches that read few files.

A store has a folder of vectors for each cell round a centre, and a table with every cell's
centre, size and radius, the largest distance of its vectors from the centre. By the triangle inequality
nothing in a cell is nearer to a query than its distance to the centre less the radius. A search
first reads the cells that come first by this bound and hold k vectors; the k-th distance there
rules out whole cells, and what is left is read by folder. The answer is exact; how many
folders are read depends on how well the vectors fall into groups.

For the cosine, vectors are held at length 1, where the distance grows as the cosine falls.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ann_index import SAMPLE_BYTES, _kernels, _share, _stored
from millrace.operators.neighbours import cosine

#: The table of cells is read to the driver, so their number is bounded; more vectors make larger cells.
MAX_CELLS = 4096


def store_by_cell(base: DataFrame, path: str, *, key: str, vec: str, cols: list[str] | None = None, metric: str = "cosine", cells: int | None = None) -> int:
    """Write ``base`` (unique ``key``, ``cols``, vector) by cell to ``path``; returns the number of cells."""
    kernels, cols = _kernels(), cols or []
    plain = _stored(base, key, vec, metric, None)
    rows, width = plain.agg(F.count("*"), F.max(F.size("v"))).first()
    wanted = min(cells or math.ceil(math.sqrt(rows)), MAX_CELLS)
    most = max(256, min(48 * max(wanted, 1), SAMPLE_BYTES // (8 * (width or 1))))
    sample = plain.filter(_share(min(1.0, most / max(rows, 1)))).select("v").limit(2 * most).toArrow()
    if rows and not sample.num_rows:
        sample = plain.select("v").limit(1).toArrow()
    centres = kernels.k_means(kernels.matrix(sample.column("v")), wanted) if rows else None
    placed = _stored(base, key, vec, metric, centres)
    named = base.sparkSession.createDataFrame([(i, c) for i, c in enumerate(centres.tolist() if rows else [])], "coarse int, centre array<double>")
    own = placed.join(F.broadcast(named), "coarse").withColumn(
        "far", F.sqrt(F.aggregate(F.zip_with("v", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)))
    kept = base.select(F.col(key).cast("long").alias("id"), *([F.struct(*cols).alias("row")] if cols else []))
    out = own.join(kept, "id").select("id", "v", "far", *(["row.*"] if cols else []), F.col("coarse").alias("cell"))
    out.repartition("cell").write.partitionBy("cell").mode("overwrite").parquet(f"{path}/vectors")
    stored = base.sparkSession.read.schema(out.schema).parquet(f"{path}/vectors")
    stored.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).join(
        F.broadcast(named.withColumnRenamed("coarse", "cell")), "cell").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    return len(centres) if rows else 0


def _asked(query: list[float], metric: str):
    import numpy as np

    q = np.asarray(query, "f8")
    return q / (np.sqrt((q * q).sum()) or 1.0) if metric == "cosine" else q


def _far(q) -> Column:
    asked = F.array(*[F.lit(float(x)) for x in q])
    return F.sqrt(F.aggregate(F.zip_with("v", asked, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))


def cells_in_reach(spark: SparkSession, path: str, query: list[float], k: int = 5, metric: str = "cosine") -> list[int]:
    """The cells that can hold one of the k nearest of the query; reads the k-th distance from the nearest cells that hold k vectors."""
    import numpy as np

    q = _asked(query, metric)
    cells = spark.read.schema("cell int, radius double, n long, centre array<double>").parquet(f"{path}/cells").collect()  # MAX_CELLS rows at most
    distance = {c["cell"]: float(np.sqrt(((np.array(c["centre"]) - q) ** 2).sum())) for c in cells}
    near, held = [], 0
    for c in sorted(cells, key=lambda c: (distance[c["cell"]], c["cell"])):
        near.append(c["cell"])
        held += c["n"]
        if held >= k:
            break
    reach = math.inf
    if held >= k:
        first = spark.read.parquet(f"{path}/vectors").filter(F.col("cell").isin(near)).select(_far(q).alias("far")).orderBy("far").limit(k)
        reach = first.agg(F.max("far")).first()[0]
    # With room for rounding, of the distances and of the compared score.
    return sorted(c["cell"] for c in cells if distance[c["cell"]] - c["radius"] <= reach + 1e-5)


def search_stored(spark: SparkSession, path: str, query: list[float], k: int = 5, *, cols: list[str] | None = None, metric: str = "cosine") -> DataFrame:
    """``id``, ``cols`` and ``score`` of the k nearest stored vectors, ties by the smaller id. Reads the folders of the cells in reach."""
    q = _asked(query, metric)
    cells = cells_in_reach(spark, path, query, k, metric)
    if not cells or metric == "cosine" and not q.any():
        return spark.createDataFrame([], "id long, score double")
    score = cosine(F.col("v"), F.array(*[F.lit(float(x)) for x in q])) if metric == "cosine" else -_far(q)
    found = spark.read.parquet(f"{path}/vectors").filter(F.col("cell").isin(cells)).select("id", *(cols or []), score.alias("score"))
    return found.orderBy(F.desc(F.round("score", 9)), "id").limit(k)
