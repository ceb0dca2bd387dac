"""Nearest-neighbour search: one query, exact joins, approximate joins, k-NN voting.

Scores are cosine similarities (or negated Euclidean distances) in double
precision, compared after rounding to 9 decimals with ties going to the smaller
base id. Vectors that are null or zero have no cosine and are never neighbours.

Pairs never become rows: a task scores a block of queries against a block of
base vectors with one matrix product and emits only the best k per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import hash32
from millrace.operators import ann_index
from millrace.session import materialize

# Rows that are scored against each other at a time, and bytes of the vectors of a block.
BLOCK_BASE = 2048
BLOCK_QUERY = 1024
BLOCK_BYTES = 32 << 20
# Cells grow with the root of the base, up to what every task can hold as pivots; larger cells are cut into blocks.
MIN_CELLS, MAX_CELLS = 16, 4096
# Rows whose distances to all pivots are held at a time.
SLICE = 512


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two array columns in double; null for a null or zero vector."""
    x, y = (F.transform(c, lambda v: v.cast("double")) for c in (a, b))
    add = lambda arr: F.aggregate(arr, F.lit(0.0), lambda s, v: s + v)
    dot = add(F.zip_with(x, y, lambda u, v: u * v))
    norms = F.sqrt(add(F.transform(x, lambda v: v * v))) * F.sqrt(add(F.transform(y, lambda v: v * v)))
    return F.try_divide(dot, norms)


def similarity_search(base: DataFrame, query: list[float], cols: list[str], k: int = 5, *, vec: str, key: str) -> DataFrame:
    """The k rows of ``base`` most similar to one query vector, with their score."""
    q = F.array(*[F.lit(float(v)) for v in query])
    scored = base.select(key, *[c for c in cols if c != key], cosine(F.col(vec), q).alias("score"))
    return scored.filter(F.col("score").isNotNull()).orderBy(F.desc(F.round("score", 9)), key).limit(k)


def _best_k():
    """Matrix kernel shared by all paths, returned as a closure so that it ships by value."""

    def best_k(q, q_rows, x, x_ids, k, metric):
        """(query row, base id, score) of the best k columns per row of q."""
        import numpy as np

        if metric == "cosine":
            s = q @ x.T
        else:
            s = -np.sqrt(np.maximum((q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * (q @ x.T), 0))
        s = np.round(s, 9)
        if s.shape[1] > k:
            floor = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            rows, cols = np.nonzero(s >= floor[:, None])
        else:
            rows, cols = np.nonzero(np.ones_like(s, dtype=bool))
        score, ids = s[rows, cols], x_ids[cols]
        order = np.lexsort((ids, -score, rows))
        rows, score, ids = rows[order], score[order], ids[order]
        first = np.searchsorted(rows, np.arange(len(q_rows)))
        keep = np.arange(len(rows)) - first[rows] < k
        return q_rows[rows[keep]], ids[keep], score[keep]

    return best_k


def _matrix():
    """Reader of an Arrow batch as (ids, double matrix), returned as a closure."""

    def matrix(batch, metric):
        """Rows in double, of length 1 for cosine, without null or zero vectors."""
        import numpy as np
        import pyarrow as pa

        v = batch.column("v")
        v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        ids = batch.column("id").to_numpy()
        if not len(ids):
            return ids, np.empty((0, 0))
        x = v.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(ids), -1)
        if metric == "cosine":
            norm = np.sqrt((x * x).sum(1))
            ids, x = ids[norm > 0], x[norm > 0] / norm[norm > 0][:, None]
        return ids, x

    return matrix


def _vectors(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(id, v) without null vectors."""
    return df.select(F.col(key).cast("long").alias("id"), F.col(vec).alias("v")).filter(F.col("v").isNotNull())


def _merge(hits: DataFrame, k: int) -> DataFrame:
    """Best k per query over the blocks; each block has at most k rows per query."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "neighbour_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


HITS = "query_id long, neighbour_id long, score double"


def _best_of_blocks():
    """Best k of a block of queries among base vectors that come in pieces, returned as a closure."""
    best_k, base, block = _best_k(), BLOCK_BASE, BLOCK_QUERY

    def best_of_blocks(q_mat, q_ids, pieces, k, metric):
        """(query id, base id, score); ``pieces`` gives (ids, matrix). Few products are held at a time, and 3 * k hits a query."""
        import numpy as np

        rows, ids, score = np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0)
        held, waiting, floor = [], 0, np.full(len(q_ids), -np.inf)

        def fold():
            rows, ids, score = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((ids, -score, rows))
            rows, ids, score = rows[order], ids[order], score[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            last = place == k - 1
            floor[rows[last]] = score[last]
            return rows[place < k], ids[place < k], score[place < k]

        for x_ids, x_mat in pieces:
            for b in range(0, len(x_ids), base):
                for a in range(0, len(q_ids), block):
                    places = np.arange(a, min(a + block, len(q_ids)))
                    hit = best_k(q_mat[a : a + block], places, x_mat[b : b + base], x_ids[b : b + base], k, metric)
                    near = hit[2] >= floor[hit[0]]
                    held.append(tuple(c[near] for c in hit))
                    waiting += int(near.sum())
                    if waiting > 2 * k * len(q_ids) + block:
                        held = [fold()]
                        waiting = len(held[0][0])
        if held:
            rows, ids, score = fold()
        return q_ids[rows], ids, score

    return best_of_blocks


def _small_side(q: DataFrame, x: DataFrame, k: int, metric: str) -> DataFrame:
    """All queries as one broadcast matrix; one pass over the base vectors."""
    best_of_blocks, matrix = _best_of_blocks(), _matrix()
    shared = q.sparkSession.sparkContext.broadcast(matrix(q.toArrow(), metric))

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        q_ids, q_mat = shared.value
        step = max(256, (8 << 20) // (8 * max(1, q_mat.shape[1])))
        pieces = (matrix(batch.slice(at, step), metric) for batch in batches for at in range(0, batch.num_rows, step))
        hit = best_of_blocks(q_mat, q_ids, pieces, k, metric)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in hit], names=["query_id", "neighbour_id", "score"])

    return x.mapInArrow(search, HITS)


VECTORS = "id long, v array<double>, cell int"
ROUTES = "id long, cell int"


def _rows_of():
    """Arrow batch of (id, v, cell) from arrays, returned as a closure."""

    def rows_of(ids, x, cell, *more, names=()):
        import numpy as np
        import pyarrow as pa

        width = x.shape[1] if len(ids) else 0
        offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * width)
        v = pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
        cols = [pa.array(ids), v, pa.array(cell.astype(np.int32)), *map(pa.array, more)]
        return pa.RecordBatch.from_arrays(cols, names=["id", "v", "cell", *names])

    return rows_of


def _distances():
    """Euclidean distances between the rows of two matrices, returned as a closure."""

    def distances(x, p):
        import numpy as np

        return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * (x @ p.T), 0))

    return distances


def _cells(df: DataFrame, pivots, metric: str) -> DataFrame:
    """(id, v, cell, dist): every vector with its nearest pivot and the distance to it; written once."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)
    matrix, rows_of, distances, step = _matrix(), _rows_of(), _distances(), SLICE

    def assign(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            ids, x = matrix(batch, metric)
            for at in range(0, len(ids), step):
                part = slice(at, at + step)
                d = distances(x[part], shared.value)
                cell = d.argmin(1)
                yield rows_of(ids[part], x[part], cell, d[np.arange(len(cell)), cell], names=["dist"])

    return materialize(df.mapInArrow(assign, VECTORS + ", dist double"), "cells")


def _cell_count(x: DataFrame, cells: int | None) -> int:
    """The given number of cells, or one that follows the number of base vectors."""
    return cells or min(max(math.isqrt(x.count()), MIN_CELLS), MAX_CELLS)


def _pivots(x: DataFrame, n: int, metric: str):
    """Up to n base vectors with the smallest id hashes: a fixed-size, repeatable sample."""
    import numpy as np

    _, p = _matrix()(x.orderBy(hash32("id"), "id").limit(n).toArrow(), metric)
    return np.unique(p, axis=0)


def _blocked(routed: DataFrame, q: DataFrame, x: DataFrame, k: int, metric: str, width: int) -> DataFrame:
    """Join queries to base vectors cell by cell in blocks of bounded size.

    ``routed`` has (id, cell), one row per query and cell to search; the vectors
    of ``q`` (id, v) join it only on their way into the blocks. A cell
    with many base vectors or many queries is cut into blocks by id hash, so a
    hot cell spreads over many tasks and no task holds more than one block pair.
    Each side is copied for every block of the other, so blocks are as large as the
    work for all cores and BLOCK_BYTES allow.
    """
    # One row per cell, so at most MAX_CELLS or the number the caller gave.
    counts = x.groupBy("cell").agg(F.count("*").alias("xs")).join(routed.groupBy("cell").agg(F.count("*").alias("qs")), "cell").collect()
    spark = q.sparkSession
    share = math.isqrt(sum(r.xs * r.qs for r in counts) // (3 * spark.sparkContext.defaultParallelism))
    most = max(1, min(max(share, BLOCK_QUERY), max(BLOCK_QUERY, BLOCK_BYTES // (8 * max(1, width)))))
    parts = F.broadcast(spark.createDataFrame(
        [(r.cell, -(-r.xs // most), -(-r.qs // most)) for r in counts], "cell int, x_parts int, q_parts int"))
    shuffled = F.xxhash64("id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (
        routed.join(q, "id").join(parts, "cell").withColumn("q_part", F.pmod(shuffled, F.col("q_parts")).cast("int"))
        .select("cell", "q_part", every("x_parts").alias("x_part"), "id", "v")
    )
    right = (
        x.join(parts, "cell").withColumn("x_part", F.pmod(shuffled, F.col("x_parts")).cast("int"))
        .select("cell", every("q_parts").alias("q_part"), "x_part", "id", "v")
    )
    best_of_blocks, matrix = _best_of_blocks(), _matrix()

    def pair(q, b):
        import pyarrow as pa

        q_ids, q_mat = matrix(q, metric)
        b_ids, b_mat = matrix(b, None)
        hit = ([], [], [])
        if len(q_ids) and len(b_ids):
            hit = best_of_blocks(q_mat, q_ids, [(b_ids, b_mat)], k, metric)
        kinds = {"query_id": pa.int64(), "neighbour_id": pa.int64(), "score": pa.float64()}
        return pa.table({n: pa.array(v, t) for (n, t), v in zip(kinds.items(), hit)})

    keys = ["cell", "q_part", "x_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, HITS)


def _exact_routes(q: DataFrame, x: DataFrame, pivots, k: int, metric: str) -> DataFrame:
    """(id, cell) for every cell that can hold one of the k nearest of a query.

    Each cell gives its radius and its k smallest pivot distances (few numbers
    per cell). By the triangle inequality these bound a query's k-th distance
    from above, and its distance to anything in a cell from below.
    """
    import numpy as np

    w = Window.partitionBy("cell").orderBy("dist")
    near = (
        x.select("cell", "dist").withColumn("at", F.row_number().over(w)).filter(F.col("at") <= k)
        .select("cell", "dist").collect()
    )
    radius = np.full(len(pivots), -1.0)
    for r in x.groupBy("cell").agg(F.max("dist").alias("r")).collect():
        radius[r.cell] = r.r
    near_cell = np.array([r.cell for r in near])
    near_dist = np.array([r.dist for r in near])
    shared = q.sparkSession.sparkContext.broadcast((pivots, radius, near_cell, near_dist))
    matrix, distances, step = _matrix(), _distances(), SLICE

    def route(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        p, rad, cells, dists = shared.value
        for batch in batches:
            ids, v = matrix(batch, metric)
            for at in range(0, len(ids), step):
                part = slice(at, at + step)
                d = distances(v[part], p)
                kth = np.full(len(d), np.inf)
                if len(cells) >= k:
                    kth = np.partition(d[:, cells] + dists[None, :], k - 1, axis=1)[:, k - 1]
                rows, cols = np.nonzero((d - rad[None, :] <= kth[:, None] + 1e-6) & (rad >= 0)[None, :])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part][rows]), pa.array(cols.astype(np.int32))], names=["id", "cell"])

    return q.mapInArrow(route, ROUTES)


def knn(
    queries: DataFrame, base: DataFrame, k: int = 5, *, q_id: str, q_vec: str, b_id: str, b_vec: str,
    metric: str = "cosine", exclude_self: bool = False, broadcast_bytes: int = 64 << 20, cells: int | None = None,
) -> DataFrame:
    """Exact k nearest base vectors per query: (query_id, neighbour_id, score, rank).

    A query set measured to fit ``broadcast_bytes`` is sent to all tasks and the
    base is read once. A larger one, which must hold each id once, is joined
    through a pivot partition of the base: cells that the triangle inequality
    rules out for a query are skipped, the others are scored in bounded blocks.
    Where it rules out so little that the cells would move more copies of the
    queries than blocks over the whole base do, those blocks are used.
    """
    q = materialize(_vectors(queries, q_id, q_vec), "queries")
    x = _vectors(base, b_id, b_vec)
    volume = q.agg(F.coalesce(F.sum(F.size("v") * 8 + 8), F.lit(0))).first()[0]
    want = k + 1 if exclude_self else k
    if volume <= broadcast_bytes:
        hits = _small_side(q, x, want, metric)
    else:
        pivots = _pivots(x, _cell_count(x, cells), metric)
        if not len(pivots):
            return _merge(q.sparkSession.createDataFrame([], HITS), k)
        x = _cells(x, pivots, metric)
        routed = materialize(_exact_routes(q, x, pivots, want, metric), "routes")
        if routed.count() > q.count() * -(-x.count() // max(BLOCK_QUERY, BLOCK_BYTES // (8 * pivots.shape[1]))):
            routed, x = (df.withColumn("cell", F.lit(0)) for df in (routed.select("id").distinct(), x))
        hits = _blocked(routed, q, x.drop("dist"), want, metric, pivots.shape[1])
    if exclude_self:
        hits = hits.filter("query_id <> neighbour_id")
    return _merge(hits, k)


def ann(
    queries: DataFrame, base: DataFrame, k: int = 5, *, q_id: str, q_vec: str, b_id: str, b_vec: str,
    metric: str = "cosine", exclude_self: bool = False, cells: int | None = None, probes: int | None = None,
) -> DataFrame:
    """Approximate k nearest neighbours. The query ids must be unique.

    By default over an index in two levels of cells with product codes, whose number of
    visited cells is measured (see ``ann_index``, which also keeps an index for many
    searches). With ``cells`` or ``probes`` given, over one level of cells round sampled
    pivots: each query searches its ``probes`` nearest cells in full.
    """
    if cells is None and probes is None:
        index = ann_index.build(base, key=b_id, vec=b_vec, metric=metric, k=k)
        return ann_index.search(index, queries, k, key=q_id, vec=q_vec, exclude_self=exclude_self)
    q, x = _vectors(queries, q_id, q_vec), _vectors(base, b_id, b_vec)
    pivots = _pivots(x, _cell_count(x, cells), metric)
    probes = probes or max(8, -(-len(pivots) // 8))
    if not len(pivots):
        return _merge(q.sparkSession.createDataFrame([], HITS), k)
    x = _cells(x, pivots, metric)
    shared = q.sparkSession.sparkContext.broadcast(pivots)
    matrix, distances, step = _matrix(), _distances(), SLICE

    def route(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        n = min(probes, len(shared.value))
        for batch in batches:
            ids, v = matrix(batch, metric)
            for at in range(0, len(ids), step):
                part = slice(at, at + step)
                nearest = np.argsort(distances(v[part], shared.value), axis=1)[:, :n].ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[part], n)), pa.array(nearest.astype(np.int32))], names=["id", "cell"])

    routed = materialize(q.mapInArrow(route, ROUTES), "routes")
    hits = _blocked(routed, q, x.drop("dist"), k + 1 if exclude_self else k, metric, pivots.shape[1])
    if exclude_self:
        hits = hits.filter("query_id <> neighbour_id")
    return _merge(hits, k)


def knn_classify(
    train: DataFrame, test: DataFrame, k: int = 5, *, key: str, vec: str, label: str, metric: str = "l2", **options,
) -> DataFrame:
    """Majority label of the k nearest training rows; a tie goes to the smallest label."""
    hits = knn(test, train, k, q_id=key, q_vec=vec, b_id=key, b_vec=vec, metric=metric, **options)
    votes = (
        hits.join(train.select(F.col(key).alias("neighbour_id"), F.col(label).alias("_label")), "neighbour_id")
        .groupBy("query_id", "_label").agg(F.count("*").alias("votes"))
    )
    return votes.groupBy("query_id").agg(
        F.min(F.struct((-F.col("votes")).alias("_fewest"), "_label"))["_label"].alias("prediction")
    ).select(F.col("query_id").alias(key), "prediction")
