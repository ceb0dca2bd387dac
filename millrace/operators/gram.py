"""Correlations of very wide tables from a tiled Gram matrix.

The columns are cut into blocks, and the matrix of cross products into tiles, one for each pair of
blocks. One pass over the rows adds up as many tiles as fit the memory given to a task; more tiles take
more passes, and a pass reads only the columns of its blocks. Tasks hand on strips of tiles as bytes, which
are added in two steps by key, so a step holds some tens of strips whatever the number of tasks.

A tile has six matrices over the rows where both columns are known: their number, both sums,
both sums of squares, and the products. Columns are brought to about
mean 0 and deviation 1 first, by moments that one pass with one row per column and task gives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

#: Columns of a block, rows of a tile's strip, bytes of tiles in a task, strips added at a time.
TILE, STRIP, TASK_BYTES, AT_ONCE = 256, 32, 256 << 20, 64
MATRICES = 6


def _numbers():
    """Reader of some columns of an Arrow batch as a matrix in double, NaN where missing; a closure, to ship by value."""

    def numbers(batch, names):
        import numpy as np

        return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names]).astype("f8")

    return numbers


def moments(df: DataFrame, cols: list[str]) -> list[tuple[float, float]]:
    """(mean, population deviation) of each column's known values; 0 and 1 where there are none or one value only."""
    numbers, names = _numbers(), [str(i) for i in range(len(cols))]
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(cols, names)])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        n, mean, far = (np.zeros(len(names)) for _ in range(3))
        for batch in batches:
            x = numbers(batch, names)
            known = ~np.isnan(x)
            own = known.sum(0)
            middle = np.where(known, x, 0).sum(0) / np.maximum(own, 1)
            spread = (np.where(known, x - middle, 0) ** 2).sum(0)
            both = np.maximum(n + own, 1)
            far += spread + (middle - mean) ** 2 * n * own / both
            mean += (middle - mean) * own / both
            n += own
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(names), dtype="i4")), pa.array(n), pa.array(mean), pa.array(far)], names=["i", "n", "mean", "far"])

    def merged(key, tasks):
        import numpy as np
        import pyarrow as pa

        n, mean, far = (tasks.column(c).to_numpy() for c in ("n", "mean", "far"))
        whole = max(n.sum(), 1.0)
        middle = (n * mean).sum() / whole
        deviation = np.sqrt((far + n * (mean - middle) ** 2).sum() / whole)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([middle]), pa.array([deviation])], names=["i", "mean", "deviation"])

    # A row per column and task, then one per column.
    each = values.mapInArrow(run, "i int, n double, mean double, far double")
    out = [(0.0, 1.0)] * len(cols)
    for r in each.groupBy("i").applyInArrow(merged, "i int, mean double, deviation double").collect():
        out[r["i"]] = (r["mean"], r["deviation"] or 1.0)
    return out


def _waves(blocks: int, pairs: int) -> list[list[tuple[int, int]]]:
    """All pairs of blocks (i >= j), a wave at a time; the pairs of a wave share few blocks."""
    side = max(1, math.isqrt(pairs))
    groups = range(0, blocks, side)
    waves = [[(i, j) for i in range(a, min(a + side, blocks)) for j in range(b, min(b + side, blocks)) if i >= j] for a in groups for b in groups if a >= b]
    return [w for w in waves if w]


def _tiles(pairs: list[tuple[int, int]], members: dict[int, list[str]], strip: int):
    numbers = _numbers()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = {(i, j): np.zeros((MATRICES, len(members[i]), len(members[j]))) for i, j in pairs}
        for batch in batches:
            block = {}
            for b, names in members.items():
                x = numbers(batch, names)
                known = ~np.isnan(x)
                x = np.where(known, x, 0.0)
                block[b] = (x, known.astype("f8"), x * x)
            for (i, j), t in total.items():
                (x, m, xx), (y, k, yy) = block[i], block[j]
                t += np.stack([m.T @ k, x.T @ k, m.T @ y, xx.T @ k, m.T @ yy, x.T @ y])
        for (i, j), t in total.items():
            for at in range(0, t.shape[1], strip):
                part = t[:, at : at + strip].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([at], pa.int32()), pa.array([part], pa.binary())], names=["i", "j", "at", "sums"])

    return run


def _added():
    def run(key, rows):
        import numpy as np
        import pyarrow as pa

        total = None
        for part in rows.column("sums").to_pylist():
            own = np.frombuffer(part, "f8")
            total = own.copy() if total is None else total + own
        return pa.table([pa.array([k.as_py()], pa.int32()) for k in key[:3]] + [pa.array([total.tobytes()], pa.binary())], names=["i", "j", "at", "sums"])

    return run


def _correlated(members: dict[int, list[int]], absolute: bool):
    """(i, j, r) of the column pairs of a strip, every pair once, the later column first; r is null where a side is constant."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i, j, at, sums in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "at", "sums"))):
                rows, cols = np.array(members[i]), np.array(members[j])
                n, x, y, xx, yy, xy = np.frombuffer(sums, "f8").reshape(MATRICES, -1, len(cols))
                rows = rows[at : at + len(n)]
                with np.errstate(all="ignore"):
                    spread = np.sqrt(np.maximum(xx - x * x / n, 0)) * np.sqrt(np.maximum(yy - y * y / n, 0))
                    # On scaled columns anything this small is rounding, so that side is constant.
                    r = np.where(spread > 1e-9 * n, (xy - x * y / n) / spread, np.nan)
                r = np.abs(r) if absolute else r
                a, b = np.nonzero(rows[:, None] > cols[None, :])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[a].astype("i4")), pa.array(cols[b].astype("i4")), pa.array(r[a, b], mask=np.isnan(r[a, b]))], names=["i", "j", "r"])

    return run


def corr_tiled(df: DataFrame, cols: list[str], absolute: bool = False, tile: int = TILE, strip: int = STRIP, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Pearson r of every column pair in long form, as ``profile.corr_matrix`` gives it, for any number of columns."""
    if not cols:
        return df.sparkSession.createDataFrame([], "col_i string, col_j string, r double")
    numbers = range(len(cols))
    # Stored, so that moments and passes do not make the rows anew; a pass reads its own columns only.
    df = materialize(df.select(*[F.col(f"`{c}`").cast("double").alias(str(i)) for i, c in enumerate(cols)]), "columns")
    scale = moments(df, df.columns)
    known = {b: [i for i in numbers[at : at + tile]] for b, at in enumerate(range(0, len(cols), tile))}
    width = F.lit(None).cast("double")
    waves = _waves(len(known), max(1, task_bytes // (8 * MATRICES * tile * tile)))
    out = None
    for pairs in waves:
        blocks = sorted({b for pair in pairs for b in pair})
        scaled = df.select(*[
            ((F.nanvl(F.col(str(i)), width) - scale[i][0]) / scale[i][1]).alias(str(i)) for b in blocks for i in known[b]])
        members = {b: [str(i) for i in known[b]] for b in blocks}
        made = scaled.mapInArrow(_tiles(pairs, members, strip), "i int, j int, at int, sums binary")
        out = made if out is None else out.unionByName(made)
    steps = max(1, math.ceil(df.rdd.getNumPartitions() / AT_ONCE))
    schema, key = "i int, j int, at int, sums binary", ["i", "j", "at"]
    salted = out.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(steps)))
    sums = salted.groupBy(*key, "salt").applyInArrow(_added(), schema)
    if steps > 1:
        sums = sums.groupBy(*key).applyInArrow(_added(), schema)
    pairs = sums.mapInArrow(_correlated(known, absolute), "i int, j int, r double")
    if len(cols) <= tile:
        names = F.array(*[F.lit(c) for c in cols])
        return pairs.select(F.get(names, "i").alias("col_i"), F.get(names, "j").alias("col_j"), "r")
    named = df.sparkSession.createDataFrame(list(enumerate(cols)), "n int, name string")
    return (
        pairs.join(F.broadcast(named.toDF("i", "col_i")), "i").join(F.broadcast(named.toDF("j", "col_j")), "j").select("col_i", "col_j", "r"))
