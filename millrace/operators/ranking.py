"""Ordered prefix sums over data of any size, and what is built on them.

A window without a partition key, or over one hot group, sorts everything in
one task. Here the ordering column is cut into ranges at sampled split points:
each range is summed on its own, a running sum over the few ranges gives every
range its offset, and the ordered window runs inside one range only.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialize


def split_points(df: DataFrame, order: str, buckets: int) -> list:
    """At most ``buckets - 1`` values that cut ``order`` into about equal ranges.

    The rows with the smallest hashes form a uniform sample of fixed size, so
    what reaches the driver is bounded by ``64 * buckets`` values. Split points
    only steer balance; any set of them gives the same result.
    """
    sample = (
        df.filter(F.col(order).isNotNull())
        .orderBy(F.xxhash64(*df.columns)).limit(64 * buckets)
        .select(order).collect()
    )
    values = sorted(r[0] for r in sample)
    step = max(len(values) / buckets, 1)
    cuts = [values[int(i * step)] for i in range(1, buckets) if int(i * step) < len(values)]
    return sorted(set(cuts))


def with_range(df: DataFrame, order: str, cuts: list) -> DataFrame:
    """Add ``_range``, the number of the range between split points the value lies in.

    Numbers go through a binary search; other types are compared with each
    split point. Either way a smaller value never gets a larger range.
    """
    if not cuts:
        return df.withColumn("_range", F.lit(0))
    if isinstance(df.schema[order].dataType, T.NumericType):
        points = sorted({float(c) for c in cuts if c == c and abs(c) != float("inf")})
        if points:
            ranges = Bucketizer(
                splits=[-float("inf"), *points, float("inf")], inputCol="_number", outputCol="_range",
                handleInvalid="keep")
            numbered = df.withColumn("_number", F.col(order).cast("double"))
            return ranges.transform(numbered).drop("_number").withColumn("_range", F.col("_range").cast("int"))
        return df.withColumn("_range", F.lit(0))
    below = F.filter(F.array(*[F.lit(v) for v in cuts]), lambda cut: cut < F.col(order))
    return df.withColumn("_range", F.size(below))


def running_total(
    df: DataFrame, order: str, measures: list[str], by: list[str] | None = None,
    buckets: int = 64, suffix: str = "_before", stored: bool = False,
) -> DataFrame:
    """Add ``<measure>_before``: the sum of the measure over all smaller ``order`` values.

    ``df`` must hold one row per (``by``, ``order``) with no nulls in those
    columns, so a hot value has already been folded into one row. It is
    materialised once (unless it is ``stored`` already) and then read for the
    split points, the range totals and the result.
    """
    by = by or []
    df = df if stored else materialize(df, "running")
    tagged = with_range(df, order, split_points(df, order, buckets))

    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tagged.groupBy(*by, "_range").agg(*[F.sum(m).alias(m) for m in measures])
    offsets = offsets.select(
        *[F.col(b).alias(f"_by_{b}") for b in by], F.col("_range").alias("_r"),
        *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_off_{m}") for m in measures],
    )
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = tagged.withColumns({
        f"_in_{m}": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures
    })
    match = F.col("_range") == F.col("_r")
    for b in by:
        match = match & (F.col(b) == F.col(f"_by_{b}"))
    return ranked.join(offsets, match).select(
        *df.columns, *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(m + suffix) for m in measures]
    )


def label_codes(df: DataFrame, c: str, buckets: int = 64) -> DataFrame:
    """(value, code): the distinct values in sorted order, numbered from 0."""
    values = df.select(c).filter(F.col(c).isNotNull()).distinct().withColumn("_one", F.lit(1).cast("long"))
    return running_total(values, c, ["_one"], buckets=buckets).select(c, F.col("_one_before").alias("code"))


def _brackets(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], accuracy: int) -> DataFrame:
    """Per group its size and, per quantile, two values that enclose it.

    They come from ``percentile_approx`` two error bounds to either side; a
    group of up to ``accuracy`` rows is enclosed whole.
    """
    margin = 2.0 / accuracy
    points = [min(max(p + d, 0.0), 1.0) for p in probs.values() for d in (-margin, margin)]
    sketch = df.groupBy(*keys).agg(
        F.count("*").alias("_size"), F.min(value).alias("_min"), F.max(value).alias("_max"),
        F.percentile_approx(value, points, accuracy).alias("_near"))
    small = F.col("_size") <= accuracy
    out = []
    for i, name in enumerate(probs):
        out.append(F.when(small, F.col("_min")).otherwise(F.get("_near", F.lit(2 * i))).alias(f"_lo_{name}"))
        out.append(F.when(small, F.col("_max")).otherwise(F.get("_near", F.lit(2 * i + 1))).alias(f"_hi_{name}"))
    return sketch.select(*keys, "_size", *out)


def _pick(
    run: DataFrame, keys: list[str], value: str, probs: dict[str, float],
) -> DataFrame:
    """Interpolated quantiles from running counts.

    ``run`` has per group the values, their counts ``_n``, the counts below
    ``_n_before``, and the group size. A rank that falls on no row gives null.
    """
    out = []
    for name, p in probs.items():
        h = (F.col("_size") - 1) * F.lit(float(p))
        holds = lambda rank: (F.col("_n_before") <= rank) & (rank < F.col("_n_before") + F.col("_n"))
        low, high = F.floor(h), F.ceil(h)
        lo = F.max(F.when(holds(low), F.col(value)))
        hi = F.max(F.when(holds(high), F.col(value)))
        out.append((lo + (hi - lo) * F.max(h - low)).alias(name))
    return run.groupBy(*keys).agg(*out)


def quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], buckets: int = 64, accuracy: int = 10_000,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group, one row per group.

    A first pass encloses every quantile between two approximate ones. A second
    pass keeps single values only inside the enclosures and folds all others
    into one count per gap, so the rows that are shuffled and ordered are a
    fraction of about 4 / accuracy per quantile. Should an enclosure miss its
    quantile, the groups are done again with all values kept. Nulls in the value
    or the keys are left out.
    """
    known = df.dropna(subset=[*keys, value]).select(*keys, F.col(value).cast("double").alias(value))
    box = materialize(_brackets(known, keys, value, probs, accuracy), "brackets")

    def finish(folded: DataFrame) -> DataFrame:
        counts = materialize(folded, "counts")
        run = running_total(counts, value, ["_n", "_gap"], by=keys, buckets=buckets, stored=True)
        run = run.withColumn("_n_before", F.col("_n_before") + F.col("_gap_before"))
        sizes = box.select(*keys, "_size")
        run = run.join(sizes, keys) if keys else run.withColumn("_size", sizes.scalar())
        return materialize(_pick(run, keys, value, probs), "quantiles")

    v = F.col(value)
    if keys:
        joined = known.join(box, keys)
        lo, hi = ({n: F.col(f"_{side}_{n}") for n in probs} for side in ("lo", "hi"))
    else:
        joined, row = known, box.first()
        if not row["_size"]:
            return known.agg(*[F.max(v).alias(n) for n in probs])
        lo, hi = ({n: F.lit(row[f"_{side}_{n}"]) for n in probs} for side in ("lo", "hi"))
    kept = F.lit(False)
    for n in probs:
        kept = kept | v.between(lo[n], hi[n])
    # A value in a gap counts right after the enclosure below it.
    below = F.greatest(*[F.when(hi[n] < v, hi[n]) for n in probs], F.lit(-float("inf")))
    spot = F.when(kept, v).otherwise(below)
    folded = joined.groupBy(*keys, spot.alias(value)).agg(
        F.count_if(kept).alias("_n"), F.count_if(~kept).alias("_gap"))
    out = finish(folded)
    missed = F.lit(False)
    for n in probs:
        missed = missed | F.col(n).isNull()
    if out.filter(missed).limit(1).count():
        every = known.groupBy(*keys, value).agg(F.count("*").alias("_n")).withColumn("_gap", F.lit(0).cast("long"))
        out = finish(every)
    return out
