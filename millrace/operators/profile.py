"""Exploratory aggregates: frequencies, rates, distributions, correlations."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import hash_below
from millrace.functions.scalars import nan_as_null
from millrace.operators import gram
from millrace.operators.ranking import label_codes, quantiles
from millrace.session import materialize


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    return (
        df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), c)
    )


def value_pct(df: DataFrame, c: str) -> DataFrame:
    """Share of each value in percent of the non-null rows."""
    counts = value_counts(df, c)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def group_mean(df: DataFrame, keys: list[str], c: str, name: str = "mean") -> DataFrame:
    """Mean per group of the rows whose keys are all known."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.avg(c).alias(name))


def group_count(df: DataFrame, keys: list[str], c: str, name: str = "n") -> DataFrame:
    """Non-null values of ``c`` per group of the rows whose keys are all known."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(c).alias(name))


#: So many values of a column become columns of their own; more become sparse vectors.
WIDE = 1000
#: Codes that one row of a sparse crosstab covers.
SPAN = 1 << 16


def domain(df: DataFrame, c: str, limit: int = WIDE) -> list | None:
    """Sorted distinct known values of a column, or None where there are more than ``limit``."""
    values = [r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct().limit(limit + 1).collect()]
    return sorted(values) if len(values) <= limit else None


def domains(df: DataFrame, cols: list[str], limit: int = WIDE) -> dict[str, list | None]:
    """:func:`domain` of several columns by one job."""
    kinds = {c: df.schema[c].dataType for c in cols}
    one = lambda i: F.struct(F.lit(i).alias("i"), *[
        (F.col(f"`{c}`") if j == i else F.lit(None).cast(kinds[c])).alias(f"v{j}") for j, c in enumerate(cols)])
    values = df.select(F.explode(F.array(*map(one, range(len(cols))))).alias("e")).select("e.*").distinct()
    known = F.expr(" OR ".join(f"v{j} IS NOT NULL" for j in range(len(cols))))
    few = values.filter(known).withColumn("_n", F.row_number().over(Window.partitionBy("i").orderBy(F.xxhash64(*[f"v{j}" for j in range(len(cols))])))).filter(F.col("_n") <= limit + 1)
    found: dict[str, list] = {c: [] for c in cols}
    for r in few.collect():
        found[cols[r["i"]]].append(r[f"v{r['i']}"])
    return {c: sorted(v) if len(v) <= limit else None for c, v in found.items()}


def crosstab(df: DataFrame, a: str, b: str, values: list | None = None, limit: int = WIDE) -> DataFrame:
    """Counts of ``a`` × ``b`` with one column per value of ``b``; absent pairs are 0.

    More than ``limit`` values are too many for columns: the rows are then those of
    :func:`crosstab_sparse`, which any number of values fits.
    """
    values = domain(df, b, limit) if values is None else values
    if values is None:
        return crosstab_sparse(df, a, b)[0]
    return df.filter(F.col(a).isNotNull()).groupBy(a).agg(*[
        F.count_if(F.col(b) == v).alias(str(v)) for v in values
    ])


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """``a``, ``b``, ``n`` of every pair that occurs, and the margins.

    ``margin`` says what a row counts: a pair ("none"), all of one value ("a" or
    "b", the other column is null), or everything ("all"). Nulls are not counted.
    """
    pairs = materialize(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n")), "pairs")
    # The margins add up the pairs, so the table is read once however many rows a value has.
    sums = pairs.rollup(a, b).agg(F.sum("n").alias("n"), F.grouping_id().alias("_g")).filter("_g > 0")
    named = F.when(F.col("_g") == 3, "all").otherwise("a")
    other = pairs.groupBy(b).agg(F.sum("n").alias("n")).select(F.lit(None).cast(df.schema[a].dataType).alias(a), b, "n", F.lit("b").alias("margin"))
    return pairs.withColumn("margin", F.lit("none")).unionByName(
        sums.select(a, b, "n", named.alias("margin"))).unionByName(other)


def crosstab_sparse(df: DataFrame, a: str, b: str, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Counts of ``a`` × ``b`` as sparse vectors, and the dictionary (``b``, ``code``) of their indices.

    Codes number the values of ``b`` in order. A row holds the counts of one value of
    ``a`` for one ``block`` of ``span`` codes: ``codes`` in order with their ``counts``, and their
    ``total``. A row is bounded by the span, whatever the number of values or rows.
    """
    pairs = materialize(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n")), "pairs")
    codes = materialize(label_codes(pairs, b), "codes")
    coded = pairs.join(codes.withColumnRenamed(b, "_b"), F.col(b) == F.col("_b"))
    block = F.floor(F.col("code") / span).cast("long").alias("block")
    rows = coded.groupBy(a, block).agg(F.array_sort(F.collect_list(F.struct("code", "n"))).alias("_in"), F.sum("n").alias("total"))
    return rows.select(a, "block", F.col("_in.code").alias("codes"), F.col("_in.n").alias("counts"), "total"), codes


def rate(df: DataFrame, pred: Column, by: list[str] | None = None, name: str = "rate") -> DataFrame:
    """Percent of rows for which ``pred`` holds, overall or per group."""
    share = (F.avg(F.when(pred, 1.0).otherwise(0.0)) * 100).alias(name)
    return df.dropna(subset=by).groupBy(*by).agg(share) if by else df.agg(share)


def box_stats(df: DataFrame, keys: list[str], c: str, buckets: int = 64, approx: int | None = None) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers at 1.5 IQR, outlier count.

    Quartiles are exact; ``approx`` takes the accuracy of ``percentile_approx``
    instead when an estimate is enough.
    """
    # The source is worked out once; the passes below read the stored columns.
    known = materialize(df.dropna(subset=[*keys, c]).select(*keys, c), "box")
    if approx:
        box = known.groupBy(*keys).agg(*[
            F.percentile_approx(c, p, approx).cast("double").alias(n)
            for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
        ])
    else:
        box = quantiles(known, keys, c, {"q1": 0.25, "median": 0.5, "q3": 0.75}, buckets)
    iqr = F.col("q3") - F.col("q1")
    box = box.withColumns({"_low": F.col("q1") - iqr * 1.5, "_high": F.col("q3") + iqr * 1.5})
    inside = F.col(c).between(F.col("_low"), F.col("_high"))
    return known.join(box, keys).groupBy(*keys).agg(
        F.min(c).cast("double").alias("min"),
        *[F.first(q).alias(q) for q in ("q1", "median", "q3")],
        F.max(c).cast("double").alias("max"),
        F.min(F.when(inside, F.col(c))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col(c))).cast("double").alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def histogram(df: DataFrame, c: str, bins: int = 30, by: list[str] | None = None) -> DataFrame:
    """Rows per equal-width bin and class; the last bin includes the maximum.

    A constant column gets a bin range one unit wide around its value.
    """
    by = by or []
    known = df.filter(F.col(c).isNotNull())
    lo, hi = known.agg(F.min(c).cast("double"), F.max(c).cast("double")).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    bin_no = F.least(F.floor((F.col(c) - lo) / width), F.lit(bins - 1)).cast("int")
    return (
        known.groupBy(*by, bin_no.alias("bin")).agg(F.count("*").alias("n"))
        .withColumn("bin_start", F.lit(lo) + F.col("bin") * width)
    )


def density(df: DataFrame, c: str, points: int = 32) -> DataFrame:
    """Gaussian kernel density on an even grid, bandwidth by Scott's rule.

    The grid reaches half the value range beyond both ends. One pass computes
    all grid sums; no row is repeated per grid point.
    """
    known = df.filter(F.col(c).isNotNull())
    n, sd, lo, hi = known.agg(
        F.count("*"), F.stddev_samp(c), F.min(c).cast("double"), F.max(c).cast("double")
    ).first()
    if n < 2 or not sd:
        raise ValueError(f"{c} needs at least two different values for a density")
    h = sd * n ** -0.2
    start, step = lo - 0.5 * (hi - lo), 2 * (hi - lo) / (points - 1)
    grid = [start + i * step for i in range(points)]
    scale = 1.0 / (n * h * math.sqrt(2 * math.pi))
    sums = known.agg(*[
        (F.sum(F.exp(-0.5 * F.pow((F.col(c) - g) / h, F.lit(2)))) * scale).alias(str(i))
        for i, g in enumerate(grid)
    ])
    long = sums.unpivot([], [str(i) for i in range(points)], "point", "density")
    return long.select(
        F.col("point").cast("int").alias("point"),
        (F.lit(start) + F.col("point").cast("int") * step).alias("x"), "density",
    )


def describe(df: DataFrame, cols: list[str], buckets: int = 64) -> DataFrame:
    """count, mean, sample std, min, quartiles and max of the known values, one row per column."""
    wide = materialize(nan_as_null(df.select([F.col(c).cast("double").alias(c) for c in cols])), "described")
    long = wide.unpivot([], cols, "column", "value")
    figures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    # One row of figures for all columns; the rows are not multiplied by the columns for it.
    row = wide.agg(*[F.struct(*[f(c).alias(n) for n, f in figures.items()]).alias(c) for c in cols])
    moments = row.unpivot([], cols, "column", "f").select("column", "f.*").filter("count > 0")
    quartiles = quantiles(long, ["column"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, buckets)
    return moments.join(quartiles, "column")


def _per_column(df: DataFrame, cols: list[str], agg, value: str) -> DataFrame:
    """One aggregate per column in a single pass, as (column, value) rows."""
    return df.agg(*[agg(c).alias(c) for c in cols]).unpivot([], cols, "column", value)


def info(df: DataFrame) -> DataFrame:
    """Type and number of known values of every column."""
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return _per_column(nan_as_null(df), df.columns, F.count, "non_null").withColumn("type", types[F.col("column")])


def missing(df: DataFrame) -> DataFrame:
    """Count and percent of missing values of the columns that have any, most first."""
    n_rows = "_rows"
    wide = nan_as_null(df).agg(F.count("*").alias(n_rows), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return (
        wide.unpivot([n_rows], df.columns, "column", "total")
        .filter("total > 0")
        .select("column", "total", (F.col("total") * 100.0 / F.col(n_rows)).alias("pct"))
        .orderBy(F.desc("total"), "column")
    )


def nunique(df: DataFrame, c: str, approx: bool = False) -> DataFrame:
    """Number of distinct non-null values."""
    agg = F.approx_count_distinct(c) if approx else F.count_distinct(c)
    return df.agg(agg.alias("n_distinct"))


def uniques(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values per column, as text, in long form; null counts as a value."""
    return df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value").distinct()


def duplicates(df: DataFrame) -> DataFrame:
    """Every row that occurs more than once, with its number of extra copies."""
    return df.groupBy(*df.columns).agg((F.count("*") - 1).alias("extra")).filter("extra > 0")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Number of rows beyond the first copy of each."""
    return duplicates(df).agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("long").alias("duplicates"))


def _corr(a: str, b: str) -> Column:
    """Pearson r over the rows where both are known; null when one side is constant."""
    x = F.when(F.col(b).isNotNull(), F.col(a)).cast("double")
    y = F.when(F.col(a).isNotNull(), F.col(b)).cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_matrix(df: DataFrame, cols: list[str], absolute: bool = False) -> DataFrame:
    """Pearson r of every column pair, ``col_i`` after ``col_j``, in long form.

    Each pair uses the rows where both are known; r is null when a side is
    constant there. Columns are first brought to mean 0 and deviation 1; then
    every task adds up its cross products as small matrices and emits one row of
    sums per pair, whatever its number of rows. Very wide tables go by tiles, see ``gram``.
    """
    d = len(cols)
    if d > gram.TILE:
        return gram.corr_tiled(df, cols, absolute)
    df = nan_as_null(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    scaled = df.select([
        ((F.col(c).cast("double") - F.lit(row[f"m{i}"])) / F.lit(row[f"s{i}"] or 1.0)).alias(str(i))
        for i, c in enumerate(cols)])

    def cross(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros((4, d, d))
        for batch in batches:
            x = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(d)])
            known = ~np.isnan(x)
            x, m = np.where(known, x, 0.0), known.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        i, j = np.tril_indices(d, -1)
        n, s, ss, sp = total
        values = [n[i, j], s[i, j], s[j, i], ss[i, j], ss[j, i], sp[i, j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype("int32")), pa.array(j.astype("int32")), *map(pa.array, values)],
            names=["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    sums = scaled.mapInArrow(
        cross, "i int, j int, n double, x double, y double, xx double, yy double, xy double"
    ).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    var = lambda square, total: F.col(square) - F.try_divide(F.col(total) * F.col(total), "n")
    spread = F.sqrt(F.greatest(var("xx", "x"), F.lit(0.0))) * F.sqrt(F.greatest(var("yy", "y"), F.lit(0.0)))
    # On scaled columns anything this small is rounding, so that side is constant.
    r = F.when(spread > 1e-9 * F.col("n"), (F.col("xy") - F.col("x") * F.col("y") / F.col("n")) / spread)
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(
        F.get(names, "i").alias("col_i"), F.get(names, "j").alias("col_j"),
        (F.abs(r) if absolute else r).alias("r"))


def corr_with(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """Pearson r of every column with the target, largest first, over the rows where both are known."""
    return (
        nan_as_null(df.select(*dict.fromkeys([target, *cols]))).agg(*[_corr(c, target).alias(c) for c in cols])
        .unpivot([], cols, "column", "r").orderBy(F.desc_nulls_last("r"), "column")
    )


def variances(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sample variance of the known values per column."""
    return _per_column(nan_as_null(df.select(*cols)), cols, F.var_samp, "variance")


def top_variance(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    """The n columns with the largest sample variance."""
    return variances(df, cols).orderBy(F.desc_nulls_last("variance"), "column").limit(n)


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def estimate_count(df: DataFrame, keys: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """Row count estimated from a key-determined sample."""
    sampled = df.filter(hash_below(fraction, *keys, seed=seed))
    return sampled.agg(F.count("*").alias("sampled")).withColumn(
        "estimate", F.round(F.col("sampled") / fraction).cast("long"))


def pred_distribution(df: DataFrame, c: str = "prediction") -> DataFrame:
    """Rows and share in percent per predicted class."""
    return value_pct(df, c).withColumnRenamed("pct", "share")
