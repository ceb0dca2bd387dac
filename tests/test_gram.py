"""The tiled Gram matrix against numpy and against the one-block form."""

import numpy as np
import pytest

from millrace.operators import features, gram, profile
from tests.conftest import rows_of


def wide(spark, n, d, seed=1):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n, 5))
    x = base @ r.normal(size=(5, d)) + r.normal(size=(n, d)) * 2
    x = x * 10.0 ** r.integers(-3, 5, d) + 10.0 ** r.integers(0, 6, d)
    x[r.random((n, d)) < 0.03] = np.nan
    names = [f"c{i}" for i in range(d)]
    return spark.createDataFrame([[None if v != v and i % 2 else float(v) for i, v in enumerate(row)] for row in x], names).repartition(3), x, names


def table_of(df):
    return {(r["col_i"], r["col_j"]): r["r"] for r in df.collect()}


def test_equals_the_form_of_one_block(spark):
    df, _, names = wide(spark, 300, 11)
    df = df.selectExpr("*", "7 as flat", "cast(null as double) as nothing")
    cols = [*names, "flat", "nothing"]
    want = table_of(profile.corr_matrix(df, cols))
    for options in ({"tile": 4, "strip": 3}, {"tile": 4, "strip": 2, "task_bytes": 1}, {"tile": 13}, {"tile": 5, "task_bytes": 8 * 6 * 25 * 4}):
        got = table_of(gram.corr_tiled(df, cols, **options))
        assert got.keys() == want.keys() and len(got) == 78
        assert all(got[k] == pytest.approx(want[k]) if want[k] is not None else got[k] is None for k in want)


def test_hundreds_of_columns(spark):
    df, x, names = wide(spark, 200, 300)
    got = table_of(profile.corr_matrix(df, names, absolute=True))
    assert len(got) == 300 * 299 // 2
    for i, j in ((5, 0), (299, 298), (256, 255), (270, 3)):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[f"c{i}", f"c{j}"] == pytest.approx(abs(np.corrcoef(x[both, i], x[both, j])[0, 1]))
    assert rows_of(features.prune_list(df, names, 2.0)) == []


def test_waves_hold_every_pair_once():
    for blocks, pairs in ((1, 1), (7, 1), (7, 5), (20, 81), (3, 100)):
        waves = gram._waves(blocks, pairs)
        every = [p for w in waves for p in w]
        assert sorted(every) == [(i, j) for i in range(blocks) for j in range(i + 1)] and max(map(len, waves)) <= pairs


def test_moments(spark):
    df, x, names = wide(spark, 150, 6, seed=4)
    for (mean, deviation), own in zip(gram.moments(df, names), x.T):
        assert (mean, deviation) == (pytest.approx(np.nanmean(own)), pytest.approx(np.nanstd(own)))
    assert gram.moments(df.limit(0), names) == [(0.0, 1.0)] * 6
    assert not gram.corr_tiled(df.limit(0), names, tile=2).filter("r is not null").count()
