"""Rows of a costly frame are made once for all passes over them."""

import numpy as np

from millrace.operators import gram


def test_passes_of_correlations_make_the_rows_once(spark):
    made = spark.sparkContext.accumulator(0)
    x = np.random.default_rng(2).normal(size=(400, 7))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"c{i}" for i in range(7)]).repartition(2)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    got = {(r["col_i"], r["col_j"]): r["r"] for r in gram.corr_tiled(df.mapInArrow(counted, df.schema), df.columns, tile=3, task_bytes=1).collect()}
    assert made.value == 400
    want = np.corrcoef(x.T)
    assert len(got) == 21 and all(abs(got[f"c{i}", f"c{j}"] - want[i, j]) < 1e-9 for i in range(7) for j in range(i))
