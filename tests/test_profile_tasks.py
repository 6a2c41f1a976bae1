"""The exact profile keeps the values of one column at a time."""

import pandas as pd

from tabml.sources import io


def test_exact_profile_keeps_no_row_once_per_column(spark):
    rows = [(i % 5, f"n{i % 7}" if i % 11 else None, float(i % 3) if i % 13 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, `b.c` string, d double")
    got = io.profile(df, exact_distinct=True)
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    x = pd.DataFrame(rows, columns=["a", "b.c", "d"])
    found = [(r.column, r.n, r.nulls, r.distinct) for r in got.collect()]
    assert found == [(c, 500, int(x[c].isna().sum()), x[c].nunique()) for c in x]
    assert [r.distinct for r in io.profile(df.limit(0), exact_distinct=True).collect()] == [0, 0, 0]
    assert [r.column for r in io.profile(df, ["d"], exact_distinct=True).collect()] == ["d"]
