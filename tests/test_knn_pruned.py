"""The pruned neighbour join against brute force, and what it sends where."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.operators import knn


def frame(spark, x, start=0):
    return spark.createDataFrame([(start + i, r.tolist(), i % 3) for i, r in enumerate(x)], "id long, x array<double>, y int").repartition(3)


def brute(train, test, k, p):
    out = set()
    for i, q in enumerate(test):
        d = knn._significant(knn._minkowski(q[None, :], train, p)[0])
        for r, j in enumerate(np.lexsort((np.arange(len(train)), d))[:k]):
            out.add((i, r + 1, int(j), round(float(d[j]), 9)))
    return out


def rows_of(df):
    return {(r["qid"], r["nn_rank"], r["nn_key"], round(r["dist"], 9)) for r in df.collect()}


@pytest.mark.parametrize("p,k,block", [(2, 5, 16), (1, 3, 1000), (3, 4, 40), (2, 200, 32)])
def test_pruned_equals_brute_force(spark, p, k, block):
    rng = np.random.default_rng(int(p * 10 + k))
    train = np.round(rng.normal(size=(160, 3)) + 1000 * rng.integers(0, 3, (160, 1)), 1)  # ties, far from 0
    train[:50] = train[0]  # a third of all rows at one point
    test = np.concatenate([train[40:80], rng.normal(size=(20, 3)) * 500, np.full((30, 3), 7.0)])
    te = frame(spark, test).select(F.col("id").alias("qid"), "x")
    got = knn.neighbors(frame(spark, train), te, "id", "x", "y", k, p, block, test_key="qid", broadcast_bytes=0)
    assert rows_of(got) == brute(train, test, k, p)


def test_rows_visit_few_cells_of_clustered_data(spark):
    rng = np.random.default_rng(1)
    centres = rng.uniform(-100, 100, (40, 8))
    train = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8))
    test = centres[rng.integers(0, 40, 500)] + rng.normal(size=(500, 8))
    cells = knn._Cells(train[:200], 2)
    d = cells.distances(train)[0]
    cell = d.argmin(axis=1)
    own = d[np.arange(len(d)), cell]
    cells.summarise([{"cell": c, "n": int((cell == c).sum()), "lo": own[cell == c].min(), "hi": own[cell == c].max(),
                      "near": np.sort(own[cell == c])[:5]} for c in np.unique(cell)], 5)
    row, _ = cells.visits(test, 5)
    assert len(row) / len(test) < 12  # of 200 cells; blocks without pruning would be all
    got = knn.neighbors(frame(spark, train), frame(spark, test).select(F.col("id").alias("qid"), "x"), "id", "x", "y", 5, 2, 100,
                        test_key="qid", broadcast_bytes=0)
    assert rows_of(got) == brute(train, test, 5, 2)


def test_plan_sends_no_row_everywhere(spark):
    rng = np.random.default_rng(2)
    train = np.repeat(rng.uniform(-1000, 1000, (10, 4)), 100, axis=0) + rng.normal(size=(1000, 4)) * 0.1
    df = frame(spark, train)
    plan = knn.neighbors(df, df.select(F.col("id").alias("qid"), "x"), "id", "x", "y", 3, 2, 50, test_key="qid",
                         broadcast_bytes=0)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Generate" not in plan
    assert "FlatMapCoGroupsInPandas" in plan


def test_several_targets_share_one_neighbour_table(spark):
    rng = np.random.default_rng(3)
    train = rng.normal(size=(90, 2))
    tr = frame(spark, train).withColumn("z", (F.col("id") % 2).cast("string"))
    te = frame(spark, rng.normal(size=(20, 2))).drop("y")
    large = knn.predict(tr, te, "id", "x", ["y", "z"], "classification", 5, block_rows=16, broadcast_bytes=0)
    small = knn.predict(tr, te, "id", "x", ["y", "z"], "classification", 5)
    assert {(r["id"], r["pred_y"], r["pred_z"]) for r in large.collect()} == {(r["id"], r["pred_y"], r["pred_z"]) for r in small.collect()}
