"""What a Python worker holds in the neighbour join is bounded in bytes, not by the table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.operators import knn, tuning


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist(), i % 3) for i, r in enumerate(x)], "id long, x array<double>, y int").repartition(3)


def test_cuts_of_narrow_rows_stay_within_the_bytes(spark, monkeypatch):
    limit, k = 1 << 18, 7
    monkeypatch.setattr(knn, "_CUT_BYTES", limit)

    def sizes(k, p):
        def fn(train, test):
            import pandas as pd
            some = [len(train)] if len(train) and len(test) else []
            return pd.DataFrame({"_g": [0] * len(some), "qk": [len(test)] * len(some), "tk": some, "dist": [-float(n) for n in some], "y": [0] * len(some)})
        return fn

    monkeypatch.setattr(knn, "_block_topk", sizes)
    rng = np.random.default_rng(11)
    x = rng.uniform(size=(60_000, 2))
    x[:9000] = x[0]
    df = frame(spark, x)
    got = knn.neighbors(df, df.where("id % 3 = 0").select(F.col("id").alias("qid"), "x"), "id", "x", "y", k, 2, 16,
                        test_key="qid", broadcast_bytes=0).collect()
    # a vector and its objects take 400 bytes or more, a neighbour 60 (cuts are by hash: a quarter more is chance)
    assert max(r["nn_key"] for r in got) * 400 < 1.25 * limit
    assert max(r["qid"] for r in got) * k * 60 < 1.25 * limit


def test_rows_are_routed_in_slices(spark, monkeypatch):
    monkeypatch.setattr(knn, "_ROUTE_CELLS", 200)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(300, 2))
    df = frame(spark, x)
    nb = knn.neighbors(df, df.select(F.col("id").alias("qid"), "x"), "id", "x", "y", 3, 2, 16, test_key="qid", broadcast_bytes=0)
    got = {(r["qid"], r["nn_rank"]): r["nn_key"] for r in nb.collect()}
    d = knn._significant(knn._minkowski(x, x, 2))
    want = np.stack([np.lexsort((np.arange(len(x)), row))[:3] for row in d])
    assert got == {(i, j + 1): int(want[i, j]) for i in range(len(x)) for j in range(3)}


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_predictions_follow_the_rules_of_vote_and_regress(spark, weights):
    rng = np.random.default_rng(13)
    rows = []
    for i in range(200):
        d = np.sort(rng.integers(0 if i % 3 else 1, 4, 5)).astype(float)
        rows += [(i, j + 1, float(d[j]), None if rng.random() < 0.1 else int(rng.integers(0, 3))) for j in range(5)]
    nb = spark.createDataFrame(rows, "id long, nn_rank int, dist double, nn_label int")
    near = nb.select("id", F.struct("nn_rank", "dist", F.struct(F.col("nn_label").alias("y")).alias("_y")).alias("_n"))
    near = near.groupBy("id").agg(F.sort_array(F.collect_list("_n")).alias("_near"))
    for k in (1, 3, 5):
        got = {r["id"]: r["v"] for r in near.select("id", tuning._prediction(k, weights, "y", "classification").alias("v")).collect()}
        want = {r["id"]: r["prediction"] for r in knn.vote(nb, "id", k, weights).collect()}
        assert got == want
        got = {r["id"]: r["v"] for r in near.select("id", tuning._prediction(k, weights, "y", "regression").alias("v")).collect()}
        want = {r["id"]: r["prediction"] for r in knn.regress(nb, "id", k, weights).collect()}
        assert {i: v is None for i, v in got.items()} == {i: v is None for i, v in want.items()}
        assert all(v is None or abs(v - want[i]) < 1e-12 for i, v in got.items())


def test_grid_search_meets_neighbours_once_for_all_labels(spark):
    df = spark.range(90).selectExpr("id", "cast(id % 9 as double) as a", "cast(id % 7 as double) as c", "id % 2 as y1", "concat('c', id % 3) as y2")
    rep = tuning.knn_grid_search(df, "id", ["a", "c"], ["y1", "y2"], folds=3, scoring="accuracy",
                                 grid={"scaler": [None], "n_neighbors": [3], "weights": ["uniform"], "p": [2], "algorithm": ["auto"]})
    assert "FlatMapCoGroupsInPandas" not in rep._jdf.queryExecution().toString()  # once for each label before
    assert 0 <= rep.first()["mean_test_score"] <= 1
