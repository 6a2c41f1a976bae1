"""Tables whose rows several columns identify, or none."""

import itertools
import uuid

import pytest
from pyspark.sql import functions as F

from tabml.functions import hashing
from tabml.operators import score
from tabml.plans.train import train
from tabml.session import checkpoint_dir
from tabml.sources import store


def test_row_key_tells_rows_apart_and_keeps_their_order(spark):
    values = itertools.product([None, -(1 << 63), -5, 0, 7, (1 << 63) - 1], [None, "", "/", "a", "a/", "ab", "é"])
    df = spark.createDataFrame(list(values), "a long, b string")
    rows = df.select("a", "b", hashing.row_key(df, ["a", "b"]).alias("k")).collect()
    assert len({r.k for r in rows}) == len(rows) == 42

    def place(r):
        return r.a is not None, r.a or 0, r.b is not None, (r.b or "").encode()
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.k)] == [(r.a, r.b) for r in sorted(rows, key=place)]


def test_row_key_of_other_types(spark):
    df = spark.sql("""SELECT * FROM VALUES (true, 1.5D, DATE'1960-01-01', TIMESTAMP'2020-01-01 00:00:00', array(1.0D), 1.10),
                      (false, 1.5D, DATE'1960-01-01', TIMESTAMP'2020-01-01 00:00:00', array(1.0D, 2.0D), 1.20),
                      (null, null, null, null, null, null) AS t(a, b, c, d, e, f)""")
    assert df.select(hashing.row_key(df, df.columns).alias("k")).distinct().count() == 3


@pytest.mark.parametrize("block", [1 << 16, 4])
def test_equal_rows_are_numbered(spark, block, monkeypatch):
    monkeypatch.setattr(hashing, "_COPIES", block)
    df = spark.range(50).select(F.when(F.col("id") < 21, F.lit(None)).otherwise(F.col("id") % 3).alias("a"),
                                F.when(F.col("id") < 40, F.lit("x")).alias("b"))
    got = hashing.number_copies(df, "n").groupBy("a", "b").agg(F.sort_array(F.collect_list("n")).alias("n")).collect()
    want = {(r.a, r.b): list(range(r["count"])) for r in df.groupBy("a", "b").count().collect()}
    assert {(r.a, r.b): r.n for r in got} == want
    assert hashing.number_copies(df.limit(0), "n").count() == 0


def _table(spark, n=240):
    return spark.range(n).select((F.col("id") % 40).alias("a"), (F.col("id") / 40).cast("int").cast("string").alias("b"),
                                 (F.col("id") % 8).cast("double").alias("x"), (F.col("id") % 3).alias("z"),
                                 F.when(F.col("id") % 8 < 4, "lo").otherwise("hi").alias("y"))


@pytest.mark.parametrize("model, key", [("knn_classifier", ["a", "b"]), ("tree_classifier", None)])
def test_train_save_load_and_score(spark, model, key):
    t = _table(spark)
    r = train(t, key, "y", ["x", "z"], model)
    assert [c for c in r.predictions.columns if c.startswith("_")] == [] and r.predictions.count() == 240
    assert r.predictions.where("is_test").count() == 48
    again = train(t.repartition(7), key, "y", ["x", "z"], model)
    keys = (key or []) + ["is_test", "y", "pred_y"]
    assert sorted(map(tuple, again.predictions.select(*keys).collect())) == sorted(map(tuple, r.predictions.select(*keys).collect()))
    path = f"{checkpoint_dir(spark)}/keys-{uuid.uuid4().hex}"
    store.save_model(r.bundle, path)
    b = store.load_model(path)
    assert b.key == key
    out = score.predict(b, t, keep=["x", "y"])
    assert out.columns == [*(key or []), "x", "y", "pred_y"] and out.count() == 240
    assert out.where("y = pred_y").count() == 240


def test_scoring_a_large_training_side_without_a_key(spark, monkeypatch):
    from tabml.operators import knn
    t = _table(spark)
    b = train(t, None, "y", ["x", "z"], "knn_classifier").bundle
    b.prepared = knn.prepare(b.knn_train, b.row_key, "features", b.targets, b.task, 0)
    out = score.predict(b, t, keep=["x", "z", "y"])
    assert out.count() == 240 and out.where("y = pred_y").count() == 240


def test_search_with_two_key_columns(spark):
    r = train(_table(spark), ("a", "b"), "y", ["x", "z"], "tree_classifier", use_cv=True, folds=2, grid={"max_depth": [1, 3]})
    assert r.cv_report.count() >= 2 and r.bundle.key == ["a", "b"]


def test_keys_that_cannot_be(spark):
    with pytest.raises(ValueError, match="targets"):
        train(_table(spark), ["a", "y"], "y", ["x"], "tree_classifier")
    with pytest.raises(ValueError, match="no key"):
        train(_table(spark), [], "y", ["x"], "tree_classifier")


def test_a_group_of_copies_is_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(hashing, "_COPIES", 500)
    monkeypatch.setattr(hashing, "_TASK_ROWS", 1000, raising=False)
    df = hashing.number_copies(spark.range(20000).select(F.lit("x").alias("a")), "n")
    made = df.groupBy(F.spark_partition_id().alias("t")).agg(F.count(F.lit(1)).alias("c")).collect()
    assert sum(r.c for r in made) == df.select("n").distinct().count() == 20000
    assert max(r.c for r in made) <= 5000  # all in one task before: the blocks are few bytes
