"""Insight of SVM classifiers, and the evaluation sink's runs."""

import uuid

import pytest
from pyspark.sql import functions as F

from tabml.operators import svm
from tabml.plans.train import insight, train
from tabml.session import checkpoint_dir
from tabml.sources import store


def _rows(spark):
    """Three classes on a line, and a second target."""
    return spark.range(90).select("id", (F.col("id") % 9).cast("double").alias("u"), (F.col("id") % 5).cast("double").alias("v"),
                                  F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.floor((F.col("id") % 9) / 3) + 1).cast("int")).alias("y"),
                                  (F.col("id") % 5 > 1).alias("z"))


def test_one_vs_rest_counts_rows_inside_any_margin(spark):
    df = _rows(spark).select("id", "y", F.array("u", "v").alias("features"))
    m = svm.SVC(kernel="linear", multiclass="ovr", max_iter=10).fit(df, "y", key="id")
    got = {r.label: r for r in svm.svm_insight(m, df, "id", n_ids=3).collect()}
    want = {}
    for r in df.collect():
        margins = [one.intercept + sum(w * x for w, x in zip(one.coefficients, r.features)) for one in m.model_.models]
        if any((f if m.classes_[c] == r.y else -f) <= 1 + 1e-9 for c, f in enumerate(margins)):
            want.setdefault(r.y, []).append(r.id)
    assert {c: r.n_support for c, r in got.items()} == {c: len(v) for c, v in want.items()}
    for c, r in got.items():
        assert r.first_support_ids == sorted(want[c])[:3] and r.n_machines == 1 and r.n_coefficients == 2
        assert r.intercepts == [m.model_.models[m.classes_.index(c)].intercept]


def test_insight_of_a_chosen_target(spark):
    t = _rows(spark)
    b = train(t, "id", ["y", "z"], ["u", "v"], "svm_classifier", max_iter=10).bundle
    by_y = insight(b, t, "y").collect()
    assert {r.label for r in by_y} <= {"a", "b", "c"} and {r.target for r in by_y} == {"y"} and len(by_y) > 1
    assert {r.label for r in insight(b, t, "z").collect()} <= {True, False}
    with pytest.raises(ValueError, match="choose a target"):
        insight(b, t)
    with pytest.raises(ValueError, match="unknown target"):
        insight(b, t, "u")


def test_a_run_written_again_replaces_itself(spark):
    path = f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    ev = spark.createDataFrame([("y", "test", "accuracy", 0.5), ("y", "train", "accuracy", 0.75)], "target string, split string, metric string, value double")
    for run in ("1", "2", "1"):
        store.write_evaluation(ev, path, "json", "m", run=run)
    assert [tuple(r) for r in spark.read.json(path).groupBy("model", "run").count().orderBy("run").collect()] == [("m", 1, 2), ("m", 2, 2)]
