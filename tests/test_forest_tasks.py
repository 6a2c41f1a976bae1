"""What a task of a tree fit keeps follows from a bound, not from the table."""

from tabml.operators import trees


def test_forest_rows_are_dealt_to_more_tasks_as_they_grow(spark, monkeypatch):
    seen = []

    class Model(trees.TreeModel):
        def _fit(self, df, label, features, counts):
            seen.append(df.rdd.getNumPartitions())
            return self

    rows = [(i % 3, [float(i), float(i % 7)]) for i in range(60_000)]
    df = spark.createDataFrame(rows, "y int, features array<double>").coalesce(1)
    par = spark.sparkContext.defaultParallelism
    Model("forest", "classification", n_estimators=100, max_depth=5).fit(df, "y")
    monkeypatch.setattr(trees, "TASK_BYTES", 536 * 1000)  # a row of 100 trees and 2 features takes 536 bytes
    for depth in (5, 20):
        Model("forest", "classification", n_estimators=100, max_depth=depth).fit(df, "y")
    assert seen[0] == par
    assert seen[1] == max(par, 60) and seen[2] > 1.5 * seen[1]


def test_node_ids_are_kept_for_deep_trees_only():
    est = [trees.make_estimator("forest", "classification", max_depth=d) for d in (5, 11)]
    assert [e.getCacheNodeIds() for e in est] == [False, True]
