"""Small inline cases with known answers (FIXTURES.md, 'Small inline cases')."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.functions.rank import HashOrder, cumulative_sums, exact_quantiles, kth_smallest
from tabml.functions.hashing import order_hash
from tabml.operators import curves, knn, metrics, prep, roles, split


def test_vote_tie_goes_to_smaller_class(spark):
    train = spark.createDataFrame([(1, [0.0], "b"), (2, [2.0], "a")], "id long, x array<double>, y string")
    test = spark.createDataFrame([(10, [1.0])], "id long, x array<double>")
    nb = knn.neighbors(train, test, "id", "x", "y", k=2)
    assert knn.vote(nb, "id", 2).first()["prediction"] == "a"


def test_kth_distance_tie_goes_to_smaller_key(spark):
    train = spark.createDataFrame([(5, [1.0], "p"), (3, [-1.0], "q"), (9, [3.0], "r")],
                                  "id long, x array<double>, y string")
    test = spark.createDataFrame([(10, [0.0])], "id long, x array<double>")
    nb = knn.neighbors(train, test, "id", "x", "y", k=1)
    assert nb.first()["nn_key"] == 3


def test_zero_distance_with_distance_weights(spark):
    train = spark.createDataFrame([(1, [0.0], "a"), (2, [0.1], "b"), (3, [0.1], "b")],
                                  "id long, x array<double>, y string")
    test = spark.createDataFrame([(10, [0.0])], "id long, x array<double>")
    nb = knn.neighbors(train, test, "id", "x", "y", k=3)
    assert knn.vote(nb, "id", 3, "distance").first()["prediction"] == "a"
    assert knn.vote(nb, "id", 3, "uniform").first()["prediction"] == "b"
    pr = {r["class"]: r["probability"] for r in knn.proba(nb, "id", 3, "distance").collect()}
    assert pr == {"a": 1.0, "b": 0.0}


def test_blocked_join_equals_single_block(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y int")
    tr, te = df.where("id % 4 != 0"), df.where("id % 4 = 0")
    a = {(r["id"], r["nn_rank"]): r["nn_key"] for r in knn.neighbors(tr, te, "id", "x", "y", 7).collect()}
    b = {(r["id"], r["nn_rank"]): r["nn_key"] for r in
         knn.neighbors(tr, te, "id", "x", "y", 7, block_rows=16, broadcast_bytes=0).collect()}
    assert a == b and len(a) == 75 * 7
    x = np.array([r[1] for r in rows])
    for (q, rank), key in list(a.items())[:50]:
        d = np.sqrt(((x[[i for i in range(300) if i % 4 != 0]] - x[q]) ** 2).sum(1))
        ids = [i for i in range(300) if i % 4 != 0]
        order = sorted(zip(np.round(d, 9), ids))
        assert order[rank - 1][1] == key


def test_median_mode_and_constant_scalers(spark):
    df = spark.createDataFrame([(1.0, "a", 5.0), (2.0, "a", 5.0), (4.0, "b", 5.0), (10.0, "b", 5.0),
                                (None, None, 5.0)], "v double, c string, k double")
    assert prep.fit_median(df, ["v"])["v"] == 3.0
    assert prep.fit_mode(df, ["c"])["c"] == "a"
    c, s = prep.fit_scaler(df.where("v is not null"), ["v", "k"], "standard")
    assert s[1] == 1.0 and abs(s[0] - np.std([1, 2, 4, 10])) < 1e-12
    c, s = prep.fit_scaler(df, ["k"], "minmax")
    assert (5.0 - c[0]) / s[0] == 0.0
    c, s = prep.fit_scaler(df.where("v is not null"), ["v"], "robust")
    assert c[0] == 3.0 and s[0] == np.percentile([1, 2, 4, 10], 75) - np.percentile([1, 2, 4, 10], 25)


def test_unseen_categories(spark):
    fit = spark.createDataFrame([("x",), ("y",)], "c string")
    cats = prep.fit_categories(fit, "c")
    df = spark.createDataFrame([("z",), ("y",)], "c string")
    rows = df.select(prep.ordinal_expr("c", cats).alias("o"), *prep.one_hot_exprs("c", "c", cats)).collect()
    assert rows[0]["o"] == -1.0 and rows[0]["c_x"] == 0.0 and rows[0]["c_y"] == 0.0
    assert rows[1]["o"] == 1.0 and rows[1]["c_y"] == 1.0


def test_constant_target_r2(spark):
    perfect = spark.createDataFrame([(3.0, 3.0), (3.0, 3.0)], "y double, p double")
    off = spark.createDataFrame([(3.0, 3.0), (3.0, 4.0)], "y double, p double")
    assert metrics.regression_scores(perfect, "y", "p").first()["r2"] == 1.0
    assert metrics.regression_scores(off, "y", "p").first()["r2"] == 0.0


def test_never_predicted_class_and_empty_confusion_row(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "y string, p string")
    rep = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rep["b"]["precision"] == 0.0 and rep["b"]["f1"] == 0.0
    only_pred = spark.createDataFrame([("a", "a"), ("a", "z")], "y string, p string")
    cm = metrics.confusion_matrix(only_pred, "y", "p", normalize=True).collect()
    assert len(cm) == 4 and all(r["share"] == 0.0 for r in cm if r["y"] == "z")


def test_roc_auc_equal_and_perfect_scores(spark):
    eq = spark.createDataFrame([(0, 0.5), (1, 0.5), (0, 0.5), (1, 0.5)], "y int, s double")
    perfect = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)], "y int, s double")
    assert curves.roc_auc(eq, "y", "s").first()["auc"] == 0.5
    assert curves.roc_auc(perfect, "y", "s").first()["auc"] == 1.0
    assert abs(curves.pr_auc(perfect, "y", "s").first()["auc"] - 1.0) < 1e-12


def test_binary_only_curves_stop_friendly(spark):
    one = spark.createDataFrame([(1, 0.2), (1, 0.3)], "y int, s double")
    three = spark.createDataFrame([(0, 0.2), (1, 0.3), (2, 0.4)], "y int, s double")
    for df in (one, three):
        with pytest.raises(ValueError, match="exactly two classes"):
            curves.roc_curve(df, "y", "s")


def test_column_name_rules(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "k long, x double, y string")
    with pytest.raises(ValueError, match="duplicate"):
        roles.ColumnRoles.resolve(df, "y", ["x", "x"])
    with pytest.raises(ValueError, match="no feature"):
        roles.ColumnRoles.resolve(df, "y", [" ", ""])
    with pytest.raises(ValueError, match="unknown feature"):
        roles.ColumnRoles.resolve(df, "y", ["nope"])
    with pytest.raises(ValueError, match="overlap"):
        roles.ColumnRoles.resolve(df, "y", ["x", "y"])
    assert roles.ColumnRoles.resolve(df, " y ", None, key="k").features == ["x"]


def test_exact_quantiles_with_hot_value_and_refinement(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 5, 1000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = exact_quantiles(df, "v", probs)
    assert np.allclose(got, np.percentile(vals, [p * 100 for p in probs]), rtol=0, atol=1e-12)
    srt = np.sort(vals)
    ranks = [0, 17, 2999, 4500, 5999]
    got = kth_smallest(df, "v", ranks, cells=16, leaf_rows=50)  # forces refinement levels
    assert [got[r] for r in ranks] == [srt[r] for r in ranks]


def test_hash_cutoffs_refinement_matches_full_rank(spark):
    df = spark.range(0, 20000).withColumn("g", (F.col("id") % 3).cast("int"))
    h = df.withColumn("h", order_hash(7, ["id"]))
    order = HashOrder(h, "h", "g", leaf_rows=3)  # forces refinement below the 3-digit level
    cuts = order.cutoffs({0: [1, 1000, 6667], 2: [3333]})
    pdf = h.toPandas().sort_values("h")
    for (g, pos), val in cuts.items():
        assert pdf[pdf.g == g].h.iloc[pos - 1] == val


def test_split_is_exact_and_partition_independent(spark):
    df = spark.range(0, 1001).withColumn("c", F.when(F.col("id") % 10 == 0, "x").otherwise("y"))
    a = split.train_test_split(df, ["id"], 0.25, 3, stratify="c")
    b = split.train_test_split(df.repartition(7), ["id"], 0.25, 3, stratify="c")
    sa = {r["id"] for r in a.where("is_test").collect()}
    sb = {r["id"] for r in b.where("is_test").collect()}
    assert sa == sb and len(sa) == math.ceil(0.25 * 1001)
    folds = split.kfold(df, ["id"], 4, 3).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in folds] == split.kfold_sizes(1001, 4)


def test_cumulative_sums_match_pandas(spark):
    rng = np.random.default_rng(2)
    rows = [(float(s), int(a), int(b)) for s, a, b in zip(rng.permutation(500), rng.integers(0, 5, 500),
                                                          rng.integers(0, 5, 500))]
    df = spark.createDataFrame(rows, "s double, a long, b long")
    got = cumulative_sums(df, "s", ["a", "b"], descending=True, buckets=8).toPandas().sort_values("s", ascending=False)
    assert (got["cum_a"].to_numpy() == got["a"].cumsum().to_numpy()).all()
    assert (got["cum_b"].to_numpy() == got["b"].cumsum().to_numpy()).all()


def test_roc_drop_intermediate_known_answer(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5)], "y int, s double")
    th = sorted((r["threshold"] for r in curves.roc_curve(df, "y", "s").collect()), reverse=True)
    assert th == [float("inf"), 0.9, 0.7, 0.5]


def test_roc_drop_intermediate_matches_numpy_rule_across_buckets(spark):
    rng = np.random.default_rng(5)
    n = 3000
    scores = rng.permutation(n).astype(float)
    # long runs of one label make many collinear points
    y = (np.repeat(rng.integers(0, 2, n // 30), 30)).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, scores)], "y int, s double")
    got = sorted((r["threshold"] for r in curves.roc_curve(df, "y", "s").collect()), reverse=True)
    order = np.argsort(-scores)
    tps, fps = np.cumsum(y[order]), np.cumsum(1 - y[order])
    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    want = [float("inf")] + list(scores[order][keep])
    assert got == want and len(want) < n / 2


def test_broadcast_path_equals_blocked_path(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).round(1).tolist(), int(rng.integers(0, 4))) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y int")
    tr, te = df.where("id % 3 != 0"), df.where("id % 3 = 0")
    for p in (1, 2):
        a = sorted(tuple(r) for r in knn.neighbors(tr, te, "id", "x", "y", 6, p=p).collect())
        b = sorted(tuple(r) for r in knn.neighbors(tr, te, "id", "x", "y", 6, p=p, block_rows=64,
                                                    broadcast_bytes=0).collect())
        assert a == b and len(a) == 200 * 6


def test_in_task_predict_equals_blocked_vote(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(0, 4, size=3).astype(float).tolist(), str(rng.integers(0, 3)), float(rng.normal()))
            for i in range(500)]
    df = spark.createDataFrame(rows, "id long, x array<double>, c string, r double")
    tr, te = df.where("id % 4 != 0"), df.where("id % 4 = 0")
    for task, targets in (("classification", ["c"]), ("regression", ["r"])):
        for w in ("uniform", "distance"):
            a = knn.predict(tr, te, "id", "x", targets, task, k=5, weights=w).select("id", f"pred_{targets[0]}")
            b = knn.predict(tr, te, "id", "x", targets, task, k=5, weights=w, broadcast_bytes=0,
                            block_rows=32).select("id", f"pred_{targets[0]}")
            ra = {r[0]: r[1] for r in a.collect()}
            rb = {r[0]: r[1] for r in b.collect()}
            assert ra.keys() == rb.keys() and len(ra) == 125
            for key_ in ra:
                if task == "classification":
                    assert ra[key_] == rb[key_], (w, key_)
                else:
                    assert abs(ra[key_] - rb[key_]) < 1e-9, (w, key_)


def test_knn_probabilities_in_task_equal_blocked(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.integers(0, 3, size=2).astype(float).tolist(), str(rng.integers(0, 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x array<double>, c string")
    tr, te = df.where("id % 3 != 0"), df.where("id % 3 = 0")
    for w in ("uniform", "distance"):
        a = {r["id"]: r["proba_c"] for r in knn.predict(tr, te, "id", "x", ["c"], "classification", k=4,
                                                        weights=w, proba=True).collect()}
        b = {r["id"]: r["proba_c"] for r in knn.predict(tr, te, "id", "x", ["c"], "classification", k=4,
                                                        weights=w, proba=True, broadcast_bytes=0).collect()}
        assert a.keys() == b.keys() and len(a) == 100
        for key_ in a:
            assert np.allclose(a[key_], b[key_]) and abs(sum(a[key_]) - 1) < 1e-12


def test_screen_keeps_rounding_ties_at_large_norms(spark):
    # points far from the origin at (nearly) equal distances: the screened
    # kernel must agree with a full exact sort on (rounded distance, key)
    rng = np.random.default_rng(4)
    base = np.array([100.0, -50.0, 25.0])
    train = []
    for i in range(400):
        v = rng.normal(size=3)
        v = v / np.linalg.norm(v) * (1.0 + (i % 3) * 1e-10)  # distances 1, 1+1e-10, 1+2e-10
        train.append((i, (base + v).tolist(), 0))
    tr = spark.createDataFrame(train, "id long, x array<double>, y int")
    te = spark.createDataFrame([(10_000, base.tolist())], "id long, x array<double>")
    got = [r["nn_key"] for r in knn.neighbors(tr, te, "id", "x", "y", 7).orderBy("nn_rank").collect()]
    x = np.array([t[1] for t in train])
    d = np.round(np.sqrt(((x - base) ** 2).sum(1)), 9)
    want = [i for _, i in sorted(zip(d, range(400)))][:7]
    assert got == want


def test_split_argument_selects_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(rng.integers(0, 2)), float(rng.random()), bool(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, y int, s double, is_test boolean")
    a = curves.roc_auc(df, "y", "s", split="test").first()["auc"]
    b = curves.roc_auc(df.where("is_test"), "y", "s").first()["auc"]
    c = curves.roc_auc(df.where("not is_test"), "y", "s").first()["auc"]
    assert a == b and curves.roc_auc(df, "y", "s", split="train").first()["auc"] == c
    with pytest.raises(ValueError, match="split must be"):
        curves.roc_auc(df, "y", "s", split="valid")
