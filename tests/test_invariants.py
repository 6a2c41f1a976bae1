"""Invariants for operators without an SQL oracle."""

import numpy as np
from pyspark.sql import functions as F

from tabml.operators import metrics, prep, split, svm, trees
from tabml.plans import catalog
from tabml.plans import fixtures as fx

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def test_tree_learns_planted_target_and_importances_sum_to_one(spark):
    pred = catalog.QUERIES["tree_classify"](spark, SF01)
    acc = pred.agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).first()[0]
    assert acc >= 0.95
    imp = catalog.QUERIES["feature_importance"](spark, SF01).toPandas()
    assert abs(imp["importance"].sum() - 1.0) < 1e-9
    assert list(imp["importance"]) == sorted(imp["importance"], reverse=True)


def test_tree_nodes_shape(spark):
    nodes = catalog.QUERIES["tree_nodes"](spark, SF01).toPandas()
    assert nodes["depth"].max() <= 3 and (nodes["depth"] == 0).sum() == 1


def test_linear_svc_learns_planted_target(spark):
    pred = catalog.QUERIES["svc_linear"](spark, SF01)
    acc = pred.agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).first()[0]
    assert acc >= 0.8


def test_platt_probability_monotone_in_score(spark):
    s = catalog._p6(spark, SF01)
    m = svm.SVC(kernel="linear", probability=True).fit(s.where(~F.col("is_test")), "y", "x", key="vec_id")
    dec = m.decision_function(s).select("vec_id", "decision")
    pr = m.predict(s).select("vec_id", F.col("probability")[1].alias("p"))
    pdf = dec.join(pr, "vec_id").toPandas().sort_values("decision")
    assert (np.diff(pdf["p"].to_numpy()) >= -1e-12).all()


def test_svr_recovers_planted_coefficients(spark):
    p2 = fx.fixture(spark, SF01, fx.P2, "part").withColumn(
        "x", F.array(F.col("p_size").cast("double"), F.col("p_retailprice"), (F.col("p_type") == "PROMO").cast("double")))
    r = svm.SVR(C=10.0, epsilon=0.1, kernel="linear").fit(p2, "y", "x")
    assert np.allclose(r.coef_[:2], [2.0, 0.5], atol=0.01)


def test_pca_components_orthonormal(spark):
    li = fx.table(spark, SF, "lineitem")
    pm = prep.Preprocess(scaler="standard", pca=3).fit(li, catalog._COV_COLS)
    c = np.array(pm.pca_components)
    assert np.allclose(c @ c.T, np.eye(3), atol=1e-9)
    assert sum(pm.pca_variance) <= len(catalog._COV_COLS) + 1e-6
    for row in c:
        assert row[np.argmax(np.abs(row))] > 0


def test_save_load_identical_predictions(spark):
    r = catalog.QUERIES["save_load_roundtrip"](spark, SF).first()
    assert r["mismatches"] == 0 and r["n"] > 0


def test_class_weights_balance(spark):
    w = catalog.QUERIES["class_weights"](spark, SF).toPandas()
    assert abs((w["weight"] * w["n_class"]).sum() - w["n_class"].sum()) < 1e-3


def test_kfold_fold_sizes_follow_library_allocation(spark):
    o = fx.table(spark, SF, "orders").select("o_orderkey", "o_orderstatus")
    got = split.kfold(o, ["o_orderkey"], 5, 42, stratify="o_orderstatus").groupBy("o_orderstatus", "fold").count()
    counts = {r[0]: r[1] for r in o.groupBy("o_orderstatus").count().collect()}
    want = split.stratified_fold_sizes(counts, 5)
    for r in got.collect():
        assert want[r["o_orderstatus"]][r["fold"]] == r["count"]


def test_cv_report_ranks(spark):
    rep = catalog.QUERIES["cv_tree"](spark, SF).toPandas()
    best = rep[rep["rank_test_score"] == 1]["mean_test_score"].max()
    assert best == rep["mean_test_score"].max()


def test_metrics_match_mllib_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    p8 = fx.fixture(spark, SF, fx.P8, "orders")
    codes = {"F": 0.0, "O": 1.0, "P": 2.0}
    m = F.create_map(*sum(([F.lit(k), F.lit(v)] for k, v in codes.items()), []))
    num = p8.select(F.element_at(m, F.col("y")).alias("label"), F.element_at(m, F.col("yhat")).alias("prediction"))
    ev = MulticlassClassificationEvaluator(metricName="f1").evaluate(num)
    ours = metrics.classification_scores(p8, "y", "yhat").first()["f1_weighted"]
    assert abs(ev - ours) < 1e-12


def test_min_samples_split_prunes_small_internal_nodes(spark):
    import uuid
    from tabml.session import checkpoint_dir
    p = fx.fixture(spark, SF01, fx.P1, "part").select(
        F.array(F.col("p_size").cast("double"), "p_retailprice").alias("features"), "y")
    full = trees.TreeModel("tree", "classification", max_depth=8).fit(p, "y")
    pr = trees.TreeModel("tree", "classification", max_depth=8, min_samples_split=200).fit(p, "y")
    nodes = trees.tree_nodes(pr.model, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}", 0, None).toPandas()
    assert ((nodes["left"].notna()) & (nodes["count"] < 200)).sum() == 0
    assert pr.model.numNodes < full.model.numNodes
    # the pruned tree = the full tree walked from the root, stopping at nodes with < 200 rows
    full_nodes = trees.tree_nodes(full.model, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}", 0, None).toPandas()
    by_id = full_nodes.set_index("id")
    kept, stack = [], [int(full_nodes.loc[full_nodes["depth"] == 0, "id"].iloc[0])]
    while stack:
        n = by_id.loc[stack.pop()]
        kept.append((int(n["depth"]), int(n["count"]), float(n["prediction"])))
        if n["left"] == n["left"] and n["count"] >= 200:  # internal and large enough to split
            stack += [int(n["left"]), int(n["right"])]
    got = sorted((int(r.depth), int(r["count"]), float(r.prediction)) for _, r in nodes.iterrows())
    assert got == sorted(kept)
    two = trees.TreeModel("tree", "classification", max_depth=8, min_samples_split=2).fit(p, "y")
    assert two.model.numNodes == full.model.numNodes


def test_transform_stream_with_tree_bundle(spark):
    import uuid
    from tabml.operators import score
    from tabml.plans.train import train
    from tabml.session import checkpoint_dir
    from tabml.streaming.score import transform_stream
    p = fx.fixture(spark, SF, fx.P1, "part")
    r = train(p, "p_partkey", "y", ["p_size", "p_retailprice", "p_type"], "tree_classifier", max_depth=3)
    part = fx.table(spark, SF, "part")
    stream = spark.readStream.schema(part.schema).option("pathGlobFilter", "part.parquet").parquet(SF)
    name = f"s{uuid.uuid4().hex[:8]}"
    q = (transform_stream(r.bundle, stream).writeStream.format("memory").queryName(name)
         .option("checkpointLocation", f"{checkpoint_dir(spark)}/{name}").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {row["p_partkey"]: row["pred_y"] for row in spark.sql(f"SELECT * FROM {name}").collect()}
    want = {row["p_partkey"]: row["pred_y"] for row in score.predict(r.bundle, part).collect()}
    assert got == want and len(got) == part.count()


def test_knn_grid_search_regression(spark):
    from tabml.operators import tuning
    p = fx.fixture(spark, SF, fx.P2, "part").withColumn(
        "x", F.array(F.col("p_size").cast("double"), F.col("p_retailprice")))
    rep = tuning.knn_grid_search(p, "p_partkey", "x", "y", "regression", folds=3, seed=1,
                                 grid={"scaler": ["standard", None], "n_neighbors": [1, 5], "weights": ["uniform"],
                                       "p": [2], "algorithm": ["auto"]}).toPandas()
    assert len(rep) == 4 and rep["mean_test_score"].notna().all()
    assert rep.loc[rep["rank_test_score"] == 1, "mean_test_score"].iloc[0] == rep["mean_test_score"].max()


def test_pca_matches_numpy_svd(spark):
    li = fx.table(spark, SF, "lineitem").select(*catalog._COV_COLS, "l_orderkey", "l_linenumber", "l_partkey")
    pm = prep.Preprocess(scaler="standard", pca=2).fit(li, catalog._COV_COLS)
    pdf = li.toPandas()
    x = pdf[catalog._COV_COLS].to_numpy(dtype=float)
    z = (x - x.mean(0)) / x.std(0)
    zc = z - z.mean(0)
    _, sv, vt = np.linalg.svd(zc, full_matrices=False)
    for i in range(2):
        if vt[i][np.argmax(np.abs(vt[i]))] < 0:
            vt[i] = -vt[i]
    assert np.allclose(np.array(pm.pca_components), vt[:2], atol=1e-8)
    assert np.allclose(pm.pca_variance, (sv[:2] ** 2) / (len(z) - 1), rtol=1e-8)
    got = pm.transform(li, keep=["l_orderkey", "l_linenumber", "l_partkey"]).toPandas()
    mine = np.round(np.stack(got["features"].to_numpy()), 8)
    want = np.round(zc @ vt[:2].T, 8)
    # compare as multisets of rows (lineitem has no unique key among these columns)
    mine = mine[np.lexsort(mine.T[::-1])]
    want = want[np.lexsort(want.T[::-1])]
    assert np.allclose(mine, want, atol=1e-7)


def test_linear_svc_solves_the_library_objective(spark):
    s = catalog._p6(spark, SF01).where(~F.col("is_test"))
    C = 1.0
    m = svm.SVC(C=C, kernel="linear", tol=1e-6, max_iter=500).fit(s, "y", "x")
    pdf = s.toPandas()
    x = np.stack(pdf["x"].to_numpy())
    y = np.where(pdf["y"] == m.classes_[1], 1.0, -1.0)
    w, b = m.model_.coefficients.toArray(), m.model_.intercept

    def obj(w, b):
        return 0.5 * w @ w + C * np.maximum(0.0, 1 - y * (x @ w + b)).sum()

    # plain subgradient descent on the same objective, from zero
    wn, bn, best = np.zeros(x.shape[1]), 0.0, np.inf
    for t in range(1, 20001):
        act = y * (x @ wn + bn) < 1
        gw = wn - C * (y[act, None] * x[act]).sum(0)
        gb = -C * y[act].sum()
        eta = 0.5 / (t ** 0.5 * len(y))
        wn, bn = wn - eta * gw, bn - eta * gb
        best = min(best, obj(wn, bn))
    assert obj(w, b) <= best * 1.01


def test_one_vs_one_svc_votes_and_round_trip(spark):
    import uuid
    from tabml.operators import score
    from tabml.plans.train import train
    from tabml.session import checkpoint_dir
    from tabml.sources import store
    p = fx.fixture(spark, SF01, fx.P1, "part")
    r = train(p, "p_partkey", "y", ["p_size", "p_retailprice", "p_type"], "svm_classifier", kernel="linear",
              C=10.0, scaler="standard", max_iter=50)
    m = r.bundle.models["y"]
    assert isinstance(m.model_, list) and m.pairs_ == [(0, 1), (0, 2), (1, 2)]
    acc = r.evaluation.where("split = 'test' AND metric = 'accuracy'").first()["value"]
    assert acc >= 0.95
    # the vote rule re-derived with NumPy from the fitted pair machines
    x = r.bundle.prep.transform(p, keep=["p_partkey"]).toPandas()
    feats = np.stack(x["features"].to_numpy())
    votes = np.zeros((len(x), 3))
    for (i, j), pm in zip(m.pairs_, m.model_):
        d = feats @ pm.coefficients.toArray() + pm.intercept
        votes[:, i] += d > 0
        votes[:, j] += d <= 0
    want = dict(zip(x["p_partkey"], np.argmax(votes, axis=1)))
    got = {row["p_partkey"]: row["pred_y"] for row in r.predictions.select("p_partkey", "pred_y").collect()}
    assert all(got[k] == want[k] for k in got)
    path = f"{checkpoint_dir(spark)}/ovo-{uuid.uuid4().hex}"
    store.save_model(r.bundle, path)
    b = store.load_model(path)
    a1 = {row["p_partkey"]: row["pred_y"] for row in score.predict(r.bundle, p).collect()}
    a2 = {row["p_partkey"]: row["pred_y"] for row in score.predict(b, p).collect()}
    assert a1 == a2


def test_transform_stream_with_knn_bundle(spark):
    import uuid
    from tabml.operators import score
    from tabml.plans.train import train
    from tabml.session import checkpoint_dir
    from tabml.streaming.score import transform_stream
    p = fx.fixture(spark, SF, fx.P1, "part")
    r = train(p, "p_partkey", "y", ["p_size", "p_retailprice", "p_type"], "knn_classifier", scaler="standard")
    part = fx.table(spark, SF, "part")
    stream = spark.readStream.schema(part.schema).option("pathGlobFilter", "part.parquet").parquet(SF)
    name = f"k{uuid.uuid4().hex[:8]}"
    q = (transform_stream(r.bundle, stream).writeStream.format("memory").queryName(name)
         .option("checkpointLocation", f"{checkpoint_dir(spark)}/{name}").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {row["p_partkey"]: row["pred_y"] for row in spark.sql(f"SELECT * FROM {name}").collect()}
    want = {row["p_partkey"]: row["pred_y"] for row in score.predict(r.bundle, part).collect()}
    assert got == want and len(got) == part.count()


def test_tree_bundle_probabilities(spark):
    from tabml.operators import score
    from tabml.plans.train import train
    p = fx.fixture(spark, SF, fx.P1, "part")
    r = train(p, "p_partkey", "y", ["p_size", "p_retailprice", "p_type"], "forest_classifier",
              max_depth=4, n_estimators=10)
    pdf = score.predict(r.bundle, p, proba=True).toPandas()
    probs = np.stack(pdf["proba_y"].to_numpy())
    assert probs.shape[1] == 3 and np.allclose(probs.sum(1), 1.0)
    classes = r.bundle.label_maps["y"]
    assert (np.array(classes)[probs.argmax(1)] == pdf["pred_y"].to_numpy()).mean() > 0.99


def test_knn_grid_search_with_pca_matches_a_manual_fold_loop(spark):
    from tabml.operators import knn, tuning
    from tabml.operators.split import kfold
    e = fx.table(spark, SF, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    grid = {"scaler": ["standard"], "pca": [3], "n_neighbors": [5], "weights": ["uniform"], "p": [2],
            "algorithm": ["auto"]}
    rep = tuning.knn_grid_search(e, "vec_id", "x", "label", "classification", folds=3, seed=7, grid=grid,
                                 scoring="accuracy").first()
    f = kfold(e, ["vec_id"], 3, 7, stratify="label")
    scores = []
    for g in range(3):
        tr, va = f.where(F.col("fold") != g), f.where(F.col("fold") == g)
        pm = prep.Preprocess(scaler="standard", pca=3).fit(tr, ["x"])
        xtr, xva = pm.transform(tr, keep=["vec_id", "label"]), pm.transform(va, keep=["vec_id", "label"])
        pred = knn.vote(knn.neighbors(xtr, xva, "vec_id", "features", "label", 5), "vec_id", 5)
        scores.append(pred.join(va, "vec_id").agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0])
    assert abs(rep["mean_test_score"] - float(np.mean(scores))) < 1e-9 and rep["pca"] == 3


def test_multi_target_search_does_not_depend_on_the_order_of_targets(spark):
    from tabml.plans.train import train
    rows = [(i, float(i % 37), None if i % 9 == 0 else "ab"[i % 2], "x" if i % 37 < 18 else "y", int(i % 2)) for i in range(240)]
    df = spark.createDataFrame(rows, "k long, a double, c string, y1 string, y2 int")
    grid = {"scaler": ["standard"], "n_neighbors": [3, 5], "weights": ["uniform"], "p": [2], "algorithm": ["auto"]}
    scores = []
    for targets in (["y1", "y2"], ["y2", "y1"]):
        res = train(df, "k", targets, ["a", "c"], "knn_classifier", use_cv=True, grid=grid, folds=3)
        scores.append(sorted((r.n_neighbors, round(r.mean_test_score, 9)) for r in res.cv_report.collect()))
    assert scores[0] == scores[1]


def test_repeated_scoring_keys_get_their_own_neighbours_in_both_plans(spark):
    from tabml.operators import knn
    tr = spark.createDataFrame([(i, [float(i)], "a" if i < 5 else "b") for i in range(10)], "k long, x array<double>, y string")
    te = spark.createDataFrame([(1, [0.0]), (1, [9.0]), (1, [9.0]), (2, [4.0])], "k long, x array<double>")
    plans = [sorted((r.k, r.x[0], r.pred_y) for r in knn.predict(tr, te, "k", "x", ["y"], "classification", k=1, broadcast_bytes=b).collect())
             for b in (1 << 20, 0)]
    assert plans[0] == plans[1] == [(1, 0.0, "a"), (1, 9.0, "b"), (1, 9.0, "b"), (2, 4.0, "a")]


def test_regression_tree_counts_rows_not_labels(spark, monkeypatch):
    from tabml.operators import trees
    seen = []
    monkeypatch.setattr(trees, "spread", lambda df, rows: seen.append(rows) or df)
    df = spark.range(30000).selectExpr("cast(id as double) as y", "array(cast(id as double)) as features")
    trees.TreeModel("tree", "regression", max_depth=2).fit(df, "y")
    assert seen == [30000]


def test_rejected_candidates_keep_their_message(spark):
    from tabml.operators import trees, tuning
    df = spark.range(60).selectExpr("id", "cast(id % 7 as double) as a", "cast(id as double) as y")
    rep = tuning.fold_grid_search(df, "id", ["a"], "y", lambda **p: trees.TreeModel("tree", "regression", **p),
                                  {"criterion": ["squared_error", "absolute_error"]}, "regression", folds=2)
    errors = {("absolute_error" in r.params): r.error for r in rep.collect()}
    assert errors[False] is None and "absolute_error" in errors[True]


def test_stratified_split_and_folds_with_many_classes(spark):
    from tabml.operators import split
    df = spark.range(60000).selectExpr("id", "concat('c', id % 20000) as y")
    s = split.train_test_split(df, ["id"], 0.34, 1, stratify="y")
    assert s.where("is_test").count() == 20400 and s.columns == ["id", "y", "is_test"]
    per = s.groupBy("y").agg(F.sum(F.col("is_test").cast("int")).alias("n")).groupBy("n").count().collect()
    assert {r.n for r in per} == {1, 2}
    f = split.kfold(df, ["id"], 3, 1, stratify="y").groupBy("y").agg(F.countDistinct("fold").alias("k")).groupBy("k").count().collect()
    assert [(r.k, r["count"]) for r in f] == [(3, 20000)]


def test_refinement_ends_on_repeated_keys(spark):
    from tabml.functions.rank import HashOrder
    df = spark.createDataFrame([(k,) for k in [1, 2] * 30], "k long").selectExpr("md5(cast(k as string)) as h")
    low, high = sorted(r.h for r in df.distinct().collect())
    cuts = HashOrder(df, "h", leaf_rows=5).cutoffs({0: [10, 40]})
    assert cuts == {(0, 10): low, (0, 40): high}


def test_histogram_by_class_leaves_rows_in_place(spark):
    from tabml.operators import curves
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).selectExpr("cast(id % 3 as string) as y", "cast(id as double) as s")
        out = curves.histogram(df, "s", 10, by="y")
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert out.agg(F.sum("n")).first()[0] == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_svm_insight_of_three_classes_and_decision_preview(spark):
    rows = [(i, [float(i % 3) + (i % 7) * 0.2, float(i % 5) * 0.1], "abc"[i % 3]) for i in range(210)]  # neighbours overlap
    df = spark.createDataFrame(rows, "id long, x array<double>, y string")
    m = svm.SVC(kernel="linear").fit(df, "y", "x")
    assert m.converged_ and len(m.iterations_) == 3 and max(m.iterations_) < 1000
    info = {r.label: r for r in svm.svm_insight(m, df, "id", n_ids=5).collect()}
    assert set(info) == {"a", "b", "c"} and all(r.n_machines == 2 and len(r.intercepts) == 2 for r in info.values())
    assert all(5 < r.n_support <= 70 and r.first_support_ids == sorted(r.first_support_ids) for r in info.values())
    pre = svm.decision_preview(m, df, "id", 4).collect()
    assert [r.id for r in pre] == [0, 1, 2, 3] and all(r.prediction in "abc" and len(r.decision) == r.n_scores == 3 for r in pre)


def test_node_view_and_model_list_grow_the_default_forest(spark, monkeypatch):
    grown = []
    with monkeypatch.context() as m:
        m.setattr(catalog.trees, "tree_nodes", lambda model, *a, **k: grown.append(model.getNumTrees))
        catalog.QUERIES["tree_nodes"](spark, SF)
    real = catalog.train_entry
    with monkeypatch.context() as m:
        m.setattr(catalog, "train_entry", lambda *a, **k: grown.append(k.get("n_estimators", 100)) or real(*a, **k))
        catalog.QUERIES["list_models"](spark, SF)
    assert grown == [100, 100, 100]
