"""Scale properties read from the physical plans (what the README claims)."""

from pyspark.sql import functions as F

from tabml.operators import knn, metrics, prep, split
from tabml.plans import fixtures as fx

SF = "/root/testdata/sf0.01"

def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str) -> int:
    return plan.count("FileScan parquet")


def test_split_is_map_only(spark):
    o = fx.table(spark, SF, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    s = split.train_test_split(o, ["o_orderkey"], 0.2, 42, stratify="o_orderstatus")
    plan = _plan(s)
    assert "Exchange" not in plan and _scans(plan) == 1
    f = split.kfold(o, ["o_orderkey"], 5, 42, stratify="o_orderstatus")
    assert "Exchange" not in _plan(f)


def test_preprocessing_transform_is_one_projection(spark):
    p = fx.fixture(spark, SF, fx.P1, "part")
    pm = prep.Preprocess(scaler="standard").fit(p, ["p_size", "p_retailprice", "p_type"])
    plan = _plan(pm.transform(p, keep=["p_partkey"]))
    assert "Exchange" not in plan and "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_bounded_knn_scoring_has_no_shuffle(spark):
    n = 4000
    train = spark.createDataFrame([(i, [float(i % 17), float(i % 5)], str(i % 3)) for i in range(300)],
                                  "id long, x array<double>, y string")
    par = spark.sparkContext.defaultParallelism
    test = (spark.range(0, n, 1, numPartitions=max(2, par))
                 .select(F.col("id"), F.array((F.col("id") % 19).cast("double"), (F.col("id") % 7).cast("double")).alias("x")))
    plan = _plan(knn.predict(train, test, "id", "x", ["y"], "classification", k=5))
    assert "Exchange" not in plan and "MapInPandas" in plan


def test_metrics_scan_input_once(spark):
    p8 = fx.fixture(spark, SF, fx.P8, "orders")
    # the pair counts are one scan, written; the grid around them reads the input no more
    assert _scans(_plan(metrics.pair_counts(p8, "y", "yhat"))) == 1
    assert "orders.parquet" not in _plan(metrics.confusion_matrix(p8, "y", "yhat"))
    assert _scans(_plan(metrics.classification_report(p8, "y", "yhat"))) == 1
    assert _scans(_plan(metrics.regression_scores(fx.fixture(spark, SF, fx.P9, "orders"), "y", "yhat"))) == 1


def test_pruning_reaches_the_scan(spark):
    li = fx.table(spark, SF, "lineitem")
    q = li.where(F.col("l_discount") > 0.05).select("l_orderkey", "l_discount")
    s = split.train_test_split(q, ["l_orderkey"], 0.2, 1)
    text = s._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)]" in text
    schema = [x for x in text.split("ReadSchema: ")[1:]]
    assert schema and all(x.startswith("struct<l_orderkey:bigint,l_discount:double>") for x in schema)


def test_many_groups_use_the_bounded_refinement(spark, monkeypatch):
    import tabml.functions.rank as rank
    from tabml.functions.hashing import order_hash
    monkeypatch.setattr(rank, "_DRIVER_ROWS", 500)  # forces totals-first, adaptive prefixes
    df = spark.range(0, 30000).withColumn("g", (F.col("id") % 60).cast("int"))
    h = df.withColumn("h", order_hash(3, ["id"]))
    order = rank.HashOrder(h, "h", "g", leaf_rows=50)
    assert not order._level1  # the one-scan level-1 table did not fit the bound
    req = {g: [1, 250, 500] for g in range(0, 60, 7)}
    cuts = order.cutoffs(req)
    pdf = h.toPandas().sort_values("h")
    for (g, pos), val in cuts.items():
        assert pdf[pdf.g == g].h.iloc[pos - 1] == val


def test_hot_class_split_and_histogram(spark):
    from tabml.operators import curves
    # class 'hot' holds 40% of the rows
    df = spark.range(0, 20000).withColumn(
        "c", F.when(F.col("id") % 5 < 2, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 97).cast("string"))))
    s = split.train_test_split(df, ["id"], 0.2, 5, stratify="c")
    counts = {r["c"]: (r["n"], r["t"]) for r in s.groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    quotas = split.largest_remainder({k: v[0] for k, v in counts.items()}, 20000 - 4000)
    assert all(counts[k][0] - quotas[k] == counts[k][1] for k in counts)
    assert sum(v[1] for v in counts.values()) == 4000
    h = curves.histogram(df.withColumn("v", (F.col("id") % 1000).cast("double")), "v", 10, by="c")
    hot = {r["bin"]: r["n"] for r in h.where("group = 'hot'").collect()}
    assert sum(hot.values()) == 8000 and len(hot) == 10
