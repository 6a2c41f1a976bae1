"""Classes and labels beyond what the driver holds."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabml.functions import rank
from tabml.functions.rank import group_cutoffs, running_sums
from tabml.operators import split, target
from tabml.plans.train import train
from tabml.sources import store

CLASSES = 50_000


def order_of(key):
    return hashlib.md5(f"42:{key}".encode()).hexdigest()


@pytest.fixture(scope="module")
def many(spark):
    # two to three rows a class, and one class with a third of all
    rows = spark.range(120_000).select("id", F.concat(F.lit("c"), (F.col("id") % CLASSES).cast("string")).alias("y"))
    hot = spark.range(120_000, 180_000).select("id", F.lit("hot").alias("y"))
    return rows.unionAll(hot).repartition(6)


@pytest.fixture(scope="module")
def by_class():
    out = defaultdict(list)
    for i in range(180_000):
        out["hot" if i >= 120_000 else f"c{i % CLASSES}"].append(i)
    return {c: sorted(v, key=order_of) for c, v in out.items()}


def test_stratified_split_of_many_classes(many, by_class):
    got = {r["id"]: r["is_test"] for r in split.train_test_split(many, ["id"], 0.2, 42, stratify="y").collect()}
    quota = split.largest_remainder({c: len(v) for c, v in by_class.items()}, 180_000 - 36_000)
    assert sum(got.values()) == 36_000
    for c, ids in by_class.items():
        q = len(ids) - quota[c]
        assert [got[i] for i in ids] == [True] * q + [False] * (len(ids) - q)


def test_stratified_folds_of_many_classes(many, by_class):
    got = {r["id"]: r["fold"] for r in split.kfold(many, ["id"], 5, 42, stratify="y").collect()}
    sizes = split.stratified_fold_sizes({c: len(v) for c, v in by_class.items()}, 5)
    for c, ids in by_class.items():
        assert [got[i] for i in ids] == [f for f, s in enumerate(sizes[c]) for _ in range(s)]


def test_many_classes_raise_like_few(spark, monkeypatch):
    monkeypatch.setattr(rank, "_DRIVER_GROUPS", 2)
    df = spark.createDataFrame([(i, c) for i, c in enumerate("aabbccd")], "id long, y string")
    with pytest.raises(ValueError, match="fewer than 2"):
        split.train_test_split(df, ["id"], 0.3, stratify="y")
    with pytest.raises(ValueError, match="exceeds"):
        split.kfold(df, ["id"], 3, stratify="y")
    with pytest.raises(ValueError, match="nulls"):
        split.train_test_split(df.withColumn("y", F.when(F.col("y") != "d", F.col("y"))), ["id"], 0.3, stratify="y")


def test_large_groups_are_not_ranked_whole(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    wanted = df.groupBy("g").agg(F.count("*").alias("n")).withColumn("positions", F.array(F.lit(1), F.col("n")).cast("array<long>"))
    hashes = defaultdict(list)
    for r in df.collect():
        hashes[r.g].append(r.h)
    for leaf in (10_000, 2000, 100):
        got = {r.g: r["_at"] for r in group_cutoffs(df, "h", "g", wanted, leaf).collect()}
        assert got == {g: {1: min(v), len(v): max(v)} for g, v in hashes.items()}


def test_running_sums_over_range_partitions(spark):
    rows = [(chr(97 + i % 26) * (1 + i // 26), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(4)
    for parts in (1, 7, None):
        got = running_sums(df, [F.col("k").desc()], ["v"], parts, with_next=True).collect()
        acc, want, ordered = 0, {}, sorted(rows, reverse=True)
        for (k, v), nxt in zip(ordered, [*ordered[1:], (None, None)]):
            acc += v
            want[k] = (acc, nxt[1])
        assert {r.k: (r.cum_v, r.next_v) for r in got} == want


def test_labels_without_a_cap(many, by_class):
    maps = target.fit_label_map(many, "y")
    assert isinstance(maps["y"], target.LabelTable) and maps["y"].size == CLASSES + 1
    coded = target.encode_labels(many, maps, suffix="_code")
    names = {c: i for i, c in enumerate(sorted(by_class))}
    rows = coded.select("y", "y_code").distinct().collect()
    assert {r.y: r.y_code for r in rows} == names
    back = target.decode_labels(coded.withColumn("back", F.col("y_code")), maps, {"back": "y"})
    assert back.where("not (back <=> y)").isEmpty() and back.count() == 180_000 and back.columns == ["id", "y", "y_code", "back"]
    with pytest.raises(Exception, match="unseen label"):
        target.encode_labels(many.limit(5).withColumn("y", F.lit("other")), maps).collect()
    nulls = target.encode_labels(many.limit(5).withColumn("y", F.lit(None).cast("string")), maps)
    assert [r.y for r in nulls.collect()] == [None] * 5
    with pytest.raises(ValueError, match="read its table"):
        target.class_names(maps, "y")


def test_a_model_with_a_label_table_round_trips(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(target, "MAX_CLASSES", 3)
    monkeypatch.setattr(target.fit_label_map, "__defaults__", (3,))
    df = spark.createDataFrame([(i, float(i % 6), "abcdef"[i % 6]) for i in range(120)], "id long, x double, y string")
    res = train(df, "id", "y", ["x"], model="knn_classifier")
    assert isinstance(res.bundle.label_maps["y"], target.LabelTable)
    store.save_model(res.bundle, str(tmp_path / "m"))
    from tabml.operators import score
    out = score.predict(store.load_model(str(tmp_path / "m")), df.drop("y")).join(df, "id")
    assert Counter((r.y, r.pred_y) for r in out.collect()) == Counter({(c, c): 20 for c in "abcdef"})


def test_selection_of_many_columns_shares_its_scans(spark, monkeypatch):
    rng = np.random.default_rng(0)
    n = 4000
    x = {"normal": rng.normal(size=n), "heavy": np.exp(20 * rng.normal(size=n)), "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n)),
         "one": np.full(n, 3.5), "signs": rng.choice([-0.0, 0.0, 1e-300, -1e-300, np.inf, -np.inf], n)}
    pdf = pd.DataFrame(x)
    pdf.loc[::17, "normal"] = None
    df = spark.createDataFrame([tuple(None if pd.isna(v) else float(v) for v in r) for r in pdf.itertuples(index=False)],
                               ", ".join(f"{c} double" for c in x)).repartition(3)
    scans = []
    plain = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: scans.append(1) or plain(self, *a, **k))
    for cells, leaf, most in ((1_000_000, 500, 6), (64, 10, 18), (1_000_000, 0, 6)):
        scans.clear()
        need = {c: [0, 1, 1000, 1999, 3000, int(pdf[c].notna().sum()) - 1] for c in x}
        got = rank.select_ranks(df, need, {c: (pdf[c].min(), pdf[c].max()) for c in x}, cells, leaf)
        for c in x:
            v = np.sort(pdf[c].dropna().to_numpy())
            assert got[c] == {r: v[r] for r in need[c]}, c
        assert len(scans) <= most
    want = pdf.quantile([0.25, 0.5, 0.75])
    for leaf in (10, 1_000_000):
        got = rank.exact_quantiles_multi(df, ["normal", "heavy", "hot", "one"], [0.25, 0.5, 0.75], leaf_rows=leaf)
        assert all(np.allclose(got[c], want[c]) for c in got)
