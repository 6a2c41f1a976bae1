"""Decision trees and random forests on MLlib.

MLlib grows trees level by level with one distributed aggregation of split
statistics per level, which is the Spark-native way to grow a tree over a
table of any size.  This module maps the reference's parameters onto it:

* ``criterion``: gini / entropy / log_loss (= entropy) for classifiers,
  squared_error (= variance) / friedman_mse (variance; a notice) /
  absolute_error (not available: error) for regressors;
* ``max_depth`` None -> 30, the MLlib maximum (larger values are rejected);
* ``min_samples_leaf`` -> ``minInstancesPerNode``;
* ``min_samples_split`` (no MLlib parameter): the tree is grown, its saved
  node table is read as a DataFrame, every internal node with fewer than
  ``min_samples_split`` training rows becomes a leaf (it already stores its
  own prediction), and the pruned table is loaded back with MLlib's loader.
  Growth is greedy and top-down, so this equals stopping early;
* ``n_estimators`` -> ``numTrees``; forests sample ``sqrt`` features for
  classification and all features for regression (the library defaults);
* ``class_weight="balanced"`` -> a weight column n / (k * n_class).

Split candidates are the midpoints of consecutive distinct values as long as
a feature has fewer distinct values than ``max_bins``; beyond that MLlib uses
quantile bins, so trees are not promised to equal another library's trees.
"""

from __future__ import annotations

import warnings

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.operators.target import MAX_CLASSES

from tabml.session import active_spark, at_most, spread

MAX_DEPTH = 30
#: what MLlib keeps of a task's rows between the levels, about
TASK_BYTES = 256 * 1024 * 1024
#: trees deeper than this look up a row's node in a kept array instead of walking down from the root
WALK_DEPTH = 10


def _depth(max_depth):
    if max_depth is None:
        return MAX_DEPTH
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth {max_depth} exceeds the supported maximum {MAX_DEPTH}")
    return int(max_depth)


def _impurity(criterion: str, task: str) -> str:
    c = (criterion or "").lower()
    if task == "classification":
        if c in ("gini",):
            return "gini"
        if c in ("entropy", "log_loss"):
            return "entropy"
        raise ValueError("criterion must be gini, entropy or log_loss")
    if c in ("squared_error", "mse", "variance"):
        return "variance"
    if c == "friedman_mse":
        warnings.warn("friedman_mse is grown with the variance criterion", stacklevel=3)
        return "variance"
    if c == "absolute_error":
        raise ValueError("absolute_error trees are not available; use squared_error")
    raise ValueError("criterion must be squared_error, friedman_mse or absolute_error")


def _check_split(min_samples_split):
    if min_samples_split is not None and int(min_samples_split) < 2:
        raise ValueError("min_samples_split must be at least 2")


def _renumber(nodes: dict, s: int) -> list:
    """Pre-order walk from node 0: nodes with rawCount < s become leaves; new
    ids are pre-order positions (MLlib's layout: children after parents)."""
    out, stack, new_id = [], [(0, None, None)], {}
    order = []
    while stack:
        nid, parent, side = stack.pop()
        n = dict(nodes[nid])
        order.append((nid, parent, side))
        new_id[nid] = len(order) - 1
        leaf = n["leftChild"] < 0 or n["rawCount"] < s
        if not leaf:
            stack.append((n["rightChild"], nid, "r"))
            stack.append((n["leftChild"], nid, "l"))
    rows = {}
    for nid, parent, side in order:
        n = dict(nodes[nid])
        if n["leftChild"] >= 0 and n["rawCount"] < s:
            n["leftChild"], n["rightChild"], n["gain"] = -1, -1, -1.0
            n["split"] = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        n["id"] = new_id[nid]
        rows[nid] = n
    for nid, n in rows.items():
        if n["leftChild"] >= 0:
            n["leftChild"], n["rightChild"] = new_id[n["leftChild"]], new_id[n["rightChild"]]
        out.append(n)
    return sorted(out, key=lambda r: r["id"])


def prune_min_samples_split(model, min_samples_split: int, path: str):
    """Post-prune a fitted MLlib tree or forest to ``min_samples_split``."""
    spark = active_spark()
    model.write().overwrite().save(f"{path}/grown")
    data = spark.read.parquet(f"{path}/grown/data")
    forest = "treeID" in data.columns
    # the node table is model-sized; MLlib's own loader collects it the same way
    rows = [r.asDict(recursive=True) for r in data.collect()]
    if forest:
        by_tree: dict = {}
        for r in rows:
            by_tree.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
        new = [{"treeID": t, "nodeData": n} for t, nodes in by_tree.items()
               for n in _renumber(nodes, min_samples_split)]
    else:
        new = _renumber({r["id"]: r for r in rows}, min_samples_split)
    out = f"{path}/pruned"
    spark.createDataFrame(new, schema=data.schema).write.mode("overwrite").parquet(f"{out}/data")
    spark.read.text(f"{path}/grown/metadata").write.mode("overwrite").text(f"{out}/metadata")
    if forest:
        spark.read.parquet(f"{path}/grown/treesMetadata").write.mode("overwrite").parquet(f"{out}/treesMetadata")
    return type(model).load(out)


def balanced_weights(df: DataFrame, label: str, out_col: str = "_weight") -> DataFrame:
    """Adds ``n / (k * n_class)``; the class counts are a bounded broadcast."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k")).first()
    w = counts.select(label, (F.lit(float(tot["n"])) / (F.lit(float(tot["k"])) * F.col("_nc"))).alias(out_col))
    return df.join(F.broadcast(w), label)


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    tot = counts.agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k")).first()
    return counts.select(label, "n_class",
                         (F.lit(float(tot["n"])) / (F.lit(float(tot["k"])) * F.col("n_class"))).alias("weight"))


def _vec(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn("_vec", array_to_vector(F.col(features).cast("array<double>")))


def make_estimator(kind: str, task: str, *, criterion=None, max_depth=None, min_samples_split=2,
                   min_samples_leaf=1, n_estimators=100, random_state=42, max_bins=32,
                   weight_col=None, label="label", prediction="prediction"):
    _check_split(min_samples_split)
    # 1 GB of split statistics per pass (fewer passes per level) and, for deep
    # trees, cached node ids (no re-walk of the trees, but an id per row and tree)
    depth = _depth(max_depth)
    common = dict(featuresCol="_vec", labelCol=label, predictionCol=prediction,
                  maxDepth=depth, minInstancesPerNode=int(min_samples_leaf),
                  maxBins=int(max_bins), seed=int(random_state), maxMemoryInMB=1024, cacheNodeIds=depth > WALK_DEPTH)
    if task == "classification":
        common["impurity"] = _impurity(criterion or "gini", task)
        if weight_col:
            common["weightCol"] = weight_col
        if kind == "tree":
            return DecisionTreeClassifier(**common)
        return RandomForestClassifier(numTrees=int(n_estimators), featureSubsetStrategy="sqrt", **common)
    common["impurity"] = _impurity(criterion or "squared_error", task)
    if kind == "tree":
        return DecisionTreeRegressor(**common)
    return RandomForestRegressor(numTrees=int(n_estimators), featureSubsetStrategy="all", **common)


class TreeModel:
    """Fit/predict wrapper over an array feature column."""

    def __init__(self, kind: str = "tree", task: str = "classification", class_weight: str | None = None,
                 **params):
        if kind not in ("tree", "forest"):
            raise ValueError("kind must be 'tree' or 'forest'")
        self.kind, self.task, self.class_weight, self.params = kind, task, class_weight, params
        self.model = None

    def fit(self, df: DataFrame, label: str, features: str = "features") -> "TreeModel":
        # the class list, the split sample and the binning all read the input: persist it once
        base = df.select(label, features).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # one pass: the row count, for classifiers per class
            if self.task == "classification":
                counts = base.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
                rows = sum(r["count"] for r in counts)
            else:
                counts, rows = [], base.count()
            first = base.select(F.size(features)).first()
            data = at_most(spread(base, rows=rows), rows, TASK_BYTES // self._row_bytes(first[0] if first else 0))
            return self._fit(data, label, features, counts)
        finally:
            base.unpersist()

    def _row_bytes(self, dim: int) -> int:
        """What MLlib keeps of a row while it grows the trees, about: the bins of the
        features and, per tree, how often the row was drawn and (deep trees) its node."""
        trees = int(self.params.get("n_estimators", 100)) if self.kind == "forest" else 1
        deep = _depth(self.params.get("max_depth")) > WALK_DEPTH
        return 128 + 4 * max(dim, 0) + 4 * trees * (2 if deep else 1)

    def _fit(self, df: DataFrame, label: str, features: str, counts: list) -> "TreeModel":
        data = _vec(df, features)
        self.label = label
        self.classes_ = None
        if self.task == "classification":
            # classes as 0..k-1 in sorted order (bounded list); decoded again in predict
            if len(counts) > MAX_CLASSES:
                raise ValueError(f"more than {MAX_CLASSES} classes in {label!r}: not a classification target")
            self.classes_ = sorted(r[label] for r in counts)
            items = sum(([F.lit(c), F.lit(float(i))] for i, c in enumerate(self.classes_)), [])
            data = data.withColumn("_label", F.element_at(F.create_map(*items), F.col(label)))
            label = "_label"
        wc = None
        if self.class_weight == "balanced":
            if self.task != "classification":
                raise ValueError("class_weight is for classifiers")
            data, wc = balanced_weights(data, label), "_weight"
        elif self.class_weight not in (None, "none"):
            raise ValueError("class_weight must be None or 'balanced'")
        est = make_estimator(self.kind, self.task, weight_col=wc, label=label, **self.params)
        self.model = est.fit(data)
        mss = self.params.get("min_samples_split")
        if mss is not None and int(mss) > 2:
            import uuid
            from tabml.session import checkpoint_dir
            self.model = prune_min_samples_split(self.model, int(mss),
                                                 f"{checkpoint_dir(df.sparkSession)}/prune-{uuid.uuid4().hex}")
        return self

    def predict(self, df: DataFrame, features: str = "features", out_col: str = "prediction",
                keep_proba: bool = False) -> DataFrame:
        out = self.model.transform(_vec(df, features))
        pred = F.col("prediction")
        if getattr(self, "classes_", None) is not None:
            pred = F.element_at(F.array(*[F.lit(c) for c in self.classes_]), pred.cast("int") + 1)
        cols = [c for c in df.columns] + [pred.alias(out_col)]
        if keep_proba and "probability" in out.columns:
            from pyspark.ml.functions import vector_to_array
            cols.append(vector_to_array("probability").alias("probability"))
        return out.select(*cols)


def feature_importance(models, names: list[str]) -> DataFrame:
    """``(feature, importance, importance_ratio)`` sorted descending; with several
    models (one per target) the importances are averaged."""
    models = models if isinstance(models, (list, tuple)) else [models]
    imp = [0.0] * len(names)
    for m in models:
        v = m.featureImportances.toArray()
        for i in range(len(names)):
            imp[i] += float(v[i]) / len(models)
    spark = active_spark()
    df = spark.createDataFrame([(n, v) for n, v in zip(names, imp)], "feature string, importance double")
    return df.select("feature", "importance", (F.col("importance") * 100).alias("importance_ratio")) \
        .orderBy(F.desc("importance"), "feature")


def tree_nodes(model, path: str, tree_index: int = 0, max_depth: int | None = 3) -> DataFrame:
    """Nodes of one tree down to ``max_depth`` from the model's saved node table:
    ``(depth, id, prediction, impurity, gain, count, feature, threshold, left, right)``.
    Depths come from level-by-level joins of the node table (at most 30)."""
    spark = active_spark()
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" in data.columns:
        n_trees = data.select("treeID").distinct().count()
        if not 0 <= tree_index < n_trees:
            raise ValueError(f"tree_index {tree_index} outside 0..{n_trees - 1}")
        data = data.where(F.col("treeID") == tree_index).select("nodeData.*")
    elif tree_index != 0:
        raise ValueError("a single tree has only tree_index 0")
    nodes = data.select("id", "prediction", "impurity", "gain", "rawCount", "leftChild", "rightChild",
                        F.col("split.featureIndex").alias("feature"),
                        F.col("split.leftCategoriesOrThreshold")[0].alias("threshold"))
    level = nodes.where(F.col("id") == nodes.agg(F.min("id")).first()[0]).withColumn("depth", F.lit(0))
    out = level
    limit = MAX_DEPTH if max_depth is None else max_depth
    for d in range(1, limit + 1):
        kids = level.select(F.explode(F.array("leftChild", "rightChild")).alias("id")).where(F.col("id") >= 0)
        level = nodes.join(kids, "id", "left_semi").withColumn("depth", F.lit(d))
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out.select("depth", "id", "prediction", "impurity", "gain", F.col("rawCount").alias("count"),
                      F.when(F.col("leftChild") >= 0, F.col("feature")).alias("feature"),
                      F.when(F.col("leftChild") >= 0, F.col("threshold")).alias("threshold"),
                      F.when(F.col("leftChild") >= 0, F.col("leftChild")).alias("left"),
                      F.when(F.col("leftChild") >= 0, F.col("rightChild")).alias("right"))
