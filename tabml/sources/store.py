"""Model store and report sinks, all through Spark writers (so the folder may
be any shared file system the cluster can reach).

A saved bundle is a folder with ``meta`` (one JSON row: model name, key,
targets, raw feature names, preprocessing, label maps, parameters, custom
model state, save time), one MLlib model folder per target for trees and
linear SVMs, and ``train`` (parquet) for KNN, whose model is its training
rows.  Label maps are saved too (the reference does not save them).
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.session import active_spark

from tabml.operators.prep import PreprocessModel
from tabml.operators.target import LabelTable


def _svm_state(m) -> dict:
    st = {"kind": type(m).__name__, "params": {k: v for k, v in vars(m).items()
                                               if k in ("C", "kernel", "gamma", "degree", "coef0", "class_weight",
                                                        "tol", "max_iter", "probability", "n_landmarks", "seed",
                                                        "epsilon", "platt_cv", "multiclass", "loss", "landmark_tol")}}
    if getattr(m, "nys_", None) is not None:
        st["nys"] = {"gamma_": m.nys_.gamma_, "landmarks": m.nys_.landmarks_.tolist(), "norm": m.nys_.norm_.tolist()}
    if type(m).__name__ == "SVR":
        st["coef"], st["intercept"] = m.coef_.tolist(), m.intercept_
    else:
        st["classes"] = m.classes_
    st["label"], st["features"] = m.label, m.features
    return st


def save_model(bundle, path: str) -> None:
    spark = active_spark()
    models = {}
    for i, t in enumerate(bundle.targets):
        m = bundle.models.get(t)
        if m is None:
            continue
        if bundle.family in ("tree", "forest"):
            m.model.write().overwrite().save(f"{path}/model_{i}")
            models[t] = {"kind": "mllib", "task": m.task, "family": m.kind, "classes": m.classes_}
        else:
            st = _svm_state(m)
            if st["kind"] == "SVC" and isinstance(m.model_, list):
                for (a, b), pm in zip(m.pairs_, m.model_):
                    pm.write().overwrite().save(f"{path}/model_{i}_pair_{a}_{b}")
                st["pairs"] = [list(pr) for pr in m.pairs_]
            elif st["kind"] == "SVC":
                m.model_.write().overwrite().save(f"{path}/model_{i}")
            if st["kind"] == "SVC" and getattr(m, "platt_", None):
                st["platt"] = [list(x) for x in m.platt_]
            models[t] = st
    if bundle.family == "knn":
        bundle.knn_train.write.mode("overwrite").parquet(f"{path}/train")
    label_maps = dict(bundle.label_maps)
    for i, (t, labels) in enumerate(bundle.label_maps.items()):
        if isinstance(labels, LabelTable):
            labels.table.write.mode("overwrite").parquet(f"{path}/labels_{i}")
            label_maps[t] = {"table": f"labels_{i}", "size": labels.size}
    meta = {
        "model_name": bundle.model_name, "key": bundle.key, "targets": bundle.targets,
        "features": bundle.features, "prep": bundle.prep.to_json(), "label_maps": label_maps,
        "params": bundle.params, "models": models,
        "saved_at": dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
    }
    spark.createDataFrame([(json.dumps(meta, default=str), bundle.model_name, meta["saved_at"])],
                          "meta string, model_name string, saved_at string") \
        .coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_model(path: str):
    from pyspark.ml.classification import (DecisionTreeClassificationModel, LinearSVCModel, OneVsRestModel,
                                           RandomForestClassificationModel)
    from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressionModel
    import numpy as np

    from tabml.operators import svm, trees
    from tabml.plans.train import Bundle

    spark = active_spark()
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    label_maps = {t: LabelTable(spark.read.parquet(f"{path}/{x['table']}"), x["size"]) if isinstance(x, dict) else x
                  for t, x in meta["label_maps"].items()}
    b = Bundle(meta["model_name"], meta["key"], meta["targets"], meta["features"],
               PreprocessModel.from_json(meta["prep"]), label_maps, meta["params"])
    if b.family == "knn":
        b.knn_train = spark.read.parquet(f"{path}/train")
        return b
    for i, t in enumerate(b.targets):
        st = meta["models"][t]
        if st["kind"] == "mllib":
            cls = {("tree", "classification"): DecisionTreeClassificationModel,
                   ("forest", "classification"): RandomForestClassificationModel,
                   ("tree", "regression"): DecisionTreeRegressionModel,
                   ("forest", "regression"): RandomForestRegressionModel}[(st["family"], st["task"])]
            tm = trees.TreeModel(st["family"], st["task"])
            tm.model = cls.load(f"{path}/model_{i}")
            tm.classes_, tm.label = st.get("classes"), t
            b.models[t] = tm
            continue
        m = svm.SVC(**st["params"]) if st["kind"] == "SVC" else svm.SVR(**st["params"])
        m.label, m.features = st["label"], st["features"]
        if "nys" in st:
            n = svm.Nystroem(m.kernel, m.gamma, m.degree, m.coef0, m.n_landmarks, m.seed)
            n.gamma_, n.landmarks_, n.norm_ = st["nys"]["gamma_"], np.array(st["nys"]["landmarks"]), \
                np.array(st["nys"]["norm"])
            m.nys_ = n
        if st["kind"] == "SVR":
            m.coef_, m.intercept_ = np.array(st["coef"]), st["intercept"]
        else:
            m.classes_ = st["classes"]
            if st.get("pairs"):
                m.pairs_ = [tuple(pr) for pr in st["pairs"]]
                m.model_ = [LinearSVCModel.load(f"{path}/model_{i}_pair_{a}_{b}") for a, b in m.pairs_]
            else:
                loader = LinearSVCModel if len(m.classes_) == 2 else OneVsRestModel
                m.model_ = loader.load(f"{path}/model_{i}")
            if st.get("platt"):
                m.platt_ = [tuple(x) for x in st["platt"]]
        b.models[t] = m
    return b


def list_models(spark: SparkSession, root: str, model_name: str | None = None) -> DataFrame:
    """``(path, model_name, saved_at)`` of the bundles under ``root``, newest first."""
    metas = spark.read.json(f"{root}/*/meta").withColumn("path", F.regexp_replace(
        F.input_file_name(), "/meta/[^/]*$", ""))
    if model_name:
        metas = metas.where(F.col("model_name") == model_name)
    return metas.select("path", "model_name", "saved_at").orderBy(F.desc("saved_at"))


def write_cv_report(cv: DataFrame, path: str, top: int = 5) -> str:
    """Top candidates as CSV in a time-stamped folder; params as JSON text."""
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    out = f"{path}/cv_report_{stamp}"
    cols = [F.to_json(F.col(c)).alias(c) if dict(cv.dtypes)[c].startswith(("struct", "map", "array")) else F.col(c)
            for c in cv.columns]
    cv.orderBy("rank_test_score").limit(top).select(*cols).coalesce(1).write.mode("overwrite") \
        .option("header", "true").csv(out)
    return out


def write_evaluation(ev: DataFrame, path: str, fmt: str = "json", model_name: str | None = None,
                     run: str | None = None) -> None:
    """Evaluation rows (long form), partitioned by model name, and by ``run``
    if it is named: writing a run again replaces its rows and leaves the others."""
    out = ev.withColumn("model", F.lit(model_name or "model"))
    if run is None:
        out.write.mode("append").partitionBy("model").format(fmt).save(path)
    else:
        (out.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("model", "run").format(fmt).save(path))


def write_insight(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.mode("overwrite").format(fmt).save(path)
