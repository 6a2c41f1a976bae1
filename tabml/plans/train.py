"""Train entry by model name: roles -> label maps -> split -> [grid search]
-> preprocessing -> one model per target -> predictions -> evaluation.

Eight models as in the reference: ``knn_classifier``, ``knn_regressor``,
``svm_classifier``, ``svm_regressor``, ``tree_classifier``, ``tree_regressor``,
``forest_classifier``, ``forest_regressor``.  Defaults of the reference's
training entry: test size 0.2, seed 42, 5 folds, scoring ``f1_weighted`` /
``r2``, one-hot encoding.  Label encoding happens before the split (as in the
reference); the split is stratified for a single classification target.
"""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.hashing import ROW_KEY, identified
from tabml.operators import knn as knn_op
from tabml.operators import metrics, svm, trees, tuning
from tabml.operators import target as target_op
from tabml.operators.prep import Preprocess, PreprocessModel
from tabml.operators.roles import ColumnRoles
from tabml.operators.split import train_test_split

MODELS = {
    "knn_classifier": ("knn", "classification"),
    "knn_regressor": ("knn", "regression"),
    "svm_classifier": ("svm", "classification"),
    "svm_regressor": ("svm", "regression"),
    "tree_classifier": ("tree", "classification"),
    "tree_regressor": ("tree", "regression"),
    "forest_classifier": ("forest", "classification"),
    "forest_regressor": ("forest", "regression"),
}

_PREP_KEYS = ("scaler", "pca", "cat_encoder")


@dataclass
class Bundle:
    """Everything needed to score new rows: raw input names, preprocessing,
    label maps and one fitted model per target."""
    model_name: str
    key: str | list | None                         # the identifying column(s); None: the table has none
    targets: list
    features: list
    prep: PreprocessModel
    label_maps: dict
    params: dict
    models: dict = field(default_factory=dict)   # target -> fitted model (non-KNN)
    knn_train: DataFrame | None = None            # KNN: the preprocessed training rows
    prepared: object = None                        # KNN: what scoring made of them, once per bundle

    @property
    def family(self) -> str:
        return MODELS[self.model_name][0]

    @property
    def task(self) -> str:
        return MODELS[self.model_name][1]

    @property
    def row_key(self) -> str:
        """The one column that identifies a row of the preprocessed tables."""
        return self.key if isinstance(self.key, str) else ROW_KEY

    @property
    def keys(self) -> list[str]:
        return [self.key] if isinstance(self.key, str) else list(self.key or [])

    def feature_names(self) -> list[str]:
        return self.prep.feature_names()


@dataclass
class TrainResult:
    bundle: Bundle
    predictions: DataFrame      # key, is_test, targets (encoded), pred_<target>
    evaluation: DataFrame       # long (target, split, metric, value)
    cv_report: DataFrame | None = None
    dropped_null_targets: int = 0


def _model_params(family: str, task: str, params: dict) -> dict:
    return {k: v for k, v in params.items() if k not in _PREP_KEYS}


def fit_models(family: str, task: str, train: DataFrame, key: str, targets: list, params: dict) -> dict:
    out = {}
    mp = _model_params(family, task, params)
    for t in targets:
        if family in ("tree", "forest"):
            tp = dict(mp)
            cw = tp.pop("class_weight", None)
            out[t] = trees.TreeModel(family, task, class_weight=cw if task == "classification" else None,
                                     **tp).fit(train, t)
        elif family == "svm":
            if task == "classification":
                out[t] = svm.SVC(**mp).fit(train, t, key=key)
            else:
                out[t] = svm.SVR(**mp).fit(train, t, key=key)
        else:
            raise ValueError(family)
    return out


def predict_matrix(bundle: Bundle, x: DataFrame, proba: bool = False) -> DataFrame:
    """``x`` has the bundle's ``row_key`` and ``features`` (preprocessed); adds ``pred_<target>``
    (encoded classes for encoded targets) and, with ``proba`` for classifiers,
    ``proba_<target>`` (class probabilities in sorted class order)."""
    key = bundle.row_key
    if bundle.family == "knn":
        p = bundle.params
        k, w, pp = int(p.get("n_neighbors", 5)), p.get("weights", "uniform"), float(p.get("p", 2))
        if bundle.prepared is None:
            bundle.prepared = knn_op.prepare(bundle.knn_train, key, "features", bundle.targets, bundle.task)
        return knn_op.predict(bundle.knn_train, x, key, "features", bundle.targets, bundle.task, k=k, p=pp,
                              weights=w, proba=proba, prepared=bundle.prepared)
    out = x
    for t in bundle.targets:
        m = bundle.models[t]
        if proba and bundle.task == "classification":
            if bundle.family in ("tree", "forest"):
                out = m.predict(out, out_col=f"pred_{t}", keep_proba=True).withColumnRenamed(
                    "probability", f"proba_{t}")
                continue
            if getattr(m, "platt_", None):
                out = m.predict(out, out_col=f"pred_{t}").withColumnRenamed("probability", f"proba_{t}")
                continue
            raise ValueError("this SVC was fitted without probability=True")
        out = m.predict(out, out_col=f"pred_{t}")
    return out


def train(df: DataFrame, key: str | Sequence[str] | None, targets, features=None, model: str = "knn_classifier",
          test_size=0.2, seed: int = 42, use_cv: bool = False, folds: int = 5, scoring: str | None = None,
          grid: dict | None = None, **params) -> TrainResult:
    """``key`` names the column that identifies a row, or several that do so
    together, or is None for a table without any: equal rows are then numbered,
    and a row's place in splits and folds follows from its values and that number.
    The predictions carry the key columns, if there are any."""
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; choose one of {sorted(MODELS)}")
    family, task = MODELS[model]
    roles = ColumnRoles.resolve(df, targets, features, key=key)
    ts = roles.targets
    keys = [key] if isinstance(key, str) else list(key or [])
    if isinstance(key, str):
        data = df.select(key, *roles.features, *ts)
    else:
        if key is not None and not keys:
            raise ValueError("no key column given (None for a table without a key)")
        if clash := [c for c in keys if c in ts]:
            raise ValueError(f"key columns are targets: {clash}")
        data = identified(df.select(*dict.fromkeys([*keys, *roles.features, *ts])), keys if key is not None else None)
        key = ROW_KEY
    cond = None
    for t in ts:
        cond = F.col(t).isNull() if cond is None else (cond | F.col(t).isNull())
    dropped = data.where(cond).count()
    data = data.where(~cond)
    maps = target_op.fit_label_map(data, ts) if task == "classification" else {}
    data = target_op.encode_labels(data, maps)
    strat = ts[0] if (task == "classification" and len(ts) == 1) else None
    s = train_test_split(data, [key], test_size, seed, stratify=strat)
    tr = s.where(~F.col("is_test"))
    scoring = scoring or ("f1_weighted" if task == "classification" else "r2")
    cv = None
    params = dict(params)
    if use_cv:
        grid = dict(tuning.GRIDS[model] if grid is None else grid)
        if params.get("pca") and family in ("knn", "svm") and "pca" not in grid:
            # with PCA on, component counts 2/3/5 join the grid, limited by the
            # encoded width (not the raw column count)
            width = len(Preprocess(cat_encoder=params.get("cat_encoder", "ohe")).fit(tr, roles.features)
                        .feature_names())
            grid["pca"] = [n for n in (2, 3, 5) if n <= width] or [None]
        if family == "knn":
            cv = tuning.knn_grid_search(tr, key, roles.features, ts, task, folds, seed, grid, scoring,
                                        cat_encoder=params.get("cat_encoder", "ohe"))
            names = ["scaler", "p", "n_neighbors", "weights", "algorithm"] + (["pca"] if "pca" in cv.columns else [])
            best = tuning.best_params(cv, names, {**tuning.KNN_GRID, **grid})
            params.update({k: best[k] for k in ("n_neighbors", "weights", "p", "algorithm")})
            params["scaler"] = None if best["scaler"] == "none" else best["scaler"]
            if "pca" in best:
                params["pca"] = best["pca"]
        else:
            prep_params = {k: params[k] for k in _PREP_KEYS if k in params}

            def make(**cand):
                mp = {**_model_params(family, task, params), **cand}
                return _Single(family, task, key, mp)
            cv = tuning.fold_grid_search(tr, key, roles.features, ts, make, grid, task, folds, seed, scoring,
                                         prep_params)
            best = cv.orderBy("rank_test_score", "cand").first()
            import json
            params.update(json.loads(best["params"]))
    pre = Preprocess(cat_encoder=params.get("cat_encoder", "ohe"), scaler=params.get("scaler"),
                     pca=params.get("pca")).fit(tr, roles.features)
    x = pre.transform(s, keep=[*dict.fromkeys([key, *keys]), "is_test", *ts])
    xtr = x.where(~F.col("is_test"))
    bundle = Bundle(model, key if key in keys else keys or None, ts, roles.features, pre, maps, params)
    if family == "knn":
        bundle.knn_train = xtr.select(key, "features", *ts)
    else:
        bundle.models = fit_models(family, task, xtr, key, ts, params)
    pred = predict_matrix(bundle, x)
    evals = []
    for t in ts:
        fn = metrics.eval_classifier if task == "classification" else metrics.eval_regressor
        evals.append(fn(pred, t, f"pred_{t}", split_col="is_test", target=t))
    ev = evals[0]
    for e in evals[1:]:
        ev = ev.unionByName(e)
    if len(ts) > 1:
        ev = metrics.eval_multi(ev)
    return TrainResult(bundle, pred if key in keys else pred.drop(ROW_KEY), ev, cv, dropped)


def insight(bundle: Bundle, df: DataFrame, target: str | None = None, n_ids: int = 20) -> DataFrame:
    """``svm_insight`` of an SVM classifier's bundle over raw rows with their
    labels, for one of its targets (the only one if none is named); labels as in
    ``df``. Rows without a label are left out. Several key columns show as a
    struct; a bundle without a key has no ids to show."""
    if bundle.model_name != "svm_classifier":
        raise ValueError(f"insight is for svm_classifier, not {bundle.model_name}")
    if target is None and len(bundle.targets) > 1:
        raise ValueError(f"choose a target: {bundle.targets}")
    target = target or bundle.targets[0]
    if target not in bundle.targets:
        raise ValueError(f"unknown target {target!r}; choose one of {bundle.targets}")
    if not bundle.keys:
        raise ValueError("insight shows row ids: train with key=")
    rows = df.where(F.col(target).isNotNull())
    ids = F.col(bundle.key) if isinstance(bundle.key, str) else F.struct(*bundle.keys)
    rows = rows.select(ids.alias("_id"), *bundle.features, F.col(target).alias("_y"))
    maps = {"_y": bundle.label_maps[target]} if target in bundle.label_maps else {}
    rows = target_op.encode_labels(rows, maps)
    model = copy(bundle.models[target])
    model.label = "_y"
    out = svm.svm_insight(model, bundle.prep.transform(rows, keep=["_id", "_y"]), "_id", n_ids)
    return target_op.decode_labels(out, maps, {"label": "_y"}).withColumn("target", F.lit(target))


class _Single:
    """One-target model with the fit/predict protocol of ``fold_grid_search``."""

    def __init__(self, family, task, key, params):
        self.family, self.task, self.key, self.params = family, task, key, params

    def fit(self, df, label):
        self.label = label
        self.m = fit_models(self.family, self.task, df, self.key, [label], dict(self.params))[label]
        return self

    def predict(self, df):
        return self.m.predict(df, out_col="prediction")
