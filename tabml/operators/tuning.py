"""Cross-validated grid search.

KNN: the ``algorithm`` never changes results, and one neighbour list of
``max(n_neighbors)`` rows per test row serves every ``n_neighbors`` and both
weightings.  So the 320 candidates of the reference grid (4 scalers x 5 k x 2
weights x 2 p x 4 algorithms) need one neighbour join per ``p``: the group key
(scaler, fold) lets fold g's validation rows meet only the training rows of
the other folds (``neighbors(group=...)``), scaled with statistics fitted on
those other folds (no leakage), for every scaler in the same join.

Other estimators: a fold loop that re-fits the preprocessing on each fold's
training part, fits every candidate (a thread pool submits the MLlib fits as
concurrent Spark jobs) and scores the validation part.

Reports follow the library's conventions: mean and population std of the fold
scores, ``rank`` with ties sharing the best rank, best = highest mean.
"""

from __future__ import annotations

import itertools
import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.operators import knn, metrics
from tabml.operators.prep import Preprocess, fit_scaler, normalize_scaler
from tabml.operators.split import kfold
from tabml.session import written

# The default search grids of the reference, one per model
# (candidate counts 320, 320, 96, 144, 90, 135, 216, 108).  With PCA on, the
# reference adds pca n_components [2, 3, 5] (those not above the feature count).
KNN_GRID = {
    "scaler": ["standard", "minmax", "robust", None],
    "n_neighbors": [3, 5, 7, 9, 11],
    "weights": ["uniform", "distance"],
    "p": [1, 2],
    "algorithm": ["auto", "ball_tree", "kd_tree", "brute"],
}
GRIDS = {
    "knn_classifier": KNN_GRID,
    "knn_regressor": KNN_GRID,
    "svm_classifier": {"scaler": ["standard", "minmax", "robust", None], "C": [0.1, 1, 10],
                       "kernel": ["linear", "rbf"], "gamma": ["scale", "auto"], "class_weight": [None, "balanced"]},
    "svm_regressor": {"scaler": ["standard", "minmax", "robust", None], "C": [0.1, 1, 10],
                      "kernel": ["linear", "rbf"], "gamma": ["scale", "auto"], "epsilon": [0.01, 0.1, 0.5]},
    "tree_classifier": {"criterion": ["gini", "entropy"], "max_depth": [None, 3, 5, 8, 12],
                        "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]},
    "tree_regressor": {"criterion": ["squared_error", "friedman_mse", "absolute_error"],
                       "max_depth": [None, 3, 5, 8, 12], "min_samples_split": [2, 5, 10],
                       "min_samples_leaf": [1, 2, 4]},
    "forest_classifier": {"n_estimators": [100, 300, 600], "max_depth": [None, 5, 10, 20],
                          "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
                          "class_weight": [None, "balanced"]},
    "forest_regressor": {"n_estimators": [100, 300, 600], "max_depth": [None, 5, 10, 20],
                         "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]},
}
PREP_KEYS = ("scaler", "pca", "cat_encoder")


def _fold_stats(f: DataFrame, features: str, folds: int, kind: str) -> dict:
    """Per fold g, (center, scale) arrays fitted on the rows of the other folds."""
    if kind == "robust":
        out = {}
        for g in range(folds):
            rest = f.where(F.col("fold") != g)
            dim = len(rest.select(features).first()[0])
            wide = rest.select(*[F.col(features)[j].alias(f"_d{j}") for j in range(dim)])
            out[g] = fit_scaler(wide, wide.columns, "robust")
        return out
    long = f.select("fold", F.posexplode(F.col(features).cast("array<double>")).alias("j", "v"))
    rows = long.groupBy("fold", "j").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"),
        F.min("v").alias("mn"), F.max("v").alias("mx")).collect()  # folds x dims rows
    dim = max(r["j"] for r in rows) + 1
    n, s, q = (np.zeros((folds, dim)) for _ in range(3))
    mn, mx = np.full((folds, dim), np.inf), np.full((folds, dim), -np.inf)
    for r in rows:
        g, j = r["fold"], r["j"]
        n[g, j], s[g, j], q[g, j], mn[g, j], mx[g, j] = r["n"], r["s"], r["q"], r["mn"], r["mx"]
    out = {}
    for g in range(folds):
        keep = [h for h in range(folds) if h != g]
        if kind == "standard":
            nn, ss, qq = n[keep].sum(0), s[keep].sum(0), q[keep].sum(0)
            mean = ss / nn
            std = np.sqrt(np.maximum(qq / nn - mean * mean, 0.0))
            center, scale = mean, std
        else:
            lo, hi = mn[keep].min(0), mx[keep].max(0)
            center, scale = lo, hi - lo
        scale = np.where(np.abs(scale) < 10 * np.finfo(float).eps, 1.0, scale)
        out[g] = (center.tolist(), scale.tolist())
    return out


def _fold_moments(f: DataFrame, features: str, folds: int):
    """Per fold: row count, column sums and Gram matrix of the raw features, from
    per-partition NumPy partial sums (one pass; folds x d^2 numbers come back)."""
    import pandas as pd

    def partial(it):
        acc: dict = {}
        for pdf in it:
            for g, grp in pdf.groupby("fold"):
                x = np.stack(grp[features].to_numpy()).astype(np.float64)
                n0, s0, q0 = acc.get(g, (0, 0.0, 0.0))
                acc[g] = (n0 + len(x), s0 + x.sum(axis=0), q0 + x.T @ x)
        for g, (n, sm, q) in acc.items():
            yield pd.DataFrame({"fold": [int(g)], "n": [int(n)],
                                "v": [np.concatenate([np.ravel(sm), np.ravel(q)]).tolist()]})

    parts = f.select("fold", F.col(features).cast("array<double>").alias(features)).mapInPandas(
        partial, "fold int, n long, v array<double>")
    rows = (parts.select("fold", F.posexplode("v").alias("i", "x"))
                 .groupBy("fold", "i").agg(F.sum("x").alias("x")).collect())
    cells: dict = {}
    for r in rows:
        cells.setdefault(r["fold"], {})[r["i"]] = r["x"]
    counts = {r["fold"]: r["n"] for r in parts.groupBy("fold").agg(F.sum("n").alias("n")).collect()}
    out = {}
    for g, c in cells.items():
        m = len(c)
        d = int(round((-1 + (1 + 4 * m) ** 0.5) / 2))  # m = d + d^2
        vec = np.array([c[i] for i in range(m)])
        out[g] = (counts[g], vec[:d], vec[d:].reshape(d, d))
    return out


def _fold_pca(moments: dict, stats: dict | None, folds: int, k: int, dim: int) -> dict:
    """Per fold g: (mean, components) of PCA on the scaled rows of the other
    folds.  Scaling is affine per column, so the scaled covariance is
    D^-1 Cov D^-1 of the raw covariance of those rows."""
    out = {}
    for g in range(folds):
        n = sum(moments[h][0] for h in range(folds) if h != g)
        sm = sum(moments[h][1] for h in range(folds) if h != g)
        q = sum(moments[h][2] for h in range(folds) if h != g)
        mu = sm / n
        cov = (q - n * np.outer(mu, mu)) / max(1, n - 1)
        center, scale = (np.zeros(dim), np.ones(dim)) if not stats else (np.array(stats[g][0]),
                                                                        np.array(stats[g][1]))
        cov_s = cov / np.outer(scale, scale)
        vals, vecs = np.linalg.eigh((cov_s + cov_s.T) / 2)
        comps = vecs[:, np.argsort(vals)[::-1][:k]].T
        for i in range(comps.shape[0]):
            if comps[i, np.argmax(np.abs(comps[i]))] < 0:
                comps[i] = -comps[i]
        out[g] = (((mu - center) / scale).tolist(), comps.tolist())
    return out


def _projected(xs, g, pca: dict):
    """Centre with the fold's mean and project on its components (JVM array ops)."""
    mm, cm = [], []
    for k_, (mu, comps) in pca.items():
        mm += [F.lit(k_), F.array(*[F.lit(float(v)) for v in mu])]
        cm += [F.lit(k_), F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in comps])]
    mu = F.element_at(F.create_map(*mm), g)
    comps = F.element_at(F.create_map(*cm), g)
    centred = F.zip_with(xs, mu, lambda a, b: a - b)
    return F.transform(comps, lambda row: F.aggregate(F.zip_with(centred, row, lambda a, b: a * b),
                                                      F.lit(0.0), lambda acc, v: acc + v))


def _scaled(x, g, stats: dict | None):
    if not stats:
        return x.cast("array<double>")
    cm, sm = [], []
    for k, (c, s) in stats.items():
        cm += [F.lit(k), F.array(*[F.lit(float(v)) for v in c])]
        sm += [F.lit(k), F.array(*[F.lit(float(v)) for v in s])]
    c = F.element_at(F.create_map(*cm), g)
    s = F.element_at(F.create_map(*sm), g)
    return F.transform(x.cast("array<double>"), lambda v, i: (v - F.element_at(c, i + 1)) / F.element_at(s, i + 1))


def _prediction(k: int, weights: str, name: str, task: str):
    """What the first k of a row's neighbours, ``_near`` in order, predict for a label:
    the rules of ``knn.vote`` and ``knn.regress``."""
    near = F.slice("_near", 1, k)
    zero = F.col("_near")[0]["dist"] == 0  # the nearest's: then only those at distance 0 count

    def w(n):
        if weights == "uniform":
            return F.lit(1.0)
        return F.when(zero, (n["dist"] == 0).cast("double")).otherwise(1.0 / n["dist"])

    def total(of, value):
        return F.aggregate(of, F.lit(0.0), lambda acc, n: acc + value(n))

    if task == "classification":
        classes = F.array_distinct(F.transform(near, lambda n: n["_y"][name]))
        votes = F.transform(classes, lambda y: F.struct(
            (-total(F.filter(near, lambda n: n["_y"][name].eqNullSafe(y)), w)).alias("a"), y.alias("b")))
        return F.array_min(votes)["b"]
    known = F.filter(near, lambda n: n["_y"][name].isNotNull())
    return F.when(F.size(known) > 0, total(known, lambda n: w(n) * n["_y"][name])) / total(near, w)


def _raw_sides(f: DataFrame, key: str, raw: list, labels: list, combos: list, folds: int, cat_encoder: str):
    """(validation, training) rows of raw columns: one preprocessing per fold and
    (scaler, pca), fitted on the other folds."""
    qs, ts = [], []
    for ci, (kind, pc) in enumerate(combos):
        for g in range(folds):
            rest = F.col("fold") != g
            pm = Preprocess(cat_encoder=cat_encoder, scaler=kind, pca=pc).fit(f.where(rest), raw)
            x = pm.transform(f, keep=[key, "fold", *labels]).select(
                key, "fold", *labels, F.lit(ci * folds + g).alias("_g"), F.col("features").alias("_xs"))
            qs.append(x.where(~rest).drop("fold"))
            ts.append(x.where(rest).drop("fold"))
    return reduce(DataFrame.unionByName, qs), reduce(DataFrame.unionByName, ts)


def _array_sides(f: DataFrame, key: str, features: str, labels: list, combos: list, folds: int):
    """(validation, training) rows of an array column, scaled and projected by
    statistics of the other folds that come from one pass over all."""
    dim = len(f.select(features).first()[0])
    moments = _fold_moments(f, features, folds) if any(pc for _, pc in combos) else None
    qs, ts = [], []
    stats_by_kind = {kind: (_fold_stats(f, features, folds, kind) if kind else None) for kind, _ in combos}
    for ci, (kind, pc) in enumerate(combos):
        stats = stats_by_kind[kind]
        if pc:
            if pc > dim:
                raise ValueError(f"pca n_components={pc} exceeds the feature count {dim}")
            pca = _fold_pca(moments, stats, folds, int(pc), dim)

            def feat(gcol, stats=stats, pca=pca):
                return _projected(_scaled(F.col(features), gcol, stats), gcol, pca)
        else:
            def feat(gcol, stats=stats):
                return _scaled(F.col(features), gcol, stats)
        qs.append(f.select(key, *labels, (F.col("fold") + ci * folds).alias("_g"), feat(F.col("fold")).alias("_xs")))
        ts.append(f.select(key, *labels, "fold", features,
                           F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("_f"))
                  .where(F.col("_f") != F.col("fold"))
                  .select(key, *labels, (F.col("_f") + ci * folds).alias("_g"), feat(F.col("_f")).alias("_xs")))
    return reduce(DataFrame.unionByName, qs), reduce(DataFrame.unionByName, ts)


def knn_grid_search(df: DataFrame, key: str, features: str | list[str], label: str | list[str],
                    task: str = "classification", folds: int = 5, seed: int = 42, grid: dict | None = None,
                    scoring: str | None = None, stratify: bool | None = None, block_rows: int = 4096,
                    cat_encoder: str = "ohe") -> DataFrame:
    """One row per candidate: ``(scaler, p, n_neighbors, weights, algorithm, params,
    split0..split{k-1}, mean_test_score, std_test_score, rank_test_score)``.

    ``features`` is an array column, or a list of raw columns; raw columns are
    imputed, encoded, scaled and projected by statistics of the other folds'
    rows, so validation rows never leak.  With several labels every one is
    voted for from the same neighbour list, a candidate's score on a fold is
    the mean over the labels, and the folds aren't stratified."""
    g = {**KNN_GRID, **(grid or {})}
    labels = [label] if isinstance(label, str) else list(label)
    scoring = scoring or ("f1_weighted" if task == "classification" else "r2")
    strat = labels[0] if (task == "classification" and stratify is not False and len(labels) == 1) else None
    raw = [] if isinstance(features, str) else list(features)
    f = kfold(df.select(key, *(raw or [features]), *labels), [key], folds, seed, stratify=strat).cache()
    positive = {t: metrics.positive_label(f, t) if scoring == "f1" else None for t in labels}
    ks, ws = sorted(set(g["n_neighbors"])), list(dict.fromkeys(g["weights"]))
    kinds = list(dict.fromkeys(normalize_scaler(sc) for sc in g["scaler"]))
    pcas = list(dict.fromkeys(g.get("pca", [None]) or [None]))
    combos = [(kind, pc) for kind in kinds for pc in pcas]
    # every (scaler, pca, fold) triple is one group of a single blocked join per p:
    # group id = combo index * folds + fold
    if raw:
        q, t = _raw_sides(f, key, raw, labels, combos, folds, cat_encoder)
    else:
        q, t = _array_sides(f, key, features, labels, combos, folds)
    # one label column travels with the neighbours: several are packed as JSON
    packed = F.col(labels[0]) if len(labels) == 1 else F.to_json(F.struct(*labels))
    t = t.withColumn("_packed", packed)
    as_struct = T.StructType([f.schema[x] for x in labels])
    combo_idx = (F.col("_g") / folds).cast("int") + 1
    names = F.element_at(F.array(*[F.lit(kind or "none") for kind, _ in combos]), combo_idx)
    pca_col = F.element_at(F.array(*[F.lit(pc).cast("int") for _, pc in combos]), combo_idx)
    parts = []
    for p in g["p"]:
        nb = knn.neighbors(t, q, key, "_xs", "_packed", k=max(ks), p=p, block_rows=block_rows, group="_g")
        own = F.from_json("nn_label", as_struct) if len(labels) > 1 else F.struct(F.col("nn_label").alias(labels[0]))
        near = nb.select("_g", key, F.struct("nn_rank", "dist", own.alias("_y")).alias("_n"))
        near = near.groupBy("_g", key).agg(F.sort_array(F.collect_list("_n")).alias("_near"))  # k at most
        made = near.select("_g", key, *[F.array(*[
            F.struct(F.struct(F.lit(k).alias("k"), F.lit(w).alias("weights")).alias("_c"), _prediction(k, w, name, task).alias("prediction"))
            for k in ks for w in ws]).alias(f"_made{i}") for i, name in enumerate(labels)])
        scored = made.join(q.select(key, "_g", *labels), ["_g", key])
        if len(labels) > 1:
            scored = written(scored, "predictions")  # each label's scores read them
        for i, name in enumerate(labels):
            each = scored.select("_g", name, F.explode(f"_made{i}").alias("_e")).select("_g", name, "_e._c", "_e.prediction")
            s = metrics.score_by(each, name, "prediction", scoring, ["_c", "_g"], positive[name])
            parts.append(s.select(names.alias("scaler"), pca_col.alias("pca"), F.lit(float(p)).alias("p"),
                                  F.col("_c.k").alias("n_neighbors"), F.col("_c.weights").alias("weights"),
                                  (F.col("_g") % folds).alias("fold"), "score"))
    allp = parts[0]
    for x in parts[1:]:
        allp = allp.unionByName(x)
    if len(labels) > 1:
        allp = allp.groupBy("scaler", "pca", "p", "n_neighbors", "weights", "fold").agg(F.avg("score").alias("score"))
    # the algorithm is a physical hint: every algorithm scores the same
    algos = F.explode(F.array(*[F.lit(a) for a in g["algorithm"]])).alias("algorithm")
    params = ["scaler", "p", "n_neighbors", "weights", "algorithm"] + (["pca"] if any(pcas) else [])
    if not any(pcas):
        allp = allp.drop("pca")
    return report(allp.select("*", algos), params, folds)


def report(fold_scores: DataFrame, params: list[str], folds: int) -> DataFrame:
    """``(*params, split<i>_test_score, mean_test_score, std_test_score,
    rank_test_score)`` from ``(*params, fold, score)``; the table has one row
    per candidate (bounded by the grid), so the rank window is small."""
    failed = F.max(F.col("score").isNull().cast("int")) == 1
    agg = fold_scores.groupBy(*params).agg(
        *[F.max(F.when(F.col("fold") == i, F.col("score"))).alias(f"split{i}_test_score") for i in range(folds)],
        F.when(failed, F.lit(None)).otherwise(F.avg("score")).alias("mean_test_score"),
        F.when(failed, F.lit(None)).otherwise(F.stddev_pop("score")).alias("std_test_score"))
    # rank on the mean rounded to 10 decimals: float noise in a sum of equal
    # fold scores must not split a tie
    w = Window.orderBy(F.desc_nulls_last(F.round("mean_test_score", 10)))
    return agg.withColumn("rank_test_score", F.rank().over(w))


def grid_order(grid: dict) -> list[str]:
    """Parameter names in the library's candidate order: its grid keys are
    ``classifier__<name>``, ``pca__n_components`` and ``scaler``, iterated in
    sorted order with the last key varying fastest."""
    def lib_name(k):
        return {"scaler": "scaler", "pca": "pca__n_components"}.get(k, f"classifier__{k}")
    return sorted(grid, key=lib_name)


def best_params(report_df: DataFrame, params: list[str], grid: dict | None = None) -> dict:
    """The best candidate; among tied ranks, the first in the library's grid
    order (the candidate it would refit)."""
    top = [r.asDict() for r in report_df.where(F.col("rank_test_score") == 1).collect()]  # <= grid size
    if grid:
        keys = grid_order(grid)
        pos = {k: {json.dumps(v, default=str): i for i, v in enumerate(grid[k])} for k in keys}

        def index(r):
            out = []
            for k in keys:
                v = r[k]
                v = None if (k == "scaler" and v == "none") else v
                if k == "p":
                    v = int(v) if float(v).is_integer() else v
                out.append(pos[k].get(json.dumps(v, default=str), 0))
            return tuple(out)
        row = min(top, key=index)
    else:
        row = min(top, key=lambda r: tuple(str(r[c]) for c in params))
    return {c: row[c] for c in params} | {"mean_test_score": row["mean_test_score"]}


def grid_candidates(grid: dict | None) -> list[dict]:
    """Candidates in the library's order (``grid_order``)."""
    if not grid:
        return [{}]
    keys = grid_order(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


def fold_grid_search(df: DataFrame, key: str, features: list[str], label: str | list[str], make_model, grid: dict | None,
                     task: str = "classification", folds: int = 5, seed: int = 42, scoring: str | None = None,
                     prep_params: dict | None = None, stratify: bool | None = None,
                     parallelism: int = 4) -> DataFrame:
    """Grid search for model objects with ``fit(df, label)`` / ``predict(df)``
    over an array ``features`` column; ``make_model(**params)`` builds one.

    Preprocessing (imputers, encoders and the ``scaler``/``pca`` of the
    candidate) is fitted on each fold's training part.  With several labels a
    candidate's score on a fold is the mean over one model per label, and the
    folds aren't stratified.  A candidate whose parameters the model rejects
    scores null and ranks last (the library's ``error_score=nan``), with the
    message in ``error``; any other failure stops the search."""
    scoring = scoring or ("f1_weighted" if task == "classification" else "r2")
    labels = [label] if isinstance(label, str) else list(label)
    strat = labels[0] if (task == "classification" and stratify is not False and len(labels) == 1) else None
    f = kfold(df.select(key, *labels, *features), [key], folds, seed, stratify=strat).cache()
    positive = {t: metrics.positive_label(f, t) if scoring == "f1" else None for t in labels}
    cands = grid_candidates(grid)
    groups: dict = {}
    for i, c in enumerate(cands):
        pk = json.dumps({k: c[k] for k in PREP_KEYS if k in c}, sort_keys=True, default=str)
        groups.setdefault(pk, []).append(i)
    rows = []
    for g in range(folds):
        tr_raw, va_raw = f.where(F.col("fold") != g), f.where(F.col("fold") == g)
        for pk, idxs in groups.items():
            pp = {**(prep_params or {}), **json.loads(pk)}
            pm = Preprocess(**pp).fit(tr_raw, features)
            tr = pm.transform(tr_raw, keep=[key, *labels]).cache()
            va = pm.transform(va_raw, keep=[key, *labels]).cache()

            def run(i, tr=tr, va=va, g=g):
                params = cands[i]
                model_params = {k: v for k, v in params.items() if k not in PREP_KEYS}
                sc, error = [], None
                try:
                    for name in labels:
                        m = make_model(**model_params).fit(tr, name)
                        sc.append(metrics.score(m.predict(va), name, "prediction", scoring, positive[name]).first()["score"])
                except (ValueError, IllegalArgumentException) as e:  # what models raise for their parameters
                    error = str(e)
                mean = None if error or None in sc else float(sum(sc)) / len(sc)
                return (i, json.dumps(params, sort_keys=True, default=str), g, mean, error)

            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
                rows += list(ex.map(run, idxs))
            tr.unpersist()
            va.unpersist()
    f.unpersist()
    spark = df.sparkSession
    scores = spark.createDataFrame(rows, "cand int, params string, fold int, score double, error string")
    errors = scores.groupBy("cand").agg(F.max("error").alias("error"))
    return report(scores.drop("error"), ["cand", "params"], folds).join(errors, "cand")
