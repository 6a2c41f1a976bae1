"""Support vector machines on Spark.

Classifier (``SVC``)
    Linear kernel: MLlib ``LinearSVC`` (distributed OWL-QN on the hinge loss).
    MLlib minimises ``mean(hinge) + regParam/2 |w|^2``; the library's
    ``C * sum(hinge) + 1/2 |w|^2`` is the same problem with
    ``regParam = 1 / (C * n)`` (``n`` = weight sum with class weights).  More
    than two classes: one-vs-one as the library does (one machine per class
    pair, fitted as concurrent jobs; majority vote, first maximum wins), or
    one-vs-rest (``multiclass="ovr"``, MLlib ``OneVsRest``).
    rbf / poly / sigmoid kernels: a low-rank feature map. Landmark rows are the
    pivots of an incomplete Cholesky factorisation of the kernel matrix
    (Fine & Scheinberg 2001): each pass over the table measures what the landmarks
    so far leave of every row's diagonal entry, the rows with the most become
    landmarks, until the residual trace is at most ``landmark_tol`` of the
    whole. ``landmark_error_`` is the share that is left; ``n_landmarks`` bounds their
    number, with a warning where it ends the search. Each row is mapped to its row
    of the factor by a pandas UDF, and the linear machine is trained on the map.
    ``probability=True``: Platt scaling as the library does it: decision
    scores of the training rows come out of fold (``platt_cv`` stratified
    folds, default 5), and a sigmoid is fitted to them with Platt's smoothed
    targets ``(N+ + 1) / (N+ + 2)`` and ``1 / (N- + 2)`` (a logistic regression on the score, all sigmoids in the same passes).  One-vs-one machines: a sigmoid per class pair
    on the out-of-fold margins of its rows, and the class probabilities that
    agree best with all pairs (Wu, Lin & Weng 2004, second method), solved for a
    whole batch of rows at once.  One-vs-rest: one sigmoid per score, normalised.

Regressor (``SVR``)
    ``loss="epsilon_insensitive"``: the absolute loss, ``1/2 |w|^2 + C *
    sum(max(0, |y - x.w - b| - eps))``, fitted to a duality gap of ``tol``
    (``operators/tube.py``); ``objective_``, ``gap_`` and ``converged_`` report it.
    ``loss="squared_epsilon_insensitive"``: the same with squares, by semismooth
    Newton steps, each one pass that sums ``Z^T Z`` and ``Z^T t`` over the rows
    outside the tube, solved on the driver.

Kernel parameters: ``gamma="scale"`` = 1 / (d * variance of all matrix
entries), ``"auto"`` = 1 / d, or a number; ``degree`` and ``coef0`` as usual.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tabml.functions.hashing import order_hash
from tabml.functions.sums import blocks, matrix, sum_over
from tabml.operators.target import MAX_CLASSES
from tabml.operators.tube import FeatureMap, fit_tube
from tabml.session import spread

#: landmarks of a kernel map at most, and the share of the kernel's trace that may be left
MAX_LANDMARKS, LANDMARK_TOL = 1000, 1e-2


def resolve_gamma(df: DataFrame, features: str, gamma) -> float:
    if isinstance(gamma, (int, float)):
        return float(gamma)
    row = df.select(F.explode(F.col(features).cast("array<double>")).alias("v")).agg(
        F.count(F.lit(1)).alias("n"), F.var_pop("v").alias("var")).first()
    dim = df.select(F.size(features)).first()[0]
    if gamma == "auto":
        return 1.0 / dim
    if gamma == "scale":
        var = row["var"] or 0.0
        return 1.0 / (dim * var) if var > 0 else 1.0
    raise ValueError("gamma must be 'scale', 'auto' or a number")


def _kernel(a: np.ndarray, b: np.ndarray, kernel: str, gamma: float, degree: int, coef0: float) -> np.ndarray:
    if kernel == "rbf":
        d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
        return np.exp(-gamma * np.maximum(d2, 0.0))
    if kernel == "poly":
        return (gamma * a @ b.T + coef0) ** degree
    if kernel == "sigmoid":
        return np.tanh(gamma * a @ b.T + coef0)
    raise ValueError("kernel must be linear, rbf, poly or sigmoid")


def _diagonal(x: np.ndarray, kernel: str, gamma: float, degree: int, coef0: float) -> np.ndarray:
    """k(x, x) of every row."""
    if kernel == "rbf":
        return np.ones(len(x))
    dot = gamma * np.einsum("ij,ij->i", x, x) + coef0
    return dot ** degree if kernel == "poly" else np.tanh(dot)


def _pivots(rows: np.ndarray, kernel_of, residual: np.ndarray, most: int, floor: float) -> list[int]:
    """Greedy pivots among candidate rows whose kernel, less what earlier landmarks
    explain, is ``kernel_of(rows, row)``; ends at ``most`` or a residual of ``floor``."""
    left, factor, out = residual.copy(), np.zeros((len(rows), most)), []
    while len(out) < min(most, len(rows)):
        i = int(np.argmax(left))
        if left[i] <= floor:
            break
        k = len(out)
        factor[:, k] = (kernel_of(rows, rows[i:i + 1])[:, 0] - factor[:, :k] @ factor[i, :k]) / np.sqrt(left[i])
        left = left - factor[:, k] ** 2
        left[i] = -np.inf
        out.append(i)
    return out


class Nystroem:
    """Low-rank kernel map on landmark rows found by pivoted incomplete Cholesky."""

    def __init__(self, kernel="rbf", gamma="scale", degree=3, coef0=0.0, n_landmarks=MAX_LANDMARKS, seed=42,
                 landmark_tol=LANDMARK_TOL):
        self.kernel, self.gamma, self.degree, self.coef0 = kernel, gamma, degree, coef0
        self.n_landmarks, self.seed, self.landmark_tol = n_landmarks, seed, landmark_tol

    def fit(self, df: DataFrame, key: str, features: str = "features", n_rows: int | None = None) -> "Nystroem":
        """One pass per batch of landmarks; ties are broken by a seeded hash of the key.
        ``n_rows``, where known, spreads a table of few splits over all cores."""
        self.gamma_ = resolve_gamma(df, features, self.gamma)
        rows = df.select(order_hash(self.seed, [key]).alias("h"), F.col(features).cast("array<double>").alias("x"))
        rows = (rows if n_rows is None else spread(rows, rows=n_rows)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            dim = len(rows.first()["x"])
            self.landmarks_, self.norm_ = np.zeros((0, dim)), np.zeros((0, 0))
            while True:
                total, left, found = self._residuals(rows, dim, max(32, len(self.landmarks_)))
                self.landmark_error_ = left / total if total > 0 else 0.0
                room = self.n_landmarks - len(self.landmarks_)
                if self.landmark_error_ <= self.landmark_tol or room <= 0 or not self._grow(found, room):
                    break
        finally:
            rows.unpersist()
        if self.landmark_error_ > self.landmark_tol:
            warnings.warn(f"kernel map: {len(self.landmarks_)} landmarks leave {self.landmark_error_:.3g} of the kernel's trace "
                          f"(landmark_tol {self.landmark_tol:.3g})")
        return self

    def _residuals(self, rows: DataFrame, dim: int, batch: int) -> tuple[float, float, list]:
        """Trace of the kernel, what the landmarks leave of it, and the rows with most left."""
        lm, norm, kernel, args = self.landmarks_, self.norm_, self.kernel, (self.kernel, self.gamma_, self.degree, self.coef0)

        def run(batches):
            total = rest = 0.0
            best: list = []
            for b in batches:
                if not b.num_rows:
                    continue
                x = matrix(b.column("x"), dim)
                diagonal = _diagonal(x, *args)
                left = diagonal.copy()
                if len(lm):
                    for part in blocks(len(x), len(lm)):
                        left[part] -= ((_kernel(x[part], lm, *args) @ norm) ** 2).sum(axis=1)
                total += np.abs(diagonal).sum()
                rest += np.maximum(left, 0.0).sum()
                h, top = b.column("h"), np.arange(len(left))
                if len(left) > 2 * batch:
                    # of equal residuals, the least hashes
                    order = np.argsort(-left, kind="stable") if np.ptp(left) > 0 else np.argsort(h.to_numpy(zero_copy_only=False), kind="stable")
                    top = order[:2 * batch]
                best = sorted(best + [(-float(left[i]), k, x[i].tolist()) for i, k in zip(top, h.take(pa.array(top)).to_pylist())])[:2 * batch]
            out = [(None, None, None, total, rest)] + [(-v, k, x, None, None) for v, k, x in best]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.float64()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.list_(pa.float64())),
                 pa.array([r[3] for r in out], pa.float64()), pa.array([r[4] for r in out], pa.float64())], ["r", "h", "x", "total", "rest"])

        found = rows.mapInArrow(run, "r double, h string, x array<double>, total double, rest double").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            total, rest = found.agg(F.sum("total"), F.sum("rest")).first()
            top = found.where("h is not null").orderBy(F.desc("r"), "h").limit(2 * batch).collect()  # bounded by the batch
        finally:
            found.unpersist()
        return total or 0.0, rest or 0.0, top

    def _grow(self, found: list, room: int) -> bool:
        """Adds up to half of the candidates as landmarks; False if none has anything left."""
        x, left = np.array([r["x"] for r in found]), np.array([r["r"] for r in found])
        args = (self.kernel, self.gamma_, self.degree, self.coef0)
        lm, norm = self.landmarks_, self.norm_

        def kernel_of(a, b):
            k = _kernel(a, b, *args)
            return k - (_kernel(a, lm, *args) @ norm) @ (_kernel(b, lm, *args) @ norm).T if len(lm) else k

        chosen = _pivots(x, kernel_of, left, min(room, max(1, len(found) // 2)), 1e-9 * max(1.0, float(left.max())))
        if not chosen:
            return False
        self.landmarks_ = np.vstack([lm, x[chosen]])
        k = _kernel(self.landmarks_, self.landmarks_, *args)
        vals, vecs = np.linalg.eigh((k + k.T) / 2)
        keep = vals > 1e-12 * vals.max()
        self.norm_ = vecs[:, keep] / np.sqrt(vals[keep])  # K_mm^{-1/2} up to rotation
        return True

    def transform(self, df: DataFrame, features: str = "features", out_col: str = "features") -> DataFrame:
        lm, norm = self.landmarks_, self.norm_
        kernel, gamma, degree, coef0 = self.kernel, self.gamma_, self.degree, self.coef0

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def phi(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                if len(x) == 0:
                    yield pd.Series([], dtype=object)
                for part in blocks(len(x), len(lm)):
                    a = np.stack(x.iloc[part].to_numpy()).astype(np.float64)
                    yield pd.Series(list(_kernel(a, lm, kernel, gamma, degree, coef0) @ norm))

        return df.withColumn(out_col, phi(F.col(features).cast("array<double>")))

    def values(self, x: np.ndarray) -> np.ndarray:
        """Kernel of rows and landmarks: the features are these values times ``norm_``."""
        return _kernel(x, self.landmarks_, self.kernel, self.gamma_, self.degree, self.coef0)

    def linear(self, df: DataFrame, features: str, coef: np.ndarray, intercept: float, out_col: str) -> DataFrame:
        """Adds a linear function of the mapped features, which are not made."""
        w, values, width = self.norm_ @ coef, self.values, len(self.landmarks_)

        dim, lost = self.landmarks_.shape[1], bool(np.isnan(self.norm_).any())

        # Arrow, where NaN (a machine without finite coefficients) isn't null (a row without features)
        @F.arrow_udf(T.DoubleType())
        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for x in batches:
                rows, out, null = matrix(x, dim), np.zeros(len(x)), np.zeros(len(x), dtype=bool)
                for part in blocks(len(x), width):
                    k = values(rows[part])
                    out[part], null[part] = k @ w + intercept, np.isnan(k).any(axis=1) | lost
                yield pa.array(out, pa.float64(), mask=null)

        return df.withColumn(out_col, score(F.col(features).cast("array<double>")))


class SVC:
    def __init__(self, C: float = 1.0, kernel: str = "rbf", gamma="scale", degree: int = 3, coef0: float = 0.0,
                 class_weight: str | None = None, tol: float = 1e-3, max_iter: int = 1000,
                 probability: bool = False, n_landmarks: int = MAX_LANDMARKS, seed: int = 42, platt_cv: int | None = 5,
                 multiclass: str = "ovo", landmark_tol: float = LANDMARK_TOL):
        if multiclass not in ("ovo", "ovr"):
            raise ValueError("multiclass must be 'ovo' or 'ovr'")
        self.multiclass = multiclass
        self.C, self.kernel, self.gamma, self.degree, self.coef0 = C, kernel, gamma, degree, coef0
        self.class_weight, self.tol, self.max_iter = class_weight, tol, max_iter
        self.probability, self.n_landmarks, self.seed = probability, n_landmarks, seed
        self.platt_cv, self.landmark_tol = platt_cv, landmark_tol

    def _map(self, df, features):
        if self.kernel == "linear":
            return df.withColumn("_vec", array_to_vector(F.col(features).cast("array<double>")))
        return self.nys_.transform(df, features, "_phi").withColumn("_vec", array_to_vector("_phi")).drop("_phi")

    def fit(self, df: DataFrame, label: str, features: str = "features", key: str | None = None) -> "SVC":
        self.label, self.features = label, features
        counts = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
        if len(counts) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes in {label!r}: not a classification target")
        classes = sorted(r[label] for r in counts)
        n_rows = sum(r["count"] for r in counts)
        if len(classes) < 2:
            raise ValueError("SVC needs at least two classes")
        self.classes_ = classes
        idx = F.element_at(F.create_map(*sum(([F.lit(c), F.lit(float(i))] for i, c in enumerate(classes)), [])),
                           F.col(label))
        data = df.withColumn("_label", idx)
        if self.kernel != "linear":
            if key is None:
                raise ValueError("a kernel SVC needs key= (landmarks are chosen by a seeded hash of the key)")
            self.nys_ = Nystroem(self.kernel, self.gamma, self.degree, self.coef0, self.n_landmarks,
                                 self.seed, self.landmark_tol).fit(df, key, features, n_rows)
        # only what the machines read is kept in memory
        data = spread(self._map(data, features).select("_label", "_vec"), rows=n_rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._fit_linear(data, classes)
            self._note_convergence()
        finally:
            data.unpersist()
        if self.probability:
            self.platt_ = self._fit_platt(df, label, features, key)
        return self

    def _note_convergence(self) -> None:
        """``iterations_`` per machine and ``converged_``: none ran into ``max_iter``."""
        models = self.model_ if isinstance(self.model_, list) else getattr(self.model_, "models", [self.model_])
        self.iterations_ = [m.summary().totalIterations for m in models if m.hasSummary]
        self.converged_ = bool(self.iterations_) and max(self.iterations_) < self.max_iter

    def _fit_linear(self, data: DataFrame, classes: list) -> None:
        wcol = None
        if self.class_weight == "balanced":
            counts = {r[0]: r[1] for r in data.groupBy("_label").count().collect()}
            n, k = sum(counts.values()), len(counts)
            wmap = F.create_map(*sum(([F.lit(c), F.lit(n / (k * m))] for c, m in counts.items()), []))
            data, wcol = data.withColumn("_w", F.element_at(wmap, F.col("_label"))), "_w"
        elif self.class_weight not in (None, "none"):
            raise ValueError("class_weight must be None or 'balanced'")
        k = len(classes)
        if k > 2 and self.multiclass == "ovo":
            self._fit_ovo(data, k, wcol)
            return
        n_eff = data.agg(F.sum(F.col(wcol)) if wcol else F.count(F.lit(1))).first()[0]
        svc = LinearSVC(featuresCol="_vec", labelCol="_label", regParam=1.0 / (self.C * float(n_eff)),
                        standardization=False, maxIter=self.max_iter, tol=self.tol, fitIntercept=True)
        if wcol:
            svc.setWeightCol(wcol)
        # one-vs-rest fits run as concurrent Spark jobs (one per class, up to 8)
        est = svc if k == 2 else OneVsRest(classifier=svc, featuresCol="_vec", labelCol="_label",
                                           parallelism=min(8, k))
        self.model_ = est.fit(data)

    def _fit_ovo(self, data: DataFrame, k: int, wcol: str | None) -> None:
        """One binary machine per class pair (i < j), positive = class i, each
        on the rows of its two classes with regParam = 1 / (C * their weight);
        the pairs are fitted as concurrent Spark jobs."""
        wsum = {r[0]: float(r[1]) for r in data.groupBy("_label").agg(
            F.sum(F.col(wcol)) if wcol else F.count(F.lit(1))).collect()}
        pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]

        def fit(pair):
            i, j = pair
            sub = (data.where(F.col("_label").isin(float(i), float(j)))
                       .withColumn("_pl", (F.col("_label") == float(i)).cast("double")))
            svc = LinearSVC(featuresCol="_vec", labelCol="_pl", standardization=False, maxIter=self.max_iter,
                            tol=self.tol, fitIntercept=True,
                            regParam=1.0 / (self.C * (wsum.get(float(i), 0.0) + wsum.get(float(j), 0.0))))
            if wcol:
                svc.setWeightCol(wcol)
            return svc.fit(sub)

        with ThreadPoolExecutor(max_workers=min(8, len(pairs))) as ex:
            models = list(ex.map(fit, pairs))
        self.pairs_ = pairs
        self.model_ = models

    def _fit_platt(self, df: DataFrame, label: str, features: str, key: str | None) -> list:
        k, folded = len(self.classes_), None
        if self.platt_cv and self.platt_cv > 1:
            if key is None:
                raise ValueError("probability=True needs key= for the internal folds (or platt_cv=None)")
            from tabml.operators.split import kfold
            folded = kfold(df, [key], self.platt_cv, self.seed, stratify=label).cache()

            def held_out(g):
                sub = SVC(C=self.C, kernel=self.kernel, gamma=self.gamma, degree=self.degree, coef0=self.coef0,
                          class_weight=self.class_weight, tol=self.tol, max_iter=self.max_iter, probability=False,
                          n_landmarks=self.n_landmarks, seed=self.seed, multiclass=self.multiclass,
                          landmark_tol=self.landmark_tol)
                sub.fit(folded.where(F.col("fold") != g), label, features, key)
                held = folded.where(F.col("fold") == g)
                return sub._scores(sub._map(held, features)).select(label, "_platt")

            # the folds' machines are concurrent Spark jobs
            with ThreadPoolExecutor(max_workers=min(4, self.platt_cv)) as ex:
                parts = list(ex.map(held_out, range(self.platt_cv)))
            oof = parts[0]
            for p in parts[1:]:
                oof = oof.unionByName(p)
        else:
            oof = self._scores(self._map(df, features)).select(label, "_platt")
        idx = F.element_at(F.create_map(*sum(([F.lit(c), F.lit(i)] for i, c in enumerate(self.classes_)), [])),
                           F.col(label))
        oof = oof.withColumn("_label", idx).cache()
        counts = {int(r[0]): r[1] for r in oof.groupBy("_label").count().collect()}  # one row per class
        # (position in _platt, positive class, classes whose rows it is fitted on)
        if k == 2:
            wanted = [(0, 1, (0, 1))]
        elif isinstance(self.model_, list):
            wanted = [(x, i, (i, j)) for x, (i, j) in enumerate(self.pairs_)]
        else:
            wanted = [(j, j, tuple(range(k))) for j in range(k)]
        try:
            return fit_sigmoids(oof.select(F.col("_platt").cast("array<double>"), F.col("_label").cast("double")), wanted, counts)
        finally:
            oof.unpersist()
            if folded is not None:
                folded.unpersist()

    def _scores(self, mapped: DataFrame) -> DataFrame:
        """Adds ``_score`` (array of per-class decision values), ``_pred`` (index) and
        ``_platt`` (what the sigmoids are fitted on: the margin, pair margins or scores)."""
        if len(self.classes_) == 2:
            out = self.model_.transform(mapped)
            raw = vector_to_array("rawPrediction")
            return out.withColumn("_score", F.array(-raw[1], raw[1])).withColumn("_pred", F.col("prediction")).withColumn(
                "_platt", F.array(raw[1]))
        vec = vector_to_array("_vec")

        def margin(m):
            w = F.array(*[F.lit(float(v)) for v in m.coefficients.toArray()])
            return F.aggregate(F.zip_with(vec, w, lambda a, c: a * c), F.lit(float(m.intercept)),
                               lambda acc, v: acc + v)

        k = len(self.classes_)
        if isinstance(self.model_, list):
            # one-vs-one: votes (margin > 0 -> the pair's first class) decide, the first
            # maximum wins; the score is the library's one-vs-rest shaped transform
            # votes + conf / (3 (|conf| + 1)) with conf the summed pair margins
            dec = {pair: margin(m) for pair, m in zip(self.pairs_, self.model_)}
            votes, conf = [], []
            for c in range(k):
                v = F.lit(0.0)
                cf = F.lit(0.0)
                for (i, j), d in dec.items():
                    if c == i:
                        v = v + F.when(d > 0, 1.0).otherwise(0.0)
                        cf = cf + d
                    elif c == j:
                        v = v + F.when(d > 0, 0.0).otherwise(1.0)
                        cf = cf - d
                votes.append(v)
                conf.append(cf)
            varr = F.array(*votes)
            best = F.array_position(varr, F.array_max(varr)) - 1
            score = F.array(*[v + cf / (3 * (F.abs(cf) + 1)) for v, cf in zip(votes, conf)])
            return mapped.withColumn("_score", score).withColumn("_pred", best.cast("double")).withColumn(
                "_platt", F.array(*dec.values()))
        arr = F.array(*[margin(m) for m in self.model_.models])
        best = F.array_position(arr, F.array_max(arr)) - 1
        return mapped.withColumn("_score", arr).withColumn("_pred", best.cast("double")).withColumn("_platt", arr)

    def decision_function(self, df: DataFrame) -> DataFrame:
        """Input plus ``decision`` (binary: the signed margin of the larger
        class; multi-class: the per-class margins)."""
        s = self._scores(self._map(df, self.features))
        dec = F.col("_score")[1] if len(self.classes_) == 2 else F.col("_score")
        return s.select(*df.columns, dec.alias("decision"))

    def predict(self, df: DataFrame, out_col: str = "prediction") -> DataFrame:
        s = self._scores(self._map(df, self.features))
        lab = F.element_at(F.array(*[F.lit(c) for c in self.classes_]), F.col("_pred").cast("int") + 1)
        cols = [*df.columns, lab.alias(out_col)]
        if self.probability:
            cols.append(self._proba_col().alias("probability"))
        return s.select(*cols)

    def _proba_col(self):
        def sig(m, x):
            return 1.0 / (1.0 + F.exp(-(F.lit(m[0]) * x + F.lit(m[1]))))
        ps = [sig(m, F.col("_platt")[j]) for j, m in enumerate(self.platt_)]
        if len(self.classes_) == 2:
            return F.array(1 - ps[0], ps[0])
        if not isinstance(self.model_, list):
            tot = sum(ps[1:], ps[0])
            return F.array(*[p / tot for p in ps])
        k, pairs = len(self.classes_), self.pairs_

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def coupled(r: pd.Series) -> pd.Series:
            return pd.Series(list(couple(np.array(r.tolist(), dtype=np.float64).reshape(len(r), len(pairs)), pairs, k)))

        return coupled(F.array(*ps))


def fit_sigmoids(rows: DataFrame, wanted: list[tuple[int, int, tuple[int, ...]]], counts: dict[int, int],
                 max_iter: int = 50) -> list[tuple[float, float]]:
    """(slope, intercept) of Platt's sigmoid for every (position, positive class,
    classes) over rows (scores, class index): damped Newton steps, all sigmoids in
    the same pass. The smoothed targets keep separable scores finite."""
    width, tasks = len(rows.first()[0]), rows.rdd.getNumPartitions()
    at = np.array([w[0] for w in wanted])
    member = np.zeros((max(counts) + 1, len(wanted)), dtype=bool)
    target = np.zeros(member.shape)
    for x, (_, c, classes) in enumerate(wanted):
        pos = counts.get(c, 0)
        neg = sum(counts.get(o, 0) for o in classes) - pos
        for o in classes:
            if o < len(member):
                member[o, x], target[o, x] = True, (pos + 1.0) / (pos + 2.0) if o == c else 1.0 / (neg + 2.0)

    def measure(theta: np.ndarray) -> np.ndarray:
        def partial(batches):
            total = np.zeros((6, len(wanted)))
            for b in batches:
                s, c = matrix(b.column(0), width)[:, at], b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                z = theta[:, 0] * s + theta[:, 1]
                p, t, m = 1 / (1 + np.exp(-np.clip(z, -500, 500))), target[c], member[c]
                off, bend = (p - t) * m, p * (1 - p) * m
                total += [((np.logaddexp(0, z) - t * z) * m).sum(axis=0), (off * s).sum(axis=0), off.sum(axis=0),
                          (bend * s * s).sum(axis=0), (bend * s).sum(axis=0), bend.sum(axis=0)]
            return total.ravel()

        return sum_over(rows, partial, tasks).reshape(6, -1)

    theta = np.zeros((len(wanted), 2))
    best = measure(theta)
    step, size = None, np.ones(len(wanted))
    for _ in range(max_iter):
        if step is None:
            _, gs, g1, hss, hs1, h11 = best
            hss, h11 = hss + 1e-12, h11 + 1e-12
            det = hss * h11 - hs1 * hs1
            det = np.where(det > 1e-12 * hss * h11, det, hss * h11)
            step = -np.stack([h11 * gs - hs1 * g1, hss * g1 - hs1 * gs], axis=1) / det[:, None]
            size = np.ones(len(wanted))
        new = measure(theta + size[:, None] * step)
        worse = ~(new[0] <= best[0] + 1e-12 * np.abs(best[0]))
        if worse.any() and size[worse].max() > 1e-6:
            size[worse] /= 4
            continue
        size[worse] = 0.0
        theta, best = theta + size[:, None] * step, np.where(worse, best, new)
        if np.abs(size[:, None] * step).max() <= 1e-8 * (1 + np.abs(theta).max()):
            break
        step = None
    return [(float(a), float(b)) for a, b in theta]


def couple(r: np.ndarray, pairs: list[tuple[int, int]], k: int) -> np.ndarray:
    """Class probabilities (rows, k) from pair probabilities (rows, pairs): r is that
    of the pair's first class. Minimises sum over i != j of (r_ji p_i - r_ij p_j)^2
    with p summing to 1, a linear system per row, all rows solved at once."""
    each = np.zeros((len(r), k, k))
    for x, (i, j) in enumerate(pairs):
        each[:, i, j] = np.clip(r[:, x], 1e-7, 1 - 1e-7)
        each[:, j, i] = 1 - each[:, i, j]
    system = np.ones((len(r), k + 1, k + 1))
    system[:, :k, :k] = -each * np.swapaxes(each, 1, 2)
    system[:, range(k), range(k)] = (each ** 2).sum(axis=1)
    system[:, k, k] = 0.0
    right = np.zeros((len(r), k + 1, 1))
    right[:, k] = 1.0
    p = np.maximum(np.linalg.solve(system, right)[:, :k, 0], 0.0)
    return p / p.sum(axis=1, keepdims=True)


LOSSES = ("epsilon_insensitive", "squared_epsilon_insensitive")


class SVR:
    """``max_iter`` bounds the passes of the absolute and the steps of the squared loss."""

    def __init__(self, C: float = 1.0, epsilon: float = 0.1, kernel: str = "rbf", gamma="scale", degree: int = 3,
                 coef0: float = 0.0, max_iter: int = 300, tol: float = 1e-5, n_landmarks: int = MAX_LANDMARKS,
                 seed: int = 42, loss: str = "epsilon_insensitive", landmark_tol: float = LANDMARK_TOL):
        if loss not in LOSSES:
            raise ValueError(f"loss must be one of {LOSSES}")
        self.C, self.epsilon, self.kernel, self.gamma = C, epsilon, kernel, gamma
        self.degree, self.coef0, self.max_iter, self.tol = degree, coef0, max_iter, tol
        self.n_landmarks, self.seed, self.loss, self.landmark_tol = n_landmarks, seed, loss, landmark_tol

    def _map(self, df: DataFrame, features: str) -> DataFrame:
        if self.kernel == "linear":
            return df.withColumn("_z", F.col(features).cast("array<double>"))
        return self.nys_.transform(df, features, "_z")

    def fit(self, df: DataFrame, label: str, features: str = "features", key: str | None = None) -> "SVR":
        self.label, self.features = label, features
        if self.kernel != "linear" and key is None:
            raise ValueError("a kernel SVR needs key= (landmark ties are broken by a seeded hash of the key)")
        # the input is read once: landmarks and machine take the kept rows
        cols = [F.col(features).cast("array<double>").alias("_x"), F.col(label).cast("double").alias("_y")]
        base = df.select(*cols, *([] if self.kernel == "linear" else [F.col(key).alias("_k")])).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = base.count()
            if self.kernel != "linear":
                self.nys_ = Nystroem(self.kernel, self.gamma, self.degree, self.coef0, self.n_landmarks,
                                     self.seed, self.landmark_tol).fit(base, "_k", "_x", n)
            self._fit_machine(spread(base.select("_x", "_y"), rows=n))
        finally:
            base.unpersist()
        return self

    def _fit_machine(self, rows: DataFrame) -> None:
        """Fit on rows (_x, _y)."""
        C, eps, tasks = float(self.C), float(self.epsilon), rows.rdd.getNumPartitions()
        if self.loss == "epsilon_insensitive":
            dim, made = 0, None
            if self.kernel == "linear":
                dim = len(rows.first()["_x"])
            else:
                dim, made = self.nys_.norm_.shape[1], FeatureMap(self.nys_.landmarks_.shape[1], self.nys_.values, self.nys_.norm_)
            f = fit_tube(rows, dim, C, eps, self.tol, self.max_iter, tasks, made)
            self.coef_, self.intercept_, self.objective_ = f.coef, f.intercept, f.objective
            self.gap_, self.converged_, self.n_iter_ = f.gap, f.converged, f.passes
            return
        data = self._map(rows, "_x").select("_z", "_y").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._fit_squared(data, len(data.first()["_z"]), C, eps, tasks)
        finally:
            data.unpersist()

    def _fit_squared(self, data: DataFrame, d: int, C: float, eps: float, tasks: int) -> None:
        theta = np.zeros(d + 1)
        reg = np.eye(d + 1)
        reg[d, d] = 0.0
        best, best_obj = theta, None
        self.n_iter_, self.converged_ = 0, False
        while self.n_iter_ < self.max_iter and not self.converged_:
            self.n_iter_ += 1
            g, r, loss = self._pass(data, theta, d, eps, tasks)
            obj = 0.5 * float(theta[:d] @ theta[:d]) + C * loss
            if best_obj is not None and obj > best_obj * (1 + 1e-12) + 1e-12:
                # the full step overshot: back off halfway toward the last accepted point
                theta = best + 0.5 * (theta - best)
                self.converged_ = float(np.max(np.abs(theta - best))) <= 1e-10 * (1.0 + float(np.max(np.abs(best))))
                continue
            best, best_obj = theta, obj
            new = np.linalg.solve(reg + 2 * C * g + 1e-12 * np.eye(d + 1), 2 * C * r)
            # a Newton step on an unchanged active set lands on the exact minimum
            self.converged_ = float(np.max(np.abs(new - theta))) <= 1e-9 * (1.0 + float(np.max(np.abs(theta))))
            theta = new
        if not self.converged_:
            warnings.warn(f"squared epsilon-insensitive fit: not converged after {self.n_iter_} steps")
        self.coef_, self.intercept_, self.objective_, self.gap_ = best[:d], float(best[d]), best_obj, None

    @staticmethod
    def _pass(data: DataFrame, th: np.ndarray, d: int, eps: float, tasks: int):
        """One distributed pass: ``Z^T Z`` and ``Z^T t`` over the rows outside
        the tube, and the tube loss."""

        def partial(batches):
            g = np.zeros((d + 1, d + 1))
            r = np.zeros(d + 1)
            loss = 0.0
            for b, part in ((b, part) for b in batches for part in blocks(b.num_rows, d + 1)):
                z = matrix(b.column(0), d)[part]
                z = np.column_stack([z, np.ones(len(z))])
                y = b.column(1).to_numpy(zero_copy_only=False)[part]
                res = y - z @ th
                act = np.abs(res) > eps
                za, ta = z[act], y[act] - np.sign(res[act]) * eps
                g += za.T @ za
                r += za.T @ ta
                loss += float(((np.abs(res[act]) - eps) ** 2).sum())
            return np.concatenate([g.ravel(), r, [loss]])

        vec = sum_over(data, partial, tasks)
        return (vec[:(d + 1) ** 2].reshape(d + 1, d + 1), vec[(d + 1) ** 2:(d + 1) ** 2 + d + 1],
                float(vec[-1]))

    def predict(self, df: DataFrame, out_col: str = "prediction") -> DataFrame:
        if self.kernel != "linear":
            return self.nys_.linear(df, self.features, self.coef_, self.intercept_, "_p").select(*df.columns, F.col("_p").alias(out_col))
        mapped = self._map(df, self.features)
        w = F.array(*[F.lit(float(v)) for v in self.coef_])
        dot = F.aggregate(F.zip_with(F.col("_z"), w, lambda a, b: a * b), F.lit(self.intercept_),
                          lambda acc, v: acc + v)
        return mapped.select(*df.columns, dot.alias(out_col))


def svm_insight(model: SVC, df: DataFrame, key: str, n_ids: int = 20) -> DataFrame:
    """Per class of a linear-map machine, binary, one-vs-one or one-vs-rest: support-vector
    count (training rows on or inside a margin, ``y * f(x) <= 1``, of any machine
    of their class), the first ``n_ids`` support keys in key order, the machines
    of the class (of one-vs-rest: the one that tells it from the rest), their
    intercepts, and the coefficients of one.  ``intercept`` is the single
    machine's, null with several."""
    every = range(len(model.classes_))
    # (positive classes, negative classes, machine)
    if isinstance(model.model_, list):
        machines = [([a], [b], m) for (a, b), m in zip(model.pairs_, model.model_)]
    elif len(model.classes_) == 2:
        machines = [([1], [0], model.model_)]  # a positive margin is the second class
    else:
        machines = [([c], [x for x in every if x != c], m) for c, m in zip(every, model.model_.models)]
    rest = len(model.classes_) > 2 and not isinstance(model.model_, list)
    mapped = model._map(df, model.features)
    vec = vector_to_array("_vec")
    inside = F.lit(False)
    for pos, neg, m in machines:
        w = F.array(*[F.lit(float(v)) for v in m.coefficients.toArray()])
        margin = F.aggregate(F.zip_with(vec, w, lambda a, b: a * b), F.lit(float(m.intercept)), lambda acc, v: acc + v)
        for classes, sign in ((pos, 1.0), (neg, -1.0)):
            inside = inside | (F.col(model.label).isin([model.classes_[c] for c in classes]) & (sign * margin <= 1.0 + 1e-9))
    sv = mapped.where(inside).select(F.col(model.label).alias("label"), key)
    counts = sv.groupBy("label").agg(F.count(F.lit(1)).alias("n_support"))
    # first ids: a per-class top-n (WindowGroupLimit), never a whole class in one list
    w = Window.partitionBy("label").orderBy(key)
    first = (sv.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n_ids)
               .groupBy("label").agg(F.array_sort(F.collect_list(key)).alias("first_support_ids")))
    own = {c: [float(m.intercept) for pos, neg, m in machines if c in pos or (c in neg and not rest)] for c in every}
    info = F.create_map(*sum(([F.lit(model.classes_[c]), F.array(*[F.lit(x) for x in v])] for c, v in own.items()), []))
    one = machines[0][2]
    return counts.join(first, "label").select(
        "label", "n_support", "first_support_ids",
        F.lit(float(one.intercept) if len(machines) == 1 else None).cast("double").alias("intercept"),
        F.lit(int(one.numFeatures)).alias("n_coefficients"), F.size(F.element_at(info, F.col("label"))).alias("n_machines"),
        F.element_at(info, F.col("label")).alias("intercepts"))


def decision_preview(model: SVC, df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first ``n`` rows in key order: key, true label, prediction, decision
    scores (one per class, or the binary margin and its negative) and their number."""
    few = df.orderBy(key).limit(n)
    scored = model._scores(model._map(few, model.features))
    names = F.array(*[F.lit(c) for c in model.classes_])
    return scored.select(key, F.col(model.label).alias("label"), F.element_at(names, F.col("_pred").cast("int") + 1).alias("prediction"),
                         F.col("_score").alias("decision"), F.size("_score").alias("n_scores"))
