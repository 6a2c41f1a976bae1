"""Feature preprocessing: fit on a DataFrame, transform any DataFrame.

Fitting is a handful of aggregations whose results are small (one number per
column, the category list of each categorical column, a d x d covariance).
Transforming is a single projection of column expressions (imputation by
``coalesce``, one-hot by comparisons, ordinal codes by a literal map, scaling
by arithmetic, PCA by dot products), so it compiles into one whole-stage
codegen span with no shuffle and no Python worker.

Conventions (public library semantics the reference relies on):

* median imputation of numeric columns, exact and interpolated;
* most-frequent imputation of categorical columns, ties to the smallest value;
* one-hot over the sorted categories seen in fit, unknown -> all zeros;
* ordinal codes 0..k-1 over the sorted categories, unknown -> -1;
* output order: numeric block, then categorical block; other columns dropped;
* standard scaler with population std, min-max and robust (median, IQR)
  scalers; a zero scale becomes 1 (constant column -> 0);
* PCA centres, keeps the top components of the covariance, and flips each
  component's sign so that its largest-magnitude loading is positive.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions.rank import exact_quantiles_multi

MAX_CATEGORIES = 10_000
ENCODERS = ("ohe", "ordinal")
SCALERS = ("standard", "minmax", "robust")


# --------------------------------------------------------------------------- imputers

def fit_median(df: DataFrame, cols: list[str]) -> dict:
    return {c: v[0] for c, v in exact_quantiles_multi(df, cols, [0.5]).items()}


def fit_mode(df: DataFrame, cols: list[str]) -> dict:
    """Most frequent non-null value per column; ties -> smallest value."""
    out = {}
    for c in cols:
        top = (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
                 .orderBy(F.desc("_n"), F.asc(c)).limit(1).collect())
        out[c] = top[0][c] if top else None
    return out


def fit_mode_and_categories(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES):
    """(mode, sorted categories) from one grouped count (bounded by the
    category limit, checked)."""
    rows = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("v"))
              .agg(F.count(F.lit(1)).alias("n")).limit(max_categories + 1).collect())
    if len(rows) > max_categories:
        raise ValueError(f"column {col!r} has more than {max_categories} categories")
    if not rows:
        return None, []
    mode = min(rows, key=lambda r: (-r["n"], r["v"]))["v"]
    return mode, sorted(r["v"] for r in rows)


def impute(df: DataFrame, fills: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items() if v is not None})


# --------------------------------------------------------------------------- encoders

def fit_categories(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES) -> list:
    vals = [r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct()
            .limit(max_categories + 1).collect()]
    if len(vals) > max_categories:
        raise ValueError(f"column {col!r} has more than {max_categories} categories")
    return sorted(vals)


def one_hot_exprs(col: str | Column, name: str, categories: list) -> list[Column]:
    c = F.col(col) if isinstance(col, str) else col
    return [F.when(c == F.lit(v), 1.0).otherwise(0.0).alias(f"{name}_{v}") for v in categories]


def ordinal_expr(col: str | Column, categories: list) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if not categories:
        return F.lit(-1.0)
    items = []
    for i, v in enumerate(categories):
        items += [F.lit(v), F.lit(float(i))]
    return F.coalesce(F.element_at(F.create_map(*items), c), F.lit(-1.0))


# --------------------------------------------------------------------------- roles

def is_numeric(dt) -> bool:
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                           T.DoubleType, T.DecimalType))


def is_categorical(dt) -> bool:
    return isinstance(dt, (T.StringType, T.BooleanType))


def is_vector(dt) -> bool:
    return isinstance(dt, T.ArrayType) and is_numeric(dt.elementType)


# --------------------------------------------------------------------------- the fitted transformer

@dataclass
class PreprocessModel:
    numeric: list = field(default_factory=list)        # [[name, median]]
    vectors: list = field(default_factory=list)        # [[name, dim]]
    categorical: list = field(default_factory=list)    # [[name, mode, [categories]]]
    cat_encoder: str = "ohe"
    scaler: str | None = None
    center: list = field(default_factory=list)
    scale: list = field(default_factory=list)
    pca_mean: list = field(default_factory=list)
    pca_components: list = field(default_factory=list)  # k x d
    pca_variance: list = field(default_factory=list)
    input_names: list = field(default_factory=list)

    # -- matrix columns before scaling
    def matrix_names(self) -> list[str]:
        names = [n for n, _ in self.numeric]
        for n, dim in self.vectors:
            names += [f"{n}_{i}" for i in range(dim)]
        for n, _, cats in self.categorical:
            names += [f"{n}_{v}" for v in cats] if self.cat_encoder == "ohe" else [n]
        return names

    def feature_names(self) -> list[str]:
        if self.pca_components:
            return [f"pca{i}" for i in range(len(self.pca_components))]
        return self.matrix_names()

    def matrix_exprs(self) -> list[Column]:
        ex = [F.coalesce(F.col(n).cast("double"), F.lit(m)) for n, m in self.numeric]
        for n, dim in self.vectors:
            arr = F.col(n).cast("array<double>")
            ex += [arr[i] for i in range(dim)]
        for n, mode, cats in self.categorical:
            c = F.coalesce(F.col(n).cast("string"), F.lit(mode))
            if self.cat_encoder == "ohe":
                ex += [F.when(c == F.lit(v), 1.0).otherwise(0.0) for v in cats]
            else:
                ex.append(ordinal_expr(c, cats))
        return ex

    def feature_exprs(self) -> list[Column]:
        ex = self.matrix_exprs()
        if self.scaler:
            ex = [(e - F.lit(c)) / F.lit(s) for e, c, s in zip(ex, self.center, self.scale)]
        if self.pca_components:
            ex = [sum(((e - F.lit(m)) * F.lit(w) for e, m, w in zip(ex, self.pca_mean, comp)), F.lit(0.0))
                  for comp in self.pca_components]
        return ex

    def transform(self, df: DataFrame, out_col: str = "features", keep: list[str] | None = None) -> DataFrame:
        missing = [c for c in self.input_names if c not in df.columns]
        if missing:
            raise ValueError(f"missing input columns: {missing}")
        keep = list(keep) if keep is not None else [c for c in df.columns if c not in self.input_names]
        return df.select(*keep, F.array(*self.feature_exprs()).alias(out_col))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, s: str) -> "PreprocessModel":
        return cls(**json.loads(s))


class Preprocess:
    """Column transformer + optional scaler + optional PCA (fit on train only)."""

    def __init__(self, numeric: list[str] | None = None, categorical: list[str] | None = None,
                 cat_encoder: str = "ohe", scaler: str | None = None, pca: int | None = None,
                 max_categories: int = MAX_CATEGORIES):
        if cat_encoder not in ENCODERS:
            raise ValueError(f"cat_encoder {cat_encoder!r} is unknown: {' or '.join(ENCODERS)}")
        self.numeric, self.categorical, self.cat_encoder = numeric, categorical, cat_encoder
        self.scaler = normalize_scaler(scaler)
        self.pca, self.max_categories = pca, max_categories

    def fit(self, df: DataFrame, features: list[str]) -> PreprocessModel:
        # several aggregates read the same feature columns: persist just those
        df = df.select(*features).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._fit(df, features)
        finally:
            df.unpersist()

    def _fit(self, df: DataFrame, features: list[str]) -> PreprocessModel:
        sch = {f.name: f.dataType for f in df.schema.fields}
        cat = self.categorical if self.categorical is not None else [c for c in features if is_categorical(sch[c])]
        num = self.numeric if self.numeric is not None else [c for c in features if c not in cat]
        vec = [c for c in num if is_vector(sch[c])]
        num = [c for c in num if c not in vec]
        bad = [c for c in num if not is_numeric(sch[c])]
        if bad:
            raise ValueError(f"unsupported feature types (cast them first): {[(c, sch[c].simpleString()) for c in bad]}")
        m = PreprocessModel(cat_encoder=self.cat_encoder, input_names=list(features))
        med = fit_median(df, num)
        m.numeric = [[c, med[c]] for c in num]
        for c in vec:
            dims = df.agg(F.min(F.size(c)).alias("a"), F.max(F.size(c)).alias("b")).first()
            if dims["a"] != dims["b"]:
                raise ValueError(f"vector column {c!r} has varying length")
            m.vectors.append([c, int(dims["a"])])
        for c in cat:
            mode, cats = fit_mode_and_categories(df, c, self.max_categories)
            m.categorical.append([c, mode, cats])
        if self.scaler or self.pca:
            mat = df.select(*[e.alias(f"_m{i}") for i, e in enumerate(m.matrix_exprs())])
            names = mat.columns
            if self.scaler:
                m.scaler = self.scaler
                m.center, m.scale = fit_scaler(mat, names, self.scaler)
        if self.pca:
            width = len(m.matrix_names())
            if width < 2:
                return m  # one encoded feature has nothing to project: PCA is off
            if self.pca > width:
                raise ValueError(f"pca n_components={self.pca} exceeds the feature count {width}")
            scaled = df.select(*[e.alias(f"_s{i}") for i, e in enumerate(m.feature_exprs())])
            mean, comps, var = fit_pca(scaled, scaled.columns, self.pca)
            m.pca_mean, m.pca_components, m.pca_variance = mean, comps, var
        return m


def normalize_scaler(s: str | None) -> str | None:
    """The scaler's name, None for no scaling."""
    if s is None or s in SCALERS:
        return s
    raise ValueError(f"scaler {s!r} is unknown: None, {' or '.join(SCALERS)}")


def fit_scaler(df: DataFrame, cols: list[str], kind: str) -> tuple[list[float], list[float]]:
    """(center, scale) per column; a zero scale becomes 1."""
    if kind == "robust":
        qs = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75])
        center = [qs[c][1] for c in cols]
        scale = [qs[c][2] - qs[c][0] for c in cols]
    else:
        aggs = []
        for c in cols:
            if kind == "standard":
                aggs += [F.avg(c), F.stddev_pop(c)]
            else:
                aggs += [F.min(c).cast("double"), (F.max(c) - F.min(c)).cast("double")]
        row = df.agg(*aggs).first() if aggs else []
        center = [row[2 * i] for i in range(len(cols))]
        scale = [row[2 * i + 1] for i in range(len(cols))]
    scale = [1.0 if (s is None or abs(s) < 10 * np.finfo(float).eps) else s for s in scale]
    return center, scale


def gram(df: DataFrame, cols: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, column means, centred X^T X).

    Two passes: one ``agg`` for the means, then per-batch NumPy partial sums of
    the centred cross products inside the tasks, combined by one Spark sum per
    matrix cell (d + d^2 numbers reach the driver).  Centring before
    multiplying avoids the cancellation of ``X^T X - n mu mu^T``."""
    d = len(cols)
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)]).first()
    n = int(row["_n"])
    mean = np.array([row[f"_m{i}"] or 0.0 for i in range(d)], dtype=np.float64)

    def partial(it):
        g = np.zeros((d, d))
        for pdf in it:
            x = pdf[cols].to_numpy(dtype=np.float64) - mean
            g += x.T @ x
        yield pd.DataFrame({"g": [g.ravel().tolist()]})

    parts = df.select(*cols).mapInPandas(partial, "g array<double>")
    cells = parts.select(F.posexplode("g").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    gv = np.zeros(d * d)
    for r in cells:
        gv[r["i"]] = r["v"]
    return n, mean, gv.reshape(d, d)


def covariance(df: DataFrame, cols: list[str], ddof: int = 0) -> np.ndarray:
    n, _, g = gram(df, cols)
    return g / (n - ddof)


def fit_pca(df: DataFrame, cols: list[str], k: int):
    n, mean, g = gram(df, cols)
    cov = g / max(1, n - 1)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1][:k]
    comps = vecs[:, order].T
    for i in range(comps.shape[0]):
        j = np.argmax(np.abs(comps[i]))
        if comps[i, j] < 0:
            comps[i] = -comps[i]
    return mean.tolist(), comps.tolist(), vals[order].tolist()
