"""Exact k-nearest neighbours as a pruned Spark join.

Two large sides (no cross join, no pair rows, no unbounded broadcast):

1. Pivots are training rows of lowest seeded hash, a bounded number. Every training
   row belongs to the cell of its nearest pivot. Per cell one summary: rows, least and
   largest distance to the pivot, and the k least.
2. Every test row gets an upper bound of its k-th distance from the summaries
   (distance to a pivot plus the pivot's own k least), and is sent only to cells that
   the triangle inequality doesn't rule out: by the cell's ring around its pivot,
   and by the half-way plane between the nearest pivot and the cell's.
3. Cells of more than ``block_rows`` training or test rows are cut by a hash of the
   keys, and each pair of cuts meets in ``cogroup(...).applyInPandas``. Cuts grow with
   the table only up to what their rows and neighbour lists may take in a Python
   worker (``_cut_rows``), so memory is bounded whatever the rows' number and skew.
   NumPy emits only the k best per test row (ties: smaller train key), and the lists
   are merged by ``row_number() <= k`` (Spark plans a ``WindowGroupLimit`` before the
   shuffle).

How many cells a row visits depends on how clustered the data are, not on their
number; without any structure it is all of them, so there are few large cells
rather than many small ones.  With ``group`` (grid search: other features per
group) every group has pivots and cells of its own, in the same jobs.

Where rows meet, the training rows lie in leaves with bounding boxes
(``_Index``): test rows that lie close together meet only the leaves that may
hold one of their nearest, or, where boxes spare less than half, all rows,
screened by one float product (p=2) or 16-bit sums (p=1) against the k-th
distance so far.

Small training side: when ``n_train * (d + 2) * 8`` bytes is within
``broadcast_bytes`` (checked from the counted rows and the vector length
before anything is collected), the indexed training rows are broadcast once per
executor and every test partition computes its neighbours in place with
``mapInPandas``: no shuffle of the (possibly huge) scoring side at all.  This
is the batch-scoring case: a bounded model, an unbounded table to score.

Distances are rounded to 10 significant digits so that float noise cannot
reorder mathematically equal distances, whatever the scale of the features;
ties are then broken by the train key.
The neighbour list (``neighbors``) is the shared intermediate: one list of
``k_max`` neighbours serves every ``n_neighbors <= k_max`` and both weightings
(``vote``, ``proba``, ``regress``), which grid search exploits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions.hashing import order_hash
from tabml.functions.sums import matrix
from tabml.session import written

DIST_DIGITS = 10  # significant
#: bytes of a training side that goes to every Python worker (each holds a copy of its own)
_BROADCAST = 128 << 20
_CHUNK_CELLS = 4_000_000  # distance-matrix cells computed per NumPy step


def _significant(d: np.ndarray) -> np.ndarray:
    """Distances at ``DIST_DIGITS`` significant digits; 0 stays 0."""
    unit = np.power(10.0, DIST_DIGITS - 1 - np.floor(np.log10(np.where(d > 0, d, 1.0))))
    return np.round(d * unit) / unit


def _minkowski(q: np.ndarray, x: np.ndarray, p: float) -> np.ndarray:
    diff = np.abs(q[:, None, :] - x[None, :, :])
    if p == 2:
        return np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    if p == 1:
        return diff.sum(axis=2)
    return np.power(np.power(diff, p).sum(axis=2), 1.0 / p)


def _exact_rows(q: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray, p: float) -> np.ndarray:
    diff = np.abs(q[rows] - x[cols])
    if p == 2:
        return np.sqrt(np.einsum("ij,ij->i", diff, diff))
    if p == 1:
        return diff.sum(axis=1)
    return np.power(np.power(diff, p).sum(axis=1), 1.0 / p)


def _topk_chunk(q: np.ndarray, x: np.ndarray, x2: np.ndarray, kk: int, p: float):
    """k nearest (distance rounded, then train position) for each row of ``q``.

    Screening: an approximate distance for every pair (for p=2 one matrix
    product, ``|q|^2 + |x|^2 - 2 q.x``), then every pair within a margin that
    exceeds the float error of the approximation of the k-th value is
    re-measured exactly by differences.  Ordering the candidates by (rounded
    exact distance, position) gives the same k as a full exact sort."""
    if p == 2:
        q2 = np.einsum("ij,ij->i", q, q)
        approx = q2[:, None] + x2[None, :] - 2.0 * (q @ x.T)
        kth = np.partition(approx, kk - 1, axis=1)[:, kk - 1]
        # the margin covers (a) the float error of the expansion (~1e-16 of the
        # squared norms) and (b) the rounding window: distances that round to the
        # k-th one's value differ by < 1e-9 of it, i.e. < 2e-9 of its square
        margin = 4e-9 * np.maximum(kth, 0.0) + 1e-12 * (q2 + x2.max())
        rows, cols = np.nonzero(approx <= (kth + margin)[:, None])
    else:
        d_full = _minkowski(q, x, p)
        kth = np.partition(d_full, kk - 1, axis=1)[:, kk - 1]
        rows, cols = np.nonzero(d_full <= (kth * (1 + 4e-9))[:, None])
    d = _significant(_exact_rows(q, x, rows, cols, p))
    order = np.lexsort((cols, d, rows))
    rows, cols, d = rows[order], cols[order], d[order]
    # first kk entries of each row (every row has at least kk candidates)
    starts = np.searchsorted(rows, np.arange(q.shape[0]))
    take = (starts[:, None] + np.arange(kk)[None, :]).ravel()
    return rows[take], cols[take], d[take]


#: training rows of a leaf, test rows searched together, training rows met at once where pruning doesn't help
_LEAF, _TEAM, _SLAB = 128, 32, 8192
#: candidate pairs measured at once, and columns up to which 16 bits tell Manhattan distances apart
_SOME, _SHORT_DIMS = 1 << 16, 1000


def _pieces(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers, ascending, of pieces of at most ``most`` rows that lie close together:
    halved at a value of the widest column, so equal rows stay in one piece, however many."""
    todo, out = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        part = x[rows]
        width = np.ptp(part, axis=0) if part.size else np.zeros(1)
        if len(rows) <= most or not width.max() > 0:
            out.append(rows)
            continue
        v = part[:, width.argmax()]
        low = v < np.partition(v, len(v) // 2)[len(v) // 2]
        if not low.any():
            low = v <= v.min()
        todo += [rows[~low], rows[low]]
    return out


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class _Index:
    """Training rows (in the order that breaks ties) in leaves with bounding boxes.

    ``search`` meets teams of test rows that lie close together with the leaves that
    may hold one of their nearest. Of a leaf whose rows are all equal only the first k
    can. Teams that the boxes spare less than half of the rows meet them all, slab by
    slab, against the distance of the k-th found so far."""

    def __init__(self, x: np.ndarray) -> None:
        if not np.isfinite(x).all():
            raise ValueError("features hold nulls or values that are not finite")
        leaves = _pieces(x, _LEAF)
        self.place = np.concatenate(leaves)
        self.x = x[self.place]
        self.sizes = np.array([len(i) for i in leaves])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.lo, self.hi = (f.reduceat(self.x, self.starts, axis=0) for f in (np.minimum, np.maximum))
        self.equal = (self.lo == self.hi).all(axis=1)

    def __len__(self) -> int:
        return len(self.x)

    def search(self, q: np.ndarray, k: int, p: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of q, training row, distance) of the k nearest of each row, in order."""
        if not np.isfinite(q).all():
            raise ValueError("features hold nulls or values that are not finite")
        kk = min(k, len(self.x))
        if q.shape[1] == 0 or not len(q):
            c = np.tile(np.sort(self.place)[:kk], len(q))
            return np.repeat(np.arange(len(q)), kk), c, np.zeros(len(c))
        cols, dist = np.empty((len(q), kk), dtype=np.int64), np.empty((len(q), kk))
        sizes = np.where(self.equal, np.minimum(self.sizes, kk), self.sizes)
        wide, vain = [], 0
        for team in _pieces(q, _TEAM):
            one = len(team) > _TEAM  # equal rows have the same neighbours
            found = self._near(q[team[:1]] if one else q[team], kk, p, sizes) if vain < 8 else None
            if found is None:
                vain += 1
                wide.append(team[:1] if one else team)
                if one:
                    wide.append(team)  # filled in from its first row below
            else:
                vain = 0
                cols[team], dist[team] = found
        rows = [t for t in wide if len(t) <= _TEAM]
        if rows:
            rows = np.concatenate(rows)
            step = max(1, min(512, _CHUNK_CELLS // _SLAB))
            for a in range(0, len(rows), step):
                cols[rows[a:a + step]], dist[rows[a:a + step]] = self._all(q[rows[a:a + step]], kk, p)
            for t in wide:
                if len(t) > _TEAM:
                    cols[t], dist[t] = cols[t[0]], dist[t[0]]
        return np.repeat(np.arange(len(q)), kk), cols.ravel(), dist.ravel()

    def _near(self, q: np.ndarray, kk: int, p: float, sizes: np.ndarray):
        """(k places, k distances) for each row of a team, or None where the boxes don't prune."""
        gap = np.maximum(0.0, np.maximum(self.lo - q.max(axis=0), q.min(axis=0) - self.hi))
        least = (np.sqrt(np.einsum("ij,ij->i", gap, gap)) if p == 2 else gap.sum(axis=1) if p == 1
                 else np.power(np.power(gap, p).sum(axis=1), 1.0 / p)) * (1 - 1e-12)
        m = min(len(least), 4 * (kk // _LEAF + 1))
        near = np.argpartition(least, m - 1)[:m]
        if sizes[near].sum() < kk:
            by = np.argsort(least)
            near = by[:np.searchsorted(np.cumsum(sizes[by]), kk) + 1]
        _, d = self._topk(q, near, kk, p, sizes)
        reach = d[:, -1].max() * (1 + 4e-9)
        near = np.flatnonzero(least <= reach)
        if len(self.x) > 2 * _SLAB and 2 * sizes[near].sum() > len(self.x):
            return None
        return self._topk(q, near, kk, p, sizes)

    def _topk(self, q: np.ndarray, leaves: np.ndarray, kk: int, p: float, sizes: np.ndarray):
        return self._best(q, _runs(self.starts[leaves], sizes[leaves]), kk, p)

    def _best(self, q: np.ndarray, at: np.ndarray, kk: int, p: float):
        """(k places, k distances) for each row of ``q`` among the rows ``at``."""
        at = at[np.argsort(self.place[at])]
        x = self.x[at]
        x2 = np.einsum("ij,ij->i", x, x)
        step = max(1, _CHUNK_CELLS // (len(x) * (1 if p == 2 else x.shape[1])))
        found = [_topk_chunk(q[a:a + step], x, x2, kk, p) for a in range(0, len(q), step)]
        return (np.concatenate([self.place[at[c]] for _, c, _ in found]).reshape(-1, kk),
                np.concatenate([d for _, _, d in found]).reshape(-1, kk))

    def _all(self, q: np.ndarray, kk: int, p: float):
        """(k places, k distances) for each row of ``q`` among all rows."""
        first = min(len(self.x), max(kk, _SLAB // 4))
        place, d = self._best(q, np.arange(first), kk, p)
        row = np.repeat(np.arange(len(q)), kk)
        place, d = place.ravel(), d.ravel()
        near = self._screen(q, p)
        for a in range(first, len(self.x), _SLAB):
            b = min(a + _SLAB, len(self.x))
            kth = d[kk - 1::kk]
            r, c = near(a, b, kth * (1 + 4e-9))
            if not len(r):
                continue
            new = np.concatenate([_significant(_exact_rows(q, self.x[a:b], r[z:z + _SOME], c[z:z + _SOME], p)) for z in range(0, len(r), _SOME)])
            r, c, new = (v[new <= kth[r]] for v in (r, c, new))
            row, place, d = np.concatenate([row, r]), np.concatenate([place, self.place[a + c]]), np.concatenate([d, new])
            order = np.lexsort((place, d, row))
            row, place, d = row[order], place[order], d[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < kk
            row, place, d = row[keep], place[keep], d[keep]
        return place.reshape(-1, kk), d.reshape(-1, kk)

    def _screen(self, q: np.ndarray, p: float):
        """``near(a, b, limit)``: (row, column) of rows a to b that may be within each row's limit."""
        dim = q.shape[1]
        if p == 2:  # one product: q.x - |x|^2 / 2 is at least (|q|^2 - limit^2) / 2
            mid = (self.lo.min(axis=0) + self.hi.max(axis=0)) / 2
            wide = np.hstack([q - mid, np.ones((len(q), 1))])
            q2 = np.einsum("ij,ij->i", wide, wide) - 1
            most = (np.maximum(np.abs(self.lo - mid), np.abs(self.hi - mid)) ** 2).sum(axis=1).max()
            wrong = (dim + 4) * (np.sqrt(q2 * most) + most / 2)
            def near(a, b, limit):
                x = self.x[a:b] - mid
                kind, eps = (np.float32, 1.2e-7) if 1.2e-7 * np.median(wrong) < 1e-3 * np.median(limit) ** 2 else (np.float64, 1e-14)
                other = np.hstack([x, -0.5 * np.einsum("ij,ij->i", x, x)[:, None]]).astype(kind)
                floor = ((q2 - limit ** 2) / 2 - eps * (wrong + q2)).astype(kind)
                return np.divmod(np.flatnonzero(wide.astype(kind) @ other.T >= floor[:, None]), b - a)
        elif p == 1 and dim <= _SHORT_DIMS:  # whole steps of each column in 16 bits, each wrong by half a step at most
            lo, hi = self.lo.min(axis=0), self.hi.max(axis=0)
            step = (hi - lo).max() / (32000 // dim)
            inside = np.clip(q, lo, hi)
            own = np.round((inside - lo) / step).astype(np.int16)
            beyond = np.abs(q - inside).sum(axis=1)
            def near(a, b, limit):
                x = np.ascontiguousarray(np.round((self.x[a:b] - lo) / step).astype(np.int16).T)
                most = np.minimum((limit - beyond) / step + dim + 1, 32766).astype(np.int64)
                out = []
                for s in range(0, len(q), 16):
                    sums, gap = np.zeros((2, min(16, len(q) - s), b - a), dtype=np.int16)
                    for j in range(dim):
                        np.subtract(x[j][None, :], own[s:s + 16, j, None], out=gap)
                        np.absolute(gap, out=gap)
                        np.add(sums, gap, out=sums)
                    out.append(np.flatnonzero(sums <= np.maximum(most[s:s + 16], -1).astype(np.int16)[:, None]) + s * (b - a))
                return np.divmod(np.concatenate(out), b - a)
        else:
            def near(a, b, limit):
                step = max(1, _CHUNK_CELLS // ((b - a) * dim))
                out = [np.flatnonzero(_minkowski(q[s:s + step], self.x[a:b], p) <= limit[s:s + step, None]) + s * (b - a) for s in range(0, len(q), step)]
                return np.divmod(np.concatenate(out), b - a)
        return near


def _block_topk(k: int, p: float):
    def fn(train: pd.DataFrame, test: pd.DataFrame) -> pd.DataFrame:
        cols = ["_g", "qk", "tk", "dist", "y"]
        if train.empty or test.empty:
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in cols})
        g = train["_g"].iloc[0]
        train = train.sort_values("_tk", kind="stable").reset_index(drop=True)
        index = _Index(np.stack(train["_x"].to_numpy()).astype(np.float64))
        r, c, d = index.search(np.stack(test["_x"].to_numpy()).astype(np.float64), k, p)
        return pd.DataFrame({
            "_g": np.full(len(r), g), "qk": test["_qk"].to_numpy()[r], "tk": train["_tk"].to_numpy()[c],
            "dist": d, "y": train["_y"].to_numpy()[c],
        })
    return fn


def _rows(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if column.null_count:
        raise ValueError("feature vectors are null")
    return matrix(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, dim)


def _values(column: pa.ChunkedArray) -> np.ndarray:
    """A column as an array, of Python objects where NumPy has no type for it."""
    if not column.null_count and (pa.types.is_integer(column.type) or pa.types.is_floating(column.type)):
        return column.to_numpy()
    out = np.empty(len(column), dtype=object)
    out[:] = column.to_pylist()
    return out


def _broadcast_neighbors(train: DataFrame, test: DataFrame, key: str, test_key: str, features: str,
                         label: str | None, k: int, p: float, n_train: int) -> DataFrame:
    spark = train.sparkSession
    lab = F.col(label) if label else F.lit(None).cast("double")
    rows = train.select(F.col(key).alias("_tk"), F.col(features).cast("array<double>").alias("_x"),
                        lab.alias("_y")).orderBy("_tk").toArrow()  # bounded: checked by the caller
    x = _rows(rows.column("_x"), len(rows.column("_x")[0]))
    bc = spark.sparkContext.broadcast({"index": _Index(x), "tk": _values(rows.column("_tk")), "ty": _values(rows.column("_y"))})
    kk = min(k, n_train)
    schema = T.StructType([
        T.StructField(test_key, test.schema[test_key].dataType),
        T.StructField("nn_rank", T.IntegerType()),
        T.StructField("nn_key", train.schema[key].dataType),
        T.StructField("dist", T.DoubleType()),
        T.StructField("nn_label", train.schema[label].dataType if label else T.DoubleType()),
    ])

    def part(it):
        b = bc.value
        for pdf in it:
            if pdf.empty:
                continue
            r, c, d = b["index"].search(np.stack(pdf["_x"].to_numpy()).astype(np.float64), k, p)
            yield pd.DataFrame({test_key: pdf["_qk"].to_numpy()[r], "nn_rank": np.tile(np.arange(1, kk + 1), len(pdf)),
                                "nn_key": b["tk"][c], "dist": d, "nn_label": b["ty"][c]})

    q = test.select(F.col(test_key).alias("_qk"), F.col(features).cast("array<double>").alias("_x"))
    par = spark.sparkContext.defaultParallelism
    if q.rdd.getNumPartitions() < par:
        # a small input read as one split would put every distance in one task;
        # large inputs already have enough partitions and are left in place
        q = q.repartition(par)
    return q.mapInPandas(part, schema)


#: pivots at most, and bytes of their matrix at most (it goes to every task)
_PIVOTS, _PIVOT_BYTES = 4096, 64 << 20
#: nearest pivots from whose rows the k-th distance is bounded
_NEAREST = 8


class _Cells:
    """Pivots, and what is known about the training rows of each pivot's cell."""

    def __init__(self, pivots: np.ndarray, p: float) -> None:
        self.centre = pivots.mean(axis=0)
        self.pivots, self.p = pivots - self.centre, p
        self.squares = np.einsum("ij,ij->i", self.pivots, self.pivots)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, pivots) distances, and per row what they may be wrong by."""
        x = x - self.centre
        if self.p != 2:
            step = max(1, _CHUNK_CELLS // max(1, self.pivots.size))
            d = np.concatenate([_minkowski(x[a:a + step], self.pivots, self.p) for a in range(0, len(x), step)])
            return d, 1e-12 * d.max(axis=1)
        own = np.einsum("ij,ij->i", x, x)
        d2 = own[:, None] + self.squares[None, :] - 2.0 * (x @ self.pivots.T)
        return np.sqrt(np.maximum(d2, 0.0)), 1e-7 * np.sqrt(own + self.squares.max())

    def summarise(self, rows: list, k: int) -> None:
        """Takes (cell, n, lo, hi, near) of each cell that has rows."""
        m = len(self.pivots)
        self.n = np.zeros(m, dtype=np.int64)
        self.lo, self.hi = np.full(m, np.inf), np.full(m, -np.inf)
        self.near = np.full((m, k), np.inf)
        for r in rows:
            self.n[r["cell"]], self.lo[r["cell"]], self.hi[r["cell"]] = r["n"], r["lo"], r["hi"]
            self.near[r["cell"], :len(r["near"])] = r["near"]

    def visits(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) pairs: the cells that may hold one of a row's k nearest."""
        d, wrong = self.distances(x)
        some = np.argpartition(d, min(_NEAREST, d.shape[1]) - 1, axis=1)[:, :_NEAREST]
        reach = (np.take_along_axis(d, some, axis=1)[:, :, None] + self.near[some]).reshape(len(x), -1)
        bound = np.partition(reach, k - 1, axis=1)[:, k - 1] if reach.shape[1] >= k else np.full(len(x), np.inf)
        for i in np.flatnonzero(np.isinf(bound)).tolist():  # too few rows near by: all cells
            reach = (d[i][:, None] + self.near).ravel()
            bound[i] = np.partition(reach, k - 1)[k - 1] if len(reach) >= k else np.inf
        # distances that round to the same 10 digits are ties
        limit = bound * (1 + 4e-9) + 4 * wrong
        least = np.maximum(d - self.hi, self.lo - d)
        least = np.maximum(least, (d - d.min(axis=1, keepdims=True)) / 2)
        return np.nonzero((self.n > 0) & (least <= limit[:, None]))


#: cells that the rows of data without structure go to, about, and what a cut may take in a Python worker, each side
_CELLS, _CUT_BYTES = 48, 48 << 20
#: distances to pivots that a task holds at once
_ROUTE_CELLS = 1 << 20


def _cut_rows(dim: int, k: int, text: float) -> tuple[int, int]:
    """(training, test) rows of a cut that take about ``_CUT_BYTES``, as measured: their
    vectors three times over, an object for each vector, and the k rows made of a test
    row.  ``text``: characters of a training row's key and label."""
    return (max(1, int(_CUT_BYTES / (24 * dim + 440 + 2 * text))),
            max(1, int(_CUT_BYTES / (24 * dim + 100 + k * (60 + 2 * text)))))


def _pruned_neighbors(train: DataFrame, test: DataFrame, key: str, test_key: str, features: str, label: str | None,
                      k: int, p: float, sizes: dict, block_rows: int, group: str | None = None, seed: int = 42) -> DataFrame:
    """``sizes`` has the training rows of every group (of 0 without ``group``)."""
    lab = F.col(label) if label else F.lit(None).cast("double")
    x, own_group = F.col(features).cast("array<double>").alias("_x"), (F.col(group) if group else F.lit(0)).alias("_g")
    tr = train.select(own_group, F.xxhash64(key).alias("_s"), F.col(key).alias("_tk"), x, lab.alias("_y"))
    te = test.select(own_group, F.xxhash64(test_key).alias("_s"), F.col(test_key).alias("_qk"), x)
    text = [F.coalesce(F.length(c), F.lit(0)) for c in ("_tk", "_y") if isinstance(tr.schema[c].dataType, T.StringType)]
    dim, text = tr.agg(F.max(F.size("_x")), F.avg(sum(text, F.lit(0)))).first()  # groups may differ
    # many small blocks would send every row of data without structure to each of them
    largest, (t_most, q_most) = max(sizes.values()), _cut_rows(dim, k, text)
    block = max(block_rows, min(t_most, -(-2 * largest * len(sizes) // _CELLS)))
    q_block = max(block_rows, min(q_most, 4 * block))
    most = int(min(_PIVOTS, max(16 if len(sizes) == 1 else 4, 2 * largest // block), max(1, _PIVOT_BYTES // (8 * max(1, dim) * len(sizes)))))
    hashed = tr.select("_g", order_hash(seed, ["_tk"]).alias("_h"), "_x")
    first = F.row_number().over(Window.partitionBy("_g").orderBy("_h"))
    hashed = hashed.withColumn("_i", first).where(F.col("_i") <= most) if group else hashed.orderBy("_h").limit(most)
    pivots: dict = {}
    for r in hashed.select("_g", "_x").collect():  # bounded by ``most`` for each group
        pivots.setdefault(r["_g"], []).append(r["_x"])
    cells = {g: _Cells(np.unique(np.array(v, dtype=np.float64).reshape(len(v), -1), axis=0), p) for g, v in pivots.items()}
    base, total = {}, 0
    for g, c in cells.items():
        base[g], total = total, total + len(c.pivots)
    near_of = {g: min(k, sizes[g]) for g in cells}

    def routed(b, route):
        """(rows, cells, extra) of a batch: each group's rows by ``route(cells, x, group)`` over its own cells."""
        x, gs = b.column("_x"), np.array(b.column("_g").to_pylist(), dtype=object)
        found = []
        for g, own in cells.items():
            of_group = np.flatnonzero(gs == g)
            step = max(1, _ROUTE_CELLS // max(len(own.pivots), _NEAREST * near_of[g]))
            for a in range(0, len(of_group), step):
                at = of_group[a:a + step]
                v = _rows(x if len(at) == len(x) else x.take(pa.array(at)), own.pivots.shape[1])
                row, cell, extra = route(own, v, g)
                found.append((at[row], cell + base[g], extra))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        return tuple(np.concatenate(z) for z in zip(*found))

    def own_cell(c, v, g):
        d, _ = c.distances(v)
        cell = d.argmin(axis=1)
        return np.arange(len(v)), cell, d[np.arange(len(v)), cell]

    def visited(c, v, g):
        row, cell = c.visits(v, near_of[g])
        return row, cell, np.zeros(len(row))

    def summary(batches):
        n = np.zeros(total, dtype=np.int64)
        lo, hi, near = np.full(total, np.inf), np.full(total, -np.inf), [np.zeros(0)] * total
        for b in batches:
            if b.num_rows:
                _, cell, own = routed(b, own_cell)
                n += np.bincount(cell, minlength=total)
                np.minimum.at(lo, cell, own)
                np.maximum.at(hi, cell, own)
                for c in np.unique(cell).tolist():
                    near[c] = np.sort(np.concatenate([near[c], own[cell == c]]))[:k]
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(lo[at]), pa.array(hi[at]),
                                          pa.array([near[c].tolist() for c in at.tolist()], pa.list_(pa.float64()))], ["cell", "n", "lo", "hi", "near"])

    parts = tr.select("_g", "_x").mapInArrow(summary, "cell long, n long, lo double, hi double, near array<double>")
    known = [r.asDict() for r in parts.groupBy("cell").agg(  # one row per pivot
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k).alias("near")).collect()]
    held = np.zeros(total, dtype=np.int64)
    for g, c in cells.items():
        mine = [r | {"cell": r["cell"] - base[g], "near": r["near"][:near_of[g]]} for r in known if 0 <= r["cell"] - base[g] < len(c.pivots)]
        c.summarise(mine, near_of[g])
        held[base[g]:base[g] + len(c.pivots)] = c.n

    def arrivals(batches):
        n = np.zeros(total, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                n += np.bincount(routed(b, visited)[1], minlength=total)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0])], ["cell", "n"])

    asked = np.zeros(total, dtype=np.int64)
    for c, n in te.select("_g", "_x").mapInArrow(arrivals, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():  # one row per pivot
        asked[c] = n
    t_cuts, q_cuts = np.maximum(1, -(-held // block)), np.maximum(1, -(-asked // q_block))

    def deal(own_cuts: np.ndarray, other_cuts: np.ndarray, route, flip: bool):
        """Rows to (cell, train cut, test cut): one cut of their own side, all of the other's."""
        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                row, cell, _ = routed(b, route)
                mine = b.column("_s").to_numpy()[row] % own_cuts[cell]
                times = other_cuts[cell]
                row, cell, mine = np.repeat(row, times), np.repeat(cell, times), np.repeat(mine, times)
                other = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                for a in range(0, len(row), 1 << 14):
                    z = slice(a, a + (1 << 14))
                    cuts = (other[z], mine[z]) if flip else (mine[z], other[z])
                    some = pa.RecordBatch.from_arrays([pa.array(v, pa.int32()) for v in (cell[z], *cuts)], ["_c", "_tc", "_qc"])
                    kept = b.take(pa.array(row[z]))
                    yield pa.RecordBatch.from_arrays([*some.columns, *(kept.column(c) for c in kept.schema.names if c != "_s")],
                                                     [*some.schema.names, *(c for c in kept.schema.names if c != "_s")])
        return run

    def schema_of(df):
        return T.StructType([T.StructField(c, T.IntegerType()) for c in ("_c", "_tc", "_qc")] + [f for f in df.schema.fields if f.name != "_s"])

    left = tr.mapInArrow(deal(t_cuts, q_cuts, own_cell, False), schema_of(tr))
    right = te.mapInArrow(deal(q_cuts, t_cuts, visited, True), schema_of(te))
    schema = T.StructType([
        T.StructField("_g", tr.schema["_g"].dataType), T.StructField("qk", test.schema[test_key].dataType),
        T.StructField("tk", train.schema[key].dataType), T.StructField("dist", T.DoubleType()), T.StructField("y", tr.schema["_y"].dataType)])
    on = ("_c", "_tc", "_qc")
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(_block_topk(k, p), schema)
    ranked = found.withColumn("nn_rank", F.row_number().over(Window.partitionBy("_g", "qk").orderBy("dist", "tk"))).where(F.col("nn_rank") <= k)
    out = [F.col("_g").alias(group)] if group else []
    return ranked.select(*out, F.col("qk").alias(test_key), "nn_rank", F.col("tk").alias("nn_key"), "dist", F.col("y").alias("nn_label"))


def neighbors(train: DataFrame, test: DataFrame, key: str, features: str = "features",
              label: str | None = None, k: int = 5, p: float = 2, block_rows: int = 4096,
              test_key: str | None = None, group: str | None = None,
              broadcast_bytes: int = _BROADCAST) -> DataFrame:
    """``([group,] <test key>, nn_rank, nn_key, dist, nn_label)`` with the k
    nearest train rows of every test row (``nn_rank`` 1..k).  With ``group``,
    test rows only meet train rows of the same group (one join serves, e.g.,
    every cross-validation fold at once)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    if p < 1:
        raise ValueError("p must be >= 1")
    test_key = test_key or key
    own_group = (F.col(group) if group else F.lit(0)).alias("_gg")
    sizes = {r["_gg"]: int(r["count"]) for r in train.groupBy(own_group).count().collect()}  # one row per group
    if not sizes:
        raise ValueError("empty train set")
    if group is None and broadcast_bytes:
        dim = train.select(F.size(F.col(features))).first()[0] or 0
        if sizes[0] * (dim + 2) * 8 <= broadcast_bytes:
            return _broadcast_neighbors(train, test, key, test_key, features, label, k, p, sizes[0])
    return _pruned_neighbors(train, test, key, test_key, features, label, k, p, sizes, block_rows, group)


def _weights(nb: DataFrame, test_key: str, weights: str) -> DataFrame:
    if weights == "uniform":
        return nb.withColumn("_w", F.lit(1.0))
    if weights != "distance":
        raise ValueError("weights must be 'uniform' or 'distance'")
    # 1/d; if any neighbour sits at distance 0, only those count (one window
    # over the k rows of each test row, no self-join)
    zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy(test_key))
    return nb.withColumn("_w", F.when(zero == 1, (F.col("dist") == 0).cast("double"))
                                .otherwise(1.0 / F.col("dist")))


def class_weights(nb: DataFrame, test_key: str, k: int, weights: str = "uniform") -> DataFrame:
    """``(<test key>, nn_label, weight)``: summed vote weight per class."""
    sub = nb.where(F.col("nn_rank") <= k)
    return (_weights(sub, test_key, weights)
            .groupBy(test_key, "nn_label").agg(F.sum("_w").alias("weight")))


def vote(nb: DataFrame, test_key: str, k: int, weights: str = "uniform",
         out_col: str = "prediction") -> DataFrame:
    """Majority (or weighted) class per test row; ties -> smallest class."""
    cw = class_weights(nb, test_key, k, weights)
    best = F.min(F.struct((-F.col("weight")).alias("a"), F.col("nn_label").alias("b")))
    return cw.groupBy(test_key).agg(best["b"].alias(out_col))


def proba(nb: DataFrame, test_key: str, k: int, weights: str = "uniform") -> DataFrame:
    """``(<test key>, class, probability)`` for the classes that received votes
    (other classes have probability 0)."""
    cw = class_weights(nb, test_key, k, weights)
    tot = cw.groupBy(test_key).agg(F.sum("weight").alias("_t"))
    return (cw.join(tot, test_key)
              .select(test_key, F.col("nn_label").alias("class"),
                      (F.col("weight") / F.col("_t")).alias("probability")))


_class_shares = proba  # ``predict`` has a ``proba`` flag


def regress(nb: DataFrame, test_key: str, k: int, weights: str = "uniform",
            out_col: str = "prediction") -> DataFrame:
    sub = _weights(nb.where(F.col("nn_rank") <= k), test_key, weights)
    return sub.groupBy(test_key).agg(
        (F.sum(F.col("_w") * F.col("nn_label")) / F.sum("_w")).alias(out_col))


def _in_task_predict(d: np.ndarray, c: np.ndarray, kk: int, weights: str, targets: list, info: dict) -> dict:
    """Per test row (rows of ``d``/``c`` reshaped to ``(m, kk)``): vote or
    weighted mean for every target, the same rules as ``vote``/``regress``."""
    d = d.reshape(-1, kk)
    c = c.reshape(-1, kk)
    if weights == "uniform":
        w = np.ones_like(d)
    else:
        zero = d == 0
        anyz = zero.any(axis=1, keepdims=True)
        with np.errstate(divide="ignore"):
            w = np.where(anyz, zero.astype(np.float64), 1.0 / np.where(d == 0, 1.0, d))
    out = {}
    rows = np.repeat(np.arange(d.shape[0]), kk)
    for t in targets:
        ti = info[t]
        if ti["classes"] is not None:
            acc = np.zeros((d.shape[0], len(ti["classes"])))
            np.add.at(acc, (rows, ti["codes"][c].ravel()), w.ravel())
            out[t] = ti["classes"][np.argmax(acc, axis=1)]  # first maximum = smallest class
            out[("proba", t)] = acc / acc.sum(axis=1, keepdims=True)
        else:
            out[t] = (w * ti["values"][c]).sum(axis=1) / w.sum(axis=1)
    return out


@dataclass
class Prepared:
    """A training side as scoring uses it: its row count and, while it is small
    enough, its matrix and targets as a broadcast (made once, ``release`` frees it)."""
    n_train: int
    matrix: object = None

    def release(self) -> None:
        if self.matrix is not None:
            self.matrix.unpersist()


def prepare(train: DataFrame, key: str, features: str, targets: list, task: str,
            broadcast_bytes: int = _BROADCAST) -> Prepared:
    n_train = train.count()
    if n_train == 0:
        raise ValueError("empty train set")
    dim = train.select(F.size(F.col(features))).first()[0] or 0
    if n_train * (dim + 1 + len(targets)) * 8 > broadcast_bytes:
        return Prepared(n_train)
    rows = (train.select(F.col(key).alias("_tk"), F.col(features).cast("array<double>").alias("_x"), *targets)
                 .orderBy("_tk").toArrow())  # bounded: checked above
    index = _Index(_rows(rows.column("_x"), dim))
    info = {}
    for t in targets:
        vals = rows.column(t).to_pylist()
        if task == "classification":
            classes = np.array(sorted(set(vals)), dtype=object)
            pos = {v: i for i, v in enumerate(classes)}
            info[t] = {"classes": classes, "codes": np.array([pos[v] for v in vals], dtype=np.int64)}
        else:
            info[t] = {"classes": None, "values": np.array(vals, dtype=np.float64)}
    return Prepared(n_train, train.sparkSession.sparkContext.broadcast({"index": index, "info": info}))


def predict(train: DataFrame, test: DataFrame, key: str, features: str, targets: list, task: str,
            k: int = 5, p: float = 2, weights: str = "uniform", block_rows: int = 4096,
            broadcast_bytes: int = _BROADCAST, prefix: str = "pred_", proba: bool = False,
            prepared: Prepared | None = None) -> DataFrame:
    """``test`` plus ``<prefix><target>`` for every target, and with ``proba``
    (classification) ``proba_<target>``: the vote shares over the target's
    sorted training classes.

    Bounded training side (the size check of ``neighbors``): neighbours and
    votes are computed in the same task, all test columns pass through, and
    the plan is a single map over the scored table (no shuffle, no join).
    Otherwise the blocked neighbour join, then the vote or mean per target.
    ``prepared`` reuses what ``prepare`` made of the same training side."""
    if weights not in ("uniform", "distance"):
        raise ValueError("weights must be 'uniform' or 'distance'")
    prepared = prepared or prepare(train, key, features, targets, task, broadcast_bytes)
    if prepared.matrix is None:
        if test.isStreaming:
            raise ValueError("the training side exceeds broadcast_bytes; score the stream per micro-batch "
                             "(streaming.score_stream)")
        # a scored table may repeat a key: a point is its key and its features
        out = test.withColumn("_point", F.concat_ws(":", F.col(key).cast("string"), F.xxhash64(features)))
        points = out.select("_point", features).dropDuplicates(["_point"])
        nb = written(neighbors(train, points, key, features, None, k, p, block_rows, test_key="_point", broadcast_bytes=0),
                     "neighbours")  # once for all targets
        labels = train.select(F.col(key).alias("nn_key"), *targets)
        nbl = nb.drop("nn_label").join(labels, "nn_key")
        for t in targets:
            sub = nbl.select("_point", "nn_rank", "dist", F.col(t).alias("nn_label"))
            fn = vote if task == "classification" else regress
            out = out.join(fn(sub, "_point", k, weights, f"{prefix}{t}"), "_point")
            if proba and task == "classification":
                classes = sorted(r[0] for r in train.select(t).distinct().collect())
                pr = _class_shares(sub, "_point", k, weights)
                m = pr.groupBy("_point").agg(F.map_from_entries(F.collect_list(F.struct("class", "probability")))
                                        .alias("_pm"))  # at most k entries per row
                arr = F.array(*[F.coalesce(F.element_at("_pm", F.lit(c)), F.lit(0.0)) for c in classes])
                out = out.join(m.select("_point", arr.alias(f"proba_{t}")), "_point")
        return out.drop("_point")
    spark, bc = train.sparkSession, prepared.matrix
    kk = min(k, prepared.n_train)
    out_fields = list(test.schema.fields) + [
        T.StructField(f"{prefix}{t}", train.schema[t].dataType if task == "classification" else T.DoubleType())
        for t in targets]
    with_proba = proba and task == "classification"
    if with_proba:
        out_fields += [T.StructField(f"proba_{t}", T.ArrayType(T.DoubleType())) for t in targets]
    schema = T.StructType(out_fields)

    def part(it):
        b = bc.value
        for pdf in it:
            if pdf.empty:
                continue
            _, c, d = b["index"].search(np.stack(pdf[features].to_numpy()).astype(np.float64), kk, p)
            preds = _in_task_predict(d, c, kk, weights, targets, b["info"])
            for t in targets:
                pdf[f"{prefix}{t}"] = preds[t]
                if with_proba:
                    pdf[f"proba_{t}"] = list(preds[("proba", t)])
            yield pdf

    par = spark.sparkContext.defaultParallelism
    if test.isStreaming:
        src = test  # a micro-batch map: one task per input split
    else:
        src = test.repartition(par) if test.rdd.getNumPartitions() < par else test
    return src.mapInPandas(part, schema)
