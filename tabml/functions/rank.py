"""Distributed order statistics without a global sort.

Two primitives serve splits, folds and curves:

``HashOrder``
    Rows are ordered by a uniform hex hash (``functions.hashing``).  Counting
    rows per hash prefix (``16**3`` buckets per group) gives exact bucket
    offsets; the p-th row of a group then lies in a known bucket, and only that
    bucket is ranked.  Buckets larger than ``leaf_rows`` are refined by three
    more hex digits.  The caller turns the returned cutoff hashes into a plain
    ``h <= cutoff`` column: the split itself is map-only, with no shuffle of
    the data, and is identical on recomputation after an executor loss.

``running_sums``
    Running sums of value columns in a total order: range partitions written
    once, one total per partition (broadcast as offsets), and a window in each.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.session import written

_DIGITS = 3  # at most 3 hex digits added per refinement level (4096 sub-buckets)
_HASH_DIGITS = 32  # of the hex hash: no prefix is longer
_DRIVER_ROWS = 1_000_000  # bound on the bucket counts a refinement level returns
_DRIVER_GROUPS = 10_000  # groups whose totals come to the driver


class HashOrder:
    """Exact positions in the order of a hex hash column, per optional group.

    One aggregate gives the group totals (one row per class).  Each
    refinement level counts rows per (group, longer hash prefix) for the
    prefixes that hold a requested position only; the prefix grows by as many
    hex digits as keep ``requested prefixes x sub-buckets`` near
    ``_DRIVER_ROWS``.  Rows that share a key share a hash: a cutoff there is that
    hash, and they all fall on its side."""

    def __init__(self, df: DataFrame, h_col: str, group_col: str | None = None,
                 leaf_rows: int = 2_000_000):
        self.h = h_col
        self.g = group_col
        self.leaf_rows = leaf_rows
        cols = [h_col] + ([group_col] if group_col else [])
        self.df = df.select(*cols)
        gcol = F.col(group_col) if group_col else F.lit(0)
        self._level1: dict = {}
        # common case, one scan: counts per (group, 3-digit prefix) when they fit the bound
        rows = (self.df.groupBy(gcol.alias("_g"), F.substring(h_col, 1, _DIGITS).alias("_p"))
                .agg(F.count(F.lit(1)).alias("_n")).limit(_DRIVER_ROWS + 1).collect())
        if len(rows) <= _DRIVER_ROWS:
            lv: dict = defaultdict(list)
            for r in rows:
                lv[r["_g"]].append((r["_p"], int(r["_n"])))
            if len(lv) > _DRIVER_GROUPS:
                self._totals = None
                return
            self._level1 = {(g, ""): sorted(v) for g, v in lv.items()}
            self._totals = {g: sum(n for _, n in v) for g, v in lv.items()}
            return
        rows = (self.df.groupBy(gcol.alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
                .limit(_DRIVER_GROUPS + 1).collect())
        self._totals = {r["_g"]: int(r["_n"]) for r in rows} if len(rows) <= _DRIVER_GROUPS else None

    @property
    def many(self) -> bool:
        """Too many groups for the driver: ``group_cutoffs`` is for those."""
        return self._totals is None

    def totals(self) -> dict:
        return dict(self._totals)

    def _gcol(self):
        return F.col(self.g) if self.g else F.lit(0)

    def cutoffs(self, requests: dict) -> dict:
        """``requests``: group -> list of 1-based positions.  Returns
        ``{(group, position): hash of that row}``."""
        out: dict = {}
        # pending entries: (group, position, prefix, residual position inside the prefix)
        pending = []
        for g, ps in requests.items():
            for p in ps:
                total = self._totals.get(g, 0)
                if not 1 <= p <= total:
                    raise ValueError(f"position {p} outside 1..{total} for group {g!r}")
                pending.append((g, p, "", p))
        while pending:
            need = {(g, pre) for g, _, pre, _ in pending}
            buckets = {k: self._level1[k] for k in need if k in self._level1}
            missing = need - set(buckets)
            if missing:
                buckets.update(self._refine(missing))
            leaves, deeper = [], []
            for g, p, pre, r in pending:
                acc = 0
                for sub, n in buckets[(g, pre)]:
                    if acc + n >= r:
                        if len(sub) >= _HASH_DIGITS:
                            out[(g, p)] = sub
                        else:
                            (leaves if n <= self.leaf_rows else deeper).append((g, p, sub, r - acc))
                        break
                    acc += n
            if leaves:
                out.update(self._rank_leaves(leaves))
            pending = deeper
        return out

    def _refine(self, prefixes: set) -> dict:
        """Row counts per (group, prefix + next digits) for the given prefixes."""
        spark = self.df.sparkSession
        by_len = defaultdict(list)
        for g, pre in prefixes:
            by_len[len(pre)].append((g, pre))
        res: dict = defaultdict(list)
        for plen, items in by_len.items():
            digits = max(1, min(_DIGITS, _HASH_DIGITS - plen, int(math.log(max(1.0, _DRIVER_ROWS / len(items)), 16))))
            keys = spark.createDataFrame([(str(g), pre) for g, pre in items], "_gs string, _pre string")
            rows = (
                self.df.join(
                    F.broadcast(keys),  # one row per requested prefix
                    (self._gcol().cast("string") == F.col("_gs"))
                    & (F.substring(self.h, 1, plen) == F.col("_pre")),
                )
                .groupBy("_gs", "_pre", F.substring(self.h, 1, plen + digits).alias("_p"))
                .agg(F.count(F.lit(1)).alias("_n"))
                .collect()
            )
            gmap = {str(g): g for g, _ in items}
            for r in rows:
                res[(gmap[r["_gs"]], r["_pre"])].append((r["_p"], r["_n"]))
        for k in res:
            res[k].sort()
        return res

    def _rank_leaves(self, leaves: list) -> dict:
        spark = self.df.sparkSession
        by_len = defaultdict(list)
        for g, p, sub, r in leaves:
            by_len[len(sub)].append((g, p, sub, r))
        out = {}
        for plen, items in by_len.items():
            keys = spark.createDataFrame(
                list({(str(g), sub) for g, _, sub, _ in items}), "_gs string, _pre string")
            w = Window.partitionBy("_gs", "_pre").orderBy(self.h)
            wanted = spark.createDataFrame(
                [(str(g), sub, int(r)) for g, _, sub, r in items], "_gs string, _pre string, _r long")
            rows = (
                self.df.withColumn("_gs", self._gcol().cast("string"))
                .withColumn("_pre", F.substring(self.h, 1, plen))
                .join(F.broadcast(keys), ["_gs", "_pre"], "left_semi")
                .withColumn("_r", F.row_number().over(w).cast("long"))
                .join(F.broadcast(wanted), ["_gs", "_pre", "_r"])
                .select("_gs", "_pre", "_r", self.h)
                .collect()
            )
            found = {(r["_gs"], r["_pre"], r["_r"]): r[self.h] for r in rows}
            for g, p, sub, r in items:
                out[(g, p)] = found[(str(g), sub, int(r))]
        return out


def group_cutoffs(df: DataFrame, h_col: str, group_col: str, wanted: DataFrame, leaf_rows: int = 2_000_000) -> DataFrame:
    """(group, ``_at``): the hash of the row at each wanted position of a group's
    hash order, as a map from position to hash.  ``wanted`` has (group, ``n``,
    ``positions``), n being the group's rows and positions an array.

    Groups of up to ``leaf_rows`` rows are ranked by a window each.  Larger ones,
    of which there can be few, go through ``HashOrder``, which never ranks a whole group."""
    rows = df.select(group_col, h_col)
    w = Window.partitionBy(group_col).orderBy(h_col)
    small = rows.join(wanted.where(F.col("n") <= leaf_rows).select(group_col, "positions"), group_col)
    small = small.withColumn("_r", F.row_number().over(w).cast("long")).where(F.array_contains("positions", F.col("_r")))
    found = small.groupBy(group_col).agg(F.map_from_entries(F.collect_list(F.struct("_r", h_col))).alias("_at"))
    hot = {r[0]: list(r[1]) for r in wanted.where(F.col("n") > leaf_rows).select(group_col, "positions").collect()}
    if hot:
        order = HashOrder(df.where(F.col(group_col).isin(list(hot))), h_col, group_col, leaf_rows)
        cuts = order.cutoffs(hot)
        values = [(g, {p: cuts[(g, p)] for p in ps}) for g, ps in hot.items()]
        found = found.unionAll(df.sparkSession.createDataFrame(values, found.schema))
    return found


def ordered_parts(df: DataFrame, order: list[Column], parts: int) -> DataFrame:
    """A written copy, range-partitioned by ``order``, with ``_b``, the number of
    the row's partition in that order (written, so it is the same for every reader)."""
    return written(df.repartitionByRange(parts, *order).withColumn("_b", F.spark_partition_id()), "ordered")


def running_sums(df: DataFrame, order: list[Column], value_cols: list[str], parts: int | None = None,
                 with_next: bool = False, part_rows: int = 1_000_000) -> DataFrame:
    """Add ``cum_<v>`` = running sum of each value column over rows in ``order``,
    inclusive; with ``with_next`` also ``next_<v>`` = the value of the following row (null
    for the last row).  ``order`` must be unique per row.

    Two levels: a range partition of about ``part_rows`` rows is summed by a window of
    its own, and one total per partition gives what lies before it."""
    if parts is None:
        parts = max(1, math.ceil(df.count() / part_rows))
    b = ordered_parts(df, order, parts)
    totals = b.groupBy("_b").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    wt = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select(
        "_b", *[F.coalesce(F.sum(f"_t_{v}").over(wt), F.lit(0)).alias(f"_o_{v}") for v in value_cols]
    )
    w = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    res = b.join(F.broadcast(offsets), "_b")
    for v in value_cols:
        res = res.withColumn(f"cum_{v}", F.sum(v).over(w) + F.col(f"_o_{v}"))
    if with_next:
        wn = Window.partitionBy("_b").orderBy(*order)
        # first row of every partition, shifted to the one before it
        firsts = b.withColumn("_r", F.row_number().over(wn)).where("_r = 1").select("_b", F.struct(*value_cols).alias("_f"))
        nxt = firsts.select("_b", F.lead("_f").over(Window.orderBy("_b")).alias("_nf"))
        res = res.join(F.broadcast(nxt), "_b", "left")
        for v in value_cols:
            res = res.withColumn(f"next_{v}", F.coalesce(F.lead(v).over(wn), F.col("_nf")[v]))
        res = res.drop("_nf")
    return res.drop("_b", *[f"_o_{v}" for v in value_cols])


def cumulative_sums(df: DataFrame, order_col: str, value_cols: list[str], descending: bool = False,
                    buckets: int | None = None, with_next: bool = False) -> DataFrame:
    """``running_sums`` in the order of one column, ascending or descending.
    ``order_col`` must be unique per row (pre-aggregate by it first) and not null."""
    oc = F.col(order_col).desc() if descending else F.col(order_col).asc()
    return running_sums(df, [oc], value_cols, buckets, with_next)


def _ordered_long(v: np.ndarray) -> np.ndarray:
    """Doubles as longs in the same order; NaN is above all, -0.0 is 0.0."""
    v = np.where(np.isnan(v), np.nan, v + 0.0)
    i = v.view(np.int64)
    return i ^ ((i >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _from_long(i: int) -> float:
    x = np.array([i], dtype=np.int64)
    return float((x ^ ((x >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)[0])


def select_ranks(df: DataFrame, need: dict, bounds: dict, cells: int = 1_000_000, leaf_rows: int = 200_000) -> dict:
    """Exact values at 0-based ranks of the non-null values of several columns:
    ``{column: {rank: value}}`` for ``need`` = {column: ranks} and ``bounds`` =
    {column: (least, largest value)}.

    All columns and ranks share every scan.  A scan cuts each interval that holds a
    wanted rank into equal ranges of the doubles' ordered bit patterns and counts
    them, so an interval shrinks by the same factor whatever the distribution and six scans are
    the most for 4,096 ranges; a value that a third of the rows hold ends as a range
    of one pattern.  Intervals whose rows fit ``leaf_rows`` together are read out in the next
    scan.  At most ``cells`` counts and ``leaf_rows`` values reach the driver a scan."""
    cols = list(need)
    data = df.select([F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    out: dict = {c: {} for c in cols}
    # an interval: (column, lo, hi, ((rank, rank inside),...), rows or None while not counted)
    todo = []
    for i, c in enumerate(cols):
        lo, hi = (int(_ordered_long(np.array([v], dtype=np.float64))[0]) for v in bounds[c])
        todo.append((i, lo, hi, tuple((r, r) for r in sorted(set(need[c]))), None))
    while todo:
        for i, lo, _, wanted, _ in [x for x in todo if x[1] == x[2]]:
            out[cols[i]] |= {r: _from_long(lo) for r, _ in wanted}
        todo = [x for x in todo if x[1] < x[2]]
        if not todo:
            break
        leaf, room = set(), leaf_rows
        for x, t in sorted(enumerate(todo), key=lambda y: y[1][4] if y[1][4] is not None else math.inf):
            if t[4] is not None and t[4] <= room:
                leaf.add(x)
                room -= t[4]
        ranges = max(16, min(4096, cells // max(1, len(todo) - len(leaf))))
        nodes = [(i, lo, hi, -(-(hi - lo + 1) // ranges), x in leaf) for x, (i, lo, hi, _, _) in enumerate(todo)]

        def scan(batches, nodes=nodes, ranges=ranges):
            counts = {x: np.zeros(ranges, dtype=np.int64) for x, t in enumerate(nodes) if not t[4]}
            for b in batches:
                found, values = [], {}
                for x, (i, lo, hi, step, whole) in enumerate(nodes):
                    if i not in values:
                        values[i] = _ordered_long(b.column(i).drop_null().to_numpy(zero_copy_only=False).astype(np.float64))
                    v = values[i]
                    v = v[(v >= lo) & (v <= hi)]
                    if whole:
                        found.append((x, v))
                    elif len(v):
                        at = (v.view(np.uint64) - np.uint64(lo & 0xFFFFFFFFFFFFFFFF)) // np.uint64(step)
                        counts[x] += np.bincount(at.astype(np.int64), minlength=ranges)
                x = np.concatenate([np.full(len(v), x) for x, v in found]) if found else np.zeros(0, np.int64)
                v = np.concatenate([v for _, v in found]) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()), pa.array(v, pa.int64()), pa.array(np.ones(len(v), np.int64))], ["x", "at", "n"])
            for x, n in counts.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), x), pa.int32()), pa.array(at, pa.int64()), pa.array(n[at])], ["x", "at", "n"])

        rows: dict = defaultdict(list)
        for r in data.mapInArrow(scan, "x int, at long, n long").groupBy("x", "at").agg(F.sum("n").alias("n")).collect():
            rows[r["x"]].append((r["at"], r["n"]))
        later = []
        for x, (i, lo, hi, step, whole) in enumerate(nodes):
            into: dict = defaultdict(list)
            upto, at = 0, iter(sorted(rows[x]))
            where, n = next(at)
            for r, inside in todo[x][3]:
                while upto + n <= inside:
                    upto += n
                    where, n = next(at)
                into[where, n].append((r, inside - upto))
            for (where, n), wanted in into.items():
                if whole:
                    out[cols[i]] |= {r: _from_long(where) for r, _ in wanted}
                else:
                    later.append((i, lo + where * step, min(hi, lo + (where + 1) * step - 1), tuple(wanted), n))
        todo = later
    return out


def kth_smallest(df: DataFrame, col: str, ranks: list[int], cells: int = 1_000_000, leaf_rows: int = 200_000) -> dict:
    """Exact values at 0-based ``ranks`` of the non-null values of ``col``."""
    n, lo, hi = df.agg(F.count(col), F.min(F.col(col).cast("double")), F.max(F.col(col).cast("double"))).first()
    if any(not 0 <= r < n for r in ranks):
        raise ValueError(f"ranks must be in 0..{n - 1}")
    return select_ranks(df, {col: ranks}, {col: (lo, hi)}, cells, leaf_rows)[col] if ranks else {}


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Linear-interpolated quantiles (position ``p * (n - 1)``) of the non-null
    values, exact; ``None`` when the column has no value."""
    return exact_quantiles_multi(df, [col], probs)[col]


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float],
                          leaf_rows: int = 1_000_000) -> dict:
    """``exact_quantiles`` for several columns with few jobs: one aggregate
    counts the non-null values of every column; columns with at most
    ``leaf_rows`` values (a checked bound) are ranked together by one window
    partitioned by column; larger ones together by ``select_ranks``."""
    if not cols:
        return {}
    counts = df.agg(*[f(F.col(c).cast("double")).alias(f"_{n}{i}") for i, c in enumerate(cols)
                      for f, n in ((F.count, "n"), (F.min, "lo"), (F.max, "hi"))]).first()
    need: dict = {}
    pos: dict = {}
    for i, c in enumerate(cols):
        n = int(counts[f"_n{i}"])
        pos[c] = [p * (n - 1) for p in probs] if n else None
        if n:
            need[c] = sorted({int(math.floor(h)) for h in pos[c]} | {int(math.ceil(h)) for h in pos[c]})
    vals: dict = {c: {} for c in cols}
    small = [c for c in need if int(counts[f"_n{cols.index(c)}"]) <= leaf_rows]
    if small:
        spark = df.sparkSession
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(small)
        ])).alias("_s")).select("_s._c", "_s._v").where(F.col("_v").isNotNull())
        want = spark.createDataFrame([(i, r + 1) for i, c in enumerate(small) for r in need[c]], "_c int, _rn int")
        w = Window.partitionBy("_c").orderBy("_v")
        rows = (long.withColumn("_rn", F.row_number().over(w)).join(F.broadcast(want), ["_c", "_rn"])
                    .select("_c", "_rn", "_v").collect())
        for r in rows:
            vals[small[r["_c"]]][r["_rn"] - 1] = r["_v"]
    large = {c: need[c] for c in need if c not in small}
    if large:
        at = {c: cols.index(c) for c in large}
        vals |= select_ranks(df, large, {c: (counts[f"_lo{i}"], counts[f"_hi{i}"]) for c, i in at.items()})
    out = {}
    for c in cols:
        if pos[c] is None:
            out[c] = [None for _ in probs]
            continue
        res = []
        for h in pos[c]:
            lo, hi = int(math.floor(h)), int(math.ceil(h))
            res.append(vals[c][lo] + (h - lo) * (vals[c][hi] - vals[c][lo]))
        out[c] = res
    return out
