"""Exact, seeded train/test splits and K-folds (map-only).

Semantics follow the public scikit-learn functions the reference calls:

* ``n_test = ceil(test_size * n)`` for a fraction, ``test_size`` itself for an
  integer; ``n_train = n - n_test``.
* Stratified split: the per-class *train* quota is the largest-remainder
  allocation of ``n_train`` over the class counts; the test quota is the rest
  of each class.  Remainder ties go to the smaller class (the library breaks
  them at random).
* K-fold: fold sizes ``n // k + 1`` for the first ``n % k`` folds, then
  ``n // k``; each fold is a contiguous run of the seeded order.
* Stratified K-fold: per-class fold sizes of the library's allocation (sorted
  labels dealt round-robin over the folds), classes taken in sorted order.

Row order is ``md5('<seed>:<key>')`` (``functions.hashing``).  Cutoff hashes
come from ``HashOrder``; the output is the input plus one column computed by a
comparison, so no shuffle of the data is needed.  Above 10,000 classes nothing
per class reaches the driver: quotas and cutoffs are Spark tables, joined back by class.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions.hashing import order_hash
from tabml.functions.rank import HashOrder, group_cutoffs, running_sums
from tabml.session import written

_H = "_tabml_h"


def _n_test(test_size, n: int) -> int:
    if isinstance(test_size, float):
        if not 0.0 < test_size < 1.0:
            raise ValueError("test_size must be in (0, 1) or a positive integer")
        k = math.ceil(test_size * n)
    else:
        k = int(test_size)
    if not 0 < k < n:
        raise ValueError(f"test size {k} leaves no rows on one side (n={n})")
    return k


def largest_remainder(counts: dict, n_draw: int) -> dict:
    """Integer allocation of ``n_draw`` proportional to ``counts``; remainder ties
    to the smaller class."""
    total = sum(counts.values())
    keys = sorted(counts)
    cont = {c: counts[c] / total * n_draw for c in keys}
    alloc = {c: math.floor(cont[c]) for c in keys}
    need = n_draw - sum(alloc.values())
    order = sorted(keys, key=lambda c: (-(cont[c] - alloc[c]), c))
    for c in order[:need]:
        alloc[c] += 1
    return alloc


#: groups up to which a lookup is a literal map in the plan
_LITERAL_GROUPS = 64


def _with_group_value(df: DataFrame, values: dict, gcol: str, name: str, kind: str) -> DataFrame:
    """``df`` plus column ``name``: the group's value, null for groups without
    one.  A literal map for few groups, else a join on the group (one row per
    group; Spark broadcasts it while it is small)."""
    if len(values) <= _LITERAL_GROUPS:
        items = [F.lit(x) for g, v in values.items() for x in (g, v)]
        return df.withColumn(name, F.element_at(F.create_map(*items), F.col(gcol)) if items else F.lit(None).cast(kind))
    table = df.sparkSession.createDataFrame([(g, v) for g, v in values.items()],
                                            T.StructType([T.StructField("_group", df.schema[gcol].dataType), T.StructField(name, T._parse_datatype_string(kind))]))
    return df.join(table, F.col(gcol) == F.col("_group"), "left").drop("_group")


def train_test_split(df: DataFrame, key_cols: Sequence[str], test_size=0.2, seed: int = 42,
                     stratify: str | None = None, out_col: str = "is_test") -> DataFrame:
    """Input plus boolean ``out_col``.  ``stratify`` names the class column."""
    h = order_hash(seed, key_cols)
    base = df.withColumn(_H, h)
    order = HashOrder(base, _H, stratify)
    if order.many:
        return _split_many(base, test_size, stratify, out_col, order.leaf_rows)
    totals = order.totals()
    if stratify is not None and None in totals:
        raise ValueError(f"stratify column {stratify!r} has nulls")
    n = sum(totals.values())
    n_test = _n_test(test_size, n)
    if stratify is None:
        cut = order.cutoffs({0: [n_test]})[(0, n_test)]
        return base.withColumn(out_col, F.col(_H) <= F.lit(cut)).drop(_H)
    if min(totals.values()) < 2:
        raise ValueError("the least populated class has fewer than 2 members; cannot stratify")
    train_q = largest_remainder(totals, n - n_test)
    test_q = {g: totals[g] - train_q[g] for g in totals}
    cuts = order.cutoffs({g: [q] for g, q in test_q.items() if q > 0})
    cut_by_g = {g: cuts[(g, q)] for g, q in test_q.items() if q > 0}
    cut = F.coalesce("_cut", F.lit(""))  # '' sorts before any hash -> no test rows
    return _with_group_value(base, cut_by_g, stratify, "_cut", "string").withColumn(out_col, F.col(_H) <= cut).drop(_H, "_cut")


def _class_counts(base: DataFrame, stratify: str):
    """The table (class, n), written, and its (rows, smallest class, largest class, null classes)."""
    classes = written(base.groupBy(stratify).agg(F.count(F.lit(1)).alias("n")), "classes")
    return classes, classes.agg(F.sum("n"), F.min("n"), F.max("n"), F.count(F.when(F.col(stratify).isNull(), 1))).first()


def _split_many(base: DataFrame, test_size, stratify: str, out_col: str, leaf_rows: int) -> DataFrame:
    """The stratified split with the quotas and cutoffs as Spark tables: largest
    remainders by a running count over the classes, cutoffs joined back by class."""
    classes, (n, least, _, nulls) = _class_counts(base, stratify)
    if nulls:
        raise ValueError(f"stratify column {stratify!r} has nulls")
    n_train = n - _n_test(test_size, n)
    if least < 2:
        raise ValueError("the least populated class has fewer than 2 members; cannot stratify")
    exact = F.col("n").cast("double") / F.lit(float(n)) * F.lit(float(n_train))
    quota = written(classes.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact")).withColumn("_one", F.lit(1)), "quotas")
    need = n_train - quota.agg(F.sum("_floor")).first()[0]
    quota = running_sums(quota, [(F.col("_exact") - F.col("_floor")).desc(), F.col(stratify).asc()], ["_one"])
    take = F.col("n") - F.col("_floor") - (F.col("cum__one") <= need).cast("long")
    wanted = written(quota.select(stratify, "n", F.array(take).alias("positions")).where(F.col("positions")[0] > 0), "wanted")
    found = group_cutoffs(base, _H, stratify, wanted, leaf_rows).select(F.col(stratify).alias("_class"), F.map_values("_at")[0].alias("_cut"))
    out = base.join(found, F.col(stratify) == F.col("_class"), "left")
    return out.withColumn(out_col, F.col(_H) <= F.coalesce("_cut", F.lit(""))).drop(_H, "_class", "_cut")


def _kfold_many(base: DataFrame, k: int, stratify: str, out_col: str, leaf_rows: int) -> DataFrame:
    """Stratified folds with class offsets and cutoffs as Spark tables."""
    classes, (_, _, most, _) = _class_counts(base, stratify)
    if most < k:
        raise ValueError(f"k={k} exceeds the members of every class")
    classes = running_sums(classes, [F.col(stratify).asc()], ["n"])

    def upto(x, i):
        return F.greatest(F.lit(0), F.ceil((x - i) / F.lit(float(k)))).cast("long")

    off = F.col("cum_n") - F.col("n")
    ends, acc = [], F.lit(0).cast("long")
    for i in range(k - 1):
        acc = acc + upto(F.col("cum_n"), i) - upto(off, i)
        ends.append(acc)
    wanted = classes.select(stratify, "n", F.array(*ends).alias("_ends"))
    wanted = written(wanted.withColumn("positions", F.array_distinct(F.filter("_ends", lambda e: e > 0))), "wanted")
    found = wanted.select(stratify, "_ends").join(group_cutoffs(base, _H, stratify, wanted, leaf_rows), stratify, "left")
    cuts = F.transform("_ends", lambda e: F.coalesce(F.element_at("_at", e), F.lit("")))
    out = base.join(found.select(F.col(stratify).alias("_class"), cuts.alias("_cuts")), F.col(stratify).eqNullSafe(F.col("_class")), "left")
    fold = F.size(F.filter("_cuts", lambda c: c < F.col(_H))).cast("int")
    return out.withColumn(out_col, fold).drop(_H, "_class", "_cuts")


def kfold_sizes(n: int, k: int) -> list[int]:
    return [n // k + (1 if i < n % k else 0) for i in range(k)]


def stratified_fold_sizes(counts: dict, k: int) -> dict:
    """Per class, the size of each fold: class c owns positions [off, off+n) of
    the sorted labels; fold i gets the positions p there with p % k == i."""

    def upto(x, i):
        return max(0, -(-(x - i) // k))

    out, off = {}, 0
    for c in sorted(counts):
        n = counts[c]
        out[c] = [upto(off + n, i) - upto(off, i) for i in range(k)]
        off += n
    return out


def kfold(df: DataFrame, key_cols: Sequence[str], k: int = 5, seed: int = 42,
          stratify: str | None = None, out_col: str = "fold") -> DataFrame:
    """Input plus integer ``out_col`` in 0..k-1."""
    if k < 2:
        raise ValueError("k must be at least 2")
    base = df.withColumn(_H, order_hash(seed, key_cols))
    order = HashOrder(base, _H, stratify)
    if order.many:
        return _kfold_many(base, k, stratify, out_col, order.leaf_rows)
    totals = order.totals()
    if stratify is None:
        sizes = {0: kfold_sizes(totals[0], k)}
        if totals[0] < k:
            raise ValueError(f"cannot make {k} folds of {totals[0]} rows")
    else:
        if max(totals.values()) < k:
            raise ValueError(f"k={k} exceeds the members of every class")
        sizes = stratified_fold_sizes(totals, k)
    # cutoff = last position of folds 0..k-2 (skip empty-fold duplicates harmlessly)
    req = {}
    for g, sz in sizes.items():
        ends, acc = [], 0
        for s in sz[:-1]:
            acc += s
            ends.append(acc)
        req[g] = [e for e in ends if e > 0]
    found = order.cutoffs({g: sorted(set(v)) for g, v in req.items() if v})
    cuts = {}
    for g, sz in sizes.items():
        acc, lst = 0, []
        for s in sz[:-1]:
            acc += s
            lst.append(found[(g, acc)] if acc > 0 else "")
        cuts[g] = lst
    if stratify is None:
        base = base.withColumn("_cuts", F.array(*[F.lit(c) for c in cuts[0]]))
    else:
        base = _with_group_value(base, {g: F.array(*[F.lit(c) for c in v]) if len(cuts) <= _LITERAL_GROUPS else v for g, v in cuts.items()},
                                 stratify, "_cuts", "array<string>")
    fold = F.size(F.filter("_cuts", lambda c: c < F.col(_H))).cast("int")  # cutoffs strictly below the row's hash
    return base.withColumn(out_col, fold).drop(_H, "_cuts")
