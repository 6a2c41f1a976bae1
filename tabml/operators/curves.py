"""ROC and precision-recall curves, AUCs and score histograms.

Rows are first pre-aggregated to one row per distinct score (positives and
negatives counted map-side), then running sums over the distinct scores come
from ``functions.rank.cumulative_sums`` (range partitions + broadcast
offsets; no window over all rows, no unbounded task).  AUCs are sums of per-score
trapezoids, each computable from the row's own running sums, so they are one
more aggregate.

Semantics of the public library the reference calls: the positive class is
the larger of the two observed labels; ROC thresholds are the distinct scores
in decreasing order with a leading ``(+inf, 0, 0)`` point, and by default
points whose second difference is zero (collinear, ``drop_intermediate``) are
dropped; the PR curve keeps every threshold and ends at ``(recall 0,
precision 1)``; the AUC is the trapezoid rule over all thresholds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.rank import cumulative_sums
from tabml.operators.roles import require_binary, select_split
from tabml.session import written


def score_counts(df: DataFrame, y: str, score: str, positive=None) -> tuple[DataFrame, object]:
    classes = require_binary(df, y)
    pos = classes[1] if positive is None else positive
    is_pos = (F.col(y) == F.lit(pos)).cast("long")
    agg = (df.where(F.col(score).isNotNull())
             .groupBy(F.col(score).cast("double").alias("threshold"))
             .agg(F.sum(is_pos).alias("tp"), F.sum(1 - is_pos).alias("fp")))
    return agg, pos


def _cum(df: DataFrame, y: str, score: str, positive=None, with_next: bool = False) -> DataFrame:
    agg, _ = score_counts(df, y, score, positive)
    # the per-score table feeds the range partitions, the totals and the running
    # sums: materialise it once in the checkpoint folder (the input is scanned
    # once, and the lineage is cut)
    from tabml.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    agg = agg.checkpoint(eager=True)
    cum = cumulative_sums(agg, "threshold", ["tp", "fp"], descending=True, with_next=with_next)
    tot = agg.agg(F.sum("tp").alias("P"), F.sum("fp").alias("N")).first()  # two numbers
    return cum.withColumn("P", F.lit(float(tot["P"]))).withColumn("N", F.lit(float(tot["N"])))


def roc_curve(df: DataFrame, y: str, score: str, positive=None, drop_intermediate: bool = True,
              split: str | None = None, split_col: str = "is_test") -> DataFrame:
    """``(threshold, fpr, tpr)``; the first point is ``(+inf, 0, 0)``.  A point i
    is dropped when both second differences are zero, i.e. the next distinct
    score adds the same positives and negatives as this one; the first and last
    points are kept."""
    df = select_split(df, split, split_col)
    c = _cum(df, y, score, positive, with_next=drop_intermediate)
    if drop_intermediate:
        first = (F.col("cum_tp") == F.col("tp")) & (F.col("cum_fp") == F.col("fp"))
        keep = (first | F.col("next_tp").isNull() | (F.col("next_tp") != F.col("tp"))
                | (F.col("next_fp") != F.col("fp")))
        c = c.where(keep)
    pts = c.select("threshold", (F.col("cum_fp") / F.col("N")).alias("fpr"),
                   (F.col("cum_tp") / F.col("P")).alias("tpr"))
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(pts)


def roc_auc(df: DataFrame, y: str, score: str, positive=None, split: str | None = None,
            split_col: str = "is_test") -> DataFrame:
    df = select_split(df, split, split_col)
    c = _cum(df, y, score, positive)
    area = F.col("fp") / F.col("N") * (2 * F.col("cum_tp") - F.col("tp")) / (2 * F.col("P"))
    return c.agg(F.sum(area).alias("auc"))


def pr_curve(df: DataFrame, y: str, score: str, positive=None, split: str | None = None,
             split_col: str = "is_test") -> DataFrame:
    """``(threshold, recall, precision)`` plus the end point (null, 0, 1)."""
    df = select_split(df, split, split_col)
    c = _cum(df, y, score, positive)
    pts = c.select("threshold", (F.col("cum_tp") / F.col("P")).alias("recall"),
                   (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"))
    end = df.sparkSession.createDataFrame([(None, 0.0, 1.0)], "threshold double, recall double, precision double")
    return pts.unionByName(end)


def pr_auc(df: DataFrame, y: str, score: str, positive=None, split: str | None = None,
           split_col: str = "is_test") -> DataFrame:
    df = select_split(df, split, split_col)
    c = _cum(df, y, score, positive)
    prev_tp = F.col("cum_tp") - F.col("tp")
    prev_all = prev_tp + F.col("cum_fp") - F.col("fp")
    prec = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    prev_prec = F.when(prev_all > 0, prev_tp / prev_all).otherwise(F.lit(1.0))
    area = F.col("tp") / F.col("P") * (prec + prev_prec) / 2
    return c.agg(F.sum(area).alias("auc"))


_BROADCAST_GROUPS = 10_000


def _bins(v, lo, hi, bins: int):
    return F.least(F.lit(bins - 1), F.floor((v - lo) * (F.lit(float(bins)) / (hi - lo))).cast("int"))


def histogram(df: DataFrame, value: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width histogram over each group's own [min, max] (a constant
    group spans [v - 0.5, v + 0.5]); the maximum falls in the last bin.
    ``(group, bin, lo, hi, n)`` with empty bins included.  Without ``by`` the
    two bounds are literals (no join); with ``by`` the per-group bounds are a
    table with one row per group, broadcast up to ``_BROADCAST_GROUPS`` groups
    (counted) and joined beyond that."""
    x = df.where(F.col(value).isNotNull()).select(
        (F.col(by) if by else F.lit("all")).alias("group"), F.col(value).cast("double").alias("v"))
    width = (F.col("hi0") - F.col("lo0")) / F.lit(float(bins))
    if by is None:
        mm = x.agg(F.min("v").alias("mn"), F.max("v").alias("mx")).first()  # two numbers
        if mm["mn"] is None:
            return df.sparkSession.createDataFrame([], "group string, bin int, lo double, hi double, n long")
        lo0, hi0 = (mm["mn"] - 0.5, mm["mx"] + 0.5) if mm["mn"] == mm["mx"] else (mm["mn"], mm["mx"])
        counts = x.groupBy(_bins(F.col("v"), F.lit(lo0), F.lit(hi0), bins).alias("bin")).agg(
            F.count(F.lit(1)).alias("n"))
        grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        return (grid.join(counts, "bin", "left")
                    .select(F.lit("all").alias("group"), "bin",
                            (F.lit(lo0) + F.col("bin") * F.lit((hi0 - lo0) / bins)).alias("lo"),
                            F.when(F.col("bin") == bins - 1, F.lit(hi0))
                             .otherwise(F.lit(lo0) + (F.col("bin") + 1) * F.lit((hi0 - lo0) / bins)).alias("hi"),
                            F.coalesce("n", F.lit(0)).cast("long").alias("n")))
    rng = x.groupBy("group").agg(F.min("v").alias("mn"), F.max("v").alias("mx"))
    rng = rng.select("group",
                     F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo0"),
                     F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi0"))
    rng = written(rng, "ranges")  # one row per group
    if len(rng.select("group").limit(_BROADCAST_GROUPS + 1).collect()) <= _BROADCAST_GROUPS:
        rng = F.broadcast(rng)  # the rows stay where they are, whatever their group
    counts = (x.join(rng, "group")
                .groupBy("group", _bins(F.col("v"), F.col("lo0"), F.col("hi0"), bins).alias("bin"))
                .agg(F.count(F.lit(1)).alias("n")))
    grid = rng.select("group", "lo0", "hi0", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(counts, ["group", "bin"], "left")
                .select("group", "bin", (F.col("lo0") + F.col("bin") * width).alias("lo"),
                        F.when(F.col("bin") == bins - 1, F.col("hi0"))
                         .otherwise(F.col("lo0") + (F.col("bin") + 1) * width).alias("hi"),
                        F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def score_histogram(df: DataFrame, y: str, score: str, bins: int = 30, split: str | None = None,
                    split_col: str = "is_test") -> DataFrame:
    """Decision-score histogram per true class: ``(class, bin, lo, hi, n)``."""
    df = select_split(df, split, split_col)
    return histogram(df, score, bins, by=y).withColumnRenamed("group", "class")
