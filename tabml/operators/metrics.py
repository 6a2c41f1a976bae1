"""Evaluation as aggregations.

Every classification metric is derived from one partial aggregate
``groupBy(y, yhat).count()`` (at most classes^2 rows after the map-side
combine), so the cost is one scan of the predictions whatever their size.
Regression metrics are one ``agg`` of sums.  Conventions of the public
library the reference calls: population variance, zero division -> 0,
classes = sorted union of true and predicted labels, constant target ->
R2 = 1 when predictions are perfect, else 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabml.operators.roles import select_split
from tabml.session import written


def pair_counts(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, yhat: str, classes: DataFrame | None = None,
                     normalize: bool = False, split: str | None = None, split_col: str = "is_test") -> DataFrame:
    """``(y, yhat, n)`` over the full class grid, zero cells included;
    ``normalize=True`` adds ``share`` = n / row total (empty row -> 0).

    The pair counts (map-side combined, written once) are the only scan. The result's rows are
    every class by every class (or the first column of ``classes``): row classes
    are dealt to buckets, column classes are copied to each bucket, and the
    counts are joined on. ``split`` takes the train or test rows only."""
    pc = written(pair_counts(select_split(df, split, split_col), y, yhat), "pairs")
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if classes is None:
        names = pc.select(F.explode(F.array("y", "yhat")).alias("c")).where("c is not null").distinct()
    else:
        names = classes.select(F.col(classes.columns[0]).alias("c")).distinct()
    rows = names.select(F.col("c").alias("y"), F.pmod(F.xxhash64("c"), F.lit(buckets)).cast("int").alias("_b"))
    cols = names.select(F.col("c").alias("yhat"), F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_b"))
    grid = rows.join(cols, "_b").drop("_b")
    out = grid.join(pc, ["y", "yhat"], "left").select("y", "yhat", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    if normalize:
        tot = F.sum("n").over(Window.partitionBy("y"))
        out = out.withColumn("share", F.when(tot > 0, F.col("n") / tot).otherwise(F.lit(0.0)))
    return out


def per_class(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, class, tp, support, predicted)`` for the union of labels.

    Each (y, yhat, n) cell of the pair counts contributes ``support`` and
    ``tp`` to class y and ``predicted`` to class yhat: one explode and one
    grouped sum, no joins."""
    by = list(by)
    pc = pair_counts(df, y, yhat, by)
    z = F.lit(0).cast("long")
    cells = pc.select(*by, F.explode(F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"),
                 F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(z).alias("tp"),
                 z.alias("predicted")),
        F.struct(F.col("yhat").alias("class"), z.alias("support"), z.alias("tp"),
                 F.col("n").alias("predicted")),
    )).alias("_e")).select(*by, "_e.*")
    return cells.groupBy(*by, "class").agg(
        F.sum("tp").cast("long").alias("tp"), F.sum("support").cast("long").alias("support"),
        F.sum("predicted").cast("long").alias("predicted"))


def _prf(pcl: DataFrame) -> DataFrame:
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    x = pcl.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return x.withColumn("f1", f1)


def classification_report(df: DataFrame, y: str, yhat: str, digits: int | None = None, split: str | None = None,
                          split_col: str = "is_test") -> DataFrame:
    """``(class, precision, recall, f1, support)``: one row per class (as a
    string), then ``accuracy`` (all three columns carry the accuracy, support =
    rows), ``macro avg`` and ``weighted avg``.

    One aggregate: ``rollup(class)`` over the per-class table yields the class
    rows and the grand total in the same pass (the average over a single class
    row is that row's own value)."""
    x = _prf(per_class(select_split(df, split, split_col), y, yhat))
    r = x.rollup("class").agg(
        F.grouping_id().alias("_gid"), F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    n = F.col("n")
    acc = F.col("tp") / n

    def row(name, p, rc, f):
        return F.struct(name.alias("class"), p.alias("precision"), rc.alias("recall"), f.alias("f1"),
                        n.cast("long").alias("support"))

    rows = F.when(F.col("_gid") == 0, F.array(
        row(F.col("class").cast("string"), F.col("mp"), F.col("mr"), F.col("mf")))).otherwise(F.array(
            row(F.lit("accuracy"), acc, acc, acc),
            row(F.lit("macro avg"), F.col("mp"), F.col("mr"), F.col("mf")),
            row(F.lit("weighted avg"), F.col("wp") / n, F.col("wr") / n, F.col("wf") / n)))
    out = r.select(F.explode(rows).alias("s")).select("s.*")
    if digits is not None:
        out = out.select("class", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1")],
                         "support")
    return out


CLASSIFICATION_SCORES = ("accuracy", "f1", "f1_weighted", "f1_macro", "precision_weighted",
                         "recall_weighted")
REGRESSION_SCORES = ("r2", "neg_mean_squared_error", "neg_mean_absolute_error")


def positive_label(df: DataFrame, y: str):
    """The larger of the two labels of a binary column (of one, that one); None
    for more than two or none."""
    labels = [r[0] for r in df.where(F.col(y).isNotNull()).select(y).distinct().limit(3).collect()]
    return max(labels) if 1 <= len(labels) <= 2 else None


def classification_scores(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), positive=None) -> DataFrame:
    """Per group of ``by``: accuracy, f1_weighted, f1_macro, precision_weighted,
    recall_weighted, and f1: of the label ``positive`` (0 where a group lacks
    it), or without one of the larger label, null unless the labels are
    exactly two.  Rows without a label or a prediction are left out."""
    x = _prf(per_class(df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull()), y, yhat, by))
    w = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    agg = x.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        w("f1").alias("f1_weighted"), F.avg("f1").alias("f1_macro"),
        w("precision").alias("precision_weighted"), w("recall").alias("recall_weighted"),
        F.count(F.lit(1)).alias("_k"),
        F.max(F.struct(F.col("class"), F.col("f1")))["f1"].alias("_f1_pos"),
        F.max(F.when(F.col("class") == F.lit(positive), F.col("f1"))).alias("_f1_named"))
    f1 = F.when(F.col("_k") == 2, F.col("_f1_pos")) if positive is None else F.coalesce("_f1_named", F.lit(0.0))
    return agg.select(*by, "accuracy", f1.alias("f1"),
                      "f1_weighted", "f1_macro", "precision_weighted", "recall_weighted")


def regression_scores(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group of ``by``: r2, mse, mae, neg_mean_squared_error,
    neg_mean_absolute_error, n, dropped.  Rows without a target or a prediction
    take no part in any of them and are counted in ``dropped``."""
    e = F.col(yhat) - F.col(y)
    a = df.groupBy(*by).agg(F.count(e).alias("n"), F.count_if(e.isNull()).alias("dropped"), F.sum(e * e).alias("sse"),
                            F.sum(F.abs(e)).alias("sae"), F.var_pop(F.when(e.isNotNull(), F.col(y))).alias("vy"))
    sst = F.col("vy") * F.col("n")
    r2 = (F.when(sst > 0, 1 - F.col("sse") / sst)
           .when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return a.select(*by, r2.alias("r2"), (F.col("sse") / F.col("n")).alias("mse"),
                    (F.col("sae") / F.col("n")).alias("mae"),
                    (-F.col("sse") / F.col("n")).alias("neg_mean_squared_error"),
                    (-F.col("sae") / F.col("n")).alias("neg_mean_absolute_error"),
                    F.col("n").cast("long").alias("n"), F.col("dropped").cast("long").alias("dropped"))


def score_by(df: DataFrame, y: str, yhat: str, scoring: str, by: Sequence[str], positive=None) -> DataFrame:
    """``(*by, score)`` for a scoring name of the reference's menus.  ``positive``:
    the positive label for ``f1``, so that a fold with one class scores too."""
    if scoring in REGRESSION_SCORES:
        return regression_scores(df, y, yhat, by).select(*by, F.col(scoring).alias("score"))
    if scoring not in CLASSIFICATION_SCORES:
        raise ValueError(f"unknown scoring {scoring!r}")
    s = classification_scores(df, y, yhat, by, positive)
    if scoring == "f1":
        s = s.withColumn("f1", F.when(F.col("f1").isNotNull(), F.col("f1")).otherwise(
            F.raise_error(F.lit("scoring 'f1' needs a binary target; use f1_weighted"))))
    return s.select(*by, F.col(scoring).alias("score"))


def score(df: DataFrame, y: str, yhat: str, scoring: str, positive=None) -> DataFrame:
    """Single value ``score`` for a scoring name of the reference's menus (``f1``
    is binary only: a multi-class target gets a clear error)."""
    return score_by(df, y, yhat, scoring, (), positive)


def _long(df: DataFrame, id_cols: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return df.select(*id_cols, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])).alias("m")).select(*id_cols, "m.metric", "m.value")


def _split_name(split_col: str | None):
    if split_col is None:
        return F.lit("all")
    return F.when(F.col(split_col), F.lit("test")).otherwise(F.lit("train"))


def eval_classifier(df: DataFrame, y: str, yhat: str, split_col: str | None = None,
                    target: str = "y") -> DataFrame:
    """Long ``(target, split, metric, value)`` with accuracy and weighted F1 per
    split, all splits in one grouped pass."""
    d = df.withColumn("_split", _split_name(split_col))
    cs = classification_scores(d, y, yhat, ["_split"]).select(
        F.lit(target).alias("target"), F.col("_split").alias("split"), "accuracy", "f1_weighted")
    return _long(cs, ["target", "split"], ["accuracy", "f1_weighted"])


def eval_regressor(df: DataFrame, y: str, yhat: str, split_col: str | None = None,
                   target: str = "y") -> DataFrame:
    """Long ``(target, split, metric, value)`` with r2, mse, mae per split."""
    d = df.withColumn("_split", _split_name(split_col))
    out = regression_scores(d, y, yhat, ["_split"]).select(
        F.lit(target).alias("target"), F.col("_split").alias("split"), "r2", "mse", "mae")
    return _long(out, ["target", "split"], ["r2", "mse", "mae"])


def eval_multi(long_df: DataFrame) -> DataFrame:
    """Per-target rows plus the plain mean over targets (``target = 'mean'``)
    from a long ``(target, split, metric, value)`` frame."""
    per = long_df.select("target", "split", "metric", "value")
    mean = long_df.groupBy("split", "metric").agg(F.avg("value").alias("value")) \
        .select(F.lit("mean").alias("target"), "split", "metric", "value")
    return per.unionByName(mean)
