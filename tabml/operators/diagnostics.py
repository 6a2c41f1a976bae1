"""Regression diagnostics: residual statistics (all rows), a bounded seeded
sample of points, and the residual histogram.  Residual = y - prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.hashing import order_hash
from tabml.operators.curves import histogram
from tabml.operators.roles import select_split


def residual(y: str, yhat: str):
    return (F.col(y) - F.col(yhat)).alias("residual")


def residual_stats(df: DataFrame, y: str, yhat: str, target: str = "y", split: str | None = None,
                   split_col: str = "is_test") -> DataFrame:
    """``(target, mean, std, mae, n)`` over every row of the chosen split that
    has a target and a prediction (std is the population std)."""
    df = select_split(df, split, split_col)
    r = F.col(y) - F.col(yhat)
    return df.agg(F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"), F.avg(F.abs(r)).alias("mae"),
                  F.count(r).alias("n")).select(F.lit(target).alias("target"), "mean", "std", "mae", "n")


def residual_points(df: DataFrame, y: str, yhat: str, key: Sequence[str] | str,
                    max_points: int = 5000, seed: int = 42, split: str | None = None,
                    split_col: str = "is_test") -> DataFrame:
    """At most ``max_points`` rows without replacement, chosen by the lowest
    seeded hash of the key (a bounded top-k, planned as TakeOrdered)."""
    df = select_split(df, split, split_col)
    keys = [key] if isinstance(key, str) else list(key)
    h = order_hash(seed, keys)
    return (df.select(*keys, F.col(y).alias("y"), F.col(yhat).alias("yhat"), h.alias("_h"))
              .orderBy("_h").limit(max_points)
              .select(*keys, "y", "yhat", (F.col("y") - F.col("yhat")).alias("residual")))


def diagonal_bounds(df: DataFrame, y: str, yhat: str, split: str | None = None, split_col: str = "is_test") -> DataFrame:
    """``(lo, hi)`` of the predicted-vs-actual diagonal over the chosen split."""
    df = select_split(df, split, split_col)
    return df.agg(F.least(F.min(y), F.min(yhat)).alias("lo"), F.greatest(F.max(y), F.max(yhat)).alias("hi"))


def residual_histogram(df: DataFrame, y: str, yhat: str, bins: int = 30, split: str | None = None,
                       split_col: str = "is_test") -> DataFrame:
    df = select_split(df, split, split_col)
    return histogram(df.select((F.col(y) - F.col(yhat)).alias("residual")), "residual", bins).drop("group")
