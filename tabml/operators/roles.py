"""Column roles: targets, features, type split, validation, alignment.

Name rules of the reference: names are stripped, blanks dropped, duplicates
rejected, every name must exist, features must not overlap the targets, and
when no features are given all non-target columns are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.operators.prep import is_categorical, is_numeric, is_vector


def _clean(names: str | Sequence[str] | None, what: str) -> list[str]:
    if names is None:
        return []
    if isinstance(names, str):
        names = [names]
    out = [n.strip() for n in names if n is not None and n.strip()]
    if not out:
        raise ValueError(f"no {what} column given")
    dup = sorted({n for n in out if out.count(n) > 1})
    if dup:
        raise ValueError(f"duplicate {what} columns: {dup}")
    return out


@dataclass
class ColumnRoles:
    targets: list[str]
    features: list[str]

    @classmethod
    def resolve(cls, df: DataFrame, targets, features=None, key: str | Sequence[str] | None = None) -> "ColumnRoles":
        t = _clean(targets, "target")
        cols = df.columns
        missing = [c for c in t if c not in cols]
        if missing:
            raise ValueError(f"unknown target columns: {missing}")
        keys = [key] if isinstance(key, str) else list(key or [])
        if features is None:
            f = [c for c in cols if c not in t and c not in keys]
        else:
            f = _clean(features, "feature")
            missing = [c for c in f if c not in cols]
            if missing:
                raise ValueError(f"unknown feature columns: {missing}")
            overlap = [c for c in f if c in t]
            if overlap:
                raise ValueError(f"feature columns overlap the targets: {overlap}")
        if not f:
            raise ValueError("no feature column left")
        return cls(t, f)

    @property
    def multi_output(self) -> bool:
        return len(self.targets) > 1

    def select(self, df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
        return df.select(*key, *self.features, *self.targets)


def infer_roles(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(pos, name, type, role)`` with role categorical / numeric / vector /
    unsupported, in column order."""
    spark = df.sparkSession
    rows = []
    for i, f in enumerate(df.schema.fields):
        if cols is not None and f.name not in cols:
            continue
        dt = f.dataType
        role = ("categorical" if is_categorical(dt) else "numeric" if is_numeric(dt)
                else "vector" if is_vector(dt) else "unsupported")
        rows.append((i, f.name, dt.simpleString(), role))
    return spark.createDataFrame(rows, "pos int, name string, type string, role string")


def validate(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """One row ``(n_rows, n_features, n_targets)``; raises on an empty table."""
    if df.isEmpty():
        raise ValueError("the table is empty")
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(roles.features)).cast("long").alias("n_features"),
        F.lit(len(roles.targets)).cast("long").alias("n_targets"))


def align(df: DataFrame, feature_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Required raw input columns present, in the stored order."""
    missing = [c for c in feature_cols if c not in df.columns]
    if missing:
        raise ValueError(f"the table lacks the model's input columns: {missing}")
    return df.select(*keep, *feature_cols)


def require_binary(df: DataFrame, label: str) -> list:
    """The two observed classes (sorted), else a friendly error."""
    vals = [r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().limit(3).collect()]
    if len(vals) != 2:
        raise ValueError(f"this curve needs exactly two classes in {label!r}; found "
                         f"{'more than two' if len(vals) > 2 else len(vals)}")
    return sorted(vals)


def preview(df: DataFrame, order_by: str | Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in an explicit order (TakeOrdered, no global sort)."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)


def select_split(df: DataFrame, split: str | None, split_col: str = "is_test") -> DataFrame:
    """Rows of one side of a train/test split (``"train"`` / ``"test"``), or all
    rows for ``None``: the dataset choice for curves and diagnostics."""
    if split is None:
        return df
    if split not in ("train", "test"):
        raise ValueError("split must be 'train', 'test' or None")
    return df.where(F.col(split_col) if split == "test" else ~F.col(split_col))
