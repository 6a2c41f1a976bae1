"""Label maps for classification targets.

A numeric or boolean target is used as is; any other target is encoded as
the index of its value among the sorted distinct values (0..k-1).  Up to
``MAX_CLASSES`` labels are a list, applied as a literal map, so encoding and
decoding are projections.  More are a ``LabelTable``, written and numbered by
range partitions and joined (Spark broadcasts it while it is small, else splits skewed labels).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions.rank import running_sums
from tabml.session import written

MAX_CLASSES = 10_000


@dataclass
class LabelTable:
    """The sorted labels of a target as a written table (label string, code int)."""
    table: DataFrame
    size: int


def needs_encoding(df: DataFrame, target: str) -> bool:
    dt = df.schema[target].dataType
    return not isinstance(dt, (T.NumericType, T.BooleanType))


def fit_label_map(df: DataFrame, targets: str | Sequence[str], max_literal: int = MAX_CLASSES) -> dict:
    """``{target: [sorted labels]}`` for the targets that need encoding; a
    ``LabelTable`` for one of more than ``max_literal`` labels."""
    targets = [targets] if isinstance(targets, str) else list(targets)
    out = {}
    for t in targets:
        if not needs_encoding(df, t):
            continue
        vals = [r[0] for r in df.where(F.col(t).isNotNull()).select(t).distinct()
                .limit(max_literal + 1).collect()]
        out[t] = sorted(str(v) for v in vals) if len(vals) <= max_literal else _label_table(df, t)
    return out


def _label_table(df: DataFrame, t: str) -> LabelTable:
    labels = df.where(F.col(t).isNotNull()).select(F.col(t).cast("string").alias("label"), F.lit(1).alias("one")).distinct()
    numbered = running_sums(labels, [F.col("label").asc()], ["one"])
    table = written(numbered.select("label", (F.col("cum_one") - 1).cast("int").alias("code")), "labels")
    return LabelTable(table, table.count())


def encode_labels(df: DataFrame, label_map: dict, suffix: str = "") -> DataFrame:
    """Replace (or add ``<target><suffix>``) the encoded index; unknown labels
    raise at run time."""
    cols, joined = {}, []
    for n, (t, labs) in enumerate(label_map.items()):
        if isinstance(labs, LabelTable):
            lab, num = f"_label_{n}", f"_code_{n}"
            df = df.join(labs.table.select(F.col("label").alias(lab), F.col("code").alias(num)), F.col(t).cast("string") == F.col(lab), "left")
            code, joined = F.col(num), [*joined, lab, num]
        else:
            items = []
            for i, lab in enumerate(labs):
                items += [F.lit(lab), F.lit(i)]
            code = F.element_at(F.create_map(*items), F.col(t).cast("string"))
        cols[t + suffix] = F.when(F.col(t).isNull(), F.lit(None).cast("int")).when(
            code.isNull(), F.raise_error(F.concat(F.lit(f"unseen label in {t}: "), F.col(t).cast("string")))
        ).otherwise(code)
    return df.withColumns(cols).drop(*joined)


def decode_labels(df: DataFrame, label_map: dict, cols: dict) -> DataFrame:
    """``cols``: {column holding codes: target whose map applies}."""
    out, joined = {}, []
    for n, (c, t) in enumerate(cols.items()):
        labs = label_map.get(t)
        if labs is None:
            continue
        if isinstance(labs, LabelTable):
            lab, num = f"_label_{n}", f"_code_{n}"
            df = df.join(labs.table.select(F.col("label").alias(lab), F.col("code").alias(num)), F.col(c).cast("int") == F.col(num), "left")
            out[c], joined = F.col(lab), [*joined, lab, num]
            continue
        arr = F.array(*[F.lit(x) for x in labs])
        out[c] = F.element_at(arr, F.col(c).cast("int") + 1)
    return df.withColumns(out).drop(*joined)


def class_names(label_map: dict, target: str) -> list[str]:
    """The labels in code order; those of a ``LabelTable`` are its ``table``."""
    labels = label_map.get(target, [])
    if isinstance(labels, LabelTable):
        raise ValueError(f"target {target!r} has {labels.size} labels: read its table")
    return list(labels)
