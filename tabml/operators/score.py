"""Batch scoring with a fitted bundle: check and align the raw input columns,
preprocess, predict every target, decode class labels.  No collect: the
result is a DataFrame of the same rows plus ``pred_<target>`` columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.hashing import row_key
from tabml.operators import target
from tabml.operators.roles import align


def predict(bundle, df: DataFrame, decode: bool = True, keep: list[str] | None = None,
            proba: bool = False) -> DataFrame:
    """Rows of ``df`` (its key and ``keep`` columns; without a key, just those) plus ``pred_<target>``; with ``proba``
    (classifiers) also ``proba_<target>``, the class probabilities in sorted
    class order (``bundle.label_maps`` names the classes of encoded targets)."""
    from tabml.plans.train import predict_matrix
    keep = list(dict.fromkeys([*(k for k in bundle.keys if k not in (keep or [])), *(keep or [])]))
    raw = align(df, [f for f in bundle.features if f not in keep], keep=keep)
    if bundle.row_key not in keep:
        # without a key a row is told apart by its features, on which its prediction depends alone
        named = row_key(raw, bundle.keys) if bundle.keys else F.sha2(row_key(raw, bundle.features), 256)
        keep, raw = [bundle.row_key, *keep], raw.withColumn(bundle.row_key, named)
    x = bundle.prep.transform(raw, keep=keep)
    out = predict_matrix(bundle, x, proba=proba).drop("features")
    if bundle.row_key not in bundle.keys:
        out = out.drop(bundle.row_key)
    if decode and bundle.label_maps:
        out = target.decode_labels(out, bundle.label_maps,
                                   {f"pred_{t}": t for t in bundle.targets if t in bundle.label_maps})
    return out
