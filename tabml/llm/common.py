"""Helpers shared by the operators of this sub-package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.session import checkpoint_dir

#: the separators of every word rule here: space and U+0009 to U+000D
SEPARATORS = b" \t\n\x0b\x0c\r"
#: a word, for Java, RE2 and Python
WORD = r"[^\x20\x09-\x0D]+"
#: A-Z to a-z, every other byte unchanged
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage: what follows survives lost executors, and a result
    that is used twice isn't computed twice.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tabml-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def signed(values: np.ndarray) -> np.ndarray:
    return np.asarray(values, dtype=np.uint64).view(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), vectorised."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def arrow(schema: str):
    """The Arrow schema of a Spark DDL schema."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of a stream whose rows arrive ordered by ``keys``.

    Holds one Arrow batch and the group that is still open.
    """
    open_: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if open_:
            last = open_[-1].slice(open_[-1].num_rows - 1)
            same = all(last.column(k)[0].as_py() == batch.column(k)[0].as_py() for k in keys)
            if not same:
                yield pa.Table.from_batches(open_)
                open_ = []
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield pa.Table.from_batches([*open_, batch.slice(a, b - a)])
            open_ = []
        open_.append(batch.slice(cuts[-2]))
    if open_:
        yield pa.Table.from_batches(open_)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named input columns under the operator's own names, so that
    other columns of the input can't clash with what the operator adds."""
    return df.select([F.col(f"`{c}`").alias(n) for n, c in columns.items()])
