"""Seeded pseudo-random row order that does not depend on partitioning.

A row's place is ``md5('<seed>:<key1>:<key2>...')`` (lower-case hex).  The
same string is produced by DuckDB's ``md5(concat_ws(':', ...))`` for integer
and string keys, which is what the SQL oracles rely on.  ``key_cols`` must
identify rows uniquely; otherwise equal keys share a place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.session import written


def order_hash(seed: int, key_cols: Sequence[str]) -> Column:
    if not key_cols:
        raise ValueError("key_cols is required: the row order is a hash of a unique key")
    parts = [F.lit(str(int(seed)))] + [F.col(c).cast("string") for c in key_cols]
    return F.md5(F.concat_ws(":", *parts))


#: the one-column row identity that several key columns (or none) are turned into
ROW_KEY = "_row_key"
#: equal rows that a block numbers at most, and those that need none
_COPIES, _FEW = 1 << 16, 1 << 4
#: rows that a task makes from blocks, about, and tasks at most
_TASK_ROWS, _MOST_TASKS = 1 << 20, 10_000


def _part(df: DataFrame, name: str) -> Column:
    """A column as text without '/': integers, dates and times in order, text by its bytes."""
    c, dt = F.col(name), df.schema[name].dataType
    if isinstance(dt, T.DateType):
        c, dt = F.unix_date(c), T.LongType()
    elif isinstance(dt, T.TimestampType):
        c, dt = F.unix_micros(c), T.LongType()
    if isinstance(dt, (T.IntegralType, T.BooleanType)):
        c = c.cast("int").cast("long") if isinstance(dt, T.BooleanType) else c.cast("long")
        text = F.lpad(F.hex(c.bitwiseXOR(F.lit(-1 << 63))), 16, "0")
    elif isinstance(dt, (T.ArrayType, T.StructType)):
        text = F.sha2(c.cast("string"), 256)
    else:
        text = F.hex(F.encode(c.cast("string"), "UTF-8"))
    return F.coalesce(F.concat(F.lit("1"), text), F.lit("0"))


def row_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """Several columns as one string that differs where any of them does, null
    from everything else. Its order is that of the columns in turn, nulls first,
    for integers, dates, times and text; other types order by their text."""
    return F.concat_ws("/", *[_part(df, c) for c in cols])


def number_copies(df: DataFrame, out_col: str) -> DataFrame:
    """``df`` plus ``out_col`` (long): 0, 1, ... among equal rows.

    Rows are counted per value (with partial sums before the shuffle) and made
    again from the counts, so no window ever holds a group of copies; counts over
    2^4 are cut into blocks of up to 2^16, dealt to a number of tasks that follows
    from the rows they make (the blocks themselves are too small to tell)."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    few = groups.where(F.col("_copies") <= _FEW).select(
        *df.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias(out_col))
    copied = groups.where(F.col("_copies") > _FEW)
    rows = copied.agg(F.sum("_copies")).first()[0] or 0
    if not rows:
        return few
    blocks = copied.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {_COPIES}"))))
    first = F.col("_block") * _COPIES
    tasks = min(_MOST_TASKS, -(-rows // _TASK_ROWS))
    many = blocks.repartition(tasks, "_block", *df.columns).select(
        *df.columns, F.explode(F.sequence(first, F.least(first + (_COPIES - 1), F.col("_copies") - 1))).alias(out_col))
    return few.unionByName(many)


def identified(df: DataFrame, key: Sequence[str] | None) -> DataFrame:
    """``df`` plus ``ROW_KEY``: the columns of ``key`` as one (they must identify
    a row), or for None a digest of the whole row and its number among equal
    rows, written once, as every later pass reads it."""
    if key is not None:
        return df.withColumn(ROW_KEY, row_key(df, key))
    numbered = number_copies(df, "_copy")
    digest = F.sha2(row_key(df, df.columns), 256)
    return written(numbered.withColumn(ROW_KEY, F.concat_ws("/", digest, _part(numbered, "_copy"))).drop("_copy"), "rows")
