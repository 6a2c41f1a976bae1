"""Reading tables, listing datasets, column listings and profiles."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.operators.prep import is_categorical, is_numeric

_FORMATS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".jsonl": "json", ".orc": "orc",
            ".txt": "text"}


def read_table(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Any Spark source; the format defaults from the extension.  CSV gets
    ``header`` and ``inferSchema`` unless given (pass a schema in production)."""
    if fmt is None:
        ext = os.path.splitext(path.rstrip("/"))[1].lower()
        fmt = _FORMATS.get(ext, "parquet")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options = {"header": "true", "inferSchema": "true", **options}
    return reader.options(**options).load(path)


def list_datasets(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``(path, size, modified)`` of the files under ``root`` (file contents are
    pruned away by the binaryFile source, only metadata is read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(root)
            .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")))


def describe_columns(df: DataFrame) -> DataFrame:
    from tabml.operators.roles import infer_roles
    return infer_roles(df)


def profile(df: DataFrame, cols: list[str] | None = None, exact_distinct: bool = False) -> DataFrame:
    """``(column, n, nulls, distinct, min, max, mean, std)`` (numeric statistics
    are null for non-numeric columns; std is the sample std).  Distinct values
    are HyperLogLog++ estimates in the one aggregate of all columns;
    ``exact_distinct=True`` counts them, each column in an aggregate of its own
    that reads and shuffles the values of this column only."""
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.sum(c.isNull().cast("long")).alias(f"_null{i}"))
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"_dist{i}"))
        if is_numeric(f.dataType):
            x = c.cast("double")
            aggs += [F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}"), F.avg(x).alias(f"_avg{i}"),
                     F.stddev_samp(x).alias(f"_std{i}")]
    row = df.agg(*aggs)
    distinct = [F.col(f"_dist{i}") for i in range(len(fields))]
    if exact_distinct and fields:
        # in one aggregate every row would be kept once per column, with the state of all statistics
        counts = [df.agg(F.countDistinct(F.col(f"`{f.name}`")).alias("d")).select(F.lit(i).alias("i"), "d")
                  for i, f in enumerate(fields)]
        found = reduce(DataFrame.unionAll, counts).agg(F.map_from_entries(F.collect_list(F.struct("i", "d"))).alias("_dist"))
        row = row.crossJoin(F.broadcast(found))  # a row each
        distinct = [F.col("_dist")[i] for i in range(len(fields))]
    structs = []
    for i, f in enumerate(fields):
        num = is_numeric(f.dataType)
        nul = F.lit(None).cast("double")
        structs.append(F.struct(
            F.lit(f.name).alias("column"), F.col("_n").alias("n"), F.col(f"_null{i}").alias("nulls"),
            distinct[i].cast("long").alias("distinct"),
            (F.col(f"_min{i}") if num else nul).alias("min"), (F.col(f"_max{i}") if num else nul).alias("max"),
            (F.col(f"_avg{i}") if num else nul).alias("mean"), (F.col(f"_std{i}") if num else nul).alias("std")))
    return row.select(F.explode(F.array(*structs)).alias("p")).select("p.*")


__all__ = ["read_table", "list_datasets", "describe_columns", "profile", "is_categorical"]
