"""Planted inputs over the given tables.

The tables carry almost no natural signal, so targets (and a few nulls) are
planted by fixed SQL rules.  The same SQL text runs in Spark (over temp views
of the parquet files) and in DuckDB (the oracle), so both sides see the same
rows.  These only shape input rows; every operator does its own work on them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# P1 one class target: 3 string classes, numeric + categorical features
P1 = """SELECT p_partkey, p_size, p_retailprice, p_type, p_brand,
       CASE WHEN p_type = 'PROMO' THEN 'A' WHEN p_size <= 25 THEN 'B' ELSE 'C' END AS y
FROM part"""

# P2 regression target, linear and noise free
P2 = """SELECT p_partkey, p_size, p_retailprice, p_type,
       CAST(2 * p_size AS DOUBLE) + 0.5 * p_retailprice
         + CASE WHEN p_type = 'PROMO' THEN CAST(30 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS y
FROM part"""

# P3 two class targets and two regression targets
P3 = """SELECT p_partkey, p_size, p_retailprice, p_type,
       CASE WHEN p_size <= 25 THEN 'small' ELSE 'large' END AS y1,
       CASE WHEN p_retailprice < 950 THEN 0 ELSE 1 END AS y2,
       CAST(2 * p_size AS DOUBLE) AS r1, 0.5 * p_retailprice AS r2
FROM part"""

# P4 nulls for the imputers
P4 = """SELECT p_partkey,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS p_size,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS p_type
FROM part"""

# P5 unseen category: fit on P5_FIT, transform P5_ALL; plus a constant column
P5_FIT = """SELECT p_partkey, p_type, p_size, CAST(5 AS DOUBLE) AS const FROM part WHERE p_type <> 'PROMO'"""
P5_ALL = """SELECT p_partkey, p_type, p_size, CAST(5 AS DOUBLE) AS const FROM part"""

# P6 array features with a linear binary target
P6_SPARK = """SELECT vec_id, embedding, label, embedding[0] > 0 AS y FROM embeddings"""
P6_DUCK = """SELECT vec_id, embedding, label, embedding[1] > 0 AS y FROM embeddings"""

# P7 one-split tree target on two low-cardinality features
P7 = """SELECT l_orderkey, l_linenumber, l_discount, l_tax,
       CAST((l_discount > 0.045) <> (l_linenumber = 1) AS INT) AS y FROM lineitem"""

# P8 class predictions without a model: a never-predicted class and tied scores
P8 = """SELECT o_orderkey, o_orderstatus AS y,
       CASE WHEN o_orderkey % 10 < 6 THEN replace(o_orderstatus, 'P', 'O')
            WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'O' END AS yhat,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS yb,
       ((o_orderkey * 37) % 101 + CASE WHEN o_orderstatus = 'F' THEN 20 ELSE 0 END) / CAST(121 AS DOUBLE) AS score
FROM orders"""

# P9 regression predictions without a model
P9 = """SELECT o_orderkey, o_totalprice AS y,
       o_totalprice + CAST((o_orderkey * 13) % 2001 - 900 AS DOUBLE) AS yhat FROM orders"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """The rows of ``sql`` with the named tables read from ``sf_dir`` (nothing is
    registered in the session, so several folders can be used at once)."""
    for n in tables or TABLES:
        sql = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 parquet.`{sf_dir}/{n}.parquet`", sql)
    return spark.sql(sql)
