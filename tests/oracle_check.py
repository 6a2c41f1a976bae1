"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Columns are compared sorted by name, rows as a multiset, doubles at 6 digits.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows], [cols[i] for i in order]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE",
          "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def type_diff(sdf, res) -> list:
    """Columns whose Spark type and DuckDB type differ (by name)."""
    st = dict(sdf.dtypes)
    out = []
    for c, t in zip(res.columns, res.types):
        want = _TYPES.get(st.get(c, ""), st.get(c, ""))
        if str(t) != want:
            out.append((c, st.get(c), str(t)))
    return out


def compare(spark, name, fn, sql, sf_dir, con):
    t = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    dt = time.time() - t
    s, scols = rows_of(df.columns, srows)
    if sql is None:
        return dict(name=name, ok=None, rows=len(s), sec=round(dt, 2))
    res = con.sql(sql)
    d, dcols = rows_of(res.columns, res.fetchall())
    types = type_diff(df, res)
    ok = scols == dcols and Counter(s) == Counter(d) and not types
    info = dict(name=name, ok=ok, rows=len(s), oracle_rows=len(d), sec=round(dt, 2))
    if types:
        info["types"] = types
    if not ok:
        info["cols"] = (scols, dcols)
        diff = list((Counter(s) - Counter(d)).elements())[:3]
        info["spark_only"] = diff
        info["oracle_only"] = list((Counter(d) - Counter(s)).elements())[:3]
    return info


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    if os.environ.get("PLAIN_SESSION"):
        # the driver's session may carry none of our settings
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from tabml.session import get_spark
        spark = get_spark("local[8]")
    qs, ors = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            info = compare(spark, name, qs[name], ors.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            info = dict(name=name, ok=False, error=f"{type(e).__name__}: {str(e)[:400]}")
        if info.get("ok") is False:
            bad += 1
        print(info, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")


if __name__ == "__main__":
    main()
