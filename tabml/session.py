"""Session helpers.

On a cluster the session comes from the platform and already names a shared
``spark.checkpoint.dir``; we only read it.  A local folder is set only when
the setting is absent (tests, the bench), never on a cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, partitions: int = 8, app: str = "tabml") -> SparkSession:
    """``partitions`` is for a local ``master`` only: on a cluster the platform's
    own number of shuffle partitions stays."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TABML_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` or an already registered
    checkpoint folder).  Only when neither exists and the master is local (tests,
    the bench) a fresh scratch folder is created and registered; on a cluster the
    setting must be given.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            # a machine-local folder is wrong on a cluster: the shared one must be named
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        d = tempfile.mkdtemp(prefix="tabml-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def written(df, name: str):
    """``df`` written once as Parquet under the shared checkpoint folder and read
    back: for a small intermediate result that is used more than once."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tabml-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def active_spark() -> SparkSession:
    """The running session, also from worker threads (where the thread-local
    active session is unset)."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


#: rows below which more tasks only add overhead to each iteration
_SPREAD_ROWS = 50_000


def spread(df, rows: int | None = None, min_rows: int = _SPREAD_ROWS, min_bytes: int = 4 * 1024 * 1024):
    """Give an iterative fit every core: an input with fewer partitions than
    the default parallelism (a table read as one or a few splits) is
    repartitioned round-robin.  Inputs that already have enough partitions,
    and small inputs (fewer than ``min_rows`` rows when the caller knows the
    count, else a Catalyst size estimate below ``min_bytes``), where more tasks
    only add per-iteration overhead, are left alone."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    if rows is not None:
        big = rows >= min_rows
    else:
        big = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= min_bytes
    return df.repartition(want) if big else df


def at_most(df, rows: int, task_rows: int):
    """``df``, of ``rows`` rows, in partitions of no more than about ``task_rows``;
    small inputs are left alone."""
    want = -(-rows // max(1, task_rows))
    return df if rows < _SPREAD_ROWS or df.rdd.getNumPartitions() >= want else df.repartition(want)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tabml`` importable in the Python workers (pandas UDFs, mapInPandas
    and cogroups unpickle functions that live in this package): zip the package
    once and hand it to ``SparkContext.addPyFile``, which distributes it to every
    executor, the same way ``spark-submit --py-files`` does."""
    import os
    import zipfile

    sc = spark.sparkContext
    sid = sc.applicationId
    if sid in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="tabml-pkg-"), "tabml.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sid)
