"""Session helpers: a local session for tests, and materialised intermediate tables.

Intermediate results that several branches of a plan read are written as Parquet below the folder the cluster names in
``spark.checkpoint.dir``. They survive lost executors, cut the lineage, and give Spark real sizes to choose joins by.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def local_session(cores: str = "*", app: str = "affilix", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, or a temporary folder in local mode only."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="affilix-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below :func:`shared_root` that no other call returns."""
    return f"{shared_root(spark)}/affilix/{uuid.uuid4().hex}/{label}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so that every branch using it reads files rather than recomputing it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt by a hash of ``columns`` over ``spark.sql.shuffle.partitions`` tasks. For costly work on rows that come
    in few or small files, which Spark would read in one task however many rows they hold."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def tasks_for(df: DataFrame, rows: int, n: int | None = None) -> int:
    """``spark.sql.shuffle.partitions``, or as many more as leave each task about ``rows`` rows of ``df``, which is counted
    unless it is known to have ``n``. A fixed number of tasks would grow with the table."""
    n = df.count() if n is None else n
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // rows))
