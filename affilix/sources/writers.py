"""Sinks. A run never writes over files its own plan reads: every run has its own folder."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affilix.functions.literals import encode_list


def write_run(df: DataFrame, path: str) -> str:
    """Write Parquet to a new folder ``path/run=...`` and return it. Earlier runs stay readable meanwhile."""
    stamp = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
    target = f"{path.rstrip('/')}/run={stamp}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(target)
    return target


def latest_run(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest finished run below ``path``, or None."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return None
    runs = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith("run=")]
    done = [r for r in runs if files.exists(spark._jvm.org.apache.hadoop.fs.Path(r, "_SUCCESS"))]
    return max((r.toString() for r in done), default=None)


def read_latest(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The newest run's table, or None when there is none."""
    run = latest_run(spark, path)
    return None if run is None else spark.read.schema(schema).parquet(run)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder that :mod:`affilix.sources.readers` reads back; lists become list literals."""
    flat = [
        encode_list(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema
    ]
    df.select(*flat).write.option("header", True).option("escape", '"').option("quote", '"').csv(path)
