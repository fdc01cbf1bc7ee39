"""Readers for the five inputs, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affilix import schemas
from affilix.functions.literals import decode_list


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header whose cells may hold line breaks and doubled quotes. Columns are matched by name.

    Cells are read as text and cast, so extra columns (a stored row index, say) do no harm. An empty cell is NULL.
    """
    wanted = spark.createDataFrame([], schema).schema
    raw = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
        .option("inferSchema", False).csv(path)
    )
    have = set(raw.columns)
    return raw.select(*[
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in wanted
    ])


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.METADATA)


def read_collected(spark: SparkSession, path: str) -> DataFrame:
    """An earlier collection, from Parquet or from CSV with the list as text."""
    if not path.endswith(".csv"):
        return spark.read.schema(schemas.COLLECTED).parquet(path)
    return read_csv(spark, path, schemas.COLLECTED_TEXT).withColumn("affiliate", decode_list(F.col("affiliate")))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    if not path.endswith(".csv"):
        return spark.read.schema(schemas.CACHE).parquet(path)
    return read_csv(spark, path, schemas.CACHE)


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.ADDRESSES)


def read_registry(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The registry: a JSON object with a list ``institutes``, as one file or (``multi_line`` off) one object per line.

    A file of the first kind is read by one task; convert it once.
    """
    institute = spark.createDataFrame([], schemas.INSTITUTES).schema
    whole = T.StructType([T.StructField("institutes", T.ArrayType(institute))])
    rows = spark.read.schema(whole).option("multiLine", multi_line).json(path)
    return rows.select(F.explode("institutes").alias("i")).select("i.*")


def convert_registry(spark: SparkSession, json_path: str, parquet_path: str, files: int = 64) -> DataFrame:
    """Rewrite the JSON registry as Parquet, spread over ``files`` files, and read that."""
    read_registry(spark, json_path).repartition(files, "id").write.parquet(parquet_path)
    return spark.read.schema(schemas.INSTITUTES).parquet(parquet_path)


def read_optional(spark: SparkSession, path: str, reader) -> DataFrame | None:
    """What ``reader`` finds at ``path``, or None if nothing is there: then everything is still to do."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return reader(spark, path) if files.exists(location) else None

