"""Readers and writers. Schemas are always given; nothing scans a file to guess types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salvor.functions.scalars import whole
from salvor.schema import all_strings

# A text no cell holds: with it as the null marker, blanks stay blanks.
_NEVER = "\u0001\u0001"
_FORMAT = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "escape": '"'}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_FORMAT).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, lenient: bool = False) -> DataFrame:
    """Typed CSV scan. ``lenient`` turns a cell that does not parse into null;
    otherwise such a cell fails the read."""
    mode = "PERMISSIVE" if lenient else "FAILFAST"
    return spark.read.schema(schema).options(**_FORMAT, mode=mode, enforceSchema="false").csv(path)


def read_csv_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every column as text; a missing cell is the empty text, never null."""
    text = all_strings(schema)
    df = spark.read.schema(text).options(**_FORMAT, nullValue=_NEVER, emptyValue="").csv(path)
    return df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name) for f in text])


def read_csv_key(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """Typed CSV scan whose key column is cast leniently to a long."""
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == key else f.dataType, True) for f in schema]
    )
    return read_csv(spark, path, as_text, lenient=True).withColumn(key, whole(key))


def write_stage(df: DataFrame, path: str, *partition_by: str) -> None:
    """Parquet hand-over between steps; partition columns prune later reads.

    Rows are first gathered by partition, so a task does not write a small file into
    every one of them; a partition far larger than the others is split again.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_lines(df: DataFrame, path: str) -> None:
    """One text column as lines."""
    df.write.mode("overwrite").text(path)
