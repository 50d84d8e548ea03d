"""The staging schema: load files into it, find its tables, read one from a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salvor.sources.files import read_csv

SCHEMA = "stg"


def stage_tables(
    spark: SparkSession,
    files: Mapping[str, str],
    schemas: Mapping[str, T.StructType],
    *,
    schema: str = SCHEMA,
    location: str | None = None,
) -> DataFrame:
    """Replace-load each CSV as table ``schema.name``; one status row per file.

    A missing file is skipped and a failing one does not stop the others. Row counts
    come from the written Parquet footers.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}{where}")
    status = []
    for name, path in files.items():
        try:
            df = read_csv(spark, path, schemas[name])
            df.write.mode("overwrite").saveAsTable(f"{schema}.{name}")
            status.append((name, "loaded", spark.table(f"{schema}.{name}").count()))
        except AnalysisException as error:
            missing = error.getCondition() == "PATH_NOT_FOUND"
            status.append((name, "missing" if missing else "failed", None))
        except PySparkException:
            status.append((name, "failed", None))
    return spark.createDataFrame(status, "table_name string, status string, row_count bigint")


def discover(spark: SparkSession, schema: str = SCHEMA) -> dict[str, DataFrame]:
    """Every table of the schema, by name in sorted order."""
    names = sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)
    return {name: spark.table(f"{schema}.{name}") for name in names}


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, column_count) as one plan."""
    rows = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
        )
        for name, df in tables.items()
    ]
    union = rows[0]
    for row in rows[1:]:
        union = union.unionByName(row)
    return union


def database_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_on: str | None = None,
    low: int = 0,
    high: int = 0,
    parts: int = 1,
    **options: str,
) -> DataFrame:
    """A table of an external database, read in ``parts`` ranges of ``split_on``."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_on:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
        )
    return reader.load()
