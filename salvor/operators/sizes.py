"""Frames kept for a second pass, and frames of one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.session import scratch


def stored(df: DataFrame) -> DataFrame:
    """Compute once and keep as Parquet below the shared folder, where a lost executor cannot lose it: later reads take only
    their columns, and Spark knows the size, so it broadcasts what is small enough without being told."""
    path = scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SLOTS = 1 << 20


def split_by_slots(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that meet none of ``keys``, one column, and the others): hash slots of the keys are broadcast, SLOTS at most. The
    others are all rows of a key in ``keys`` and the few that share a slot with one; no key is in both parts."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int").alias("_slot")
    used = F.broadcast(keys.select(slot(F.col(keys.columns[0]))).distinct())
    marked = rows.select("*", slot(key))
    return marked.join(used, "_slot", "left_anti").drop("_slot"), marked.join(used, "_slot", "left_semi").drop("_slot")


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Every row of ``df`` with the columns of a frame that has one row by construction
    (an aggregate without keys), so the broadcast has a fixed size."""
    return df.join(F.broadcast(one_row), how="cross")
