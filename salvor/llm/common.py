"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salvor.session import scratch, shared_folder

# White space and words of the contracts.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Bounds of the texts that a function holds as Python strings at once.
BATCH_ROWS, BATCH_BYTES = 512, 2 << 20
SLOTS = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once below the shared folder and read back: later uses scan the files, and a lost
    executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    shared_folder(spark)
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(small: DataFrame, name: str, most_rows: int = 100_000) -> DataFrame:
    """A narrow lookup, staged and counted: marked for broadcast up to ``most_rows``, else joined by shuffle."""
    small = staged(small, name)
    return F.broadcast(small) if small.count() <= most_rows else small


def split_by_slots(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that meet none of ``keys``, the others): the key of every row falls into one of SLOTS hash slots, and those that
    ``keys`` (one column) use are broadcast, SLOTS rows at most. The others hold every row that meets a key, and the few that
    share a slot with one, so a join after it is exact while most rows need no shuffle."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int").alias("_slot")
    used = F.broadcast(keys.select(slot(F.col(keys.columns[0]))).distinct())
    marked = rows.select("*", slot(key))
    return marked.join(used, "_slot", "left_anti").drop("_slot"), marked.join(used, "_slot", "left_semi").drop("_slot")


def thinned(docs: DataFrame, key: Column, decided: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``decided`` (key, keep) takes out: of a key to keep one row stays, of a key not to keep
    none, and rows of other keys stay as they are. Rows travel as one struct, so no column clashes."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), key.alias("key"))
    away, met = split_by_slots(rows, F.col("key"), decided.select("key"))
    met = met.join(decided, "key", "left").filter("keep is null or keep").withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(64)))
    # Rows of a key that repeats without end: first one of each of 64 parts, then one of these.
    for by in (("key", "part"), ("key",)):
        met = met.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(1)))).filter("keep is null or place = 1")
    return away.select("doc.*").unionByName(met.select("doc.*"))


ROWS_A_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def few_rows(spark: SparkSession):
    """Fewer rows in an Arrow batch than Spark's default, for the length of an eager pass over texts."""
    return setting(spark, ROWS_A_BATCH, str(BATCH_ROWS))


def by_batches(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow over texts for a frame that runs later. A session that has Spark's default of 10,000 rows a batch gets
    BATCH_ROWS from here on, as both sides hold a batch; a value of its own stays."""
    conf = df.sparkSession.conf
    if conf.get(ROWS_A_BATCH) == "10000":
        conf.set(ROWS_A_BATCH, str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of an eager action; then the former one is back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def kept(name: tuple, make):
    """What ``make`` gives, once for a Python worker: tasks that follow in its process find it again. Functions of this package
    travel by value, so the interpreter itself holds it."""
    held = sys.__dict__.setdefault("_held_between_tasks", {})
    if name not in held:
        held[name] = make()
    return held[name]


def arrow(schema: pa.Schema, columns: list[Any]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def key60(*columns: Column) -> Column:
    """A uniform whole number below 2^60 that any engine with md5 can state."""
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def remainder4(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; a missing id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4))


def batches(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches with their column ``text`` as str, null as empty, cut to BATCH_ROWS rows and about BATCH_BYTES bytes
    (a longer text is a batch of its own). Spark bounds what it sends at once by bytes."""
    for whole in source:
        filled = np.cumsum(pc.fill_null(pc.binary_length(whole.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < whole.num_rows:
            most = (filled[start - 1] if start else 0) + BATCH_BYTES
            stop = max(start + 1, min(start + BATCH_ROWS, int(np.searchsorted(filled, most, "right"))))
            batch = whole.slice(start, stop - start)
            yield batch, [t or "" for t in batch.column("text").to_pylist()]
            start = stop
