"""Token ids as ORC: run-length encoded stripes in ascending document order, with row indexes and Bloom filters."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salvor.llm.common import arrow, batches, bounded, few_rows, kept, staged, table
from salvor.llm.packing import END_ID, WordIds
from salvor.session import scratch

# A row holds at most so many ids; longer documents are several rows, so that a batch of rows of the format's
# reader or writer (4096 and 1024) has a bounded size.
PIECE_IDS = 4096
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
FALSE_POSITIVES = 0.01
# part: the writing task, in document order; at: ids of the part before the document; first: ids of the document before the row.
ROW = "part int, at long, doc_id long, n_tokens long, first long, ids array<int>"


def write(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = END_ID, piece_ids: int = PIECE_IDS, stripe_bytes: int = STRIPE_BYTES,
          index_rows: int = INDEX_ROWS, false_positives: float = FALSE_POSITIVES, parts: int | None = None) -> None:
    """Write the ids of every whole text, each with ``end_id`` at its end, in ascending doc_id order.

    Rows are dealt by sampled ranges of (doc_id, hash of the text), sorted and encoded in one pass: the tasks' files
    follow each other in that order, and each task counts the ids it has written, so no second pass numbers them.
    The third sort key deals rows that are equal in both over several ranges.

    Null text is the end id alone. A missing id comes last; equal ids go by their texts' hash and text, and
    rows that repeat are written each. An empty table gives files without rows. Only doc_id and text are read.
    """
    key = [F.col("doc_id").asc_nulls_last(), F.col("hashed").asc()]
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "coalesce(text, '') text", "xxhash64(text) hashed", "monotonically_increasing_id() salt")
    dealt = rows.repartitionByRange(*[parts] if parts else [], *key, F.col("salt").asc()).sortWithinPartitions(*key, "text")
    schema = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("first", pa.int64()), ("ids", pa.list_(pa.int32()))])
    end = np.array([end_id], "<u4").tobytes()

    def encode(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, at = kept(("words", tokenizer), lambda: WordIds(tokenizer)), TaskContext.get().partitionId(), 0
        for batch, texts in batches(source):
            made, ids, ends = [], [], [0]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                ids.append(words.text(text) + end)
                n = len(ids[-1]) // 4
                for first in range(0, n, piece_ids):
                    made.append((part, at, doc_id, n, first))
                    ends.append(ends[-1] + min(piece_ids, n - first))
                at += n
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
            columns = [pa.array(c, t) for c, t in zip(zip(*made), schema.types)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*columns, lists], schema=schema)

    encoded = dealt.select("doc_id", "text").mapInArrow(encode, ROW)
    writer = (
        encoded.write.option("compression", "zstd")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", index_rows)
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.rows.between.memory.checks", index_rows)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", false_positives)
    )
    with few_rows(docs.sparkSession):
        writer.orc(path)


def rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows as written. Splits of a file read stripes of their own; a filter on doc_id passes over
    stripes and row groups by their bounds and Bloom filters."""
    return spark.read.schema(ROW).orc(path)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """part and the ids of all parts before it, from two narrow columns. There is a row for each writing task."""
    sizes = rows(spark, path).groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))


def joined_crc(parts: list[dict]) -> int:
    """crc32 of pieces one after another from the crc32 of each: over n zero bytes a start value
    changes as it does over any other n bytes."""
    whole = 0
    for part in parts:
        zeros = bytes(4 * part["length"])
        whole = zlib.crc32(zeros, whole) ^ zlib.crc32(zeros) ^ part["crc"]
    return whole


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 (of the ids as little-endian 32-bit
    numbers) of every document, read back from the files. Only the rows of documents longer than a piece are grouped."""
    schema = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("first", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())])

    def digest(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            lists = batch.column("ids")
            bounds, ids = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            kept = [batch.column(n) for n in ("part", "at", "doc_id", "n_tokens", "first")]
            yield arrow(schema, [*kept, np.diff(bounds), crc])

    @F.pandas_udf("long")
    def join(pieces: pd.Series) -> pd.Series:
        return pd.Series([joined_crc(p) for p in pieces], dtype="int64")

    pieces = rows(spark, path).mapInArrow(digest, "part int, at long, doc_id long, n_tokens long, first long, length long, crc long")
    pieces = staged(pieces, "token-digests")  # narrow, and read twice
    whole = pieces.filter("length = n_tokens").select("part", "at", "doc_id", "n_tokens", "crc")
    cut = pieces.filter("length < n_tokens").groupBy("part", "at", "doc_id", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("first", "length", "crc"))).alias("pieces"))
    found = whole.unionByName(cut.select("part", "at", "doc_id", "n_tokens", join("pieces").alias("crc")))
    placed = found.join(bounded(part_starts(spark, path), "token-parts"), "part")
    return placed.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"))


def lookup(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """doc_id, n_tokens and all ids of the documents of that id, by pushed-down equality; ids that no file holds give no rows."""
    found = rows(spark, path).filter(F.col("doc_id").isin(list(doc_ids)))
    pieces = found.groupBy("part", "at", "doc_id", "n_tokens").agg(F.array_sort(F.collect_list(F.struct("first", "ids"))).alias("pieces"))
    return pieces.select("doc_id", "n_tokens", F.flatten("pieces.ids").alias("ids"))


def query(spark, folder: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-ids")
    write(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return checksums(spark, path)
