"""Exact deduplication by content sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salvor.llm.common import SPACES, staged, table, thinned

SALTS = 64
HEAD = 64


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_groups(docs: DataFrame, *, salts: int = SALTS) -> DataFrame:
    """Groups of equal normalised texts: doc_id, keep_id, group_size, kept, text_sha256.

    Sampled splitters range-partition the rows by the text's first HEAD characters, then its SHA-256 and a salt, so
    the sample that the driver sees holds no whole text. Each partition is sorted externally by these and the text, and
    neighbours are compared in full by the window over equal texts. The salt follows the id, so the copies of a hot
    text lie in up to ``salts`` ranges; the heads of these parts (at most ``salts`` a text) meet again by their SHA-256,
    and the few columns of the rows take the result back by (digest, salt), which is spread the same way.

    Null text is the empty text. Rows with equal id and text count each in group_size, and one of
    them is kept. A missing id sorts last and is kept only when its group has no other. An
    empty table gives no rows. Only doc_id and text are read, so other columns cannot clash.
    """
    rows = docs.select("doc_id", normalized(F.col("text")).alias("body")).select(
        "doc_id",
        "body",
        F.substring("body", 1, HEAD).alias("head"),
        F.sha2("body", 256).alias("text_sha256"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
    )
    equal = Window.partitionBy("head", "text_sha256", "salt", "body")
    inside = equal.orderBy(F.col("doc_id").asc_nulls_last())
    local = rows.repartitionByRange("head", "text_sha256", "salt").select(
        "doc_id",
        "text_sha256",
        "salt",
        F.row_number().over(inside).alias("place"),
        F.count("*").over(equal).alias("members"),
    )
    local = staged(local, "exact-local")
    digest = Window.partitionBy("text_sha256")
    heads = local.filter("place = 1").select(
        "text_sha256",
        "salt",
        F.min("doc_id").over(digest).alias("keep_id"),
        F.sum("members").over(digest).alias("group_size"),
        F.row_number().over(digest.orderBy(F.col("doc_id").asc_nulls_last())).alias("rank"),
    )
    return local.join(heads, ["text_sha256", "salt"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("place") == 1) & (F.col("rank") == 1)).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that exact_groups keeps, all columns as they are. Only rows that repeat, or lie in a hash slot of a row
    that goes, are shuffled with their texts after the content sort."""
    key = F.struct(docs["doc_id"].cast("bigint").alias("id"), F.sha2(normalized(docs["text"]), 256).alias("sha"))
    groups = exact_groups(docs).filter("group_size > 1").groupBy(F.struct(F.col("doc_id").cast("bigint").alias("id"), F.col("text_sha256").alias("sha")).alias("key"))
    decided = groups.agg(F.max("kept").alias("keep"), F.count("*").alias("copies")).filter("not keep or copies > 1").drop("copies")
    return thinned(docs, key, staged(decided, "exact-decided"))


def query(spark, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))


SQL = r"""
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents
)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = min(doc_id) over g as kept, text_sha256
from d
window g as (partition by text_sha256)
"""
