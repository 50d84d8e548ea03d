"""Building blocks shared by the named analyses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.scalars import pct
from salvor.functions.stats import pearson


def share_of_total(grouped: DataFrame, count: str, into: str = "percentage") -> DataFrame:
    """Percentage of each group's count; the total is a scalar subquery, not a window
    over all groups, so many groups stay distributed."""
    total = grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn(into, pct(F.col(count), total))


def distribution(df: DataFrame, column: str, count: str) -> DataFrame:
    """Rows and percentage per value, most frequent first."""
    grouped = df.groupBy(column).agg(F.count("*").alias(count))
    return share_of_total(grouped, count).orderBy(F.desc(count), F.asc_nulls_first(column))


def row_count(df: DataFrame) -> Column:
    """The frame's row count as a scalar subquery."""
    return df.agg(F.count("*")).scalar()


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows of a total order (planned as a take-ordered, not a full sort)."""
    return df.orderBy(*order).limit(k)


def partial_by_key(fact: DataFrame, key: str, measures: Mapping[str, Column], *extra: str) -> DataFrame:
    """Fact measures added up per foreign key before the dimension is joined.

    The join then sees one row per key, however hot a key is in the fact.
    """
    return fact.filter(F.col(key).isNotNull()).groupBy(key, *extra).agg(
        *[m.alias(name) for name, m in measures.items()]
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count) of several categorical columns in one pass."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(entries).alias("_e"))
        .groupBy("_e.column", "_e.value")
        .agg(F.count("*").alias("count"))
    )


def correlations(df: DataFrame, target: str, columns: Sequence[str], into: str) -> DataFrame:
    """(column, corr) of every column with the target from a single aggregate."""
    entries = [F.struct(F.lit(c).alias("column"), pearson(c, target).alias(into)) for c in columns]
    long = df.agg(F.array(*entries).alias("_e")).select(F.explode("_e").alias("_e")).select("_e.*")
    return long.orderBy(F.desc_nulls_first(into), "column")
