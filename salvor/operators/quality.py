"""Declarative data-quality rules; each report is one pass over its frame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salvor.functions.scalars import stripped
from salvor.operators.normalize import attach_dimensions
from salvor.schema import DIMENSION_KEYS

# The spellings the witness column may hold.
WITNESS_VALUES = ("Y", "N", "Yes", "No", "y", "n")
REQUIRED = {
    "claim": ("claim_number", "claim_date", "subrogation"),
    "accident": ("accident_key", "accident_type", "accident_site"),
}


def _long(df: DataFrame, entries: list[Column], names: str) -> DataFrame:
    """One aggregated row of structs -> one row per entry."""
    return df.agg(F.array(*entries).alias("_e")).select(F.explode("_e").alias("_e")).select(names)


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations): rows where the rule is false or missing; one aggregate."""
    entries = [
        F.struct(
            F.lit(name).alias("rule"),
            F.count_if(~F.coalesce(rule, F.lit(False))).alias("violations"),
        )
        for name, rule in rules.items()
    ]
    return _long(df, entries, "_e.*")


def has_columns(df: DataFrame, names: Iterable[str]) -> Column:
    return F.lit(all(n in df.columns for n in names))


def claim_rules(df: DataFrame) -> dict[str, Column]:
    c = F.col
    return {
        "required_columns": has_columns(df, REQUIRED["claim"]),
        "label_is_0_or_1": c("subrogation").isin(0, 1),
        "liability_0_to_100": c("liab_prct").between(0, 100),
        "payout_positive": c("claim_est_payout") > 0,
        "witness_known": c("witness_present_ind").isin(*WITNESS_VALUES),
        "date_castable": c("claim_date").try_cast("timestamp_ntz").isNotNull(),
        "payout_numeric": c("claim_est_payout").try_cast("double").isNotNull(),
        "liability_numeric": c("liab_prct").try_cast("double").isNotNull(),
    }


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row (none = the key is unique)."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def profile(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null, rows) of every column."""
    entries = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.count(F.col(f.name)).alias("non_null"),
            F.count("*").alias("rows"),
        )
        for f in df.schema
    ]
    return _long(df, entries, "_e.*")


def uncastable(df: DataFrame, columns: Iterable[str], kind: str = "double") -> DataFrame:
    """(column, value, n) of values that are present, not blank and do not cast.

    All columns in one pass; a column the frame lacks is skipped.
    """
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns
        if c in df.columns
    ]
    value = F.col("value")
    return (
        df.select(F.explode(F.array(*entries)).alias("_e"))
        .select("_e.*")
        .filter(value.isNotNull() & (stripped(value) != "") & value.try_cast(kind).isNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "column", "value")
    )


def completeness(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Row count and present count of each named column (``{column: output}``)."""
    return df.agg(
        F.count("*").alias("total_records"),
        *[F.count(F.col(c)).alias(out) for c, out in columns.items()],
    )


def join_integrity(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Rows before and after attaching the dimensions, and the columns each brought."""
    joined = attach_dimensions(fact, dimensions)
    brought = [
        F.lit(int(all(c in joined.columns for c in dim.columns))).alias(f"has_{name}")
        for name, dim in dimensions.items()
    ]
    keys = list(DIMENSION_KEYS.values())
    before = fact.agg(F.count("*")).scalar()
    # Count a column of every dimension; the counts guard the result, or the joins would be pruned away.
    touched = [F.count(F.col(next(c for c in d.columns if c not in keys))) for d in dimensions.values()]
    after = joined.agg(F.count("*").alias("joined_rows"), *[t.alias(f"_t{i}") for i, t in enumerate(touched)])
    guards = [F.col(f"_t{i}") >= 0 for i in range(len(touched))]
    whole = F.when(reduce(and_, guards, F.lit(True)), F.col("joined_rows")).alias("joined_rows")
    return after.select(before.alias("fact_rows"), whole, *brought)


def feature_rules(df: DataFrame, selected: Iterable[str]) -> dict[str, Column]:
    """Rules of a finished feature frame."""
    c = F.col
    critical = ("age_at_claim", "period_of_driving", "liab_prct", "is_weekend", "is_single_car")
    binary = ("is_weekend", "is_weekday", "is_young_driver", "is_single_car", "has_witness", "has_police")
    numeric = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    selected = list(selected)
    rules = {f"present_{n}": c(n).isNotNull() for n in critical if n in df.columns}
    rules |= {f"binary_{n}": c(n).isin(0, 1) for n in binary if n in df.columns}
    infinite = F.lit(float("inf"))
    finite = [F.coalesce(F.abs(c(n)) < infinite, F.lit(True)) for n in numeric]
    rules |= {
        "age_16_to_100": c("age_at_claim").between(16, 100),
        "liability_0_to_100": c("liab_prct").between(0, 100),
        "no_infinity": F.forall(F.array(*finite), lambda ok: ok) if finite else F.lit(True),
        "column_names": F.lit(not any(" " in n or n.startswith("_") for n in df.columns)),
        "selected_coverage": F.lit(sum(s in df.columns for s in selected) > 0.9 * len(selected)),
    }
    return rules
