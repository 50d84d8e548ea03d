"""Analyses of the claim table alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.scalars import is_yes, pct
from salvor.functions.stats import count_where
from salvor.operators import analysis as A
from salvor.operators import quality as Q

COMPLETENESS = {
    "witness_present_ind": "witness_present_count",
    "policy_report_filed_ind": "policy_report_filed_count",
    "in_network_bodyshop": "in_network_bodyshop_count",
    "accident_key": "accident_key_count",
    "policyholder_key": "policyholder_key_count",
    "vehicle_key": "vehicle_key_count",
    "driver_key": "driver_key_count",
}


def both_indicators(literal: str | None = None) -> Column:
    """Witness present and police report filed; ``literal`` is an exact witness spelling."""
    return is_yes("witness_present_ind", literal) & (F.col("policy_report_filed_ind") == 1)


def total(claim: DataFrame) -> DataFrame:
    return claim.agg(F.count("*").alias("total_claims"))


def preview(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return A.top(df, n, F.col(key).asc())


def completeness(claim: DataFrame) -> DataFrame:
    return Q.completeness(claim, COMPLETENESS)


def by_value(claim: DataFrame, column: str) -> DataFrame:
    return A.distribution(claim, column, "claim_count")


def witness_by_police(claim: DataFrame) -> DataFrame:
    keys = ["witness_present_ind", "policy_report_filed_ind"]
    return (
        claim.groupBy(*keys)
        .agg(F.count("*").alias("claim_count"))
        .orderBy(*[F.asc_nulls_last(k) for k in keys])
    )


def with_both(claim: DataFrame, literal: str | None = None) -> DataFrame:
    """Claims with both indicators and their share of all claims, in one pass."""
    counts = claim.agg(
        count_where(both_indicators(literal)).alias("claims_with_both"), F.count("*").alias("_all")
    )
    return counts.select(
        "claims_with_both", pct(F.col("claims_with_both"), F.col("_all")).alias("percentage_of_total")
    )


def repeated_accidents(claim: DataFrame, more_than: int = 1, k: int = 20) -> DataFrame:
    grouped = claim.groupBy("accident_key").agg(F.count("*").alias("claim_count"))
    return A.top(
        grouped.filter(F.col("claim_count") > more_than),
        k,
        F.desc("claim_count"),
        F.asc_nulls_last("accident_key"),
    )


def distinct_keys(claim: DataFrame) -> DataFrame:
    return claim.agg(
        F.count_distinct("accident_key").alias("unique_accidents"),
        F.count_distinct("policyholder_key").alias("unique_policyholders"),
        F.count_distinct("vehicle_key").alias("unique_vehicles"),
        F.count_distinct("driver_key").alias("unique_drivers"),
    )
