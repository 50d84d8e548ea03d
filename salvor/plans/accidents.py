"""Analyses of accidents, alone and joined with claims.

Claims are added up per accident before the join, so the join moves one row per
accident however many claims it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.scalars import is_yes, pct
from salvor.functions.stats import count_where, distinct_with_null
from salvor.operators import analysis as A
from salvor.plans.claims import both_indicators

def _multi() -> Column:
    return F.col("accident_type").contains("multi_vehicle")


def totals(accident: DataFrame) -> DataFrame:
    return accident.agg(
        F.count("*").alias("total_accidents"),
        distinct_with_null("accident_site").alias("unique_sites"),
        distinct_with_null("accident_type").alias("unique_types"),
    )


def by_value(accident: DataFrame, column: str) -> DataFrame:
    return A.distribution(accident, column, "accident_count")


def multi_vehicle(accident: DataFrame) -> DataFrame:
    grouped = accident.filter(_multi()).groupBy("accident_type").agg(F.count("*").alias("multi_vehicle_count"))
    share = pct(F.col("multi_vehicle_count"), A.row_count(accident))
    return grouped.withColumn("percentage_of_all", share).orderBy(
        F.desc("multi_vehicle_count"), "accident_type"
    )


def site_by_type(accident: DataFrame, k: int = 20) -> DataFrame:
    grouped = accident.groupBy("accident_site", "accident_type").agg(F.count("*").alias("accident_count"))
    return A.top(grouped, k, F.desc("accident_count"), F.col("accident_site"), F.col("accident_type"))


def join_accident_claim(accident: DataFrame, claim: DataFrame) -> DataFrame:
    return accident.join(claim, "accident_key")


def joined_sample(accident: DataFrame, claim: DataFrame, k: int = 20) -> DataFrame:
    """First k joined rows by claim number.

    The k earliest claims that have an accident are found before the join.
    """
    known = claim.join(accident.select("accident_key"), "accident_key", "left_semi")
    first = A.top(known, k, F.col("claim_number").asc())
    return join_accident_claim(accident, first).select(
        "claim_number",
        "accident_key",
        "accident_site",
        "accident_type",
        "witness_present_ind",
        "policy_report_filed_ind",
        "in_network_bodyshop",
    )


def _per_accident(claim: DataFrame, literal: str | None) -> DataFrame:
    return A.partial_by_key(
        claim,
        "accident_key",
        {
            "claims": F.count("*"),
            "witness": count_where(is_yes("witness_present_ind", literal)),
            "police": count_where(F.col("policy_report_filed_ind") == 1),
            "both": count_where(both_indicators(literal)),
        },
    )


def high_potential(accident: DataFrame, claim: DataFrame, literal: str | None = None) -> DataFrame:
    """Multi-vehicle groups with claims that have both indicators, % of all claims."""
    grouped = (
        accident.filter(_multi())
        .join(_per_accident(claim, literal).filter(F.col("both") > 0), "accident_key")
        .groupBy("accident_type", "accident_site")
        .agg(F.sum("both").alias("high_potential_claims"))
    )
    share = pct(F.col("high_potential_claims"), A.row_count(claim))
    return grouped.withColumn("percentage_of_claims", share).orderBy(
        F.desc("high_potential_claims"), "accident_type", "accident_site"
    )


def indicators_by(accident: DataFrame, claim: DataFrame, column: str, literal: str | None = None) -> DataFrame:
    """Indicator counts and potential % per accident type or site."""
    grouped = (
        accident.join(_per_accident(claim, literal), "accident_key")
        .groupBy(column)
        .agg(
            F.sum("claims").alias("total_claims"),
            F.sum("witness").alias("claims_with_witness"),
            F.sum("police").alias("claims_with_police_report"),
            F.sum("both").alias("claims_with_both"),
        )
    )
    potential = pct(F.col("claims_with_both"), F.col("total_claims"))
    return grouped.withColumn("subrogation_potential_pct", potential).orderBy(
        F.desc("subrogation_potential_pct"), column
    )


def priority_view(accident: DataFrame, claim: DataFrame, literal: str | None = None) -> DataFrame:
    """Per accident: counts and High / Medium / Low priority."""
    counted = accident.join(_per_accident(claim, literal), "accident_key").select(
        "accident_key",
        "accident_site",
        "accident_type",
        F.col("claims").alias("claim_count"),
        F.col("witness").alias("witness_count"),
        F.col("police").alias("police_report_count"),
    )
    priority = (
        F.when(_multi() & (F.col("witness_count") > 0) & (F.col("police_report_count") > 0), "High")
        .when(_multi(), "Medium")
        .otherwise("Low")
    )
    return counted.withColumn("subrogation_priority", priority).orderBy(
        "subrogation_priority", F.desc("claim_count"), "accident_key"
    )
