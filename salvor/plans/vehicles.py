"""Analyses of vehicles with their claims.

Claims are added up per vehicle (and per claim attribute that stays in the result)
before the join; averages come from the sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.scalars import half_up
from salvor.functions.stats import count_where, pearson
from salvor.operators import analysis as A

CATEGORICAL_CLAIM = ("channel", "claim_day_of_week", "witness_present_ind", "policy_report_filed_ind")
CATEGORICAL_VEHICLE = ("vehicle_category", "vehicle_color")
# Upper bounds and labels of the bands; the last band also takes missing values.
PRICE_BANDS = ((15000, "<15k"), (25000, "15k–25k"), (40000, "25k–40k"))
PRICE_REST = "≥40k"
MILEAGE_BANDS = ((10000, "<10k"), (50000, "10k–50k"), (100000, "50k–100k"))
MILEAGE_REST = "≥100k"


def _measures() -> dict[str, Column]:
    recovered = F.col("subrogation") > 0
    payout = F.col("claim_est_payout")
    parts = {
        "payout": payout,
        "payout_rec": F.when(recovered, payout),
        "payout_non": F.when(F.col("subrogation") == 0, payout),
        "liab_rec": F.when(recovered, F.col("liab_prct")),
    }
    sums = {f"{n}_sum": F.sum(x) for n, x in parts.items()}
    counts = {f"{n}_n": F.count(x) for n, x in parts.items()}
    return {"claims": F.count("*"), "recovered": count_where(recovered), **sums, **counts}


def _joined(claim: DataFrame, vehicle: DataFrame, *extra: str) -> DataFrame:
    return vehicle.join(A.partial_by_key(claim, "vehicle_key", _measures(), *extra), "vehicle_key")


def _mean(total: str, n: str, digits: int) -> Column:
    return half_up(F.try_divide(F.sum(total), F.sum(n)), digits)


def _rate() -> Column:
    return F.round(F.sum("recovered") / F.sum("claims"), 4).alias("subro_rate")


def _claim_to_value() -> Column:
    """Mean of payout / price over claims whose price is present and not zero."""
    price = F.nullif(F.col("vehicle_price"), F.lit(0.0))
    priced = F.when(price.isNotNull(), F.col("payout_n"))
    return F.round(
        F.try_divide(F.sum(F.try_divide(F.col("payout_sum"), price)), F.sum(priced)), 4
    ).alias("avg_claim_to_value_ratio")


def _band(value: str, bands, rest: str) -> tuple[Column, Column]:
    """Label and ordinal of the band a value falls in."""
    label = order = None
    for i, (upper, name) in enumerate(bands, 1):
        below = F.col(value) < upper
        label = F.when(below, name) if label is None else label.when(below, name)
        order = F.when(below, i) if order is None else order.when(below, i)
    return label.otherwise(rest), order.otherwise(len(bands) + 1)


def by_category_color(claim: DataFrame, vehicle: DataFrame) -> DataFrame:
    return (
        _joined(claim, vehicle)
        .groupBy("vehicle_category", "vehicle_color")
        .agg(
            F.sum("claims").alias("num_claims"),
            _rate(),
            _mean("payout_rec_sum", "payout_rec_n", 2).alias("avg_payout_subro"),
            _mean("payout_non_sum", "payout_non_n", 2).alias("avg_payout_non"),
            _claim_to_value(),
        )
        .orderBy("vehicle_category", F.desc("subro_rate"), "vehicle_color")
    )


def by_price_band(claim: DataFrame, vehicle: DataFrame) -> DataFrame:
    label, order = _band("vehicle_price", PRICE_BANDS, PRICE_REST)
    return (
        _joined(claim, vehicle)
        .groupBy(label.alias("price_band"), order.alias("_o"))
        .agg(
            F.sum("claims").alias("num_claims"),
            _rate(),
            _mean("payout_sum", "payout_n", 2).alias("avg_payout"),
            _claim_to_value(),
        )
        .orderBy("_o")
        .drop("_o")
    )


def by_mileage_band(claim: DataFrame, vehicle: DataFrame) -> DataFrame:
    label, order = _band("vehicle_mileage", MILEAGE_BANDS, MILEAGE_REST)
    return (
        _joined(claim, vehicle)
        .groupBy(label.alias("mileage_band"), order.alias("_o"))
        .agg(
            F.sum("claims").alias("num_claims"),
            _rate(),
            _mean("liab_rec_sum", "liab_rec_n", 2).alias("avg_liability_if_subro"),
            _mean("payout_sum", "payout_n", 2).alias("avg_payout"),
        )
        .orderBy("_o")
        .drop("_o")
    )


def by_category_evidence(claim: DataFrame, vehicle: DataFrame) -> DataFrame:
    evidence = ["witness_present_ind", "policy_report_filed_ind"]
    return (
        _joined(claim, vehicle, *evidence)
        .groupBy("vehicle_category", *evidence)
        .agg(F.sum("claims").alias("num_claims"), _rate())
        .orderBy("vehicle_category", F.desc("subro_rate"), F.desc("num_claims"), *evidence)
    )


def by_category_channel(claim: DataFrame, vehicle: DataFrame, at_least: int = 50) -> DataFrame:
    return (
        _joined(claim, vehicle, "channel")
        .groupBy("vehicle_category", "channel")
        .agg(
            F.sum("claims").alias("num_claims"),
            _rate(),
            _mean("payout_sum", "payout_n", 2).alias("avg_payout"),
        )
        .filter(F.col("num_claims") >= at_least)
        .orderBy("vehicle_category", F.desc("subro_rate"), F.desc("num_claims"), "channel")
    )


def claim_means(claim: DataFrame) -> DataFrame:
    return claim.agg(
        F.avg("subrogation").alias("avg_subrogation"),
        F.avg("claim_est_payout").alias("avg_payout"),
        F.avg("liab_prct").alias("avg_liability_pct"),
    )


def vehicle_means(vehicle: DataFrame) -> DataFrame:
    return vehicle.agg(
        F.avg("vehicle_price").alias("avg_vehicle_price"),
        F.avg("vehicle_mileage").alias("avg_mileage"),
        F.avg("vehicle_weight").alias("avg_weight"),
    )


def categorical_check(claim: DataFrame, vehicle: DataFrame) -> DataFrame:
    """(column, value, count) of the six categorical columns, most frequent first."""
    counts = A.value_counts(claim, CATEGORICAL_CLAIM).unionByName(
        A.value_counts(vehicle, CATEGORICAL_VEHICLE)
    )
    return counts.orderBy("column", F.desc("count"), F.asc_nulls_first("value"))


def named_correlations(claim: DataFrame, vehicle: DataFrame) -> DataFrame:
    """Four correlations in one aggregate over the joined rows."""
    both = claim.join(vehicle.select("vehicle_key", "vehicle_price", "vehicle_mileage"), "vehicle_key")
    return both.agg(
        pearson("subrogation", "vehicle_price").alias("corr_subro_price"),
        pearson("subrogation", "vehicle_mileage").alias("corr_subro_mileage"),
        pearson("claim_est_payout", "vehicle_price").alias("corr_payout_price"),
        pearson("subrogation", "liab_prct").alias("corr_subro_liability"),
    )
