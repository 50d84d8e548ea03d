"""Analyses of drivers, alone and joined with claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salvor.operators import analysis as A
from salvor.operators import ordering as O



def by_gender(driver: DataFrame) -> DataFrame:
    return driver.groupBy("gender").agg(
        F.count("*").alias("total_drivers"),
        F.round(F.avg("age_of_DL"), 1).alias("avg_age_when_got_DL"),
        F.round(F.avg("safety_rating"), 2).alias("avg_safety_rating"),
    )


def licence_age_group(age: Column) -> Column:
    """Early / Young / Mid / Late; a missing age is Late."""
    return (
        F.when(age < 18, "Early")
        .when(age.between(18, 25), "Young")
        .when(age.between(26, 40), "Mid")
        .otherwise("Late")
    )


def by_licence_age(driver: DataFrame) -> DataFrame:
    return (
        driver.groupBy(licence_age_group(F.col("age_of_DL")).alias("dl_age_group"), "gender")
        .agg(F.count("*").alias("total_drivers"), F.round(F.avg("safety_rating"), 2).alias("avg_safety_rating"))
        .orderBy("dl_age_group", "gender")
    )


def quartile_label(rank: Column) -> Column:
    return (
        F.when(rank <= 0.25, "bottom_quartile").when(rank >= 0.75, "top_quartile").otherwise("middle_50pct")
    )


def safety_ranks(driver: DataFrame) -> DataFrame:
    """Every driver with its percent rank inside its gender and the quartile label."""
    ranks = O.percent_ranks(driver, "safety_rating", ["gender"])
    same = F.col("d.gender").eqNullSafe(F.col("r.gender")) & F.col("d.safety_rating").eqNullSafe(
        F.col("r.safety_rating")
    )
    joined = driver.alias("d").join(ranks.alias("r"), same, "left")
    return joined.select(
        "d.driver_key",
        "d.gender",
        "d.safety_rating",
        "r.p_rank",
        quartile_label(F.col("r.p_rank")).alias("group_label"),
    )


def safety_quartiles(driver: DataFrame) -> DataFrame:
    """Median rating of each quartile group against the median of its gender.

    Works on the frequency table (gender, rating) only: equal ratings share a rank,
    so no driver row is sorted. Drivers without a gender belong to no group.
    """
    driver = driver.filter(F.col("gender").isNotNull())
    ranks = O.percent_ranks(driver, "safety_rating", ["gender"]).withColumn(
        "group_label", quartile_label(F.col("p_rank"))
    )
    keys = ["gender", "group_label"]
    rated = ranks.filter(F.col("safety_rating").isNotNull())
    groups = O.exact_quantiles(rated, "safety_rating", [0.5], by=keys)
    genders = O.exact_quantiles(rated, "safety_rating", [0.5], by=["gender"])
    counts = ranks.groupBy(*keys).agg(F.sum("n").alias("driver_count"))
    median = F.col("q")[0]
    return (
        counts.join(groups.select(*keys, median.alias("median_group")), keys, "left")
        .join(genders.select("gender", median.alias("median_total_gender")), "gender", "left")
        .select(
            "gender",
            "group_label",
            "driver_count",
            "median_group",
            "median_total_gender",
            (F.col("median_group") - F.col("median_total_gender")).alias("diff_from_total_median"),
        )
        .orderBy(*keys)
    )


def merge_driver_claim(driver: DataFrame, claim: DataFrame) -> DataFrame:
    return driver.join(claim, "driver_key")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def label_correlations(driver: DataFrame, claim: DataFrame, target: str = "subrogation") -> DataFrame:
    """Correlation of every numeric column with the label, highest first."""
    merged = merge_driver_claim(driver, claim)
    columns = [c for c in numeric_columns(merged) if c != target]
    return A.correlations(merged, target, columns, f"corr_with_{target}")
