"""Linear and logistic regressions with their summaries, on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.scalars import flag, is_yes, to_bool
from salvor.operators.evaluate import regression_metrics
from salvor.operators.prep import hash_split, label_codes, label_encode
from salvor.operators.sizes import stored

C = F.col
PAYOUT_FEATURES = (
    "is_multi_vehicle",
    "has_witness",
    "has_police_report",
    "in_network",
    "has_subrogation",
    "liab_prct",
    "accident_site_encoded",
    "accident_type_encoded",
    "channel_encoded",
)
LABEL_FEATURES = ("vehicle_price", "claim_est_payout", "liab_prct", "witness_present", "policy_report_filed")
LOGIT_FEATURES = ("liab_prct", "accident_key", "policy_report_filed_ind", "safety_rating")


def assembled(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    """``keep`` columns and one vector; rows with a missing feature are left out."""
    features = list(features)
    rows = df.select(*keep, *[C(f).cast("double").alias(f"_f_{f}") for f in features]).dropna()
    return VectorAssembler(inputCols=[f"_f_{f}" for f in features], outputCol="features").transform(rows).select(
        *keep, "features"
    )


def flat_columns(df: DataFrame, features: Sequence[str]) -> set[str]:
    """Features with a single value; one row of 2 x features comes back."""
    row = df.agg(*[(F.min(C(f)) == F.max(C(f))).alias(f) for f in features]).first()
    return {f for f in features if row[f] is not False}


def payout_frame(accident: DataFrame, claim: DataFrame, literal: str | None = None) -> DataFrame:
    """Model frame of the payout regression; categories as codes in text order."""
    joined = accident.join(claim, "accident_key").select(
        "claim_number",
        "claim_est_payout",
        "accident_site",
        "accident_type",
        "channel",
        flag(C("accident_type").contains("multi_vehicle")).alias("is_multi_vehicle"),
        flag(is_yes("witness_present_ind", literal)).alias("has_witness"),
        flag(C("policy_report_filed_ind") == 1).alias("has_police_report"),
        flag(is_yes("in_network_bodyshop", literal)).alias("in_network"),
        C("subrogation").alias("has_subrogation"),
        "liab_prct",
    )
    for column, source in (("accident_site", accident), ("accident_type", accident), ("channel", claim)):
        codes = label_codes([source], column)
        joined = label_encode(joined, codes, column, f"{column}_encoded", keep_missing=True)
    return joined.dropna(subset=[*PAYOUT_FEATURES, "claim_est_payout"])


def fit_linear(df: DataFrame, features: Sequence[str], label: str):
    """(model, fitted features): least squares by normal equations, one pass over the rows.

    Features with a single value are left out of the fit; they carry no information.
    """
    flat = flat_columns(df, features)
    used = [f for f in features if f not in flat]
    rows = assembled(df, used, label)
    return LinearRegression(labelCol=label, solver="normal", regParam=0.0).fit(rows), used


def payout_regression(frame: DataFrame, test_percent: int = 20) -> DataFrame:
    """(metric, value): mse and r2 on the held-out rows, row count, coefficients, intercept."""
    frame = stored(frame.select("claim_number", "claim_est_payout", *PAYOUT_FEATURES))
    held = hash_split("claim_number", test_percent)
    model, used = fit_linear(frame.filter(~held), PAYOUT_FEATURES, "claim_est_payout")
    weights = dict(zip(used, (float(x) for x in model.coefficients)))
    guess = F.lit(float(model.intercept))
    for f, w in weights.items():
        guess = guess + C(f) * w
    scored = frame.filter(held).select("claim_est_payout", guess.alias("prediction"))
    metrics = regression_metrics(scored, "claim_est_payout", "prediction").select("mse", C("r2").alias("r2_score"))
    fixed = [("num_samples", F.lit(float(frame.count())))]
    fixed += [(f"coef_{f}", F.lit(weights.get(f, 0.0))) for f in PAYOUT_FEATURES]
    fixed += [("intercept", F.lit(float(model.intercept)))]
    rows = [F.struct(F.lit(n).alias("metric"), C(n).alias("value")) for n in ("mse", "r2_score")]
    rows += [F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in fixed]
    return metrics.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def ranked_coefficients(metrics: DataFrame) -> DataFrame:
    """(feature, coefficient, abs_coefficient), largest first."""
    return (
        metrics.filter(C("metric").startswith("coef_"))
        .select(
            F.substring(C("metric"), F.lit(6), F.length("metric")).alias("feature"),
            C("value").alias("coefficient"),
            F.abs("value").alias("abs_coefficient"),
        )
        .orderBy(F.desc("abs_coefficient"), "feature")
    )


def _terms(df: DataFrame, names: Sequence[str], *lists: Sequence[float]) -> DataFrame:
    """One row per model term (a fixed handful)."""
    rows = [(n, *[float(x) for x in values]) for n, *values in zip(names, *lists)]
    return df.sparkSession.createDataFrame(
        rows, "term string, coef double, std_err double, t double, p_value double"
    )


def label_frame(claim: DataFrame, vehicle: DataFrame) -> DataFrame:
    return claim.join(vehicle.select("vehicle_key", "vehicle_price"), "vehicle_key").select(
        C("subrogation").cast("double").alias("subrogation"),
        "vehicle_price",
        "claim_est_payout",
        "liab_prct",
        to_bool("witness_present_ind").alias("witness_present"),
        to_bool("policy_report_filed_ind").alias("policy_report_filed"),
    ).dropna()


def label_regression(frame: DataFrame) -> DataFrame:
    """Linear probability model: (term, coef, std_err, t, p_value, r2, n)."""
    frame = stored(frame)  # the fit and its summary pass over it several times
    model, used = fit_linear(frame, LABEL_FEATURES, "subrogation")
    s = model.summary
    terms = _terms(
        frame,
        [*used, "const"],
        [*model.coefficients, model.intercept],
        s.coefficientStandardErrors,
        s.tValues,
        s.pValues,
    )
    return terms.withColumns({"r2": F.lit(float(s.r2)), "n": F.lit(int(s.numInstances))})


def logit_frame(driver: DataFrame, claim: DataFrame) -> DataFrame:
    return claim.join(driver.select("driver_key", "safety_rating"), "driver_key").select(
        C("subrogation").cast("double").alias("subrogation"), *LOGIT_FEATURES
    ).dropna()


def interaction(left: str, right: str) -> Column:
    return C(left).cast("double") * C(right)


def logistic_regression(frame: DataFrame) -> DataFrame:
    """Logit with one interaction: (term, coef, std_err, t, p_value, pseudo_r2, n)."""
    name = "liab_prct:safety_rating"
    rows = frame.withColumn("liab_x_safety", interaction("liab_prct", "safety_rating"))
    inputs = assembled(stored(rows), [*LOGIT_FEATURES, "liab_x_safety"], "subrogation")
    model = GeneralizedLinearRegression(family="binomial", link="logit", labelCol="subrogation").fit(inputs)
    s = model.summary
    terms = _terms(
        frame,
        [*LOGIT_FEATURES, name, "const"],
        [*model.coefficients, model.intercept],
        s.coefficientStandardErrors,
        s.tValues,
        s.pValues,
    )
    pseudo = 1 - s.deviance / s.nullDeviance
    return terms.withColumns({"pseudo_r2": F.lit(float(pseudo)), "n": F.lit(int(s.numInstances))})
