"""Claim features: one pass of projections over the wide claim frame.

``fit`` learns thirteen statistics of a training frame, ``transform`` applies them to
any frame. Everything is row-local except the statistics and the three-quarter marks
behind the "high" flags, which always come from the frame at hand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.scalars import clip, num
from salvor.operators.normalize import pick
from salvor.operators.ordering import exact_quantiles
from salvor.operators.sizes import beside, stored
from salvor.session import compiled_methods

C = F.col
MONEY = ("annual_income", "vehicle_price", "vehicle_weight", "claim_est_payout")
# Column -> output flag for values above the frame's own three-quarter mark.
HIGH_FLAGS = {
    "vehicle_mileage": "is_high_mileage",
    "annual_income": "is_high_income",
    "vehicle_price": "is_expensive_car",
    "claim_est_payout": "is_large_payout",
}
CATEGORICAL = ("gender", "vehicle_category", "channel")
ENCODED = ("accident_type", "accident_site", "zip3", "accident_combo")

# Liability percentages that get a flag of their own.
EXACT_LIABILITY = (15, 18, 20, 22, 25, 27, 30, 32, 35, 37, 40, 45, 50)

# The selected model features.
SELECTED = """
is_single_car liab_x_witness liab_inverse liab_x_highway has_witness high_education address_change
is_parking liab_40_plus is_multi_clear liab_prct liab_20_30 liab_squared liab_cubed liab_sqrt
liab_inverse_sq liab_log liab_zero liab_full liab_half liab_0_10 liab_10_20 liab_30_40 liab_x_police
liab_x_evidence_count liab_inverse_x_evidence liab_20_30_x_multi_unclear liab_20_30_x_single
low_liab_x_multi high_liab_x_single liab_x_intersection liab_x_weekend liab_x_rush_hour liab_x_night
liab_x_young_driver liab_x_new_driver liab_inverse_x_experienced liab_x_past_claims
liab_inverse_x_no_claims liab_x_payout_ratio liab_inverse_x_high_income liab_20_30_x_multi_x_evidence
low_liab_x_single_x_no_evidence high_liab_x_weekend_x_night golden_combo has_police evidence_count
has_full_evidence has_no_evidence in_network safety_rating safety_high safety_low is_multi_unclear
is_highway is_intersection age_at_claim period_of_driving is_young_driver is_senior_driver
is_mid_age_driver is_new_driver is_experienced past_num_of_claims claims_per_year has_past_claims
has_multiple_claims vehicle_mileage mileage_per_year mileage_log is_high_mileage annual_income_capped
annual_income_log vehicle_price_capped vehicle_price_log vehicle_weight_capped vehicle_weight_log
claim_est_payout_capped claim_est_payout_log payout_to_income payout_to_price income_to_price
is_high_income is_expensive_car is_large_payout is_weekend is_weekday is_morning is_afternoon
is_evening is_night is_rush_hour is_winter is_summer
""".split()

# The short feature list of the single-model run (categoricals come on top).
SHORT_LIST = """
liab_prct liab_inverse liab_x_witness has_witness has_police evidence_count is_single_car
is_multi_unclear is_highway is_parking liab_20_30 liab_squared age_at_claim period_of_driving
is_young_driver past_num_of_claims vehicle_mileage annual_income_capped vehicle_price_capped
claim_est_payout_capped payout_to_income safety_rating high_education address_change
""".split()


# --- fitted statistics -------------------------------------------------------


def value_counts(df: DataFrame) -> DataFrame:
    """(column, value, n) of the five fitted columns, stored; missing is a value of its own.

    One narrow scan and one shuffle of already combined counts. Both quantile passes read this table.
    """
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), num(c).alias("value")) for c in ("vehicle_mileage", *MONEY)]
    )
    return stored(
        df.select(F.explode(entries).alias("_e"))
        .groupBy(C("_e.column").alias("column"), C("_e.value").alias("value"))
        .agg(F.count("*").alias("n"))
    )


def fit(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row of thirteen statistics of the training frame. ``counts`` are its ``value_counts``, where they are at hand."""
    counts = value_counts(df) if counts is None else counts
    counts = counts.withColumn("n", F.when(C("value").isNotNull(), C("n")).otherwise(0))
    quantiles = exact_quantiles(counts, "value", [0.01, 0.5, 0.99], by=["column"])

    def of(column: str, i: int) -> Column:
        return F.max(F.when(C("column") == column, C("q")[i]))

    return stored(
        quantiles.agg(
            of("vehicle_mileage", 1).alias("mileage_median"),
            *[
                of(c, i).alias(f"{c}_{name}")
                for c in MONEY
                for name, i in (("med", 1), ("p99", 2), ("p01", 0))
            ],
        )
    )


def high_marks(df: DataFrame, artifacts: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row: the frame's own 0.75 quantile of mileage and of the capped money columns."""
    value = C("value")
    for column in HIGH_FLAGS:
        here = C("column") == column
        if column == "vehicle_mileage":
            filled = F.coalesce("value", "mileage_median")
        else:
            filled = clip(F.coalesce("value", f"{column}_med"), C(f"{column}_p01"), C(f"{column}_p99"))
        value = F.when(here, filled).otherwise(value)
    capped = (
        beside(value_counts(df) if counts is None else counts, artifacts)
        .select("column", value.alias("value"), "n")
        .groupBy("column", "value")
        .agg(F.sum("n").alias("n"))
    )
    marks = exact_quantiles(capped.filter("value is not null"), "value", [0.75], by=["column"])
    return stored(marks.agg(*[F.max(F.when(C("column") == c, C("q")[0])).alias(f"{c}_mark") for c in HIGH_FLAGS]))


# --- row-local groups: output column -> SQL expression ------------------------


def _flags(**conditions: str) -> dict[str, str]:
    """0/1 columns; a condition over a missing value is 0."""
    return {name: f"int(coalesce({test}, false))" for name, test in conditions.items()}


def _number(column: str, default: float | None = None) -> str:
    value = f"nullif(try_cast(`{column}` AS double), double('NaN'))"
    return value if default is None else f"coalesce({value}, double({default}))"


TIME_PARTS = {
    "claim_date": "try_cast(claim_date AS timestamp_ntz)",
    "claim_year": "year(claim_date)",
    "claim_month": "month(claim_date)",
    "claim_dow": "weekday(claim_date)",
    "claim_hour": "hour(claim_date)",
    "claim_day": "dayofmonth(claim_date)",
    "claim_quarter": "quarter(claim_date)",
}
TIME_FLAGS = _flags(
    is_weekend="claim_dow >= 5",
    is_weekday="claim_dow < 5",
    is_morning="claim_hour BETWEEN 6 AND 11",
    is_afternoon="claim_hour BETWEEN 12 AND 17",
    is_evening="claim_hour BETWEEN 18 AND 21",
    is_night="claim_hour >= 22 OR claim_hour < 6",
    is_rush_hour="claim_hour BETWEEN 7 AND 9 OR claim_hour BETWEEN 16 AND 19",
    is_winter="claim_month IN (12, 1, 2)",
    is_summer="claim_month IN (6, 7, 8)",
)
# Raw numbers and texts with their defaults; later groups build on these.
RAW = {
    "year_of_born": _number("year_of_born", 1980),
    "age_of_DL": _number("age_of_DL", 25),
    "past_num_of_claims": _number("past_num_of_claims", 0),
    "safety_rating": _number("safety_rating", 50),
    "liab_prct": f"least(greatest({_number('liab_prct', 0)}, 0D), 100D)",
    "accident_type": "coalesce(string(accident_type), 'Unknown')",
    "accident_site": "coalesce(string(accident_site), 'Unknown')",
    **{c: f"coalesce(string({c}), 'Unknown')" for c in CATEGORICAL},
    "zip_code": f"string(bigint({_number('zip_code', 0)}))",
}
MONEY_COLUMNS = {
    "vehicle_mileage": f"coalesce({_number('vehicle_mileage')}, mileage_median)",
    **{f"{c}_capped": f"greatest(least(coalesce({_number(c)}, {c}_med), {c}_p99), {c}_p01)" for c in MONEY},
}
# A missing claim year keeps the age missing: greatest and least alone would hide it.
AGE = {
    "age_at_claim": "CASE WHEN claim_year IS NOT NULL "
    "THEN least(greatest(claim_year - year_of_born, 16D), 100D) END"
}
DRIVEN = {"period_of_driving": "CASE WHEN age_at_claim IS NOT NULL THEN greatest(age_at_claim - age_of_DL, 0D) END"}
DEMOGRAPHICS = _flags(
    is_young_driver="age_at_claim < 25",
    is_senior_driver="age_at_claim >= 65",
    is_mid_age_driver="age_at_claim >= 25 AND age_at_claim < 65",
    is_new_driver="period_of_driving < 3",
    is_experienced="period_of_driving >= 10",
)
HISTORY = {
    "claims_per_year": "past_num_of_claims / (period_of_driving + 1)",
    **_flags(has_past_claims="past_num_of_claims > 0", has_multiple_claims="past_num_of_claims >= 2"),
}
LIABILITY = {
    **_flags(
        liab_0_10="liab_prct <= 10",
        liab_10_20="liab_prct > 10 AND liab_prct <= 20",
        liab_20_30="liab_prct > 20 AND liab_prct <= 30",
        liab_30_40="liab_prct > 30 AND liab_prct <= 40",
        liab_40_plus="liab_prct > 40",
        liab_zero="liab_prct = 0",
        liab_full="liab_prct = 100",
        liab_half="liab_prct = 50",
        **{f"liab_{i}_{i + 5}": f"liab_prct > {i} AND liab_prct <= {i + 5}" for i in range(0, 100, 5)},
        **{f"liab_exactly_{v}": f"liab_prct = {v}" for v in EXACT_LIABILITY},
    ),
    "liab_squared": "liab_prct * liab_prct",
    "liab_cubed": "liab_prct * liab_prct * liab_prct",
    "liab_sqrt": "sqrt(liab_prct)",
    "liab_inverse": "100 - liab_prct",
    "liab_inverse_sq": "(100 - liab_prct) * (100 - liab_prct)",
    "liab_log": "log1p(liab_prct)",
}
EVIDENCE = {
    **_flags(
        has_witness="upper(witness_present_ind) IN ('Y', 'YES', '1', 'TRUE')",
        in_network="lower(in_network_bodyshop) IN ('yes', 'y', '1')",
    ),
    "has_police": f"int({_number('policy_report_filed_ind', 0)})",
}
EVIDENCE_COUNT = {"evidence_count": "has_witness + has_police"}
EVIDENCE_FLAGS = _flags(has_full_evidence="evidence_count = 2", has_no_evidence="evidence_count = 0")
PROFILE = {
    "high_education": f"int({_number('high_education_ind', 0)})",
    "address_change": f"int({_number('address_change_ind', 0)})",
    **_flags(safety_high="safety_rating >= 70", safety_low="safety_rating <= 30"),
}
# is_multi_clear also matches the unclear type.
ACCIDENT = _flags(
    is_single_car="accident_type RLIKE '(?i)single'",
    is_multi_unclear="accident_type RLIKE '(?i)multi.*unclear'",
    is_multi_clear="accident_type RLIKE '(?i)multi.*clear'",
    is_highway="accident_site RLIKE '(?i)highway'",
    is_intersection="accident_site RLIKE '(?i)intersection'",
    is_parking="accident_site RLIKE '(?i)parking'",
)
CATEGORIES = {
    "accident_combo": "concat_ws('_', accident_site, accident_type)",
    # lpad alone would cut a longer code.
    "zip_code": "CASE WHEN length(zip_code) < 5 THEN lpad(zip_code, 5, '0') ELSE zip_code END",
}
ZIP3 = {"zip3": "CASE WHEN left(zip_code, 3) = '000' THEN 'unknown' ELSE left(zip_code, 3) END"}
RATIOS = {
    "mileage_per_year": "vehicle_mileage / (period_of_driving + 1)",
    "mileage_log": "log1p(vehicle_mileage)",
    **{f"{c}_log": f"log1p({c}_capped)" for c in MONEY},
    "payout_to_income": "claim_est_payout_capped / (annual_income_capped + 1)",
    "payout_to_price": "claim_est_payout_capped / (vehicle_price_capped + 1)",
    "income_to_price": "annual_income_capped / (vehicle_price_capped + 1)",
    **_flags(
        **{
            name: f"{c if c == 'vehicle_mileage' else f'{c}_capped'} > {c}_mark"
            for c, name in HIGH_FLAGS.items()
        }
    ),
}
# liab_x_<name> = liability times this column.
TIMES_LIABILITY = {
    "witness": "has_witness",
    "police": "has_police",
    "evidence_count": "evidence_count",
    "highway": "is_highway",
    "intersection": "is_intersection",
    "weekend": "is_weekend",
    "rush_hour": "is_rush_hour",
    "night": "is_night",
    "young_driver": "is_young_driver",
    "new_driver": "is_new_driver",
    "past_claims": "has_past_claims",
    "payout_ratio": "payout_to_income",
}
INTERACTIONS = {
    **{f"liab_x_{name}": f"liab_prct * {c}" for name, c in TIMES_LIABILITY.items()},
    "liab_inverse_x_evidence": "liab_inverse * evidence_count",
    "liab_inverse_x_experienced": "liab_inverse * is_experienced",
    "liab_inverse_x_no_claims": "liab_inverse * (1 - has_past_claims)",
    "liab_inverse_x_high_income": "liab_inverse * is_high_income",
    "liab_20_30_x_multi_unclear": "liab_20_30 * is_multi_unclear",
    "liab_20_30_x_single": "liab_20_30 * is_single_car",
    "liab_20_30_x_multi_x_evidence": "liab_20_30 * is_multi_unclear * int(evidence_count > 0)",
    "low_liab_x_multi": "int(liab_prct < 30) * (1 - is_single_car)",
    "high_liab_x_single": "int(liab_prct > 50) * is_single_car",
    "low_liab_x_single_x_no_evidence": "int(liab_prct < 25) * is_single_car * has_no_evidence",
    "high_liab_x_weekend_x_night": "int(liab_prct > 60) * is_weekend * is_night",
    "golden_combo": "liab_20_30 * is_multi_unclear * int(evidence_count > 0) * is_highway",
}
# Each step is one projection and may use the columns of the steps before it.
STEPS = (
    {"claim_date": TIME_PARTS["claim_date"]} | RAW | MONEY_COLUMNS | EVIDENCE,
    {n: e for n, e in TIME_PARTS.items() if n != "claim_date"} | EVIDENCE_COUNT | CATEGORIES,
    AGE | TIME_FLAGS | EVIDENCE_FLAGS | LIABILITY | PROFILE | ACCIDENT | ZIP3,
    DRIVEN,
    DEMOGRAPHICS | HISTORY | RATIOS,
    INTERACTIONS,
)
ENGINEERED = tuple(dict.fromkeys(name for step in STEPS for name in step))


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add or replace columns in one projection. Several of these make methods too large for HotSpot."""
    compiled_methods(df.sparkSession)
    kept = [f"`{c}`" for c in df.columns if c not in columns]
    return df.selectExpr(*kept, *[f"{sql} AS `{name}`" for name, sql in columns.items()])


def transform(df: DataFrame, artifacts: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """All engineered columns. ``marks`` fixes the high-flag marks (for example those of
    the training frame); by default they come from ``df``."""
    marks = high_marks(df, artifacts) if marks is None else marks
    wide = beside(beside(df, artifacts), marks)
    for step in STEPS:
        wide = _project(wide, step)
    return wide.drop(*artifacts.columns, *marks.columns)


def engineered(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """All engineered columns of a frame, from statistics of its own or of ``fit_on``, and marks of its own. The frames
    should be stored, as they are read for the value counts and for the columns."""
    counts = value_counts(df)
    artifacts = fit(df, counts) if fit_on is None else fit(fit_on)
    return transform(df, artifacts, high_marks(df, artifacts, counts))


# Stand-ins for statistics that no wanted column needs.
_NO_MARKS = {f"{c}_mark": "cast(null as double)" for c in HIGH_FLAGS}
_NO_STATISTICS = {"mileage_median": "cast(null as double)"} | {f"{c}_{n}": "cast(null as double)" for c in MONEY for n in ("med", "p99", "p01")}


def row_local(df: DataFrame) -> DataFrame:
    """The engineered columns that need no statistics (others are missing): nothing is fitted, and every row stands alone."""
    wide = _project(df, _NO_STATISTICS | _NO_MARKS)
    for step in STEPS:
        wide = _project(wide, step)
    return wide.drop(*_NO_STATISTICS, *_NO_MARKS)


def select_features(df: DataFrame, names: Sequence[str] = SELECTED, *keep: str) -> DataFrame:
    """The wanted features that the frame has, after the ``keep`` columns."""
    return df.select(*keep, *pick(df, names))
