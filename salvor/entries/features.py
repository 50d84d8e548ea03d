"""Feature groups over the wide claims; ``_apply`` uses statistics of earlier months."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F
from pyspark.sql import types as T

from salvor.operators import features as E
from salvor.operators.prep import hold_out_split
from salvor.operators.sizes import stored
from salvor.sources.star import HOLD_OUT

# Group -> its output columns.
GROUPS = {
    "fe01": "claim_year claim_month claim_dow claim_hour claim_day is_weekend is_weekday is_morning "
    "is_afternoon is_evening is_night is_rush_hour claim_quarter is_winter is_summer",
    "fe02": "year_of_born age_of_DL age_at_claim period_of_driving is_young_driver is_senior_driver "
    "is_mid_age_driver is_new_driver is_experienced",
    "fe03": "past_num_of_claims claims_per_year has_past_claims has_multiple_claims",
    "fe05": "vehicle_mileage mileage_per_year mileage_log is_high_mileage",
    "fe06": " ".join(f"{c}_capped {c}_log" for c in E.MONEY)
    + " payout_to_income payout_to_price income_to_price is_high_income is_expensive_car is_large_payout",
    "fe08": "has_witness has_police evidence_count has_full_evidence has_no_evidence in_network",
    "fe09": "high_education address_change safety_rating safety_high safety_low",
    "fe10": "accident_type accident_site is_single_car is_multi_unclear is_multi_clear is_highway "
    "is_intersection is_parking",
    "fe12": "gender vehicle_category channel accident_combo zip_code zip3",
}


def compared(df, *keep):
    """Doubles to nine places; keys, flags and text as they are."""
    return df.select(
        *keep,
        *[
            F.round(f.name, 9).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
            if f.name not in keep
        ],
    )


def _names(group):
    if group == "fe07":
        return ["liab_prct", *E.LIABILITY]
    if group == "fe11":
        return list(E.INTERACTIONS)
    return GROUPS[group].split()


# Groups whose columns each follow from the row alone.
ROW_LOCAL = ("fe01", "fe02", "fe03", "fe07", "fe08", "fe09", "fe10", "fe12")


def engineered(s):
    """The wide claims are derived once and stored, then read for the statistics and for the columns."""
    return E.engineered(stored(s.wide))


def group_of(s, group):
    f = E.row_local(s.wide) if group in ROW_LOCAL else engineered(s)
    return compared(f.select("claim_number", *_names(group)), "claim_number")


def group_applied(s, group):
    train, test = hold_out_split(stored(s.wide), *HOLD_OUT)
    return compared(E.engineered(test, fit_on=train).select("claim_number", *_names(group)), "claim_number")


def selected(s):
    f = engineered(s)
    return compared(E.select_features(f, E.SELECTED, "claim_number"), "claim_number")


def short_list(s):
    f = engineered(s)
    return compared(E.select_features(f, [*E.SHORT_LIST, *E.CATEGORICAL], "claim_number"), "claim_number")


QUERIES = {name: partial(group_of, group=name) for name in [*GROUPS, "fe07", "fe11"]}
QUERIES |= {f"{name}_apply": partial(group_applied, group=name) for name in ("fe05", "fe06", "fe11")}
QUERIES |= {"fe04": lambda s: compared(E.fit(s.wide)), "fe13": selected, "fe13_short": short_list}
