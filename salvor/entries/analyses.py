"""Named analyses."""

from __future__ import annotations

from functools import partial

from salvor.plans import accidents, claims, drivers, policyholders, vehicles
from pyspark.sql import functions as F


def rounded(df, **digits):
    """Round the named columns, for comparison across engines."""
    return df.withColumns({c: F.round(c, d) for c, d in digits.items() if c in df.columns})


QUERIES = {
    "acl01": lambda s: claims.total(s.claim),
    "acl02": lambda s: claims.preview(s.claim, "claim_number"),
    "acl03": lambda s: claims.completeness(s.claim),
    "acl04": lambda s: claims.by_value(s.claim, "witness_present_ind"),
    "acl05": lambda s: claims.by_value(s.claim, "policy_report_filed_ind"),
    "acl06": lambda s: claims.by_value(s.claim, "in_network_bodyshop"),
    "acl07": lambda s: claims.witness_by_police(s.claim),
    "acl08": lambda s: claims.with_both(s.claim),
    "acl08_literal": lambda s: claims.with_both(s.claim, "Yes"),
    "acl09": lambda s: claims.repeated_accidents(s.claim),
    "acl10": lambda s: claims.distinct_keys(s.claim),
    "acc01": lambda s: accidents.totals(s.accident),
    "acc02": lambda s: claims.preview(s.accident, "accident_key"),
    "acc03": lambda s: accidents.by_value(s.accident, "accident_type"),
    "acc04": lambda s: accidents.by_value(s.accident, "accident_site"),
    "acc05": lambda s: accidents.multi_vehicle(s.accident),
    "acc06": lambda s: accidents.site_by_type(s.accident),
    "acc07": lambda s: accidents.joined_sample(s.accident, s.claim),
    "veh01": lambda s: vehicles.by_category_color(s.claim, s.vehicle),
    "veh02": lambda s: vehicles.by_price_band(s.claim, s.vehicle),
    "veh03": lambda s: vehicles.by_mileage_band(s.claim, s.vehicle),
    "veh04": lambda s: vehicles.by_category_evidence(s.claim, s.vehicle),
    "veh05": lambda s: vehicles.by_category_channel(s.claim, s.vehicle),
    "veh06": lambda s: rounded(
        vehicles.claim_means(s.claim), avg_subrogation=6, avg_payout=4, avg_liability_pct=6
    ),
    "veh07": lambda s: rounded(
        vehicles.vehicle_means(s.vehicle), avg_vehicle_price=6, avg_mileage=6, avg_weight=6
    ),
    "veh08": lambda s: vehicles.categorical_check(s.claim, s.vehicle),
    "veh09": lambda s: rounded(
        vehicles.named_correlations(s.claim, s.vehicle),
        corr_subro_price=9,
        corr_subro_mileage=9,
        corr_payout_price=9,
        corr_subro_liability=9,
    ),
    "drv01": lambda s: drivers.by_gender(s.driver),
    "drv02": lambda s: drivers.by_licence_age(s.driver),
    "drv03": lambda s: drivers.safety_quartiles(s.driver),
    "drv04": lambda s: rounded(drivers.label_correlations(s.driver, s.claim), corr_with_subrogation=9),
}

for _suffix, _literal in (("", None), ("_literal", "Yes")):
    QUERIES |= {
        f"acc08{_suffix}": partial(lambda s, t: accidents.high_potential(s.accident, s.claim, t), t=_literal),
        f"acc09{_suffix}": partial(
            lambda s, t: accidents.indicators_by(s.accident, s.claim, "accident_type", t), t=_literal
        ),
        f"acc10{_suffix}": partial(
            lambda s, t: accidents.indicators_by(s.accident, s.claim, "accident_site", t), t=_literal
        ),
        f"acc11{_suffix}": partial(lambda s, t: accidents.priority_view(s.accident, s.claim, t), t=_literal),
    }

_FOUR = {
    "pol01": ("avg_payout",),
    "pol02": ("avg_payout",),
    "pol03": ("avg_past_claims",),
    "pol07": ("avg_payout",),
    "pol08": ("avg_payout",),
    "ins01": ("high_avg", "low_avg", "payout_gap"),
    "ins02": ("frequent_avg", "highest_avg"),
    "ins03": ("high_past", "low_past"),
    "ins07": ("avg_payout",),
    "ins08": ("avg_payout",),
}


ANALYSES = sorted([*policyholders.SQL, *policyholders.PLANS])


def _holder(s, name):
    run = policyholders.run if name in ANALYSES else policyholders.insight
    digits = dict.fromkeys(_FOUR.get(name, ()), 4) | ({"gap_pct": 6} if name == "ins01" else {})
    return rounded(run(s.spark, name, s.claim, s.policyholder), **digits)


QUERIES |= {n: partial(_holder, name=n) for n in (*ANALYSES, *policyholders.INSIGHTS)}
