"""Oracle of the feature frame, written out as DuckDB steps."""

from oracles.star import over

HOLD = "year(claim_date) = 2000 and month(claim_date) = 9"
EXACT = (15, 18, 20, 22, 25, 27, 30, 32, 35, 37, 40, 45, 50)


def _q(c: str, p: float) -> str:
    return f"quantile_cont(try_cast({c} as double), {p})"


_MONEY = ("annual_income", "vehicle_price", "vehicle_weight", "claim_est_payout")
ART = "select " + ", ".join(
    [f"{_q('vehicle_mileage', 0.5)} as mileage_median"]
    + [f"{_q(c, p)} as {c}_{n}" for c in _MONEY for n, p in (("med", 0.5), ("p99", 0.99), ("p01", 0.01))]
)


def _capped(c: str) -> str:
    return f"least(greatest(coalesce(try_cast(s.{c} as double), {c}_med), {c}_p01), {c}_p99) as {c}_capped"


BASE = f"""
select s.claim_number, s.claim_date, year(s.claim_date) as claim_year, month(s.claim_date) as claim_month,
  isodow(s.claim_date) - 1 as claim_dow, hour(s.claim_date) as claim_hour, day(s.claim_date) as claim_day,
  coalesce(try_cast(year_of_born as double), 1980) as year_of_born,
  coalesce(try_cast(age_of_DL as double), 25) as "age_of_DL",
  coalesce(try_cast(past_num_of_claims as double), 0) as past_num_of_claims,
  coalesce(try_cast(s.vehicle_mileage as double), mileage_median) as vehicle_mileage,
  {', '.join(_capped(c) for c in _MONEY)},
  least(greatest(coalesce(try_cast(liab_prct as double), 0), 0), 100) as liab_prct,
  case when upper(coalesce(witness_present_ind, 'N')) in ('Y', 'YES', '1', 'TRUE') then 1 else 0 end as has_witness,
  cast(trunc(coalesce(try_cast(policy_report_filed_ind as double), 0)) as integer) as has_police,
  case when lower(coalesce(in_network_bodyshop, 'no')) in ('yes', 'y', '1') then 1 else 0 end as in_network,
  cast(trunc(coalesce(try_cast(high_education_ind as double), 0)) as integer) as high_education,
  cast(trunc(coalesce(try_cast(address_change_ind as double), 0)) as integer) as address_change,
  coalesce(try_cast(safety_rating as double), 50) as safety_rating,
  coalesce(accident_type, 'Unknown') as accident_type, coalesce(accident_site, 'Unknown') as accident_site,
  coalesce(gender, 'Unknown') as gender, coalesce(vehicle_category, 'Unknown') as vehicle_category,
  coalesce(channel, 'Unknown') as channel,
  case when length(zip_digits) < 5 then lpad(zip_digits, 5, '0') else zip_digits end as zip_code
from (select *, cast(cast(coalesce(try_cast(zip_code as double), 0) as bigint) as varchar) as zip_digits from s) s, art"""

AGED = """
select *, case when claim_year is not null
    then least(greatest(claim_year - year_of_born, 16), 100) end as age_at_claim
from base"""

MARKS = "select " + ", ".join(
    f"quantile_cont({c}, 0.75) as m_{n}"
    for c, n in (
        ("vehicle_mileage", "mileage"),
        ("annual_income_capped", "income"),
        ("vehicle_price_capped", "price"),
        ("claim_est_payout_capped", "payout"),
    )
) + " from aged"


def _int(test: str, name: str) -> str:
    return f"case when {test} then 1 else 0 end as {name}"


_TIME = [
    _int("claim_dow >= 5", "is_weekend"),
    _int("claim_dow < 5", "is_weekday"),
    _int("claim_hour >= 6 and claim_hour < 12", "is_morning"),
    _int("claim_hour >= 12 and claim_hour < 18", "is_afternoon"),
    _int("claim_hour >= 18 and claim_hour < 22", "is_evening"),
    _int("claim_hour >= 22 or claim_hour < 6", "is_night"),
    _int("(claim_hour >= 7 and claim_hour <= 9) or (claim_hour >= 16 and claim_hour <= 19)", "is_rush_hour"),
    "(claim_month - 1) // 3 + 1 as claim_quarter",
    _int("claim_month in (12, 1, 2)", "is_winter"),
    _int("claim_month in (6, 7, 8)", "is_summer"),
]
_DEMO = [
    _int("age_at_claim < 25", "is_young_driver"),
    _int("age_at_claim >= 65", "is_senior_driver"),
    _int("age_at_claim >= 25 and age_at_claim < 65", "is_mid_age_driver"),
    _int("driven < 3", "is_new_driver"),
    _int("driven >= 10", "is_experienced"),
    "driven as period_of_driving",
]
_PAST = [
    "past_num_of_claims / (driven + 1) as claims_per_year",
    _int("past_num_of_claims > 0", "has_past_claims"),
    _int("past_num_of_claims >= 2", "has_multiple_claims"),
]
_CAR = [
    "vehicle_mileage / (driven + 1) as mileage_per_year",
    "ln(1 + vehicle_mileage) as mileage_log",
    _int("vehicle_mileage > m_mileage", "is_high_mileage"),
]
_CASH = [f"ln(1 + {c}_capped) as {c}_log" for c in _MONEY] + [
    "claim_est_payout_capped / (annual_income_capped + 1) as payout_to_income",
    "claim_est_payout_capped / (vehicle_price_capped + 1) as payout_to_price",
    "annual_income_capped / (vehicle_price_capped + 1) as income_to_price",
    _int("annual_income_capped > m_income", "is_high_income"),
    _int("vehicle_price_capped > m_price", "is_expensive_car"),
    _int("claim_est_payout_capped > m_payout", "is_large_payout"),
]
_LIAB = (
    [
        _int("liab_prct <= 10", "liab_0_10"),
        _int("liab_prct > 10 and liab_prct <= 20", "liab_10_20"),
        _int("liab_prct > 20 and liab_prct <= 30", "liab_20_30"),
        _int("liab_prct > 30 and liab_prct <= 40", "liab_30_40"),
        _int("liab_prct > 40", "liab_40_plus"),
    ]
    + [_int(f"liab_prct > {i} and liab_prct <= {i + 5}", f"liab_{i}_{i + 5}") for i in range(0, 100, 5)]
    + [_int(f"liab_prct = {v}", f"liab_exactly_{v}") for v in EXACT]
    + [
        "liab_prct ** 2 as liab_squared",
        "liab_prct ** 3 as liab_cubed",
        "sqrt(liab_prct) as liab_sqrt",
        "100 - liab_prct as liab_inverse",
        "(100 - liab_prct) ** 2 as liab_inverse_sq",
        "ln(1 + liab_prct) as liab_log",
        _int("liab_prct = 0", "liab_zero"),
        _int("liab_prct = 100", "liab_full"),
        _int("liab_prct = 50", "liab_half"),
    ]
)
_EVID = [
    "has_witness + has_police as evidence_count",
    _int("has_witness + has_police = 2", "has_full_evidence"),
    _int("has_witness + has_police = 0", "has_no_evidence"),
]
_PROFILE = [_int("safety_rating >= 70", "safety_high"), _int("safety_rating <= 30", "safety_low")]
_ACC = [
    _int(f"regexp_matches({c}, '{p}', 'i')", n)
    for n, c, p in (
        ("is_single_car", "accident_type", "single"),
        ("is_multi_unclear", "accident_type", "multi.*unclear"),
        ("is_multi_clear", "accident_type", "multi.*clear"),
        ("is_highway", "accident_site", "highway"),
        ("is_intersection", "accident_site", "intersection"),
        ("is_parking", "accident_site", "parking"),
    )
]
_CAT = [
    "accident_site || '_' || accident_type as accident_combo",
    "case when left(zip_code, 3) = '000' then 'unknown' else left(zip_code, 3) end as zip3",
]
FLAGS = (
    "select *, "
    + ", ".join(_TIME + _DEMO + _PAST + _CAR + _CASH + _LIAB + _EVID + _PROFILE + _ACC + _CAT)
    + """ from (select *, case when age_at_claim is not null then greatest(age_at_claim - age_of_DL, 0) end as driven
              from aged), marks"""
)
_X = {
    "liab_x_witness": "liab_prct * has_witness",
    "liab_x_police": "liab_prct * has_police",
    "liab_x_evidence_count": "liab_prct * evidence_count",
    "liab_inverse_x_evidence": "liab_inverse * evidence_count",
    "liab_20_30_x_multi_unclear": "liab_20_30 * is_multi_unclear",
    "liab_20_30_x_single": "liab_20_30 * is_single_car",
    "low_liab_x_multi": "case when liab_prct < 30 then 1 - is_single_car else 0 end",
    "high_liab_x_single": "case when liab_prct > 50 then is_single_car else 0 end",
    "liab_x_highway": "liab_prct * is_highway",
    "liab_x_intersection": "liab_prct * is_intersection",
    "liab_x_weekend": "liab_prct * is_weekend",
    "liab_x_rush_hour": "liab_prct * is_rush_hour",
    "liab_x_night": "liab_prct * is_night",
    "liab_x_young_driver": "liab_prct * is_young_driver",
    "liab_x_new_driver": "liab_prct * is_new_driver",
    "liab_inverse_x_experienced": "liab_inverse * is_experienced",
    "liab_x_past_claims": "liab_prct * has_past_claims",
    "liab_inverse_x_no_claims": "liab_inverse * (1 - has_past_claims)",
    "liab_x_payout_ratio": "liab_prct * payout_to_income",
    "liab_inverse_x_high_income": "liab_inverse * is_high_income",
    "liab_20_30_x_multi_x_evidence": "case when evidence_count > 0 then liab_20_30 * is_multi_unclear else 0 end",
    "low_liab_x_single_x_no_evidence": "case when liab_prct < 25 then is_single_car * has_no_evidence else 0 end",
    "high_liab_x_weekend_x_night": "case when liab_prct > 60 then is_weekend * is_night else 0 end",
    "golden_combo": "case when evidence_count > 0 then liab_20_30 * is_multi_unclear * is_highway else 0 end",
}
FULL = "select *, " + ", ".join(f"{sql} as {name}" for name, sql in _X.items()) + " from flags"


def steps(frame: str = "select * from wide", trained_on: str = "select * from wide") -> dict[str, str]:
    """CTEs from a wide frame to the feature frame ``f``."""
    return {
        "s": frame,
        "trained": trained_on,
        "art": f"{ART} from trained",
        "base": BASE,
        "aged": AGED,
        "marks": MARKS,
        "flags": FLAGS,
        "f": FULL,
    }


# Output columns of each group; doubles that are not exact are compared to nine places.
GROUPS = {
    "fe01": "claim_year claim_month claim_dow claim_hour claim_day is_weekend is_weekday is_morning "
    "is_afternoon is_evening is_night is_rush_hour claim_quarter is_winter is_summer",
    "fe02": "year_of_born age_of_DL age_at_claim period_of_driving is_young_driver is_senior_driver "
    "is_mid_age_driver is_new_driver is_experienced",
    "fe03": "past_num_of_claims claims_per_year has_past_claims has_multiple_claims",
    "fe05": "vehicle_mileage mileage_per_year mileage_log is_high_mileage",
    "fe06": " ".join(f"{c}_capped {c}_log" for c in _MONEY)
    + " payout_to_income payout_to_price income_to_price is_high_income is_expensive_car is_large_payout",
    "fe07": "liab_prct liab_0_10 liab_10_20 liab_20_30 liab_30_40 liab_40_plus "
    + " ".join(f"liab_{i}_{i + 5}" for i in range(0, 100, 5))
    + " "
    + " ".join(f"liab_exactly_{v}" for v in EXACT)
    + " liab_squared liab_cubed liab_sqrt liab_inverse liab_inverse_sq liab_log liab_zero liab_full liab_half",
    "fe08": "has_witness has_police evidence_count has_full_evidence has_no_evidence in_network",
    "fe09": "high_education address_change safety_rating safety_high safety_low",
    "fe10": "accident_type accident_site is_single_car is_multi_unclear is_multi_clear is_highway "
    "is_intersection is_parking",
    "fe11": " ".join(_X),
    "fe12": "gender vehicle_category channel accident_combo zip_code zip3",
}
INEXACT = set(
    "claims_per_year vehicle_mileage mileage_per_year mileage_log payout_to_income payout_to_price "
    "income_to_price liab_sqrt liab_log liab_x_payout_ratio".split()
    + [f"{c}_{k}" for c in _MONEY for k in ("capped", "log")]
)


def columns(names: str) -> str:
    return ", ".join(f"round({n}, 9) as {n}" if n in INEXACT else f'"{n}"' for n in names.split())


def features(names: str, **kw) -> str:
    return over("wide", f"select claim_number, {columns(names)} from f", **steps(**kw))


_HELD = {
    "frame": f"select * from wide where {HOLD}",
    "trained_on": f"select * from wide where not ({HOLD}) and subrogation is not null",
}
ORACLES = {name: features(names) for name, names in GROUPS.items()}
ORACLES |= {f"{name}_apply": features(GROUPS[name], **_HELD) for name in ("fe05", "fe06", "fe11")}
ORACLES["fe04"] = over(
    "wide",
    "select "
    + ", ".join(
        f"round({n}, 9) as {n}"
        for n in ["mileage_median"] + [f"{c}_{k}" for c in _MONEY for k in ("med", "p99", "p01")]
    )
    + " from art",
    art=f"{ART} from wide",
)

# Rules of the feature frame, each counted on the independent frame.
_RULES = {
    **{
        f"present_{c}": f"{c} is not null"
        for c in ("age_at_claim", "period_of_driving", "liab_prct", "is_weekend", "is_single_car")
    },
    **{
        f"binary_{c}": f"{c} in (0, 1)"
        for c in ("is_weekend", "is_weekday", "is_young_driver", "is_single_car", "has_witness", "has_police")
    },
    "age_16_to_100": "age_at_claim between 16 and 100",
    "liability_0_to_100": "liab_prct between 0 and 100",
    "no_infinity": "not isinf(payout_to_income) and not isinf(mileage_log) and not isinf(claims_per_year)",
    "column_names": "true",
    "selected_coverage": "true",
}
ORACLES["nrm20"] = over(
    "wide",
    "\nunion all\n".join(
        f"select '{rule}' as rule, count(*) filter (where not coalesce({test}, false)) as violations from f"
        for rule, test in _RULES.items()
    ),
    **steps(),
)

SELECTED = (
    "is_single_car liab_x_witness liab_inverse liab_x_highway has_witness high_education address_change "
    "is_parking liab_40_plus is_multi_clear liab_prct liab_20_30 liab_squared liab_cubed liab_sqrt "
    "liab_inverse_sq liab_log liab_zero liab_full liab_half liab_0_10 liab_10_20 liab_30_40 "
    + " ".join(n for n in _X if n not in ("liab_x_witness", "liab_x_highway"))
    + " has_police evidence_count has_full_evidence has_no_evidence in_network safety_rating safety_high "
    "safety_low is_multi_unclear is_highway is_intersection age_at_claim period_of_driving is_young_driver "
    "is_senior_driver is_mid_age_driver is_new_driver is_experienced past_num_of_claims claims_per_year "
    "has_past_claims has_multiple_claims vehicle_mileage mileage_per_year mileage_log is_high_mileage "
    + GROUPS["fe06"]
    + " is_weekend is_weekday is_morning is_afternoon is_evening is_night is_rush_hour is_winter is_summer"
)
SHORT = (
    "liab_prct liab_inverse liab_x_witness has_witness has_police evidence_count is_single_car "
    "is_multi_unclear is_highway is_parking liab_20_30 liab_squared age_at_claim period_of_driving "
    "is_young_driver past_num_of_claims vehicle_mileage annual_income_capped vehicle_price_capped "
    "claim_est_payout_capped payout_to_income safety_rating high_education address_change "
    "gender vehicle_category channel"
)
ORACLES |= {"fe13": features(SELECTED), "fe13_short": features(SHORT)}
