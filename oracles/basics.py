"""Oracles of sources, sinks, normalisation, quality and single operations."""

from oracles.analyses import ORACLES as ANALYSES
from oracles.analyses import YES
from oracles.star import STAR, over

ORACLES: dict[str, str] = {}

# --- sources and sinks ---
ORACLES |= {f"src01_{t}": over(t, f"select * from {t}") for t in ("accident", "claim", "driver", "policyholder", "vehicle")}
ORACLES |= {
    "src02": over(
        "claim",
        "select "
        + ", ".join(
            f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S'), '') as {c}"
            if c == "claim_date"
            else f"coalesce(cast({c} as varchar), '') as {c}"
            for c in (
                "claim_number subrogation claim_est_payout liab_prct claim_date claim_day_of_week channel "
                "zip_code witness_present_ind policy_report_filed_ind in_network_bodyshop accident_key "
                "policyholder_key vehicle_key driver_key"
            ).split()
        )
        + " from claim",
    ),
    "src03": over(
        "vehicle",
        """select * replace (
          case when vehicle_key % 10 in (0, 1) then null else vehicle_price end as vehicle_price,
          case when vehicle_key % 15 = 0 then null else vehicle_made_year end as vehicle_made_year)
        from vehicle""",
    ),
    "src04": over(
        "driver",
        "select * replace (case when driver_key % 9 = 0 then null else driver_key end as driver_key) from driver",
    ),
    "src05": over(
        "accident claim driver policyholder vehicle",
        "\nunion all\n".join(
            f"select '{t}' as table_name, count(*) as row_count, {n} as column_count from {t}"
            for t, n in (("accident", 3), ("claim", 15), ("driver", 5), ("policyholder", 7), ("vehicle", 7))
        ),
    ),
    "src06": over("vehicle", "select * from vehicle order by vehicle_key limit 10"),
    "src07": over(
        "claim policyholder",
        """select living_status, count(*) as num_claims
        from claim join policyholder using (policyholder_key) group by 1""",
    ),
    "snk01": over(
        "accident claim driver policyholder vehicle",
        "\nunion all\n".join(
            f"select '{t}' as table_name, 'loaded' as status, count(*) as row_count from {t}"
            for t in ("accident", "claim", "driver", "policyholder", "vehicle")
        )
        + "\nunion all select 'archive', 'missing', null",
    ),
    "snk02": ANALYSES["acc11"],
    "snk03": over("claim", "select * from claim where year(claim_date) = 2000 and month(claim_date) = 9"),
    "snk03_all": over("claim", "select *, strftime(claim_date, '%Y-%m') as claim_month from claim"),
}

# --- normalisation ---
# The wide file image as text, after trimming.
_TEXT = """select claim_number as row_id, cast(claim_number as varchar) as claim_number,
    cast(subrogation as varchar) as subrogation, cast(claim_est_payout as varchar) as claim_est_payout,
    cast(liab_prct as varchar) as liab_prct, strftime(claim_date, '%Y-%m-%d %H:%M:%S') as claim_date,
    claim_day_of_week, channel, zip_code, coalesce(witness_present_ind, '') as witness_present_ind,
    cast(policy_report_filed_ind as varchar) as policy_report_filed_ind, in_network_bodyshop,
    accident_site, accident_type, cast(annual_income as varchar) as annual_income,
    cast(high_education_ind as varchar) as high_education_ind,
    cast(email_or_tel_available as varchar) as email_or_tel_available,
    cast(address_change_ind as varchar) as address_change_ind, living_status,
    cast(past_num_of_claims as varchar) as past_num_of_claims,
    cast(vehicle_made_year as varchar) as vehicle_made_year, vehicle_category,
    coalesce(cast(vehicle_price as varchar), '') as vehicle_price, vehicle_color,
    cast(vehicle_weight as varchar) as vehicle_weight,
    coalesce(cast(vehicle_mileage as varchar), '') as vehicle_mileage,
    cast(year_of_born as varchar) as year_of_born, gender, cast(age_of_DL as varchar) as "age_of_DL",
    cast(safety_rating as varchar) as safety_rating
  from wide"""
_NATURAL = {
    "accident": "accident_site, accident_type",
    "policyholder": "annual_income, high_education_ind, email_or_tel_available, address_change_ind, "
    "living_status, past_num_of_claims",
    "vehicle": "vehicle_made_year, vehicle_category, vehicle_price, vehicle_color, vehicle_weight, vehicle_mileage",
    "driver": 'year_of_born, gender, "age_of_DL", safety_rating',
}
_FACT = (
    "claim_number, subrogation, claim_est_payout, liab_prct, claim_date, claim_day_of_week, channel, "
    "zip_code, witness_present_ind, policy_report_filed_ind, in_network_bodyshop"
)


def _dim(name: str) -> str:
    return f"""select {_NATURAL[name]}, row_number() over (order by min(row_id)) as {name}_key
      from t group by {_NATURAL[name]}"""


_DIMS = {"t": _TEXT} | {f"d_{n}": _dim(n) for n in _NATURAL}
_KEYED = " ".join(f"left join d_{n} using ({_NATURAL[n]})" for n in _NATURAL)
_KEYS = "accident_key, policyholder_key, vehicle_key, driver_key"

_PROFILE = {
    "bigint": "claim_number accident_key policyholder_key vehicle_key driver_key",
    "int": "subrogation policy_report_filed_ind high_education_ind email_or_tel_available "
    "address_change_ind past_num_of_claims vehicle_made_year year_of_born age_of_DL",
    "double": "claim_est_payout liab_prct annual_income vehicle_price vehicle_weight vehicle_mileage safety_rating",
    "timestamp_ntz": "claim_date",
    "string": "claim_day_of_week channel zip_code witness_present_ind in_network_bodyshop accident_site "
    "accident_type living_status vehicle_category vehicle_color gender",
}
_LINES = STAR["claim"].replace("where rn = 1", "")

ORACLES |= {f"nrm03_{n}": over("wide", f"select * from d_{n}", t=_TEXT, **{f"d_{n}": _dim(n)}) for n in _NATURAL}
ORACLES |= {
    "nrm01": over(
        "wide",
        "select claim_number, channel, accident_site, vehicle_color, witness_present_ind from t",
        t=_TEXT,
    ),
    "nrm02": over(
        "wide",
        f"""select {_FACT} from (select * replace (' ' || channel || chr(9) || ' ' as channel) from t)""",
        t=_TEXT,
    ),
    "nrm04": over("claim", "select claim_number, claim_est_payout, subrogation, vehicle_key, driver_key from claim"),
    "nrm05": over("wide", f"select claim_number, {_KEYS} from t {_KEYED}", **_DIMS),
    "nrm06": over("wide", f"select {_FACT}, {_KEYS} from t {_KEYED}", **_DIMS),
    "nrm10": over("wide", "select * from wide"),
    "nrm11": over(
        "wide",
        """select 1 as columns_match, count(*) as left_rows, count(*) as right_rows,
          0 as only_left, 0 as only_right from wide where subrogation is not null""",
    ),
    "nrm12": over(
        "wide",
        "\nunion all\n".join(
            f"""select '{c}' as "column", '{kind}' as dtype, count({c}) as non_null, count(*) as rows from wide"""
            for kind, columns in _PROFILE.items()
            for c in columns.split()
        ),
    ),
}
_BROKEN = """select claim_number, case when accident_key = 12 then 0 else accident_key end as accident_key,
    policyholder_key, case when vehicle_key % 50 = 0 then 0 else vehicle_key end as vehicle_key, driver_key
  from claim"""
ORACLES |= {
    "nrm07": over("claim", _BROKEN),
    "nrm08": over("claim", f"select * from ({_BROKEN}) where accident_key = 0"),
    "nrm08_anti": over(
        "claim accident policyholder vehicle driver",
        "\nunion all\n".join(
            f"""select *, '{n}' as dimension from ({_BROKEN}) b
            where not exists (select 1 from {n} d where d.{n}_key = b.{n}_key)"""
            for n in ("accident", "policyholder", "vehicle", "driver")
        ),
    ),
    "nrm09": over("vehicle", "select vehicle_key, count(*) as n from vehicle group by 1 having count(*) > 1"),
    "nrm09_repeated": over("", "select claim_number, count(*) as n from c group by 1 having count(*) > 1", c=_LINES),
    "nrm13_claim": over(
        "claim",
        f"""select claim_number, cast(subrogation as double) as subrogation,
          case when claim_number % 10 = 3 then null else claim_est_payout end as claim_est_payout,
          liab_prct, vehicle_key,
          case when {YES} then 1 when witness_present_ind = 'N' then 0 end as witness_present,
          policy_report_filed_ind as policy_report_filed from claim""",
    ),
    "nrm13_vehicle": over(
        "vehicle",
        """select * replace (
          case when vehicle_key % 10 in (0, 1) then null else vehicle_price end as vehicle_price,
          cast(case when vehicle_key % 15 = 0 then null else vehicle_made_year end as bigint) as vehicle_made_year)
        from vehicle""",
    ),
    "nrm14": over(
        "vehicle",
        """select 'vehicle_price' as "column", 'unknown' as value, count(*) as n from vehicle
          where vehicle_key % 10 = 0 having count(*) > 0
        union all select 'vehicle_made_year', 'n/a', count(*) from vehicle
          where vehicle_key % 15 = 0 having count(*) > 0""",
    ),
    "nrm15": over(
        "claim",
        """select claim_number, spelled,
          case when lower(trim(spelled)) in ('y', 'yes', 'true', '1') then 1
               when lower(trim(spelled)) in ('n', 'no', 'false', '0') then 0 end as witness
        from (select claim_number, case witness_present_ind
            when 'Y' then case claim_number % 4 when 0 then ' Yes ' when 1 then 'TRUE' when 2 then '1' else 'y' end
            when 'N' then case claim_number % 4 when 0 then 'No' when 1 then 'false' when 2 then '0' else 'maybe' end
          end as spelled from claim)""",
    ),
    "nrm16": over(
        "",
        ANALYSES["acl03"][ANALYSES["acl03"].rindex("select count(*) as total_records") :].replace("from claim", "from c"),
        c=_LINES,
    ),
    "nrm17": over(
        "",
        ANALYSES["acl10"][ANALYSES["acl10"].rindex("select count(distinct accident_key)") :].replace(
            "from claim", "from c"
        ),
        c=_LINES,
    ),
    "nrm18": over(
        "claim",
        "\nunion all\n".join(
            f"select '{rule}' as rule, count(*) filter (where not coalesce({test}, false)) as violations from claim"
            for rule, test in {
                "required_columns": "true",
                "label_is_0_or_1": "subrogation in (0, 1)",
                "liability_0_to_100": "liab_prct between 0 and 100",
                "payout_positive": "claim_est_payout > 0",
                "witness_known": "witness_present_ind in ('Y', 'N', 'Yes', 'No', 'y', 'n')",
                "date_castable": "claim_date is not null",
                "payout_numeric": "claim_est_payout is not null",
                "liability_numeric": "liab_prct is not null",
            }.items()
        ),
    ),
    "nrm19": over(
        "claim wide",
        """select (select count(*) from claim) as fact_rows, count(*) as joined_rows, 1 as has_accident,
          1 as has_policyholder, 1 as has_vehicle, 1 as has_driver from wide""",
    ),
}

# --- filters, projections ---
_HOLD = "year(claim_date) = 2000 and month(claim_date) = 9"
_PRICE_BAND = """case when vehicle_price < 15000 then '<15k' when vehicle_price < 25000 then '15k–25k'
  when vehicle_price < 40000 then '25k–40k' else '≥40k' end as price_band"""
ORACLES |= {
    "flt01": over("claim", f"select claim_number from claim where {YES} and policy_report_filed_ind = 1"),
    "flt01_literal": over(
        "claim", "select claim_number from claim where witness_present_ind = 'Y' and policy_report_filed_ind = 1"
    ),
    "flt02": over("accident", "select * from accident where accident_type like '%multi_vehicle%'"),
    "flt02_regex": over("accident", "select * from accident where regexp_matches(accident_type, 'multi.*unclear')"),
    "flt03": over("claim", "select claim_number, liab_prct from claim where liab_prct between 20 and 80"),
    "flt04": over("claim", f"select claim_number, claim_date from claim where {_HOLD}"),
    "flt04_rest": over(
        "claim",
        f"""select count(*) as kept, count(*) filter (where claim_date is null) as undated
        from (select case when claim_number % 100 <> 0 then claim_date end as claim_date from claim)
        where not coalesce({_HOLD}, false)""",
    ),
    "flt05": over(
        "wide",
        """select claim_number, witness_present_ind, vehicle_price, vehicle_mileage from wide
        where witness_present_ind is not null and vehicle_price is not null""",
    ),
    "flt06": over("claim", "select claim_number from claim where month(claim_date) in (12, 1, 2)"),
    "flt07": over(
        "claim", "select vehicle_key, count(*) as claim_count from claim group by 1 having count(*) > 25"
    ),
    "flt08": over("vehicle", f"select vehicle_key, {_PRICE_BAND} from vehicle"),
    "flt08_safety": over(
        "driver",
        """select driver_key, case when safety_rating >= 80 then 'High' when safety_rating >= 60 then 'Medium'
          else 'Low' end as safety from driver""",
    ),
    "prj01": over("claim", "select claim_number as id, channel, 'claim' as source from claim"),
    "prj02": over(
        "wide",
        """select claim_number, round(claim_est_payout / nullif(vehicle_price - 10000, 0), 6) as value_ratio
        from wide""",
    ),
    "jn01": over(
        "accident claim",
        "select claim_number, accident_key, accident_site, accident_type from accident join claim using (accident_key)",
    ),
    "jn02": over(
        "driver claim", "select claim_number, driver_key, safety_rating from driver join claim using (driver_key)"
    ),
    "jn03": over(
        "vehicle claim", "select claim_number, vehicle_key, vehicle_price from claim join vehicle using (vehicle_key)"
    ),
    "jn04": over(
        "policyholder claim",
        "select claim_number, annual_income from claim join policyholder using (policyholder_key)",
    ),
    "jn04_left": over(
        "policyholder claim",
        """select claim_number, annual_income from claim c
        left join (select * from policyholder where past_num_of_claims > 3) p
          on c.policyholder_key = p.policyholder_key""",
    ),
    "jn05": over(
        "driver",
        """select driver_key, gender, safety_rating, gender_avg from driver
        join (select gender, avg(safety_rating) as gender_avg from driver group by gender) using (gender)""",
    ),
    "jn06": over("wide", "select claim_number, accident_site, annual_income, vehicle_color, gender from wide"),
    "jn07": over(
        "claim",
        """select claim_number, round(coalesce(m, (select avg(subrogation) from claim)), 9) as encoded from claim
        left join (select channel, avg(subrogation) as m from claim where channel <> 'Broker' group by 1)
          using (channel)""",
    ),
    "agg01": over(
        "claim",
        "select channel, count(*) as n, count(witness_present_ind) as with_witness_field from claim group by 1",
    ),
    "agg02": over(
        "claim",
        """select count(distinct witness_present_ind) as present_values,
          count(distinct witness_present_ind)
            + max(case when witness_present_ind is null then 1 else 0 end) as values_with_null from claim""",
    ),
    "agg03": over(
        "claim",
        """select accident_key, round(avg(claim_est_payout), 4) as mean_payout,
          round(sum(claim_est_payout), 2) as sum_payout, max(liab_prct) as max_liability from claim group by 1""",
    ),
    "agg04": over(
        "claim",
        f"""select channel, count(*) filter (where {YES}) as witnessed,
          count(*) filter (where policy_report_filed_ind = 1) as reported from claim group by 1""",
    ),
    "agg05": over(
        "claim",
        """select channel, round(avg(case when subrogation > 0 then claim_est_payout end), 4) as avg_payout_subro
        from claim group by 1""",
    ),
    "agg06": over(
        "claim",
        """select channel, round(avg(case when subrogation > 0 then 1 else 0 end), 6) as subro_rate
        from claim group by 1""",
    ),
    "agg07": over(
        "claim", "select channel, round(quantile_cont(claim_est_payout, 0.5), 6) as median from claim group by 1"
    ),
    "agg08": over(
        "claim",
        "select "
        + ", ".join(
            f"round(quantile_cont(claim_est_payout, {p}), 6) as {n}"
            for p, n in ((0.01, "p01"), (0.5, "p50"), (0.75, "p75"), (0.99, "p99"))
        )
        + " from claim",
    ),
    "agg09": over(
        "claim",
        """select round(corr(claim_est_payout, liab_prct), 9) as corr_payout_liability,
          cast(null as double) as corr_flat from claim""",
    ),
    "agg10": over("claim", "select channel, policy_report_filed_ind, count(*) as n from claim group by 1, 2"),
    "agg11": over(
        "claim",
        """select distinct top, low from (select max(liab_prct) as top, min(liab_prct) as low
        from claim group by accident_key)""",
    ),
    "agg12": over(
        "claim",
        """select channel, count(*) as n, round(count(*) / (select count(*) from claim), 6) as share
        from claim group by 1""",
    ),
    "agg13": over(
        "claim",
        "\nunion all\n".join(
            f"""select '{c}' as "column", cast({c} as varchar) as value, count(*) as count from claim group by {c}"""
            for c in ("channel", "claim_day_of_week", "witness_present_ind", "policy_report_filed_ind")
        ),
    ),
    "win01": over(
        "claim",
        """select claim_day_of_week, count(*) as n,
          round(count(*) * 100.0 / sum(count(*)) over (), 2) as percentage from claim group by 1""",
    ),
    "win02": over(
        "driver",
        """select driver_key, gender, safety_rating,
          round(percent_rank() over (partition by gender order by safety_rating), 12) as p_rank from driver""",
    ),
    "win03": over(
        "driver",
        """select driver_key, case when p <= 0.25 then 'bottom_quartile' when p >= 0.75 then 'top_quartile'
          else 'middle_50pct' end as group_label
        from (select *, percent_rank() over (partition by gender order by safety_rating) as p from driver)""",
    ),
    "srt01": over("claim", "select witness_present_ind, count(*) as n from claim group by 1"),
    "srt02": over("claim", "select channel, claim_day_of_week, count(*) as n from claim group by 1, 2"),
    "srt03": over(
        "vehicle claim",
        f"select {_PRICE_BAND}, count(*) as num_claims from vehicle join claim using (vehicle_key) group by 1",
    ),
    "srt04": over(
        "claim",
        "select claim_number, claim_est_payout from claim order by claim_est_payout desc, claim_number limit 20",
    ),
}

# --- scalar functions ---
_MONEY = "coalesce(format('{{:,.2f}}', {}), 'N/A')"
ORACLES |= {
    "scl01": over(
        "claim",
        "select claim_number, case when claim_number % 7 = 0 then null else claim_date end as parsed from claim",
    ),
    "scl02": over(
        "claim",
        """select claim_number, year(claim_date) as y, month(claim_date) as m, hour(claim_date) as h,
          day(claim_date) as d, isodow(claim_date) - 1 as dow from claim""",
    ),
    "scl03": over("claim", "select claim_number, (month(claim_date) - 1) // 3 + 1 as quarter from claim"),
    "scl04": over(
        "vehicle",
        """select vehicle_key, case when vehicle_key % 10 in (0, 1) then null else vehicle_price end as price,
          cast(case when vehicle_key % 15 = 0 then 1980 else vehicle_made_year end as double) as made from vehicle""",
    ),
    "scl05": over(
        "wide",
        """select claim_number,
          case when vehicle_price is not null then greatest(15000, least(40000, vehicle_price)) end as both,
          case when vehicle_mileage is not null then greatest(50000, vehicle_mileage) end as floor from wide""",
    ),
    "scl06": over(
        "claim",
        """select claim_number, round(ln(1 + claim_est_payout), 9) as log, round(sqrt(liab_prct), 9) as root,
          liab_prct ** 2 as square, liab_prct ** 3 as cube, abs(liab_prct - 50) as size from claim""",
    ),
    "scl07": over("claim", "select claim_number, round(claim_est_payout / 7, 2) as rounded from claim"),
    "scl08": over("wide", "select claim_number, lower(channel) as low, upper(accident_site) as up from t", t=_TEXT),
    "scl09": over(
        "wide",
        """select claim_number, cast(regexp_matches(accident_type, 'SINGLE', 'i') as integer) as single,
          cast(regexp_matches(accident_type, 'multi.*clear', 'i') as integer) as multi_clear,
          cast(regexp_matches(accident_site, 'highway', 'i') as integer) as highway,
          coalesce(cast(regexp_matches(witness_present_ind, 'y', 'i') as integer), 0) as witness from wide""",
    ),
    "scl10": over(
        "claim",
        """select claim_number, lpad(cast((policyholder_key * 37) % 99999 as varchar), 5, '0') as padded,
          case when length(cast(claim_number as varchar)) < 5 then lpad(cast(claim_number as varchar), 5, '0')
            else cast(claim_number as varchar) end as long,
          nullif(left(zip_code, 3), '000') as zip3 from claim""",
    ),
    "scl11": over("wide", "select claim_number, accident_site || '_' || accident_type as combo from wide"),
    "scl12": over(
        "claim",
        """select claim_number, coalesce(cast(witness_present_ind = 'Y' as integer), 0) as seen,
          coalesce(cast(witness_present_ind <> 'Y' as integer), 0) as unseen,
          cast(isodow(claim_date) >= 6 as integer) as weekend from claim""",
    ),
    "scl13": over(
        "wide",
        f"""select claim_number, {_MONEY.format('claim_est_payout')} as payout,
          {_MONEY.format('vehicle_price')} as price, coalesce(witness_present_ind, 'N/A') as witness from wide""",
    ),
    "scl14": over(
        "claim vehicle",
        """select channel as category from claim where subrogation = 1
        union select claim_day_of_week from claim where subrogation = 0
        union select vehicle_category from vehicle""",
    ),
}

# --- the same operations over all rows, with keys that are missing or respelled ---
_MISSED = "case when claim_number % 11 = 0 then null when claim_number % 13 = 0 then {other} else {column} end"
_CHANNEL = _MISSED.format(column="channel", other="lower(channel)")
ORACLES |= {
    "jn04_left_all": over(
        "policyholder claim",
        f"""select claim_number, annual_income
        from (select claim_number, {_MISSED.format(column="policyholder_key", other="-1 - policyholder_key")} as k from claim) c
        left join policyholder p on c.k = p.policyholder_key""",
    ),
    "jn07_all": over(
        "claim",
        f"""select claim_number, round(coalesce(m, (select avg(subrogation) from claim)), 9) as encoded
        from (select claim_number, {_CHANNEL} as channel from claim)
        left join (select channel, avg(subrogation) as m from claim group by 1) using (channel)""",
    ),
    "scl14_all": over(
        "claim vehicle",
        f"""select {_CHANNEL} as category from claim
        union select claim_day_of_week from claim
        union select vehicle_category from vehicle""",
    ),
}
