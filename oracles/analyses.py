"""Oracles of the named analyses."""

from oracles.star import over



def _half_up(x: str, digits: int) -> str:
    """Round the decimal value, so that a mean that ends in 5 goes up."""
    return f"cast(round(cast({x} as decimal(28, 8)), {digits}) as double)"


YES = "lower(trim(coalesce(witness_present_ind, ''))) in ('y', 'yes', 'true', '1')"


def _pct(part: str, whole: str) -> str:
    return f"round(({part}) * 100.0 / ({whole}), 2)"


def _share(table: str, column: str, count: str) -> str:
    return over(
        table,
        f"""select {column}, count(*) as {count},
          round(count(*) * 100.0 / sum(count(*)) over (), 2) as percentage
        from {table} group by {column}""",
    )


def _both(test: str) -> str:
    return f"({test} and policy_report_filed_ind = 1)"


def _acl08(test: str) -> str:
    return over(
        "claim",
        f"""select count(*) as claims_with_both,
          round(count(*) * 100.0 / (select count(*) from claim), 2) as percentage_of_total
        from claim where {_both(test)}""",
    )


def _acc08(test: str) -> str:
    return over(
        "accident claim",
        f"""select accident_type, accident_site, count(*) as high_potential_claims,
          round(count(*) * 100.0 / (select count(*) from claim), 2) as percentage_of_claims
        from accident join claim using (accident_key)
        where accident_type like '%multi_vehicle%' and {_both(test)}
        group by accident_type, accident_site""",
    )


def _indicators(column: str, test: str) -> str:
    return over(
        "accident claim",
        f"""select {column}, count(*) as total_claims,
          cast(sum(case when {test} then 1 else 0 end) as bigint) as claims_with_witness,
          cast(sum(case when policy_report_filed_ind = 1 then 1 else 0 end) as bigint)
            as claims_with_police_report,
          cast(sum(case when {_both(test)} then 1 else 0 end) as bigint) as claims_with_both,
          round(sum(case when {_both(test)} then 1 else 0 end) * 100.0 / count(*), 2)
            as subrogation_potential_pct
        from accident join claim using (accident_key) group by {column}""",
    )


def _acc11(test: str) -> str:
    return over(
        "accident claim",
        f"""select accident_key, accident_site, accident_type, count(*) as claim_count,
          cast(sum(case when {test} then 1 else 0 end) as bigint) as witness_count,
          cast(sum(case when policy_report_filed_ind = 1 then 1 else 0 end) as bigint) as police_report_count,
          case when accident_type like '%multi_vehicle%'
                 and sum(case when {test} then 1 else 0 end) > 0
                 and sum(case when policy_report_filed_ind = 1 then 1 else 0 end) > 0 then 'High'
               when accident_type like '%multi_vehicle%' then 'Medium' else 'Low' end
            as subrogation_priority
        from accident join claim using (accident_key)
        group by accident_key, accident_site, accident_type""",
    )


LITERAL = "witness_present_ind = 'Yes'"
RATE = "round(avg(case when subrogation > 0 then 1 else 0 end), 4) as subro_rate"
VALUE = "round(avg(claim_est_payout / nullif(vehicle_price, 0)), 4) as avg_claim_to_value_ratio"
JOINED = "from vehicle join claim using (vehicle_key)"

ORACLES = {
    "acl01": over("claim", "select count(*) as total_claims from claim"),
    "acl02": over("claim", "select * from claim order by claim_number limit 10"),
    "acl03": over(
        "claim",
        """select count(*) as total_records,
          count(witness_present_ind) as witness_present_count,
          count(policy_report_filed_ind) as policy_report_filed_count,
          count(in_network_bodyshop) as in_network_bodyshop_count,
          count(accident_key) as accident_key_count,
          count(policyholder_key) as policyholder_key_count,
          count(vehicle_key) as vehicle_key_count,
          count(driver_key) as driver_key_count from claim""",
    ),
    "acl04": _share("claim", "witness_present_ind", "claim_count"),
    "acl05": _share("claim", "policy_report_filed_ind", "claim_count"),
    "acl06": _share("claim", "in_network_bodyshop", "claim_count"),
    "acl07": over(
        "claim",
        """select witness_present_ind, policy_report_filed_ind, count(*) as claim_count
        from claim group by 1, 2""",
    ),
    "acl08": _acl08(YES),
    "acl08_literal": _acl08(LITERAL),
    "acl09": over(
        "claim",
        """select accident_key, count(*) as claim_count from claim group by accident_key
        having count(*) > 1 order by claim_count desc, accident_key limit 20""",
    ),
    "acl10": over(
        "claim",
        """select count(distinct accident_key) as unique_accidents,
          count(distinct policyholder_key) as unique_policyholders,
          count(distinct vehicle_key) as unique_vehicles,
          count(distinct driver_key) as unique_drivers from claim""",
    ),
    "acc01": over(
        "accident",
        """select count(*) as total_accidents, count(distinct accident_site) as unique_sites,
          count(distinct accident_type) as unique_types from accident""",
    ),
    "acc02": over("accident", "select * from accident order by accident_key limit 10"),
    "acc03": _share("accident", "accident_type", "accident_count"),
    "acc04": _share("accident", "accident_site", "accident_count"),
    "acc05": over(
        "accident",
        """select accident_type, count(*) as multi_vehicle_count,
          round(count(*) * 100.0 / (select count(*) from accident), 2) as percentage_of_all
        from accident where accident_type like '%multi_vehicle%' group by accident_type""",
    ),
    "acc06": over(
        "accident",
        """select accident_site, accident_type, count(*) as accident_count from accident
        group by 1, 2 order by accident_count desc, accident_site, accident_type limit 20""",
    ),
    "acc07": over(
        "accident claim",
        """select claim_number, accident_key, accident_site, accident_type, witness_present_ind,
          policy_report_filed_ind, in_network_bodyshop
        from accident join claim using (accident_key) order by claim_number limit 20""",
    ),
    "acc08": _acc08(YES),
    "acc08_literal": _acc08(LITERAL),
    "acc09": _indicators("accident_type", YES),
    "acc09_literal": _indicators("accident_type", LITERAL),
    "acc10": _indicators("accident_site", YES),
    "acc10_literal": _indicators("accident_site", LITERAL),
    "acc11": _acc11(YES),
    "acc11_literal": _acc11(LITERAL),
    "veh01": over(
        "vehicle claim",
        f"""select vehicle_category, vehicle_color, count(*) as num_claims, {RATE},
          {_half_up('avg(case when subrogation > 0 then claim_est_payout end)', 2)} as avg_payout_subro,
          {_half_up('avg(case when subrogation = 0 then claim_est_payout end)', 2)} as avg_payout_non,
          {VALUE} {JOINED} group by 1, 2""",
    ),
    "veh02": over(
        "vehicle claim",
        f"""select case when vehicle_price < 15000 then '<15k'
            when vehicle_price >= 15000 and vehicle_price < 25000 then '15k–25k'
            when vehicle_price >= 25000 and vehicle_price < 40000 then '25k–40k'
            else '≥40k' end as price_band,
          count(*) as num_claims, {RATE}, {_half_up('avg(claim_est_payout)', 2)} as avg_payout, {VALUE}
        {JOINED} group by 1""",
    ),
    "veh03": over(
        "vehicle claim",
        f"""select case when vehicle_mileage < 10000 then '<10k'
            when vehicle_mileage >= 10000 and vehicle_mileage < 50000 then '10k–50k'
            when vehicle_mileage >= 50000 and vehicle_mileage < 100000 then '50k–100k'
            else '≥100k' end as mileage_band,
          count(*) as num_claims, {RATE},
          {_half_up('avg(case when subrogation > 0 then liab_prct end)', 2)} as avg_liability_if_subro,
          {_half_up('avg(claim_est_payout)', 2)} as avg_payout
        {JOINED} group by 1""",
    ),
    "veh04": over(
        "vehicle claim",
        f"""select vehicle_category, witness_present_ind, policy_report_filed_ind,
          count(*) as num_claims, {RATE} {JOINED} group by 1, 2, 3""",
    ),
    "veh05": over(
        "vehicle claim",
        f"""select vehicle_category, channel, count(*) as num_claims, {RATE},
          {_half_up('avg(claim_est_payout)', 2)} as avg_payout {JOINED} group by 1, 2 having count(*) >= 50""",
    ),
    "veh06": over(
        "claim",
        """select round(avg(subrogation), 6) as avg_subrogation,
          round(avg(claim_est_payout), 4) as avg_payout,
          round(avg(liab_prct), 6) as avg_liability_pct from claim""",
    ),
    "veh07": over(
        "vehicle",
        """select round(avg(vehicle_price), 6) as avg_vehicle_price,
          round(avg(vehicle_mileage), 6) as avg_mileage,
          round(avg(vehicle_weight), 6) as avg_weight from vehicle""",
    ),
    "veh08": over(
        "claim vehicle",
        "\nunion all\n".join(
            f"""select '{c}' as "column", cast({c} as varchar) as value, count(*) as count
            from {t} group by {c}"""
            for t, c in (
                ("claim", "channel"),
                ("claim", "claim_day_of_week"),
                ("claim", "witness_present_ind"),
                ("claim", "policy_report_filed_ind"),
                ("vehicle", "vehicle_category"),
                ("vehicle", "vehicle_color"),
            )
        ),
    ),
    "veh09": over(
        "vehicle claim",
        f"""select round(corr(subrogation, vehicle_price), 9) as corr_subro_price,
          round(corr(subrogation, vehicle_mileage), 9) as corr_subro_mileage,
          round(corr(claim_est_payout, vehicle_price), 9) as corr_payout_price,
          round(corr(subrogation, liab_prct), 9) as corr_subro_liability {JOINED}""",
    ),
    "drv01": over(
        "driver",
        """select gender, count(*) as total_drivers,
          round(avg(age_of_DL), 1) as "avg_age_when_got_DL",
          round(avg(safety_rating), 2) as avg_safety_rating from driver group by gender""",
    ),
    "drv02": over(
        "driver",
        """select case when age_of_DL < 18 then 'Early' when age_of_DL between 18 and 25 then 'Young'
            when age_of_DL between 26 and 40 then 'Mid' else 'Late' end as dl_age_group,
          gender, count(*) as total_drivers, round(avg(safety_rating), 2) as avg_safety_rating
        from driver group by 1, 2""",
    ),
    "drv03": over(
        "driver",
        """select gender, group_label, count(*) as driver_count,
          quantile_cont(safety_rating, 0.5) as median_group, max(median_gender) as median_total_gender,
          quantile_cont(safety_rating, 0.5) - max(median_gender) as diff_from_total_median
        from (select r.*, median_gender, case when p_rank <= 0.25 then 'bottom_quartile'
                when p_rank >= 0.75 then 'top_quartile' else 'middle_50pct' end as group_label
              from (select *, percent_rank() over (partition by gender order by safety_rating) as p_rank
                    from driver) r
              join (select gender, quantile_cont(safety_rating, 0.5) as median_gender
                    from driver group by gender) g using (gender))
        group by gender, group_label""",
    ),
    "drv04": over(
        "driver claim",
        "\nunion all\n".join(
            f"""select '{c}' as "column",
              case when var_pop({c}) > 0 then round(corr({c}, subrogation), 9) end as corr_with_subrogation
            from driver join claim using (driver_key)"""
            for c in (
                "driver_key",
                "year_of_born",
                "age_of_DL",
                "safety_rating",
                "claim_number",
                "claim_est_payout",
                "liab_prct",
                "policy_report_filed_ind",
                "accident_key",
                "policyholder_key",
                "vehicle_key",
            )
        ),
    ),
}

POL = {
    "pol01": """select high_education_ind as has_higher_ed, avg(claim_est_payout) as avg_payout,
        count(*) as total_claims
      from claim c left join policyholder p on c.policyholder_key = p.policyholder_key group by 1""",
    "pol02": """select annual_income, count(*) as num_claims, avg(claim_est_payout) as avg_payout
      from claim join policyholder using (policyholder_key) group by 1""",
    "pol03": """select high_education_ind as has_higher_ed, avg(past_num_of_claims) as avg_past_claims
      from policyholder group by 1""",
    "pol04": f"""select case when high_education_ind = 1 then 'HigherEdu' else 'NonEdu' end as education,
        living_status, {_half_up('avg(claim_est_payout)', 2)} as avg_payout, count(*) as num_claims
      from claim join policyholder using (policyholder_key) group by 1, 2""",
    "pol05": f"""select past_num_of_claims as prev_claims, count(claim_number) as new_claims,
        {_half_up('avg(claim_est_payout)', 2)} as avg_payout
      from claim join policyholder using (policyholder_key) group by 1""",
    "pol06": f"""select channel, count(*) as num_claims, {_half_up('avg(claim_est_payout)', 2)} as avg_payout,
        round(sum(claim_est_payout), 2) as total_payout from claim group by 1""",
    "pol07": """select accident_key, count(*) as num_claims, avg(claim_est_payout) as avg_payout
      from claim group by 1""",
    "pol08": """select accident_key, witness_present_ind, policy_report_filed_ind, count(*) as num_claims,
        avg(claim_est_payout) as avg_payout from claim group by 1, 2, 3""",
    "pol09": """select claim_number, accident_key, policy_report_filed_ind, witness_present_ind,
        past_num_of_claims, claim_est_payout
      from claim join policyholder using (policyholder_key)
      where policy_report_filed_ind = 1 and witness_present_ind = 'Y' and liab_prct between 20 and 80""",
}


def _rounded(sql: str) -> str:
    """Averages the analysis leaves unrounded are compared to four places."""
    for c in ("avg_payout", "avg_past_claims"):
        sql = sql.replace(
            f"avg({'claim_est_payout' if c == 'avg_payout' else 'past_num_of_claims'}) as {c}",
            f"round(avg({'claim_est_payout' if c == 'avg_payout' else 'past_num_of_claims'}), 4) as {c}",
        )
    return sql


ORACLES |= {name: over("claim policyholder", _rounded(sql)) for name, sql in POL.items()}


def _money(x: str) -> str:
    return f"coalesce(format('{{:,.2f}}', {x}), 'N/A')"


def _na(x: str) -> str:
    return f"coalesce(cast({x} as varchar), 'N/A')"


def _insight(source: str, body: str) -> str:
    return over("claim policyholder", body, r=POL[source])


ORACLES |= {
    "ins01": _insight(
        "pol01",
        f"""select high_claims, low_claims, round(high_avg, 4) as high_avg, round(low_avg, 4) as low_avg,
          round(high_avg - low_avg, 4) as payout_gap, round(gap, 6) as gap_pct,
          'Higher-education policyholders file ' || high_claims || ' claims with avg payout $'
          || {_money('high_avg')} || ', vs others ' || low_claims || ' claims at $' || {_money('low_avg')}
          || '. Difference: ' || {_money('gap')} || '%.' as insight
        from (select h.total_claims as high_claims, h.avg_payout as high_avg,
                l.total_claims as low_claims, l.avg_payout as low_avg,
                case when l.avg_payout <> 0
                  then (h.avg_payout - l.avg_payout) / l.avg_payout * 100 else 0 end as gap
              from r h, r l where h.has_higher_ed = 1 and l.has_higher_ed = 0)""",
    ),
    "ins02": _insight(
        "pol02",
        f"""select f.annual_income as frequent_income, f.num_claims as frequent_claims,
          round(f.avg_payout, 4) as frequent_avg, h.annual_income as highest_income,
          round(h.avg_payout, 4) as highest_avg,
          'Most frequent income level = ' || {_money('f.annual_income')} || ' with ' || f.num_claims
          || ' claims (avg payout $' || {_money('f.avg_payout')} || '). Highest avg payout = '
          || {_money('h.annual_income')} || ' with $' || {_money('h.avg_payout')} || '.' as insight
        from (select * from r order by num_claims desc, annual_income limit 1) f,
             (select * from r order by avg_payout desc, annual_income limit 1) h""",
    ),
    "ins03": _insight(
        "pol03",
        f"""select round(h.avg_past_claims, 4) as high_past, round(l.avg_past_claims, 4) as low_past,
          'On average, higher-education policyholders had ' || {_money('h.avg_past_claims')}
          || ' past claims vs others ' || {_money('l.avg_past_claims')} || '.' as insight
        from r h, r l where h.has_higher_ed = 1 and l.has_higher_ed = 0""",
    ),
    "ins04": _insight(
        "pol04",
        f"""select h.education || '/' || h.living_status as highest_group, h.avg_payout as highest_avg,
          h.num_claims as highest_claims, f.education || '/' || f.living_status as frequent_group,
          f.num_claims as frequent_claims,
          'Highest avg payout group = ' || h.education || '/' || h.living_status || ' ($'
          || {_money('h.avg_payout')} || ', ' || h.num_claims || ' claims). Most frequent group = '
          || f.education || '/' || f.living_status || ' with ' || f.num_claims || ' claims.' as insight
        from (select * from r order by avg_payout desc, education, living_status limit 1) h,
             (select * from r order by num_claims desc, education, living_status limit 1) f""",
    ),
    "ins05": _insight(
        "pol05",
        f"""select l.prev_claims as low_prior, l.new_claims as low_new, l.avg_payout as low_avg,
          h.prev_claims as high_prior, h.new_claims as high_new, h.avg_payout as high_avg,
          'Policyholders with ' || l.prev_claims || ' prior claims filed ' || l.new_claims
          || ' new ones (avg payout $' || {_money('l.avg_payout')} || '). Those with ' || h.prev_claims
          || ' prior claims filed ' || h.new_claims || ' new ones (avg payout $'
          || {_money('h.avg_payout')} || ').' as insight
        from (select * from r order by prev_claims limit 1) l,
             (select * from r order by prev_claims desc limit 1) h""",
    ),
    "ins06": _insight(
        "pol06",
        f"""select a.channel as avg_channel, a.avg_payout as avg_value, t.channel as total_channel,
          t.total_payout as total_value, n.channel as active_channel, n.num_claims as active_value,
          'Highest avg payout channel = ' || {_na('a.channel')} || ' ($' || {_money('a.avg_payout')}
          || '). Highest total payout = ' || {_na('t.channel')} || ' ($' || {_money('t.total_payout')}
          || '). Most active channel = ' || {_na('n.channel')} || ' (' || n.num_claims || ' claims).' as insight
        from (select * from r order by avg_payout desc, channel limit 1) a,
             (select * from r order by total_payout desc, channel limit 1) t,
             (select * from r order by num_claims desc, channel limit 1) n""",
    ),
    "ins07": _insight(
        "pol07",
        f"""select accident_key, num_claims, round(avg_payout, 4) as avg_payout,
          'Most common accident_key = ' || {_na('accident_key')} || ' with ' || num_claims
          || ' claims (avg payout $' || {_money('avg_payout')} || ').' as insight
        from r order by num_claims desc, accident_key limit 1""",
    ),
    "ins08": _insight(
        "pol08",
        f"""select accident_key, witness_present_ind, policy_report_filed_ind, num_claims,
          round(avg_payout, 4) as avg_payout,
          'Most common accident_key = ' || {_na('accident_key')} || ' with witness_present_ind='
          || {_na('witness_present_ind')} || ' and policy_report_filed_ind='
          || {_na('policy_report_filed_ind')} || ' had ' || num_claims || ' claims (avg payout $'
          || {_money('avg_payout')} || ').' as insight
        from r order by num_claims desc, accident_key, witness_present_ind, policy_report_filed_ind limit 1""",
    ),
    "ins09": _insight(
        "pol09",
        f"""select claim_number, accident_key, policy_report_filed_ind, witness_present_ind,
          past_num_of_claims, claim_est_payout,
          'Claim ' || claim_number || ' at accident ' || {_na('accident_key')} || ': payout $'
          || {_money('claim_est_payout')} || ', ' || {_na('past_num_of_claims')} || ' past claims.' as insight
        from r order by claim_est_payout desc, claim_number limit 5""",
    ),
}
