"""The derived star as DuckDB CTEs (mapping in FIXTURES.md)."""

STAR = {
    "accident": """
  select k as accident_key,
    case k % 4 when 0 then 'Parking Area' when 1 then 'Highway/Intersection'
               when 2 then 'Local' else 'Unknown' end as accident_site,
    case k % 3 when 0 then 'single_car' when 1 then 'multi_vehicle_clear'
               else 'multi_vehicle_unclear' end as accident_type
  from (select distinct 1 + o_orderkey % 12 as k from orders) t""",
    "driver": """
  select s_suppkey as driver_key, cast(1940 + s_suppkey % 60 as integer) as year_of_born,
    case when s_suppkey % 2 = 0 then 'F' else 'M' end as gender,
    cast(15 + (s_suppkey * 3) % 35 as integer) as age_of_DL,
    cast(1 + (s_suppkey * 17) % 100 as double) as safety_rating
  from supplier""",
    "policyholder": """
  select c_custkey as policyholder_key,
    cast(20000 + (c_custkey % 40) * 2500 as double) as annual_income,
    cast(c_custkey % 2 as integer) as high_education_ind,
    cast((c_custkey + 1) % 2 as integer) as email_or_tel_available,
    case when c_custkey % 5 = 0 then 1 else 0 end as address_change_ind,
    case when c_nationkey % 3 = 0 then 'Own' else 'Rent' end as living_status,
    cast(c_custkey % 8 as integer) as past_num_of_claims
  from customer""",
    "vehicle": """
  select p_partkey as vehicle_key, cast(2000 + p_size % 17 as integer) as vehicle_made_year,
    case p_size % 3 when 0 then 'Compact' when 1 then 'Medium' else 'Large' end as vehicle_category,
    cast(case when p_partkey % 97 = 0 then null else 10000 + (p_partkey * 131) % 50000 end as double)
      as vehicle_price,
    p_brand as vehicle_color, cast(2500 + p_size * 50 as double) as vehicle_weight,
    cast(case when p_partkey % 89 = 0 then null else (p_partkey * 997) % 150000 end as double)
      as vehicle_mileage
  from part""",
    "claim": """
  select l_orderkey * 10 + l_linenumber as claim_number,
    case when l_returnflag = 'R' then 1 else 0 end as subrogation,
    l_extendedprice as claim_est_payout,
    cast((l_partkey * 7 + l_linenumber * 13) % 101 as double) as liab_prct,
    l_shipdate + INTERVAL '1' HOUR * (l_orderkey % 24) as claim_date,
    dayname(l_shipdate + INTERVAL '1' HOUR * (l_orderkey % 24)) as claim_day_of_week,
    case l_linenumber % 3 when 0 then 'Broker' when 1 then 'Phone' else 'Online' end as channel,
    lpad(cast((o_custkey * 37) % 99999 as varchar), 5, '0') as zip_code,
    case when l_linenumber = 7 then null when l_tax < 0.04 then 'Y' else 'N' end as witness_present_ind,
    case when l_linestatus = 'F' then 1 else 0 end as policy_report_filed_ind,
    case when l_quantity < 25 then 'yes' else 'no' end as in_network_bodyshop,
    1 + l_orderkey % 12 as accident_key, o_custkey as policyholder_key,
    l_partkey as vehicle_key, l_suppkey as driver_key
  from (select *, row_number() over (partition by l_orderkey, l_linenumber
          order by l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) as rn
        from lineitem) l
  join orders on l_orderkey = o_orderkey
  where rn = 1""",
    "wide": """
  select c.*, a.* exclude (accident_key), p.* exclude (policyholder_key),
    v.* exclude (vehicle_key), d.* exclude (driver_key)
  from claim c
  left join accident a on c.accident_key = a.accident_key
  left join policyholder p on c.policyholder_key = p.policyholder_key
  left join vehicle v on c.vehicle_key = v.vehicle_key
  left join driver d on c.driver_key = d.driver_key""",
    "scored": """
  select claim_number, claim_date, claim_est_payout, liab_prct, claim_day_of_week,
    case when left(md5('label:' || claim_number), 8) < '19999999' then 1 - rule else rule end as y,
    (100 - liab_prct) / 250.0::double + (w * 3 + q) / 20.0::double + (claim_number % 97) / 1000.0::double as p_a,
    (100 - liab_prct) / 250.0::double + (w + q) / 10.0::double + (claim_number % 89) / 500.0::double as p_b,
    ((100 - liab_prct) / 250.0::double * 2 + (claim_number % 83) / 100.0::double) / 2.0::double as p_c
  from (select *, case when witness_present_ind = 'Y' then 1 else 0 end as w,
          policy_report_filed_ind as q,
          case when liab_prct < 25 and (witness_present_ind = 'Y' or policy_report_filed_ind = 1)
               then 1 else 0 end as rule
        from claim)""",
}
NEEDS = {
    "wide": ("accident", "policyholder", "vehicle", "driver", "claim"),
    "scored": ("claim",),
}


def over(tables: str, body: str, **ctes: str) -> str:
    """``body`` over the named star tables; ``ctes`` are further named steps, in order."""
    names: list[str] = []
    for name in tables.split():
        for needed in (*NEEDS.get(name, ()), name):
            if needed not in names:
                names.append(needed)
    steps = [f"{n} as ({STAR[n]})" for n in names] + [f"{n} as ({sql})" for n, sql in ctes.items()]
    return "with " + ",\n".join(steps) + "\n" + body if steps else body
