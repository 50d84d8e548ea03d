"""Oracles of least squares: normal equations solved step by step in SQL."""

import random

from oracles.basics import over
from oracles.features import ART


def solve(source: str, features: list[str], y: str) -> dict[str, str]:
    """CTEs that end in ``inv``: n, means, covariances with y, and the inverse of the
    covariance matrix of the features (Gauss-Jordan, one step per feature)."""
    p = range(len(features))
    moments = ", ".join(
        ["count(*) as n", f"avg({y}) as my", f"var_pop({y}) as vy"]
        + [f"avg({f}) as m{i}" for i, f in enumerate(features)]
        + [f"covar_pop({f}, {y}) as c{i}" for i, f in enumerate(features)]
        + [f"covar_pop({a}, {b}) as a{i}_{j}" for i, a in enumerate(features) for j, b in enumerate(features)]
        + [f"{1 if i == j else 0}.0::double as b{i}_{j}" for i in p for j in p]
    )
    steps = {"moments": f"select {moments} from {source}"}
    last = "moments"
    keep = ", ".join(["n", "my", "vy"] + [f"m{i}" for i in p] + [f"c{i}" for i in p])
    for k in p:
        cells = []
        for i in p:
            for side in "ab":
                for j in p:
                    pivot = f"{side}{k}_{j} / a{k}_{k}"
                    cells.append(
                        f"{pivot} as {side}{i}_{j}"
                        if i == k
                        else f"{side}{i}_{j} - a{i}_{k} * ({pivot}) as {side}{i}_{j}"
                    )
        steps[f"step{k}"] = f"select {keep}, {', '.join(cells)} from {last}"
        last = f"step{k}"
    coefs = ", ".join(" + ".join(f"b{i}_{j} * c{j}" for j in p) + f" as w{i}" for i in p)
    steps["inv"] = f"select *, {coefs} from {last}"
    return steps


_PAYOUT = [
    "is_multi_vehicle", "has_witness", "has_police_report", "in_network", "has_subrogation", "liab_prct",
    "accident_site_encoded", "accident_type_encoded", "channel_encoded",
]


def _payout_frame(truthy: str) -> str:
    return f"""select claim_number, claim_est_payout,
      case when accident_type like '%multi_vehicle%' then 1 else 0 end as is_multi_vehicle,
      case when {truthy.format('witness_present_ind')} then 1 else 0 end as has_witness,
      case when policy_report_filed_ind = 1 then 1 else 0 end as has_police_report,
      case when {truthy.format('in_network_bodyshop')} then 1 else 0 end as in_network,
      subrogation as has_subrogation, liab_prct,
      (select count(distinct accident_site) from accident s where s.accident_site < a.accident_site)
        as accident_site_encoded,
      (select count(distinct accident_type) from accident s where s.accident_type < a.accident_type)
        as accident_type_encoded,
      case channel when 'Broker' then 0 when 'Online' then 1 else 2 end as channel_encoded
    from claim c join accident a on c.accident_key = a.accident_key"""


def _payout(truthy: str, used: list[str]) -> dict[str, str]:
    guess = " + ".join(f"w{i} * ({f} - m{i})" for i, f in enumerate(used))
    weight = {f: f"w{i}" for i, f in enumerate(used)}
    rows = [f"select '{m}' as metric, {v} as value from {t}" for m, v, t in (
        ("mse", "mse", "e"), ("r2_score", "r2", "e"),
    )]
    rows.append("select 'num_samples', cast(count(*) as double) from fr")
    rows += [f"select 'coef_{f}', {weight.get(f, '0')} from inv" for f in _PAYOUT]
    rows.append("select 'intercept', my - (" + " + ".join(f"w{i} * m{i}" for i in range(len(used))) + ") from inv")
    return {
        "fr": _payout_frame(truthy),
        "tr": "select * from fr where left(md5('42:' || claim_number), 8) >= '33333333'",
        **solve("tr", used, "claim_est_payout"),
        "e": f"""select avg((claim_est_payout - g) ** 2) as mse,
          1 - avg((claim_est_payout - g) ** 2) / var_pop(claim_est_payout) as r2
          from (select claim_est_payout, my + {guess} as g from fr, inv
                where left(md5('42:' || claim_number), 8) < '33333333')""",
        "r": "\nunion all\n".join(rows),
    }


_SHOWN = """select metric, case when metric = 'mse' then round(value, 1) when metric = 'r2_score' then round(value, 9)
  else round(value, 4) end as value from r"""
_ANY = "lower({}) in ('y', 'yes', 'true', '1')"
_LITERAL = "{} = 'Yes'"

_LABEL = ["vehicle_price", "claim_est_payout", "liab_prct", "witness_present", "policy_report_filed"]
_P = range(len(_LABEL))
_QUAD = " + ".join(f"m{i} * b{i}_{j} * m{j}" for i in _P for j in _P)
_LABEL_STEPS = {
    "fr": """select cast(subrogation as double) as subrogation, vehicle_price, claim_est_payout, liab_prct,
      case witness_present_ind when 'Y' then 1 when 'N' then 0 end as witness_present,
      policy_report_filed_ind as policy_report_filed
      from claim join vehicle using (vehicle_key)
      where vehicle_price is not null and witness_present_ind is not null""",
    **solve("fr", _LABEL, "subrogation"),
    "s": f"""select *, ({' + '.join(f'w{i} * c{i}' for i in _P)}) / vy as r2,
      n * (vy - ({' + '.join(f'w{i} * c{i}' for i in _P)})) / (n - {len(_LABEL) + 1}) as s2 from inv""",
    "r": "\nunion all\n".join(
        [
            f"select '{f}' as term, w{i} as coef, sqrt(s2 * b{i}_{i} / n) as std_err, r2, n from s"
            for i, f in enumerate(_LABEL)
        ]
        + [
            f"""select 'const', my - ({' + '.join(f'w{i} * m{i}' for i in _P)}),
              sqrt(s2 * (1 + {_QUAD}) / n), r2, n from s"""
        ]
    ),
}

_LOGIT = ("liab_prct", "accident_key", "policy_report_filed_ind", "safety_rating", "liab_prct:safety_rating", "const")
# Columns are scaled so that the normal equations are well conditioned; coefficients are of the scaled columns.
_LOGIT_X = ("liab_prct / 100", "accident_key / 10.0", "policy_report_filed_ind * 1.0", "safety_rating / 100", "liab_prct * safety_rating / 10000", "1.0")


def _eliminated(name: str, source: str, n: int) -> dict[str, str]:
    """CTEs that solve sum(w x_i x_j) b_j = sum(w x_i z) by full elimination; the last has b0.. and the inverse's diagonal d0.."""
    wide = 2 * n + 1  # matrix, right side, identity
    cells = [f"sum(w * x{i} * x{j}) as m{i}_{j}" for i in range(n) for j in range(n)]
    cells += [f"sum(w * x{i} * z) as m{i}_{n}" for i in range(n)]
    cells += [f"{1.0 if i == j else 0.0}::double as m{i}_{n + 1 + j}" for i in range(n) for j in range(n)]
    steps = {f"{name}_0": f"select {', '.join(cells)} from {source}"}
    for p in range(n):
        row = [f"m{p}_{j} / m{p}_{p} as m{p}_{j}" for j in range(wide)]
        rest = [f"m{i}_{j} - m{i}_{p} * m{p}_{j} / m{p}_{p} as m{i}_{j}" for i in range(n) if i != p for j in range(wide)]
        steps[f"{name}_{p + 1}"] = f"select {', '.join(row + rest)} from {name}_{p}"
    solved = [f"m{i}_{n} as b{i}, m{i}_{n + 1 + i} as d{i}" for i in range(n)]
    return steps | {name: f"select {', '.join(solved)} from {name}_{n}"}


def _newton(steps: int = 9) -> dict[str, str]:
    """Reweighted least squares from zero; nine steps are beyond the digits compared."""
    n, x = len(_LOGIT), ", ".join(f"x{i}" for i in range(len(_LOGIT)))
    ctes = {"b_start": "select " + ", ".join(f"0.0::double as b{i}" for i in range(n))}
    before = "b_start"
    for t in range(steps):
        eta = " + ".join(f"b{i} * x{i}" for i in range(n))
        ctes[f"r{t}"] = f"""select {x}, p * (1 - p) as w, eta + (y - p) / (p * (1 - p)) as z
          from (select {x}, y, eta, 1 / (1 + exp(-eta)) as p from (select {x}, y, {eta} as eta from pts, {before}))"""
        ctes |= _eliminated(f"b{t}_", f"r{t}", n)
        before = f"b{t}_"
    eta = " + ".join(f"b{i} * x{i}" for i in range(n))
    ctes["fit"] = f"""select -2 * sum(y * eta - ln(1 + exp(eta))) as deviance, avg(y) as share, count(*) as n
      from (select y, {eta} as eta from pts, {before})"""
    ctes["pseudo"] = "select 1 - deviance / (-2 * n * (share * ln(share) + (1 - share) * ln(1 - share))) as pseudo_r2, n from fit"
    rows = [f"select '{t}' as term, b{i} as coef, sqrt(d{i}) as std_err from {before}" for i, t in enumerate(_LOGIT)]
    return ctes | {"terms": " union all ".join(rows)}


HOLD = "(year(claim_date) = 2000 and month(claim_date) = 9)"


def _drawn(trials: int = 20) -> str:
    """The search's parameters: seeded draws, log-uniform, whole and uniform."""
    rng, rows = random.Random(42), []
    for t in range(trials):
        step = 0.01 * 5.0 ** rng.random()
        depth, least = rng.randint(3, 8), rng.randint(10, 50)
        share = rng.uniform(0.5, 1.0)
        rows.append(f"({t}, {step!r}::double, {depth}.0::double, {least}.0::double, {share!r}::double)")
    return ", ".join(rows)


ORACLES = {
    "ml05": over("scored", f"select claim_number, cast(y as integer) as subrogation, true as within from scored where {HOLD}"),
    "ml05_metrics": """select 27 as n_features, true as ranks_train, true as ranks_test, true as above_all_positive,
      true as on_grid, true as waited, true as better""",
    "ml06": over(
        "scored",
        f"""select count(*) filter (where not {HOLD}) as oof_rows, count(distinct claim_number) filter (where not {HOLD}) as oof_keys,
          count(*) filter (where {HOLD}) as test_rows, 5 as folds, true as waited, true as kept_some,
          true as weights_sum_to_one, true as ranks, true as on_grid, true as f1_within from scored""",
    ),
    "ml06_predictions": over("scored", f"select claim_number, true as within, true as follows from scored where {HOLD}"),
    "ml12": f"""select trial, round(step, 9) as stepSize, depth as maxDepth, least as minInstancesPerNode,
      round(share, 9) as subsamplingRate, true as within, true as sorted, true as learns, true as waited
      from (values {_drawn()}) t(trial, step, depth, least, share)""",
    "mp06_neighbours": over(
        "scored",
        """select claim_number, cast(unnest(range(1, 6)) as integer) as rank, round(unnest(near), 6) as distance
        from (select a.claim_number, min(sqrt(power(a.liab_prct - b.liab_prct, 2) + power((a.claim_est_payout - b.claim_est_payout) / 1000, 2)
                + power(100 * (a.p_a - b.p_a), 2) + power(a.m - b.m, 2)), 5) as near
              from pts a join pts b on a.claim_number <> b.claim_number group by a.claim_number)""",
        pts="select claim_number, liab_prct, claim_est_payout, p_a, claim_number % 97 as m from scored where y = 1",
    ),
    "ml01": over("accident claim", _SHOWN, **_payout(_ANY, _PAYOUT)),
    "ml01_literal": over(
        "accident claim",
        _SHOWN,
        **_payout(_LITERAL, [f for f in _PAYOUT if f not in ("has_witness", "in_network")]),
    ),
    "ml02": over(
        "accident claim",
        """select substr(metric, 6) as feature, round(value, 4) as coefficient, round(abs(value), 4) as abs_coefficient
        from r where metric like 'coef_%'""",
        **_payout(_ANY, _PAYOUT),
    ),
    "ml03": over(
        "claim vehicle",
        """select term, round(coef, 12) as coef, round(std_err, 12) as std_err, round(coef / std_err, 5) as t,
          round(r2, 9) as r2, n from r""",
        **_LABEL_STEPS,
    ),
    "ml03_summary": over(
        "claim vehicle",
        """select term, abs(coef / std_err) > 1.96 as significant, abs(coef / std_err) > 3.2906 as strongly, n from r""",
        **_LABEL_STEPS,
    ),
    "ml04": over(
        "claim driver",
        "select term, round(coef, 5) as coef, round(std_err, 5) as std_err, round(pseudo_r2, 7) as pseudo_r2, n from terms, pseudo",
        pts=f"""select {', '.join(f'{x} as x{i}' for i, x in enumerate(_LOGIT_X))}, cast(subrogation as double) as y
          from claim c join driver d on c.driver_key = d.driver_key
          where subrogation is not null and liab_prct is not null and accident_key is not null
            and policy_report_filed_ind is not null and safety_rating is not null""".replace("accident_key /", "c.accident_key /"),
        **_newton(),
    ),
    "mp06": over(
        "scored",
        """select cast(y as integer) as subrogation, 0 as synthetic, count(*) as n, 0 as outside from scored group by y
        union all
        select 1, 1, cast(trunc(0.6 * count(*) filter (where y = 0) - count(*) filter (where y = 1)) as bigint), 0
        from scored having 0.6 * count(*) filter (where y = 0) >= count(*) filter (where y = 1) + 1""",
    ),
    "snk06_artifacts": over(
        "wide",
        "select round(columns(*), 9) from art",
        art=f"{ART} from wide",
    ),
}
