"""Oracles of model preparation, evaluation and triage."""

from oracles.star import over

HOLD = "(year(claim_date) = 2000 and month(claim_date) = 9)"
_CATS = """select claim_number, claim_date, subrogation, accident_type, accident_site,
  nullif(left(zip_code, 3), '000') as zip3, accident_site || '_' || accident_type as accident_combo from wide"""


def _te(c: str) -> str:
    return f"""select {c}, (sum(subrogation) + 30 * (select avg(subrogation) from tr))
      / (count(subrogation) + 30) as te from tr where {c} is not null group by {c}"""


_TE = ("accident_type", "accident_site", "zip3", "accident_combo")


def _linear(s: str) -> str:
    """Thresholds 'first, last, denominator' as a table t(step, thr)."""
    first, last, den = s.split()
    return f"select cast(i - {first} as integer) as step, i / {den}.0::double as thr from range({first}, {last} + 1) r(i)"


def _sweep(grid: str, score: str = "p_a", source: str = "scored") -> str:
    return f"""select step, thr, tp, fp, fn,
      case when 2 * tp + fp + fn = 0 then 0 else 2.0 * tp / (2.0 * tp + fp + fn) end as f1
    from (select step, thr, count(*) filter (where {score} >= thr and y = 1) as tp,
            count(*) filter (where {score} >= thr and y = 0) as fp,
            count(*) filter (where {score} < thr and y = 1) as fn
          from {source}, ({_linear(grid)}) t group by step, thr)"""


ENSEMBLE, SEARCH, SINGLE = "40 80 200", "20 40 100", "10 50 100"


def _best(sweep: str) -> str:
    return f"""select case when f1 > 0 then thr else 0.3 end as threshold, f1
      from ({sweep}) order by f1 desc, step limit 1"""


def _f1(score: str, thr: str, source: str) -> str:
    return f"""(select 2.0 * count(*) filter (where {score} >= {thr} and y = 1)
      / (2.0 * count(*) filter (where {score} >= {thr} and y = 1)
         + count(*) filter (where {score} >= {thr} and y = 0)
         + count(*) filter (where {score} < {thr} and y = 1)) from {source})"""


def _auc(score: str, source: str) -> str:
    """Mid-rank formula over single rows."""
    return f"""(select (sum(case when y = 1 then r end) - count(*) filter (where y = 1)
        * (count(*) filter (where y = 1) + 1) / 2.0)
      / (count(*) filter (where y = 1) * 1.0 * count(*) filter (where y = 0))
    from (select y, rank() over (order by {score}) + (count(*) over (partition by {score}) - 1) / 2.0 as r
          from {source}))"""


_PARTS = {
    "tr": f"select * from scored where not {HOLD}",
    "te": f"select * from scored where {HOLD}",
}
_METRICS = _PARTS | {
    "b": _best(_sweep(SINGLE, source="tr")),
    "m": f"""select {_f1('p_a', '(select threshold from b)', 'tr')} as train_f1, {_auc('p_a', 'tr')} as train_auc,
      {_f1('p_a', '(select threshold from b)', 'te')} as test_f1, {_auc('p_a', 'te')} as test_auc,
      threshold as best_threshold, 27 as n_features from b""",
}
_ROUNDED = """select round(train_f1, 9) as train_f1, round(train_auc, 9) as train_auc,
  round(test_f1, 9) as test_f1, round(test_auc, 9) as test_auc, round(best_threshold, 9) as best_threshold,
  n_features from m"""
_WEIGHTS = {
    f"f_{c}": f"select f1 from ({_best(_sweep(ENSEMBLE, c))})" for c in ("p_a", "p_b", "p_c")
} | {
    "w": """select a.f1 / (a.f1 + b.f1 + c.f1) as p_a, b.f1 / (a.f1 + b.f1 + c.f1) as p_b,
      c.f1 / (a.f1 + b.f1 + c.f1) as p_c from f_p_a a, f_p_b b, f_p_c c"""
}

ORACLES = {
    "mp01": over(
        "claim",
        f"""select case when {HOLD} then 'test' else 'train' end as part, count(*) as n,
          round(avg(subrogation), 9) as rate, max(claim_date) as latest from claim group by 1""",
    ),
    "mp02": over(
        "wide",
        f"""select claim_number, {', '.join(f'round(coalesce(x_{c}.te, g), 9) as {c}_te' for c in _TE)}
        from cats {' '.join(f'left join (select {c} as k, te from e_{c}) x_{c} on cats.{c} = x_{c}.k' for c in _TE)},
          (select avg(subrogation) as g from tr)""",
        cats=_CATS,
        tr=f"select * from cats where not {HOLD}",
        **{f"e_{c}": _te(c) for c in _TE},
    ),
    "mp03": over(
        "wide",
        f"""select claim_number, colour.code as vehicle_color, coalesce(ch.code, 2) as channel
        from (select * from wide where {HOLD}) h
        join (select vehicle_color, dense_rank() over (order by vehicle_color) - 1 as code
              from (select distinct vehicle_color from wide)) colour using (vehicle_color)
        left join (select channel, dense_rank() over (order by channel) - 1 as code
              from (select distinct channel from wide where not {HOLD} and channel <> 'Phone')) ch
          on ch.channel = h.channel""",
    ),
    "mp04": over(
        "scored",
        """select claim_number, y, cast((row_number() over (partition by y
            order by left(md5('42:' || claim_number), 15), claim_number) - 1) % 5 as integer) as fold
        from scored""",
    ),
    "mp05": over(
        "claim",
        """select claim_number, case when left(md5('42:' || claim_number), 8) < '33333333' then 'test' else 'train' end as part
        from claim""",
    ),
    "mp07": over(
        "scored",
        """select claim_number, model, round(avg(p + (claim_number % (fold + 7)) / 100.0::double), 9) as p
        from (select claim_number, unnest(['p_a', 'p_b', 'p_c']) as model, unnest([p_a, p_b, p_c]) as p from scored),
          range(0, 5) r(fold)
        group by 1, 2""",
    ),
    "ml07": over(
        "scored",
        """select claim_number, round(w.p_a * s.p_a + w.p_b * s.p_b + w.p_c * s.p_c, 9) as weighted,
          round((s.p_a + s.p_b + s.p_c) / 3, 9) as simple from scored s, w""",
        **_WEIGHTS,
    ),
    "ml07_weights": over(
        "scored", "select round(p_a, 9) as p_a, round(p_b, 9) as p_b, round(p_c, 9) as p_c from w", **_WEIGHTS
    ),
    "ml08": over("scored", f"select round(threshold, 9) as threshold, round(f1, 9) as f1 from ({_best(_sweep(ENSEMBLE))})"),
    "ml09": over(
        "scored",
        """select class, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1, support from (
          select '1' as class, tp / (tp + fp) as precision, tp / (tp + fn) as recall,
            2 * tp / (2 * tp + fp + fn) as f1, cast(tp + fn as bigint) as support from k
          union all select '0', tn / (tn + fn), tn / (tn + fp), 2 * tn / (2 * tn + fn + fp), cast(tn + fp as bigint) from k
          union all select 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn),
            (tp + tn) / (tp + tn + fp + fn), cast(tp + tn + fp + fn as bigint) from k
          union all select 'macro avg', (tp / (tp + fp) + tn / (tn + fn)) / 2, (tp / (tp + fn) + tn / (tn + fp)) / 2,
            (2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fn + fp)) / 2, cast(tp + tn + fp + fn as bigint) from k
          union all select 'weighted avg',
            (tp / (tp + fp) * (tp + fn) + tn / (tn + fn) * (tn + fp)) / (tp + tn + fp + fn),
            (tp + tn) / (tp + tn + fp + fn),
            (2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fn + fp) * (tn + fp)) / (tp + tn + fp + fn),
            cast(tp + tn + fp + fn as bigint) from k)""",
        k="""select cast(count(*) filter (where p_a >= 0.4::double and y = 1) as double) as tp,
          cast(count(*) filter (where p_a >= 0.4::double and y = 0) as double) as fp,
          cast(count(*) filter (where p_a < 0.4::double and y = 1) as double) as fn,
          cast(count(*) filter (where p_a < 0.4::double and y = 0) as double) as tn from scored""",
    ),
    "ml10": over(
        "scored",
        "\nunion all\n".join(
            f"select '{c}' as model, round({_auc(c, 'scored')}, 9) as auc" for c in ("p_a", "p_b", "p_c")
        ),
    ),
    "ml11": over(
        "scored",
        """select round(avg(e * e), 2) as mse,
          round(1 - sum(e * e) / sum((x - mean) ** 2), 9) as r2, count(*) as n
        from (select claim_est_payout as x, claim_est_payout - (60000 - liab_prct * 100) as e,
                (select avg(claim_est_payout) from scored) as mean from scored)""",
    ),
    "ml13": over(
        "scored",
        """select claim_number, round(p_a, 9) as subrogation_proba,
          case when p_a >= threshold then 1 else 0 end as subrogation_pred from te, b""",
        **_METRICS,
    ),
    "ml13_rate": over(
        "scored",
        "select round(avg(case when p_a >= threshold then 1 else 0 end), 9) as positive_rate from te, b",
        **_METRICS,
    ),
    "ml14": over("scored", _ROUNDED, **_METRICS),
    # What a saved model must give: every claim of the held month, with the score of the model in memory.
    "snk06": over("claim", f"select claim_number, true as same, true as within, true as varied from claim where {HOLD}"),
    "snk04": over("scored", _ROUNDED, **_METRICS),
    "snk05": over(
        "scored",
        """select unnest(['Claim model execution report', 'Model performance:',
          '- Training F1 score: ' || format('{:.4f}', train_f1), '- Training AUC: ' || format('{:.4f}', train_auc),
          '- Test F1 score: ' || format('{:.4f}', test_f1), '- Test AUC: ' || format('{:.4f}', test_auc),
          '- Best threshold: ' || format('{:.3f}', best_threshold), '- Features used: ' || n_features]) as value
        from m""",
        **_METRICS,
    ),
}
ORACLES["mp03_all"] = over(
    "wide",
    f"""select claim_number, colour.code as vehicle_color,
      coalesce(ch.code, (select count(distinct channel) from wide where not {HOLD})) as channel
    from (select claim_number, vehicle_color, case when claim_number % 11 = 0 then null
            when claim_number % 13 = 0 then lower(channel) else channel end as channel from wide) h
    join (select vehicle_color, dense_rank() over (order by vehicle_color) - 1 as code
          from (select distinct vehicle_color from wide)) colour using (vehicle_color)
    left join (select channel, dense_rank() over (order by channel) - 1 as code
          from (select distinct channel from wide where not {HOLD})) ch on ch.channel = h.channel""",
)
ORACLES["snk05_lines"] = over(
    "scored",
    """select cast(unnest(range(11)) as integer) as line_number, unnest([repeat('=', 45), 'Claim model execution report',
      repeat('=', 45), 'Model performance:',
      '- Training F1 score: ' || format('{:.4f}', train_f1), '- Training AUC: ' || format('{:.4f}', train_auc),
      '- Test F1 score: ' || format('{:.4f}', test_f1), '- Test AUC: ' || format('{:.4f}', test_auc),
      '- Best threshold: ' || format('{:.3f}', best_threshold), '- Features used: ' || n_features,
      repeat('=', 45)]) as value
    from m""",
    **_METRICS,
)
ORACLES |= {
    f"ml08_{n}": over("scored", f"select step, tp, fp, fn, round(f1, 9) as f1 from ({_sweep(g)})")
    for n, g in (("ensemble", ENSEMBLE), ("search", SEARCH), ("single", SINGLE))
}

# --- triage ---
_ROWS = {
    "t0": """select claim_number, floor(least(greatest(p_a, 0), 1) * 100 + 0.5) / 100 as prob,
      claim_est_payout as amount,
      cast(case when claim_number % 13 = 0 then 0 else 1000 + claim_number % 37 * 1500 end as double) as cost,
      case when liab_prct < 20 then 'clear' when liab_prct < 60 then 'medium' else 'unclear' end as liability,
      case claim_number % 3 when 0 then 'urgent' when 1 then 'normal' else 'loose' end as timing
      from scored where claim_number % 50 <> 0""",
    "t1": """select *, case when prob >= 0.8 then 'A' when prob >= 0.6 then 'B' when prob >= 0.4 then 'C'
        when prob >= 0.2 then 'D' else 'E' end as band, prob * amount as expected,
      case when cost > 0 then prob * amount / cost else 'infinity'::double end as roi from t0""",
    "t": """select *, case band when 'A' then 3 when 'B' then 2 when 'C' then 1 else 0 end
      + case when roi >= 2 then 2 when roi >= 1 then 1 else 0 end
      + case when liability = 'clear' then 1 else 0 end + case when timing = 'urgent' then 1 else 0 end as score
      from t1""",
}
ORACLES |= {
    "tri01": over(
        "scored",
        """select claim_number, prob, band,
          case band when 'A' then 'Top priority' when 'B' then 'Focus' when 'C' then 'Contested'
            when 'D' then 'Low chance' else 'Do not pursue' end as band_label,
          case band
            when 'A' then 'Very high success likelihood. Fast-track subrogation with full resources.'
            when 'B' then 'Good success likelihood. Recommended to pursue with strong follow-up.'
            when 'C' then 'Moderate success likelihood. Pursue selectively based on ROI and strategy.'
            when 'D' then 'Low success likelihood. Only pursue in special situations.'
            else 'Very low success likelihood. Generally not recommended for subrogation.' end as band_summary
        from t""",
        **_ROWS,
    ),
    "tri02": over(
        "scored", "select claim_number, expected, roi from t", **_ROWS
    ),
    "tri03": over(
        "scored",
        """select claim_number, score,
          case when score >= 5 then 'High' when score >= 3 then 'Medium' else 'Low' end as priority,
          case when score >= 5 then 'Immediately open a subrogation file. Assign to an experienced handler, '
              || 'start negotiations, and prepare litigation as a back-up.'
            when score >= 3 then 'Pursue subrogation through standard workflow. Monitor progress and escalate '
              || 'if cooperation breaks down or new evidence emerges.'
            else 'Limit effort to light-touch actions (demand letters, simple negotiation). Only escalate in '
              || 'exceptional circumstances.' end as action
        from t""",
        **_ROWS,
    ),
    "tri04": over(
        "scored",
        """select claim_number, 'Model probability is ' || format('{:.2f}', prob) || ', placing the claim in band '
          || band || '. | '
          || case when expected > cost then 'Expected recovery is higher than estimated pursuit cost.'
             else 'Expected recovery does not clearly exceed estimated pursuit cost.' end || ' | '
          || case liability when 'clear' then 'Liability is assessed as clear against the counterparty.'
             when 'medium' then 'Liability is mixed, which may reduce negotiating leverage.'
             else 'Liability is unclear, creating additional litigation risk.' end || ' | '
          || case timing when 'urgent' then
               'Limitation is urgent, so delays increase the risk of losing the opportunity.'
             when 'normal' then 'Limitation is standard with normal time pressure.'
             else 'Limitation is comfortable, allowing more flexibility in triage.' end as reasons
        from t""",
        **_ROWS,
    ),
    "tri06": over(
        "scored",
        """select claim_number, format('{:,}', cast(round(expected) as bigint)) as expected_shown,
          format('{:,}', cast(cost as bigint)) as cost_shown,
          case when isinf(roi) then '∞' else format('{:.2f}', roi) || '×' end as roi_shown from t""",
        **_ROWS,
    ),
}
