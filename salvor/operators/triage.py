"""Claim triage: scores to band, expected recovery, return on cost, priority, reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.scalars import clip, display_money, num

C = F.col

# Lower bound, band, label, summary; the last band takes everything below.
BANDS = (
    (0.8, "A", "Top priority", "Very high success likelihood. Fast-track subrogation with full resources."),
    (0.6, "B", "Focus", "Good success likelihood. Recommended to pursue with strong follow-up."),
    (0.4, "C", "Contested", "Moderate success likelihood. Pursue selectively based on ROI and strategy."),
    (0.2, "D", "Low chance", "Low success likelihood. Only pursue in special situations."),
    (0.0, "E", "Do not pursue", "Very low success likelihood. Generally not recommended for subrogation."),
)
# Lowest score, priority, advice.
PRIORITIES = (
    (
        5,
        "High",
        "Immediately open a subrogation file. Assign to an experienced handler, start negotiations, "
        "and prepare litigation as a back-up.",
    ),
    (
        3,
        "Medium",
        "Pursue subrogation through standard workflow. Monitor progress and escalate if cooperation "
        "breaks down or new evidence emerges.",
    ),
    (
        0,
        "Low",
        "Limit effort to light-touch actions (demand letters, simple negotiation). Only escalate in "
        "exceptional circumstances.",
    ),
)
# Reason texts by assessment; None is any other value.
LIABILITY_REASONS = {
    "clear": "Liability is assessed as clear against the counterparty.",
    "medium": "Liability is mixed, which may reduce negotiating leverage.",
    None: "Liability is unclear, creating additional litigation risk.",
}
TIMING_REASONS = {
    "urgent": "Limitation is urgent, so delays increase the risk of losing the opportunity.",
    "normal": "Limitation is standard with normal time pressure.",
    None: "Limitation is comfortable, allowing more flexibility in triage.",
}
WORTH_IT = "Expected recovery is higher than estimated pursuit cost."
NOT_WORTH_IT = "Expected recovery does not clearly exceed estimated pursuit cost."


def probability(raw: Column) -> Column:
    """Not a number -> 0, clamped to [0, 1], two decimals (the band uses the rounded value)."""
    return F.floor(clip(num(raw, 0), 0.0, 1.0) * 100 + 0.5) / 100


def _by_bound(value: Column, table, field: int) -> Column:
    *upper, last = table
    chain = None
    for row in upper:
        hit = value >= row[0]
        chain = F.when(hit, row[field]) if chain is None else chain.when(hit, row[field])
    return chain.otherwise(last[field])


def _by_value(value: Column, table: dict) -> Column:
    chain = None
    for key, text in table.items():
        if key is not None:
            chain = F.when(value == key, text) if chain is None else chain.when(value == key, text)
    return chain.otherwise(table[None])


def banded(df: DataFrame, prob: str = "prob") -> DataFrame:
    p = probability(C(prob))
    return df.withColumn(prob, p).withColumns(
        {
            "band": _by_bound(C(prob), BANDS, 1),
            "band_label": _by_bound(C(prob), BANDS, 2),
            "band_summary": _by_bound(C(prob), BANDS, 3),
        }
    )


def recovery(df: DataFrame) -> DataFrame:
    """Expected recovery and return on cost (infinite without cost)."""
    expected = C("prob") * C("amount")
    roi = F.when(C("cost") > 0, expected / C("cost")).otherwise(F.lit(float("inf")))
    return df.withColumns({"expected": expected, "roi": roi})


def prioritised(df: DataFrame) -> DataFrame:
    points = (
        F.when(C("band") == "A", 3).when(C("band") == "B", 2).when(C("band") == "C", 1).otherwise(0)
        + F.when(C("roi") >= 2, 2).when(C("roi") >= 1, 1).otherwise(0)
        + F.when(C("liability") == "clear", 1).otherwise(0)
        + F.when(C("timing") == "urgent", 1).otherwise(0)
    )
    return df.withColumn("score", points).withColumns(
        {"priority": _by_bound(C("score"), PRIORITIES, 1), "action": _by_bound(C("score"), PRIORITIES, 2)}
    )


def reasons() -> Column:
    return F.array(
        F.format_string("Model probability is %.2f, placing the claim in band %s.", C("prob"), C("band")),
        F.when(C("expected") > C("cost"), WORTH_IT).otherwise(NOT_WORTH_IT),
        _by_value(C("liability"), LIABILITY_REASONS),
        _by_value(C("timing"), TIMING_REASONS),
    )


def triage(df: DataFrame) -> DataFrame:
    """All triage columns for rows with ``prob, amount, cost, liability, timing``.

    Rows whose probability, amount or cost is not a number give no result.
    """
    numbers = {c: num(c) for c in ("prob", "amount", "cost")}
    known = df.withColumns(numbers).dropna(subset=list(numbers))
    rated = prioritised(recovery(banded(known)))
    infinite = C("roi") == F.lit(float("inf"))
    return rated.withColumns(
        {
            "reasons": reasons(),
            "expected_shown": display_money("expected"),
            "cost_shown": display_money("cost"),
            "roi_shown": F.when(infinite, "∞").otherwise(F.concat(F.format_string("%.2f", C("roi")), F.lit("×"))),
        }
    )
