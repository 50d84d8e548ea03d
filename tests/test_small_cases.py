"""Small tables whose answers can be read off."""

import pytest
from pyspark.sql import functions as F

from salvor.entries.basics import QUERIES
from salvor.functions import scalars as X
from salvor.operators import normalize as N
from salvor.operators import quality as Q
from salvor.operators import triage as T
from salvor.plans import accidents, drivers, policyholders

# The accident table that ships with published results.
ACCIDENTS = [
    (1, "Parking Area", "multi_vehicle_clear"),
    (2, "Unknown", "multi_vehicle_unclear"),
    (3, "Highway/Intersection", "multi_vehicle_clear"),
    (4, "Unknown", "single_car"),
    (5, "Local", "single_car"),
    (6, "Highway/Intersection", "single_car"),
    (7, "Parking Area", "multi_vehicle_unclear"),
    (8, "Local", "multi_vehicle_clear"),
    (9, "Parking Area", "single_car"),
    (10, "Local", "multi_vehicle_unclear"),
    (11, "Highway/Intersection", "multi_vehicle_unclear"),
    (12, "Unknown", "multi_vehicle_clear"),
]


@pytest.fixture(scope="module")
def accident(spark):
    return spark.createDataFrame(ACCIDENTS, "accident_key long, accident_site string, accident_type string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_accident_results(accident):
    assert rows(accidents.totals(accident)) == [(12, 4, 3)]
    assert {r[1:] for r in rows(accidents.by_value(accident, "accident_type"))} == {(4, 33.33)}
    assert {r[1:] for r in rows(accidents.by_value(accident, "accident_site"))} == {(3, 25.0)}
    assert rows(accidents.multi_vehicle(accident)) == [
        ("multi_vehicle_clear", 4, 33.33),
        ("multi_vehicle_unclear", 4, 33.33),
    ]
    assert len(rows(accidents.site_by_type(accident))) == 12


def test_literal_witness_spelling_finds_nothing_in_y_n_data(spark, accident):
    claim = spark.createDataFrame(
        [(1, "Y", 1, 1), (2, "N", 1, 1), (3, "Y", 0, 4), (4, None, 1, 4)],
        "claim_number long, witness_present_ind string, policy_report_filed_ind int, accident_key long",
    )
    assert rows(accidents.high_potential(accident, claim, "Yes")) == []
    assert rows(accidents.high_potential(accident, claim)) == [("multi_vehicle_clear", "Parking Area", 1, 25.0)]
    view = {r["accident_key"]: r for r in accidents.priority_view(accident, claim).collect()}
    assert view[1]["subrogation_priority"] == "High" and view[4]["subrogation_priority"] == "Low"
    literal = accidents.priority_view(accident, claim, "Yes").collect()
    assert {r["subrogation_priority"] for r in literal} == {"Medium", "Low"}


def test_text_flags(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("yes",), (" No ",), ("1",), ("0",), ("?",), (None,)], "w string")
    assert [r[0] for r in df.select(X.to_bool("w")).collect()] == [1, 0, 1, 0, 1, 0, None, None]


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("100.5",), ("200.3",), ("invalid",), ("300.0",), ("NaN",)], "v string")
    assert [r[0] for r in df.select(X.num("v")).collect()] == [100.5, 200.3, None, 300.0, None]
    assert rows(Q.uncastable(df, ["v"])) == [("v", "invalid", 1)]
    keys = spark.createDataFrame([("5",), ("5.0",), ("x",), ("9007199254740993",)], "k string")
    assert [r[0] for r in keys.select(X.whole("k")).collect()] == [5, 5, None, 9007199254740993]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(5.0,), (None,), (-1.0,)], "x double")
    assert [r[0] for r in df.select(X.clip("x", 0.0, 3.0)).collect()] == [3.0, None, 0.0]


def test_income_levels(spark):
    claim = spark.createDataFrame(
        [(1, 1, 1000.0), (2, 2, 1500.0), (3, 3, 1200.0), (4, 4, 2000.0)],
        "claim_number long, policyholder_key long, claim_est_payout double",
    )
    holder = spark.createDataFrame(
        [(1, 30000.0), (2, 50000.0), (3, 30000.0), (4, 70000.0)], "policyholder_key long, annual_income double"
    )
    assert rows(policyholders.run(spark, "pol02", claim, holder))[0] == (30000.0, 2, 1100.0)


def test_missing_holder_group_comes_first(spark):
    claim = spark.createDataFrame(
        [(1, 1, 10.0), (2, 9, None), (3, 9, None)], "claim_number long, policyholder_key long, claim_est_payout double"
    )
    holder = spark.createDataFrame([(1, 1)], "policyholder_key long, high_education_ind int")
    assert rows(policyholders.run(spark, "pol01", claim, holder)) == [(None, None, 2), (1, 10.0, 1)]


def test_flat_correlation_is_missing(spark):
    from salvor.functions.stats import pearson

    df = spark.createDataFrame([(0.0, 1.0, 5.0), (1.0, 2.0, 5.0), (None, 9.0, 5.0)], "y double, x double, flat double")
    r = df.agg(pearson("x", "y").alias("a"), pearson("flat", "y").alias("b")).first()
    assert r["a"] == pytest.approx(1.0) and r["b"] is None


def test_licence_groups_missing_is_late(spark):
    df = spark.createDataFrame([(17,), (18,), (25,), (26,), (40,), (41,), (None,)], "a int")
    assert [r[0] for r in df.select(drivers.licence_age_group(F.col("a"))).collect()] == [
        "Early", "Young", "Young", "Mid", "Mid", "Late", "Late",
    ]


def test_split_numbers_dimensions_in_first_seen_order(spark):
    wide = spark.createDataFrame(
        [
            (0, "7", " Local ", "b", "", ""),
            (1, "8", "", "", "M", "2"),
            (2, "7", "Local", "a", "M", "2"),
            (3, "9", "Local\t", "b", "F", "2"),
        ],
        "row_id long, claim_number string, accident_site string, accident_type string, gender string, safety_rating string",
    )
    t = N.split_wide(wide)
    assert set(t) == {"accident", "driver", "claim"}
    assert sorted(rows(t["accident"].select("accident_key", "accident_type"))) == [(1, "b"), (2, "a")]
    claims = {r["claim_number"]: (r["accident_key"], r["driver_key"]) for r in t["claim"].collect()}
    assert claims == {"7": (1, None), "8": (None, 1), "9": (1, 2)}


def test_compare_frames_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (0, None), (None, "q")], "subrogation int, v string")
    b = spark.createDataFrame([("x", 1), (None, 0), (None, 0)], "v string, subrogation int")
    assert rows(N.compare_frames(a, b)) == [(1, 3, 3, 1, 1)]


# The three preset scenarios of the triage form.
PRESETS = [
    ("high", 0.88, 90000.0, 12000.0, "clear", "urgent"),
    ("borderline", 0.48, 45000.0, 15000.0, "medium", "normal"),
    ("low", 0.18, 12000.0, 7000.0, "unclear", "loose"),
]
TRIAGE = "name string, prob double, amount double, cost double, liability string, timing string"


def test_triage_presets(spark):
    got = {r["name"]: r for r in T.triage(spark.createDataFrame(PRESETS, TRIAGE)).collect()}
    assert {n: (r["band"], r["score"], r["priority"]) for n, r in got.items()} == {
        "high": ("A", 7, "High"),
        "borderline": ("C", 2, "Low"),
        "low": ("E", 0, "Low"),
    }
    assert (got["high"]["expected_shown"], got["high"]["roi_shown"]) == ("79,200", "6.60×")
    assert got["borderline"]["reasons"] == [
        "Model probability is 0.48, placing the claim in band C.",
        "Expected recovery is higher than estimated pursuit cost.",
        "Liability is mixed, which may reduce negotiating leverage.",
        "Limitation is standard with normal time pressure.",
    ]


def test_triage_edges(spark):
    cases = [(str(p), p, 100.0, 0.0, "x", "x") for p in (0.795, 0.794, 0.6, 0.4, 0.2, 0.194, -3.0, 9.0)]
    cases.append(("no cost", 0.5, 100.0, None, "x", "x"))
    got = {r["name"]: r for r in T.triage(spark.createDataFrame(cases, TRIAGE)).collect()}
    assert "no cost" not in got
    assert [got[str(p)]["band"] for p in (0.795, 0.794, 0.6, 0.4, 0.2, 0.194, -3.0, 9.0)] == list("ABBCDEEA")
    assert got["0.6"]["roi"] == float("inf") and got["0.6"]["roi_shown"] == "∞"


def test_one_query_per_name():
    assert len(QUERIES) == len(set(QUERIES))
