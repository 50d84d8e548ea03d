"""Features on missing values, on other partitionings, and with fixed marks."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from verify import compare

from oracles import features as oracle
from salvor.operators import features as E
from salvor.operators import quality as Q
from salvor.operators.prep import hold_out_split
from salvor.sources.star import HOLD_OUT

N = None
ROWS = {
    "claim_number": list(range(1, 11)),
    "claim_date": [datetime.datetime(2016, 1, 1 + i) for i in range(9)] + [None],
    "year_of_born": [1980, N, 1990, N, 1985, 1975, N, 1995, 1988, N],
    "age_of_DL": [20, 25, N, 22, N, 18, 23, N, 21, 24],
    "vehicle_mileage": [50000, N, 75000, N, 100000, N, 25000, N, 60000, 80000],
    "annual_income": [50000, N, 75000, N, N, 60000, N, 85000, N, 70000],
    "vehicle_price": [20000, N, 30000, N, 25000, N, 35000, N, 28000, N],
    "vehicle_weight": [3000, N, 3500, N, N, 3200, N, 3800, N, 3400],
    "claim_est_payout": [5000, N, 7500, N, N, 6000, N, 8500, N, 7000],
    "liab_prct": [30, N, 50, N, 25, N, 75, N, 40, N],
    "witness_present_ind": ["Y", "N", N, "Y", "N", N, "yes", "N", N, "Y"],
    "policy_report_filed_ind": [1, 0, N, 1, N, 0, 1, N, 0, 1],
    "in_network_bodyshop": ["yes", "no", N, "YES", N, "no", "y", N, "no", "yes"],
    "past_num_of_claims": [0, N, 1, N, 2, N, 0, N, 1, N],
    "high_education_ind": [1, 0, N, 1, N, 0, 1, N, 0, 1],
    "address_change_ind": [0, 1, N, 0, N, 1, 0, N, 1, 0],
    "safety_rating": [70, N, 80, N, 75, N, 85, N, 90, 20],
    "accident_type": ["single_car"] * 4 + ["multi_vehicle_unclear"] * 3 + ["multi_vehicle_clear", N, N],
    "accident_site": ["Highway"] * 8 + ["Parking Area", N],
    "gender": ["M"] * 9 + [N],
    "vehicle_category": ["Compact"] * 9 + [N],
    "channel": ["Broker"] * 9 + [N],
    "zip_code": ["10001", "501", "0", "x", N, "123456", "00012", "99", "85001", "85002"],
    "subrogation": [0, 1] * 5,
}
KINDS = {"claim_number": "long", "claim_date": "timestamp_ntz", "subrogation": "int"} | {
    c: "string" for c in ("witness_present_ind in_network_bodyshop accident_type accident_site gender "
                          "vehicle_category channel zip_code").split()
}


@pytest.fixture(scope="module")
def sparse(spark):
    schema = ", ".join(f"`{c}` {KINDS.get(c, 'double')}" for c in ROWS)
    rows = [
        tuple(float(v) if v is not None and KINDS.get(c) is None else v for c, v in zip(ROWS, row))
        for row in zip(*ROWS.values())
    ]
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("group", sorted(oracle.GROUPS))
def test_missing_values(sparse, duck, group):
    from salvor.entries.features import _names, compared

    pdf = pd.DataFrame(ROWS)
    pdf["claim_date"] = pd.to_datetime(pdf["claim_date"])
    duck.register("sparse_rows", pdf)
    ctes = oracle.steps(frame="select * from sparse_rows", trained_on="select * from sparse_rows")
    sql = "with " + ", ".join(f"{n} as ({body})" for n, body in ctes.items())
    sql += f" select claim_number, {oracle.columns(oracle.GROUPS[group])} from f"
    f = E.transform(sparse, E.fit(sparse))
    assert compare(compared(f.select("claim_number", *_names(group)), "claim_number"), duck, sql) is None


def test_column_count_and_names(sparse):
    f = E.transform(sparse, E.fit(sparse))
    engineered = [c for c in E.ENGINEERED if c not in ("gender", "vehicle_category", "channel")]
    assert len(engineered) == 141
    assert set(E.SELECTED) <= set(f.columns) and len(E.SELECTED) == 94
    assert not any(" " in c or c.startswith("_") for c in f.columns)
    assert f.count() == sparse.count()


def test_test_frame_uses_training_statistics(star):
    train, test = hold_out_split(star.wide, *HOLD_OUT)
    art = E.fit(train)
    median = art.first()["mileage_median"]
    held = E.transform(test.withColumn("vehicle_mileage", F.lit(None).cast("double")), art)
    assert [r[0] for r in held.select("vehicle_mileage").distinct().collect()] == [median]


def test_marks_can_be_fixed(star):
    art = E.fit(star.wide)
    marks = E.high_marks(star.wide, art)
    some = star.wide.filter("vehicle_price > 25000")
    own = E.transform(some, art).filter("is_expensive_car = 1").count()
    fixed = E.transform(some, art, marks).filter("is_expensive_car = 1").count()
    assert own < fixed == E.transform(star.wide, art).filter("is_expensive_car = 1").count()


def test_same_features_on_other_partitioning(spark, star):
    def total():
        f = E.transform(star.wide, E.fit(star.wide)).select(*E.SELECTED)
        return f.agg(F.sum(F.xxhash64(*f.columns) % 1_000_003)).first()[0]

    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = total()
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert total() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rules_find_bad_rows(star):
    f = E.transform(star.wide, E.fit(star.wide)).withColumn("is_weekend", F.lit(3))
    bad = {r["rule"]: r["violations"] for r in Q.violations(f, Q.feature_rules(f, E.SELECTED)).collect()}
    assert bad.pop("binary_is_weekend") == f.count() and not any(bad.values())
