"""The claims of rows that repeat or collide, and what their shuffles carry."""

import re
from datetime import datetime

from salvor import schema as S
from salvor.entries.basics import orphan_claims
from salvor.sources.star import Star


class Rows(Star):
    """A star over given raw tables."""

    def __init__(self, spark, tables):
        super().__init__(spark, "")
        self.tables = tables

    def raw(self, table):
        return self.tables[table]


def star_of(spark, lines, vehicles=(1, 2)):
    made = {
        "lineitem": spark.createDataFrame(
            lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
            "l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": spark.createDataFrame([(k, 5) for k in sorted({r[0] for r in lines})], "o_orderkey long, o_custkey long"),
        "customer": spark.createDataFrame([(5, 3)], "c_custkey long, c_nationkey long"),
        "supplier": spark.createDataFrame([(7,)], "s_suppkey long"),
        "part": spark.createDataFrame([(k, 4, "B") for k in vehicles], "p_partkey long, p_size int, p_brand string"),
    }
    return Rows(spark, made)


DAY = datetime(2000, 9, 4)
LINES = [
    (1, 11, 2, 7, 1.0, 10.0, 0.01, "R", "F", DAY),  # the claim number of order 2, line 1
    (2, 1, 1, 7, 30.0, 20.0, 0.09, "N", "O", DAY),
    (2, 1, 2, 7, 30.0, 20.0, 0.01, "R", "F", DAY),
    (3, None, 1, 7, None, 5.0, None, None, None, None),
]


def test_first_of_colliding_numbers_and_missing_values(spark):
    s = star_of(spark, LINES)
    got = {r["claim_number"]: r for r in s.wide.collect()}
    assert sorted(got, key=str) == [21, None]
    one, none = got[21], got[None]
    assert (one["vehicle_key"], one["claim_est_payout"], one["channel"], one["witness_present_ind"]) == (1, 20.0, "Phone", "N")
    assert (one["accident_key"], one["liab_prct"], one["in_network_bodyshop"]) == (3, 20.0, "no")
    assert (none["accident_key"], none["liab_prct"], none["claim_date"], none["witness_present_ind"]) == (4, None, None, "N")
    assert s.line_claims.count() == 4 and s.claim.count() == 2
    assert s.line_claims.select("_seen.*").columns == ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]


def test_no_shuffle_of_the_wide_claims_carries_derived_text(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = star_of(spark, LINES).wide._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    windows = [i for i, line in enumerate(text.splitlines()) if "Exchange hashpartitioning" in line]
    assert windows
    for i in windows:
        below = " ".join(text.splitlines()[i + 1 : i + 2])
        assert not re.search(r"AS (claim_day_of_week|channel|zip_code|witness_present_ind|in_network_bodyshop|_seen)#", below), below


def test_orphans_of_every_dimension(spark):
    lines = [(k, 1, v, d, 1.0, 1.0, 0.0, "R", "F", DAY) for k, v, d in ((11, 1, 7), (2, 9, 7), (3, 1, 8), (4, 50, 7), (5, 1, 7))]
    found = orphan_claims(star_of(spark, lines, (1, 50)))
    assert {(r["claim_number"], r["dimension"]) for r in found.collect()} == {
        (111, "accident"), (21, "vehicle"), (31, "driver"), (41, "vehicle")}
    assert set(found.columns) == {"claim_number", *S.DIMENSION_KEYS.values(), "dimension"}


def test_lines_of_one_order_are_picked_without_a_shuffle_by_number(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = star_of(spark, LINES).claim._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"Window \[row_number.*\[l_orderkey#\d+L, claim_number#\d+L\]", text)
    assert not re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L, claim_number", text)


def test_numbers_shared_within_and_between_orders(spark):
    lines = [
        (1, 12, 4, 7, 1.0, 10.0, 0.0, "R", "F", DAY), (2, 2, 3, 7, 1.0, 11.0, 0.0, "R", "F", DAY),  # 22 twice
        (5, 3, 2, 7, 1.0, 12.0, 0.0, "R", "F", DAY), (5, 3, 1, 7, 1.0, 13.0, 0.0, "R", "F", DAY),  # 53 twice
        (7, -2, 1, 7, 1.0, 14.0, 0.0, "R", "F", DAY), (6, 8, 2, 7, 1.0, 15.0, 0.0, "R", "F", DAY),  # 68 twice
        (None, 4, 1, 7, 1.0, 16.0, 0.0, "R", "F", DAY), (9, 0, 1, 7, 1.0, 17.0, 0.0, "R", "F", DAY),
    ]
    s = star_of(spark, [line for line in lines if line[0]])
    s.tables["lineitem"] = s.tables["lineitem"].unionByName(spark.createDataFrame([lines[6]], s.tables["lineitem"].schema))
    s.tables["orders"] = s.tables["orders"].unionByName(s.tables["orders"].filter("o_orderkey = 9"))  # an order twice
    got = {r["claim_number"]: r["claim_est_payout"] for r in s.claim.collect()}
    assert got == {22: 11.0, 53: 13.0, 68: 14.0, 90: 17.0} and s.claim.count() == 4


def test_shuffles_of_the_wide_claims_carry_stored_values_of_dimensions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = star_of(spark, LINES).wide._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    below = " ".join(lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert not re.search(r"AS (annual_income|living_status|gender|safety_rating|vehicle_category|vehicle_mileage)#", below), below


def test_claims_without_a_row_in_a_dimension_and_with_two(spark):
    lines = [(k, 1, v, d, 1.0, 1.0, 0.0, "R", "F", DAY) for k, v, d in ((1, 1, 7), (2, 9, 8), (3, None, None))]
    s = star_of(spark, lines)
    s.tables["part"] = s.tables["part"].unionByName(spark.createDataFrame([(1, 5, None), (None, 6, "C")], s.tables["part"].schema))
    got = sorted(
        (r["claim_number"], r["gender"], r["vehicle_weight"], r["vehicle_category"], r["living_status"], r["annual_income"])
        for r in s.wide.collect())
    assert got == [(11, "M", 2700.0, "Medium", "Own", 32500.0), (11, "M", 2750.0, "Large", "Own", 32500.0),
                   (21, None, None, None, "Own", 32500.0), (31, None, None, None, "Own", 32500.0)]
    assert s.wide.schema["year_of_born"].dataType.simpleString() == "int"
