"""Lookups run over every claim, with hits and misses of each kind."""

import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

import __spark_entry__ as E


@pytest.mark.parametrize("name, value", [("mp03_all", "channel"), ("jn04_left_all", "annual_income"), ("jn07_all", "encoded")])
def test_every_claim_comes_out(spark, star, name, value):
    got = E.queries()[name](spark, FOLDER)
    assert got.count() == star.claim.count()
    missed = got.filter("claim_number % 11 = 0 OR claim_number % 13 = 0").select(value).distinct().collect()
    assert len(missed) == 1 and got.select(F.count_distinct(value)).first()[0] >= 3


def test_categories_of_every_row(spark, star):
    got = {r[0] for r in E.queries()["scl14_all"](spark, FOLDER).collect()}
    assert {None, "Broker", "Phone", "Online", "broker"} <= got
    assert {r[0] for r in star.claim.select("claim_day_of_week").distinct().collect()} <= got
