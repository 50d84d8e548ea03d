"""The comparison of frames: what it shuffles, and which values it takes as equal."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salvor.operators import normalize as N


def frame(spark, rows=300):
    n = F.col("id")
    return spark.range(rows).select((n % 2).alias("subrogation"), n.cast("string").alias("a"), (n % 7).alias("b"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_frames_are_compared_without_a_shuffle_of_their_rows(spark):
    got = N.compare_frames(frame(spark), frame(spark).repartition(3))
    assert "hashpartitioning(a#" not in plan(got) and "keys=[a#" not in plan(got)
    assert tuple(got.first()) == (1, 300, 300, 0, 0)


def test_rows_of_slots_that_differ_are_compared_whole(spark):
    left = frame(spark).unionByName(frame(spark, 2))
    right = frame(spark).withColumn("a", F.when(F.col("a") == "9", "nine").otherwise(F.col("a"))).withColumn("c", F.lit(1))
    got = N.compare_frames(left, right)
    assert tuple(got.first()) == (0, 302, 300, 3, 1)
    assert tuple(N.compare_frames(left.limit(0), right).first()) == (0, 0, 300, 0, 300)


EQUAL = [
    ("double", 0.0, -0.0),
    ("double", float("nan"), float("nan")),
    ("string", None, None),
]
OTHER = [
    ("string", None, ""),
    ("string", "-", None),
    ("double", 0.1, 0.1 + 2**-56),
    ("decimal(9,2)", Decimal("1.10"), Decimal("1.11")),
    ("timestamp", datetime(2000, 1, 1, 0, 0, 0, 1), datetime(2000, 1, 1)),
    ("timestamp_ntz", datetime(2000, 1, 1, 0, 0, 0, 1), datetime(2000, 1, 1)),
    ("binary", b"\xff", b"\xfe"),
    ("array<int>", [1], [2]),
]


@pytest.mark.parametrize(("kind", "one", "two"), EQUAL + OTHER)
def test_values_are_equal_as_in_a_grouping(spark, kind, one, two):
    schema = f"subrogation int, v {kind}"
    got = N.compare_frames(spark.createDataFrame([(1, one)], schema), spark.createDataFrame([(1, two)], schema)).first()
    alone = int((kind, one, two) in OTHER)
    assert tuple(got) == (1, 1, 1, alone, alone)


def test_cells_do_not_run_into_each_other(spark):
    schema = "subrogation int, u string, v string"
    pairs = [(("a", None), (None, "a")), (("a1:", "b"), ("a", "1:b")), (("", "ab"), ("ab", ""))]
    for one, two in pairs:
        a, b = (spark.createDataFrame([(1, *x)], schema) for x in (one, two))
        assert tuple(N.compare_frames(a, b).first()) == (1, 1, 1, 1, 1)


def test_sides_of_two_widths_have_equal_rows(spark):
    a, b = spark.createDataFrame([(1, 5)], "subrogation int, v int"), spark.createDataFrame([(1, 5)], "subrogation long, v long")
    assert tuple(N.compare_frames(a, b).first()) == (1, 1, 1, 0, 0)
