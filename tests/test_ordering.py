import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salvor.operators import ordering as O


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_quantiles_with_a_hot_value_and_outliers(spark):
    rng = np.random.default_rng(3)
    values = [5.0] * 700 + [float(x) for x in rng.normal(0, 100, 800)] + [1e15, -1e15, 0.0]
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = frame(spark, [(v,) for v in values] + [(None,)], "x double")
    got = O.exact_quantiles(O.frequencies(df, "x"), "x", probabilities).first()["q"]
    assert np.allclose(got, np.quantile(values, probabilities), rtol=1e-12)


def test_quantiles_per_group(spark):
    rows = [("a", float(i)) for i in range(101)] + [("b", 7.0)] + [(None, float(i)) for i in (1, 2)]
    q = O.exact_quantiles(O.frequencies(frame(spark, rows, "g string, x double"), "x", ["g"]), "x", [0.5], by=["g"])
    assert {r["g"]: r["q"][0] for r in q.collect()} == {"a": 50.0, "b": 7.0, None: 1.5}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9, width=32), min_size=1, max_size=60), st.floats(0, 1))
def test_quantile_is_numpys(spark, values, p):
    df = frame(spark, [(v,) for v in values], "x double")
    got = O.exact_quantiles(O.frequencies(df, "x"), "x", [p]).first()["q"][0]
    assert got == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-6)


def test_percent_rank_puts_missing_last(spark):
    rows = [("m", 1.0), ("m", 1.0), ("m", 3.0), ("m", None), ("f", 2.0)]
    ranks = O.percent_ranks(frame(spark, rows, "g string, x double"), "x", ["g"])
    got = {(r["g"], r["x"]): r["p_rank"] for r in ranks.collect()}
    assert got == {("m", 1.0): 0.0, ("m", 3.0): 2 / 3, ("m", None): 1.0, ("f", 2.0): 0.0}


@pytest.mark.parametrize("parts", ["1", "7"])
def test_numbers_are_dense_on_any_partitioning(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        ids = spark.range(0, 5000, 3).withColumn("row_id", F.col("id") * 1_000)
        numbered = O.number_rows(ids, ["row_id"], O.id_cell(F.col("row_id"), 10_000), "n")
        assert numbered.filter(F.col("n") != F.col("id") / 3 + 1).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_text_numbers_follow_text_order(spark):
    words = ["b", "", "abcd", "abce", "ä", "z", "abc"]
    df = frame(spark, [(w,) for w in words], "w string")
    got = O.number_rows(O.ranged(df, ["w"], "c"), ["w"], F.col("c"), "n", start=0).orderBy("n")
    assert [r["w"] for r in got.collect()] == sorted(words, key=lambda w: w.encode())


def test_texts_of_one_prefix_have_even_cells(spark):
    df = spark.range(100_000).select(F.format_string("multi_vehicle_%06d", "id").alias("w"), "id")
    cells = O.ranged(df, ["w"], "c", parts=16)
    sizes = [r["count"] for r in cells.groupBy("c").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 100_000 / 16
    assert O.number_rows(cells, ["w"], F.col("c"), "n", start=0).filter("n <> id").count() == 0
