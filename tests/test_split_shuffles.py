"""What the split of the wide file shuffles."""

from collections import Counter

from pyspark.sql import functions as F

from salvor.operators import normalize as N


def wide_text(spark, rows=200):
    n = F.col("id")
    text = {c: (n % (2 + i)).cast("string") for i, c in enumerate(c for cs in N.DIMENSION_COLUMNS.values() for c in cs)}
    number = F.when(n % 10 == 0, "").otherwise((n % 150).cast("string"))
    return spark.range(rows).select(n.alias("row_id"), number.alias("claim_number"), *[v.alias(c) for c, v in text.items()])


def test_small_dimensions_meet_the_claims_without_a_shuffle(spark, tmp_path):
    wide_text(spark).write.parquet(f"{tmp_path}/wide")
    claim = N.split_wide(spark.read.parquet(f"{tmp_path}/wide"))["claim"]
    text = claim._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 4
    assert claim.count() == 136


def test_first_rows_where_keys_repeat_or_are_missing(spark):
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None), (6, ""), (7, "c")]
    df = spark.createDataFrame(rows, "row_id long, claim_number string")
    got = Counter(r["row_id"] for r in N.keep_first_stored(df, "claim_number", "row_id").collect())
    assert got == Counter([1, 2, 4, 6, 7])
