"""Plan shapes that matter at scale."""

import re

import pytest

import __spark_entry__ as E
from conftest import FOLDER

QUERIES = E.queries()
LAZY = [n for n in QUERIES if re.match(r"(acl|acc|veh|drv|pol|ins|flt|jn|agg|win|srt|scl|nrm(0|10|11))", n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_product_and_no_python(name, spark):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"(ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas)", text)


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["acl06"](spark, FOLDER))
    read = set(re.findall(r"l_\w+", "".join(re.findall(r"ReadSchema: struct<([^>]*)>", text))))
    assert "l_returnflag" not in read and "l_tax" not in read and "l_discount" not in read


def test_hold_out_month_prunes_partitions_and_row_groups(spark, star, tmp_path):
    from salvor.entries.basics import hold_out
    from salvor.operators.prep import in_month
    from salvor.sources import files

    path = str(tmp_path / "claims")
    files.write_stage(star.claim, path)
    text = plan(files.read_stage(spark, path).filter(in_month("claim_date", 2000, 9)))
    assert "GreaterThanOrEqual(claim_date" in text and "LessThan(claim_date" in text
    assert hold_out(star).count() > 0
    pruned = plan(QUERIES["snk03"](spark, FOLDER))
    assert re.search(r"PartitionFilters: \[[^\]]*claim_month", pruned)


def test_raw_rows_are_never_in_one_partition(spark):
    """Single-partition exchanges only ever carry aggregates."""
    for name in ("acl04", "drv03", "agg08", "ml10", "nrm03_vehicle"):
        lines = plan(QUERIES[name](spark, FOLDER)).split("== Initial Plan ==")[-1].splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = " ".join(lines[i + 1 : i + 4])
                assert "Aggregate" in below, (name, below)
