"""Sinks give back all that was written."""

from conftest import FOLDER

import __spark_entry__ as E


def test_stage_gives_every_month(spark, star):
    got = E.queries()["snk03_all"](spark, FOLDER)
    assert got.count() == star.claim.count()
    assert got.select("claim_month").distinct().count() > 12
    month = "date_format(cast(claim_date as timestamp), 'yyyy-MM')"
    assert got.filter(f"NOT claim_month <=> {month}").count() == 0


def test_report_gives_every_line_in_its_place(spark):
    got = E.queries()["snk05_lines"](spark, FOLDER).orderBy("line_number").collect()
    assert [r["line_number"] for r in got] == list(range(11))
    assert [i for i, r in enumerate(got) if r["value"] == "=" * 45] == [0, 2, 10]
