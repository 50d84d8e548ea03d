"""Encoded claims are joined once, however many fits and lookups read them."""

import pytest
from conftest import FOLDER

import __spark_entry__ as E


@pytest.mark.parametrize("name", ["mp02", "mp03", "mp03_all"])
def test_fits_and_lookups_read_stored_claims(spark, name):
    got = E.queries()[name](spark, FOLDER)
    assert not [f for f in got.inputFiles() if "lineitem" in f]
    assert got.count() > 0
