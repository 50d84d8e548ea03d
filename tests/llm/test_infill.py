"""Fill-in-middle against plain slicing, exact round trips, and rows at the edges."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salvor.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = st.text(st.sampled_from("ab é🙂\t\n\x0b\x1c<>PSM "), max_size=60)


def by_slicing(text, doc_id, seed=42):
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or c % 100 >= 50:
        return n, "plain", None, None, text
    first, second = sorted((a % (n + 1), b % (n + 1)))
    p, m, s = "".join(units[:first]), "".join(units[first:second]), "".join(units[second:])
    if d % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(0, 5000))
def test_rotation_equals_slicing_and_goes_back(text, doc_id):
    made = infill.changed(text.encode(), doc_id, 42, 50, 80)
    assert (*made[:4], made[4].decode()) == by_slicing(text, doc_id)
    body = bytearray(made[4])
    infill.restored(body, made[1])
    assert body.decode() == text


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.data())
def test_three_reversals_exchange_neighbours(body, data):
    start = data.draw(st.integers(0, len(body)))
    middle = data.draw(st.integers(start, len(body)))
    stop = data.draw(st.integers(middle, len(body)))
    turned = bytearray(body)
    infill.rotate(turned, start, middle, stop)
    assert turned == body[:start] + body[middle:stop] + body[start:middle] + body[stop:]


LONG = "palabra muy  larga\n" * 100_000 + "a" * 500_000
EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (4, "one two"), (5, LONG), (6, "has <P> inside"), (None, "one  two "), (7, "é́🙂 \x1c x"), (-8, "  lead and trail  "), (9, "<"), (10, "<P <S <M > >")]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "x", 1, "y", "z") for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, form string, n int, output string, restored string")


def test_edges(edges):
    for seed in (42, 7, 8, 9):
        made = infill.fill_in_middle(edges, seed=seed)
        got = sorted((tuple(r) for r in infill.restore(made).collect()), key=str)
        wanted = sorted(((i, *by_slicing(t or "", i, seed), t or "") for i, t in EDGES), key=str)
        assert got == wanted


def test_all_or_none_change(edges):
    forms = {r["form"] for r in infill.fill_in_middle(edges.filter("text not like '%<P>%' and text <> ''"), percent=100, suffix_first=0).collect()}
    assert forms == {"psm"}
    assert {r["form"] for r in infill.fill_in_middle(edges, percent=0).collect()} == {"plain"}


def test_empty_table(edges):
    assert infill.restore(infill.fill_in_middle(edges.filter("false"))).count() == 0
