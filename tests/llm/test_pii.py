"""The semi-Markov field against enumeration and a numeric slope; windows, overlaps, variants and memory."""

import itertools
import resource
import time

import numpy as np
import pytest

from salvor.llm import pii


@pytest.fixture(scope="module")
def weights(spark):
    signs = [f"x ann.{i}b@mail{i % 7}.example.com y 10.0.{i}.7 z +1 ({200 + 7 * i}) 555-{1000 + 13 * i} w 4{i:03d}5555444411 {i}77 end" for i in range(120)]
    return pii.fit(spark.createDataFrame(list(enumerate(signs)), "doc_id long, text string"))


def segmentations(case):
    """Every set of segments of an island that do not overlap, each with a kind."""
    spans = [(first, end, i) for i, (first, end) in enumerate(case.at)]
    for size in range(len(spans) + 1):
        for chosen in itertools.combinations(spans, size):
            ordered = sorted(chosen)
            if all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:])):
                for kinds in itertools.product(range(len(pii.KINDS)), repeat=size):
                    yield [(i, k) for (_, _, i), k in zip(ordered, kinds)]


ISLANDS = ["a@b.c", "1 2", "+1 23", "x@y", "7-8"]


@pytest.mark.parametrize("text", ISLANDS)
def test_decode_is_the_best_of_all_segmentations(text):
    pick = np.random.default_rng(len(text))
    case = pii.Case(text, [])
    for _ in range(5):
        w = pick.normal(size=(len(pii.NAMES), len(pii.KINDS)))
        scores = case.features @ w
        best = max(sum(scores[i, k] for i, k in s) for s in segmentations(case))
        assert sum(s for *_, s in pii.decode(pii.Segments(text), w)) == pytest.approx(max(0.0, best))


@pytest.mark.parametrize("text", ISLANDS)
def test_slope_is_that_of_the_enumerated_likelihood(text):
    pick = np.random.default_rng(1)
    case = pii.Case(text, pii.base_spans(text))
    w = 0.3 * pick.normal(size=(len(pii.NAMES), len(pii.KINDS)))
    listed = list(segmentations(case))

    def likelihood(w):
        scores = case.features @ w
        totals = np.array([sum(scores[i, k] for i, k in s) for s in listed])
        return sum(scores[i, k] for i, k in case.gold) - np.logaddexp.reduce(totals)

    slope = case.slope(w)
    for at in zip(*np.nonzero(np.abs(case.features).sum(axis=0)[:, None] * np.ones((1, len(pii.KINDS))))):
        step = np.zeros_like(w)
        step[at] = 1e-5
        assert slope[at] == pytest.approx((likelihood(w + step) - likelihood(w - step)) / 2e-5, abs=1e-6)


def found(text, weights):
    return [(pii.KINDS[k], text[a:b]) for k, a, b in pii.added_spans(text, pii.base_spans(text), weights)]


def test_variants_are_found(weights):
    for phone in ("(846) 555-1234", "846-555-1234", "846.555.1234"):
        assert found(f"call {phone} now", weights) == [("phone", phone)]
    for address in ("bob [at] site.example.org", "bob(at)site.example.org", "ann (at) mail (dot) com"):
        assert found(f"write to {address} today", weights) == [("email", address)]
    for clean in ("In 1998 some 47774316 copies were sold, 3.5 a day.", "at 12:30 and 10-20 or 1,234,567.89", "see [at] home", "rows 1 2 3 4 5 6 7 8 9 10 11 12"):
        assert found(clean, weights) == []


def test_long_local_parts_are_found_whole(weights):
    for length in (30, 100, 5_000):
        address = "a" * length + " [at] site.example.org"
        assert found(f"write to {address} today", weights) == [("email", address)]


def test_no_added_span_overlaps_another(weights):
    text = " ".join(f"{c}@b.c" for c in "abcdefghijklmnopq") + " [at] site.example.org"
    base = pii.base_spans(text)
    added = pii.added_spans(text, base, weights)
    spans = sorted((a, b) for _, a, b in base + added)
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_a_table_of_numbers_takes_little_memory(weights):
    text = " ".join(str(1000 + i * 37 % 9000) for i in range(200_000))
    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    pii.added_spans(text, [], weights)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300 * 1024
    assert time.time() - start < 120
