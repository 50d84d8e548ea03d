"""Personal data: base patterns, and a semi-Markov conditional random field that adds spans."""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salvor.llm.common import arrow, batches, by_batches, key60, table

KINDS = ("email", "ip", "card", "phone")
LONGEST = 24  # atoms of an entity
MOST_DIGITS = 19  # of an entity without an at sign
TRAIN_DOCUMENTS = 600
TRAIN_ISLAND = 240  # characters of an island used to fit
LEAST_SCORE = 3.0  # log odds of an added span against leaving it out

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOT = re.compile(r"[0-9@]|[\[(<]at[\])>]")
SIGN = re.compile(r"[\[(<]at[\])>]")
ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]", re.S)
# Signs of entities; a run of them with a digit or an at sign, also a spelled one, is an island, with the next ones after one space.
RUN = re.compile(r"[\w.%+@()\[\]<>-]+", re.A)
# What may stand before and behind an island that holds a spelled at sign.
LOCAL_BEFORE = re.compile(r"[\w.%+-]+ ?\Z", re.A)
DOMAIN_BEHIND = re.compile(r"(?: ?[\w.-]+)?(?: ?(?:\.|[\[(<]dot[\])>]) ?[\w-]+)*", re.A)
SPAN = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for place, sign in enumerate(reversed(digits)):
        value = int(sign) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[SPAN]:
    """Leftmost matches of each kind that do not overlap within the kind, in order of kind and start.

    Each scan is linear: an address starts where the run of local signs before its at sign starts,
    an ip at the start of a run of digits.
    """
    found: list[SPAN] = []
    at, last = text.find("@"), 0
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if domain and start < at:
            found.append((0, start, domain.end()))
            last = domain.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    if not HOT.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            found.append((3, m.start(), m.end()))
    return found


def islands(text: str) -> Iterator[tuple[int, int]]:
    start = end = -1
    for m in RUN.finditer(text):
        if HOT.search(m[0]):
            if end >= 0 and text[end : m.start()] == " ":
                end = m.end()
                continue
            if end >= 0:
                yield start, end
            start, end = m.span()
    if end >= 0:
        yield start, end


NAMES = (
    "bias", "digits_1_6", "digits_7_8", "digits_9_12", "digits_13_19", "digits_more", "at", "one_at", "letters", "only_digits_and_signs",
    "three_dots", "small_parts", "dot_after_at", "plus", "space", "parens", "hyphen", "luhn", "open_left", "open_right",
    "starts_alnum", "ends_alnum", "area_exchange_line", "one_digit_run", "spelled_at",
)
GROUPED = re.compile(r"(?:\+?[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}")
SPELLED = re.compile(r"[\w.%+-]+ ?[\[(<]at[\])>] ?[\w-]+(?: ?(?:\.|[\[(<]dot[\])>]) ?[\w-]+)+", re.A)


class Segments:
    """The candidate segments of an island, by atoms: at most LONGEST atoms, and MOST_DIGITS digits where no at sign is
    written or spelled, from a letter, digit, plus sign or open bracket to a letter or digit, with a digit or an at sign
    inside and no line end. Only the atoms are held; segments and features are made when they are used."""

    def __init__(self, text: str):
        self.text = text
        self.starts, self.stops = array("q"), array("q")
        # Of each atom: may it start or end a segment, what does it add, does it break one.
        self.opens, self.closes, self.hot, self.digits, self.breaks = bytearray(), bytearray(), bytearray(), array("q"), bytearray()
        for m in ATOM.finditer(text):
            lo, hi = m.span()
            sign, ascii_ = text[lo], text[lo].isascii()
            spelled = text[lo:hi] == "at" and text[lo - 1 : lo] in ("[", "(", "<")
            self.starts.append(lo)
            self.stops.append(hi)
            self.opens.append(ascii_ and (sign.isalnum() or sign in "+("))
            self.closes.append(ascii_ and sign.isalnum())
            self.breaks.append(not ascii_ or sign in "\n\t")
            self.digits.append(hi - lo if ascii_ and sign.isdigit() else 0)
            self.hot.append(2 if sign == "@" or spelled else 1 if self.digits[-1] else 0)
        self.n = len(self.starts)

    def ending(self, end: int) -> Iterator[tuple[int, np.ndarray]]:
        """(first atom, features) of every segment that ends before atom ``end``, the shortest first."""
        if not self.closes[end - 1]:
            return
        hot = digits = 0
        for first in range(end - 1, max(0, end - LONGEST) - 1, -1):
            if self.breaks[first]:
                return
            hot, digits = hot | self.hot[first], digits + self.digits[first]
            if digits > MOST_DIGITS and hot < 2 and not self.sign_before(first):
                return
            if hot and self.opens[first]:
                yield first, self.features(self.text, self.starts[first], self.stops[end - 1])

    def sign_before(self, first: int) -> bool:
        return any(h == 2 for h in self.hot[max(0, first - LONGEST) : first])

    @staticmethod
    def features(text: str, a: int, b: int) -> np.ndarray:
        span = text[a:b]
        digits = "".join(c for c in span if "0" <= c <= "9")
        n, ats = len(digits), span.count("@")
        letters = any(c.isalpha() for c in span)
        parts = span.split(".")
        grouped = bool(GROUPED.fullmatch(span))
        return np.array(
            [
                1, 0 < n <= 6, 7 <= n <= 8, 9 <= n <= 12, 13 <= n <= 19, n > 19, ats > 0, ats == 1, letters, not letters and ats == 0,
                len(parts) == 4 and all(p.isdigit() for p in parts), len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts),
                ats == 1 and "." in span.partition("@")[2], span[0] == "+", " " in span, "(" in span, "-" in span,
                13 <= n <= 19 and not letters and luhn(digits), a > 0 and (text[a - 1].isalnum() or text[a - 1] in "@._+-"),
                b < len(text) and (text[b].isalnum() or text[b] in "@_-" or text[b] == "." and text[b + 1 : b + 2].isalnum()),
                span[0].isalnum(), span[-1].isalnum(), grouped, n == len(span), bool(SPELLED.fullmatch(span)),
            ],
            float,
        )


class Case:
    """A training island: its segments as arrays, and which of them are gold for which kind."""

    def __init__(self, text: str, spans: list[SPAN]):
        segments = Segments(text)
        self.atoms = segments.n
        listed = [(first, end, f) for end in range(1, segments.n + 1) for first, f in segments.ending(end)]
        self.at = [(first, end) for first, end, _ in listed]
        self.features = np.array([f for _, _, f in listed]).reshape(len(listed), len(NAMES))
        by_end: list[list[int]] = [[] for _ in range(self.atoms + 1)]
        by_start: list[list[int]] = [[] for _ in range(self.atoms + 1)]
        for i, (first, end) in enumerate(self.at):
            by_end[end].append(i)
            by_start[first].append(i)
        self.by_end = [(np.array(x, int), np.array([self.at[i][0] for i in x], int)) for x in by_end]
        self.by_start = [(np.array(x, int), np.array([self.at[i][1] for i in x], int)) for x in by_start]
        starts, ends = {x: i for i, x in enumerate(segments.starts)}, {y: i + 1 for i, y in enumerate(segments.stops)}
        place, self.gold, taken = {at: i for i, at in enumerate(self.at)}, [], 0
        for kind, x, y in sorted(spans, key=lambda span: (span[1], -span[2])):
            i = place.get((starts.get(x), ends.get(y)))
            if i is not None and x >= taken:
                self.gold.append((i, kind))
                taken = y

    def slope(self, weights: np.ndarray) -> np.ndarray:
        """Gradient of the log-likelihood of the gold segmentation, by forward and backward sums. An
        atom outside entities scores 0, so a segment's score is its log odds."""
        if not self.at:
            return np.zeros_like(weights)
        scores = self.features @ weights
        best = scores.max(axis=1, keepdims=True)
        total = (best + np.log(np.exp(scores - best).sum(axis=1, keepdims=True)))[:, 0]
        forward, backward = np.zeros(self.atoms + 1), np.zeros(self.atoms + 1)
        for end in range(1, self.atoms + 1):
            found, first = self.by_end[end]
            forward[end] = forward[end - 1] if not len(found) else np.logaddexp.reduce(np.append(forward[first] + total[found], forward[end - 1]))
        for first in range(self.atoms - 1, -1, -1):
            found, end = self.by_start[first]
            backward[first] = backward[first + 1] if not len(found) else np.logaddexp.reduce(np.append(backward[end] + total[found], backward[first + 1]))
        firsts, ends = np.array(self.at).T
        chance = np.exp(scores + (forward[firsts] + backward[ends] - forward[-1])[:, None])
        slope = -self.features.T @ chance
        for i, kind in self.gold:
            slope[:, kind] += self.features[i]
        return slope


def decode(segments: Segments, weights: np.ndarray) -> list[tuple[int, int, int, float]]:
    """The best segmentation: boundaries and kinds are chosen together. (kind, start, end, score). A step looks back
    LONGEST atoms; only the best score up to each atom is held, and the segments that were best where they end."""
    n = segments.n
    best, back = array("d", bytes(8 * (n + 1))), {}
    for end in range(1, n + 1):
        best[end] = best[end - 1]
        for first, f in segments.ending(end):
            values = f @ weights
            kind = int(values.argmax())
            if best[first] + values[kind] > best[end]:
                best[end], back[end] = best[first] + values[kind], (first, kind, float(values[kind]))
    found, end = [], n
    while end > 0:
        if end not in back:
            end -= 1
        else:
            first, kind, value = back[end]
            found.append((kind, segments.starts[first], segments.stops[end - 1], value))
            end = first
    return found[::-1]


def variants(island: str) -> list[tuple[str, list[SPAN]]]:
    """The island with its base spans and, for its addresses and phones, the forms that the patterns miss:
    a phone without the plus sign and country code, with brackets, hyphens, points or spaces; an address with its at
    sign, or that and its points, spelled."""
    spans = base_spans(island)
    made = [(island, spans)]
    for kind, start, end in spans:
        span, left, right = island[start:end], island[:start], island[end:]
        if kind == 3 and (m := re.fullmatch(r"\+[0-9]{1,3} \(([0-9]{3})\) ?([0-9]{3})[ .-]?([0-9]{4})", span)):
            for phone in ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"):
                phone = phone.format(*m.groups())
                made.append((phone, [(3, 0, len(phone))]))
            made.append(("at " + phone + " on", [(3, 3, 3 + len(phone))]))
        if kind == 0 and not HOT.search(left + right):
            for sign, point in ((" [at] ", "."), ("[at]", "."), (" (at) ", "."), (" (at) ", " (dot) "), ("[at]", "[dot]")):
                local, _, domain = span.rpartition("@")
                spelled = local + sign + domain.replace(".", point)
                made.append((left + spelled + right, [(0, len(left), len(left) + len(spelled))]))
    return made


def fit(docs: DataFrame, *, documents: int = TRAIN_DOCUMENTS, rounds: int = 30) -> np.ndarray:
    """Weights (features x kinds) from islands of a bounded sample of documents with digits or at signs, and as many
    islands without a base span as there are. The base spans and the variants are the labels."""
    hot = docs.filter(F.col("text").rlike("[0-9@]")).select("doc_id", key60(F.lit("pii"), F.col("doc_id")).alias("key"))
    chosen = [r["doc_id"] for r in hot.filter("doc_id is not null").orderBy("key", "doc_id").limit(documents).collect()]
    if not chosen:
        return np.zeros((len(NAMES), len(KINDS)))

    def short(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in batches(source):
            found = [t[a:b] for t in texts for a, b in islands(t) if b - a <= TRAIN_ISLAND]
            yield arrow(pa.schema([("island", pa.string())]), [found])

    sample = docs.filter(F.col("doc_id").isin(chosen)).select("text").mapInArrow(short, "island string")
    # Distinct shapes, digits kept: at most this many short strings reach the driver.
    texts = [r["island"] for r in sample.distinct().orderBy(F.md5("island")).limit(3 * documents).collect()]
    cases = [Case(*case) for text in texts for case in variants(text)]
    weights, squares = np.zeros((len(NAMES), len(KINDS))), np.full((len(NAMES), len(KINDS)), 1e-6)
    for _ in range(rounds):
        slope = -0.02 * weights
        for case in cases:
            slope = slope + case.slope(weights)
        slope /= max(1, len(cases))
        squares += slope * slope
        weights = weights + slope / np.sqrt(squares)
    return weights


class Taken:
    """Spans and a quick test whether one overlaps a range: starts in order, and the furthest end up to each."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.furthest = [], []
        for a, b in sorted(spans):
            self.starts.append(a)
            self.furthest.append(max(b, self.furthest[-1] if self.furthest else 0))

    def overlaps(self, a: int, b: int) -> bool:
        """A span that starts before ``b`` ends after ``a``."""
        before = bisect_left(self.starts, b)
        return before > 0 and self.furthest[before - 1] > a

    def add(self, a: int, b: int) -> None:
        """Add a span that overlaps none."""
        at = bisect_left(self.starts, a)
        self.starts.insert(at, a)
        self.furthest.insert(at, max(b, self.furthest[at - 1] if at else 0))


def added_spans(text: str, base: list[SPAN], weights: np.ndarray) -> list[SPAN]:
    """Decoded spans with enough odds that overlap no base span and no other added one. An island inside a base span,
    or with fewer than four digits (no kind has so few) and no at sign, holds nothing to add. Where an at sign is spelled, the local
    part before the island and the domain behind it are decoded with it, however long."""
    if not weights.any():
        return []
    taken = Taken([(a, b) for _, a, b in base])
    inside = sorted((a, b) for _, a, b in base)
    at, reach = 0, 0
    found: list[SPAN] = []
    for a, b in islands(text):
        while at < len(inside) and inside[at][0] <= a:
            reach = max(reach, inside[at][1])
            at += 1
        spelled = SIGN.search(text, a, b)
        few = sum("0" <= c <= "9" for c in text[a:b]) < 4 and "@" not in text[a:b]
        if reach >= b or few and not spelled:
            continue
        low, high = a, b
        if spelled:
            line = max(text.rfind("\n", 0, a) + 1, before_runs(text, a))
            if m := LOCAL_BEFORE.search(text, line, a):
                low = m.start()
            high = DOMAIN_BEHIND.match(text, b).end()
        for kind, c, d, value in decode(Segments(text[low:high]), weights):
            c, d = low + c, low + d
            if value >= LEAST_SCORE and not taken.overlaps(c, d):
                found.append((kind, c, d))
                taken.add(c, d)
    return found


def before_runs(text: str, a: int) -> int:
    """Where the run of word signs before ``a`` (a space may stand between) starts."""
    at = a
    if at and text[at - 1] == " ":
        at -= 1
    while at and text[at - 1].isascii() and (text[at - 1].isalnum() or text[at - 1] in "_.%+-"):
        at -= 1
    return at


def joined(spans: list[SPAN]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, a count of the spans of each kind, base_sha256 and all spans, for every row and whole text.

    Null and empty texts have no spans, no counts and the digest of the empty text. Rows that repeat are
    found each; an empty table gives no rows. Only doc_id and text are read.
    """
    names = [f"n_{k}" for k in KINDS]
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in names), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(source):
            rows = []
            for text in texts:
                base = base_spans(text)
                spans = base + (added_spans(text, base, weights) if HOT.search(text) else [])
                counts = [sum(1 for k, _, _ in spans if k == kind) for kind in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            yield arrow(schema, [batch.column("doc_id").to_pylist(), *map(list, zip(*rows))])

    shape = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string"
    return by_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), run, shape)


def query(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return find(docs, fit(docs))
