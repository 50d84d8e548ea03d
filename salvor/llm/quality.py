"""Quality scores by Bradley-Terry pairwise ranking."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salvor.llm.common import arrow, batches, by_batches, key60, remainder4, staged, table
from salvor.operators.ordering import exact_quantiles, frequencies

TRAIN_ROWS = 3000  # of each label, in a sample to look at; the fit takes all
BUCKET_ROWS, RIVALS = 1024, 128  # labelled rows that meet in a task, and at least about so many of each label
PAIRS = 8  # opponents of each row
RIDGE = 1e-3
PASS = 0.7
FEATURES = (
    "log_words", "word_length", "long_words", "distinct", "most_frequent", "stutter", "letters", "digits", "upper",
    "stops", "inner_stops", "odd_signs", "odd_words", "bars", "repeated_lines", "line_words", "no_letter",
)


def _classes() -> np.ndarray:
    """Sign class by code below 256: letter 0, digit 1, white space 2, plain punctuation 3, bar 4, other 5; letters beyond."""
    kinds = np.zeros(0x101, np.int64)
    for code in range(0x100):
        sign = chr(code)
        kinds[code] = 0 if sign.isalpha() else 1 if sign.isdigit() else 2 if sign.isspace() else 3 if sign in ".,;:!?'\"()-" else 4 if sign == "|" else 5
    return kinds


class Measures:
    def __init__(self):
        self.kinds = _classes()

    def of(self, text: str) -> list[float]:
        """Feature values of a whole text; all shares of an empty text are 0."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        counts = np.bincount(self.kinds[np.minimum(codes, 0x100)], minlength=6) if len(codes) else np.zeros(6)
        words = text.split()
        n, shown = len(words) or 1, float(max(1, len(codes) - counts[2]))
        tally = Counter(words)
        lengths = list(map(len, words))
        lines = [x for x in text.split("\n") if x]
        stops = text.count(".") + text.count("!") + text.count("?")
        odd = sum(c for w, c in tally.items() if not w[-1].isalnum() and w[-1] not in ".,;:!?'\")")
        return [
            float(np.log1p(len(words))),
            min(20.0, sum(lengths) / n),
            sum(1 for x in lengths if x > 20) / n,
            len(tally) / n**0.75,
            max(tally.values(), default=0) / n,
            sum(map(eq, words, words[1:])) / n,
            counts[0] / shown,
            counts[1] / shown,
            sum(1 for w in words if w[0].isupper()) / n,
            min(1.0, stops / n),
            min(1.0, counts[3] / shown),
            counts[5] / shown,
            odd / n,
            counts[4] / shown,
            1.0 - len(set(lines)) / len(lines) if lines else 0.0,
            float(np.log1p(n / max(1, len(lines)))),
            float(counts[0] == 0),
        ]

    def matrix(self, texts: list[str]) -> np.ndarray:
        return np.array([self.of(t) for t in texts], float).reshape(len(texts), len(FEATURES))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and x, the features of every row and whole text; null text is the empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measures = Measures()
        for batch, texts in batches(source):
            yield arrow(schema, [batch.column("doc_id").to_pylist(), list(measures.matrix(texts))])

    return by_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), run, "doc_id long, x array<double>")


def labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, quality, x) of every labelled row outside the held-out fold. No text is shuffled, only features."""
    wanted = labels.select("doc_id", "quality").filter(F.col("quality").isin(0, 1) & (remainder4(F.col("doc_id")) != 2))
    # The lesser of conflicting labels, so that runs agree.
    wanted = wanted.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    return features.join(wanted, "doc_id").select(key60(F.lit("quality"), F.col("doc_id")).alias("key"), "quality", "x")


def _sizes(rows: DataFrame) -> dict[int, int]:
    return {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}  # two rows


def measured_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of up to about ``per_label`` of the rows of each label that ``fit`` learns from, chosen by hash, to look
    at on the driver."""
    rows = staged(labelled(measured(docs), labels), "quality-sample")
    counts = _sizes(rows)
    if not counts:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    share = F.create_map(*[F.lit(x) for label, n in counts.items() for x in (label, min(1.0, per_label / n))])
    some = rows.filter(F.col("key") < share[F.col("quality")] * F.lit(2.0**60))
    found = sorted((r["key"], r["x"], r["quality"]) for r in some.collect())
    return np.array([x for _, x, _ in found], float).reshape(len(found), len(FEATURES)), np.array([q for _, _, q in found], float)


def _expanded(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - centre) / scale, -8.0, 8.0)
    return np.hstack([z, z * z])


def dealt(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """A row for each bucket of about BUCKET_ROWS labelled rows: their features, labels, and whether this is their own bucket.
    Every row has one of its own; those of the rarer label are also copied to the next buckets until about RIVALS meet in each."""
    many = ceil(sum(counts.values()) / BUCKET_ROWS)
    rarer = min(counts, key=lambda label: (counts[label], label))
    copies = min(many, ceil(many * RIVALS / counts[rarer]))
    turns = F.when(F.col("quality") == rarer, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    placed = rows.select("*", F.explode(turns).alias("turn"))
    placed = placed.withColumn("bucket", F.pmod(F.pmod(F.xxhash64("key"), F.lit(many)) + F.col("turn"), F.lit(many)))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = sorted(zip(rows["key"], map(tuple, rows["x"]), rows["quality"], rows["turn"] == 0))
        x, y, own = (np.array([r[i] for r in found], t).tobytes() for i, t in ((1, float), (2, float), (3, bool)))
        return pd.DataFrame({"bucket": [key[0]], "x": [x], "y": [y], "own": [own]})

    return placed.groupBy("bucket").applyInPandas(pack, "bucket long, x binary, y binary, own binary")


def _duels(x: np.ndarray, y: np.ndarray, own: np.ndarray, pairs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that win, rows that lose): every own row meets ``pairs`` of the other label."""
    good, bad = np.nonzero(y == 1)[0], np.nonzero(y == 0)[0]
    if not (len(good) and len(bad)):
        return np.zeros(0, int), np.zeros(0, int)
    picks = np.random.default_rng(seed)
    mine, theirs = good[own[good]], bad[own[bad]]
    won = np.concatenate([np.repeat(mine, pairs), picks.choice(good, pairs * len(theirs))])
    return won, np.concatenate([picks.choice(bad, pairs * len(mine)), np.repeat(theirs, pairs)])


def slopes(buckets: DataFrame, centre: np.ndarray, scale: np.ndarray, weight: np.ndarray, pairs: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Pairs, and the sums of slope and curvature of their loss at ``weight``; a row for each task reaches the driver."""
    many = len(weight)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + many + many * many)
        for batch in source:
            for bucket, x, y, own in zip(*[batch.column(c).to_pylist() for c in ("bucket", "x", "y", "own")]):
                z = _expanded(np.frombuffer(x).reshape(-1, len(FEATURES)), centre, scale)
                won, lost = _duels(z, np.frombuffer(y), np.frombuffer(own, bool), pairs, 7 + bucket)
                ahead = z[won] - z[lost]
                chance = 1.0 / (1.0 + np.exp(-np.clip(ahead @ weight, -30, 30)))
                curve = (ahead * (chance * (1 - chance))[:, None]).T @ ahead
                total += np.concatenate([[len(ahead)], ahead.T @ (1 - chance), curve.ravel()])
        yield arrow(pa.schema([("sums", pa.list_(pa.float64()))]), [[total]])

    total = np.sum([r["sums"] for r in buckets.mapInArrow(run, "sums array<double>").collect()], axis=0)
    return int(total[0]), total[1 : 1 + many], total[1 + many :].reshape(many, many)


def fit(docs: DataFrame, labels: DataFrame, *, pairs: int = PAIRS, ridge: float = RIDGE) -> dict:
    """As ``fit_measured`` on the features of ``docs``."""
    return fit_measured(staged(measured(docs), "quality-features"), labels, pairs=pairs, ridge=ridge)


def fit_measured(features: DataFrame, labels: DataFrame, *, pairs: int = PAIRS, ridge: float = RIDGE) -> dict:
    """Bradley-Terry weights from preference pairs of all labelled rows outside the held-out fold.

    Each row meets ``pairs`` rows of the other label in its bucket; the chance that the better one wins is the
    logistic of the difference of their scores, a linear function of standardised features and
    their squares. Newton steps solve the logistic loss, each from sums over the buckets. The score at the quantile that
    is the share of label 0 becomes 0.7. Without both labels every score is 0.5.
    """
    rows = staged(labelled(features, labels), "quality-rows")
    counts = _sizes(rows)
    if len(counts) < 2:
        return {}
    each = range(len(FEATURES))
    spread = rows.agg(*[F.avg(F.col("x")[i]) for i in each], *[F.stddev_pop(F.col("x")[i]) for i in each]).first()
    centre, scale = np.array(spread[: len(FEATURES)]), np.maximum(np.array(spread[len(FEATURES) :]), 1e-6)
    buckets = staged(dealt(rows, counts), "quality-buckets")
    weight = np.zeros(2 * len(FEATURES))
    for _ in range(25):
        n, slope, curve = slopes(buckets, centre, scale, weight, pairs)
        if not n:
            return {}
        step = np.linalg.solve(curve / n + ridge * np.eye(len(weight)), slope / n - ridge * weight)
        weight = weight + step
        if np.abs(step).max() < 1e-8:
            break
    model = {"centre": centre, "scale": scale, "weight": weight, "cut": 0.0}
    scores = frequencies(_raw(rows.select(F.col("key").alias("doc_id"), "x"), model), "score")
    cut = exact_quantiles(scores, "score", [counts[0] / sum(counts.values())]).first()["q"][0]
    return model | {"cut": cut}


def _raw(features: DataFrame, model: dict) -> DataFrame:
    """doc_id and the linear score above the cut."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            # A sum for each row alone, so that equal features have equal scores in any batch.
            raw = (_expanded(x, model["centre"], model["scale"]) * model["weight"]).sum(axis=1) - model["cut"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw)], schema=schema)

    return features.mapInArrow(run, "doc_id long, score double")


def score_measured(features: DataFrame, model: dict) -> DataFrame:
    """doc_id and score (0 to 1) of every row of features."""
    if not model:
        return features.select("doc_id", F.lit(0.5).alias("score"))
    raw = F.greatest(F.least(F.col("score") + float(np.log(PASS / (1 - PASS))), F.lit(30.0)), F.lit(-30.0))
    return _raw(features, model).select("doc_id", (1.0 / (1.0 + F.exp(-raw))).alias("score"))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score (0 to 1) for every row and whole text; null text is the empty text, and empty
    texts are scored by their features like any other."""
    return score_measured(measured(docs), model)


def qualities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every text is measured once; the model learns from the stored features, which are then scored."""
    features = staged(measured(docs), "quality-features")
    scored = score_measured(features, fit_measured(features, labels))
    return scored.select("doc_id", (remainder4(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= PASS).cast("int").alias("predicted"))


def query(spark, folder: str) -> DataFrame:
    return qualities(table(spark, folder, "documents"), table(spark, folder, "labels"))
