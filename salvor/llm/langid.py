"""Language identification by string kernels, Nyström landmarks and ridge regression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salvor.llm.common import arrow, batches, by_batches, key60, remainder4, table

BITS = 15
LONGEST = 4
LANDMARKS = 256
TRAIN_ROWS = 500  # of each language
RIDGE = 1e-2
UNKNOWN = "und"
MOST_LANGUAGES = 512  # values of lang that are learned, the most frequent first; a column of free text has millions


class Grams:
    """Presence of letter n-grams, n = 1 to LONGEST, in 2^BITS hashed places. All but letters is a space. Grams that share a
    place count as one; four languages fill about a quarter of the places, many scripts would want more BITS."""

    def __init__(self):
        codes = range(0x10000)
        self.letter = np.fromiter((chr(c).isalpha() for c in codes), bool, 0x10000)

    def places(self, text: str) -> np.ndarray | None:
        """Places of a text's n-grams, with repeats; None if it has no letter."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letter = self.letter[np.minimum(codes, 0xFFFF)]
        if len(codes) and codes.max() > 0xFFFF:
            letter = letter | np.fromiter((c > 0xFFFF and chr(c).isalpha() for c in codes), bool, len(codes))
        if not letter.any():
            return None
        kept = letter.copy()
        kept[1:] |= letter[:-1]  # of a run of other signs the first stays, as a space
        clean = np.where(letter, codes, 32)[kept].astype(np.uint32)
        clean = np.concatenate([np.array([32], np.uint32), clean])
        found, value = [], np.zeros(len(clean), np.uint32)
        for n in range(1, LONGEST + 1):
            value = (value[: len(clean) - n + 1] * np.uint32(0x01000193)) ^ clean[n - 1 :]
            found.append(((value * np.uint32(0x9E3779B1)) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BITS))
            if len(clean) == n:
                break
        return np.concatenate(found)

    def matrix(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(rows scaled to length 1, whether a row has a letter): the kernel is their product."""
        rows, known = np.zeros((len(texts), 1 << BITS), np.float32), np.zeros(len(texts), bool)
        for i, text in enumerate(texts):
            places = self.places(text)
            if places is not None:
                rows[i, places] = 1.0
                known[i] = True
        rows /= np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1.0))
        return rows, known


def training_rows(docs: DataFrame, per_language: int) -> DataFrame:
    """Up to ``per_language`` rows of each of the MOST_LANGUAGES most frequent languages, those with the smallest hash keys. A
    share by hash first leaves about twice as many, so that no window sees a whole language."""
    usable = (remainder4(F.col("doc_id")) != 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    rows = docs.select("doc_id", "lang", "text").filter(usable).withColumn("key", key60(F.lit("langid"), F.col("doc_id")))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return rows.limit(0)
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, (2 * per_language + 100) / r["n"]))])
    some = rows.filter(F.col("key") < share[F.col("lang")] * F.lit(2.0**60))
    return some.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("key", "doc_id"))).filter(F.col("place") <= per_language)


class Model:
    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    def predict(self, texts: list[str], grams: Grams) -> tuple[list[str], list[float]]:
        """Language and score of each text, by matrix products over blocks of rows."""
        predicted, scores = [], []
        for at in range(0, len(texts), 128):
            rows, known = grams.matrix(texts[at : at + 128])
            if not self.languages:
                known[:] = False
            values = rows @ self.weights[:-1] + self.weights[-1]
            best = values.argmax(axis=1) if self.languages else known.astype(int)
            predicted += [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            scores += [float(min(1.0, max(0.0, (1 + v[b]) / 2))) if k else 0.0 for v, b, k in zip(values, best, known)]
        return predicted, scores


def fit(docs: DataFrame, *, per_language: int = TRAIN_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Weights of every place for every language, from a bounded sample.

    Executors turn the sample's texts into bit rows of 2^BITS places, so what reaches the driver is bounded
    by ``per_language`` x languages x 4 KB. Landmarks are the first rows by key. With the kernel K of
    rows to landmarks and C among landmarks, features are K C^(-1/2); ridge regression on them,
    one language against the rest, gives the weights of landmarks, and as the kernel is
    a product of rows, those of places.
    """

    def bits(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, schema = Grams(), pa.schema([("key", pa.int64()), ("lang", pa.string()), ("row", pa.binary())])
        for batch, texts in batches(source):
            rows, _ = grams.matrix(texts)
            packed = [np.packbits(r > 0).tobytes() for r in rows]
            yield arrow(schema, [batch.column("key").to_pylist(), batch.column("lang").to_pylist(), packed])

    sample = training_rows(docs, per_language).select("key", "lang", "text")
    found = sorted(sample.mapInArrow(bits, "key long, lang string, row binary").collect())
    languages = sorted({r["lang"] for r in found})
    if not found:
        return Model([], np.zeros(((1 << BITS) + 1, 0), np.float32))

    def rows(part) -> np.ndarray:
        made = np.unpackbits(np.array([np.frombuffer(r["row"], np.uint8) for r in part]), axis=1).astype(np.float32)
        return made / np.sqrt(np.maximum(made.sum(axis=1, keepdims=True), 1.0))

    marks = rows(found[:landmarks])
    kernel = np.concatenate([rows(found[i : i + 256]) @ marks.T for i in range(0, len(found), 256)]).astype(float)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.column_stack([kernel @ root, np.ones(len(found))])
    goal = np.where(np.array([r["lang"] for r in found])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    penalty = ridge * len(found) / max(1, features.shape[1]) * np.eye(features.shape[1])
    penalty[-1, -1] = 1e-9
    solved = np.linalg.solve(features.T @ features + penalty, features.T @ goal)
    weights = (marks.T @ (root @ solved[:-1])).astype(np.float32)
    return Model(languages, np.vstack([weights, solved[-1:].astype(np.float32)]))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row and whole text.

    The score is the winner's regression value moved from [-1, 1] to [0, 1]. Null texts, texts without a letter
    and a model without languages give ``und`` with score 0. Ties go to the language first in order.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch, texts in batches(source):
            yield arrow(schema, [batch.column("doc_id").to_pylist(), *model.predict(texts, grams)])

    return by_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "text"), run, "doc_id long, lang_pred string, score double")


def recognised(docs: DataFrame, model: Model, *, least: float) -> DataFrame:
    """The rows whose text has a language with at least this score, all columns as they are; no shuffle."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch, texts in batches(source):
            predicted, scores = model.predict(texts, grams)
            yield batch.filter(pa.array([p != UNKNOWN and s >= least for p, s in zip(predicted, scores)], pa.bool_()))

    return by_batches(docs, run, docs.schema)


def predictions(docs: DataFrame) -> DataFrame:
    """Fit on the rows outside the held-out fold and predict every row."""
    found = identify(docs, fit(docs))
    return found.select("doc_id", (remainder4(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score")


def query(spark, folder: str) -> DataFrame:
    return predictions(table(spark, folder, "documents"))
