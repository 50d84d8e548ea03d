"""From features to model input: splits, encodings, folds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.scalars import digest, digest_below
from salvor.operators.ordering import hash_cell, number_rows, ranged
from salvor.operators.sizes import beside, stored

C = F.col


def in_month(column: str, year: int, month: int) -> Column:
    """Half-open date range, so a Parquet scan can skip row groups."""
    start = datetime(year, month, 1)
    end = datetime(year + month // 12, month % 12 + 1, 1)
    literal = [F.lit(f"{d:%Y-%m-%d}").cast("timestamp_ntz") for d in (start, end)]
    return (C(column) >= literal[0]) & (C(column) < literal[1])


def hold_out_split(df: DataFrame, year: int, month: int, label: str = "subrogation") -> tuple[DataFrame, DataFrame]:
    """(train, test): one month is the test frame; undated rows stay in training, and
    training rows without a label are left out."""
    test = in_month("claim_date", year, month)
    train = df.filter(~F.coalesce(test, F.lit(False))).filter(C(label).isNotNull())
    return train, df.filter(test)


def hash_split(key: str, percent: int, seed: int = 42) -> Column:
    """Repeatable pick of about ``percent`` % of rows by a digest of their key, on any partitioning."""
    return digest_below(C(key), seed, percent)


def _values(columns: Sequence[str]) -> Column:
    """(column, value) of each of the columns, for one pass over all of them."""
    return F.explode(F.array(*[F.struct(F.lit(c).alias("column"), C(c).cast("string").alias("value")) for c in columns]))


def encoding_tables(
    train: DataFrame, columns: Sequence[str], label: str, smoothing: float = 30
) -> tuple[DataFrame, DataFrame]:
    """(column, value, te): the smoothed label mean of each category of all columns, and the overall mean (one row).

    All columns are counted in one pass over the training frame; a missing category is
    left out, as it takes the overall mean.
    """
    stats = stored(
        train.select(label, _values(columns).alias("_e"))
        .groupBy("_e.column", "_e.value")
        .agg(F.sum(label).alias("s"), F.count(label).alias("n"))
    )
    overall = stats.filter(C("column") == columns[0]).agg((F.sum("s") / F.sum("n")).alias("_mean"))
    known = beside(stats.filter(C("value").isNotNull()), overall)
    return known.select("column", "value", ((C("s") + smoothing * C("_mean")) / (C("n") + smoothing)).alias("te")), overall


def looked_up(df: DataFrame, table: DataFrame, column: str, value: str, into: str) -> DataFrame:
    """Add ``into``: what a (column, value, …) table has for the category of ``column``; null where it has none."""
    own = table.filter(C("column") == column).select(C("value").alias("_value"), C(value).alias("_found"))
    joined = df.join(own, C(column).cast("string") == C("_value"), "left").withColumn(into, C("_found"))
    return joined.drop("_value", "_found")


def target_encode(
    train: DataFrame,
    frames: Sequence[DataFrame],
    columns: Sequence[str],
    label: str = "subrogation",
    smoothing: float = 30,
) -> list[DataFrame]:
    """Add ``<column>_te`` to every frame from the training statistics; a category the
    training frame lacks, or a missing one, takes the overall mean."""
    if not columns:
        return list(frames)
    table, overall = encoding_tables(train, columns, label, smoothing)
    encoded = []
    for frame in frames:
        for column in columns:
            frame = looked_up(frame, table, column, "te", f"{column}_te")
        frame = beside(frame, overall)
        filled = {f"{c}_te": F.coalesce(f"{c}_te", "_mean") for c in columns}
        encoded.append(frame.withColumns(filled).drop("_mean"))
    return encoded


def fold_encodings(
    data: DataFrame, columns: Sequence[str], label: str, k: int, smoothing: float = 30
) -> tuple[DataFrame, DataFrame]:
    """(column, value, te) and one row (_means): arrays of the encodings of each fold's training part, by fold.

    One aggregate over (column, value, fold) serves all columns and folds: the sums of a training part are
    those of all rows less those of its fold."""
    sums = (
        data.select(label, "fold", _values(columns).alias("_e"))
        .groupBy("_e.column", "_e.value", "fold")
        .agg(F.sum(label).alias("s"), F.count(label).alias("n"))
    )

    def without(what: str) -> Column:
        kept = [F.sum(what) - F.coalesce(F.sum(F.when(C("fold") == f, C(what))), F.lit(0)) for f in range(k)]
        return F.array(*kept)

    stats = stored(sums.groupBy("column", "value").agg(without("s").alias("s"), without("n").alias("n")))

    def total(what: str) -> Column:
        return F.array(*[F.sum(C(what)[f]) for f in range(k)])

    means = stats.filter(C("column") == columns[0]).agg(total("s").alias("s"), total("n").alias("n"))
    means = means.select(F.array(*[C("s")[f] / C("n")[f] for f in range(k)]).alias("_means"))
    te = F.array(*[(C("s")[f] + smoothing * C("_means")[f]) / (C("n")[f] + smoothing) for f in range(k)])
    return stored(beside(stats.filter(C("value").isNotNull()), means).select("column", "value", te.alias("te"))), stored(means)


def codes_together(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """(column, value, code): the categories of each column over all frames in text order, numbered from 0, in one pass."""
    values = reduce(DataFrame.unionByName, [f.select(_values(columns).alias("_e")).select("_e.*") for f in frames])
    distinct = ranged(values.filter(C("value").isNotNull()).distinct(), ["column", "value"], "_range")
    return stored(number_rows(distinct, ["value"], C("_range"), "code", start=0, by=["column"]).select("column", "value", "code"))


def coded_together(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their codes; an unseen or missing one takes the next free code."""
    free = codes.agg(*[F.coalesce(F.max(F.when(C("column") == c, C("code"))) + 1, F.lit(0)).alias(f"_free_{c}") for c in columns])
    for column in columns:
        df = looked_up(df, codes, column, "code", column)
    df = beside(df, free).withColumns({c: F.coalesce(c, f"_free_{c}") for c in columns})
    return df.drop(*[f"_free_{c}" for c in columns])


def label_codes(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """(column, code): categories of all frames in text order, numbered from 0."""
    values = reduce(DataFrame.unionByName, [f.select(C(column).cast("string").alias(column)) for f in frames])
    distinct = ranged(values.filter(C(column).isNotNull()).distinct(), [column], "_range")
    return stored(number_rows(distinct, [column], C("_range"), "code", start=0).drop("_range"))


def label_encode(
    df: DataFrame, codes: DataFrame, column: str, into: str | None = None, *, keep_missing: bool = False
) -> DataFrame:
    """Replace (or add) the code of a category. An unseen one takes the next free code;
    a missing one too, unless ``keep_missing``."""
    small = codes.select(C(column).alias("_value"), C("code").alias("_code"))
    unseen = small.agg(F.coalesce(F.max("_code") + 1, F.lit(0)).alias("_unseen"))
    joined = beside(df.join(small, C(column).cast("string") == C("_value"), "left"), unseen)
    code = F.coalesce("_code", "_unseen")
    if keep_missing:
        code = F.when(C(column).isNotNull(), code)
    return joined.withColumn(into or column, code).drop("_value", "_code", "_unseen")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1: classes are dealt out evenly in the order of a digest of the key.

    Each class is numbered cell by cell of its digest, so two classes still use every task.
    """
    hashed = df.withColumn("_h", F.conv(digest(C(key), seed, 15), 16, 10).cast("bigint"))
    numbered = number_rows(hashed, ["_h", key], hash_cell(C("_h"), width=60), "_rn", start=0, by=[label])
    return numbered.withColumn("fold", F.pmod("_rn", F.lit(k)).cast("int")).drop("_h", "_rn")


def mean_of_folds(predictions: DataFrame, key: str, model: str = "model", score: str = "p") -> DataFrame:
    """Average of the fold models' scores per row and model."""
    return predictions.groupBy(key, model).agg(F.avg(score).alias(score))
