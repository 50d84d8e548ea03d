"""Scores to metrics, each from a small histogram instead of repeated scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salvor.functions.stats import count_where
from salvor.operators.ordering import ranged, running_position
from salvor.operators.sizes import beside, stored

C = F.col


class Grid(NamedTuple):
    """Thresholds first/denominator .. last/denominator in steps of 1/denominator."""

    first: int
    last: int
    denominator: int

    @property
    def thresholds(self) -> list[float]:
        return [i / self.denominator for i in range(self.first, self.last + 1)]


# The grids of the ensemble, the parameter search and the single-model run.
ENSEMBLE_GRID = Grid(40, 80, 200)
SEARCH_GRID = Grid(20, 40, 100)
SINGLE_GRID = Grid(10, 50, 100)
DEFAULT_THRESHOLD = 0.3


def thresholds_reached(score: Column, grid: Grid) -> Column:
    """How many thresholds of the grid the score reaches, by exact comparison."""
    guess = F.floor(score * grid.denominator)
    step = (
        F.when(score >= (guess + 1) / F.lit(float(grid.denominator)), guess + 1)
        .when(score < guess / F.lit(float(grid.denominator)), guess - 1)
        .otherwise(guess)
    )
    inside = F.least(step, F.lit(grid.last)) - (grid.first - 1)
    return F.greatest(inside, F.lit(0)).cast("int")


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """0 where undefined."""
    return F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0))


def threshold_sweep(df: DataFrame, score: str, label: str, grid: Grid, by: Sequence[str] = ()) -> DataFrame:
    """(by, step, threshold, tp, fp, fn, f1) for every threshold from one pass.

    Rows become a histogram over the grid (at most one row more than thresholds);
    the counts at each threshold are sums over that histogram.
    """
    cells = df.groupBy(*by, thresholds_reached(C(score), grid).alias("_r")).agg(
        count_where(C(label) == 1).alias("_pos"), count_where(C(label) == 0).alias("_neg")
    )

    def above(i: int, what: str) -> Column:
        return F.sum(F.when(C("_r") > i, C(what)).otherwise(0))

    steps = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(t).alias("threshold"),
            above(i, "_pos").alias("tp"),
            above(i, "_neg").alias("fp"),
            (F.sum("_pos") - above(i, "_pos")).alias("fn"),
        )
        for i, t in enumerate(grid.thresholds)
    ]
    rows = cells.groupBy(*by).agg(F.array(*steps).alias("_steps")).select(*by, F.explode("_steps").alias("_s"))
    return rows.select(*by, "_s.*").withColumn("f1", f1(C("tp"), C("fp"), C("fn")))


def best_threshold(sweep: DataFrame, by: Sequence[str] = (), default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """(by, threshold, f1): highest F1, the lowest threshold of equals; ``default`` if all are 0."""
    best = sweep.groupBy(*by).agg(
        F.max(F.struct("f1", (-C("step")).alias("_s"), "threshold")).alias("_b")
    )
    threshold = F.when(C("_b.f1") > 0, C("_b.threshold")).otherwise(F.lit(default))
    return best.select(*by, threshold.alias("threshold"), C("_b.f1").alias("f1"))


def apply_threshold(df: DataFrame, score: str, threshold: Column, into: str = "pred") -> DataFrame:
    return df.withColumn(into, F.when(C(score) >= threshold, 1).otherwise(0))


def f1_at(score: str, label: str, threshold: Column) -> Column:
    """Aggregate expression: F1 of ``score >= threshold``."""
    hit, positive = C(score) >= threshold, C(label) == 1
    return f1(
        count_where(hit & positive), count_where(hit & (C(label) == 0)), count_where(~hit & positive)
    )


def classification_report(df: DataFrame, pred: str, label: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class, accuracy, macro and weighted means."""
    p, y = C(pred), C(label)
    counts = df.agg(
        count_where((p == 1) & (y == 1)).alias("tp"),
        count_where((p == 1) & (y == 0)).alias("fp"),
        count_where((p == 0) & (y == 1)).alias("fn"),
        count_where((p == 0) & (y == 0)).alias("tn"),
    )

    def zero(x: Column) -> Column:
        return F.coalesce(x, F.lit(0.0))

    def row(name: str, hit: str, wrong: str, missed: str) -> Column:
        hit_, wrong_, missed_ = (C(c).cast("double") for c in (hit, wrong, missed))
        return F.struct(
            F.lit(name).alias("class"),
            zero(F.try_divide(hit_, hit_ + wrong_)).alias("precision"),
            zero(F.try_divide(hit_, hit_ + missed_)).alias("recall"),
            f1(hit_, wrong_, missed_).alias("f1"),
            (C(hit) + C(missed)).alias("support"),
        )

    both = counts.withColumns({"_0": row("0", "tn", "fn", "fp"), "_1": row("1", "tp", "fp", "fn")})
    total = C("tp") + C("fp") + C("fn") + C("tn")
    accuracy = zero(F.try_divide(C("tp") + C("tn"), total))

    def mean(name: str, w0: Column, w1: Column) -> Column:
        parts = [
            zero(F.try_divide(C("_0")[m] * w0 + C("_1")[m] * w1, w0 + w1)).alias(m)
            for m in ("precision", "recall", "f1")
        ]
        return F.struct(F.lit(name).alias("class"), *parts, total.alias("support"))

    rows = F.array(
        C("_0"),
        C("_1"),
        F.struct(
            F.lit("accuracy").alias("class"),
            *[accuracy.alias(m) for m in ("precision", "recall", "f1")],
            total.alias("support"),
        ),
        mean("macro avg", F.lit(1), F.lit(1)),
        mean("weighted avg", C("_0")["support"], C("_1")["support"]),
    )
    return both.select(F.explode(rows).alias("_r")).select("_r.*")


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, auc) with ties counted half, exact.

    Equal scores are grouped first; the negatives below each score come from the histogram of
    sampled ranges, so a long list of distinct scores is never sorted in one task, however close they sit.
    """
    groups = df.groupBy(*by, score).agg(
        count_where(C(label) == 1).alias("pos"), count_where(C(label) == 0).alias("neg")
    )
    cells = ranged(groups, [*by, C(score).asc_nulls_last()], "_range")
    placed = running_position(cells, [score], C("_range"), {"neg": "neg", "pos": "pos"}, by=by)
    pairs = C("pos") * (C("neg_before") + C("neg") / 2.0)
    return placed.groupBy(*by).agg(
        F.try_divide(F.sum(pairs), F.max("pos_total").cast("double") * F.max("neg_total")).alias("auc")
    )


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(mse, r2, n) over rows that have both."""
    error = C(label) - C(prediction)
    rows = df.filter(C(label).isNotNull() & C(prediction).isNotNull())
    return rows.agg(
        F.avg(error * error).alias("mse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(label))).alias("r2"),
        F.count("*").alias("n"),
    )


def blend_weights(df: DataFrame, scores: Sequence[str], label: str, grid: Grid = ENSEMBLE_GRID) -> DataFrame:
    """One row of weights, F1 of each score over the sum of F1s, from a single pass."""
    long = df.select(
        label, F.explode(F.array(*[F.struct(F.lit(s).alias("model"), C(s).alias("p")) for s in scores])).alias("_e")
    ).select(label, "_e.*")
    best = best_threshold(threshold_sweep(long, "p", label, grid, by=["model"]), by=["model"])
    of = {s: F.max(F.when(C("model") == s, C("f1"))) for s in scores}
    return best.agg(*[F.try_divide(of[s], F.sum("f1")).alias(s) for s in scores])


def blend(df: DataFrame, weights: DataFrame, scores: Sequence[str], into: str = "p") -> DataFrame:
    """Weighted score per row; the weights are one row, so nothing is shuffled."""
    held = beside(df, weights.select(*[C(s).alias(f"_w_{s}") for s in scores]))
    total = None
    for s in scores:
        part = C(f"_w_{s}") * C(s)
        total = part if total is None else total + part
    return held.withColumn(into, total).drop(*[f"_w_{s}" for s in scores])


def simple_mean(scores: Sequence[str]) -> Column:
    total = None
    for s in scores:
        total = C(s) if total is None else total + C(s)
    return total / F.lit(float(len(scores)))


def metrics_row(
    train: DataFrame, test: DataFrame, score: str, label: str, n_features: int, grid: Grid = SINGLE_GRID
) -> DataFrame:
    """One row: train and test F1 and AUC, the threshold found on train, feature count."""
    # Two columns per row, read by several metrics.
    train, test = (stored(part.select(score, label)) for part in (train, test))
    threshold = stored(best_threshold(threshold_sweep(train, score, label, grid)).select("threshold"))
    row = threshold.select(C("threshold").alias("best_threshold"), F.lit(n_features).alias("n_features"))
    for name, part in (("train", train), ("test", test)):
        hit = beside(part, threshold).agg(f1_at(score, label, C("threshold")).alias(f"{name}_f1"))
        row = beside(beside(row, hit), roc_auc(part, score, label).withColumnRenamed("auc", f"{name}_auc"))
    return row


def report_lines(metrics: DataFrame, artifacts: Mapping[str, str] | None = None) -> DataFrame:
    """Text report of a metrics row, one line per row."""
    rule = "=" * 45

    def shown(column: str, pattern: str) -> Column:
        return F.when(C(column).isNotNull(), F.format_string(pattern, C(column))).otherwise(F.lit("N/A"))

    lines = [
        F.lit(rule),
        F.lit("Claim model execution report"),
        F.lit(rule),
        F.lit("Model performance:"),
        F.concat(F.lit("- Training F1 score: "), shown("train_f1", "%.4f")),
        F.concat(F.lit("- Training AUC: "), shown("train_auc", "%.4f")),
        F.concat(F.lit("- Test F1 score: "), shown("test_f1", "%.4f")),
        F.concat(F.lit("- Test AUC: "), shown("test_auc", "%.4f")),
        F.concat(F.lit("- Best threshold: "), shown("best_threshold", "%.3f")),
        F.concat(F.lit("- Features used: "), C("n_features").cast("string")),
        *[F.lit(f"- {what}: {path}") for what, path in (artifacts or {}).items()],
        F.lit(rule),
    ]
    return metrics.select(F.posexplode(F.array(*lines)).alias("line_number", "value"))
