"""Model preparation, evaluation on fixed scores, reports, and triage."""

from __future__ import annotations

from pyspark.sql import functions as F

from salvor.entries.basics import missed
from salvor.entries.features import compared
from salvor.operators import evaluate as V
from salvor.operators import prep as P
from salvor.operators import triage as T
from salvor.operators.sizes import beside, stored
from salvor.session import scratch
from salvor.sources import files
from salvor.sources.star import HOLD_OUT

C = F.col
SCORES = ("p_a", "p_b", "p_c")


# --- preparation -------------------------------------------------------------


def split(s):
    train, test = P.hold_out_split(s.claim, *HOLD_OUT)
    marked = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return marked.groupBy("part").agg(
        F.count("*").alias("n"), F.round(F.avg("subrogation"), 9).alias("rate"), F.max("claim_date").alias("latest")
    )


def _categories(s):
    """Claims with the four encoded categories, some missing."""
    zip3 = F.nullif(F.substring("zip_code", 1, 3), F.lit("000"))
    return s.wide.select(
        "claim_number",
        "claim_date",
        "subrogation",
        "accident_type",
        "accident_site",
        zip3.alias("zip3"),
        F.concat_ws("_", "accident_site", "accident_type").alias("accident_combo"),
    )


def target_encoded(s):
    columns = ["accident_type", "accident_site", "zip3", "accident_combo"]
    train, test = P.hold_out_split(stored(_categories(s)), *HOLD_OUT)
    parts = P.target_encode(train, [train, test], columns)
    both = parts[0].unionByName(parts[1])
    return both.select("claim_number", *[F.round(f"{c}_te", 9).alias(f"{c}_te") for c in columns])


def _colours_and_channels(s):
    """The columns of the wide claims that the codes come from and go to, stored: fits and lookups read them, and the claims are
    joined once."""
    return stored(s.wide.select("claim_number", "claim_date", "subrogation", "vehicle_color", "channel"))


def label_encoded(s):
    """Codes fitted on months before the hold-out month; the claim's day of week and colour."""
    train, test = P.hold_out_split(_colours_and_channels(s), *HOLD_OUT)
    colours = P.label_codes([train, test], "vehicle_color")
    channels = P.label_codes([train.filter("channel <> 'Phone'")], "channel")
    coded = P.label_encode(test.select("claim_number", "vehicle_color", "channel"), colours, "vehicle_color")
    return P.label_encode(coded, channels, "channel")


def label_encoded_all(s):
    """Codes of every claim of both parts: colours fitted on both, channels on the training part. Some channels to
    encode are missing or respelled."""
    train, test = P.hold_out_split(_colours_and_channels(s), *HOLD_OUT)
    colours = P.label_codes([train, test], "vehicle_color")
    channels = P.label_codes([train], "channel")
    both = train.unionByName(test).select("claim_number", "vehicle_color", missed("channel", F.lower("channel")).alias("channel"))
    return P.label_encode(P.label_encode(both, colours, "vehicle_color"), channels, "channel")


def folds(s):
    """The fold of every claim: exact stratification."""
    dealt = P.stratified_folds(s.scored.select("claim_number", "y"), "claim_number", "y")
    return dealt.select("claim_number", "y", "fold")


def random_split(s):
    test = P.hash_split("claim_number", 20)
    return s.claim.select("claim_number", F.when(test, "test").otherwise("train").alias("part"))


def fold_means(s):
    """Five fold models' scores of three models, averaged per claim."""
    shift = (C("claim_number") % (C("fold") + 7)) / 100.0
    long = (
        s.scored.select("claim_number", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("fold"), *SCORES)
        .unpivot(["claim_number", "fold"], list(SCORES), "model", "p")
        .withColumn("p", C("p") + shift)
    )
    means = P.mean_of_folds(long, "claim_number")
    return means.withColumn("p", F.round("p", 9))


# --- evaluation --------------------------------------------------------------


def parts(s):
    """(train, test) of the scored claims."""
    return P.hold_out_split(s.scored, *HOLD_OUT, label="y")


def blended(s):
    weights = stored(V.blend_weights(s.scored, SCORES, "y"))
    held = V.blend(s.scored, weights, SCORES).withColumn("simple", V.simple_mean(SCORES))
    return held.select("claim_number", F.round("p", 9).alias("weighted"), F.round("simple", 9).alias("simple"))


def weights(s):
    return compared(V.blend_weights(s.scored, SCORES, "y"))


def sweep(s, grid):
    return V.threshold_sweep(s.scored, "p_a", "y", grid).select("step", "tp", "fp", "fn", F.round("f1", 9).alias("f1"))


def best(s, grid):
    return compared(V.best_threshold(V.threshold_sweep(s.scored, "p_a", "y", grid)))


def report(s):
    hit = s.scored.withColumn("pred", F.when(C("p_a") >= 0.4, 1).otherwise(0))
    return compared(V.classification_report(hit, "pred", "y"))


def auc(s):
    long = s.scored.unpivot(["y"], list(SCORES), "model", "p")
    return compared(V.roc_auc(long, "p", "y", by=["model"]))


def held_out_error(s):
    p = s.scored.select("claim_est_payout", (60000 - C("liab_prct") * 100).alias("guess"))
    m = V.regression_metrics(p, "claim_est_payout", "guess")
    return m.select(F.round("mse", 2).alias("mse"), F.round("r2", 9).alias("r2"), "n")


def predictions(s):
    train, test = parts(s)
    best_ = stored(V.best_threshold(V.threshold_sweep(train, "p_a", "y", V.SINGLE_GRID)))
    held = beside(test, best_.select("threshold"))
    return V.apply_threshold(held, "p_a", C("threshold")).select(
        "claim_number", F.round("p_a", 9).alias("subrogation_proba"), C("pred").alias("subrogation_pred")
    )


def positive_rate(s):
    return predictions(s).agg(F.round(F.avg("subrogation_pred"), 9).alias("positive_rate"))


def metrics(s):
    train, test = parts(s)
    return compared(V.metrics_row(train, test, "p_a", "y", n_features=27))


def metrics_as_json(s):
    row = metrics(s)
    path = scratch(s.spark, "metrics")
    files.write_json(row, path)
    return files.read_json(s.spark, path, row.schema)


def report_as_text(s):
    path = scratch(s.spark, "report")
    lines = V.report_lines(metrics(s))
    files.write_lines(lines.orderBy("line_number").select("value"), path)
    return s.spark.read.text(path).filter("value NOT LIKE '=%'")


def report_file_lines(s):
    """Every line of the report with its place in the file. A report is a dozen lines, so it is one file."""
    path = scratch(s.spark, "report")
    lines = V.report_lines(metrics(s)).coalesce(1).sortWithinPartitions("line_number")
    files.write_lines(lines.select("value"), path)
    content = F.split(F.regexp_replace("value", r"\n\z", ""), "\n")
    return s.spark.read.text(path, wholetext=True).select(F.posexplode(content).alias("line_number", "value"))


# --- triage ------------------------------------------------------------------


def scored_claims(s):
    """Claims as triage rows: recovery cost and assessments follow from the claim."""
    number = C("claim_number")
    return s.scored.select(
        "claim_number",
        F.when(number % 50 == 0, F.lit(None)).otherwise(C("p_a")).alias("prob"),
        C("claim_est_payout").alias("amount"),
        F.when(number % 13 == 0, 0.0).otherwise(1000.0 + number % 37 * 1500).alias("cost"),
        F.when(C("liab_prct") < 20, "clear").when(C("liab_prct") < 60, "medium").otherwise("unclear").alias("liability"),
        F.when(number % 3 == 0, "urgent").when(number % 3 == 1, "normal").otherwise("loose").alias("timing"),
    )


def _triage(*columns):
    def build(s):
        return T.triage(scored_claims(s)).select("claim_number", *columns)

    return build


def triage_reasons(s):
    t = T.triage(scored_claims(s))
    return t.select("claim_number", F.concat_ws(" | ", "reasons").alias("reasons"))


QUERIES = {
    "mp01": split,
    "mp02": target_encoded,
    "mp03": label_encoded,
    "mp03_all": label_encoded_all,
    "mp04": folds,
    "mp05": random_split,
    "mp07": fold_means,
    "ml07": blended,
    "ml07_weights": weights,
    "ml08_ensemble": lambda s: sweep(s, V.ENSEMBLE_GRID),
    "ml08_search": lambda s: sweep(s, V.SEARCH_GRID),
    "ml08_single": lambda s: sweep(s, V.SINGLE_GRID),
    "ml08": lambda s: best(s, V.ENSEMBLE_GRID),
    "ml09": report,
    "ml10": auc,
    "ml11": held_out_error,
    "ml13": predictions,
    "ml13_rate": positive_rate,
    "ml14": metrics,
    "snk04": metrics_as_json,
    "snk05": report_as_text,
    "snk05_lines": report_file_lines,
    "tri01": _triage("prob", "band", "band_label", "band_summary"),
    "tri02": _triage("expected", "roi"),
    "tri03": _triage("score", "priority", "action"),
    "tri04": triage_reasons,
    "tri06": _triage("expected_shown", "cost_shown", "roi_shown"),
}
