"""The composed training run: search, tuned ensemble, threshold, predictions, reports, stage by stage.

Every stage is a table below the run's folder. Spark marks a table that was written to its end, so a run that broke
goes on with its first unfinished stage, and a finished run is only read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.operators import classify as K
from salvor.operators import evaluate as V
from salvor.operators.sizes import beside

C = F.col
STAGES = ("search", "boosted", "oof", "test", "weights", "threshold", "metrics", "classes", "predictions", "report")


def finished(spark: SparkSession, path: str) -> bool:
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def stage(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table of a stage; it is built, and what a broken attempt left replaced, only if it is not finished."""
    path = f"{folder.rstrip('/')}/{name}"
    if not finished(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def training_run(
    train: DataFrame,
    test: DataFrame,
    search_features: Sequence[str],
    features: Sequence[str],
    folder: str,
    *,
    trials: int = 20,
    k: int = 5,
    trees: int = 1000,
    forest: int = 100,
    fit_rows: int | None = None,
) -> dict[str, DataFrame]:
    """The tables of all STAGES by name.

    The best trial of the search gives the boosted learner's parameters; the ensemble's scores out of fold give the
    weights and the threshold, and with these the hold-out rows are predicted and both parts reported.
    """
    spark, found = train.sparkSession, {}
    made: list[K.Ensemble] = []

    def run(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        found[name] = stage(spark, folder, name, build)
        return found[name]

    search = run("search", lambda: K.search_parameters(train, search_features, trials=trials, k=k, trees=trees, fit_rows=fit_rows))

    def ensemble() -> K.Ensemble:
        """Trained once, for whichever of its tables is missing."""
        if not made:
            models = K.learners(trees=trees, forest=forest, boosting=K.best_parameters(search))
            made.append(K.train_ensemble(train, test, features, models, k=k, fit_rows=fit_rows))
        return made[0]

    names = [m.name for m in K.learners()]
    run("boosted", lambda: ensemble().boosted)
    oof = run("oof", lambda: ensemble().oof)
    held = run("test", lambda: ensemble().test)
    weights = run("weights", lambda: V.blend_weights(oof, names, K.LABEL))
    blended = V.blend(oof, weights, names)
    threshold = run("threshold", lambda: V.best_threshold(V.threshold_sweep(blended, "p", K.LABEL, V.ENSEMBLE_GRID)))
    scored = V.blend(held, weights, names)
    run("metrics", lambda: V.metrics_row(blended, scored, "p", K.LABEL, len(features), V.ENSEMBLE_GRID))
    marked = V.apply_threshold(beside(blended, threshold.select("threshold")), "p", C("threshold"))
    run("classes", lambda: V.classification_report(marked, "pred", K.LABEL))
    predicted = V.apply_threshold(beside(scored, threshold.select("threshold")), "p", C("threshold"))
    run("predictions", lambda: predicted.select(K.KEY, C("p").alias("subrogation_proba"), C("pred").alias("subrogation_pred")))
    run("report", lambda: V.report_lines(found["metrics"], {"Predictions": f"{folder}/predictions"}))
    return found
