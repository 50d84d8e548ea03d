"""Splits, encodings, oversampling, learners."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salvor.entries import training
from salvor.functions.scalars import digest_below
from salvor.operators import classify as K
from salvor.operators import evaluate as V
from salvor.operators import prep as P
from salvor.operators import regress as R
from salvor.operators import smote as M


def test_unseen_categories_take_the_overall_mean(spark):
    train = spark.createDataFrame([("A", 1), ("B", 0), ("A", 1), ("B", 0)], "cat string, subrogation int")
    val = spark.createDataFrame([("C", 1), ("D", 1), (None, 1)], "cat string, subrogation int")
    seen, unseen = P.target_encode(train, [train, val], ["cat"])
    assert {r["cat_te"] for r in unseen.collect()} == {0.5}
    assert {r["cat"]: r["cat_te"] for r in seen.collect()} == {
        "A": pytest.approx((2 + 15) / 32), "B": pytest.approx(15 / 32)}


def test_label_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "c string")
    codes = P.label_codes([df.filter("c <> 'c'")], "c")
    coded = P.label_encode(df, codes, "c", "code", keep_missing=True)
    assert {r["c"]: r["code"] for r in coded.collect()} == {"a": 0, "b": 1, "c": 2, None: None}


@pytest.mark.parametrize("k", [2, 5])
def test_folds_are_even_per_class_and_repeatable(spark, k):
    df = spark.range(1003).withColumn("y", (F.col("id") % 7 == 0).cast("int"))
    first = P.stratified_folds(df, "id", "y", k)
    sizes = [r["n"] for r in first.filter("y = 1").groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == k and max(sizes) - min(sizes) <= 1
    again = P.stratified_folds(df.repartition(7), "id", "y", k)
    assert first.exceptAll(again.select(first.columns)).count() == 0
    other = P.stratified_folds(df, "id", "y", k, seed=1)
    assert first.exceptAll(other.select(first.columns)).count() > 0


def test_hash_split_is_apart_from_the_label_noise(spark):
    df = spark.range(20_000).withColumn("flipped", digest_below(F.col("id"), "label", 10).cast("int"))
    held = df.groupBy(P.hash_split("id", 20).alias("held")).agg(F.count("*").alias("n"), F.avg("flipped").alias("share"))
    got = {r["held"]: r for r in held.collect()}
    assert abs(got[True]["n"] / 20_000 - 0.2) < 0.01
    assert abs(got[True]["share"] - 0.1) < 0.015 and abs(got[False]["share"] - 0.1) < 0.01


def test_every_fold_gets_synthetic_rows(star):
    train = star.scored.select("claim_number", F.col("y").alias("subrogation"), "liab_prct", "claim_est_payout")
    data = P.stratified_folds(train, "claim_number", "subrogation")
    for fold in range(5):
        rows = data.filter(F.col("fold") != fold)
        n = {r["subrogation"]: r["count"] for r in rows.groupBy("subrogation").count().collect()}
        grown = M.smote(rows, "claim_number", "subrogation", ["liab_prct", "claim_est_payout"], ratio=0.5)
        assert grown.filter("synthetic = 1").count() == int(0.5 * n[0] - n[1]) > 0


def test_december_hold_out(spark):
    df = spark.sql("SELECT timestamp_ntz'2000-12-31 23:59:59' AS claim_date, 1 AS subrogation UNION ALL "
                   "SELECT timestamp_ntz'2001-01-01 00:00:00', 1 UNION ALL SELECT null, 0 UNION ALL SELECT null, null")
    train, test = P.hold_out_split(df, 2000, 12)
    assert (train.count(), test.count()) == (2, 1)


def test_neighbours_are_exact(spark, monkeypatch):
    """Many small tiles, and a third of the points in one place."""
    monkeypatch.setattr(M, "TILE", 60)
    monkeypatch.setattr(M, "VISITORS", 50)
    rng = np.random.default_rng(1)
    n = 900
    x = np.column_stack([rng.integers(0, 4, n) * 100.0, rng.normal(0, 50, n), rng.exponential(30, n), rng.normal(0, 1, n)])
    x[:300] = x[0]
    points = spark.createDataFrame([(g, i, v) for g in (0, 3) for i, v in enumerate(x.tolist())], "group int, key long, v array<double>")
    both = M.neighbours(points, [0, 1, 2], 5).toPandas().sort_values(["key", "rank"])
    found = both[both["group"] == 0]
    # Groups stand side by side.
    assert np.allclose(found["distance"].to_numpy(), both[both["group"] == 3]["distance"].to_numpy())
    assert (found["key"] != found["other"]).all()
    d = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert np.allclose(found["distance"].to_numpy().reshape(n, 5), np.sort(d, axis=1)[:, :5], atol=1e-9)


def test_oversampling_counts_and_bounds(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(i < 40), float(rng.normal()), float(rng.normal())) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    grown = M.smote(df, "id", "y", ["a", "b"]).toPandas()
    assert (grown["y"] == 1).sum() == 100 and (grown["y"] == 0).sum() == 200
    old, new = grown[(grown.y == 1) & (grown.synthetic == 0)], grown[grown.synthetic == 1]
    assert (new[["a", "b"]].min() >= old[["a", "b"]].min()).all()
    assert (new[["a", "b"]].max() <= old[["a", "b"]].max()).all()
    # enough minority already: nothing is added
    assert M.smote(df, "id", "y", ["a", "b"], ratio=0.1).count() == 240
    # fewer minority rows than neighbours wanted
    few = df.filter("id < 3 OR id >= 40")
    assert M.smote(few, "id", "y", ["a", "b"]).filter("y = 1").count() == 100


def test_no_positive_scores_keep_the_default_threshold(spark):
    df = spark.createDataFrame([(0.1, 1), (0.15, 0)], "p double, y int")
    best = V.best_threshold(V.threshold_sweep(df, "p", "y", V.ENSEMBLE_GRID)).first()
    assert (best["threshold"], best["f1"]) == (0.3, 0.0)


def test_thresholds_compare_exactly(spark):
    grid = V.ENSEMBLE_GRID
    scores = [t + d for t in grid.thresholds for d in (-1e-17, 0.0, 1e-16, -1e-16)] + [0.0, 1.0]
    df = spark.createDataFrame([(p,) for p in scores], "p double")
    got = [r[0] for r in df.select(V.thresholds_reached(F.col("p"), grid)).collect()]
    assert got == [sum(p >= t for t in grid.thresholds) for p in scores]


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.9, 1), (0.1, 0)], "p double, y int")
    assert V.roc_auc(df, "p", "y").first()["auc"] == 0.875


def test_auc_of_scores_within_a_millionth(spark):
    df = spark.range(4000).selectExpr("0.5 + id * 1e-10 as p", "cast(id >= 1000 and id % 2 = 1 as int) as y", "id % 3 as g")
    for part in (df, df.filter("g = 1")):
        negatives, below = 0, 0
        for r in part.orderBy("p").collect():
            below += negatives * r["y"]
            negatives += 1 - r["y"]
        auc = below / (negatives * part.filter("y = 1").count())
        assert abs(V.roc_auc(part, "p", "y").first()["auc"] - auc) < 1e-12
    assert V.roc_auc(df, "p", "y", by=["g"]).count() == 3


def test_report_shows_missing_test_metrics(spark):
    row = spark.createDataFrame(
        [(0.5, 0.6, None, None, 0.32, 27)],
        "train_f1 double, train_auc double, test_f1 double, test_auc double, best_threshold double, n_features int",
    )
    text = [r["value"] for r in V.report_lines(row).orderBy("line_number").collect()]
    assert "- Test AUC: N/A" in text and "- Best threshold: 0.320" in text


def test_single_model_learns(spark, star):
    row = training.single_metrics(star).first()
    assert row["n_features"] == 27 and all(row[c] for c in row.asDict())


def test_fold_encodings_are_those_of_each_training_part(spark):
    rows = [(i, "abc"[i % 3] if i % 7 else None, "xy"[i % 2], int(i % 4 == 0), i % 5) for i in range(60)]
    rows.append((99, "once", "x", 1, 2))
    data = spark.createDataFrame(rows, "id long, a string, b string, y int, fold int")
    table, means = P.fold_encodings(data, ["a", "b"], "y", 5)
    got = {(r["column"], r["value"]): r["te"] for r in table.collect()}
    for fold in range(5):
        train = data.filter(F.col("fold") != fold)
        (seen,) = P.target_encode(train, [data], ["a", "b"], "y")
        for r in seen.collect():
            for c in ("a", "b"):
                te = got[c, r[c]][fold] if r[c] is not None else means.first()[0][fold]
                assert te == pytest.approx(r[f"{c}_te"])


def test_codes_of_all_columns_together(spark):
    one = spark.createDataFrame([("b", "y"), ("a", None)], "c string, d string")
    two = spark.createDataFrame([("c", "x")], "c string, d string")
    codes = P.codes_together([one, two], ["c", "d"])
    assert {(r["column"], r["value"], r["code"]) for r in codes.collect()} == {("c", "a", 0), ("c", "b", 1), ("c", "c", 2), ("d", "x", 0), ("d", "y", 1)}
    unseen = spark.createDataFrame([("zz", "x"), (None, "y")], "c string, d string")
    assert {tuple(r) for r in P.coded_together(unseen, codes, ["c", "d"]).collect()} == {(3, 0), (3, 1)}


def test_logit_recovers_coefficients(spark):
    rng = np.random.default_rng(5)
    n = 4000
    liab, key, police, safety = rng.uniform(0, 1, n), rng.integers(0, 3, n), rng.integers(0, 2, n), rng.uniform(0, 1, n)
    z = -0.5 + 1.5 * liab - 0.5 * safety + 1.0 * liab * safety
    y = (rng.uniform(0, 1, n) < 1 / (1 + np.exp(-z))).astype(float)
    rows = list(zip(y.tolist(), liab.tolist(), key.tolist(), police.tolist(), safety.tolist()))
    df = spark.createDataFrame(rows, "subrogation double, liab_prct double, accident_key int, policy_report_filed_ind int, safety_rating double")
    got = {r["term"]: r for r in R.logistic_regression(df).collect()}
    assert abs(got["liab_prct"]["coef"] - 1.5) < 4 * got["liab_prct"]["std_err"]
    assert abs(got["liab_prct:safety_rating"]["coef"] - 1.0) < 4 * got["liab_prct:safety_rating"]["std_err"]
    assert 0 < got["const"]["pseudo_r2"] < 1


def test_search_draws_stay_in_range():
    for draw in K.draw_parameters(30):
        for name, (low, high, _) in K.SEARCH_SPACE.items():
            assert low <= draw[name] <= high
    assert K.draw_parameters(3) == K.draw_parameters(3)


def test_small_ensemble(star):
    train, test = training.feature_frames(star, ["liab_prct", "has_witness", "has_police", "liab_cubed"])
    models = K.learners(30, 3, forest=5)
    oof, held, _ = K.train_ensemble(train, test, ["liab_prct", "has_witness", "has_police", "liab_cubed"], models, k=2)
    assert oof.count() == train.count() and held.count() == test.count()
    row, predictions = K.weighted_ensemble(oof, held, [m.name for m in models])
    r = row.first()
    assert sum(r[f"w_{m.name}"] for m in models) == pytest.approx(1.0)
    assert r["oof_auc"] > 0.6 and predictions.count() == test.count()


def test_slices_follow_the_widest_side():
    assert M.slices([100.0, 1.0, 0.0], 8) == [8, 1, 1]
    assert M.slices([10.0, 10.0], 16) == [4, 4]
    assert M.slices([0.0, 0.0], 16) == [1, 1]


def test_folds_share_one_search(spark, monkeypatch):
    """Points of three folds, two columns of their own in each: neighbours are those of each fold alone, and a point goes
    through the tiles once."""
    monkeypatch.setattr(M, "TILE", 60)
    monkeypatch.setattr(M, "VISITORS", 50)
    rng = np.random.default_rng(4)
    n, folds, sizes = 700, 3, []
    x = np.column_stack([rng.integers(0, 4, n) * 20.0, rng.normal(0, 50, n), rng.exponential(30, n)])
    x[:200] = x[0]
    te, member = rng.normal(0, 3, (n, folds, 2)), np.arange(n)[:, None] % folds != np.arange(folds)
    member[650:, 1] = False
    rows = [(7, i, x[i].tolist(), te[i].ravel().tolist(), member[i].tolist()) for i in range(n)]
    points = spark.createDataFrame(rows, "group int, key long, v array<double>, te array<double>, member array<boolean>")
    keep = M.stored
    monkeypatch.setattr(M, "stored", lambda df: sizes.append(keep(df)) or sizes[-1])
    found = M.neighbours(points, [0, 1, 2], 4).toPandas().sort_values(["group", "key", "rank"])
    assert max(s.count() for s in sizes if "v" in s.columns) == n
    for f in range(folds):
        at = np.nonzero(member[:, f])[0]
        seen = np.concatenate([x[at], te[at, f]], axis=1)
        d = np.sqrt(((seen[:, None, :] - seen[None]) ** 2).sum(2))
        np.fill_diagonal(d, np.inf)
        own = found[found["group"] == f]
        assert (own["key"].to_numpy().reshape(len(at), 4)[:, 0] == at).all()
        assert np.allclose(own["distance"].to_numpy().reshape(len(at), 4), np.sort(d, axis=1)[:, :4], atol=1e-9)


def test_new_points_of_a_fold_lie_between_its_members(spark):
    n = 40
    rows = [(1, i, [float(i)], [10.0 * i, -10.0 * i], [i < 30, i >= 10]) for i in range(n)]
    points = spark.createDataFrame(rows, "group int, key long, v array<double>, te array<double>, member array<boolean>")
    made = M.synthetic_points(points, {0: (30, 50), 1: (30, 7)}).toPandas()
    assert made.groupby("group").size().to_dict() == {0: 50, 1: 7}
    for group, x in zip(made["group"], made["x"]):
        assert 0 <= x[0] <= 29 if group == 0 else 10 <= x[0] <= 39
        assert np.isclose(x[1], (10 if group == 0 else -10) * x[0])


def test_a_missing_value_leaves_its_block_without_new_points(spark):
    rows = [(i, int(i < 20), float(i), None if i == 3 else 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    assert M.smote(df, "id", "y", ["a", "b"]).filter("synthetic = 1").count() == 0


def test_new_rows_of_a_fold_have_its_encodings(spark):
    """The encodings of column c in fold f are 100 f + c, so those of a synthetic row say which were taken."""
    k, columns = 3, 4
    te = [[100.0 * f + c for f in range(k)] for c in range(columns)]
    rows = [(i, int(i % 6 == 0), i % k if i % 6 else (i // 6) % k, [float(i)], te) for i in range(240)]
    data = spark.createDataFrame(rows, "claim_number long, subrogation int, fold int, x array<double>, te array<array<double>>")
    made = K.oversampled(data, k, 0.5).collect()
    assert {r["model"] for r in made} == set(range(k))
    assert all(r["x"][1:] == [100.0 * r["model"] + c for c in range(columns)] for r in made)


def test_a_search_fits_all_rows(spark, monkeypatch):
    """Every training part goes whole, with its fold to watch, and no sample is asked for."""
    rng, asked = np.random.default_rng(7), []
    x = rng.normal(size=5200)
    rows = [(i, int(rng.random() < 1 / (1 + np.exp(-v))), float(v)) for i, v in enumerate(x)]
    train = spark.createDataFrame(rows, "claim_number long, subrogation int, a double")
    fit = K.fit_boosted
    monkeypatch.setattr(K, "fit_boosted", lambda rows, jobs, **o: asked.append((rows.filter("not watch").count(), rows.filter("watch").count(), o)) or fit(rows, jobs, **o))
    found = K.search_parameters(train, ["a"], trials=1, k=2, trees=2).first()
    assert found["grown"] == 2.0 and 0 < found["mean_f1"] <= 1
    # Labels are even, so no synthetic rows are wanted.
    assert asked == [(5200, 5200, {"fit_rows": None})]
