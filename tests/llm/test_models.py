"""Language and quality models against plain computations, and on labels they have not seen; packing by its rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salvor.llm import langid, packing, quality
from salvor.llm.common import remainder4, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents")


def test_language_model_is_the_plain_kernel_ridge(docs):
    model = langid.fit(docs, per_language=20, landmarks=24)
    grams = langid.Grams()
    sample = langid.training_rows(docs, 20).orderBy("key").collect()
    sets = [set(grams.places(r["text"]).tolist()) for r in sample]
    other = [(r["text"], set(grams.places(r["text"]).tolist())) for r in docs.filter("text rlike '[a-zA-Z]'").limit(40).collect()]

    def kernel(left, right):
        return np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in right] for a in left])

    marks = sets[:24]
    c, k = kernel(marks, marks), kernel(sets, marks)
    values, vectors = np.linalg.eigh(c)
    root = vectors / np.sqrt(values)
    x = np.column_stack([k @ root, np.ones(len(sets))])
    goal = np.array([[1.0 if r["lang"] == name else -1.0 for name in model.languages] for r in sample])
    penalty = langid.RIDGE * len(sets) / x.shape[1] * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(x.T @ x + penalty, x.T @ goal)
    scores = np.column_stack([kernel([s for _, s in other], marks) @ root, np.ones(len(other))]) @ weights
    predicted, got = model.predict([t for t, _ in other], grams)
    assert [model.languages[i] for i in scores.argmax(axis=1)] == predicted
    assert np.allclose(np.clip((1 + scores.max(axis=1)) / 2, 0, 1), got, atol=1e-2)  # rows and weights are single precision


def test_languages_of_unseen_documents(spark, docs):
    found = langid.query(spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null and lang_pred <> 'und'")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right >= 0.95


def test_quality_weights_are_the_optimum_of_the_pairwise_loss(spark, docs):
    labels = table(spark, FOLDER, "labels")
    model = quality.fit(docs, labels)
    x, y = quality.measured_sample(docs, labels, quality.TRAIN_ROWS)
    z = quality._expanded(x, model["centre"], model["scale"])
    good, bad = np.nonzero(y == 1)[0], np.nonzero(y == 0)[0]
    picks = np.random.default_rng(7)
    won = np.concatenate([np.repeat(good, quality.PAIRS), picks.choice(good, quality.PAIRS * len(bad))])
    lost = np.concatenate([picks.choice(bad, quality.PAIRS * len(good)), np.repeat(bad, quality.PAIRS)])

    def loss(w):
        return np.mean(np.logaddexp(0, -(z[won] - z[lost]) @ w)) + quality.RIDGE / 2 * w @ w

    best, w = loss(model["weight"]), model["weight"]
    for i in range(len(w)):
        step = np.zeros_like(w)
        step[i] = 1e-4
        assert abs(loss(w + step) - loss(w - step)) / 2e-4 < 1e-6
        assert loss(w + step) >= best and loss(w - step) >= best
    assert model["cut"] == pytest.approx(np.quantile(z @ w, (y == 0).mean()))


def test_quality_learns_from_every_labelled_row(spark, monkeypatch):
    """Many buckets, a rare label, and no more rows of a label than TRAIN_ROWS before."""
    monkeypatch.setattr(quality, "TRAIN_ROWS", 20)
    monkeypatch.setattr(quality, "BUCKET_ROWS", 64)
    docs = spark.range(600).selectExpr("id as doc_id", "concat(repeat('good words here. ', 3 + id % 7), if(id % 10 = 0, '| 7 |', '')) as text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 10 <> 0 as int) as quality")
    features = quality.measured(docs)
    x, y = quality.measured_sample(docs, labels, 10_000)
    model = quality.fit_measured(features, labels)
    assert np.allclose(model["centre"], x.mean(axis=0)) and len(y) > 400
    rows = quality.labelled(features, labels)
    buckets = quality.dealt(rows, quality._sizes(rows)).toPandas()
    own = np.concatenate([np.frombuffer(b, bool) for b in buckets["own"]])
    assert own.sum() == len(y) and len(buckets) == -(-len(y) // 64)
    assert all(set(np.frombuffer(b)) == {0.0, 1.0} for b in buckets["y"])
    raw = (quality._expanded(x, model["centre"], model["scale"]) * model["weight"]).sum(axis=1)
    assert model["cut"] == pytest.approx(np.quantile(raw, (y == 0).mean()))


def test_quality_of_unseen_documents(spark, docs):
    labels = table(spark, FOLDER, "labels").filter(remainder4(F.col("doc_id")) == 2)
    found = quality.query(spark, FOLDER).join(labels, "doc_id")
    assert found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] >= 0.85


def test_windows_take_the_best_fit():
    pick = np.random.default_rng(2)
    sizes = pick.integers(1, 130, 400).tolist()
    windows = packing.Windows(100, 5, 10, 0)
    rooms, closed = {}, 0  # by hand: window -> room
    for doc, size in enumerate(sizes):
        before = dict(rooms)
        out = list(windows.put(doc, size, bytes(4 * size)))
        held = {w: 100 - sum(p[2] for p in pieces) for w, pieces in windows.held.items()}
        pieces = [p for part in out for p in part if p[0] == doc] + [p for part in windows.held.values() for p in part if p[0] == doc]
        assert sum(p[2] for p in pieces) == size
        rest = size % 100
        if rest and any(r >= rest for r in before.values()):
            # The whole rest lies where the least room was left.
            (last,) = [p for p in pieces if p[2] < 100 or p[1] + p[2] == size and p[2] == rest]
            assert before[last[4]] == min(r for r in before.values() if r >= rest)
        rooms = held
        assert len(held) <= 5
        closed += len(out)
    assert closed > 100
