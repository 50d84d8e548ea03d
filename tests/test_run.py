"""The composed run: what it gives, and that a broken run goes on where it stopped."""

import pytest
from pyspark.sql import functions as F

from salvor.entries import training
from salvor.operators import classify as K
from salvor.operators import run as R
from salvor.session import scratch

NAMES = ["liab_prct", "has_witness", "has_police", "liab_cubed"]


def test_a_broken_run_goes_on_where_it_stopped(spark, star, monkeypatch):
    train, test = training.feature_frames(star, NAMES)
    folder, calls = scratch(spark, "run"), []
    real = {n: getattr(K, n) for n in ("search_parameters", "train_ensemble")}
    for name in real:
        monkeypatch.setattr(K, name, lambda *a, _n=name, **o: calls.append(_n) or real[_n](*a, **o))
    options = {"trials": 2, "k": 2, "trees": 30, "forest": 5, "fit_rows": 1000}
    monkeypatch.setattr(R.V, "blend_weights", lambda *a, **o: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        R.training_run(train, test, NAMES, NAMES, folder, **options)
    assert calls == ["search_parameters", "train_ensemble"]
    monkeypatch.undo()
    for name in real:
        monkeypatch.setattr(K, name, lambda *a, _n=name, **o: calls.append(_n) or real[_n](*a, **o))
    found = R.training_run(train, test, NAMES, NAMES, folder, **options)
    assert len(calls) == 2 and tuple(found) == R.STAGES  # the models are not trained again
    assert found["oof"].count() == train.count() and found["predictions"].count() == test.count()
    assert found["predictions"].filter("subrogation_proba between 0 and 1").count() == test.count()
    best = K.best_parameters(found["search"])
    assert best["maxDepth"] == found["search"].orderBy(F.desc("mean_f1"), "trial").first()["maxDepth"]
    assert found["boosted"].filter("grown <= 30").count() == 2
    assert found["report"].filter("value like '- Best threshold%'").count() == 1
    assert {r["class"] for r in found["classes"].collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
