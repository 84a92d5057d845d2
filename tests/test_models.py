"""Boosting: the registered queries' rounds, and the early stop against a fit of all rounds."""
import pytest

from velocube import catalog
from velocube.operators import models as M


class _Asked(Exception):
    pass


@pytest.mark.parametrize("query,rounds", [("train_gbt", 1000), ("score", 1000), ("forecast_gbt", 1000),
                                          ("train_gbt_lags", 100), ("train_gbt_multi", 100), ("train_reduced", 100)])
def test_registered_rounds(query, rounds, monkeypatch):
    def asked(train, valid=None, max_iter=50, depth=5, patience=50, early_stop=True, **_):
        raise _Asked(max_iter, depth, patience, early_stop and valid is not None)

    monkeypatch.setattr(M, "train_gbt", asked)
    monkeypatch.setattr(catalog, "_split", lambda spark, d: ("train", "test"))
    with pytest.raises(_Asked) as e:
        catalog.QUERIES[query](None, None)
    assert e.value.args == (rounds, 5, 50, rounds == 1000)


def test_stop_round():
    assert M.stop_round([5.0, 4.0, 3.0], 2) == (3, False)
    assert M.stop_round([5.0, 3.0, 4.0, 3.0, 1.0], 2) == (2, True)
    assert M.stop_round([5.0, 3.0, 4.0, 2.0, 2.0, 2.0], 2) == (4, True)


def test_stops_early_with_the_trees_of_a_full_fit(spark, monkeypatch):
    rows = [(float(k % 7), float(k % 3), float((k % 7) * (k % 3) + (k * 37 % 11))) for k in range(120)]
    df = spark.createDataFrame(rows, "a double, b double, total_trips double")
    tr, te = df.limit(90), df.subtract(df.limit(90))
    full, _ = M.train_gbt(tr, None, ["a", "b"], (), max_iter=48, step=0.4, depth=2, early_stop=False)
    held = full.stages[0].transform(M.cast_inputs(te, ["a", "b"]))
    errors = full.stages[-1].evaluateEachIteration(held, "absolute")
    fits = []
    fit = M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, d, *a: fits.append(self.getMaxIter()) or fit(self, d, *a))
    model, rounds = M.train_gbt(tr, te, ["a", "b"], (), max_iter=48, step=0.4, depth=2, patience=3)
    assert (rounds, fits[-1] < 48) == M.stop_round(errors, 3) and fits[0] == 4
    assert model.stages[-1].getNumTrees == rounds
    for mine, whole in zip(model.stages[-1].trees, full.stages[-1].trees):
        assert mine.toDebugString.split("\n", 1)[1] == whole.toDebugString.split("\n", 1)[1]
