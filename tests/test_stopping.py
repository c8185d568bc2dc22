"""Early stopping by patience: the rule, the cut model, and a run that overfits."""

import random

import pytest
from pyspark.sql import functions as F

from tarifa.fixed_values import FEATURES
from tarifa.operators import stopping, training
from tarifa.plans.queries import QUERIES
from tarifa.plans.tables import Tables
from tarifa.session import new_path, save

NAN = float("nan")


@pytest.mark.parametrize("losses, patience, wanted", [
    ([5, 4, 3, 2], 2, (4, False)), ([5, 4, 4.5, 4.2, 1], 2, (2, True)), ([5, 4, 4.5, 3, 3.5, 3.2], 2, (4, True)),
    ([1, 1, 1], 2, (1, True)), ([1, 1], 2, (1, False)), ([2], 1, (1, False)), ([NAN, 3, NAN, NAN], 2, (2, True)), ([3, 2], 50, (2, False)),
])
def test_rule(losses, patience, wanted):
    assert stopping.best_round(losses, patience) == wanted


@pytest.fixture(scope="module")
def marked(spark):
    """A fare that depends on two features, with noise that a deep tree learns by heart."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        values = [float(rng.randrange(20)) for _ in FEATURES]
        rows.append((*values, 3 * values[0] + values[1] ** 2 / 5 + rng.gauss(0, 25), i % 5 == 0))
    columns = ", ".join(f"{f} double" for f in FEATURES)
    return save(spark.createDataFrame(rows, f"{columns}, total_fare double, is_test boolean").repartition(2), "marked")


def error(model, rows):
    scored = training.score(model, rows)
    return scored.agg(F.avg((F.col("prediction") - F.col("total_fare")) ** 2)).first()[0]


def test_stops_and_goes_back(spark, marked):
    found = stopping.fit_with_patience(marked, rounds=40, patience=4, depth=5, rate=0.4)
    assert len(found.losses) == found.best + 4 < 40
    assert found.losses[found.best - 1] == min(found.losses)
    assert found.model.stages[-1].getNumTrees == found.best
    held_out = marked.where("is_test")
    assert error(found.model, held_out) == pytest.approx(min(found.losses), rel=1e-9)
    # The same rounds, asked for directly.
    direct = training.fit(marked.where("NOT is_test").drop("is_test"), training.boosted_trees(trees=found.best, depth=5, rate=0.4))
    assert error(direct, held_out) == pytest.approx(min(found.losses), rel=1e-9)
    table = found.table(spark).collect()
    assert [r["boosting_round"] for r in table if r["used"]] == list(range(1, found.best + 1)) and len(table) == len(found.losses)


def test_cut_model_is_stored_and_ranked(spark, marked):
    found = stopping.fit_with_patience(marked, rounds=6, patience=3, depth=3, rate=0.3)
    path, codes = new_path(spark, "model"), spark.createDataFrame([("a", "b", 0)], "feature string, value string, code int")
    training.save_model(found.model, codes, path)
    again, _ = training.load_model(spark, path)
    assert error(again, marked) == pytest.approx(error(found.model, marked), rel=1e-12)
    ranks = training.feature_importance(spark, found.model, 23).collect()
    assert len(ranks) == len(FEATURES) and {r["feature"] for r in ranks[:2]} == set(FEATURES[:2])


def test_without_marked_rows_all_rounds_count(marked):
    found = stopping.fit_with_patience(marked.withColumn("is_test", F.lit(False)), rounds=4, patience=1, depth=2)
    assert found.losses == [] and found.best == 4 and found.model.stages[-1].getNumTrees == 4


def test_rounds_outside_the_model(marked):
    model = training.fit(marked.drop("is_test"), training.boosted_trees(trees=2, depth=2)).stages[-1]
    for rounds in (0, 3):
        with pytest.raises(ValueError):
            stopping.first_rounds(model, rounds)


@pytest.mark.parametrize("name, depths", [("train_gbt", [10]), ("train_ensemble", [10, 3, 10])])
def test_queries_ask_for_the_whole_models(spark, monkeypatch, marked, name, depths):
    """Boosting may take 1,500 rounds and stops after 50 without gain, a forest has 100 trees. The fits are cut here, so that no run stops."""
    asked, fit, best_round, patiences = [], training.fit, stopping.best_round, set()

    def short(encoded, regressor):
        rounds = regressor.hasParam("maxIter")
        trees = regressor.getMaxIter() if rounds else regressor.getNumTrees()
        asked.append((regressor.getMaxDepth(), trees))
        return fit(encoded, regressor.copy({regressor.maxIter if rounds else regressor.numTrees: 2, regressor.maxDepth: 3}))

    monkeypatch.setattr("tarifa.plans.queries._marked", lambda t: marked)
    monkeypatch.setattr(training, "fit", short)
    monkeypatch.setattr(stopping, "best_round", lambda losses, patience: (patiences.add(patience), best_round(losses, patience))[1])
    found = QUERIES[name](Tables(spark, "")).collect()
    assert all(r["rows_scored"] == 80 and r["better_than_mean"] for r in found) and patiences == {50}
    most = [max(t for d, t in asked if d == depth) for depth in depths]
    assert most == [1500] * len(most) and (name == "train_gbt" or asked[-1] == (10, 100))
