"""Training reads its table three times, so queries hand it a stored one."""

import random

import pytest

from tarifa.fixed_values import FEATURES
from tarifa.operators import training
from tarifa.plans import queries
from tarifa.plans.tables import Tables


@pytest.fixture
def trained(spark, monkeypatch):
    """The plans of the tables that were trained on, over a marked table that is costly to read."""
    rng, plans, fit = random.Random(5), [], training.fit
    values = [[float(rng.randrange(6)) for _ in FEATURES] for _ in range(300)]
    rows = [(*v, 3 * v[0] + v[1], i % 5 == 0) for i, v in enumerate(values)]
    columns = ", ".join(f"{f} double" for f in FEATURES)
    table = spark.createDataFrame(rows, f"{columns}, total_fare double, is_test boolean").repartition(2, "airline_code")

    def small(encoded, regressor):
        plans.append(encoded._jdf.queryExecution().optimizedPlan().toString())
        return fit(encoded, regressor.copy({regressor.maxIter: 2, regressor.maxDepth: 2}))

    monkeypatch.setattr(queries, "_marked", lambda t: table)
    monkeypatch.setattr(training, "fit", small)
    return plans


def stored(plan):
    return "parquet" in plan and not any(step in plan for step in ("Repartition", "Window", "Join", "Exchange"))


def test_small_model(spark, trained):
    queries._small_model(Tables(spark, ""))
    assert len(trained) == 1 and all(map(stored, trained))


def test_blend(spark, trained):
    found = queries.train_blend(Tables(spark, "")).collect()
    assert len(found) == 4 and all(r["rows_scored"] == 60 for r in found)
    assert len(trained) == 2 and all(map(stored, trained))
