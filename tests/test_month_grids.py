"""Quantiles from counts per month against sorting, and the months they read."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarifa.operators import month_grids, quantiles
from tarifa.session import new_path, save

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def sorted_quantile(values, share):
    values = sorted(values)
    at = share * (len(values) - 1)
    low, high = float(values[int(at)]), float(values[min(int(at) + 1, len(values) - 1)])
    return low + (at - int(at)) * (high - low)


def stored(spark, rows, kind):
    path = new_path(spark, "months")
    spark.createDataFrame(rows, f"month string, x {kind}").write.partitionBy("month").parquet(path)
    return spark.read.schema(f"x {kind}, month string").parquet(path)


def cases():
    rng = random.Random(10)
    money = lambda: Decimal(rng.randrange(1, 90_000)) / 100
    yield "decimal(10,2)", [(f"m{i % 5}", money()) for i in range(400)] + [("m1", None), ("m1", Decimal(0)), ("m2", Decimal(-7))]
    yield "int", [(f"m{i % 3}", rng.randrange(-50, 50)) for i in range(300)] + [("m9", None)]
    wild = [rng.choice([0.0, -1e-300, 5e-324, 1.7e308, -1.7e308, rng.gauss(0, 1), float("nan"), float("inf")]) for _ in range(200)]
    yield "double", [(f"m{i % 4}", x) for i, x in enumerate(wild)]
    yield "int", [("m0", 7)] * 50
    yield "double", [("m0", 2.5)]


@pytest.mark.parametrize("kind, rows", list(cases()))
def test_against_sorting(spark, kind, rows):
    table = stored(spark, rows, kind)
    grid = save(month_grids.month_counts(table, ["x"], "month"), "grid")
    values = [v for _, v in rows if v is not None and float(v) == float(v) and abs(float(v)) != float("inf")]
    wanted = [sorted_quantile(values, s) for s in SHARES]
    assert month_grids.exact(table, grid, "x", SHARES, "month") == pytest.approx(wanted, rel=1e-12)
    finite = table.where(month_grids.cell(F.col("x")).isNotNull())
    assert month_grids.exact(table, grid, "x", SHARES, "month", "nearest") == quantiles.quantiles(finite, "x", SHARES, "nearest")
    near = month_grids.approximate(grid, "x", SHARES)
    nearest = quantiles.quantiles(finite, "x", SHARES, "nearest")
    assert all(abs(a - b) <= 0.0101 * abs(b) + 1e-320 for a, b in zip(near, nearest))


def test_cells_rise_with_values(spark):
    values = sorted([0.0, 5e-324, 1e-9, 0.999, 1.0, 1.005, 1.01, 1.0100001, 2.0, 1e300, -5e-324, -1.0, -1.02, -1e300])
    df = spark.createDataFrame([(v,) for v in values], "x double")
    cells = [r["c"] for r in df.select("x", month_grids.cell(F.col("x")).alias("c")).orderBy("x").collect()]
    assert cells == sorted(cells)
    for value, number in zip(values, cells):
        low, high = month_grids.bounds(number)
        assert low <= value <= high or abs(value) < 1e-300


def test_months_without_the_quartile_are_not_read(spark):
    table = stored(spark, [("low", i) for i in range(1, 101)] + [("high", 1000 + i) for i in range(1000)], "int")
    grid = save(month_grids.month_counts(table, ["x"], "month"), "grid")
    median = [c for c in grid.where("month = 'high'").select("cell").distinct().collect()][:2]
    rows = month_grids.rows_of_cells(table, grid, "x", [r["cell"] for r in median], "month")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "high" in plan.split("PartitionFilters: [")[1].split("]")[0] and "low" not in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(x," in plan
    assert month_grids.exact(table, grid, "x", [0.5], "month") == [sorted_quantile([*range(1, 101), *range(1000, 2000)], 0.5)]


def test_months_add_up_and_no_rows(spark):
    rows = [(f"m{i % 2}", i) for i in range(100)]
    table = stored(spark, rows, "int")
    parts = [month_grids.month_counts(table.where(F.col("month") == m), ["x"], "month") for m in ("m0", "m1")]
    assert month_grids.exact(table, parts[0].unionByName(parts[1]), "x", [0.25], "month") == [24.75]
    nothing = stored(spark, [("m0", None)], "int")
    grid = month_grids.month_counts(nothing, ["x"], "month")
    assert month_grids.exact(nothing, grid, "x", [0.5], "month") == [None] == month_grids.approximate(grid, "x", [0.5])
