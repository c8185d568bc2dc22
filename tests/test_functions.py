"""Boundary values of the column functions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tarifa.functions import rules
from tarifa.functions.fare_codes import scoring_features, training_features
from tarifa.functions.numbers import cents, iso_date, percent_label, whole_number
from tarifa.functions.text import airport_code, duration_minutes, first_item, last_item, parse_prices, split_list


def values(spark, rows, schema, column):
    """The value of ``column`` for each row, in order."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"i int, {schema}")
    return [r[1] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_duration(spark):
    cases = {
        "PT2H5M": 125, "PT10H0M": 600, "P1DT2H5M": None, "PT45M": None, "PT2H": None, "PTHM": None,
        None: None, "PT99999999999H1M": None,
    }
    found = values(spark, [(k,) for k in cases], "x string", duration_minutes(F.col("x")))
    assert found == list(cases.values())


def test_lists(spark):
    rows = [("a||b||c",), ("a",), ("",), ("a||",), (None,)]
    assert values(spark, rows, "x string", first_item(F.col("x"))) == ["a", "a", "", "a", None]
    assert values(spark, rows, "x string", last_item(F.col("x"))) == ["c", "a", "", "", None]
    assert values(spark, rows, "x string", F.size(split_list(F.col("x")))) == [3, 1, 1, 2, None]
    assert values(spark, [(" jfk ",)], "x string", airport_code(F.col("x"))) == ["JFK"]


def test_prices_text(spark):
    rows = [("100, 200.5",), ("12abc, x, .5, -3, 1e2",), ("",), ("  ",), (None,), ("none",)]
    assert values(spark, rows, "x string", parse_prices(F.col("x"))) == [
        [100.0, 200.5], [12.0, 0.5, -3.0, 100.0], None, None, None, [],
    ]


def test_numbers(spark):
    assert values(spark, [("2.7",), ("x",), ("3",)], "x string", whole_number(F.col("x"), "string")) == [3, None, 3]
    assert values(spark, [(1.005,), (2.675,), (-1.5,)], "x double", cents(F.col("x"))) == [1.01, 2.68, -1.5]
    dates = values(
        spark,
        [("2024-02-29",), ("2023-02-29",), ("2023-2-3",), ("2023-02-03T00",), ("",), (None,)],
        "x string",
        iso_date(F.col("x")).cast("string"),
    )
    assert dates == ["2024-02-29", None, "2023-02-03", None, None, None]
    labels = values(spark, [(0.35,), (0.0,), (-0.08,)], "x double", percent_label(F.col("x")))
    assert labels == ["+35.0%", "+0.0%", "-8.0%"]


CODES = [None, "", "Y0", "Y14", "F0CH", "J14INH", "wl", "QLH", "YAA7NR", "Q123456789012", "PWK"]


def test_training_fare_features(spark):
    columns = training_features(F.col("x"))
    found = values(spark, [(c,) for c in CODES], "x string", F.struct([v.alias(k) for k, v in columns.items()]))
    expected = [
        # cabin, number, passenger, season, has number, night, weekend
        ("Discount Economy", 0, "Adult", "Standard", 0, 1, 1),
        ("Unknown", 0, "Adult", "Standard", 0, 0, 0),
        ("Full Economy", 0, "Adult", "Standard", 0, 0, 0),
        ("Full Economy", 14, "Adult", "Standard", 1, 0, 0),
        ("First", 0, "Child", "High", 0, 0, 0),
        ("Business", 14, "Infant", "High", 1, 1, 0),
        ("Premium Economy", 0, "Adult", "Low", 0, 0, 0),
        ("Discount Economy", 0, "Adult", "High", 0, 0, 0),
        ("Full Economy", 7, "Adult", "Standard", 1, 1, 0),
        ("Discount Economy", 0, "Adult", "Standard", 0, 0, 0),
        ("Business", 0, "Adult", "Standard", 0, 0, 1),
    ]
    assert [tuple(r) for r in found] == expected


def test_scoring_fare_features(spark):
    columns = scoring_features(F.col("x"), F.col("h"), F.col("d"))
    packed = F.struct([v.alias(k) for k, v in columns.items()])
    found = values(spark, [(c, None, None) for c in CODES], "x string, h int, d string", packed)
    expected = [
        (1, 0, 0, 1, 0, 0, 0),
        (1, 0, 0, 1, 0, 0, 0),
        (2, 0, 0, 1, 1, 0, 0),
        (2, 14, 0, 1, 1, 0, 0),
        (5, 0, 1, 2, 1, 0, 0),
        (4, 14, 2, 2, 1, 1, 0),
        (3, 0, 0, 0, 0, 0, 0),
        (1, 0, 0, 1, 0, 0, 0),
        (2, 7, 0, 1, 1, 1, 0),
        (1, 123456789012, 0, 1, 1, 0, 0),
        (5, 0, 0, 1, 0, 0, 1),
    ]
    assert [tuple(r) for r in found] == expected
    clock = [("YN", 5, "2024-06-01"), ("YN", 6, "2024-06-03"), ("Y", 22, "bad WE"), ("WE", 21, "")]
    found = values(spark, clock, "x string, h int, d string", packed)
    assert [(r.is_night_fare_proxy, r.is_weekend_fare_proxy) for r in found] == [(1, 1), (0, 0), (1, 0), (0, 1)]


@pytest.mark.parametrize(
    ("seats", "total", "factor"),
    [
        (2, 100, 0.5), (3, 100, 0.4), (5, 100, 0.4), (10, 100, 0.25), (15, 100, 0.15), (16, 100, 0.0), (39, 100, 0.0),
        (40, 100, -0.1), (50, 100, -0.15), (60, 100, -0.25), (5, 0, -0.15), (5, -1, -0.15),
    ],
)
def test_inventory(spark, seats, total, factor):
    column = rules.inventory_factor(F.col("s"), F.col("t"))
    assert values(spark, [(seats, total)], "s int, t int", column) == [factor]


def test_time(spark):
    days = [0, 1, 2, 3, 7, 8, 14, 15, 59, 60]
    expected = [0.5, 0.5, 0.3, 0.3, 0.2, 0.1, 0.1, 0.0, 0.0, -0.1]
    assert values(spark, [(d,) for d in days], "d int", rules.time_factor(F.col("d"))) == expected


def test_demand(spark):
    rows = [(1, 7, 5, 10), (0, 3, 2, 6), (0, 1, 2, 7), (0, 12, 2, 22), (1, 4, 6, 21)]
    column = rules.demand_factor(F.col("w"), F.col("m"), F.col("d"), F.col("n"))
    found = values(spark, rows, "w int, m int, d int, n int", column)
    assert found == pytest.approx([0.45, 0.0, 0.25, 0.15, 0.3])


def test_competition(spark):
    rows = [
        (115.0, [100.0]), (116.0, [100.0]), (110.0, [100.0]), (111.0, [100.0]), (105.0, [100.0]), (106.0, [100.0]),
        (95.0, [100.0]), (94.0, [100.0]), (90.0, [100.0]), (89.0, [100.0]), (100.0, []), (100.0, None), (0.0, [100.0]),
        (100.0, [0.0]), (-100.0, [0.0]), (None, [100.0]), (100.0, [50.0, 150.0]),
    ]
    expected = [-0.15, -0.2, -0.08, -0.15, 0.0, -0.08, 0.0, 0.05, 0.05, 0.1, 0.0, 0.0, 0.0, -0.2, 0.1, 0.0, 0.0]
    column = rules.competition_factor(F.col("p"), F.col("c"))
    assert values(spark, rows, "p double, c array<double>", column) == expected


def test_season(spark):
    rows = [("peak_summer",), ("peak_winter",), ("shoulder",), ("standard",), ("off_season",), ("x",), (None,)]
    found = values(spark, rows, "s string", rules.seasonality_factor(F.col("s")))
    assert found == [0.2, 0.15, 0.05, 0.0, -0.1, 0.0, 0.0]


def test_final_price(spark):
    rows = [(2.5, 0.0), (3.5, 0.0), (100.0, 0.9), (100.0, -0.9), (0.0, 0.1), (-100.0, 0.0), (None, 0.1)]
    found = values(spark, rows, "p double, a double", rules.final_price(F.col("p"), F.col("a")))
    assert found == [2.0, 4.0, 150.0, 70.0, None, -150.0, None]


def test_confidence(spark):
    rows = [
        ("JFK", "LAX", 2, 5, 50.0), ("LAX", "ORD", 2, 5, 50.0), ("LAX", "ORD", 3, 10, 50.0), ("LAX", "ORD", 7, 10, 100.0),
        ("LAX", "ORD", 60, 150, 1500.0), ("LAX", "ORD", 61, 150, 1500.0), ("LAX", "ORD", 90, 151, 1501.0),
        ("LAX", "ORD", 91, 10, 99.0), ("JFK", "LAX", 6, 9, 1500.0),
    ]
    column = rules.confidence(F.col("o"), F.col("d"), F.col("n"), F.col("s"), F.col("p"))
    found = values(spark, rows, "o string, d string, n int, s int, p double", column)
    assert found == ["Medium", "Low", "Medium", "High", "High", "Medium", "Low", "Low", "High"]


def test_display_rules(spark):
    seats = values(spark, [(s,) for s in (2, 3, 5, 6, 10, 11)], "s int", rules.seat_status(F.col("s")))
    assert seats == ["Very Scarce", "Scarce", "Scarce", "Limited", "Limited", "Available"]
    labels = [("+10.0%",), ("+10.1%",), ("-5.0%",), ("-5.1%",)]
    assert values(spark, labels, "l string", rules.demand_level(F.col("l"))) == ["Medium", "High", "Medium", "Low"]
    miles = values(
        spark,
        [("JFK", "LAX", 1.0), ("JFK", "ATL", 1.0), (None, "ATL", 2.0)],
        "o string, d string, x double",
        rules.route_distance(F.col("o"), F.col("d"), F.col("x")),
    )
    assert miles == [2475.0, 1.0, 2.0]
    assert math.isclose(sum(rules.FACTOR_WEIGHTS.values()), 1.0)


def test_quick_forms_equal_the_plain_ones(spark):
    """Labels, prices and durations against the forms by pattern alone, which the quick ones leave for odd values only."""
    draw = random.Random(5)
    shares = [n / 1000 for n in range(-1300, 1300)] + [0.1 + 0.15 + 0.1, -0.0, 0.0, float("inf"), float("nan"), None, 1e20]
    found = spark.createDataFrame([(x,) for x in shares], "x double").select(
        percent_label(F.col("x")).alias("quick"), F.format_string("%+.1f%%", F.col("x") * 100).alias("plain")
    )
    assert found.where(~F.col("quick").eqNullSafe(F.col("plain"))).count() == 0

    texts = ["".join(draw.choice("0123456789.,,, +-eEx\t\n") for _ in range(draw.randrange(14))) for _ in range(5000)] + [None, "", " ", "1e999"]
    number = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"
    entries = F.transform(F.split("x", ","), lambda e: F.regexp_extract(F.trim(e), number, 1).try_cast("double"))
    plain = F.when(F.trim("x") != "", F.filter(entries, lambda p: p.isNotNull()))
    prices = spark.createDataFrame([(x,) for x in texts], "x string").select(parse_prices(F.col("x")).alias("quick"), plain.alias("plain"))
    assert prices.where(~F.col("quick").eqNullSafe(F.col("plain"))).count() == 0

    texts = ["PT" + "".join(draw.choice("0123HMMH- ") for _ in range(draw.randrange(8))) for _ in range(5000)] + [None, "PT5H30M", "PT5H30M\n"]
    numbers = F.regexp_extract_all("x", F.lit("[0-9]+"), F.lit(0))
    first, second = (F.get(numbers, F.lit(i)).try_cast("int") for i in (0, 1))
    plain = F.when(F.col("x").like("PT%H%M"), first * 60 + second)
    minutes = spark.createDataFrame([(x,) for x in texts], "x string").select(duration_minutes(F.col("x")).alias("quick"), plain.alias("plain"))
    assert minutes.where(~F.col("quick").eqNullSafe(F.col("plain"))).count() == 0


def test_common_labels_and_prices_take_the_quick_way(spark):
    """No higher-order function, which is not compiled, over prices; a short scan is split."""
    plan = spark.createDataFrame([("1, 2 USD",)], "x string").select(parse_prices(F.col("x")))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    assert "CASE WHEN" in str(percent_label(F.col("x")))
