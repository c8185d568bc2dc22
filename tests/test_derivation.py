"""What every derived row pays for: times as text, items counted, airline names counted by distinct text."""

import glob

from pyspark.sql import functions as F
from tarifa.functions.text import iso_text, item_count, split_list
from tarifa.operators import dimensions
from tarifa.operators.staging import stage_flights
from tarifa.plans.queries import QUERIES
from tarifa.plans.tables import Tables
from tarifa.session import shared_folder


def test_times_before_1970_are_texts_too(spark):
    rows = spark.createDataFrame([(-1,), (0,), (86399,), (1735689661,), (None,)], "epoch long")
    found = [row[0] for row in rows.select(iso_text(F.col("epoch"))).collect()]
    assert found == [
        "1969-12-31T23:59:59.000-05:00", "1970-01-01T00:00:00.000-05:00", "1970-01-01T23:59:59.000-05:00",
        "2025-01-01T00:01:01.000-05:00", None,
    ]


def test_items_are_counted_as_split_gives_them(spark):
    texts = ["", "a", "a||b", "||", "a||", "a|b", "|||", "||||", "ä||ö||", None]
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    counted = rows.select(item_count(F.col("value")), F.size(split_list(F.col("value")))).collect()
    assert [a for a, b in counted][:-1] == [b for a, b in counted][:-1]
    assert counted[-1][0] is None


def test_airline_names_are_split_by_distinct_text(spark, folder):
    plan = dimensions.airline_name_frequency(stage_flights(Tables(spark, folder).raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Aggregate") > plan.index("Generate")


def test_round_trip_scores_requests_where_they_are_derived(spark, folder):
    stored = f"{shared_folder(spark).removeprefix('file:')}/tables/requests-*"
    before = glob.glob(stored)
    found = QUERIES["model_roundtrip"](Tables(spark, folder))
    assert found.where("NOT same_prediction OR NOT price_in_bounds").isEmpty()
    assert glob.glob(stored) == before
