"""Pricing requests derived from raw itineraries, with gaps and faults that exercise every rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarifa import schemas
from tarifa.fixed_values import REQUEST_DEFAULTS
from tarifa.functions.text import airport_code, duration_minutes, first_item, item_count, parse_prices, pick

SEASONS = ["peak_summer", "peak_winter", "shoulder", "standard", "off_season", "carnival"]


def derive_requests(bronze: DataFrame) -> DataFrame:
    """One request per raw itinerary. ``ml_prediction`` is a stand-in: the base fare, 0 for a free ticket."""
    seats = F.col("SEATSREMAINING")
    case = seats % 40

    def price(step: float, count: int) -> F.Column:
        share = F.lit(0.7).cast("decimal(2,1)") + F.lit(step).cast("decimal(2,1)") * (seats % count)
        return (F.col("BASEFARE") * share).cast("decimal(12,2)").cast("string")

    offers = F.concat(price(0.1, 7), F.lit(", n/a, "), price(0.2, 4), F.lit(" USD"))
    hour = F.expr("(cast(departure as bigint) div 3600) % 24").cast("int")
    return bronze.withColumn(
        "departure", first_item(F.col("SEGMENTSDEPARTURETIMEEPOCHSECONDS"))
    ).select(
        F.col("LEGID").alias("request_id"),
        F.when(case == 11, F.lit(None))
        .when(case == 12, F.lit("soon"))
        .otherwise(F.col("SEARCHDATE").cast("string"))
        .alias("searchDate"),
        F.when(case == 13, F.lit("2023-02-30"))
        .otherwise(F.col("FLIGHTDATE").cast("string"))
        .alias("flightDate"),
        F.when(case != 14, airport_code(F.col("STARTINGAIRPORT"))).alias("startingAirport"),
        F.col("DESTINATIONAIRPORT").alias("destinationAirport"),
        F.when(seats == 150, F.lit(501)).when(seats % 10 != 7, seats).alias("seatsRemaining"),
        F.col("TOTALTRAVELDISTANCE").cast("double").alias("totalTravelDistance"),
        duration_minutes(F.col("TRAVELDURATION")).alias("durationMinutes"),
        F.when(case == 15, F.lit(7))
        .otherwise(item_count(F.col("SEGMENTSAIRLINECODE")))
        .alias("numSegments"),
        F.when(seats % 13 != 5, first_item(F.col("SEGMENTSAIRLINECODE"))).alias("carrier"),
        F.when(case == 16, F.lit(24)).when(seats % 11 != 3, hour).alias("departureHour"),
        F.col("ISBASICECONOMY").alias("isBasicEconomy"),
        F.when(seats % 17 != 0, F.col("ISNONSTOP")).alias("isNonStop"),
        F.col("ISREFUNDABLE").alias("isRefundable"),
        (seats % 19 == 0).alias("isHoliday"),
        F.col("FAREBASISCODE").alias("fareBasisCode"),
        F.lit(None).cast("int").alias("cabinCategory"),
        F.lit(None).cast("int").alias("passengerType"),
        parse_prices(
            F.when(seats % 10 == 8, F.lit("")).when(seats % 10 != 9, offers)
        ).alias("competitor_prices"),
        F.when(seats % 9 == 0, F.lit(0))
        .when(seats % 9 != 1, 60 + 30 * (seats % 5))
        .alias("total_seats"),
        pick(SEASONS, seats % 7).alias("season"),
        F.when(F.col("TOTALFARE") == 0, F.lit(0.0))
        .otherwise(F.col("BASEFARE").cast("double"))
        .alias("ml_prediction"),
    )


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Requests from JSON lines with their ``request_id``; an hour that a line does not name gets its default, a null hour stays."""
    lines = spark.read.text(path)
    schema = StructType([StructField("request_id", StringType()), *schemas.REQUEST.fields])
    named = F.array_contains(F.json_object_keys("value"), "departureHour")
    parsed = lines.select(F.from_json("value", schema).alias("request"), named.alias("has_hour")).select("request.*", "has_hour")
    hour = F.when(F.col("has_hour"), F.col("departureHour")).otherwise(REQUEST_DEFAULTS["departureHour"])
    return parsed.withColumn("departureHour", hour).drop("has_hour")
