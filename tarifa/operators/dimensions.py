"""Calendar, route and airline dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarifa.fixed_values import CALENDAR_END, CALENDAR_START
from tarifa.functions.numbers import date_key
from tarifa.functions.text import split_list
from tarifa.sources import seeds


def calendar(
    spark: SparkSession,
    holidays: DataFrame | None = None,
    start: str = CALENDAR_START,
    end: str = CALENDAR_END,
) -> DataFrame:
    """One row per day from ``start`` to ``end``, with holidays. Its size depends on the range only."""
    holidays = seeds.holidays(spark) if holidays is None else holidays
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_day")
    )
    day = F.col("date_day")
    year, quarter, weekday = F.year(day), F.quarter(day), F.dayname(day)
    return days.join(holidays, day == F.col("holiday_date"), "left").select(
        date_key(day).alias("date_key"),
        day,
        year.alias("year"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        (F.dayofweek(day) - 1).alias("day_of_week_num"),
        weekday.alias("day_name"),
        quarter.alias("quarter"),
        F.concat(F.lit("Q"), quarter, F.lit(" "), year).alias("quarter_name"),
        weekday.isin("Sat", "Sun").alias("is_weekend"),
        "holiday_name",
        F.col("holiday_name").isNotNull().alias("is_holiday"),
    )


def routes(staging: DataFrame) -> DataFrame:
    """One row per origin and destination, with the mean distance rounded to whole miles."""
    stats = (
        staging.where(
            F.col("starting_airport").isNotNull() & F.col("destination_airport").isNotNull()
        )
        .groupBy(
            F.col("starting_airport").alias("origin_airport"),
            F.col("destination_airport").alias("dest_airport"),
        )
        .agg(
            F.round(F.avg("total_travel_distance")).cast("int").alias("mean_distance"),
            F.count(F.lit(1)).alias("num_flights_observed"),
        )
    )
    return stats.select(
        F.concat("origin_airport", F.lit("_"), "dest_airport").alias("route_key"),
        "origin_airport",
        "dest_airport",
        F.coalesce("mean_distance", F.lit(0)).alias("distance_miles"),
        F.current_timestamp().alias("created_at"),
    )


def flatten_airlines(staging: DataFrame, *kept: str) -> DataFrame:
    """One row per itinerary segment: the airline code and the name at the same position, if any, after the columns in ``kept``."""
    segments = staging.select(
        *kept,
        F.posexplode(split_list(F.col("segments_airline_codes"))).alias("position", "code"),
        split_list(F.col("segments_airline_names")).alias("names"),
    )
    return segments.select(
        *kept,
        "position",
        F.trim("code").alias("airline_code"),
        F.trim(F.get("names", F.col("position"))).alias("airline_name"),
    ).where(F.col("airline_code") != "")


def airline_name_frequency(staging: DataFrame) -> DataFrame:
    """How often each code goes with each non-empty name."""
    return name_counts(staging, "frequency")


def name_counts(staging: DataFrame, output: str, *kept: str) -> DataFrame:
    """Segments by code and non-empty name, and by the columns in ``kept``.

    Equal pairs of texts are counted first, and only distinct ones are split into segments.
    """
    texts = staging.groupBy(*kept, "segments_airline_codes", "segments_airline_names").agg(F.count(F.lit(1)).alias("itineraries"))
    segments = flatten_airlines(texts, *kept, "itineraries").where(F.col("airline_name") != "")
    return segments.groupBy(*kept, "airline_code", "airline_name").agg(F.sum("itineraries").alias(output))


def airlines(staging: DataFrame) -> DataFrame:
    """The most frequent name of each code, in code order; equal counts go to the first name by text.

    The rank filter lets each task keep its best name per code before the shuffle, so a code with
    very many rows or names does not gather in one task.
    """
    by_frequency = Window.partitionBy("airline_code").orderBy(F.desc("frequency"), "airline_name")
    return (
        airline_name_frequency(staging)
        .withColumn("name_rank", F.row_number().over(by_frequency))
        .where("name_rank = 1")
        .select("airline_code", "airline_name", F.current_timestamp().alias("created_at"))
        .orderBy("airline_code")
    )
