"""Price fact and the wide feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.functions.numbers import date_key, zero_one


def fare_per_mile(fare: Column, distance: Column) -> Column:
    """Fare over distance to four places; 0 where the distance is missing or not positive."""
    return F.when(distance > 0, F.round(fare / distance, 4)).otherwise(
        F.lit(0).cast("decimal(10,4)")
    )


def flight_prices(staging: DataFrame) -> DataFrame:
    """The fact table: natural keys, prices and flight attributes of each staged itinerary."""
    ratio = fare_per_mile(F.col("total_fare"), F.col("total_travel_distance"))
    return staging.where((F.col("total_fare") > 0) & (F.col("days_until_flight") >= 0)).select(
        F.concat("starting_airport", F.lit("_"), "destination_airport").alias("route_key"),
        date_key(F.col("flight_date")).alias("date_key"),
        F.col("primary_carrier").alias("airline_key"),
        F.col("starting_airport").alias("origin_airport_key"),
        F.col("destination_airport").alias("dest_airport_key"),
        "leg_id",
        "search_date",
        "flight_date",
        "primary_cabin",
        "fare_basis_code",
        "total_fare",
        "base_fare",
        "taxes_and_fees",
        ratio.cast("decimal(18,4)").alias("fare_per_mile"),
        "seats_remaining",
        "days_until_flight",
        "total_travel_distance",
        "travel_duration_minutes",
        "num_segments",
        "is_basic_economy",
        "is_refundable",
        "is_non_stop",
    )


def with_known_airline(fact: DataFrame, airlines: DataFrame) -> DataFrame:
    """Rows whose airline is in the dimension. The dimension is not hinted: its size picks the join."""
    return fact.join(airlines, F.col("airline_key") == F.col("airline_code"), "left_semi")


def with_cities(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """Join the airports twice, as origin and as destination; unknown codes drop the row.

    No hint: the seed is estimated by its size, as any other list of airports is.
    """
    origin = airports.select(
        F.col("code").alias("origin_code"), F.col("city").alias("origin_city")
    )
    dest = airports.select(F.col("code").alias("dest_code"), F.col("city").alias("dest_city"))
    return (
        fact.join(origin, F.col("origin_airport_key") == F.col("origin_code"))
        .join(dest, F.col("dest_airport_key") == F.col("dest_code"))
        .drop("origin_code", "dest_code")
    )


def ml_features(
    fact: DataFrame, calendar: DataFrame, airlines: DataFrame, airports: DataFrame
) -> DataFrame:
    """The wide table for training: the fact joined with all four dimensions.

    The calendar is broadcast: it has one row per day of its range. Flights outside the calendar, of
    unknown airlines or unknown airports drop out.
    """
    days = calendar.select(
        F.col("date_key").alias("calendar_key"),
        F.col("year").alias("flight_year"),
        F.col("month").alias("flight_month"),
        F.col("day_of_week_num").alias("flight_day_of_week"),
        F.col("is_weekend").alias("weekend"),
        F.col("is_holiday").alias("holiday"),
    )
    dated = fact.where("total_fare > 0").join(
        F.broadcast(days), F.col("date_key") == F.col("calendar_key")
    )
    joined = with_cities(with_known_airline(dated, airlines), airports)
    return joined.select(
        "total_fare",
        "fare_basis_code",
        "days_until_flight",
        "seats_remaining",
        "total_travel_distance",
        "travel_duration_minutes",
        "num_segments",
        F.col("airline_key").alias("airline_code"),
        "origin_city",
        "dest_city",
        F.col("date_key").alias("flight_date_key"),
        "flight_year",
        "flight_month",
        "flight_day_of_week",
        zero_one(F.col("weekend")).alias("is_weekend"),
        zero_one(F.col("holiday")).alias("is_holiday"),
        zero_one(F.col("is_basic_economy")).alias("is_basic_economy"),
        zero_one(F.col("is_non_stop")).alias("is_non_stop"),
        zero_one(F.col("is_refundable")).alias("is_refundable"),
    )
