"""Raw itineraries to the cleaned, typed staging table. Every step is narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.functions.numbers import whole_number
from tarifa.functions.text import airport_code, duration_minutes, first_item, item_count, last_item

# Segment columns that only change their name: staging name -> raw name.
SEGMENT_COLUMNS = {
    "segments_departure_epoch": "SEGMENTSDEPARTURETIMEEPOCHSECONDS",
    "segments_departure_raw": "SEGMENTSDEPARTURETIMERAW",
    "segments_arrival_epoch": "SEGMENTSARRIVALTIMEEPOCHSECONDS",
    "segments_arrival_raw": "SEGMENTSARRIVALTIMERAW",
    "segments_arrival_airports": "SEGMENTSARRIVALAIRPORTCODE",
    "segments_departure_airports": "SEGMENTSDEPARTUREAIRPORTCODE",
    "segments_airline_names": "SEGMENTSAIRLINENAME",
    "segments_airline_codes": "SEGMENTSAIRLINECODE",
    "segments_equipment": "SEGMENTSEQUIPMENTDESCRIPTION",
    "segments_duration_seconds": "SEGMENTSDURATIONINSECONDS",
    "segments_distances": "SEGMENTSDISTANCE",
    "segments_cabin_codes": "SEGMENTSCABINCODE",
}


def parse_flights(bronze: DataFrame) -> DataFrame:
    """Rename and cast the raw columns. Text that does not parse becomes null instead of failing the job."""
    types = dict(bronze.dtypes)

    def money(name: str) -> Column:
        return F.col(name).try_cast("decimal(10,2)")

    def integer(name: str) -> Column:
        return whole_number(F.col(name), types[name])

    def flag(name: str) -> Column:
        return F.coalesce(name, F.lit(False))

    columns = {
        "leg_id": F.col("LEGID"),
        "search_date": F.col("SEARCHDATE").try_cast("date"),
        "flight_date": F.col("FLIGHTDATE").try_cast("date"),
        "starting_airport": airport_code(F.col("STARTINGAIRPORT")),
        "destination_airport": airport_code(F.col("DESTINATIONAIRPORT")),
        "is_basic_economy": flag("ISBASICECONOMY"),
        "is_refundable": flag("ISREFUNDABLE"),
        "is_non_stop": flag("ISNONSTOP"),
        "base_fare": money("BASEFARE"),
        "total_fare": money("TOTALFARE"),
        "seats_remaining": integer("SEATSREMAINING"),
        "total_travel_distance": money("TOTALTRAVELDISTANCE"),
        "elapsed_days": integer("ELAPSEDDAYS"),
        "travel_duration_minutes": duration_minutes(F.col("TRAVELDURATION")),
        **{new: F.col(raw) for new, raw in SEGMENT_COLUMNS.items()},
        "fare_basis_code": F.col("FAREBASISCODE"),
        "loaded_at": F.current_timestamp(),
    }
    return bronze.select([column.alias(name) for name, column in columns.items()])


def derive_flights(parsed: DataFrame) -> DataFrame:
    """Add the seven derived columns."""
    return parsed.withColumns(
        {
            "days_until_flight": F.datediff("flight_date", "search_date"),
            "num_segments": item_count(F.col("segments_airline_codes")),
            "first_departure_epoch": first_item(F.col("segments_departure_epoch")),
            "last_arrival_epoch": last_item(F.col("segments_arrival_epoch")),
            "primary_carrier": first_item(F.col("segments_airline_codes")),
            "primary_cabin": first_item(F.col("segments_cabin_codes")),
            "taxes_and_fees": (F.col("total_fare") - F.col("base_fare")).cast("decimal(10,2)"),
        }
    )


def is_valid_flight() -> Column:
    """Keys present, flight within a year of the search, positive fare, no negative seat count."""
    return (
        F.col("leg_id").isNotNull()
        & F.col("search_date").isNotNull()
        & F.col("flight_date").isNotNull()
        & F.col("days_until_flight").between(0, 365)
        & (F.col("total_fare") > 0)
        & (F.col("seats_remaining") >= 0)
    )


def stage_flights(bronze: DataFrame) -> DataFrame:
    """Parse, derive and filter: the staging table."""
    return derive_flights(parse_flights(bronze)).where(is_valid_flight())
