"""Features of a fare basis code. Training and scoring use different rules; both are kept as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarifa.fixed_values import (
    CABIN_LABELS,
    CABIN_RANKS,
    CHILD_PATTERN,
    INFANT_PATTERN,
    MISSING_FARE_CODE,
    OTHER_CABIN_LABEL,
    OTHER_CABIN_RANK,
)
from tarifa.functions.numbers import iso_date, zero_one
from tarifa.functions.text import first_number, lookup


def training_features(code: Column) -> dict[str, Column]:
    """Text labels and 0/1 flags for the training table. A missing code counts as the text UNKNOWN."""
    code = F.coalesce(code, F.lit(MISSING_FARE_CODE))
    upper, suffix = F.upper(code), F.substr(code, F.lit(2))
    letters = {letter: label for label, group in CABIN_LABELS.items() for letter in group}
    number = F.coalesce(first_number(code).try_cast("int"), F.lit(0))
    return {
        "cabin_category": lookup(letters, F.substring(upper, 1, 1), OTHER_CABIN_LABEL),
        "fare_rule_number": number,
        "passenger_type": F.when(F.upper(suffix).rlike(CHILD_PATTERN), "Child")
        .when(F.upper(suffix).rlike(INFANT_PATTERN), "Infant")
        .otherwise("Adult"),
        "seasonality_proxy": F.when(upper.endswith("H"), "High")
        .when(upper.endswith("L"), "Low")
        .otherwise("Standard"),
        "has_numeric_rule": zero_one(number > 0),
        "is_night_fare_proxy": zero_one(suffix.contains("N")),
        "is_weekend_fare_proxy": zero_one(suffix.contains("W")),
    }


def scoring_features(code: Column, hour: Column, flight_date: Column) -> dict[str, Column]:
    """Numeric features of a pricing request. A missing or empty code gives fixed values.

    The departure hour and the flight date (text) decide the night and weekend flags; where one is
    missing, the text of the code does.
    """
    upper = F.upper(code)
    absent = F.coalesce(code, F.lit("")) == ""
    digits = first_number(upper)
    weekday = F.weekday(iso_date(flight_date))
    marks_weekend = upper.contains("WE") | upper.contains("WK")
    found = {
        "cabin_category": lookup(CABIN_RANKS, F.substring(upper, 1, 1), OTHER_CABIN_RANK),
        "fare_rule_number": F.coalesce(digits.try_cast("bigint"), F.lit(0)),
        "passenger_type": F.when(upper.contains("CH"), 1).when(upper.contains("IN"), 2).otherwise(0),
        "seasonality_proxy": F.when(upper.contains("LH"), 1)
        .when(upper.contains("H"), 2)
        .when(upper.contains("L"), 0)
        .otherwise(1),
        "has_numeric_rule": zero_one(digits != ""),
        "is_night_fare_proxy": zero_one(
            F.when(hour.isNotNull(), (hour < 6) | (hour >= 22)).otherwise(upper.contains("N"))
        ),
        "is_weekend_fare_proxy": zero_one(
            F.when(weekday.isNotNull(), weekday >= 5).otherwise(marks_weekend)
        ),
    }
    fixed = {"cabin_category": OTHER_CABIN_RANK, "seasonality_proxy": 1}
    return {
        name: F.when(absent, F.lit(fixed.get(name, 0))).otherwise(column)
        for name, column in found.items()
    }
