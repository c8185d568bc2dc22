"""Column helpers for numbers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low: Column, high: Column) -> Column:
    """Raise to ``low`` first, then lower to ``high``: the upper bound wins when they cross."""
    return F.least(F.greatest(value, low), high)


def cents(value: Column) -> Column:
    """A double rounded half up to two places; the decimal step drops binary noise before the tie rule."""
    return F.round(value.try_cast("decimal(18,6)"), 2).cast("double")


def stable(value: Column, places: int = 6) -> Column:
    """A double rounded so that the order of additions cannot change it."""
    return F.round(value, places)


def zero_one(flag: Column) -> Column:
    """1 for true, 0 for false or null."""
    return F.when(flag, 1).otherwise(0)


def whole_number(value: Column, type_name: str) -> Column:
    """To int, rounding fractions half up where a plain cast would cut them off."""
    if type_name in ("tinyint", "smallint", "int", "bigint"):
        return value.try_cast("int")
    return F.round(value.try_cast("decimal(20,4)"), 0).try_cast("int")


def date_key(day: Column) -> Column:
    """A date as the integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_date(value: Column) -> Column:
    """A ``YYYY-MM-DD`` text as a date; null when it is no such date."""
    shaped = value.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    return F.when(shaped, value.try_cast("date"))


def percent_label(value: Column) -> Column:
    """A share as signed percent text with one decimal, such as ``+35.0%``.

    Formatting by a pattern is slow; shares of whole percents up to 60 take their text from a literal list.
    """
    percent = value * 100
    texts = F.array(*[F.lit(f"{p:+.1f}%") for p in range(-60, 61)])
    whole = (percent == F.rint(percent)) & percent.between(-60, 60) & (percent.cast("string") != "-0.0")
    return F.when(whole, F.get(texts, percent.cast("int") + 60)).otherwise(F.format_string("%+.1f%%", percent))
