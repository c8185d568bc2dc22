"""Row filters and outlier trimming before training."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.fixed_values import FENCE_FACTOR, MINIMUM_DURATION
from tarifa.operators.quantiles import approximate_quantiles, quantiles


def has_seats() -> Column:
    """Not sold out; an unknown seat count does not pass either."""
    return F.col("seats_remaining") != 0


def is_plausible() -> Column:
    return (
        (F.col("total_fare") > 0)
        & (F.col("total_travel_distance") > 0)
        & (F.col("travel_duration_minutes") > MINIMUM_DURATION)
        & (F.col("seats_remaining") >= 0)
        & (F.col("days_until_flight") >= 0)
    )


def zero_seat_summary(df: DataFrame) -> DataFrame:
    """Rows, sold-out rows with their share in percent, and the rows that pass, in one pass."""
    total, zero = F.count(F.lit(1)), F.count_if(F.col("seats_remaining") == 0)
    return df.agg(
        total.alias("total_rows"),
        zero.alias("zero_seat_rows"),
        F.round(F.try_divide(zero * 100, total), 2).alias("zero_seat_percent"),
        F.count_if(has_seats()).alias("kept_rows"),
    )


def clean_training_rows(df: DataFrame) -> DataFrame:
    return df.where(has_seats() & is_plausible())


class Fence(NamedTuple):
    """Quartiles and outlier bounds of one column."""

    q1: float | None
    q3: float | None
    lower_bound: float | None
    upper_bound: float | None


def fence(
    df: DataFrame,
    column: str,
    factor: float = FENCE_FACTOR,
    interpolation: str = "linear",
    exact: bool = True,
) -> Fence:
    """The quartiles and the bounds ``factor`` interquartile ranges below and above them.

    Bounds are rounded to six places, which removes binary noise from amounts in cents. All are
    ``None`` for a column without values.
    """
    shares = [0.25, 0.75]
    q1, q3 = (
        quantiles(df, column, shares, interpolation)
        if exact
        else approximate_quantiles(df, column, shares)
    )
    if q1 is None:
        return Fence(None, None, None, None)
    spread = q3 - q1
    return Fence(q1, q3, round(q1 - factor * spread, 6), round(q3 + factor * spread, 6))


def at_most(column: str, bound: float | None) -> Column:
    """A filter with a literal bound, which file scans can use to skip data."""
    return F.col(column) <= F.lit(bound)


def trim_above(df: DataFrame, column: str, **options) -> DataFrame:
    """Drop rows above the upper bound of ``column``; the lower bound is not applied."""
    return df.where(at_most(column, fence(df, column, **options).upper_bound))


def trim_outliers(df: DataFrame, **options) -> DataFrame:
    """Trim by fare, then by duration; the duration bound comes from the rows left by the first trim."""
    return trim_above(trim_above(df, "total_fare", **options), "travel_duration_minutes", **options)


def cleaning_audit(df: DataFrame, **options) -> DataFrame:
    """Rows left after each cleaning step, counted together in one pass once the bounds are known."""
    clean = clean_training_rows(df)
    fare_is_low = at_most("total_fare", fence(clean, "total_fare", **options).upper_bound)
    time_bound = fence(clean.where(fare_is_low), "travel_duration_minutes", **options).upper_bound
    seats = has_seats()
    plausible = seats & is_plausible()
    fare = plausible & fare_is_low
    duration = fare & at_most("travel_duration_minutes", time_bound)
    steps = {
        "0 loaded": F.lit(True),
        "1 with seats": seats,
        "2 plausible": plausible,
        "3 fare trimmed": fare,
        "4 duration trimmed": duration,
    }
    counted = df.agg(*[F.count_if(kept).alias(name) for name, kept in steps.items()])
    return counted.unpivot([], list(steps), "step", "rows_left")
