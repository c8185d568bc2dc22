"""Pricing rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarifa.fixed_values import (
    DEFAULT_SEASON,
    FACTOR_WEIGHTS,
    POPULAR_ROUTES,
    PRICE_CEILING,
    PRICE_FLOOR,
    ROUTE_MILES,
    SEASON_FACTORS,
)
from tarifa.functions.numbers import clip, percent_label
from tarifa.functions.text import lookup


def _share(condition: Column, value: float) -> Column:
    return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))


def demand_factor(weekend: Column, month: Column, weekday: Column, days: Column) -> Column:
    """Weekend, summer or winter month, late-week day (0 = Monday) and usual booking window add up."""
    score = (
        _share(weekend == 1, 0.10)
        + _share(month.isin(6, 7, 8, 12, 1), 0.15)
        + _share(weekday.isin(5, 6), 0.10)
        + _share(days.between(7, 21), 0.10)
    )
    return clip(score, F.lit(-0.20), F.lit(0.50))


def inventory_factor(seats: Column, total_seats: Column) -> Column:
    """Scarce seats raise the price, many free seats lower it; thresholds in percent of all seats."""
    percent = F.when(
        total_seats > 0, F.try_divide(seats.cast("double"), total_seats.cast("double")) * 100
    ).otherwise(F.lit(50.0))
    return (
        F.when(percent <= 2, 0.50)
        .when(percent <= 5, 0.40)
        .when(percent <= 10, 0.25)
        .when(percent <= 15, 0.15)
        .when(percent >= 60, -0.25)
        .when(percent >= 50, -0.15)
        .when(percent >= 40, -0.10)
        .otherwise(0.0)
    )


def time_factor(days: Column) -> Column:
    """Late bookings cost more, very early ones less."""
    return (
        F.when(days <= 1, 0.50)
        .when(days <= 3, 0.30)
        .when(days <= 7, 0.20)
        .when(days <= 14, 0.10)
        .when(days >= 60, -0.10)
        .otherwise(0.0)
    )


def competition_factor(price: Column, competitor_prices: Column) -> Column:
    """Our price against the mean competitor price. No prices, or our price 0, gives 0.

    With a mean of 0 the difference counts as unbounded, with the sign of our price.
    """
    total = F.aggregate(competitor_prices, F.lit(0.0), lambda sum_, x: sum_ + x)
    mean = total / F.nullif(F.size(competitor_prices), F.lit(0))
    difference = F.when(mean == 0, F.signum(price) * F.lit(float("inf"))).otherwise(
        F.try_divide(price - mean, mean)
    )
    usable = F.coalesce((F.size(competitor_prices) > 0) & (price != 0), F.lit(False))
    return F.when(~usable, F.lit(0.0)).otherwise(
        F.when(difference > 0.15, -0.20)
        .when(difference > 0.10, -0.15)
        .when(difference > 0.05, -0.08)
        .when(difference < -0.10, 0.10)
        .when(difference < -0.05, 0.05)
        .otherwise(0.0)
    )


def seasonality_factor(season: Column) -> Column:
    return lookup(SEASON_FACTORS, F.coalesce(season, F.lit(DEFAULT_SEASON)), 0.0)


def total_adjustment(factors: dict[str, Column], weights: dict[str, float] = FACTOR_WEIGHTS) -> Column:
    """The weighted sum of the five factors, added in the order of the weights table."""
    names = ["demand", "competition", "inventory", "time", "seasonality"]
    total = factors[names[0]] * weights[names[0]]
    for name in names[1:]:
        total = total + factors[name] * weights[name]
    return total


def final_price(prediction: Column, adjustment: Column) -> Column:
    """The adjusted price within its bounds, in whole units (ties to even); null for a prediction of 0."""
    bounded = clip(
        prediction * (1 + adjustment), prediction * PRICE_FLOOR, prediction * PRICE_CEILING
    )
    return F.when(prediction != 0, F.bround(bounded, 0))


def adjustment_percent(prediction: Column, price: Column) -> Column:
    """By how many percent the rounded price differs from the prediction."""
    return F.try_divide(price - prediction, prediction) * 100


def factor_label(factor: Column) -> Column:
    return percent_label(factor)


def confidence(origin: Column, dest: Column, days: Column, seats: Column, prediction: Column) -> Column:
    """High, Medium or Low by route, booking window, seats and price."""
    route = F.concat(origin, F.lit("-"), dest)
    known = route.isin(POPULAR_ROUTES) | F.reverse(route).isin(POPULAR_ROUTES)
    score = (
        F.when(known, 2).otherwise(0)
        + F.when(days.between(7, 60), 2).when(days.between(3, 90), 1).otherwise(0)
        + F.when(seats.between(10, 150), 1).otherwise(0)
        + F.when(prediction.between(100, 1500), 1).otherwise(0)
    )
    return F.when(score >= 4, "High").when(score >= 2, "Medium").otherwise("Low")


def seat_status(seats: Column) -> Column:
    return (
        F.when(seats <= 2, "Very Scarce")
        .when(seats <= 5, "Scarce")
        .when(seats <= 10, "Limited")
        .otherwise("Available")
    )


def demand_level(label: Column) -> Column:
    """The level behind a demand label such as ``+35.0%``."""
    percent = F.replace(label, F.lit("%"), F.lit("")).try_cast("double")
    return F.when(percent > 10, "High").when(percent < -5, "Low").otherwise("Medium")


def price_range(price: Column) -> tuple[Column, Column]:
    return price * 0.85, price * 1.15


def route_distance(origin: Column, dest: Column, fallback: Column) -> Column:
    """Miles of a known route, else the given distance. The table has 16 entries, held in the plan."""
    known = lookup(ROUTE_MILES, F.concat(origin, F.lit("-"), dest))
    return F.coalesce(known.cast("double"), fallback)
