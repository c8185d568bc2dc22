"""Pricing of request tables or streams: narrow column expressions from request to response."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.fixed_values import FACTOR_WEIGHTS, FEATURES, REQUEST_DEFAULTS
from tarifa.functions import rules
from tarifa.functions.fare_codes import scoring_features
from tarifa.functions.numbers import cents, iso_date, zero_one

FACTORS = ["demand", "competition", "inventory", "time", "seasonality"]


def with_defaults(requests: DataFrame) -> DataFrame:
    """Fill missing request fields. An empty fare code and 0 total seats also count as missing.

    The departure hour has a default where requests have no such field; a null hour stays, and the fare code decides about the
    night instead.
    """
    filled = {name: F.coalesce(name, F.lit(value)) for name, value in REQUEST_DEFAULTS.items() if name in requests.columns}
    filled |= {name: F.lit(value) for name, value in REQUEST_DEFAULTS.items() if name not in requests.columns}
    if "departureHour" in requests.columns:
        del filled["departureHour"]
    filled["fareBasisCode"] = F.coalesce(
        F.nullif(F.col("fareBasisCode"), F.lit("")), F.lit(REQUEST_DEFAULTS["fareBasisCode"])
    )
    filled["total_seats"] = F.coalesce(
        F.nullif(F.col("total_seats"), F.lit(0)), F.lit(REQUEST_DEFAULTS["total_seats"])
    )
    filled["competitor_prices"] = F.coalesce(
        "competitor_prices", F.array().cast("array<double>")
    )
    return requests.withColumns(filled)


def _broken_rules() -> dict[str, Column]:
    """Per field, whether it breaks its rule. For requests with defaults."""

    def outside(name: str, low: int, high: int | None = None) -> Column:
        value = F.col(name)
        return value < low if high is None else ~value.between(low, high)

    return {
        "searchDate": iso_date(F.col("searchDate")).isNull(),
        "flightDate": iso_date(F.col("flightDate")).isNull(),
        "startingAirport": F.col("startingAirport").isNull(),
        "destinationAirport": F.col("destinationAirport").isNull(),
        "seatsRemaining": outside("seatsRemaining", 0, 500),
        "totalTravelDistance": outside("totalTravelDistance", 0),
        "durationMinutes": outside("durationMinutes", 0),
        "numSegments": outside("numSegments", 1, 6),
        "departureHour": F.coalesce(outside("departureHour", 0, 23), F.lit(False)),
    }


def violations() -> Column:
    """The names of the fields that break a request rule; empty for a valid request."""
    names = F.array([F.when(rule, F.lit(name)) for name, rule in _broken_rules().items()])
    return F.filter(names, lambda name: name.isNotNull())


def is_valid_request() -> Column:
    """No rule is broken, as separate conditions that the optimizer can move one by one."""
    return reduce(Column.__and__, [~rule for rule in _broken_rules().values()])


def with_violations(requests: DataFrame) -> DataFrame:
    return requests.withColumn("violations", violations())


def request_features(requests: DataFrame) -> DataFrame:
    """Add the 23 model features to requests with defaults. Days are not below 0, weekday 0 is Monday."""
    search, flight = iso_date(F.col("searchDate")), iso_date(F.col("flightDate"))
    weekday = F.weekday(flight)
    columns = {
        "days_until_flight": F.greatest(F.lit(0), F.datediff(flight, search)),
        "seats_remaining": F.col("seatsRemaining"),
        "total_travel_distance": F.col("totalTravelDistance"),
        "travel_duration_minutes": F.col("durationMinutes").cast("double"),
        "num_segments": F.col("numSegments"),
        "airline_code": F.col("carrier"),
        "origin_city": F.col("startingAirport"),
        "dest_city": F.col("destinationAirport"),
        "flight_year": F.year(flight),
        "flight_month": F.month(flight),
        "flight_day_of_week": weekday,
        "is_weekend": zero_one(weekday >= 5),
        "is_holiday": zero_one(F.col("isHoliday")),
        "is_basic_economy": zero_one(F.col("isBasicEconomy")),
        "is_non_stop": zero_one(F.col("isNonStop")),
        "is_refundable": zero_one(F.col("isRefundable")),
        **scoring_features(F.col("fareBasisCode"), F.col("departureHour"), F.col("flightDate")),
    }
    return requests.withColumns({name: columns[name] for name in FEATURES})


def with_factors(featured: DataFrame) -> DataFrame:
    """Add the five price factors. Needs the features, ``ml_prediction``, ``competitor_prices``,
    ``total_seats`` and, if seasons are known, ``season``."""
    season = F.col("season") if "season" in featured.columns else F.lit(None).cast("string")
    days = F.col("days_until_flight")
    return featured.withColumns(
        {
            "demand": rules.demand_factor(
                F.col("is_weekend"), F.col("flight_month"), F.col("flight_day_of_week"), days
            ),
            "competition": rules.competition_factor(
                F.col("ml_prediction"), F.col("competitor_prices")
            ),
            "inventory": rules.inventory_factor(F.col("seats_remaining"), F.col("total_seats")),
            "time": rules.time_factor(days),
            "seasonality": rules.seasonality_factor(season),
        }
    )


def with_price(factored: DataFrame, weights: dict[str, float] = FACTOR_WEIGHTS) -> DataFrame:
    """Add the final price, its difference from the prediction in percent, and the confidence."""
    prediction = F.col("ml_prediction")
    adjustment = rules.total_adjustment({name: F.col(name) for name in FACTORS}, weights)
    return factored.withColumn("final_price", rules.final_price(prediction, adjustment)).withColumns(
        {
            "total_adjustment": rules.adjustment_percent(prediction, F.col("final_price")),
            "confidence": rules.confidence(
                F.col("origin_city"),
                F.col("dest_city"),
                F.col("days_until_flight"),
                F.col("seats_remaining"),
                prediction,
            ),
        }
    )


def with_labels(factored: DataFrame) -> DataFrame:
    """Add a percent label per factor."""
    return factored.withColumns({f"{name}_label": rules.factor_label(F.col(name)) for name in FACTORS})


def with_breakdown(factored: DataFrame, weights: dict[str, float] = FACTOR_WEIGHTS) -> DataFrame:
    """Add the amount each factor contributes."""
    return factored.withColumns(
        {
            f"{name}_amount": F.col("ml_prediction") * F.col(name) * weights[name]
            for name in FACTORS
        }
    )


def price_requests(requests: DataFrame, weights: dict[str, float] = FACTOR_WEIGHTS) -> DataFrame:
    """From requests that carry ``ml_prediction`` to prices, labels, amounts and confidence."""
    featured = request_features(with_defaults(requests))
    return with_breakdown(with_labels(with_price(with_factors(featured), weights)), weights)


def responses(priced: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The response record: rounded prices, nested factors, amounts and feature summary."""
    route = F.concat("startingAirport", F.lit(" → "), "destinationAirport")
    factors = F.struct([F.col(f"{name}_label").alias(name) for name in FACTORS])
    amounts = [cents(F.col("ml_prediction")).alias("base")] + [
        cents(F.col(f"{name}_amount")).alias(f"{name}_adj") for name in FACTORS
    ]
    summary = ["days_until_flight", "cabin_category", "seasonality_proxy", "is_weekend", "is_holiday"]
    return priced.select(
        *(keep or []),
        F.col("final_price").isNotNull().alias("success"),
        cents(F.col("ml_prediction")).alias("ml_base_price"),
        cents(F.col("final_price")).alias("dynamic_price"),
        cents(F.col("total_adjustment")).alias("total_adjustment"),
        "confidence",
        factors.alias("factors"),
        F.struct(amounts).alias("breakdown"),
        route.alias("route"),
        F.col("flightDate").alias("flight_date"),
        F.struct(summary).alias("features_summary"),
    )


def price_batch(requests: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Price every request that can be priced. The others stay in the result with their error.

    Per row: success, error, route, dynamic_price, confidence.
    """
    checked = price_requests(requests).withColumn("violations", violations())
    valid = is_valid_request()
    success = valid & F.col("final_price").isNotNull()
    error = F.when(
        ~valid, F.concat(F.lit("Invalid input: "), F.array_join("violations", ", "))
    ).when(F.col("final_price").isNull(), F.lit("Prediction error"))
    return checked.select(
        *(keep or []),
        success.alias("success"),
        error.alias("error"),
        F.concat("startingAirport", F.lit(" → "), "destinationAirport").alias("route"),
        F.when(success, cents(F.col("final_price"))).alias("dynamic_price"),
        F.when(success, F.col("confidence")).alias("confidence"),
    )


def batch_summary(batch: DataFrame) -> DataFrame:
    return batch.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("success")).alias("successful")
    )


def display_columns(priced: DataFrame) -> DataFrame:
    """Add what a price display shows: seat status, demand level and price range."""
    low, high = rules.price_range(F.col("final_price"))
    return priced.withColumns(
        {
            "seat_status": rules.seat_status(F.col("seatsRemaining")),
            "demand_level": rules.demand_level(F.col("demand_label")),
            "price_low": low,
            "price_high": high,
        }
    )
