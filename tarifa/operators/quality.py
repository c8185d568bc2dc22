"""Declared column checks, run as aggregations, and the gate that stops a run."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.sources.tables import union_all

# The checked columns of each table.
NOT_NULL = {
    "staging": [
        "leg_id", "search_date", "flight_date", "days_until_flight", "starting_airport",
        "destination_airport", "total_fare", "seats_remaining", "num_segments", "primary_carrier",
    ],
    "airlines": ["airline_code", "airline_name"],
    "routes": ["route_key", "origin_airport", "dest_airport", "distance_miles"],
    "calendar": ["date_key"],
    "flight_prices": [
        "route_key", "date_key", "airline_key", "total_fare", "days_until_flight",
        "seats_remaining", "is_basic_economy", "is_non_stop",
    ],
    "ml_features": ["total_fare", "days_until_flight", "origin_city", "is_holiday"],
}
UNIQUE = {"airlines": ["airline_code"], "routes": ["route_key"], "calendar": ["date_key"]}
ACCEPTED = {"ml_features": {"is_holiday": [0, 1]}}


class QualityError(RuntimeError):
    """At least one check found failing rows."""


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Null rows per column, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "failures").select(
        F.lit(table).alias("table_name"), "column_name", F.lit("not_null").alias("rule"), "failures"
    )


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; nulls are not compared."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def unaccepted_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Values outside the accepted list, with their count; nulls are not compared."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(~F.col(column).isin(accepted))
    )


def check_table(df: DataFrame, table: str) -> DataFrame:
    """One row per declared check of a table, all counted in one pass over it.

    ``not_null`` counts null rows, ``unique`` values that occur more than once, ``accepted_values`` distinct values outside the
    accepted list; the last two do not compare nulls.
    """
    checks = {(column, "not_null"): F.count_if(F.col(column).isNull()) for column in NOT_NULL.get(table, [])}
    for column, accepted in ACCEPTED.get(table, {}).items():
        checks[column, "accepted_values"] = F.count_distinct(F.when(~F.col(column).isin(accepted), F.col(column)))
    names = {key: f"check_{number}" for number, key in enumerate(checks)}
    found = [check.alias(names[key]) for key, check in checks.items()]
    if table in UNIQUE:
        # The rows of one value are counted together, and the counts of all values added up.
        (column,) = UNIQUE[table]
        grouped = df.groupBy(F.col(column).alias("checked")).agg(F.count(F.lit(1)).alias("copies"), *found)
        names[column, "unique"] = "check_unique"
        repeated = F.count_if((F.col("copies") > 1) & F.col("checked").isNotNull()).alias("check_unique")
        counted = grouped.agg(repeated, *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names.values() if n != "check_unique"])
    else:
        counted = df.agg(*found)
    rows = [
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col(n).alias("failures"))
        for (c, r), n in names.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """The report over the given tables: table_name, column_name, rule, failures."""
    return union_all([check_table(df, name) for name, df in tables.items() if name in NOT_NULL])


def enforce(report: DataFrame, allow: Iterable[tuple[str, str, str]] = ()) -> None:
    """Raise when a check failed. The report has one row per check, so it is small."""
    allowed = set(allow)
    failed = [
        row
        for row in report.where("failures > 0").collect()
        if (row.table_name, row.column_name, row.rule) not in allowed
    ]
    if failed:
        texts = [f"{r.table_name}.{r.column_name} {r.rule}: {r.failures}" for r in failed]
        raise QualityError("; ".join(sorted(texts)))
