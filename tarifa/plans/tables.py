"""The tables every query starts from, as lazy DataFrames over one data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.operators import dimensions, facts, training
from tarifa.operators.pricing import is_valid_request, with_defaults
from tarifa.operators.staging import stage_flights
from tarifa.operators.upsert import one_per_key
from tarifa.session import save
from tarifa.sources import seeds
from tarifa.sources.itineraries import raw_flights
from tarifa.sources.requests import derive_requests

# Rows searched before this day form the first load of the incremental examples.
FIRST_LOAD_END = "2025-01-01"


class Tables:
    """Raw itineraries of a folder and the tables derived from them.

    Small tables that later joins depend on (airlines, label codes) are stored once and read back, so
    that their file size decides how they are joined.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @cached_property
    def raw(self) -> DataFrame:
        return raw_flights(self.spark, self.folder)

    def dealt_raw(self, least: int = 1) -> DataFrame:
        """The raw rows dealt by id, if there are many to ``least`` tasks or more, for loads that reduce them to one row per id."""
        return raw_flights(self.spark, self.folder, dealt=True, least=least)

    @cached_property
    def staging(self) -> DataFrame:
        return stage_flights(self.raw).drop("loaded_at")

    @cached_property
    def fact(self) -> DataFrame:
        return facts.flight_prices(self.staging)

    @cached_property
    def airports(self) -> DataFrame:
        return seeds.airports(self.spark)

    @cached_property
    def calendar(self) -> DataFrame:
        return dimensions.calendar(self.spark)

    @cached_property
    def airlines(self) -> DataFrame:
        return save(dimensions.airlines(self.staging), "airlines")

    @cached_property
    def routes(self) -> DataFrame:
        return dimensions.routes(self.staging)

    @cached_property
    def ml(self) -> DataFrame:
        return facts.ml_features(self.fact, self.calendar, self.airlines, self.airports)

    @cached_property
    def fared(self) -> DataFrame:
        return training.with_fare_features(self.ml)

    @cached_property
    def prepared(self) -> tuple[DataFrame, DataFrame]:
        """The encoded training table and its codes."""
        return training.prepare(self.ml, save)

    @cached_property
    def requests(self) -> DataFrame:
        return derive_requests(self.raw)

    @cached_property
    def valid_requests(self) -> DataFrame:
        return with_defaults(self.requests).where(is_valid_request())

    @cached_property
    def early(self) -> DataFrame:
        """Staged rows of the first load, copies included."""
        return before_first_load_end(self.staging)

    @cached_property
    def first_load(self) -> DataFrame:
        return one_per_key(self.early)

    @cached_property
    def requoted(self) -> DataFrame:
        """The raw rows as seen by a later load, see ``requote``."""
        return requote(self.raw)


def before_first_load_end(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("search_date") < F.lit(FIRST_LOAD_END).cast("date"))


def requote(raw: DataFrame) -> DataFrame:
    """Refundable fares searched again, 30 days on and 10% up."""
    again = F.col("ISREFUNDABLE")
    dearer = F.col("TOTALFARE") * F.lit(1.1).cast("decimal(2,1)")
    return raw.withColumns(
        {
            "SEARCHDATE": F.when(again, F.date_add("SEARCHDATE", 30)).otherwise(F.col("SEARCHDATE")),
            "TOTALFARE": F.when(again, dearer).otherwise(F.col("TOTALFARE")).cast("decimal(10,2)"),
        }
    )
