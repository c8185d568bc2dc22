"""The daily run over stored tables: ingest, load staging, rebuild the star schema, check, publish."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.operators import dimensions, facts, partials, quality, rejects, stopping, training
from tarifa.operators.pricing import price_batch, with_defaults
from tarifa.operators.sampling import mark_test_rows, sample_rows
from tarifa.operators.upsert import KEY, load_batch, read_counts, read_staging
from tarifa.session import path_exists, save
from tarifa.sources import generator, seeds
from tarifa.sources.interleaved import write_interleaved
from tarifa.sources.tables import append_bronze, read_bronze, write_clustered, write_table


def ingest(
    spark: SparkSession,
    root: str,
    records: int = 1000,
    search_date: str | None = None,
    seed: int | None = None,
) -> int:
    """Append generated itineraries to the raw table; returns the rows added."""
    batch = generator.generate_batch(spark, records, search_date, seed)
    return append_bronze(batch, f"{root}/raw")


def refresh(spark: SparkSession, root: str, run_id: str | None = None, most_rejected: float = 1.0) -> str:
    """Load new raw rows, rebuild the gold tables, and publish them if all checks pass.

    Gold tables go to a folder of their own per run, so readers keep the last published run until the
    checks have passed, and a failed run can be repeated under its id. A published id is refused. Raw rows that are not loaded, or
    lose a value, are kept under ``rejects``; a run that rejects more than the share ``most_rejected`` of its rows is not published.
    """
    run_id = run_id or f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    if path_exists(spark, f"{root}/published"):
        if not spark.read.parquet(f"{root}/published").where(F.col("run_id") == run_id).isEmpty():
            raise ValueError(f"run {run_id!r} is published; use a new id")
    rejected = f"{root}/rejects/{run_id}"
    load_batch(spark, f"{root}/staging", read_bronze(spark, f"{root}/raw"), run_id, rejected)
    rejects.enforce(spark.read.parquet(f"{rejected}/summary"), most_rejected)
    staging = read_staging(spark, f"{root}/staging")
    build = f"{root}/gold/{run_id}"

    def store(df: DataFrame, name: str) -> DataFrame:
        return write_table(df, f"{build}/{name}", "overwrite")

    airports = store(seeds.airports(spark), "airports")
    calendar = store(dimensions.calendar(spark), "calendar")
    counts = read_counts(spark, f"{root}/staging")
    airlines = store(partials.airlines(counts), "airlines")
    routes = store(partials.routes(counts), "routes")
    fact = write_interleaved(
        facts.flight_prices(staging),
        f"{build}/flight_prices",
        ["date_key", "airline_key"],
        spread=["leg_id"],
        mode="overwrite",
    )
    wide = facts.ml_features(fact, calendar, airlines, airports)
    ml = write_clustered(
        wide, f"{build}/ml_features", ["flight_date_key"], spread=wide.columns, mode="overwrite"
    )
    report = quality.check_tables(
        {
            "staging": staging,
            "airlines": airlines,
            "routes": routes,
            "calendar": calendar,
            "flight_prices": fact,
            "ml_features": ml,
        }
    )
    quality.enforce(store(report, "quality"))
    published = spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("published_at")
    )
    published.write.mode("append").parquet(f"{root}/published")
    return run_id


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A gold table of the last published run."""
    if not path_exists(spark, f"{root}/published"):
        raise FileNotFoundError(f"no published run under {root}")
    runs = spark.read.parquet(f"{root}/published")
    run_id = runs.agg(F.max_by("run_id", "published_at")).first()[0]
    return spark.read.parquet(f"{root}/gold/{run_id}/{name}")


def train(
    spark: SparkSession,
    root: str,
    model_path: str,
    sample: float = 0.3,
    trees: int = 1500,
    patience: int = stopping.PATIENCE,
    **sizes,
) -> list[float]:
    """Train on a sample of the published fares and store model and codes; returns the hold-out loss of every boosting round.

    The fact is sampled by its key, without a shuffle, and only the sample is joined into wide rows.
    """
    fact, calendar, airlines, airports = (
        read_gold(spark, root, name) for name in ("flight_prices", "calendar", "airlines", "airports")
    )
    wide = facts.ml_features(sample_rows(fact, sample, [KEY]), calendar, airlines, airports)
    encoded, codes = training.prepare(wide, save)
    found = stopping.fit_with_patience(save(mark_test_rows(encoded), "marked"), trees, patience, **sizes)
    training.save_model(found.model, codes, model_path)
    return found.losses


def price(spark: SparkSession, requests: DataFrame, model_path: str, keep: list[str] | None = None) -> DataFrame:
    """Score and price a request table or stream with a stored model; rejected requests stay with their error."""
    model, codes = training.load_model(spark, model_path)
    scored = training.score_requests(model, codes, with_defaults(requests))
    return price_batch(scored.drop(*training.FEATURES), keep)
