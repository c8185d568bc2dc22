"""Every registered query: a name and a function of the tables of one data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.fixed_values import FEATURES
from tarifa.functions import rules
from tarifa.functions.fare_codes import scoring_features
from tarifa.functions.numbers import stable
from tarifa.functions.rules import PRICE_CEILING, PRICE_FLOOR
from tarifa.functions.text import duration_minutes, first_item
from tarifa.operators import (
    cleaning,
    dimensions,
    encoding,
    facts,
    key_filter,
    leafwise,
    metrics,
    month_grids,
    partials,
    pricing,
    quality,
    rejects,
    sampling,
    staging,
    stopping,
    target_means,
    training,
    upsert,
)
from tarifa.plans.tables import FIRST_LOAD_END, Tables, before_first_load_end, requote
from tarifa.session import new_path, save
from tarifa.sources import generator, interleaved, seeds, tables
from tarifa.sources.tables import read_table

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[function.__name__] = function
    return function


# Sources and sinks


@query
def raw_flights(t: Tables) -> DataFrame:
    return t.raw.drop("_LOADED_AT")


@query
def csv_to_parquet(t: Tables) -> DataFrame:
    """The raw rows through CSV files, with line breaks inside a field."""
    csv_path, parquet_path = new_path(t.spark, "csv"), new_path(t.spark, "parquet")
    broken = F.replace("SEGMENTSEQUIPMENTDESCRIPTION", F.lit("||"), F.lit("|\n|"))
    payload = t.raw.drop("_LOADED_AT").withColumn("SEGMENTSEQUIPMENTDESCRIPTION", broken)
    # As plain text these files are most of what the query stores.
    tables.write_csv(payload, csv_path, compression="lz4")
    tables.csv_to_parquet(t.spark, csv_path, parquet_path, payload.schema)
    return t.spark.read.schema(payload.schema).parquet(parquet_path)


def _seed_file(t: Tables, seed: Callable[..., DataFrame]) -> DataFrame:
    """Reference data by way of a CSV file."""
    path = new_path(t.spark, "seed")
    tables.write_csv(seed(t.spark), path)
    return seed(t.spark, path)


@query
def seed_airports(t: Tables) -> DataFrame:
    """The airports with their departures and arrivals."""
    airports = _seed_file(t, seeds.airports)
    flights = t.fact.select(
        F.inline(
            F.array(
                F.struct(F.col("origin_airport_key").alias("airport"), F.lit(1).alias("departure")),
                F.struct(F.col("dest_airport_key").alias("airport"), F.lit(0).alias("departure")),
            )
        )
    )
    counts = flights.groupBy("airport").agg(
        F.count_if(F.col("departure") == 1).alias("departures"),
        F.count_if(F.col("departure") == 0).alias("arrivals"),
    )
    return airports.join(counts, F.col("code") == F.col("airport"), "left").select(
        "code",
        "name",
        "city",
        "state",
        F.coalesce("departures", F.lit(0)).alias("departures"),
        F.coalesce("arrivals", F.lit(0)).alias("arrivals"),
    )


def _flights_per_day(t: Tables) -> DataFrame:
    return t.fact.groupBy("flight_date").agg(F.count(F.lit(1)).alias("day_flights"))


@query
def seed_holidays(t: Tables) -> DataFrame:
    """The holidays with the flights of the day."""
    days = _flights_per_day(t)
    joined = _seed_file(t, seeds.holidays).join(days, F.col("holiday_date") == F.col("flight_date"), "left")
    return joined.select(
        "holiday_name", "holiday_date", F.coalesce("day_flights", F.lit(0)).alias("flights")
    )


@query
def bronze_append(t: Tables) -> DataFrame:
    """Two batches generated from the orders, appended to one raw table."""
    path = new_path(t.spark, "bronze")
    orders = read_table(t.spark, t.folder, "orders").select("o_orderkey", "o_orderdate")
    for seed in (1, 2):
        tables.append_bronze(
            generator.generate_itineraries(orders, "o_orderkey", "o_orderdate", seed), path
        )
    return tables.read_bronze(t.spark, path).drop("_LOADED_AT", tables.RAW_MONTH)


@query
def generate_itineraries(t: Tables) -> DataFrame:
    """One synthetic itinerary per order, searched on the order date."""
    orders = read_table(t.spark, t.folder, "orders").select("o_orderkey", "o_orderdate")
    return generator.generate_itineraries(orders, "o_orderkey", "o_orderdate")


@query
def sql_query(t: Tables) -> DataFrame:
    text = """
        SELECT airline_key, month(flight_date) AS flight_month, count(*) AS flights,
               CAST(sum(total_fare) AS DECIMAL(20,2)) AS revenue, max(fare_per_mile) AS top_fare_per_mile
        FROM {fact} GROUP BY airline_key, month(flight_date)"""
    return tables.run_sql(t.spark, text, fact=t.fact)


@query
def materialize_table(t: Tables) -> DataFrame:
    return tables.write_table(t.routes.drop("created_at"), new_path(t.spark, "routes"))


@query
def clustered_write(t: Tables) -> DataFrame:
    path = new_path(t.spark, "fact")
    return tables.write_clustered(t.fact, path, ["date_key", "airline_key"], spread=["leg_id"])


@query
def interleaved_write(t: Tables) -> DataFrame:
    """Fares by airline, read from files laid out by day and airline alike, with the share of files that a day or an airline leaves."""
    path = new_path(t.spark, "fact")
    fares = t.fact.select("leg_id", "date_key", "airline_key", "total_fare")
    table = interleaved.write_interleaved(fares, path, ["date_key", "airline_key"], spread=["leg_id"], partitions=64)
    airline, day = table.agg(F.max("airline_key"), F.max("date_key")).first()
    spared = [2 * found <= files for found, files in (
        interleaved.files_that_may_hold(table, "airline_key", airline), interleaved.files_that_may_hold(table, "date_key", day)
    )]
    by_airline = table.groupBy("airline_key").agg(
        F.count(F.lit(1)).alias("flights"), F.min("date_key").alias("first_day"), F.sum("total_fare").alias("revenue")
    )
    return by_airline.withColumns({"airline_spares_files": F.lit(spared[0]), "day_spares_files": F.lit(spared[1])})


@query
def incremental_upsert(t: Tables) -> DataFrame:
    """Both loads are dealt by id before they are staged; from there on only the ids of the batch move."""
    # No fewer tasks than a join has: the rows stay where they are dealt, and the ids of the batch are sent to them.
    raw = t.dealt_raw(int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    # Of an id's rows the newest is kept, so the newest date of all rows is that of the loaded ones.
    mark = upsert.newest_date(t.early)
    target = upsert.one_per_key(before_first_load_end(staging.stage_flights(raw).drop("loaded_at")))
    arrived = staging.stage_flights(upsert.since_mark(requote(raw), mark)).drop("loaded_at")
    batch = save(upsert.one_per_key(arrived), "batch")
    return upsert.upsert(target, batch)


@query
def month_key_filter(t: Tables) -> DataFrame:
    """Per month of the first load: its rows, and those whose key a batch of the quarter around its end holds, found through stored
    filters; months that the filters rule out are not read."""
    path, month = new_path(t.spark, "staging"), upsert.MONTH
    early = before_first_load_end(staging.stage_flights(t.dealt_raw()).drop("loaded_at"))
    loaded = upsert.one_per_key(early).withColumn(month, upsert.search_month())
    upsert.write_months(loaded, path)
    current = t.spark.read.schema(loaded.schema).parquet(path)
    key_filter.write_filters(current, upsert.filters_path(path), upsert.KEY, month)
    late = t.staging.where(F.col("search_date") >= F.date_sub(F.lit(FIRST_LOAD_END).cast("date"), 60))
    batch = save(late.select(upsert.KEY).distinct(), "batch")
    filters = key_filter.read_filters(t.spark, upsert.filters_path(path), month)
    known = upsert.rows_of_known_keys(current, batch, filters).groupBy(month).agg(F.count(F.lit(1)).alias("known_rows"))
    rows = current.groupBy(month).agg(F.count(F.lit(1)).alias("table_rows"))
    return rows.join(known, month, "left").select(month, "table_rows", F.coalesce("known_rows", F.lit(0)).alias("known_rows"))


@query
def dims_incremental(t: Tables) -> DataFrame:
    """Routes and airlines after two loads of which the second replaces rows of the first, from counts that the loads kept up."""
    path = new_path(t.spark, "staging")
    early = F.col("SEARCHDATE") < F.lit(FIRST_LOAD_END).cast("date")
    dealt = t.dealt_raw()
    upsert.load_batch(t.spark, path, t.raw.where(early), "first", dealt=dealt.where(early))
    upsert.load_batch(t.spark, path, t.requoted, "requoted", dealt=requote(dealt))
    counts = save(partials.read_counts(t.spark, upsert.counts_path(path), upsert.MONTH), "counts")
    routes = partials.routes(counts).select(F.lit("route").alias("kind"), F.col("route_key").alias("key"), F.col("distance_miles").cast("string").alias("value"))
    return routes.unionByName(partials.airlines(counts).select(F.lit("airline").alias("kind"), F.col("airline_code").alias("key"), F.col("airline_name").alias("value")))


@query
def schema_sync(t: Tables) -> DataFrame:
    """Old rows lose ``elapsed_days`` and gain an empty ``primary_cabin``."""
    split_day = F.lit(FIRST_LOAD_END).cast("date")
    kept = ["leg_id", "search_date", "total_fare"]
    old = t.staging.where(F.col("search_date") < split_day).select(*kept, "elapsed_days")
    new = t.staging.where(F.col("search_date") >= split_day).select(*kept, "primary_cabin")
    return tables.sync_schema(old, new)


# Staging


@query
def staging_parse(t: Tables) -> DataFrame:
    return staging.parse_flights(t.raw).drop("loaded_at")


@query
def parse_duration(t: Tables) -> DataFrame:
    minutes = duration_minutes(F.col("TRAVELDURATION"))
    return t.raw.select(
        F.col("LEGID").alias("leg_id"),
        F.col("TRAVELDURATION").alias("travel_duration"),
        minutes.alias("travel_duration_minutes"),
    )


def damaged(raw: DataFrame) -> DataFrame:
    """The raw rows as text, some of it damaged, by the last digit of the id."""
    digit = F.right("LEGID", F.lit(1))
    spoilt = {"1": ("SEARCHDATE", "31/12/2024"), "2": ("TOTALFARE", "12,50"), "3": ("TRAVELDURATION", "5h30"),
              "4": ("SEATSREMAINING", "many"), "5": ("BASEFARE", " "), "6": ("FLIGHTDATE", "soon")}
    texts = raw.withColumns({name: F.col(name).cast("string") for name in rejects.PARSED})
    return texts.withColumns({name: F.when(digit == at, text).otherwise(F.col(name)) for at, (name, text) in spoilt.items()})


@query
def reject_summary(t: Tables) -> DataFrame:
    """Damaged raw rows: rows kept and rejected, by reason, and values that did not parse."""
    return rejects.summary(rejects.audit(damaged(t.raw)))


@query
def staging_derive(t: Tables) -> DataFrame:
    return staging.derive_flights(staging.parse_flights(t.raw)).select(
        "leg_id",
        "days_until_flight",
        "num_segments",
        "first_departure_epoch",
        "last_arrival_epoch",
        "primary_carrier",
        "primary_cabin",
        "taxes_and_fees",
    )


@query
def staging_filter(t: Tables) -> DataFrame:
    return t.staging


# Star schema


@query
def fact_flight_prices(t: Tables) -> DataFrame:
    return t.fact


@query
def fare_per_mile(t: Tables) -> DataFrame:
    return t.fact.select("leg_id", "total_fare", "total_travel_distance", "fare_per_mile")


@query
def dim_date(t: Tables) -> DataFrame:
    """The calendar with the flights of each day."""
    days = _flights_per_day(t)
    joined = t.calendar.join(days, F.col("date_day") == F.col("flight_date"), "left")
    return joined.select(
        *t.calendar.columns, F.coalesce("day_flights", F.lit(0)).alias("flights")
    )


@query
def dim_routes(t: Tables) -> DataFrame:
    return t.routes.drop("created_at")


@query
def dim_airlines(t: Tables) -> DataFrame:
    return dimensions.airlines(t.staging).drop("created_at")


@query
def airline_name_frequency(t: Tables) -> DataFrame:
    return dimensions.airline_name_frequency(t.staging)


@query
def flatten_segments(t: Tables) -> DataFrame:
    return dimensions.flatten_airlines(t.staging)


@query
def ml_flight_pricing(t: Tables) -> DataFrame:
    return t.ml


@query
def airline_existence(t: Tables) -> DataFrame:
    return facts.with_known_airline(t.fact, t.airlines).select("leg_id", "airline_key", "total_fare")


@query
def role_playing_airports(t: Tables) -> DataFrame:
    joined = facts.with_cities(t.fact, t.airports)
    return joined.select("leg_id", "origin_airport_key", "origin_city", "dest_airport_key", "dest_city")


@query
def route_distance_lookup(t: Tables) -> DataFrame:
    origin, dest, given = (
        F.col(c) for c in ("startingAirport", "destinationAirport", "totalTravelDistance")
    )
    return t.requests.select(
        "request_id", origin, dest, given, rules.route_distance(origin, dest, given).alias("route_distance")
    )


@query
def high_water_mark(t: Tables) -> DataFrame:
    """The mark of the first load, with the later raw rows on each side of it."""
    mark = upsert.newest_date(t.early)
    arrivals = upsert.since_mark(t.requoted, mark).agg(F.count(F.lit(1)).alias("eligible_rows"))
    return arrivals.select(F.lit(mark).cast("date").alias("high_water_mark"), "eligible_rows")


@query
def late_data_policy(t: Tables) -> DataFrame:
    return upsert.classify_arrivals(t.requoted, save(t.first_load, "staging"))


# Training


@query
def fare_features_train(t: Tables) -> DataFrame:
    return t.fared


@query
def zero_seat_filter(t: Tables) -> DataFrame:
    return cleaning.zero_seat_summary(t.ml)


@query
def training_clean(t: Tables) -> DataFrame:
    return cleaning.clean_training_rows(t.fared)


def _with_outliers(t: Tables) -> DataFrame:
    """Clean rows, with some fares and durations enlarged: the derived ones hold no outliers."""
    seats, fare, minutes = (F.col(c) for c in ("seats_remaining", "total_fare", "travel_duration_minutes"))
    return cleaning.clean_training_rows(t.fared).withColumns(
        {
            "total_fare": F.when(seats == 1, fare * 20).otherwise(fare).cast("decimal(12,2)"),
            "travel_duration_minutes": F.when(seats == 2, minutes * 10).otherwise(minutes),
        }
    )


@query
def iqr_trim(t: Tables) -> DataFrame:
    return cleaning.trim_outliers(save(_with_outliers(t), "clean"))


@query
def iqr_bounds(t: Tables) -> DataFrame:
    rows = save(_with_outliers(t), "clean")
    names = ("total_fare", "travel_duration_minutes")
    found = [(name, *cleaning.fence(rows, name)) for name in names]
    return t.spark.createDataFrame(
        found, "column_name string, q1 double, q3 double, lower_bound double, upper_bound double"
    )


@query
def month_quantiles(t: Tables) -> DataFrame:
    """The fences over a table stored by month: from counts per month, and the rows of the quartiles' cells alone."""
    path, month = new_path(t.spark, "staging"), upsert.MONTH
    loaded = t.first_load.withColumn(month, upsert.search_month())
    upsert.write_months(loaded, path)
    table, names = t.spark.read.schema(loaded.schema).parquet(path), ["total_fare", "travel_duration_minutes"]
    grid = save(month_grids.month_counts(table, names, month), "grid")
    found = []
    for name in names:
        q1, q3 = month_grids.exact(table, grid, name, [0.25, 0.75], month)
        near = month_grids.approximate(grid, name, [0.25, 0.75])
        close = all(abs(a - b) <= 0.011 * b + 1 for a, b in zip(near, (q1, q3)))
        lower, upper = round(q1 - 2.5 * (q3 - q1), 6), round(q3 + 2.5 * (q3 - q1), 6)
        found.append((name, round(q1, 6), round(q3, 6), lower, upper, close))
    return t.spark.createDataFrame(
        found, "column_name string, q1 double, q3 double, lower_bound double, upper_bound double, grid_is_close boolean"
    )


@query
def cleaning_audit(t: Tables) -> DataFrame:
    return cleaning.cleaning_audit(save(t.fared, "fared"))


@query
def label_encode(t: Tables) -> DataFrame:
    return t.prepared[0]


@query
def encoder_classes(t: Tables) -> DataFrame:
    return t.prepared[1]


@query
def ensemble_features(t: Tables) -> DataFrame:
    """The second training input: flags as small integers and four coded categories."""
    code = F.upper("FAREBASISCODE")
    passenger = F.when(code.contains("CH"), "child").when(code.contains("IN"), "infant").otherwise("adult")
    rows = t.raw.select(
        F.col("LEGID").alias("leg_id"),
        F.col("ISBASICECONOMY").alias("is_basic_economy"),
        F.col("ISREFUNDABLE").alias("is_refundable"),
        F.col("STARTINGAIRPORT").alias("starting_airport"),
        F.col("DESTINATIONAIRPORT").alias("destination_airport"),
        passenger.alias("passenger_type"),
        first_item(F.col("SEGMENTSAIRLINECODE")).alias("carrier_category"),
        F.col("TOTALFARE").alias("total_fare"),
    )
    rows = save(encoding.small_flags(rows, ["is_basic_economy", "is_refundable"]), "ensemble")
    names = ["starting_airport", "destination_airport", "passenger_type", "carrier_category"]
    return encoding.encode(rows, save(encoding.fit_codes(rows, names), "codes"), names)


@query
def ordered_target_means(t: Tables) -> DataFrame:
    """Fares with the mean fare of their airline over earlier rows, and over all rows as a new row would see it."""
    fares = t.fact.select("leg_id", "airline_key", "total_fare")
    seen = target_means.with_ordered_means(fares, "airline_key", "total_fare", ["leg_id"], prior=300.0, weight=2.0)
    totals = save(target_means.category_totals(fares, "airline_key", "total_fare"), "totals")
    served = target_means.with_known_means(seen, totals, "airline_key", 300.0, 2.0, output="served_mean")
    return served.select("leg_id", "airline_key", "total_fare", stable(F.col("airline_key_mean")).alias("earlier_mean"), stable(F.col("served_mean")).alias("served_mean"))


@query
def feature_vector(t: Tables) -> DataFrame:
    return t.prepared[0].select(encoding.feature_columns())


@query
def encode_categories(t: Tables) -> DataFrame:
    """Request categories by the training codes; airport codes are no city names and become 0."""
    names = training.REQUEST_CATEGORIES
    coded = encoding.encode(t.valid_requests, t.prepared[1], names, suffix="_encoded")
    return coded.select(
        "request_id",
        *[F.col(column).alias(feature) for feature, column in names.items()],
        *[F.col(f"{column}_encoded").alias(f"{feature}_encoded") for feature, column in names.items()],
    )


@query
def sample_30(t: Tables) -> DataFrame:
    return sampling.sample_rows(t.ml, 0.3)


@query
def train_test_split(t: Tables) -> DataFrame:
    return sampling.mark_test_rows(t.ml, 0.1)


@query
def preview(t: Tables) -> DataFrame:
    return sampling.preview(t.ml, t.ml.columns)


# Metrics over stand-in predictions, which are exact in both engines


def _with_predictions(t: Tables) -> DataFrame:
    base = F.col("base_fare").cast("double")
    return t.fact.select(
        "total_fare",
        (base * 1.1).alias("prediction_1"),
        (base + 40).alias("prediction_2"),
        (base * 1.25 - 10).alias("prediction_3"),
    )


@query
def regression_metrics(t: Tables) -> DataFrame:
    return metrics.regression_metrics(_with_predictions(t), prediction="prediction_1")


@query
def ensemble_blend(t: Tables) -> DataFrame:
    blended = metrics.blend(["prediction_1", "prediction_2", "prediction_3"])
    rows = _with_predictions(t).withColumn("prediction", blended)
    return metrics.regression_metrics(rows)


# Models. ``train_gbt`` and ``train_ensemble`` train the regressors at their full sizes; the queries about what is done with a model use few
# trees, ``SIZES``. Predictions depend on the library's sampling, so the queries publish what holds of them in any engine: which rows were
# scored, and what a right model fulfils.

SIZES = {"trees": 8, "depth": 5}
MODEL_COLUMNS = ["total_fare", *FEATURES]


def _marked(t: Tables) -> DataFrame:
    return sampling.mark_test_rows(t.prepared[0], 0.1, MODEL_COLUMNS)


def _small_model(t: Tables):
    # Training reads its table three times.
    marked = save(_marked(t), "marked")
    return training.fit(marked.where("NOT is_test").drop("is_test"), training.boosted_trees(**SIZES))


@query
def train_gbt(t: Tables) -> DataFrame:
    """Hold-out rows, and whether the model explains more than their mean: up to 1,500 rounds of trees of depth 10, which stop after 50
    without gain on the hold-out rows."""
    marked = save(_marked(t), "marked")
    model = stopping.fit_with_patience(marked).model
    found = metrics.regression_metrics(training.score(model, marked.where("is_test")))
    return found.select("rows_scored", (F.col("r2") > 0).alias("better_than_mean"))


@query
def patience_stopping(t: Tables) -> DataFrame:
    """Hold-out rows, whether the chosen round has the smallest loss of all rounds looked at and no more of them follow than the
    patience allows, and whether the model cut there has that loss."""
    marked, patience = save(_marked(t), "marked"), 3
    found = stopping.fit_with_patience(marked, rounds=24, patience=patience, depth=4, rate=0.5)
    scored = training.score(found.model, marked.where("is_test"))
    least, looked_at = min(found.losses), len(found.losses)
    wasted = looked_at - found.best
    error = F.avg(F.pow(F.col("prediction") - F.col("total_fare").cast("double"), 2))
    return scored.agg(F.count(F.lit(1)).alias("rows_scored"), error.alias("error")).select(
        "rows_scored",
        F.lit(found.losses[found.best - 1] == least).alias("best_is_least"),
        F.lit(wasted == patience or (wasted < patience and looked_at == 24)).alias("stops_in_time"),
        (F.abs(F.col("error") - least) <= 1e-6 * least).alias("cut_model_has_loss"),
    )


@query
def train_ensemble(t: Tables) -> DataFrame:
    """The same for three regressors and their blend, and whether the blend is the weighted sum of the three. Both boosted ones stop like
    ``train_gbt``, the forest has 100 trees of depth 10."""
    marked = save(_marked(t), "marked")
    train, scored = marked.where("NOT is_test").drop("is_test"), marked.where("is_test").drop("is_test")
    regressors = {
        "boosted": lambda: stopping.fit_with_patience(marked).model,
        "boosted_shallow": lambda: stopping.fit_with_patience(marked, depth=3, seed=7).model,
        "forest": lambda: training.fit(train, training.random_forest()),
    }
    for name, fitted in regressors.items():
        scored = training.score(fitted(), scored, output=name)
    scored = scored.withColumn("blend", metrics.blend(list(regressors)))
    low, high = F.least(*regressors), F.greatest(*regressors)
    stacked = scored.withColumn("between", F.col("blend").between(low - 1e-6, high + 1e-6)).unpivot(
        ["total_fare", "between"], [*regressors, "blend"], "model", "prediction"
    )
    found = stacked.groupBy("model").agg(*metrics.metric_columns("total_fare", "prediction"), F.every("between").alias("blend_is_mean"))
    return found.select("model", "rows_scored", (F.col("r2") > 0).alias("better_than_mean"), "blend_is_mean")


@query
def train_blend(t: Tables) -> DataFrame:
    """Three unlike regressors and their blend on the hold-out rows: boosted trees, leaf-wise trees, and boosted trees over ordered
    mean fares of the airline in place of its code."""
    marked = save(_marked(t), "marked")
    train, held_out = marked.where("NOT is_test").drop("is_test"), marked.where("is_test").drop("is_test")
    scored = training.score(training.fit(train, training.boosted_trees(**SIZES)), held_out, output="boosted")
    grown = leafwise.fit(train, trees=SIZES["trees"] // 2, leaves=15, rate=0.3)
    scored = leafwise.score(grown, scored, "leafwise")
    mean = {"category": "airline_code", "prior": 300.0, "output": "airline_code"}
    # Training reads its table three times.
    ordered = save(target_means.with_ordered_means(train, label="total_fare", key=MODEL_COLUMNS, **mean), "ordered")
    totals = save(target_means.category_totals(train, "airline_code", "total_fare"), "totals")
    known = target_means.with_known_means(scored.withColumn("code", F.col("airline_code")), totals, **mean)
    scored = training.score(training.fit(ordered, training.boosted_trees(**SIZES)), known, output="ordered")
    names = ["boosted", "leafwise", "ordered"]
    scored = scored.withColumn("blend", metrics.blend(names))
    stacked = scored.unpivot("total_fare", [*names, "blend"], "model", "prediction")
    found = stacked.groupBy("model").agg(*metrics.metric_columns("total_fare", "prediction"))
    largest = max(len(set(t.left) | set(t.right)) for t in grown.trees)
    return found.select(
        "model", "rows_scored", (F.col("r2") > 0).alias("better_than_mean"), F.lit(largest > 0 and len(grown.trees) == SIZES["trees"] // 2).alias("trees_grown")
    )


@query
def score_table(t: Tables) -> DataFrame:
    """Scored rows by airline code, and those with a prediction that is a number."""
    scored = training.score(_small_model(t), t.prepared[0])
    number = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return scored.groupBy("airline_code").agg(F.count(F.lit(1)).alias("rows_scored"), F.count_if(number).alias("rows_predicted"))


@query
def feature_importance_topk(t: Tables) -> DataFrame:
    """Ranks of the ten most important features: values fall, are shares, and belong to features of the model."""
    top = training.feature_importance(t.spark, _small_model(t))
    found = top.agg(F.sort_array(F.collect_list(F.struct("importance", "feature")), asc=False).alias("top"))
    listed = found.select("top", F.posexplode("top").alias("position", "one"))
    before = F.get("top", F.col("position") - 1)["importance"]
    return listed.select(
        (F.col("position") + 1).cast("int").alias("importance_rank"),
        F.coalesce(F.col("one.importance") <= before, F.lit(True)).alias("falls"),
        F.col("one.importance").between(0, 1).alias("is_share"),
        F.col("one.feature").isin(FEATURES).alias("is_feature"),
    )


@query
def model_roundtrip(t: Tables) -> DataFrame:
    """Per request: a model that was stored and loaded predicts the same as before, and the price keeps its bounds."""
    path, model, codes = new_path(t.spark, "model"), _small_model(t), t.prepared[1]
    training.save_model(model, codes, path)
    requests = t.valid_requests.drop("ml_prediction")
    # Both models score the same row, so requests are derived once and two predictions meet without a join.
    expected = training.score_requests(model, codes, requests).select(*requests.columns, F.col("ml_prediction").alias("expected"))
    rows = pricing.with_price(pricing.with_factors(training.score_requests(*training.load_model(t.spark, path), expected)))
    prediction, price = F.col("ml_prediction"), F.col("final_price")
    bounds = price.between(prediction * PRICE_FLOOR - 0.5, prediction * PRICE_CEILING + 0.5)
    found = rows.groupBy("request_id").agg(
        F.sort_array(F.collect_list(stable(prediction))).alias("predictions"),
        F.sort_array(F.collect_list(stable(F.col("expected")))).alias("expected"),
        F.every(F.coalesce(bounds, prediction == 0)).alias("bounded"),
    )
    return found.select(
        "request_id",
        F.size("predictions").cast("long").alias("requests"),
        (F.col("predictions") == F.col("expected")).alias("same_prediction"),
        F.col("bounded").alias("price_in_bounds"),
    )


# Pricing


@query
def validate_requests(t: Tables) -> DataFrame:
    checked = pricing.with_violations(pricing.with_defaults(t.requests))
    return checked.select(
        "request_id",
        F.array_join("violations", ",").alias("violations"),
        pricing.is_valid_request().alias("is_valid"),
    )


@query
def request_defaults(t: Tables) -> DataFrame:
    filled = pricing.with_defaults(t.requests)
    prices = F.col("competitor_prices")
    flat = filled.withColumns(
        {
            "price_count": F.size(prices),
            "price_1": F.get(prices, F.lit(0)),
            "price_2": F.get(prices, F.lit(1)),
            "nonstop_by_segments": F.col("numSegments") == 1,
        }
    )
    return flat.drop("competitor_prices", "cabinCategory", "passengerType")


@query
def fare_features_serve(t: Tables) -> DataFrame:
    features = scoring_features(F.col("fareBasisCode"), F.col("departureHour"), F.col("flightDate"))
    return t.requests.select(
        "request_id",
        "fareBasisCode",
        "departureHour",
        "flightDate",
        *[column.alias(name) for name, column in features.items()],
    )


@query
def serve_features(t: Tables) -> DataFrame:
    featured = pricing.request_features(t.valid_requests)
    return featured.select("request_id", *encoding.FEATURES)


def _factored(t: Tables) -> DataFrame:
    return pricing.with_factors(pricing.request_features(t.valid_requests))


@query
def demand_factor(t: Tables) -> DataFrame:
    return _factored(t).select(
        "request_id", "is_weekend", "flight_month", "flight_day_of_week", "days_until_flight", "demand"
    )


@query
def inventory_factor(t: Tables) -> DataFrame:
    return _factored(t).select("request_id", "seats_remaining", "total_seats", "inventory")


@query
def time_factor(t: Tables) -> DataFrame:
    return _factored(t).select("request_id", "days_until_flight", "time")


@query
def competition_factor(t: Tables) -> DataFrame:
    return _factored(t).select("request_id", "ml_prediction", "competition")


@query
def seasonality_factor(t: Tables) -> DataFrame:
    return _factored(t).select("request_id", "season", "seasonality")


@query
def dynamic_price(t: Tables) -> DataFrame:
    return pricing.with_price(_factored(t)).select(
        "request_id", "ml_prediction", "final_price", "total_adjustment"
    )


@query
def factor_labels(t: Tables) -> DataFrame:
    labels = [f"{name}_label" for name in pricing.FACTORS]
    return pricing.with_labels(_factored(t)).select("request_id", *labels)


@query
def price_breakdown(t: Tables) -> DataFrame:
    amounts = [f"{name}_amount" for name in pricing.FACTORS]
    return pricing.with_breakdown(_factored(t)).select("request_id", "ml_prediction", *amounts)


@query
def confidence_label(t: Tables) -> DataFrame:
    return pricing.with_price(_factored(t)).select(
        "request_id",
        "origin_city",
        "dest_city",
        "days_until_flight",
        "seats_remaining",
        "ml_prediction",
        "confidence",
    )


@query
def price_requests(t: Tables) -> DataFrame:
    priced = pricing.price_requests(t.valid_requests)
    parts = [f"{name}_{kind}" for name in pricing.FACTORS for kind in ("label", "amount")]
    return priced.select(
        "request_id", "ml_prediction", "final_price", "total_adjustment", "confidence", *parts
    )


@query
def price_response(t: Tables) -> DataFrame:
    answers = pricing.responses(pricing.price_requests(t.valid_requests), keep=["request_id"])
    flat = [
        F.col(f"{group}.{name}").alias(f"{group}_{name}")
        for group in ("factors", "breakdown", "features_summary")
        for name in answers.schema[group].dataType.names
    ]
    nested = ("factors", "breakdown", "features_summary")
    return answers.select(*[c for c in answers.columns if c not in nested], *flat)


@query
def price_batch(t: Tables) -> DataFrame:
    return pricing.price_batch(t.requests, keep=["request_id"])


@query
def batch_summary(t: Tables) -> DataFrame:
    return pricing.batch_summary(pricing.price_batch(t.requests))


def _displayed(t: Tables) -> DataFrame:
    return pricing.display_columns(pricing.price_requests(t.valid_requests))


@query
def seat_status(t: Tables) -> DataFrame:
    return _displayed(t).select("request_id", "seatsRemaining", "seat_status")


@query
def demand_level(t: Tables) -> DataFrame:
    return _displayed(t).select("request_id", "demand_label", "demand_level")


@query
def price_range(t: Tables) -> DataFrame:
    return _displayed(t).select("request_id", "final_price", "price_low", "price_high")


# Quality


@query
def dq_not_null(t: Tables) -> DataFrame:
    return quality.null_counts(t.fact, "flight_prices", t.fact.columns)


@query
def dq_unique(t: Tables) -> DataFrame:
    return quality.repeated_values(t.fact, "leg_id")


@query
def dq_accepted_values(t: Tables) -> DataFrame:
    found = [
        quality.unaccepted_values(t.fact, "primary_cabin", ["coach", "first"]).withColumnRenamed(
            "primary_cabin", "found"
        ),
        quality.unaccepted_values(t.ml, "is_holiday", [0, 1]).select(
            F.col("is_holiday").cast("string").alias("found"), "copies"
        ),
    ]
    return tables.union_all(found)


@query
def dq_report(t: Tables) -> DataFrame:
    """All declared checks, over tables stored once."""
    staged = save(t.staging, "staging")
    fact = facts.flight_prices(staged)
    airlines = save(dimensions.airlines(staged), "airlines")
    return quality.check_tables(
        {
            "staging": staged,
            "airlines": airlines,
            "routes": dimensions.routes(staged),
            "calendar": t.calendar,
            "flight_prices": fact,
            "ml_features": facts.ml_features(fact, t.calendar, airlines, t.airports),
        }
    )


# Streams


@query
def stream_upsert(t: Tables) -> DataFrame:
    """Three arrivals through the file stream: the first load, all raw rows quoted again, and, under a new checkpoint that numbers
    its batches from 0, the raw rows once more, which are late or change nothing."""
    from tarifa.streaming.loads import stream_into_staging

    landing, again, table = (new_path(t.spark, n) for n in ("landing", "landing", "staging"))
    checkpoints = [new_path(t.spark, "checkpoint") for _ in range(2)]
    first = t.raw.where(F.col("SEARCHDATE") < F.lit(FIRST_LOAD_END).cast("date"))
    for arrival, folder, checkpoint in (
        (first, landing, checkpoints[0]), (t.requoted, landing, checkpoints[0]), (t.raw, again, checkpoints[1])
    ):
        arrival.write.mode("append").parquet(folder)
        stream_into_staging(t.spark, folder, table, checkpoint).awaitTermination()
    return upsert.read_staging(t.spark, table).drop("loaded_at")


@query
def stream_deduplicated(t: Tables) -> DataFrame:
    """All raw rows, the same once more, and all of them quoted again, through the stream that drops repeats: the rows let through by
    month of search."""
    from tarifa.streaming.dedup import stream_once

    landing, output, checkpoint = (new_path(t.spark, n) for n in ("landing", "once", "checkpoint"))
    for arrival in (t.raw, t.raw, t.requoted):
        arrival.write.mode("append").option("compression", "zstd").parquet(landing)
        stream_once(t.spark, landing, output, checkpoint, delay="3000 days").awaitTermination()
    passed = t.spark.read.schema(t.raw.schema).parquet(output)
    return passed.groupBy(F.date_format("SEARCHDATE", "yyyy-MM").alias("search_month")).agg(F.count(F.lit(1)).alias("passed_rows"))


@query
def stream_price_requests(t: Tables) -> DataFrame:
    """The line items as a stream, joined with the orders, turned into requests and priced."""
    from tarifa.sources.itineraries import derive_itineraries
    from tarifa.sources.requests import derive_requests
    from tarifa.streaming.prices import price_stream

    static = read_table(t.spark, t.folder, "lineitem")
    stream = t.spark.readStream.schema(static.schema).parquet(f"{t.folder}/lineitem*.parquet")
    requests = derive_requests(derive_itineraries(stream, read_table(t.spark, t.folder, "orders")))
    output, checkpoint = new_path(t.spark, "prices"), new_path(t.spark, "checkpoint")
    price_stream(requests, output, checkpoint, keep=["request_id"]).awaitTermination()
    return t.spark.read.parquet(output)
