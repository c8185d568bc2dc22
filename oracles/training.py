"""Oracles for sources, staging, star schema, training and quality."""

from __future__ import annotations

from oracles.tables import FIRST_LOAD_END, query, quartiles

ORACLES: dict[str, str] = {}


def oracle(name: str, final: str, *needed: str) -> None:
    ORACLES[name] = query(final, *needed)


oracle("raw_flights", "SELECT * FROM raw", "raw")
oracle(
    "csv_to_parquet",
    """SELECT * REPLACE (nullif(FAREBASISCODE, '') AS FAREBASISCODE,
  replace(SEGMENTSEQUIPMENTDESCRIPTION, '||', '|' || chr(10) || '|') AS SEGMENTSEQUIPMENTDESCRIPTION) FROM raw""",
    "raw",
)
oracle(
    "seed_airports",
    """SELECT a.*, (SELECT count(*) FROM fact WHERE origin_airport_key = a.code) AS departures,
  (SELECT count(*) FROM fact WHERE dest_airport_key = a.code) AS arrivals FROM airports a""",
    "airports",
    "fact",
)
oracle(
    "seed_holidays",
    "SELECT h.*, (SELECT count(*) FROM fact WHERE flight_date = h.holiday_date) AS flights FROM holidays h",
    "holidays",
    "fact",
)
oracle(
    "sql_query",
    """SELECT airline_key, CAST(month(flight_date) AS INTEGER) AS flight_month, count(*) AS flights,
  CAST(sum(total_fare) AS DECIMAL(20,2)) AS revenue, max(fare_per_mile) AS top_fare_per_mile
FROM fact GROUP BY ALL""",
    "fact",
)
oracle("materialize_table", "SELECT * FROM routes", "routes")
oracle("clustered_write", "SELECT * FROM fact", "fact")
oracle(
    "interleaved_write",
    """SELECT airline_key, count(*) AS flights, min(date_key) AS first_day, CAST(sum(total_fare) AS DECIMAL(20,2)) AS revenue,
  TRUE AS airline_spares_files, TRUE AS day_spares_files FROM fact GROUP BY 1""",
    "fact",
)
oracle("incremental_upsert", "SELECT * FROM upserted", "upserted")
oracle(
    "month_key_filter",
    f"""SELECT strftime(search_date, '%Y-%m') AS search_month, count(*) AS table_rows,
  count(*) FILTER (leg_id IN (SELECT leg_id FROM staging WHERE search_date >= DATE '{FIRST_LOAD_END}' - 60)) AS known_rows
FROM loaded GROUP BY 1""",
    "loaded",
    "staging",
)
oracle(
    "dims_incremental",
    """SELECT 'route' AS kind, route_key AS key, CAST(distance_miles AS VARCHAR) AS value FROM later_routes
UNION ALL SELECT 'airline', airline_code, airline_name FROM later_airlines""",
    "later_routes",
    "later_airlines",
)
oracle("stream_upsert", "SELECT * FROM upserted", "upserted")
oracle(
    "stream_deduplicated",
    """SELECT strftime(SEARCHDATE, '%Y-%m') AS search_month, count(*) AS passed_rows FROM (
  SELECT DISTINCT LEGID, SEARCHDATE FROM raw UNION SELECT DISTINCT LEGID, SEARCHDATE FROM requoted) GROUP BY 1""",
    "raw",
    "requoted",
)
oracle(
    "schema_sync",
    f"""SELECT leg_id, search_date, total_fare,
  CASE WHEN search_date >= DATE '{FIRST_LOAD_END}' THEN primary_cabin END AS primary_cabin FROM staging""",
    "staging",
)
DAMAGED = """SELECT CASE WHEN right(LEGID, 1) NOT IN ('1') THEN SEARCHDATE END AS search_date,
  CASE WHEN right(LEGID, 1) NOT IN ('6') THEN FLIGHTDATE END AS flight_date,
  CASE WHEN right(LEGID, 1) NOT IN ('2') THEN TOTALFARE END AS total_fare,
  CASE WHEN right(LEGID, 1) NOT IN ('4') THEN SEATSREMAINING END AS seats, right(LEGID, 1) AS digit, TRAVELDURATION AS duration FROM raw"""
oracle(
    "reject_summary",
    f"""SELECT kind, name, found_rows FROM (
  WITH d AS (SELECT *, datediff('day', search_date, flight_date) AS days FROM ({DAMAGED})),
  r AS (SELECT *, coalesce(days NOT BETWEEN 0 AND 365, FALSE) AS range_bad, coalesce(total_fare <= 0, TRUE) AS fare_bad,
    coalesce(seats < 0, TRUE) AS seats_bad FROM d),
  c AS (SELECT count(*) AS n, count(*) FILTER (search_date IS NULL OR flight_date IS NULL OR range_bad OR fare_bad OR seats_bad) AS bad,
    count(*) FILTER (search_date IS NULL) AS no_search, count(*) FILTER (flight_date IS NULL) AS no_flight,
    count(*) FILTER (range_bad) AS range_n, count(*) FILTER (fare_bad) AS fare_n, count(*) FILTER (seats_bad) AS seats_n,
    count(*) FILTER (digit = '1') AS u0, count(*) FILTER (digit = '2') AS u1,
    count(*) FILTER (digit = '3' OR (trim(duration) <> '' AND NOT regexp_matches(duration, '^PT[0-9]+H[0-9]+M$'))) AS u2,
    count(*) FILTER (digit = '4') AS u3, count(*) FILTER (digit = '6') AS u5 FROM r)
  SELECT unnest([
    {{'kind': 'rows', 'name': 'input', 'found_rows': n}}, {{'kind': 'rows', 'name': 'kept', 'found_rows': n - bad}},
    {{'kind': 'rows', 'name': 'rejected', 'found_rows': bad}}, {{'kind': 'reason', 'name': 'no leg_id', 'found_rows': 0}},
    {{'kind': 'reason', 'name': 'no search_date', 'found_rows': no_search}},
    {{'kind': 'reason', 'name': 'no flight_date', 'found_rows': no_flight}},
    {{'kind': 'reason', 'name': 'days_until_flight out of range', 'found_rows': range_n}},
    {{'kind': 'reason', 'name': 'no positive total_fare', 'found_rows': fare_n}},
    {{'kind': 'reason', 'name': 'no seats_remaining', 'found_rows': seats_n}},
    {{'kind': 'unparsed', 'name': 'SEARCHDATE', 'found_rows': u0}}, {{'kind': 'unparsed', 'name': 'FLIGHTDATE', 'found_rows': u5}},
    {{'kind': 'unparsed', 'name': 'BASEFARE', 'found_rows': 0}}, {{'kind': 'unparsed', 'name': 'TOTALFARE', 'found_rows': u1}},
    {{'kind': 'unparsed', 'name': 'SEATSREMAINING', 'found_rows': u3}},
    {{'kind': 'unparsed', 'name': 'TOTALTRAVELDISTANCE', 'found_rows': 0}},
    {{'kind': 'unparsed', 'name': 'ELAPSEDDAYS', 'found_rows': 0}}, {{'kind': 'unparsed', 'name': 'TRAVELDURATION', 'found_rows': u2}}
  ], recursive := true) FROM c)""",
    "raw",
)
oracle("staging_parse", "SELECT * FROM parsed", "parsed")
oracle(
    "parse_duration",
    """SELECT LEGID AS leg_id, TRAVELDURATION AS travel_duration,
  CASE WHEN regexp_matches(TRAVELDURATION, '^PT[0-9]+H[0-9]+M$')
    THEN CAST(60 * CAST(regexp_extract(TRAVELDURATION, '^PT([0-9]+)H', 1) AS INTEGER)
      + CAST(regexp_extract(TRAVELDURATION, 'H([0-9]+)M$', 1) AS INTEGER) AS INTEGER) END AS travel_duration_minutes
FROM raw""",
    "raw",
)
oracle(
    "staging_derive",
    """SELECT leg_id, days_until_flight, num_segments, first_departure_epoch, last_arrival_epoch, primary_carrier,
  primary_cabin, taxes_and_fees FROM derived""",
    "derived",
)
oracle("staging_filter", "SELECT * FROM staging", "staging")
oracle("fact_flight_prices", "SELECT * FROM fact", "fact")
oracle("fare_per_mile", "SELECT leg_id, total_fare, total_travel_distance, fare_per_mile FROM fact", "fact")
oracle(
    "dim_date",
    """SELECT c.*, coalesce(f.flights, 0) AS flights FROM calendar c
LEFT JOIN (SELECT flight_date, count(*) AS flights FROM fact GROUP BY ALL) f ON f.flight_date = c.date_day""",
    "calendar",
    "fact",
)
oracle("dim_routes", "SELECT * FROM routes", "routes")
oracle("dim_airlines", "SELECT * FROM airlines", "airlines")
oracle("airline_name_frequency", "SELECT * FROM name_counts", "name_counts")
oracle("flatten_segments", "SELECT * FROM segments", "segments")
oracle("ml_flight_pricing", "SELECT * FROM ml", "ml")
oracle(
    "airline_existence",
    "SELECT leg_id, airline_key, total_fare FROM fact WHERE airline_key IN (SELECT airline_code FROM airlines)",
    "fact",
    "airlines",
)
oracle(
    "role_playing_airports",
    """SELECT leg_id, origin_airport_key, o.city AS origin_city, dest_airport_key, d.city AS dest_city FROM fact
JOIN airports o ON o.code = origin_airport_key JOIN airports d ON d.code = dest_airport_key""",
    "fact",
    "airports",
)
oracle(
    "high_water_mark",
    """SELECT m AS high_water_mark, (SELECT count(*) FROM requoted WHERE SEARCHDATE >= m) AS eligible_rows
FROM (SELECT max(search_date) AS m FROM loaded)""",
    "loaded",
    "requoted",
)
oracle(
    "late_data_policy",
    """SELECT CASE WHEN search_date < (SELECT max(search_date) FROM loaded) THEN 'late'
    WHEN NOT (days_until_flight BETWEEN 0 AND 365 AND total_fare > 0 AND seats_remaining >= 0) THEN 'invalid'
    WHEN leg_id IN (SELECT leg_id FROM loaded) THEN 'replaced' ELSE 'added' END AS outcome, count(*) AS arrived_rows
FROM requoted_rows GROUP BY ALL""",
    "requoted_rows",
    "loaded",
)
oracle("fare_features_train", "SELECT * FROM fared", "fared")
oracle(
    "zero_seat_filter",
    """SELECT count(*) AS total_rows, count(*) FILTER (seats_remaining = 0) AS zero_seat_rows,
  round(count(*) FILTER (seats_remaining = 0) * 100 / count(*), 2) AS zero_seat_percent,
  count(*) FILTER (seats_remaining <> 0) AS kept_rows FROM ml""",
    "ml",
)
oracle("training_clean", "SELECT * FROM clean", "clean")
oracle("iqr_trim", "SELECT * FROM outliers_trimmed", "outliers_trimmed")
oracle(
    "iqr_bounds",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, q1, q3, round(q1 - 2.5 * (q3 - q1), 6) AS lower_bound,
  round(q3 + 2.5 * (q3 - q1), 6) AS upper_bound FROM (SELECT {quartiles(c)} FROM outliers)"""
        for c in ("total_fare", "travel_duration_minutes")
    ),
    "outliers",
)
oracle(
    "month_quantiles",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 2.5 * (q3 - q1), 6) AS lower_bound,
  round(q3 + 2.5 * (q3 - q1), 6) AS upper_bound, TRUE AS grid_is_close FROM (SELECT {quartiles(c)} FROM loaded)"""
        for c in ("total_fare", "travel_duration_minutes")
    ),
    "loaded",
)
oracle(
    "cleaning_audit",
    """SELECT '0 loaded' AS step, count(*) AS rows_left FROM fared
UNION ALL SELECT '1 with seats', count(*) FROM fared WHERE seats_remaining <> 0
UNION ALL SELECT '2 plausible', count(*) FROM clean
UNION ALL SELECT '3 fare trimmed', count(*) FROM trimmed_fare
UNION ALL SELECT '4 duration trimmed', count(*) FROM trimmed""",
    "trimmed",
)
oracle("label_encode", "SELECT * FROM encoded", "encoded")
ENSEMBLE = """SELECT LEGID AS leg_id, CAST(ISBASICECONOMY AS TINYINT) AS is_basic_economy,
  CAST(ISREFUNDABLE AS TINYINT) AS is_refundable, STARTINGAIRPORT AS starting_airport,
  DESTINATIONAIRPORT AS destination_airport,
  CASE WHEN contains(upper(FAREBASISCODE), 'CH') THEN 'child' WHEN contains(upper(FAREBASISCODE), 'IN') THEN 'infant'
    ELSE 'adult' END AS passenger_type, string_split(SEGMENTSAIRLINECODE, '||')[1] AS carrier_category,
  TOTALFARE AS total_fare FROM raw"""
CODED = ["starting_airport", "destination_airport", "passenger_type", "carrier_category"]
oracle(
    "ensemble_features",
    "SELECT * REPLACE ("
    + ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}" for c in CODED)
    + f") FROM ({ENSEMBLE})",
    "raw",
)
oracle("encoder_classes", "SELECT * FROM codes", "codes")
FEATURES = [
    "days_until_flight", "seats_remaining", "total_travel_distance", "travel_duration_minutes", "num_segments",
    "airline_code", "origin_city", "dest_city", "flight_year", "flight_month", "flight_day_of_week", "is_weekend",
    "is_holiday", "is_basic_economy", "is_non_stop", "is_refundable", "cabin_category", "fare_rule_number",
    "passenger_type", "seasonality_proxy", "has_numeric_rule", "is_night_fare_proxy", "is_weekend_fare_proxy",
]
oracle(
    "feature_vector",
    "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES) + " FROM encoded",
    "encoded",
)
ML_COLUMNS = [
    "total_fare", "fare_basis_code", "days_until_flight", "seats_remaining", "total_travel_distance",
    "travel_duration_minutes", "num_segments", "airline_code", "origin_city", "dest_city", "flight_date_key",
    "flight_year", "flight_month", "flight_day_of_week", "is_weekend", "is_holiday", "is_basic_economy",
    "is_non_stop", "is_refundable",
]


def share(purpose: str, columns: list[str]) -> str:
    texts = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"CAST(('0x' || substr(md5(concat_ws('|', '{purpose}', '42', {texts})), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


oracle(
    "sample_30",
    f"""SELECT * EXCLUDE (copy_number)
FROM (SELECT *, row_number() OVER (PARTITION BY {", ".join(ML_COLUMNS)}) AS copy_number FROM ml)
WHERE {share("sample", [*ML_COLUMNS, "copy_number"])} < CAST(0.3 AS DOUBLE)""",
    "ml",
)
oracle(
    "ordered_target_means",
    """SELECT leg_id, airline_key, total_fare,
  round((CAST(coalesce(sum(total_fare) OVER earlier, 0) AS DOUBLE) + 600) / (count(*) OVER earlier + 2), 6) AS earlier_mean,
  round((CAST(sum(total_fare) OVER every AS DOUBLE) + 600) / (count(*) OVER every + 2), 6) AS served_mean
FROM fact WINDOW earlier AS (PARTITION BY airline_key ORDER BY md5(concat_ws('|', 'order', '42', leg_id))
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), every AS (PARTITION BY airline_key)""",
    "fact",
)
oracle("train_test_split", f"SELECT *, {share('split', ML_COLUMNS)} < CAST(0.1 AS DOUBLE) AS is_test FROM ml", "ml")
oracle(
    "preview",
    "SELECT * FROM ml ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in ML_COLUMNS) + " LIMIT 5",
    "ml",
)
HELD_OUT = f"SELECT count(*) FROM encoded WHERE {share('split', ['total_fare', *FEATURES])} < CAST(0.1 AS DOUBLE)"
oracle("train_gbt", f"SELECT ({HELD_OUT}) AS rows_scored, TRUE AS better_than_mean", "encoded")
oracle(
    "patience_stopping",
    f"SELECT ({HELD_OUT}) AS rows_scored, TRUE AS best_is_least, TRUE AS stops_in_time, TRUE AS cut_model_has_loss",
    "encoded",
)
oracle(
    "train_ensemble",
    f"""SELECT model, ({HELD_OUT}) AS rows_scored, TRUE AS better_than_mean, TRUE AS blend_is_mean
FROM (SELECT unnest(['boosted', 'boosted_shallow', 'forest', 'blend']) AS model)""",
    "encoded",
)
oracle(
    "train_blend",
    f"""SELECT model, ({HELD_OUT}) AS rows_scored, TRUE AS better_than_mean, TRUE AS trees_grown
FROM (SELECT unnest(['boosted', 'leafwise', 'ordered', 'blend']) AS model)""",
    "encoded",
)
oracle("score_table", "SELECT airline_code, count(*) AS rows_scored, count(*) AS rows_predicted FROM encoded GROUP BY ALL", "encoded")
oracle(
    "feature_importance_topk",
    "SELECT CAST(i AS INTEGER) AS importance_rank, TRUE AS falls, TRUE AS is_share, TRUE AS is_feature FROM range(1, 11) r(i)",
)
PREDICTED = """SELECT CAST(total_fare AS DOUBLE) AS y, CAST(base_fare AS DOUBLE) * CAST(1.1 AS DOUBLE) AS p1,
  CAST(base_fare AS DOUBLE) + 40 AS p2, CAST(base_fare AS DOUBLE) * CAST(1.25 AS DOUBLE) - 10 AS p3 FROM fact"""
METRICS = """SELECT count(*) AS rows_scored, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
  round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse"""
oracle("regression_metrics", f"{METRICS} FROM (SELECT y, p1 AS p FROM ({PREDICTED}))", "fact")
oracle(
    "ensemble_blend",
    f"""{METRICS} FROM (SELECT y, p1 * CAST(0.6 AS DOUBLE) + p2 * CAST(0.25 AS DOUBLE) + p3 * CAST(0.15 AS DOUBLE) AS p
FROM ({PREDICTED}))""",
    "fact",
)

FACT_COLUMNS = [
    "route_key", "date_key", "airline_key", "origin_airport_key", "dest_airport_key", "leg_id", "search_date",
    "flight_date", "primary_cabin", "fare_basis_code", "total_fare", "base_fare", "taxes_and_fees", "fare_per_mile",
    "seats_remaining", "days_until_flight", "total_travel_distance", "travel_duration_minutes", "num_segments",
    "is_basic_economy", "is_refundable", "is_non_stop",
]


def null_checks(table: str, source: str, columns: list[str]) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS rule, "
        f"count(*) - count({c}) AS failures FROM {source}"
        for c in columns
    ]


def unique_check(table: str, source: str, column: str) -> str:
    return (
        f"SELECT '{table}', '{column}', 'unique', count(*) FROM "
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    )


oracle("dq_not_null", "\nUNION ALL ".join(null_checks("flight_prices", "fact", FACT_COLUMNS)), "fact")
oracle(
    "dq_unique",
    "SELECT leg_id, count(*) AS copies FROM fact WHERE leg_id IS NOT NULL GROUP BY leg_id HAVING count(*) > 1",
    "fact",
)
oracle(
    "dq_accepted_values",
    """SELECT primary_cabin AS found, count(*) AS copies FROM fact WHERE primary_cabin NOT IN ('coach', 'first') GROUP BY ALL
UNION ALL
SELECT CAST(is_holiday AS VARCHAR), count(*) FROM ml WHERE is_holiday NOT IN (0, 1) GROUP BY ALL""",
    "fact",
    "ml",
)
oracle(
    "dq_report",
    "\nUNION ALL ".join(
        null_checks(
            "staging",
            "staging",
            [
                "leg_id", "search_date", "flight_date", "days_until_flight", "starting_airport",
                "destination_airport", "total_fare", "seats_remaining", "num_segments", "primary_carrier",
            ],
        )
        + null_checks("airlines", "airlines", ["airline_code", "airline_name"])
        + null_checks("routes", "routes", ["route_key", "origin_airport", "dest_airport", "distance_miles"])
        + null_checks("calendar", "calendar", ["date_key"])
        + null_checks(
            "flight_prices",
            "fact",
            [
                "route_key", "date_key", "airline_key", "total_fare", "days_until_flight", "seats_remaining",
                "is_basic_economy", "is_non_stop",
            ],
        )
        + null_checks("ml_features", "ml", ["total_fare", "days_until_flight", "origin_city", "is_holiday"])
        + [
            unique_check("airlines", "airlines", "airline_code"),
            unique_check("routes", "routes", "route_key"),
            unique_check("calendar", "calendar", "date_key"),
            "SELECT 'ml_features', 'is_holiday', 'accepted_values', count(DISTINCT is_holiday) FROM ml "
            "WHERE is_holiday NOT IN (0, 1)",
        ]
    ),
    "ml",
    "routes",
)
