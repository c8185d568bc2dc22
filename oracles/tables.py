"""Common table expressions the oracle queries build on, as DuckDB SQL over the driver tables."""

from __future__ import annotations

from tarifa.fixed_values import AIRLINES, AIRPORTS, CALENDAR_END, CALENDAR_START, EQUIPMENT, FARE_CODES, HOLIDAYS


def texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def rows(values) -> str:
    return ",\n    ".join(f"({texts(row)})" for row in values)


AIR = texts([row[0] for row in AIRPORTS] + ["XXX", "YYY"])
CODES = texts([code for code, _ in AIRLINES])
NAMES = texts([name for _, name in AIRLINES])
FARES = texts(FARE_CODES + ["F0CH", "J14INH", "wl", ""])
PLANES = texts(EQUIPMENT)


def iso(epoch: str) -> str:
    return f"strftime(make_timestamp(({epoch}) * 1000000), '%Y-%m-%dT%H:%M:%S') || '.000-05:00'"


def money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"


def seg(single: str, first: str, second: str) -> str:
    return f"CASE WHEN ns THEN CAST({single} AS VARCHAR) ELSE ({first}) || '||' || ({second}) END"


TABLES: dict[str, tuple[list[str], str]] = {}

TABLES["line"] = (
    [],
    f"""
SELECT l_orderkey, l_partkey AS p, l_suppkey AS s, l_linenumber AS n, l_quantity AS q, l_returnflag,
  l_linestatus, l_linenumber % 2 = 1 AS ns,
  CAST(o_orderdate AS DATE) + 9862 AS sd,
  CAST(o_orderdate AS DATE) + 9862 + CAST((l_partkey * 7 + l_suppkey) % 380 - 5 AS INTEGER) AS fd,
  5000 + (l_partkey * 37 + l_suppkey * 11 + l_linenumber * 101) % 75000 AS cents,
  60 + l_partkey % 340 AS m, 3600 + l_partkey % 20400 AS u, 300 + l_partkey % 2700 AS v,
  [{AIR}][l_suppkey % 24 + 1] AS o, [{AIR}][(l_partkey + 7) % 24 + 1] AS d, [{AIR}][(l_partkey + 13) % 22 + 1] AS x,
  [{CODES}][l_suppkey % 8 + 1] AS c, [{NAMES}][l_suppkey % 8 + 1] AS nm,
  [{PLANES}][l_partkey % 6 + 1] AS e1, [{PLANES}][l_suppkey % 6 + 1] AS e2
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
TABLES["timed"] = (
    ["line"],
    """
SELECT *, t + u // 2 + 2700 + s % 4500 AS t2 FROM (
  SELECT *, (fd - DATE '1970-01-01') * 86400 + 21600 + (p % 17) * 3600 AS t FROM line)""",
)
TABLES["raw"] = (
    ["timed"],
    f"""
SELECT l_orderkey || '-' || n AS LEGID, sd AS SEARCHDATE, fd AS FLIGHTDATE,
  CASE WHEN n = 3 THEN ' ' || lower(o) || ' ' ELSE o END AS STARTINGAIRPORT, d AS DESTINATIONAIRPORT,
  CASE WHEN q = 50 THEN NULL ELSE [{FARES}][p % 12 + 1] END AS FAREBASISCODE,
  CASE n WHEN 7 THEN 'P1DT2H5M' WHEN 6 THEN 'PT45M' ELSE 'PT' || m // 60 || 'H' || m % 60 || 'M' END AS TRAVELDURATION,
  CAST(0 AS INTEGER) AS ELAPSEDDAYS,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag = 'A' END AS ISBASICECONOMY,
  l_linestatus = 'O' AS ISREFUNDABLE, ns AS ISNONSTOP,
  {money("cents")} AS BASEFARE,
  CASE WHEN q = 1 THEN CAST(0 AS DECIMAL(10,2)) ELSE {money("cents + cents // 8")} END AS TOTALFARE,
  CAST((p + n * 13) % 152 - 1 AS INTEGER) AS SEATSREMAINING,
  CAST(CASE q WHEN 2 THEN NULL WHEN 3 THEN 0 ELSE v END AS DECIMAL(10,2)) AS TOTALTRAVELDISTANCE,
  {seg("t", "t", "t2")} AS SEGMENTSDEPARTURETIMEEPOCHSECONDS,
  {seg(iso("t"), iso("t"), iso("t2"))} AS SEGMENTSDEPARTURETIMERAW,
  {seg("t + u", "t + u // 2", "t2 + u - u // 2")} AS SEGMENTSARRIVALTIMEEPOCHSECONDS,
  {seg(iso("t + u"), iso("t + u // 2"), iso("t2 + u - u // 2"))} AS SEGMENTSARRIVALTIMERAW,
  {seg("d", "x", "d")} AS SEGMENTSARRIVALAIRPORTCODE,
  {seg("o", "o", "x")} AS SEGMENTSDEPARTUREAIRPORTCODE,
  CASE WHEN ns OR n = 4 THEN nm ELSE nm || '||' || nm || ' Air' END AS SEGMENTSAIRLINENAME,
  {seg("c", "c", "c")} AS SEGMENTSAIRLINECODE,
  {seg("e1", "e1", "e2")} AS SEGMENTSEQUIPMENTDESCRIPTION,
  {seg("u", "u // 2", "u - u // 2")} AS SEGMENTSDURATIONINSECONDS,
  {seg("v", "v // 2", "v - v // 2")} AS SEGMENTSDISTANCE,
  {seg("'coach'", "'business'", "'coach'")} AS SEGMENTSCABINCODE
FROM timed""",
)


def parse(source: str) -> str:
    return f"""
SELECT LEGID AS leg_id, SEARCHDATE AS search_date, FLIGHTDATE AS flight_date,
  upper(trim(STARTINGAIRPORT)) AS starting_airport, upper(trim(DESTINATIONAIRPORT)) AS destination_airport,
  coalesce(ISBASICECONOMY, FALSE) AS is_basic_economy, coalesce(ISREFUNDABLE, FALSE) AS is_refundable,
  coalesce(ISNONSTOP, FALSE) AS is_non_stop, BASEFARE AS base_fare, TOTALFARE AS total_fare,
  SEATSREMAINING AS seats_remaining, TOTALTRAVELDISTANCE AS total_travel_distance, ELAPSEDDAYS AS elapsed_days,
  CASE WHEN TRAVELDURATION LIKE 'PT%H%M' THEN
    TRY_CAST(regexp_extract_all(TRAVELDURATION, '[0-9]+')[1] AS INTEGER) * 60
    + TRY_CAST(regexp_extract_all(TRAVELDURATION, '[0-9]+')[2] AS INTEGER) END AS travel_duration_minutes,
  SEGMENTSDEPARTURETIMEEPOCHSECONDS AS segments_departure_epoch, SEGMENTSDEPARTURETIMERAW AS segments_departure_raw,
  SEGMENTSARRIVALTIMEEPOCHSECONDS AS segments_arrival_epoch, SEGMENTSARRIVALTIMERAW AS segments_arrival_raw,
  SEGMENTSARRIVALAIRPORTCODE AS segments_arrival_airports, SEGMENTSDEPARTUREAIRPORTCODE AS segments_departure_airports,
  SEGMENTSAIRLINENAME AS segments_airline_names, SEGMENTSAIRLINECODE AS segments_airline_codes,
  SEGMENTSEQUIPMENTDESCRIPTION AS segments_equipment, SEGMENTSDURATIONINSECONDS AS segments_duration_seconds,
  SEGMENTSDISTANCE AS segments_distances, SEGMENTSCABINCODE AS segments_cabin_codes,
  FAREBASISCODE AS fare_basis_code
FROM {source}"""


def derive(source: str) -> str:
    return f"""
SELECT *, CAST(datediff('day', search_date, flight_date) AS INTEGER) AS days_until_flight,
  CAST(len(string_split(segments_airline_codes, '||')) AS INTEGER) AS num_segments,
  string_split(segments_departure_epoch, '||')[1] AS first_departure_epoch,
  string_split(segments_arrival_epoch, '||')[-1] AS last_arrival_epoch,
  string_split(segments_airline_codes, '||')[1] AS primary_carrier,
  string_split(segments_cabin_codes, '||')[1] AS primary_cabin,
  CAST(total_fare - base_fare AS DECIMAL(10,2)) AS taxes_and_fees
FROM {source}"""


VALID = """leg_id IS NOT NULL AND search_date IS NOT NULL AND flight_date IS NOT NULL
  AND days_until_flight >= 0 AND days_until_flight <= 365 AND total_fare > 0 AND seats_remaining >= 0"""

TABLES["parsed"] = (["raw"], parse("raw"))
TABLES["derived"] = (["parsed"], derive("parsed"))
TABLES["staging"] = (["derived"], f"SELECT * FROM derived WHERE {VALID}")
TABLES["fact"] = (
    ["staging"],
    """
SELECT starting_airport || '_' || destination_airport AS route_key,
  CAST(strftime(flight_date, '%Y%m%d') AS INTEGER) AS date_key, primary_carrier AS airline_key,
  starting_airport AS origin_airport_key, destination_airport AS dest_airport_key, leg_id, search_date, flight_date,
  primary_cabin, fare_basis_code, total_fare, base_fare, taxes_and_fees,
  CASE WHEN total_travel_distance > 0 THEN CAST(CAST(
    (CAST(total_fare * 100 AS BIGINT) * 20000 + CAST(total_travel_distance * 100 AS BIGINT))
    // (2 * CAST(total_travel_distance * 100 AS BIGINT)) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4))
    ELSE CAST(0 AS DECIMAL(18,4)) END AS fare_per_mile,
  seats_remaining, days_until_flight, total_travel_distance, travel_duration_minutes, num_segments,
  is_basic_economy, is_refundable, is_non_stop
FROM staging WHERE total_fare > 0 AND days_until_flight >= 0""",
)
TABLES["airports"] = (
    [],
    f"SELECT * FROM (VALUES\n    {rows(AIRPORTS)}) AS a(code, name, city, state)",
)
TABLES["holidays"] = (
    [],
    f"""SELECT holiday_name, CAST(day AS DATE) AS holiday_date FROM (VALUES
    {rows(HOLIDAYS)}) AS h(holiday_name, day)""",
)
TABLES["calendar"] = (
    ["holidays"],
    f"""
SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day, CAST(year(date_day) AS INTEGER) AS year,
  CAST(month(date_day) AS INTEGER) AS month, strftime(date_day, '%b') AS month_name,
  CAST(dayofweek(date_day) AS INTEGER) AS day_of_week_num, strftime(date_day, '%a') AS day_name,
  CAST(quarter(date_day) AS INTEGER) AS quarter, 'Q' || quarter(date_day) || ' ' || year(date_day) AS quarter_name,
  dayofweek(date_day) IN (0, 6) AS is_weekend, holiday_name, holiday_name IS NOT NULL AS is_holiday
FROM (SELECT CAST(d AS DATE) AS date_day
      FROM generate_series(DATE '{CALENDAR_START}', DATE '{CALENDAR_END}', INTERVAL 1 DAY) AS g(d))
LEFT JOIN holidays ON date_day = holiday_date""",
)
TABLES["routes"] = (
    ["staging"],
    """
SELECT starting_airport || '_' || destination_airport AS route_key, starting_airport AS origin_airport,
  destination_airport AS dest_airport,
  CAST(coalesce((2 * sum(CAST(total_travel_distance * 100 AS BIGINT)) + 100 * count(total_travel_distance))
    // nullif(200 * count(total_travel_distance), 0), 0) AS INTEGER) AS distance_miles
FROM staging GROUP BY ALL""",
)
TABLES["segments"] = (
    ["staging"],
    """
SELECT CAST(i - 1 AS INTEGER) AS position, trim(codes[i]) AS airline_code, trim(names[i]) AS airline_name FROM (
  SELECT codes, names, unnest(range(1, len(codes) + 1)) AS i FROM (
    SELECT string_split(segments_airline_codes, '||') AS codes, string_split(segments_airline_names, '||') AS names
    FROM staging WHERE segments_airline_codes IS NOT NULL))
WHERE trim(codes[i]) <> ''""",
)
TABLES["name_counts"] = (
    ["segments"],
    """SELECT airline_code, airline_name, count(*) AS frequency FROM segments
WHERE airline_name <> '' GROUP BY airline_code, airline_name""",
)
TABLES["airlines"] = (
    ["name_counts"],
    """SELECT airline_code, airline_name FROM (
  SELECT *, row_number() OVER (PARTITION BY airline_code ORDER BY frequency DESC, airline_name) AS r FROM name_counts)
WHERE r = 1""",
)
TABLES["ml"] = (
    ["fact", "calendar", "airlines", "airports"],
    """
SELECT f.total_fare, f.fare_basis_code, f.days_until_flight, f.seats_remaining, f.total_travel_distance,
  f.travel_duration_minutes, f.num_segments, f.airline_key AS airline_code, o.city AS origin_city, d.city AS dest_city,
  f.date_key AS flight_date_key, c.year AS flight_year, c.month AS flight_month, c.day_of_week_num AS flight_day_of_week,
  CAST(c.is_weekend AS INTEGER) AS is_weekend, CAST(c.is_holiday AS INTEGER) AS is_holiday,
  CAST(f.is_basic_economy AS INTEGER) AS is_basic_economy, CAST(f.is_non_stop AS INTEGER) AS is_non_stop,
  CAST(f.is_refundable AS INTEGER) AS is_refundable
FROM fact f JOIN calendar c ON f.date_key = c.date_key JOIN airlines a ON f.airline_key = a.airline_code
JOIN airports o ON f.origin_airport_key = o.code JOIN airports d ON f.dest_airport_key = d.code
WHERE f.total_fare > 0""",
)
TABLES["fared"] = (
    ["ml"],
    """
SELECT * EXCLUDE (flight_date_key, code, suffix),
  CASE WHEN upper(code[1]) IN ('F','A') THEN 'First' WHEN upper(code[1]) IN ('J','C','D','I','Z','P') THEN 'Business'
    WHEN upper(code[1]) IN ('W','S','T','R') THEN 'Premium Economy' WHEN upper(code[1]) IN ('Y','B','M','H') THEN 'Full Economy'
    WHEN upper(code[1]) IN ('K','L','Q','V','U','X','N','O','G','E') THEN 'Discount Economy' ELSE 'Unknown' END AS cabin_category,
  coalesce(TRY_CAST(regexp_extract(code, '[0-9]+') AS INTEGER), 0) AS fare_rule_number,
  CASE WHEN upper(suffix) LIKE '%CH%' OR upper(suffix) LIKE '%CNN%' THEN 'Child'
    WHEN upper(suffix) LIKE '%IN%' THEN 'Infant' ELSE 'Adult' END AS passenger_type,
  CASE WHEN upper(code) LIKE '%H' THEN 'High' WHEN upper(code) LIKE '%L' THEN 'Low' ELSE 'Standard' END AS seasonality_proxy,
  CAST(coalesce(TRY_CAST(regexp_extract(code, '[0-9]+') AS INTEGER), 0) > 0 AS INTEGER) AS has_numeric_rule,
  CAST(suffix LIKE '%N%' AS INTEGER) AS is_night_fare_proxy, CAST(suffix LIKE '%W%' AS INTEGER) AS is_weekend_fare_proxy
FROM (SELECT *, coalesce(fare_basis_code, 'UNKNOWN') AS code, substr(coalesce(fare_basis_code, 'UNKNOWN'), 2) AS suffix FROM ml)""",
)
CLEAN = """seats_remaining <> 0 AND total_fare > 0 AND total_travel_distance > 0 AND travel_duration_minutes > 20
  AND seats_remaining >= 0 AND days_until_flight >= 0"""
TABLES["clean"] = (["fared"], f"SELECT * FROM fared WHERE {CLEAN}")


def quartiles(column: str) -> str:
    value = f"CAST({column} AS DOUBLE)"
    return f"quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.75) AS q3"


def upper_bound(column: str, source: str) -> str:
    return f"(SELECT round(q3 + 2.5 * (q3 - q1), 6) FROM (SELECT {quartiles(column)} FROM {source}))"


def trim(name: str, source: str) -> None:
    """Two trimming steps over ``source``: ``<name>_fare``, then ``name``."""
    TABLES[f"{name}_fare"] = (
        [source],
        f"SELECT * FROM {source} WHERE total_fare <= {upper_bound('total_fare', source)}",
    )
    bound = upper_bound("travel_duration_minutes", f"{name}_fare")
    TABLES[name] = (
        [f"{name}_fare"],
        f"SELECT * FROM {name}_fare WHERE travel_duration_minutes <= {bound}",
    )


trim("trimmed", "clean")
# The derived fares hold no outliers, so the trimming queries enlarge some first.
TABLES["outliers"] = (
    ["clean"],
    """SELECT * REPLACE (
  CAST(CASE WHEN seats_remaining = 1 THEN total_fare * 20 ELSE total_fare END AS DECIMAL(12,2)) AS total_fare,
  CASE WHEN seats_remaining = 2 THEN travel_duration_minutes * 10 ELSE travel_duration_minutes END AS travel_duration_minutes)
FROM clean""",
)
trim("outliers_trimmed", "outliers")
TABLES["training"] = (["trimmed"], "SELECT * EXCLUDE (fare_basis_code) FROM trimmed")

ENCODED = ["airline_code", "origin_city", "dest_city", "cabin_category", "passenger_type", "seasonality_proxy"]
TABLES["codes"] = (
    ["training"],
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT coalesce({c}, 'None') AS value FROM training)"
        for c in ENCODED
    ),
)
TABLES["encoded"] = (
    ["training", "codes"],
    "SELECT training.* REPLACE ("
    + ", ".join(f"{c}_k.code AS {c}" for c in ENCODED)
    + ") FROM training "
    + " ".join(
        f"JOIN codes {c}_k ON {c}_k.feature = '{c}' AND {c}_k.value = coalesce(training.{c}, 'None')"
        for c in ENCODED
    ),
)


def one_per_key(source: str) -> str:
    columns = [
        "flight_date", "starting_airport", "destination_airport", "is_basic_economy", "is_refundable",
        "is_non_stop", "base_fare", "total_fare", "seats_remaining", "total_travel_distance", "elapsed_days",
        "travel_duration_minutes", "segments_departure_epoch", "segments_departure_raw", "segments_arrival_epoch",
        "segments_arrival_raw", "segments_arrival_airports", "segments_departure_airports", "segments_airline_names",
        "segments_airline_codes", "segments_equipment", "segments_duration_seconds", "segments_distances",
        "segments_cabin_codes", "fare_basis_code",
    ]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns)
    return f"""SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (PARTITION BY leg_id ORDER BY search_date DESC, {order}) AS r FROM ({source})) WHERE r = 1"""


FIRST_LOAD_END = "2025-01-01"
TABLES["loaded"] = (
    ["staging"],
    one_per_key(f"SELECT * FROM staging WHERE search_date < DATE '{FIRST_LOAD_END}'"),
)
TABLES["requoted"] = (
    ["raw"],
    """SELECT * REPLACE (
  CASE WHEN ISREFUNDABLE THEN SEARCHDATE + 30 ELSE SEARCHDATE END AS SEARCHDATE,
  CAST(CASE WHEN ISREFUNDABLE THEN TOTALFARE * CAST(1.1 AS DECIMAL(2,1)) ELSE TOTALFARE END AS DECIMAL(10,2)) AS TOTALFARE)
FROM raw""",
)
TABLES["requoted_rows"] = (["requoted"], derive("(" + parse("requoted") + ")"))
TABLES["batch"] = (
    ["requoted_rows", "loaded"],
    one_per_key(
        f"SELECT * FROM requoted_rows WHERE {VALID} AND search_date >= (SELECT max(search_date) FROM loaded)"
    ),
)
TABLES["upserted"] = (
    ["loaded", "batch"],
    "SELECT * FROM loaded WHERE leg_id NOT IN (SELECT leg_id FROM batch) UNION ALL BY NAME SELECT * FROM batch",
)
# The dimensions over the table after both loads: the same expressions over another source.
for _name, _source, _target in (
    ("routes", "staging", "upserted"), ("segments", "staging", "upserted"), ("name_counts", "segments", "later_segments"),
    ("airlines", "name_counts", "later_name_counts"),
):
    TABLES[f"later_{_name}"] = ([_target], TABLES[_name][1].replace(f"FROM {_source}", f"FROM {_target}"))


def query(final: str, *needed: str) -> str:
    """``final`` with the table expressions it needs, in order of dependency."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for dependency in TABLES[name][0]:
                add(dependency)
            ordered.append(name)

    for name in needed:
        add(name)
    body = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name][1]}\n)" for name in ordered)
    return f"WITH {body}\n{final}" if ordered else final
