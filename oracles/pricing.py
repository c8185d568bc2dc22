"""Oracles for the pricing queries and the itinerary generator."""

from __future__ import annotations

from oracles.tables import TABLES, iso, query, seg, texts
from tarifa.fixed_values import (
    AIRLINES,
    CABINS,
    EQUIPMENT,
    FACTOR_WEIGHTS,
    FARE_CODES,
    GENERATED_AIRPORTS,
    POPULAR_ROUTES,
    ROUTE_MILES,
)

ORACLES: dict[str, str] = {}


def oracle(name: str, final: str, *needed: str) -> None:
    ORACLES[name] = query(final, *needed)


def dbl(value: float) -> str:
    return f"CAST({value} AS DOUBLE)"


def day(column: str) -> str:
    return (
        f"CASE WHEN regexp_matches({column}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') "
        f"THEN TRY_CAST({column} AS DATE) END"
    )


def offer(step: float, count: int) -> str:
    share = f"(CAST(0.7 AS DECIMAL(2,1)) + CAST({step} AS DECIMAL(2,1)) * (z % {count}))"
    return f"CAST(CAST(BASEFARE * {share} AS DECIMAL(12,2)) AS VARCHAR)"


TABLES["requests"] = (
    ["raw"],
    f"""
SELECT LEGID AS request_id,
  CASE z % 40 WHEN 11 THEN NULL WHEN 12 THEN 'soon' ELSE CAST(SEARCHDATE AS VARCHAR) END AS searchDate,
  CASE z % 40 WHEN 13 THEN '2023-02-30' ELSE CAST(FLIGHTDATE AS VARCHAR) END AS flightDate,
  CASE WHEN z % 40 <> 14 THEN upper(trim(STARTINGAIRPORT)) END AS startingAirport,
  DESTINATIONAIRPORT AS destinationAirport,
  CASE WHEN z = 150 THEN 501 WHEN z % 10 <> 7 THEN z END AS seatsRemaining,
  CAST(TOTALTRAVELDISTANCE AS DOUBLE) AS totalTravelDistance,
  CASE WHEN regexp_matches(TRAVELDURATION, '^PT[0-9]+H[0-9]+M$')
    THEN CAST(60 * CAST(regexp_extract(TRAVELDURATION, '^PT([0-9]+)H', 1) AS INTEGER)
      + CAST(regexp_extract(TRAVELDURATION, 'H([0-9]+)M$', 1) AS INTEGER) AS INTEGER) END AS durationMinutes,
  CAST(CASE WHEN z % 40 = 15 THEN 7 ELSE len(string_split(SEGMENTSAIRLINECODE, '||')) END AS INTEGER) AS numSegments,
  CASE WHEN z % 13 <> 5 THEN string_split(SEGMENTSAIRLINECODE, '||')[1] END AS carrier,
  CAST(CASE WHEN z % 40 = 16 THEN 24 WHEN z % 11 <> 3
    THEN (CAST(string_split(SEGMENTSDEPARTURETIMEEPOCHSECONDS, '||')[1] AS BIGINT) // 3600) % 24 END AS INTEGER) AS departureHour,
  ISBASICECONOMY AS isBasicEconomy, CASE WHEN z % 17 <> 0 THEN ISNONSTOP END AS isNonStop,
  ISREFUNDABLE AS isRefundable, z % 19 = 0 AS isHoliday, FAREBASISCODE AS fareBasisCode,
  CASE WHEN z % 10 = 8 THEN '' WHEN z % 10 <> 9 THEN {offer(0.1, 7)} || ', n/a, ' || {offer(0.2, 4)} || ' USD' END AS offers,
  CASE WHEN z % 9 = 0 THEN 0 WHEN z % 9 <> 1 THEN 60 + 30 * (z % 5) END AS total_seats,
  CASE WHEN z % 7 >= 0 THEN
    ['peak_summer', 'peak_winter', 'shoulder', 'standard', 'off_season', 'carnival'][z % 7 + 1] END AS season,
  CASE WHEN TOTALFARE = 0 THEN {dbl(0)} ELSE CAST(BASEFARE AS DOUBLE) END AS ml_prediction
FROM (SELECT *, SEATSREMAINING AS z FROM raw)""",
)
TABLES["filled"] = (
    ["requests"],
    f"""
SELECT * EXCLUDE (offers) REPLACE (
  coalesce(seatsRemaining, 50) AS seatsRemaining, coalesce(totalTravelDistance, {dbl(1000)}) AS totalTravelDistance,
  coalesce(durationMinutes, 180) AS durationMinutes, coalesce(numSegments, 1) AS numSegments,
  coalesce(carrier, 'DL') AS carrier,
  coalesce(isBasicEconomy, FALSE) AS isBasicEconomy, coalesce(isNonStop, TRUE) AS isNonStop,
  coalesce(isRefundable, FALSE) AS isRefundable, coalesce(isHoliday, FALSE) AS isHoliday,
  CASE WHEN fareBasisCode IS NULL OR fareBasisCode = '' THEN 'Y14' ELSE fareBasisCode END AS fareBasisCode,
  CASE WHEN total_seats IS NULL OR total_seats = 0 THEN 180 ELSE total_seats END AS total_seats),
  CASE WHEN offers IS NULL OR offers = '' THEN [] ELSE list_filter(list_transform(string_split(offers, ','),
    lambda x: TRY_CAST(regexp_extract(trim(x), '^[0-9]+[.][0-9]+') AS DOUBLE)), lambda x: x IS NOT NULL) END AS prices,
  {day("searchDate")} AS sday, {day("flightDate")} AS fday
FROM requests""",
)
TABLES["checked"] = (
    ["filled"],
    """
SELECT *, concat_ws(', ', CASE WHEN sday IS NULL THEN 'searchDate' END, CASE WHEN fday IS NULL THEN 'flightDate' END,
  CASE WHEN startingAirport IS NULL THEN 'startingAirport' END,
  CASE WHEN destinationAirport IS NULL THEN 'destinationAirport' END,
  CASE WHEN seatsRemaining NOT BETWEEN 0 AND 500 THEN 'seatsRemaining' END,
  CASE WHEN totalTravelDistance < 0 THEN 'totalTravelDistance' END,
  CASE WHEN durationMinutes < 0 THEN 'durationMinutes' END,
  CASE WHEN numSegments NOT BETWEEN 1 AND 6 THEN 'numSegments' END,
  CASE WHEN departureHour NOT BETWEEN 0 AND 23 THEN 'departureHour' END) AS broken
FROM filled""",
)


def fare_features(code: str, hour: str, flight: str) -> str:
    """The seven scoring features; ``code`` is a column that holds the upper-case fare code."""
    absent = f"coalesce({code}, '') = ''"
    return f"""
  CASE WHEN {absent} THEN 1 WHEN {code}[1] IN ('F','A','P') THEN 5 WHEN {code}[1] IN ('J','C','D','I','Z') THEN 4
    WHEN {code}[1] = 'W' THEN 3 WHEN {code}[1] IN ('Y','B','M','H') THEN 2 ELSE 1 END AS cabin_category,
  CAST(CASE WHEN {absent} THEN 0 ELSE coalesce(TRY_CAST(regexp_extract({code}, '[0-9]+') AS BIGINT), 0) END AS BIGINT)
    AS fare_rule_number,
  CASE WHEN {absent} THEN 0 WHEN contains({code}, 'CH') THEN 1 WHEN contains({code}, 'IN') THEN 2 ELSE 0 END AS passenger_type,
  CASE WHEN {absent} THEN 1 WHEN contains({code}, 'H') AND NOT contains({code}, 'LH') THEN 2
    WHEN contains({code}, 'L') AND NOT contains({code}, 'LH') THEN 0 ELSE 1 END AS seasonality_proxy,
  CASE WHEN {absent} THEN 0 WHEN regexp_matches({code}, '[0-9]') THEN 1 ELSE 0 END AS has_numeric_rule,
  CASE WHEN {absent} THEN 0 WHEN {hour} IS NOT NULL THEN CAST({hour} < 6 OR {hour} >= 22 AS INTEGER)
    ELSE CAST(contains({code}, 'N') AS INTEGER) END AS is_night_fare_proxy,
  CASE WHEN {absent} THEN 0 WHEN {flight} IS NOT NULL THEN CAST(isodow({flight}) >= 6 AS INTEGER)
    ELSE CAST(contains({code}, 'WE') OR contains({code}, 'WK') AS INTEGER) END AS is_weekend_fare_proxy"""


TABLES["featured"] = (
    ["checked"],
    f"""
SELECT *, CAST(greatest(0, datediff('day', sday, fday)) AS INTEGER) AS days_until_flight,
  seatsRemaining AS seats_remaining, totalTravelDistance AS total_travel_distance,
  CAST(durationMinutes AS DOUBLE) AS travel_duration_minutes, numSegments AS num_segments, carrier AS airline_code,
  startingAirport AS origin_city, destinationAirport AS dest_city, CAST(year(fday) AS INTEGER) AS flight_year,
  CAST(month(fday) AS INTEGER) AS flight_month, CAST(isodow(fday) - 1 AS INTEGER) AS flight_day_of_week,
  CAST(isodow(fday) >= 6 AS INTEGER) AS is_weekend, CAST(isHoliday AS INTEGER) AS is_holiday,
  CAST(isBasicEconomy AS INTEGER) AS is_basic_economy, CAST(isNonStop AS INTEGER) AS is_non_stop,
  CAST(isRefundable AS INTEGER) AS is_refundable,
  {fare_features("code", "departureHour", "fday")}
FROM (SELECT *, upper(fareBasisCode) AS code FROM checked WHERE broken = '')""",
)


def steps(value: str, *cases: tuple[str, float]) -> str:
    whens = " ".join(f"WHEN {value} {test} THEN {dbl(result)}" for test, result in cases)
    return f"CASE {whens} ELSE {dbl(0)} END"


TABLES["factored"] = (
    ["featured"],
    f"""
SELECT *,
  least(greatest(CASE WHEN is_weekend = 1 THEN {dbl(0.1)} ELSE {dbl(0)} END
    + CASE WHEN flight_month IN (12, 1, 6, 7, 8) THEN {dbl(0.15)} ELSE {dbl(0)} END
    + CASE WHEN flight_day_of_week IN (5, 6) THEN {dbl(0.1)} ELSE {dbl(0)} END
    + CASE WHEN days_until_flight BETWEEN 7 AND 21 THEN {dbl(0.1)} ELSE {dbl(0)} END, {dbl(-0.2)}), {dbl(0.5)}) AS demand,
  CASE WHEN len(prices) = 0 OR ml_prediction = 0 THEN {dbl(0)} ELSE {steps(
      "gap", ("> CAST(0.15 AS DOUBLE)", -0.2), ("> CAST(0.1 AS DOUBLE)", -0.15), ("> CAST(0.05 AS DOUBLE)", -0.08),
      ("< CAST(-0.1 AS DOUBLE)", 0.1), ("< CAST(-0.05 AS DOUBLE)", 0.05))} END AS competition,
  {steps("pct", ("<= 2", 0.5), ("<= 5", 0.4), ("<= 10", 0.25), ("<= 15", 0.15), (">= 60", -0.25), (">= 50", -0.15),
         (">= 40", -0.1))} AS inventory,
  {steps("days_until_flight", ("<= 1", 0.5), ("<= 3", 0.3), ("<= 7", 0.2), ("<= 14", 0.1), (">= 60", -0.1))} AS time,
  CASE season WHEN 'peak_summer' THEN {dbl(0.2)} WHEN 'peak_winter' THEN {dbl(0.15)} WHEN 'shoulder' THEN {dbl(0.05)}
    WHEN 'off_season' THEN {dbl(-0.1)} ELSE {dbl(0)} END AS seasonality
FROM (SELECT *, (ml_prediction - mean) / mean AS gap,
    CASE WHEN total_seats > 0 THEN CAST(seats_remaining AS DOUBLE) / total_seats * 100 ELSE {dbl(50)} END AS pct
  FROM (SELECT *, list_reduce(prices, lambda a, b: a + b, {dbl(0)}) / nullif(len(prices), 0) AS mean FROM featured))""",
)
NAMES = ["demand", "competition", "inventory", "time", "seasonality"]
WEIGHT = {name: dbl(FACTOR_WEIGHTS[name]) for name in NAMES}
TABLES["priced"] = (
    ["factored"],
    f"""
SELECT *, (final_price - ml_prediction) / ml_prediction * 100 AS total_adjustment,
  CASE WHEN points >= 4 THEN 'High' WHEN points >= 2 THEN 'Medium' ELSE 'Low' END AS confidence,
  {", ".join(f"printf('%+.1f%%', {n} * 100) AS {n}_label" for n in NAMES)},
  {", ".join(f"ml_prediction * {n} * {WEIGHT[n]} AS {n}_amount" for n in NAMES)}
FROM (SELECT *, CASE WHEN ml_prediction <> 0 THEN
    round_even(least(greatest(ml_prediction * (1 + ({" + ".join(f"{n} * {WEIGHT[n]}" for n in NAMES)})),
      ml_prediction * {dbl(0.7)}), ml_prediction * {dbl(1.5)}), 0) END AS final_price,
  CASE WHEN origin_city || '-' || dest_city IN ({texts(POPULAR_ROUTES)}) THEN 2 ELSE 0 END
    + CASE WHEN days_until_flight BETWEEN 7 AND 60 THEN 2 WHEN days_until_flight BETWEEN 3 AND 90 THEN 1 ELSE 0 END
    + CASE WHEN seats_remaining BETWEEN 10 AND 150 THEN 1 ELSE 0 END
    + CASE WHEN ml_prediction BETWEEN 100 AND 1500 THEN 1 ELSE 0 END AS points FROM factored)""",
)

REQUEST_FIELDS = """searchDate, flightDate, startingAirport, destinationAirport, seatsRemaining, totalTravelDistance,
  durationMinutes, numSegments, carrier, departureHour, isBasicEconomy, isNonStop, isRefundable, isHoliday, fareBasisCode,
  total_seats, season, ml_prediction"""
FEATURES = """days_until_flight, seats_remaining, total_travel_distance, travel_duration_minutes, num_segments,
  airline_code, origin_city, dest_city, flight_year, flight_month, flight_day_of_week, is_weekend, is_holiday,
  is_basic_economy, is_non_stop, is_refundable, cabin_category, fare_rule_number, passenger_type, seasonality_proxy,
  has_numeric_rule, is_night_fare_proxy, is_weekend_fare_proxy"""

oracle(
    "validate_requests",
    "SELECT request_id, replace(broken, ', ', ',') AS violations, broken = '' AS is_valid FROM checked",
    "checked",
)
oracle(
    "request_defaults",
    f"""SELECT request_id, {REQUEST_FIELDS}, CAST(len(prices) AS INTEGER) AS price_count, prices[1] AS price_1,
  prices[2] AS price_2, numSegments = 1 AS nonstop_by_segments FROM filled""",
    "filled",
)
oracle(
    "fare_features_serve",
    f"""SELECT request_id, fareBasisCode, departureHour, flightDate, {fare_features("code", "departureHour", "fday")}
FROM (SELECT *, upper(fareBasisCode) AS code, {day("flightDate")} AS fday FROM requests)""",
    "requests",
)
oracle(
    "model_roundtrip",
    """SELECT request_id, count(*) AS requests, TRUE AS same_prediction, TRUE AS price_in_bounds
FROM checked WHERE broken = '' GROUP BY ALL""",
    "checked",
)
oracle("serve_features", f"SELECT request_id, {FEATURES} FROM featured", "featured")
oracle(
    "encode_categories",
    """SELECT request_id, airline_code, origin_city, dest_city,
  coalesce((SELECT code FROM codes WHERE feature = 'airline_code' AND value = f.airline_code), 0) AS airline_code_encoded,
  coalesce((SELECT code FROM codes WHERE feature = 'origin_city' AND value = f.origin_city), 0) AS origin_city_encoded,
  coalesce((SELECT code FROM codes WHERE feature = 'dest_city' AND value = f.dest_city), 0) AS dest_city_encoded
FROM featured f""",
    "featured",
    "codes",
)
oracle(
    "route_distance_lookup",
    f"""SELECT request_id, startingAirport, destinationAirport, totalTravelDistance,
  CASE startingAirport || '-' || destinationAirport
  {" ".join(f"WHEN '{k}' THEN {dbl(v)}" for k, v in ROUTE_MILES.items())} ELSE totalTravelDistance END AS route_distance
FROM requests""",
    "requests",
)
oracle(
    "demand_factor",
    "SELECT request_id, is_weekend, flight_month, flight_day_of_week, days_until_flight, demand FROM factored",
    "factored",
)
oracle("inventory_factor", "SELECT request_id, seats_remaining, total_seats, inventory FROM factored", "factored")
oracle("time_factor", "SELECT request_id, days_until_flight, time FROM factored", "factored")
oracle("competition_factor", "SELECT request_id, ml_prediction, competition FROM factored", "factored")
oracle("seasonality_factor", "SELECT request_id, season, seasonality FROM factored", "factored")
oracle("dynamic_price", "SELECT request_id, ml_prediction, final_price, total_adjustment FROM priced", "priced")
LABELS = ", ".join(f"{n}_label" for n in NAMES)
AMOUNTS = ", ".join(f"{n}_amount" for n in NAMES)
oracle("factor_labels", f"SELECT request_id, {LABELS} FROM priced", "priced")
oracle("price_breakdown", f"SELECT request_id, ml_prediction, {AMOUNTS} FROM priced", "priced")
oracle(
    "confidence_label",
    """SELECT request_id, origin_city, dest_city, days_until_flight, seats_remaining, ml_prediction, confidence
FROM priced""",
    "priced",
)
oracle(
    "price_requests",
    f"""SELECT request_id, ml_prediction, final_price, total_adjustment, confidence, {LABELS}, {AMOUNTS} FROM priced""",
    "priced",
)


def cents(column: str) -> str:
    return f"CAST(round(CAST({column} AS DECIMAL(18,6)), 2) AS DOUBLE)"


ROUTE = "startingAirport || ' → ' || destinationAirport AS route"
oracle(
    "price_response",
    f"""SELECT request_id, final_price IS NOT NULL AS success, {cents("ml_prediction")} AS ml_base_price,
  {cents("final_price")} AS dynamic_price, {cents("total_adjustment")} AS total_adjustment, confidence, {ROUTE},
  flightDate AS flight_date, {", ".join(f"{n}_label AS factors_{n}" for n in NAMES)},
  {cents("ml_prediction")} AS breakdown_base, {", ".join(f"{cents(n + '_amount')} AS breakdown_{n}_adj" for n in NAMES)},
  {", ".join(f"{c} AS features_summary_{c}" for c in
             ["days_until_flight", "cabin_category", "seasonality_proxy", "is_weekend", "is_holiday"])}
FROM priced""",
    "priced",
)
BATCH = f"""SELECT request_id, final_price IS NOT NULL AS success,
  CASE WHEN final_price IS NULL THEN 'Prediction error' END AS error, {ROUTE}, {cents("final_price")} AS dynamic_price,
  CASE WHEN final_price IS NOT NULL THEN confidence END AS confidence FROM priced
UNION ALL
SELECT request_id, FALSE, 'Invalid input: ' || broken, {ROUTE}, NULL, NULL FROM checked WHERE broken <> ''"""
oracle("price_batch", BATCH, "priced")
oracle("stream_price_requests", BATCH, "priced")
oracle(
    "batch_summary",
    f"SELECT count(*) AS total, count(*) FILTER (success) AS successful FROM ({BATCH})",
    "priced",
)
oracle(
    "seat_status",
    """SELECT request_id, seatsRemaining, CASE WHEN seatsRemaining <= 2 THEN 'Very Scarce'
  WHEN seatsRemaining <= 5 THEN 'Scarce' WHEN seatsRemaining <= 10 THEN 'Limited' ELSE 'Available' END AS seat_status
FROM priced""",
    "priced",
)
oracle(
    "demand_level",
    """SELECT request_id, demand_label, CASE WHEN round(demand * 100, 1) > 10 THEN 'High'
  WHEN round(demand * 100, 1) < -5 THEN 'Low' ELSE 'Medium' END AS demand_level FROM priced""",
    "priced",
)
oracle(
    "price_range",
    f"""SELECT request_id, final_price, final_price * {dbl(0.85)} AS price_low, final_price * {dbl(1.15)} AS price_high
FROM priced""",
    "priced",
)

# Generated itineraries

DRAWS = [
    "origin", "dest", "stop", "airline", "days", "nonstop", "miles", "seconds", "seats", "fare", "markup", "cabin",
    "plane", "plane_2", "fare_code", "hour", "quarter", "layover", "basic", "refundable",
]
AIR = texts(GENERATED_AIRPORTS)


def generated(seed: int) -> str:
    digest = " || ".join(f"sha256(concat_ws('|', '{seed}', '{i}', CAST(o_orderkey AS VARCHAR)))" for i in range(2))
    draws = ", ".join(
        f"CAST('0x' || substr(digest, {1 + 6 * i}, 6) AS BIGINT) AS g_{name}" for i, name in enumerate(DRAWS)
    )
    return f"""
SELECT upper(substr(digest, 113, 16)) AS LEGID, sd AS SEARCHDATE, fd AS FLIGHTDATE, o AS STARTINGAIRPORT,
  d AS DESTINATIONAIRPORT, [{texts(FARE_CODES)}][g_fare_code % 8 + 1] AS FAREBASISCODE,
  'PT' || u // 3600 || 'H' || u // 60 % 60 || 'M' AS TRAVELDURATION, CAST(0 AS INTEGER) AS ELAPSEDDAYS,
  g_basic % 1000 < 250 AS ISBASICECONOMY, g_refundable % 1000 < 150 AS ISREFUNDABLE, ns AS ISNONSTOP,
  CAST(CAST(cents AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS BASEFARE,
  CAST(CAST((cents * (11000 + g_markup % 1001) + 5000) // 10000 AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2))
    AS DECIMAL(10,2)) AS TOTALFARE,
  CAST(g_seats % 150 + 1 AS INTEGER) AS SEATSREMAINING, CAST(v AS DECIMAL(10,2)) AS TOTALTRAVELDISTANCE,
  {seg("t", "t", "t2")} AS SEGMENTSDEPARTURETIMEEPOCHSECONDS,
  {seg(iso("t"), iso("t"), iso("t2"))} AS SEGMENTSDEPARTURETIMERAW,
  {seg("t + u", "t + u // 2", "t2 + u - u // 2")} AS SEGMENTSARRIVALTIMEEPOCHSECONDS,
  {seg(iso("t + u"), iso("t + u // 2"), iso("t2 + u - u // 2"))} AS SEGMENTSARRIVALTIMERAW,
  {seg("d", "x", "d")} AS SEGMENTSARRIVALAIRPORTCODE, {seg("o", "o", "x")} AS SEGMENTSDEPARTUREAIRPORTCODE,
  {seg("nm", "nm", "nm")} AS SEGMENTSAIRLINENAME, {seg("c", "c", "c")} AS SEGMENTSAIRLINECODE,
  {seg("e1", "e1", "e2")} AS SEGMENTSEQUIPMENTDESCRIPTION,
  {seg("u", "u // 2", "u - u // 2")} AS SEGMENTSDURATIONINSECONDS,
  {seg("v", "v // 2", "v - v // 2")} AS SEGMENTSDISTANCE, {seg("cab", "cab", "cab")} AS SEGMENTSCABINCODE
FROM (SELECT *, t + u // 2 + 2700 + g_layover % 4501 AS t2 FROM (
  SELECT *, (fd - DATE '1970-01-01') * 86400 + (6 + g_hour % 17) * 3600 + g_quarter % 4 * 900 AS t,
    [{AIR}][oi + 1] AS o, [{AIR}][di + 1] AS d,
    list_filter([{AIR}], lambda a: a <> [{AIR}][oi + 1] AND a <> [{AIR}][di + 1])[g_stop % 14 + 1] AS x
  FROM (SELECT *, (oi + 1 + g_dest % 15) % 16 AS di, sd + CAST(g_days % 90 + 1 AS INTEGER) AS fd,
      5000 + g_fare % 75001 AS cents, 3600 + g_seconds % 20401 AS u, 300 + g_miles % 2701 AS v,
      g_nonstop % 1000 < 600 AS ns, [{texts(c for c, _ in AIRLINES)}][g_airline % 8 + 1] AS c,
      [{texts(n for _, n in AIRLINES)}][g_airline % 8 + 1] AS nm, [{texts(CABINS)}][g_cabin % 4 + 1] AS cab,
      [{texts(EQUIPMENT)}][g_plane % 6 + 1] AS e1, [{texts(EQUIPMENT)}][g_plane_2 % 6 + 1] AS e2
    FROM (SELECT *, g_origin % 16 AS oi FROM (SELECT digest, CAST(o_orderdate AS DATE) AS sd, {draws}
      FROM (SELECT *, {digest} AS digest FROM orders))))))"""


ORACLES["generate_itineraries"] = generated(42)
ORACLES["bronze_append"] = f"{generated(1)}\nUNION ALL\n{generated(2)}"
