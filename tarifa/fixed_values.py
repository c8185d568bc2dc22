"""Fixed values. Results depend on these exact texts and numbers, so they are stated once, here."""

# Separator of the multi-valued SEGMENTS* text columns: literal form, and as a regular expression.
SEPARATOR = "||"
SEPARATOR_REGEX = "[|][|]"

# Airport seed: code, name, city, state.
AIRPORTS = [
    ("ATL", "Atlanta International Airport", "Atlanta", "GA"),
    ("DFW", "Dallas/Fort Worth International Airport", "Dallas", "TX"),
    ("JFK", "John F. Kennedy International Airport", "New York", "NY"),
    ("LAX", "Los Angeles International Airport", "Los Angeles", "CA"),
    ("ORD", "O'Hare International Airport", "Chicago", "IL"),
    ("SFO", "San Francisco International Airport", "San Francisco", "CA"),
    ("DEN", "Denver International Airport", "Denver", "CO"),
    ("CLT", "Charlotte Douglas International Airport", "Charlotte", "NC"),
    ("MIA", "Miami International Airport", "Miami", "FL"),
    ("EWR", "Newark Liberty International Airport", "Newark", "NJ"),
    ("DTW", "Detroit Metropolitan Wayne County Airport", "Detroit", "MI"),
    ("BOS", "Boston Logan International Airport", "Boston", "MA"),
    ("PHL", "Philadelphia International Airport", "Philadelphia", "PA"),
    ("LGA", "LaGuardia Airport", "New York", "NY"),
    ("IAD", "Washington Dulles International Airport", "Washington", "DC"),
    ("OAK", "Oakland International Airport", "Oakland", "CA"),
    ("SEA", "Seattle-Tacoma International Airport", "Seattle", "WA"),
    ("PHX", "Phoenix Sky Harbor International Airport", "Phoenix", "AZ"),
    ("IAH", "George Bush Intercontinental Airport", "Houston", "TX"),
    ("LAS", "Harry Reid International Airport", "Las Vegas", "NV"),
    ("MCO", "Orlando International Airport", "Orlando", "FL"),
    ("MSP", "Minneapolis-Saint Paul International Airport", "Minneapolis", "MN"),
]

# Holiday seed: name, date. The years 2023 and 2024 are absent on purpose.
HOLIDAYS = [
    ("New Year's Day", "2022-01-01"),
    ("Martin Luther King Jr. Day", "2022-01-17"),
    ("Presidents' Day", "2022-02-21"),
    ("Memorial Day", "2022-05-30"),
    ("Independence Day", "2022-07-04"),
    ("Labor Day", "2022-09-05"),
    ("Veterans Day", "2022-11-11"),
    ("Thanksgiving Day", "2022-11-24"),
    ("Christmas Day", "2022-12-25"),
    ("New Year's Day", "2025-01-01"),
    ("Martin Luther King Jr. Day", "2025-01-20"),
    ("Presidents' Day", "2025-02-17"),
    ("Memorial Day", "2025-05-26"),
    ("Independence Day", "2025-07-04"),
    ("Labor Day", "2025-09-01"),
    ("Veterans Day", "2025-11-11"),
    ("Thanksgiving Day", "2025-11-27"),
    ("Christmas Day", "2025-12-25"),
    ("New Year's Day", "2026-01-01"),
    ("Martin Luther King Jr. Day", "2026-01-19"),
    ("Presidents' Day", "2026-02-16"),
    ("Memorial Day", "2026-05-25"),
    ("Independence Day", "2026-07-04"),
    ("Labor Day", "2026-09-07"),
    ("Veterans Day", "2026-11-11"),
    ("Thanksgiving Day", "2026-11-26"),
    ("Christmas Day", "2026-12-25"),
]

# Calendar range, inclusive: 1,826 days.
CALENDAR_START = "2022-01-01"
CALENDAR_END = "2026-12-31"

# Value lists of generated itineraries.
GENERATED_AIRPORTS = [
    "JFK", "LAX", "ORD", "DFW", "DEN", "SFO", "SEA", "ATL",
    "MIA", "BOS", "PHX", "IAH", "LAS", "MCO", "EWR", "MSP",
]
AIRLINES = [
    ("AA", "American"),
    ("DL", "Delta"),
    ("UA", "United"),
    ("WN", "Southwest"),
    ("B6", "JetBlue"),
    ("AS", "Alaska"),
    ("NK", "Spirit"),
    ("F9", "Frontier"),
]
CABINS = ["coach", "premium coach", "business", "first"]
EQUIPMENT = [
    "Boeing 737-800",
    "Airbus A320",
    "Boeing 777-200",
    "Airbus A321",
    "Boeing 787-9",
    "Embraer E175",
]
FARE_CODES = ["YAA7NR", "KAA7NR", "LAA7NR", "VAA7NR", "HAA7NR", "BAA7NR", "MAA7NR", "QAA7NR"]
SEGMENT_TIME_OFFSET = ".000-05:00"

# Booking letter -> cabin label, for training features.
CABIN_LABELS = {
    "First": ["F", "A"],
    "Business": ["J", "C", "D", "I", "Z", "P"],
    "Premium Economy": ["W", "S", "T", "R"],
    "Full Economy": ["Y", "B", "M", "H"],
    "Discount Economy": ["K", "L", "Q", "V", "U", "X", "N", "O", "G", "E"],
}
OTHER_CABIN_LABEL = "Unknown"
MISSING_FARE_CODE = "UNKNOWN"
CHILD_PATTERN = "(CH|CNN)"
INFANT_PATTERN = "(IN|INF)"

# Booking letter -> cabin rank, for scoring features.
CABIN_RANKS = {
    "F": 5, "A": 5, "P": 5,
    "J": 4, "C": 4, "D": 4, "I": 4, "Z": 4,
    "W": 3,
    "Y": 2, "B": 2, "M": 2, "H": 2,
}
OTHER_CABIN_RANK = 1

# The 23 model features, in scoring order.
FEATURES = [
    "days_until_flight", "seats_remaining", "total_travel_distance", "travel_duration_minutes",
    "num_segments", "airline_code", "origin_city", "dest_city", "flight_year", "flight_month",
    "flight_day_of_week", "is_weekend", "is_holiday", "is_basic_economy", "is_non_stop",
    "is_refundable", "cabin_category", "fare_rule_number", "passenger_type", "seasonality_proxy",
    "has_numeric_rule", "is_night_fare_proxy", "is_weekend_fare_proxy",
]
# Columns that get label codes before training.
ENCODED_FEATURES = [
    "airline_code", "origin_city", "dest_city",
    "cabin_category", "passenger_type", "seasonality_proxy",
]
# Text that stands for a missing category.
MISSING_CATEGORY = "None"

# Price factor weights, and the season factors.
FACTOR_WEIGHTS = {
    "demand": 0.30,
    "competition": 0.25,
    "inventory": 0.20,
    "time": 0.15,
    "seasonality": 0.10,
}
SEASON_FACTORS = {
    "peak_summer": 0.20,
    "peak_winter": 0.15,
    "shoulder": 0.05,
    "standard": 0.0,
    "off_season": -0.10,
}
DEFAULT_SEASON = "standard"
PRICE_FLOOR = 0.7
PRICE_CEILING = 1.5
POPULAR_ROUTES = ["JFK-LAX", "LAX-JFK", "ORD-LAX", "JFK-SFO", "ATL-LAX"]

# Known route distances in miles, origin-destination.
ROUTE_MILES = {
    "JFK-LAX": 2475, "LAX-JFK": 2475,
    "JFK-MIA": 1089, "MIA-JFK": 1089,
    "JFK-ORD": 740, "ORD-JFK": 740,
    "JFK-SFO": 2586, "SFO-JFK": 2586,
    "LAX-SFO": 337, "SFO-LAX": 337,
    "ATL-LAX": 1946, "LAX-ATL": 1946,
    "ORD-LAX": 1745, "LAX-ORD": 1745,
    "DFW-JFK": 1391, "JFK-DFW": 1391,
}

# Defaults of a pricing request.
REQUEST_DEFAULTS = {
    "seatsRemaining": 50,
    "totalTravelDistance": 1000.0,
    "durationMinutes": 180,
    "numSegments": 1,
    "carrier": "DL",
    "departureHour": 10,
    "isBasicEconomy": False,
    "isNonStop": True,
    "isRefundable": False,
    "isHoliday": False,
    "fareBasisCode": "Y14",
    "total_seats": 180,
}

# Blend weights of the three regressors.
BLEND_WEIGHTS = [0.6, 0.25, 0.15]
# Width of the outlier fence in interquartile ranges.
FENCE_FACTOR = 2.5
# Rows flying in fewer minutes than this are not plausible.
MINIMUM_DURATION = 20
