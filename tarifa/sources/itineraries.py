"""Raw itineraries derived from line items and orders, one per line item (see FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa import schemas
from tarifa.fixed_values import AIRLINES, AIRPORTS, EQUIPMENT, FARE_CODES
from tarifa.functions.text import iso_text, list_join, pick
from tarifa.sources.tables import read_table

AIRPORT_CODES = [row[0] for row in AIRPORTS]
DERIVED_AIRPORTS = AIRPORT_CODES + ["XXX", "YYY"]
DERIVED_FARE_CODES = FARE_CODES + ["F0CH", "J14INH", "wl", ""]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_returnflag", "l_linestatus",
]
SHIFT_DAYS = 9862
LOADED_AT = "2026-01-01 00:00:00"


# Line items that one task dealt by id derives and ranks in memory, and the number from which on tasks are counted by it: Spark would
# size them by the few bytes that a dealt row has.
DEALT_ROWS = 500_000
MANY_ROWS = 8 * DEALT_ROWS


def raw_flights(spark: SparkSession, folder: str, dealt: bool = False, least: int = 1) -> DataFrame:
    """The raw itinerary table over the driver tables of ``folder``; ``dealt`` by id, if there are many to ``least`` tasks or more."""
    lineitem = read_table(spark, folder, "lineitem").select(LINE_COLUMNS)
    rows = lineitem.count() if dealt else 0
    tasks = (max(least, -(-rows // DEALT_ROWS)),) if rows > MANY_ROWS else ()
    return derive_itineraries(lineitem, read_table(spark, folder, "orders"), dealt=tasks if dealt else None)


def derive_itineraries(
    lineitem: DataFrame, orders: DataFrame, loaded_at: str = LOADED_AT, dealt: tuple[int, ...] | None = None
) -> DataFrame:
    """One itinerary per line item. ``lineitem`` may be a stream; only the order date is joined in.

    With ``dealt`` the rows go by their id to that many tasks, or to as many as Spark chooses for ``()``, while they are a few numbers.
    Steps by id that follow, such as one row per id, then move no row again, and a staged row is about seven times as large. All
    copies of an id meet in one task.
    """
    dated = lineitem.join(
        orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    part, supp, line, quantity = (
        F.col(c) for c in ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    )
    leg = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), line.cast("string"))
    if dealt is not None:
        dated, leg = dated.withColumn("leg", leg).repartition(*dealt, "leg"), F.col("leg")
    based = dated.withColumns(
        {
            "nonstop": line % 2 == 1,
            "search": F.date_add(F.col("o_orderdate").cast("date"), SHIFT_DAYS),
            "fare_cents": 5000 + (part * 37 + supp * 11 + line * 101) % 75000,
            "seconds": 3600 + part % 20400,
            "miles": 300 + part % 2700,
            "minutes": 60 + part % 340,
        }
    )
    based = based.withColumns(
        {
            "flight": F.date_add("search", ((part * 7 + supp) % 380 - 5).cast("int")),
            "seconds_1": F.expr("seconds div 2"),
            "miles_1": F.expr("miles div 2"),
        }
    )
    based = based.withColumn(
        "leaves", F.unix_date("flight").cast("bigint") * 86400 + 21600 + (part % 17) * 3600
    )
    based = based.withColumn("leaves_2", F.col("leaves") + F.col("seconds_1") + 2700 + supp % 4500)

    def by_segment(nonstop: Column, *segments: Column) -> Column:
        return F.when(F.col("nonstop"), nonstop).otherwise(list_join(*segments))

    def text(column: Column | str) -> Column:
        return (F.col(column) if isinstance(column, str) else column).cast("string")

    # Texts are picked in the last projection: those before it then copy numbers only.
    origin = pick(DERIVED_AIRPORTS, supp % 24)
    dest = pick(DERIVED_AIRPORTS, (part + 7) % 24)
    stop = pick(DERIVED_AIRPORTS, (part + 13) % 22)
    carrier = pick([code for code, _ in AIRLINES], supp % 8)
    carrier_name = pick([name for _, name in AIRLINES], supp % 8)
    plane = pick(EQUIPMENT, part % 6)
    seconds_2 = F.col("seconds") - F.col("seconds_1")
    arrives = F.col("leaves") + F.col("seconds")
    arrives_1 = F.col("leaves") + F.col("seconds_1")
    arrives_2 = F.col("leaves_2") + seconds_2
    columns = {
        "LEGID": leg,
        "SEARCHDATE": F.col("search"),
        "FLIGHTDATE": F.col("flight"),
        "STARTINGAIRPORT": F.when(
            line == 3, F.concat(F.lit(" "), F.lower(origin), F.lit(" "))
        ).otherwise(origin),
        "DESTINATIONAIRPORT": dest,
        "FAREBASISCODE": F.when(quantity != 50, pick(DERIVED_FARE_CODES, part % 12)),
        "TRAVELDURATION": F.when(line == 7, F.lit("P1DT2H5M"))
        .when(line == 6, F.lit("PT45M"))
        .otherwise(
            F.concat(
                F.lit("PT"),
                text(F.expr("minutes div 60")),
                F.lit("H"),
                text(F.col("minutes") % 60),
                F.lit("M"),
            )
        ),
        "ELAPSEDDAYS": F.lit(0),
        "ISBASICECONOMY": F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "A"),
        "ISREFUNDABLE": F.col("l_linestatus") == "O",
        "ISNONSTOP": F.col("nonstop"),
        "BASEFARE": _money("fare_cents"),
        "TOTALFARE": F.when(quantity == 1, F.lit(0).cast("decimal(10,2)")).otherwise(
            _money("fare_cents + fare_cents div 8")
        ),
        "SEATSREMAINING": (part + line * 13) % 152 - 1,
        "TOTALTRAVELDISTANCE": F.when(quantity == 3, F.lit(0))
        .when(quantity != 2, F.col("miles")),
        "SEGMENTSDEPARTURETIMEEPOCHSECONDS": by_segment(
            text("leaves"), text("leaves"), text("leaves_2")
        ),
        "SEGMENTSDEPARTURETIMERAW": by_segment(
            iso_text(F.col("leaves")), iso_text(F.col("leaves")), iso_text(F.col("leaves_2"))
        ),
        "SEGMENTSARRIVALTIMEEPOCHSECONDS": by_segment(text(arrives), text(arrives_1), text(arrives_2)),
        "SEGMENTSARRIVALTIMERAW": by_segment(iso_text(arrives), iso_text(arrives_1), iso_text(arrives_2)),
        "SEGMENTSARRIVALAIRPORTCODE": by_segment(dest, stop, dest),
        "SEGMENTSDEPARTUREAIRPORTCODE": by_segment(origin, origin, stop),
        "SEGMENTSAIRLINENAME": F.when(
            F.col("nonstop") | (line == 4), carrier_name
        ).otherwise(list_join(carrier_name, F.concat(carrier_name, F.lit(" Air")))),
        "SEGMENTSAIRLINECODE": by_segment(carrier, carrier, carrier),
        "SEGMENTSEQUIPMENTDESCRIPTION": by_segment(
            plane, plane, pick(EQUIPMENT, supp % 6)
        ),
        "SEGMENTSDURATIONINSECONDS": by_segment(text("seconds"), text("seconds_1"), text(seconds_2)),
        "SEGMENTSDISTANCE": by_segment(
            text("miles"), text("miles_1"), text(F.col("miles") - F.col("miles_1"))
        ),
        "SEGMENTSCABINCODE": by_segment(F.lit("coach"), F.lit("business"), F.lit("coach")),
        "_LOADED_AT": F.lit(loaded_at),
    }
    return based.select(
        [columns[field.name].cast(field.dataType).alias(field.name) for field in schemas.BRONZE]
    )


def _money(cents_expression: str) -> Column:
    """Whole cents as an exact decimal amount."""
    return F.expr(f"cast(cast({cents_expression} as decimal(12,0)) * 0.01 as decimal(10,2))")

