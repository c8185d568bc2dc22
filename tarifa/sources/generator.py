"""Synthetic itineraries, drawn per key so that a retried task draws the same values again."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa import schemas
from tarifa.fixed_values import (
    AIRLINES,
    CABINS,
    EQUIPMENT,
    FARE_CODES,
    GENERATED_AIRPORTS,
)
from tarifa.functions.text import iso_text, list_join, pick

# Order of the draws; each is six hexadecimal digits of a digest.
DRAWS = [
    "origin", "dest", "stop", "airline", "days", "nonstop", "miles", "seconds", "seats", "fare",
    "markup", "cabin", "plane", "plane_2", "fare_code", "hour", "quarter", "layover", "basic",
    "refundable",
]


def generate_batch(
    spark: SparkSession, records: int = 1000, search_date: str | None = None, seed: int | None = None
) -> DataFrame:
    """``records`` itineraries searched on one date, today by default.

    Without a seed every call draws new itineraries with new ids.
    """
    seed = random.randrange(2**48) if seed is None else seed
    day = F.current_date() if search_date is None else F.lit(search_date).cast("date")
    keys = spark.range(records).select(F.col("id").cast("string").alias("key"), day.alias("day"))
    return generate_itineraries(keys, "key", "day", seed)


def generate_itineraries(keys: DataFrame, key: str, search_date: str, seed: int = 42) -> DataFrame:
    """One itinerary per row of ``keys``, with values drawn from a digest of the key and the seed.

    16 airports, 8 airlines, origin, destination and stop all different, about 60% nonstop, else two
    segments with a layover of 45 to 120 minutes.
    """
    digests = [
        F.sha2(F.concat_ws("|", F.lit(str(seed)), F.lit(str(i)), F.col(key).cast("string")), 256)
        for i in range(2)
    ]
    base = keys.select(
        F.col(search_date).cast("date").alias("search"),
        F.concat(*digests).alias("digest"),
    )
    # The digests are 128 digits together, of which the draws use 120.
    drawn = base.select(
        "search",
        F.upper(F.substring("digest", 113, 16)).alias("leg"),
        *[
            F.conv(F.substring("digest", 1 + 6 * i, 6), 16, 10).cast("bigint").alias(name)
            for i, name in enumerate(DRAWS)
        ],
    )

    def below(name: str, count: int) -> Column:
        return F.col(name) % count

    def between(name: str, low: int, high: int) -> Column:
        return F.col(name) % (high - low + 1) + low

    airports = len(GENERATED_AIRPORTS)
    # Index shifts keep the three airports apart: dest skips origin, stop skips both.
    placed = drawn.withColumn("o", below("origin", airports)).withColumn(
        "d", (F.col("o") + 1 + below("dest", airports - 1)) % airports
    )
    low, high = F.least("o", "d"), F.greatest("o", "d")
    stop = below("stop", airports - 2)
    stop = stop + F.when(stop >= low, 1).otherwise(0)
    stop = stop + F.when(stop >= high, 1).otherwise(0)
    valued = placed.withColumns(
        {
            "s": stop,
            "is_nonstop": below("nonstop", 1000) < 600,
            "flight": F.date_add("search", between("days", 1, 90).cast("int")),
            "duration": between("seconds", 3600, 24000),
            "distance": between("miles", 300, 3000),
            "fare_cents": between("fare", 5000, 80000),
        }
    )
    valued = valued.withColumns(
        {
            "leaves": F.unix_date("flight").cast("bigint") * 86400
            + between("hour", 6, 22) * 3600
            + below("quarter", 4) * 900,
            "duration_1": F.expr("duration div 2"),
            "distance_1": F.expr("distance div 2"),
            # 10% to 20% on top, in hundredths of a percent, rounded half up to cents.
            "total_cents": F.expr("(fare_cents * (11000 + markup % 1001) + 5000) div 10000"),
        }
    )
    valued = valued.withColumn(
        "leaves_2", F.col("leaves") + F.col("duration_1") + between("layover", 2700, 7200)
    )

    def text(value: Column) -> Column:
        return value.cast("string")

    def by_segment(single: Column, *parts: Column) -> Column:
        return F.when(F.col("is_nonstop"), single).otherwise(list_join(*parts))

    c = F.col
    arrives, arrives_1 = c("leaves") + c("duration"), c("leaves") + c("duration_1")
    arrives_2 = c("leaves_2") + c("duration") - c("duration_1")
    origin, dest, between_stop = (pick(GENERATED_AIRPORTS, c(i)) for i in "ods")
    code = pick([a for a, _ in AIRLINES], below("airline", len(AIRLINES)))
    name = pick([n for _, n in AIRLINES], below("airline", len(AIRLINES)))
    cabin = pick(CABINS, below("cabin", len(CABINS)))
    plane = pick(EQUIPMENT, below("plane", len(EQUIPMENT)))
    plane_2 = pick(EQUIPMENT, below("plane_2", len(EQUIPMENT)))
    minutes = F.expr("duration div 60")
    columns = {
        "LEGID": c("leg"),
        "SEARCHDATE": c("search"),
        "FLIGHTDATE": c("flight"),
        "STARTINGAIRPORT": origin,
        "DESTINATIONAIRPORT": dest,
        "FAREBASISCODE": pick(FARE_CODES, below("fare_code", len(FARE_CODES))),
        "TRAVELDURATION": F.concat(
            F.lit("PT"), text(F.expr("duration div 3600")), F.lit("H"), text(minutes % 60), F.lit("M")
        ),
        "ELAPSEDDAYS": F.lit(0),
        "ISBASICECONOMY": below("basic", 1000) < 250,
        "ISREFUNDABLE": below("refundable", 1000) < 150,
        "ISNONSTOP": c("is_nonstop"),
        "BASEFARE": F.expr("cast(fare_cents as decimal(12,0)) * 0.01"),
        "TOTALFARE": F.expr("cast(total_cents as decimal(12,0)) * 0.01"),
        "SEATSREMAINING": between("seats", 1, 150),
        "TOTALTRAVELDISTANCE": c("distance"),
        "SEGMENTSDEPARTURETIMEEPOCHSECONDS": by_segment(
            text(c("leaves")), text(c("leaves")), text(c("leaves_2"))
        ),
        "SEGMENTSDEPARTURETIMERAW": by_segment(
            iso_text(c("leaves")), iso_text(c("leaves")), iso_text(c("leaves_2"))
        ),
        "SEGMENTSARRIVALTIMEEPOCHSECONDS": by_segment(text(arrives), text(arrives_1), text(arrives_2)),
        "SEGMENTSARRIVALTIMERAW": by_segment(
            iso_text(arrives), iso_text(arrives_1), iso_text(arrives_2)
        ),
        "SEGMENTSARRIVALAIRPORTCODE": by_segment(dest, between_stop, dest),
        "SEGMENTSDEPARTUREAIRPORTCODE": by_segment(origin, origin, between_stop),
        "SEGMENTSAIRLINENAME": by_segment(name, name, name),
        "SEGMENTSAIRLINECODE": by_segment(code, code, code),
        "SEGMENTSEQUIPMENTDESCRIPTION": by_segment(plane, plane, plane_2),
        "SEGMENTSDURATIONINSECONDS": by_segment(
            text(c("duration")), text(c("duration_1")), text(c("duration") - c("duration_1"))
        ),
        "SEGMENTSDISTANCE": by_segment(
            text(c("distance")), text(c("distance_1")), text(c("distance") - c("distance_1"))
        ),
        "SEGMENTSCABINCODE": by_segment(cabin, cabin, cabin),
    }
    return valued.select(
        [columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.BRONZE_PAYLOAD]
    )

