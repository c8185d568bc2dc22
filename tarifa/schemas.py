"""Explicit schemas of the tables the library reads."""

from pyspark.sql import types as T

_money = T.DecimalType(10, 2)

BRONZE = T.StructType(
    [
        T.StructField("LEGID", T.StringType()),
        T.StructField("SEARCHDATE", T.DateType()),
        T.StructField("FLIGHTDATE", T.DateType()),
        T.StructField("STARTINGAIRPORT", T.StringType()),
        T.StructField("DESTINATIONAIRPORT", T.StringType()),
        T.StructField("FAREBASISCODE", T.StringType()),
        T.StructField("TRAVELDURATION", T.StringType()),
        T.StructField("ELAPSEDDAYS", T.IntegerType()),
        T.StructField("ISBASICECONOMY", T.BooleanType()),
        T.StructField("ISREFUNDABLE", T.BooleanType()),
        T.StructField("ISNONSTOP", T.BooleanType()),
        T.StructField("BASEFARE", _money),
        T.StructField("TOTALFARE", _money),
        T.StructField("SEATSREMAINING", T.IntegerType()),
        T.StructField("TOTALTRAVELDISTANCE", _money),
        T.StructField("SEGMENTSDEPARTURETIMEEPOCHSECONDS", T.StringType()),
        T.StructField("SEGMENTSDEPARTURETIMERAW", T.StringType()),
        T.StructField("SEGMENTSARRIVALTIMEEPOCHSECONDS", T.StringType()),
        T.StructField("SEGMENTSARRIVALTIMERAW", T.StringType()),
        T.StructField("SEGMENTSARRIVALAIRPORTCODE", T.StringType()),
        T.StructField("SEGMENTSDEPARTUREAIRPORTCODE", T.StringType()),
        T.StructField("SEGMENTSAIRLINENAME", T.StringType()),
        T.StructField("SEGMENTSAIRLINECODE", T.StringType()),
        T.StructField("SEGMENTSEQUIPMENTDESCRIPTION", T.StringType()),
        T.StructField("SEGMENTSDURATIONINSECONDS", T.StringType()),
        T.StructField("SEGMENTSDISTANCE", T.StringType()),
        T.StructField("SEGMENTSCABINCODE", T.StringType()),
        T.StructField("_LOADED_AT", T.TimestampNTZType()),
    ]
)

# The 27 payload columns, without the load time.
BRONZE_PAYLOAD = T.StructType(BRONZE.fields[:-1])

AIRPORTS = T.StructType(
    [
        T.StructField("code", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)

HOLIDAYS = T.StructType(
    [
        T.StructField("holiday_name", T.StringType()),
        T.StructField("holiday_date", T.DateType()),
    ]
)

# One pricing request per row. A missing value means "use the default".
REQUEST = T.StructType(
    [
        T.StructField("searchDate", T.StringType()),
        T.StructField("flightDate", T.StringType()),
        T.StructField("startingAirport", T.StringType()),
        T.StructField("destinationAirport", T.StringType()),
        T.StructField("seatsRemaining", T.IntegerType()),
        T.StructField("totalTravelDistance", T.DoubleType()),
        T.StructField("durationMinutes", T.IntegerType()),
        T.StructField("numSegments", T.IntegerType()),
        T.StructField("carrier", T.StringType()),
        T.StructField("departureHour", T.IntegerType()),
        T.StructField("isBasicEconomy", T.BooleanType()),
        T.StructField("isNonStop", T.BooleanType()),
        T.StructField("isRefundable", T.BooleanType()),
        T.StructField("isHoliday", T.BooleanType()),
        T.StructField("fareBasisCode", T.StringType()),
        T.StructField("cabinCategory", T.IntegerType()),
        T.StructField("passengerType", T.IntegerType()),
        T.StructField("competitor_prices", T.ArrayType(T.DoubleType())),
        T.StructField("total_seats", T.IntegerType()),
    ]
)
