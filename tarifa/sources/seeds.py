"""Reference data: airports and holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarifa import schemas
from tarifa.fixed_values import AIRPORTS, HOLIDAYS


def airports(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """22 airports, or those of a CSV file with the same columns."""
    return _seed(spark, AIRPORTS, schemas.AIRPORTS, csv_path)


def holidays(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """27 public holidays, or those of a CSV file with the same columns."""
    return _seed(spark, HOLIDAYS, schemas.HOLIDAYS, csv_path)


def _seed(spark: SparkSession, rows: list[tuple], schema: StructType, csv_path: str | None) -> DataFrame:
    if csv_path:
        return spark.read.schema(schema).csv(csv_path, header=True, escape='"')
    literals = F.array(
        [
            F.struct([F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, schema)])
            for row in rows
        ]
    )
    return spark.range(1).select(F.inline(literals))
