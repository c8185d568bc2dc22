"""Label codes for text categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarifa.fixed_values import ENCODED_FEATURES, FEATURES, MISSING_CATEGORY
from tarifa.session import save


def category_text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(MISSING_CATEGORY))


def small_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    """Boolean columns as one-byte 0 and 1; null stays null."""
    return df.withColumns({c: F.col(c).cast("tinyint") for c in columns})


def fit_codes(df: DataFrame, columns: list[str] = ENCODED_FEATURES) -> DataFrame:
    """The code table: feature, value and code, where codes number the sorted distinct values from 0.

    One pass counts the values of all columns. The distinct values are stored in ranges of feature and
    value, and numbered inside each range after the number of values in the ranges before, so that a
    long value list is sorted in as many tasks as there are ranges, whatever the values have in common.
    """
    pairs = F.array(
        [F.struct(F.lit(c).alias("feature"), category_text(c).alias("value")) for c in columns]
    )
    values = df.select(F.inline(pairs)).distinct().repartitionByRange("feature", "value")
    values = save(values.withColumn("range", F.spark_partition_id()), "categories")
    sizes = values.groupBy("feature", "range").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("feature").orderBy("range")
    starts = sizes.withColumn("start", F.sum("size").over(earlier) - F.col("size")).drop("size")
    within = Window.partitionBy("feature", "range").orderBy("value")
    return values.join(starts, ["feature", "range"]).select(
        "feature",
        "value",
        (F.col("start") + F.row_number().over(within) - 1).cast("int").alias("code"),
    )


def _feature_codes(codes: DataFrame, feature: str) -> DataFrame:
    return codes.where(F.col("feature") == feature).select(
        F.col("value").alias("category_value"), F.col("code").alias("category_code")
    )


def encode(
    df: DataFrame,
    codes: DataFrame,
    columns: dict[str, str] | list[str] = ENCODED_FEATURES,
    suffix: str = "",
) -> DataFrame:
    """Write the code of each column to the column of that name plus ``suffix``.

    ``columns`` names the columns, or maps features of the code table to differently named columns. A
    value without a code becomes 0. ``codes`` should be a stored table, so that its size decides
    between broadcast and shuffle.
    """
    sources = columns if isinstance(columns, dict) else {name: name for name in columns}
    for feature, name in sources.items():
        known = category_text(name) == F.col("category_value")
        df = (
            df.join(_feature_codes(codes, feature), known, "left")
            .withColumn(name + suffix, F.coalesce("category_code", F.lit(0)))
            .drop("category_value", "category_code")
        )
    return df


def decode(df: DataFrame, codes: DataFrame, columns: list[str] = ENCODED_FEATURES) -> DataFrame:
    """The inverse of ``encode`` for known codes."""
    for name in columns:
        known = F.col(name) == F.col("category_code")
        df = (
            df.join(_feature_codes(codes, name), known, "left")
            .withColumn(name, F.col("category_value"))
            .drop("category_value", "category_code")
        )
    return df


def feature_columns(renamed: dict[str, str] | None = None) -> list[Column]:
    """The 23 model features in order, as doubles; what is not a number counts as 0.

    ``renamed`` names other columns to read for some features.
    """
    source = renamed or {}
    return [
        F.coalesce(F.col(source.get(c, c)).try_cast("double"), F.lit(0.0)).alias(c) for c in FEATURES
    ]
