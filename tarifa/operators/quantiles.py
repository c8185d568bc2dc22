"""Exact quantiles without gathering the values in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarifa.session import save


def quantiles(
    df: DataFrame, column: str, shares: list[float], interpolation: str = "linear"
) -> list[float | None]:
    """The exact quantiles of ``column``; null values are left out.

    Rows are counted per distinct value, with partial counts on the map side, and the counts are
    stored in ranges of values: the table is read once. Only the ranges that hold a wanted rank are
    sorted, each in a task of its own; there are as many ranges as shuffle partitions. The driver
    sees one total per range and one value per rank. ``interpolation`` is ``linear`` or ``nearest``.
    """
    ranged, sizes = _ranges(df, column)
    rows = sum(sizes.values())
    if not rows:
        return [None for _ in shares]
    positions = positions_of(shares, rows, interpolation)
    return interpolated(positions, _values_at(ranged, sizes, ranks_of(positions)))


def positions_of(shares: list[float], rows: int, interpolation: str = "linear") -> list[float]:
    """The 0-based places of quantiles among ``rows`` sorted values."""
    positions = [share * (rows - 1) for share in shares]
    return [float(math.floor(p + 0.5)) for p in positions] if interpolation == "nearest" else positions


def ranks_of(positions: list[float]) -> list[int]:
    """The whole places on both sides of each position."""
    return sorted({f(position) for position in positions for f in (math.floor, math.ceil)})


def interpolated(positions: list[float], value_at: dict[int, float]) -> list[float]:
    results = []
    for position in positions:
        low, high = value_at[math.floor(position)], value_at[math.ceil(position)]
        results.append(low + (position - math.floor(position)) * (high - low))
    return results


def values_at(df: DataFrame, column: str, ranks: list[int]) -> dict[int, float]:
    """The values at 0-based ranks of the sorted rows that have one, exactly."""
    return _values_at(*_ranges(df, column), ranks)


def _ranges(df: DataFrame, column: str) -> tuple[DataFrame, dict[int, int]]:
    """Stored counts of distinct values with the number of their range, and the rows of each range."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranged = save(counts.repartitionByRange("value").withColumn("range", F.spark_partition_id()), "value_counts")
    return ranged, dict(ranged.groupBy("range").agg(F.sum("n")).collect())


def _values_at(ranged: DataFrame, sizes: dict[int, int], ranks: list[int]) -> dict[int, float]:
    """The values at 0-based ranks of the sorted rows."""
    starts, start = {}, 0
    for number in sorted(sizes):
        if any(start <= rank < start + sizes[number] for rank in ranks):
            starts[number] = start
        start += sizes[number]
    first_rank = F.create_map([F.lit(x) for pair in starts.items() for x in pair])[F.col("range")]
    running = Window.partitionBy("range").orderBy("value")
    ranked = (
        ranged.where(F.col("range").isin(list(starts)))
        .withColumn("end", first_rank + F.sum("n").over(running))
        .withColumn("rank", F.explode(F.array([F.lit(rank) for rank in ranks])))
        .where((F.col("rank") >= F.col("end") - F.col("n")) & (F.col("rank") < F.col("end")))
    )
    return {row["rank"]: row["value"] for row in ranked.select("rank", "value").collect()}


def approximate_quantiles(
    df: DataFrame, column: str, shares: list[float], accuracy: int = 100_000
) -> list[float | None]:
    """Quantiles from one pass over a mergeable sketch; ranks are off by at most 1/accuracy of the rows."""
    found = df.agg(F.percentile_approx(F.col(column).cast("double"), shares, accuracy)).first()[0]
    return found or [None for _ in shares]
