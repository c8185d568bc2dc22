"""Quantiles of a table stored by month, from counts per month on a fixed grid of values.

Values fall into cells whose width is one percent of the value, on the same grid for every month, so counts of months can be added up
and those of a rewritten month replaced. The sums say exactly in which cell a rank lies and how many rows lie below it, which is a
quantile with an error of one percent of its value. One more pass makes it exact: it reads the rows of that cell alone, in the months
that have some, and finds the rank among them.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.operators import quantiles

WIDTH = 0.01
_LOG = math.log1p(WIDTH)
# More than the number of cells on either side of 1 for any double.
_ONE = 100_000


def cell(value: Column) -> Column:
    """The number of the cell of a value, rising with it; 0 for zero, null for what is not a finite number."""
    number = value.cast("double")
    size = F.floor(F.log(F.abs(number)) / F.lit(_LOG)).cast("int") + _ONE
    finite = number.isNotNull() & (F.abs(number) < F.lit(float("inf")))
    return F.when(finite & (number == 0), 0).when(finite & (number > 0), size).when(finite, -size)


def bounds(number: int) -> tuple[float, float]:
    """Values between which all of a cell lie; a little wide, as logarithms are rounded."""
    if number == 0:
        return 0.0, 0.0
    low, high = (_power(abs(number) - _ONE + step) for step in (-1e-6, 1 + 1e-6))
    return (low, high) if number > 0 else (-high, -low)


def _power(steps: float) -> float:
    return math.exp(min(steps * _LOG, 709.78))


def month_counts(df: DataFrame, columns: list[str], month: str) -> DataFrame:
    """``name``, ``cell``, ``n`` and the month for each column in ``columns``; other than finite values are left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("name"), cell(F.col(c)).alias("cell")) for c in columns])
    listed = df.select(month, F.inline(cells)).where("cell is not null")
    return listed.groupBy("name", "cell", month).agg(F.count(F.lit(1)).alias("n"))


def approximate(grid: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Quantiles within one percent of their value, from the counts alone: the upper end of the cell of the nearest rank."""
    cells, ends = _sums(grid, column)
    if not cells:
        return [None for _ in shares]
    return [bounds(cells[bisect_right(ends, round(p))])[1] for p in quantiles.positions_of(shares, ends[-1], "nearest")]


def exact(table: DataFrame, grid: DataFrame, column: str, shares: list[float], month: str, interpolation: str = "linear") -> list[float | None]:
    """The exact quantiles of ``column``; ``grid`` has the counts of all months of ``table``."""
    cells, ends = _sums(grid, column)
    if not cells:
        return [None for _ in shares]
    positions = quantiles.positions_of(shares, ends[-1], interpolation)
    ranks = quantiles.ranks_of(positions)
    place = {rank: bisect_right(ends, rank) for rank in ranks}
    used = sorted(set(place.values()))
    # Rows of the cells that are not read come before a rank in the table but not among the rows read.
    skipped, at = {}, 0
    for i in used:
        skipped[i] = (ends[i - 1] if i else 0) - at
        at += ends[i] - (ends[i - 1] if i else 0)
    value_at = quantiles.values_at(
        rows_of_cells(table, grid, column, [cells[i] for i in used], month), column, [rank - skipped[i] for rank, i in place.items()]
    )
    return quantiles.interpolated(positions, {rank: value_at[rank - skipped[i]] for rank, i in place.items()})


def rows_of_cells(table: DataFrame, grid: DataFrame, column: str, cells: list[int], month: str) -> DataFrame:
    """The values of ``column`` in the given cells, read from the months that have some; the ends of the cells reach the scan."""
    held = grid.where((F.col("name") == column) & F.col("cell").isin(cells)).select(month).distinct().collect()
    value, ends = F.col(column), [bounds(c) for c in cells]
    kind = table.schema[column].dataType
    near = [(value >= F.lit(low).cast(kind)) & (value <= F.lit(high).cast(kind)) for low, high in map(lambda e: _outside(e, kind), ends)]
    inside = near[0]
    for one in near[1:]:
        inside = inside | one
    months = F.col(month).isin([r[0] for r in held])
    return table.where(months & inside & cell(value).isin(cells)).select(column)


def _outside(ends: tuple[float, float], kind) -> tuple[float, float]:
    """Ends that still enclose the cell after a cast to whole numbers or decimals, which rounds."""
    if kind.typeName() in ("double", "float"):
        return ends
    step = 10.0 ** -getattr(kind, "scale", 0)
    return ends[0] - step, ends[1] + step


def _sums(grid: DataFrame, column: str) -> tuple[list[int], list[int]]:
    """The cells in order and the rows up to the end of each. A grid has at most some thousand cells between any usual values."""
    rows = grid.where(F.col("name") == column).groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect()
    return [r["cell"] for r in rows], list(accumulate(r["n"] for r in rows))
