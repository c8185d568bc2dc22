"""Files that prune on several keys: rows lie along a curve that interleaves the bits of the keys' ranks.

In a lexicographic order only the first key narrows down files; the others do so inside one value of it. Along this curve every file
holds a range of each key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.sources.tables import write_table

# Ranks per key are numbers of this many bits.
BITS = 6


def rank_bounds(df: DataFrame, key: str, bits: int = BITS) -> list:
    """Rising values that cut the rows into at most ``2 ** bits`` ranges of about equal size, found by Spark's own range sampling.

    Only the key is shuffled, and one value per range arrives. A frequent value may fill several ranges and is one bound.
    """
    ranged = df.where(F.col(key).isNotNull()).select(key).repartitionByRange(1 << bits, key)
    firsts = ranged.groupBy(F.spark_partition_id().alias("range")).agg(F.min(key).alias("first"))
    return sorted({row["first"] for row in firsts.collect()})[1:]


def rank(key: str, bounds: list, bits: int = BITS) -> Column:
    """The number of bounds that are not above the value, spread over all numbers of ``bits`` bits; null comes first.

    A key of few values gets ranks that are far apart, so that its highest bits tell its values apart too.
    """
    if not bounds:
        return F.lit(0)
    found = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(key)))
    spread = F.floor(found * (1 << bits) / (len(bounds) + 1)).cast("int")
    return F.when(F.col(key).isNull(), 0).otherwise(spread)


def interleave(ranks: list[Column], bits: int = BITS) -> Column:
    """One number whose bits are those of the ranks in turn, the highest first."""
    taken = [
        F.shiftleft(F.shiftright(value, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(ranks) + len(ranks) - 1 - place)
        for bit in range(bits)
        for place, value in enumerate(ranks)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


def write_interleaved(
    df: DataFrame,
    path: str,
    keys: list[str],
    spread: list[str],
    partitions: int | None = None,
    mode: str = "error",
    bits: int = BITS,
) -> DataFrame:
    """Write rows in ranges of the interleaved ranks of ``keys``, so that file statistics prune on each of them.

    A hash of ``spread`` comes last in the range, so rows with equal ranks may fill several files. Inside a file rows are sorted by
    the keys. The layout depends on a sample, the rows do not.
    """
    place = interleave([rank(key, rank_bounds(df, key, bits), bits) for key in keys], bits)
    order = [place, F.xxhash64(*spread)]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return write_table(ranged.sortWithinPartitions(*keys), path, mode)


def files_that_may_hold(table: DataFrame, key: str, value) -> tuple[int, int]:
    """Files of a stored table whose range of ``key`` includes ``value``, and all files."""
    ends = table.groupBy(F.col("_metadata.file_path")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return tuple(ends.agg(F.count_if((F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))), F.count(F.lit(1))).first())
