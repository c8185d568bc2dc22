"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.session import save


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node of ``edges`` (``a``, ``b``).

    Large-star and small-star steps in turn: each node links its larger neighbours, then its smaller ones, to the smallest
    neighbour it has. The number of rounds grows with the logarithm of the longest chain. Every round is a stored table, so a lost
    executor repeats one round at most. Self links and repeated edges are allowed; nodes are not null.
    """
    current = save(_directed(edges), "edges")
    while True:
        large = _star(current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        small = _star(large, larger=False)
        after = save(small, "edges")
        if _digest(after) == _digest(current):
            break
        current = after
    labels = after.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    roots = after.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    alone = edges.filter("a = b").select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("label").alias("label"))


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link neighbours of ``a`` to the smallest of ``a`` and its neighbours."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    least = least.withColumn("least", F.least("a", "least"))
    linked = edges.join(least, "a")
    if larger:
        kept = linked.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        kept = linked.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.filter("a <> least").select("a", F.col("least").alias("b"))
        )
    return kept.filter("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes: equal tables have equal digests."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
