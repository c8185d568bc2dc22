"""Layout by interleaved keys: the curve, the rows, and the files that filters leave."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tarifa.session import new_path
from tarifa.sources import interleaved, tables


def test_bits_take_turns(spark):
    ranks = [(a, b) for a in range(8) for b in range(8)]
    df = spark.createDataFrame(ranks, "a int, b int")
    rows = df.withColumn("z", interleaved.interleave([F.col("a"), F.col("b")], 3)).collect()
    for r in rows:
        wanted = sum(((r["a"] >> i & 1) << (2 * i + 1)) + ((r["b"] >> i & 1) << (2 * i)) for i in range(3))
        assert r["z"] == wanted
    assert sorted(r["z"] for r in rows) == list(range(64))


@pytest.fixture(scope="module")
def flights(spark):
    rng = random.Random(7)
    rows = [(i, dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(300)), rng.choice("ABCDEFGHIJKL")) for i in range(6000)]
    rows += [(9000, None, "A"), (9001, dt.date(2024, 1, 5), None), (9002, None, None)]
    return spark.createDataFrame(rows, "id long, day date, airline string")


def test_rows_stay_and_both_keys_prune(spark, flights):
    plain = tables.write_clustered(flights, new_path(spark, "plain"), ["day", "airline"], ["id"], partitions=64)
    mixed = interleaved.write_interleaved(flights, new_path(spark, "mixed"), ["day", "airline"], ["id"], partitions=64)
    assert sorted(mixed.collect(), key=str) == sorted(flights.collect(), key=str)
    before, files = interleaved.files_that_may_hold(plain, "airline", "F")
    after, mixed_files = interleaved.files_that_may_hold(mixed, "airline", "F")
    assert files > 50 and mixed_files > 50 and before == files and 3 * after <= mixed_files
    days, _ = interleaved.files_that_may_hold(mixed, "day", dt.date(2024, 6, 1))
    assert 3 * days <= mixed_files


def test_ranks(spark, flights):
    bounds = interleaved.rank_bounds(flights, "airline", 3)
    assert bounds == sorted(set(bounds)) and len(bounds) <= 7
    ranked = flights.select("airline", interleaved.rank("airline", bounds).alias("r")).distinct().collect()
    by_value = sorted(("" if r["airline"] is None else r["airline"], r["r"]) for r in ranked)
    assert [r for _, r in by_value] == sorted(r for _, r in by_value) and by_value[0][1] == 0
    # One value everywhere, and no rows at all.
    one = flights.withColumn("airline", F.lit("X"))
    assert interleaved.rank_bounds(one, "airline") == []
    assert interleaved.write_interleaved(one, new_path(spark, "one"), ["airline"], ["id"], partitions=4).count() == flights.count()
    assert interleaved.write_interleaved(flights.limit(0), new_path(spark, "none"), ["day", "airline"], ["id"]).count() == 0


def test_hot_ranks_fill_several_files(spark):
    hot = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").cast("string").alias("row"))
    path = new_path(spark, "hot")
    interleaved.write_interleaved(hot, path, ["k"], spread=["row"], partitions=4)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 4 and max(f["count"] for f in files) < 2000
