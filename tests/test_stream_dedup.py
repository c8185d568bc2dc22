"""Repeats in a stream: across batches and runs, late ones, and before a load."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F
from test_operators import as_map, load, raw  # noqa: F401

from tarifa.session import new_path
from tarifa.streaming import dedup
from tarifa.streaming.dedup import stream_once
from tarifa.streaming.loads import stream_into_staging


@pytest.fixture
def quotes(spark, raw):  # noqa: F811
    """Writes quotes of ``(number, day)`` as one arrival each and returns what passed so far."""
    landing, output, checkpoint = (new_path(spark, n) for n in ("landing", "once", "checkpoint"))
    one = raw.limit(1)

    def arrive(*rows, **options):
        listed = spark.createDataFrame([(f"leg-{n}", day) for n, day in rows], "leg string, day string")
        made = one.crossJoin(F.broadcast(listed)).withColumns({"LEGID": F.col("leg"), "SEARCHDATE": F.col("day").cast("date")})
        made.select(one.columns).coalesce(1).write.mode("append").parquet(landing)
        stream_once(spark, landing, output, checkpoint, **options).awaitTermination()
        passed = spark.read.schema(one.schema).parquet(output)
        return sorted((int(r["LEGID"][4:]), str(r["SEARCHDATE"])) for r in passed.collect())

    return arrive


def test_repeats_across_runs_are_dropped(quotes):
    first = [(1, "2024-01-01"), (2, "2024-01-02"), (1, "2024-01-01")]
    assert quotes(*first, delay="30 days") == [(1, "2024-01-01"), (2, "2024-01-02")]
    # Quoted again on another day is no repeat.
    again = quotes(*first, (1, "2024-01-03"), (3, "2024-01-01"), delay="30 days")
    assert again == [(1, "2024-01-01"), (1, "2024-01-03"), (2, "2024-01-02"), (3, "2024-01-01")]


def test_late_repeats(quotes):
    """The state of a key goes once the watermark has passed it; its repeats are below the watermark then and late."""
    quotes((1, "2024-01-01"), delay="5 days")
    quotes((2, "2024-03-01"), delay="5 days")
    quotes((3, "2024-03-02"), delay="5 days")
    passed = quotes((1, "2024-01-01"), (2, "2024-03-01"), (4, "2024-01-05"), (5, "2024-02-28"), delay="5 days")
    assert passed == [(1, "2024-01-01"), (2, "2024-03-01"), (3, "2024-03-02"), (5, "2024-02-28")]


def test_key_without_its_day(quotes):
    """By itinerary alone a second quote is a repeat until the delay is over."""
    key = ("LEGID",)
    assert quotes((1, "2024-01-01"), (2, "2024-01-01"), delay="5 days", key=key) == [(1, "2024-01-01"), (2, "2024-01-01")]
    assert len(quotes((1, "2024-01-03"), delay="5 days", key=key)) == 2
    quotes((9, "2024-02-01"), delay="5 days", key=key)
    assert (1, "2024-02-02") in quotes((1, "2024-02-02"), delay="5 days", key=key)


def test_rows_without_a_day_are_dropped(quotes):
    assert quotes((1, None), (2, "2024-01-01"), delay="5 days") == [(2, "2024-01-01")]


def test_before_a_load(spark, raw):  # noqa: F811
    landing, table, checkpoint = (new_path(spark, n) for n in ("landing", "staging", "checkpoint"))
    load(raw, "1", "2024-01-05").write.parquet(landing)
    stream_into_staging(spark, landing, table, checkpoint, repeat_delay="30 days").awaitTermination()
    before = as_map(spark, table)
    # The same quotes at another price are repeats, the others are not.
    dearer = load(raw, "1", "2024-01-05").withColumn("TOTALFARE", (F.col("TOTALFARE") + 5).cast("decimal(10,2)"))
    dearer.unionByName(load(raw, "2", "2024-01-06")).write.mode("append").parquet(landing)
    stream_into_staging(spark, landing, table, checkpoint, repeat_delay="30 days").awaitTermination()
    after = as_map(spark, table)
    assert before.items() <= after.items()
    assert {d for k, (d, _) in after.items() if k not in before} == {dt.date(2024, 1, 6)}


def test_little_stays_on_local_disk(spark, raw):  # noqa: F811
    """A run leaves neither the rows it moved nor its state on local disk, and the session has its settings back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    jvm, before = spark._jvm, spark.conf.get(key)
    local = jvm.org.apache.spark.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())

    def left():
        blocks = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        moved = {str(blocks.apply(i)) for i in range(blocks.size()) if "shuffle_" in str(blocks.apply(i))}
        return moved | {str(p) for p in pathlib.Path(local).rglob("*.sst")}

    landing, output, checkpoint = (new_path(spark, n) for n in ("landing", "once", "checkpoint"))
    raw.write.parquet(landing)
    stayed = left()
    stream_once(spark, landing, output, checkpoint).awaitTermination()
    assert left() <= stayed and spark.conf.get(key) == before


def test_only_keys_and_places_are_moved(spark, raw, capsys):  # noqa: F811
    landing, output, checkpoint = (new_path(spark, n) for n in ("landing", "once", "checkpoint"))
    raw.write.parquet(landing)
    run = stream_once(spark, landing, output, checkpoint, delay="3000 days")
    run.awaitTermination()
    capsys.readouterr()
    run.explain()
    moved = capsys.readouterr().out
    assert "Exchange" in moved and "LEGID" in moved and "TOTALFARE" not in moved


@pytest.mark.parametrize("copied", [dedup.COPIED_BYTES, 0])
def test_whole_rows_pass(spark, raw, monkeypatch, copied):  # noqa: F811
    """Rows of files with more rows than a map has bits, repeats inside a batch and later, in a folder with an odd name."""
    monkeypatch.setattr(dedup, "COPIED_BYTES", copied)
    landing, output, checkpoint = f"{new_path(spark, 'landing')} a%20b[1]{{c}}", new_path(spark, "once"), new_path(spark, "checkpoint")
    one, n = raw.limit(1), 70_001

    def arrive(numbers, fare):
        made = one.crossJoin(numbers).withColumns(
            {"LEGID": F.concat(F.lit("leg-"), F.col("id").cast("string")), "SEARCHDATE": F.lit("2024-01-01").cast("date"), "TOTALFARE": (F.col("id") % 977 + fare).cast("decimal(10,2)")}
        )
        made.select(one.columns).coalesce(1).write.mode("append").parquet(landing)
        # A stream takes a folder for a pattern.
        escaped = "".join(f"\\{c}" if c in "[]{}" else c for c in landing)
        stream_once(spark, escaped, output, checkpoint, delay="30 days").awaitTermination()
        return spark.read.schema(one.schema).parquet(output)

    passed = arrive(spark.range(n).unionByName(spark.range(0, n, 7)), 100)
    fare = F.sum(F.col("TOTALFARE") - F.substring("LEGID", 5, 9).cast("long") % 977)
    ids = F.countDistinct("LEGID")
    assert passed.agg(F.count(F.lit(1)), ids, fare).first()[:] == (n, n, 100 * n)
    passed = arrive(spark.range(n - 5, n + 40_000, 3), 200)
    new = len(range(n - 5, n + 40_000, 3)) - 2
    assert passed.agg(F.count(F.lit(1)), ids, fare).first()[:] == (n + new, n + new, 100 * n + 200 * new)
    rest = [c for c in one.columns if c not in ("LEGID", "SEARCHDATE", "TOTALFARE")]
    assert [r[:] for r in passed.select(rest).distinct().collect()] == [r[:] for r in one.select(rest).collect()]
