"""Streams without the rows that were delivered before.

Which rows pass depends on their keys, so only keys and the places of rows in their files are moved and compared; rows that pass are then
read where they lie.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarifa import schemas
from tarifa.session import LEAN_SHUFFLE, remove_path, settings

# A quote is known by its itinerary and its day: the same itinerary quoted on another day is news, not a repeat.
QUOTE_KEY = ("LEGID", "SEARCHDATE")
DELAY = "7 days"
# Keys of the whole delay are state; this store keeps it on disk and in the checkpoint, not in the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# What a stream needs on local disk: its state goes when a task has committed it to the checkpoint, the rows that a batch has moved when
# the batch ends. Else copies of the state of every run, and of all rows, stay until some later clean-up.
LEAN_DISK = {"spark.sql.streaming.stateStore.unloadOnCommit": "true", **LEAN_SHUFFLE}

# The rows of a file that pass are a bit each, in maps of this many bytes (``bitmap_construct_agg``). Maps up to this size in all are copied
# to every task; beyond it rows are moved to them.
MAP_BYTES = 4096
COPIED_BYTES = 64 << 20


def without_repeats(stream: DataFrame, delay: str = DELAY, key: tuple[str, ...] = QUOTE_KEY, event: str = "SEARCHDATE") -> DataFrame:
    """The first row of each ``key`` that arrives within ``delay``.

    Time is the greatest ``event`` of earlier batches, less ``delay``: the watermark. State of a key is kept until the watermark passes
    its first row by ``delay``. A repeat that arrives later has an ``event`` below the watermark, as its key holds it, and is dropped as
    late, like every other row below it. Without ``event`` in the key, a row of an old key with a new ``event`` passes again. Rows
    without an ``event`` have no time; they are dropped.
    """
    timed = stream.where(F.col(event).isNotNull()).withColumn("_event", F.col(event).cast("timestamp"))
    return timed.withWatermark("_event", delay).dropDuplicatesWithinWatermark(list(key)).drop("_event")


def read_landing(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """The raw rows of the files in a folder, as a stream."""
    reader = spark.readStream.schema(schemas.BRONZE)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(landing)


def use_disk_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def stream_once(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    delay: str = DELAY,
    key: tuple[str, ...] = QUOTE_KEY,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append what arrived in ``landing`` since the last run to ``output``, without repeats, then stop.

    The keys that were seen are in ``checkpoint``, so repeats are found across runs too.
    """
    use_disk_state(spark)
    event = "SEARCHDATE"
    place = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    narrow = read_landing(spark, landing, files_per_batch).select(*dict.fromkeys([*key, event]), *place)

    def append(passed: DataFrame, number: int) -> None:
        own, stored = passed.sparkSession, f"{checkpoint.rstrip('/')}/passed"
        # The only action on the batch: it commits the state.
        bits = F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("_bits")
        passed.groupBy("_file", F.bitmap_bucket_number("_row").alias("_map")).agg(bits).write.mode("overwrite").parquet(stored)
        _append_batch(rows_at(own, landing, own.read.parquet(stored)), output, number)
        remove_path(own, stored)

    once = without_repeats(narrow, delay, key, event)
    with settings(spark, LEAN_DISK):
        return once.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rows_at(spark: SparkSession, landing: str, maps: DataFrame) -> DataFrame:
    """The raw rows of ``landing`` at the places in ``maps``: ``_bits`` by ``_file`` and number ``_map`` of the map in the file.

    Only files that have a map are read. The list of them is at the driver, as it is for the reader.
    """
    found = maps.groupBy("_file").count().collect()
    if not found:
        return spark.range(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.BRONZE])
    glob = spark._jvm.org.apache.spark.deploy.SparkHadoopUtil.get().isGlobPath(spark._jvm.org.apache.hadoop.fs.Path(landing))
    options = {"__globPaths__": "false"} | ({} if glob else {"basePath": landing})
    source = spark.read.schema(schemas.BRONZE).options(**options).parquet(*[unquote(row["_file"]) for row in found])
    row = F.col("_metadata.row_index")
    placed = source.select(
        *schemas.BRONZE.names,
        F.col("_metadata.file_path").alias("_file"),
        F.bitmap_bucket_number(row).alias("_map"),
        F.bitmap_bit_position(row).alias("_bit"),
    )
    small = sum(r["count"] for r in found) * MAP_BYTES <= COPIED_BYTES
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 + 1 as int), 1)")), 16, 10).cast("long")
    passes = F.expr("shiftleft(1L, cast(_bit % 8 as int))").bitwiseAND(byte) != 0
    return placed.join(F.broadcast(maps) if small else maps, ["_file", "_map"]).where(passes).select(*schemas.BRONZE.names)


def _append_batch(rows: DataFrame, output: str, number: int) -> None:
    """Append a batch as the streaming file sink does: its log makes the files of a batch count all at once, and once only."""
    jvm, session = rows.sparkSession._jvm, rows.sparkSession._jsparkSession
    convert = jvm.org.apache.spark.api.python.PythonUtils
    made = jvm.org.apache.spark.sql.execution.datasources.parquet.ParquetFileFormat()
    options = convert.toScalaMap({"compression": "zstd", "path": output})
    sink = jvm.org.apache.spark.sql.execution.streaming.sinks.FileStreamSink(session, output, made, convert.toSeq([]), options)
    sink.addBatch(number, rows._jdf)
