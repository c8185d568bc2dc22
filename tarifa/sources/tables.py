"""Reading and writing tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarifa import schemas
from tarifa.sources.csv_ranges import read_csv

RAW_MONTH = "SEARCHMONTH"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the driver tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The raw itineraries with their declared schema, and last the month of search by which they are stored."""
    return spark.read.schema(StructType([*schemas.BRONZE.fields, StructField(RAW_MONTH, StringType())])).parquet(path)


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text in which ``{name}`` stands for the DataFrame of that name."""
    return spark.sql(query, **tables)


def csv_to_parquet(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: StructType,
    multi_line: bool = True,
) -> int:
    """Convert CSV with a header to Snappy Parquet and return the number of records.

    An empty field is null, quoted or not. A record that does not fit the schema stops the conversion. Large files are split. Line
    breaks inside quotes belong to the field; ``multi_line`` may be off for files that hold none, which are then read once only.
    """
    written = Observation()
    if multi_line:
        rows = read_csv(spark, csv_path, schema)
    else:
        rows = spark.read.schema(schema).csv(csv_path, header=True, escape='"', mode="FAILFAST")
    rows.observe(written, F.count(F.lit(1)).alias("records")).write.mode("overwrite").option(
        "compression", "snappy"
    ).parquet(parquet_path)
    return written.get["records"]


# Records of a packed file, about a range of the reader: such files are read by one task each.
PACKED_RECORDS = 50_000


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write CSV with a header such that the reader above gets equal values back.

    Files packed with ``compression`` are not split by a reader, so they are kept short.
    """
    writer = df.write.option("maxRecordsPerFile", PACKED_RECORDS) if compression else df.write
    writer.csv(
        path,
        compression=compression,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def as_bronze(df: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """Upper-case the column names, cast to the declared types and stamp the load time."""
    upper = df.toDF(*[name.upper() for name in df.columns])
    if "_LOADED_AT" not in upper.columns:
        now = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
        upper = upper.withColumn("_LOADED_AT", now)
    return upper.select(
        [F.col(field.name).cast(field.dataType).alias(field.name) for field in schemas.BRONZE]
    )


def append_bronze(df: DataFrame, path: str, loaded_at: str | None = None) -> int:
    """Append a batch to the raw table, creating it if absent; returns the number of rows added.

    The table has a folder per month of search, so a daily load skips older ones and, by file statistics, older days.
    """
    added = Observation()
    rows = as_bronze(df, loaded_at).observe(added, F.count(F.lit(1)).alias("rows"))
    rows = rows.withColumn(RAW_MONTH, F.date_format("SEARCHDATE", "yyyy-MM"))
    rows.hint("rebalance", RAW_MONTH).write.mode("append").partitionBy(RAW_MONTH).parquet(path)
    return added.get["rows"]


def write_table(df: DataFrame, path: str, mode: str = "error") -> DataFrame:
    """Full refresh of a table: write every row, then read the result back."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_clustered(
    df: DataFrame,
    path: str,
    keys: list[str],
    spread: list[str],
    partitions: int | None = None,
    mode: str = "error",
) -> DataFrame:
    """Write rows range-ordered by ``keys`` so that file statistics prune on them.

    A hash of ``spread`` comes last in the range, so rows of one hot key fill several files instead
    of one task.
    """
    order = [F.col(k) for k in keys] + [F.xxhash64(*spread)]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return write_table(ranged.sortWithinPartitions(*keys), path, mode)


def sync_schema(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both under the schema of ``incoming``: new columns filled with null, lost ones dropped."""
    wanted = incoming.columns
    kept = target.select([c for c in target.columns if c in wanted])
    return kept.unionByName(incoming, allowMissingColumns=True).select(wanted)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
