"""Incremental loads: high-water mark, one row per key, upsert into a stored table."""

from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarifa import schemas
from tarifa.operators import key_filter, partials, rejects
from tarifa.operators.staging import derive_flights, is_valid_flight, parse_flights, stage_flights
from tarifa.session import path_exists, remove_path, settings
from tarifa.sources.tables import RAW_MONTH, union_all

KEY = "leg_id"
MONTH = "search_month"


def high_water_mark(target: DataFrame, column: str = "search_date") -> DataFrame:
    """The greatest value of ``column`` as one row; null for an empty table."""
    return target.agg(F.max(column).alias("high_water_mark"))


def newest_date(table: DataFrame, column: str = "search_date") -> dt.date | None:
    """The greatest value of ``column`` in a staging table, read from its newest month that has rows."""
    if MONTH in table.columns:
        month = table.agg(F.max(MONTH)).first()[0]
        table = table.where(F.col(MONTH) == F.lit(month))
    return table.agg(F.max(column)).first()[0]


def since_mark(bronze: DataFrame, mark: dt.date | None) -> DataFrame:
    """Raw rows not older than ``mark``, or all rows without one, and without the month they are stored by.

    The mark is a literal, by which scans skip the folders of older months and the parts of files that hold older days only.
    """
    if mark is not None:
        bronze = bronze.where(F.col("SEARCHDATE") >= F.lit(mark))
        if RAW_MONTH in bronze.columns:
            bronze = bronze.where(F.col(RAW_MONTH) >= F.lit(f"{mark:%Y-%m}"))
    return bronze.drop(RAW_MONTH)


def one_per_key(df: DataFrame, key: str = KEY, newest: str = "search_date") -> DataFrame:
    """One row per key: the newest, then the first by all other columns, so that the choice is fixed.

    The rank filter keeps one row per key and task before the shuffle, so a hot key stays small.
    """
    rest = [c for c in df.columns if c not in (key, newest, "loaded_at")]
    order = [F.desc(newest)] + [F.asc_nulls_first(c) for c in rest]
    return (
        df.withColumn("copy_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
        .where("copy_rank = 1")
        .drop("copy_rank")
    )


def upsert(target: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """Batch rows replace target rows of equal key, the others are added. ``batch`` has one row per key."""
    return target.join(batch.select(key), key, "left_anti").unionByName(
        batch, allowMissingColumns=True
    )


def classify_arrivals(bronze: DataFrame, target: DataFrame) -> DataFrame:
    """Raw rows by what an incremental load does with them: late, invalid, replaced or added.

    ``target`` has one row per key, as a loaded table does.
    """
    mark = high_water_mark(target).scalar()
    known = target.select(F.col(KEY).alias("known_id"))
    rows = derive_flights(parse_flights(bronze)).join(known, F.col(KEY) == F.col("known_id"), "left")
    outcome = (
        F.when(F.col("search_date") < mark, "late")
        .when(~F.coalesce(is_valid_flight(), F.lit(False)), "invalid")
        .when(F.col("known_id").isNotNull(), "replaced")
        .otherwise("added")
    )
    return rows.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("arrived_rows"))


def search_month() -> Column:
    return F.date_format("search_date", "yyyy-MM")


def staging_schema(staged: DataFrame) -> StructType:
    """The stored schema of staged rows: their columns and the month."""
    return staged.withColumn(MONTH, search_month()).schema


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """The staging table under the current schema, also where it has no files yet."""
    staged = stage_flights(spark.createDataFrame([], schemas.BRONZE))
    return spark.read.schema(staging_schema(staged)).parquet(path).drop(MONTH)


def write_months(df: DataFrame, path: str, laid_out: bool = False) -> None:
    """Write the months in ``df``, each replaced as a whole; other months stay.

    The rebalance hint splits a hot month over tasks and merges small ones. Rows read from a table by month are ``laid_out`` already and
    are copied by the tasks that read them.
    """
    (
        (df if laid_out else df.hint("rebalance", MONTH))
        .write.mode("overwrite")
        .partitionBy(MONTH)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


# A load's files are as many as its tasks times its months; a task reads several of them.
PACKED = {"spark.sql.files.openCostInBytes": "256k"}

LEDGER = "sequence long, load_id string, state string, mark date, input_rows long, input_hash decimal(38,0), stored string"


class Ledger:
    """The loads of one table, in order: each is ``merged`` once its content is stored, then ``published``.

    Rows are appended to a folder beside the table, and a row counts once it can be read. No marker file is needed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.folder = f"{path.rstrip('/')}_loads"
        self.rows = []
        if path_exists(spark, self.folder):
            self.rows = sorted(spark.read.schema(LEDGER).parquet(self.folder).collect(), key=lambda r: (r["sequence"], r["state"]))

    def states(self, load_id: str) -> dict:
        return {row["state"]: row for row in self.rows if row["load_id"] == load_id}

    def pending(self):
        """The last load if its content is stored but not published."""
        last = self.rows[-1] if self.rows else None
        return last if last is not None and last["state"] == "merged" else None

    def add(self, **row) -> None:
        added = self.spark.createDataFrame([tuple(row[field.split()[0]] for field in LEDGER.split(", "))], LEDGER)
        added.coalesce(1).write.mode("append").parquet(self.folder)
        self.rows = self.rows + [added.first()]


def _fingerprint(bronze: DataFrame, mark: dt.date | None) -> tuple[int, Decimal]:
    """Rows that a load looks at, and a sum over their hashes, whatever their order. The load time does not count."""
    rows = since_mark(bronze, mark).drop("_LOADED_AT")
    hashed = F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))
    return tuple(rows.agg(F.count(F.lit(1)), F.coalesce(hashed, F.lit(0).cast("decimal(38,0)"))).first())


def load_batch(
    spark: SparkSession, path: str, bronze: DataFrame, load_id: str, rejects_path: str | None = None, dealt: DataFrame | None = None
) -> None:
    """Load raw rows into the staging table at ``path``, which is stored by search month.

    Rows before the high-water mark are ignored, the rest are staged, reduced to one row per key and upserted. Only months that
    hold a replaced or new row are rewritten, and only months whose key filter has one of the batch's keys are searched for such
    rows. Their new content, the fresh rows and those kept of the touched months, is first stored complete beside the table and noted in
    the ledger of loads; from there it is published. A load that failed before that note starts anew; a load that failed after it is published
    by the next one, under whatever id. A finished ``load_id`` is not loaded again: with the input it had, nothing happens, with
    other input it is an error. The stored columns follow those of the batch: new ones are empty in old rows, lost ones are
    dropped. Content stored for a load is removed once it is published. Run one load per table at a time.

    With ``rejects_path`` the rows that are not loaded, or lose a value, are stored there under ``rows``, and their counts under
    ``summary``; both are complete before the load is noted. ``dealt`` may be the rows of ``bronze`` dealt by key, which then move
    while they are narrow; without it the staged rows move.
    """
    schema = staging_schema(stage_flights(bronze.drop(RAW_MONTH)))
    ledger = Ledger(spark, path)
    if pending := ledger.pending():
        _finish(ledger, pending, path, schema)
    if known := ledger.states(load_id).get("merged"):
        if _fingerprint(bronze, known["mark"]) != (known["input_rows"], known["input_hash"]):
            raise ValueError(f"load {load_id!r} of {path} is finished and had other input; use a new id")
        return
    if path_exists(spark, path):
        current = spark.read.schema(schema).parquet(path)
    else:
        current = spark.createDataFrame([], schema)
    mark = newest_date(current)
    rows, hashed = _fingerprint(bronze, mark)
    stored = f"{path.rstrip('/')}_batches/{uuid.uuid4().hex}"
    with settings(spark, PACKED):
        _store_merged(current, since_mark(bronze if dealt is None else dealt, mark), stored, path)
    if rejects_path:
        audited = rejects.audit(since_mark(bronze, mark))
        rejects.rejects(audited).write.mode("overwrite").parquet(f"{rejects_path}/rows")
        rejects.summary(audited).coalesce(1).write.mode("overwrite").parquet(f"{rejects_path}/summary")
    entry = {"sequence": len(ledger.rows), "load_id": load_id, "mark": mark, "input_rows": rows, "input_hash": hashed, "stored": stored}
    ledger.add(state="merged", **entry)
    _finish(ledger, ledger.pending(), path, schema)


def _finish(ledger: Ledger, pending: Row, path: str, schema: StructType) -> None:
    spark, stored = ledger.spark, pending["stored"]
    touched = _months(spark, stored)
    # Loads noted before fresh rows were stored by month have their whole content in one folder.
    parts = ("merged",) if path_exists(spark, f"{stored}/merged") else ("kept", "fresh")
    with settings(spark, PACKED):
        _publish(union_all([spark.read.schema(schema).parquet(f"{stored}/{part}") for part in parts]), path, touched)
    ledger.add(**{**pending.asDict(), "state": "published"})
    remove_path(spark, stored)


def filters_path(path: str) -> str:
    """Where the key filters of the table at ``path`` are stored."""
    return f"{path.rstrip('/')}_keys"


def counts_path(path: str) -> str:
    """Where the counts per month of the table at ``path`` are stored."""
    return f"{path.rstrip('/')}_counts"


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all months of the staging table at ``path``, see ``partials``."""
    schema = staging_schema(stage_flights(spark.createDataFrame([], schemas.BRONZE)))
    table = spark.read.schema(schema).parquet(path)
    return partials.counts_of(table, partials.read_counts(spark, counts_path(path), MONTH), MONTH)


def rows_of_known_keys(current: DataFrame, fresh: DataFrame, filters: DataFrame) -> DataFrame:
    """Key and month of the rows in ``current`` that ``fresh`` replaces; months that its filters rule out are not read."""
    months = key_filter.months_to_scan(current, filters, fresh, KEY, MONTH)
    return current.where(F.col(MONTH).isin(months)).select(KEY, MONTH).join(fresh.select(KEY), KEY, "left_semi")


def _store_merged(current: DataFrame, arrived: DataFrame, stored: str, path: str) -> None:
    spark = current.sparkSession
    fresh = one_per_key(stage_flights(arrived)).withColumn(MONTH, search_month())
    # Stored for this load only: every task writes the months it has, so staged rows do not move again.
    fresh.write.partitionBy(MONTH).option("compression", "zstd").parquet(f"{stored}/fresh")
    # Read back from files: their size decides whether the key joins below broadcast or shuffle.
    fresh = spark.read.schema(current.schema).parquet(f"{stored}/fresh")
    replaced = rows_of_known_keys(current, fresh, key_filter.read_filters(spark, filters_path(path), MONTH))
    replaced.select(MONTH).union(fresh.select(MONTH)).distinct().write.parquet(f"{stored}/touched")
    rewritten = current.where(F.col(MONTH).isin(_months(spark, stored)))
    write_months(rewritten.join(fresh.select(KEY), KEY, "left_anti"), f"{stored}/kept")


def _publish(merged: DataFrame, path: str, touched: list[str]) -> None:
    kept = {row[0] for row in merged.select(MONTH).distinct().collect()}
    gone = sorted(set(touched) - kept)
    # Months in ``touched`` keep their old filters until the table has changed; a load that fails in between is finished first.
    if kept:
        write_months(merged, path, laid_out=True)
    key_filter.write_filters(merged, filters_path(path), KEY, MONTH, gone)
    partials.write_counts(merged, counts_path(path), MONTH, gone)
    # Months left without rows: their folders go, without a job for each.
    for month in gone:
        remove_path(merged.sparkSession, f"{path}/{MONTH}={month}")


def _months(spark: SparkSession, stored: str) -> list[str]:
    """Months to rewrite: bounded by the calendar, not by the number of rows."""
    return [row[0] for row in spark.read.schema(f"{MONTH} string").parquet(f"{stored}/touched").collect()]
