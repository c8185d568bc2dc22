"""Session settings and the shared folder for durable intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Generated code above this size is not compiled to machine code by the JVM, so wide projections run
# many times faster outside one large generated method.
# A few bytes of a packed line item become a wide row, so splits by the usual 128 MB are few and long tasks, the last of which run alone.
RUNTIME_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.files.maxPartitionBytes": "8m"}


def build_session(app_name: str = "tarifa", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library is written for; ``settings`` override them."""
    options = {
        **RUNTIME_SETTINGS,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **settings,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's code to the executors, where functions on Arrow batches import it; once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(), "tarifa-code")
        name = os.path.basename(package)
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), name))
        _shipped.add(application)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A session without that setting, as in tests, gets a new folder under its warehouse.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate-{context.applicationId}"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_folder(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold in here; the earlier ones are back afterwards."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


# Rows that a job has moved leave local disk when it ends, not at some later clean-up.
LEAN_SHUFFLE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Lineage ends at durable files, so lost executors recompute nothing before this point, and the
    file sizes let the optimizer choose a broadcast for a small table and a shuffle for a large one.
    Such tables are kept until the results that read them are written, so they are packed densely.
    """
    path = new_path(df.sparkSession, name)
    with settings(df.sparkSession, LEAN_SHUFFLE):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
