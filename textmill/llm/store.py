"""Files and tables in the shared folder named by ``spark.checkpoint.dir``.

Tasks write files of formats that Spark has no sink for under names of their
own attempt; a file counts only if the manifest row of the successful attempt
names it, so a retried or speculative task leaves at most an unused file.
Paths are URIs and are opened through ``pyarrow.fs`` (file, hdfs, s3, gs ...).
"""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from textmill.session import remove_scratch, scratch_path, ship_package

#: rows of one Arrow batch between the JVM and Python; whole texts ride in them
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Package on the executors; Arrow batches small enough for long texts."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count: the one lever for task size."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: folders that ``written`` made in this process and nobody has deleted yet
_WRITTEN: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder: cuts the
    lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mark_written() -> int:
    """A mark for ``release_written``."""
    return len(_WRITTEN)


def release_written(spark: SparkSession, since: int) -> None:
    """Delete the tables written since a mark, except the last one.  Only for
    callers whose later results read none of the others."""
    gone = _WRITTEN[since:-1]
    del _WRITTEN[since:-1]
    for path in gone:
        remove_scratch(spark, path)


def tidy(run):
    """A batch function that, when its task ends, gives what the worker has
    freed back to the system: workers live on and share the executor's memory with
    the next stage."""
    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            trim()
    return tidied


def trim() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files that tasks write themselves."""
    return scratch_path(spark, name)


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        uri = "file://" + uri
    return pafs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def attempt_name(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def open_output(uri: str):
    fs, path = opened(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None)


def open_input(uri: str):
    """Memory-mapped where the file is local, so that reading copies nothing."""
    fs, path = opened(uri)
    return pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)


def open_stream(uri: str):
    fs, path = opened(uri)
    return fs.open_input_stream(path, compression=None)
