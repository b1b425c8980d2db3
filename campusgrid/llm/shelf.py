"""Tables that several jobs of an operator read, written to the folder all executors share.

A lost executor loses none of them, and a plan that reads one starts from files instead of a long lineage.
They live below ``spark.checkpoint.dir`` in a folder of the application; ``clear`` removes that folder once
results have been written."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from campusgrid.session import shared_dir, ship_package

#: Rows of a batch that goes to Python: whole documents are large, and a task holds two batches at a time.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers and keep the batches sent to them small."""
    ship_package(spark)
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def tidy(run):
    """A batch function that gives its memory back when its task ends, as workers are used again for other tasks."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}"


def fresh(spark: SparkSession, name: str) -> str:
    """A new path for a table or a set of files."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Paths of the tables written so far that nobody has removed.
_tables: list[str] = []


def save(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The same rows, written once and read back."""
    spark = df.sparkSession
    path = path or fresh(spark, name)
    _tables.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def tables() -> set[str]:
    """Paths of all tables that are kept now."""
    return set(_tables)


def discard_all(spark: SparkSession, paths: set[str]) -> None:
    """Remove tables that nothing reads any more."""
    for path in paths:
        discard(spark, path)
        if path in _tables:
            _tables.remove(path)


def clear(spark: SparkSession) -> None:
    """Remove every table of this application; results that still read them must be written first."""
    discard(spark, folder(spark))
