"""Listing and opening files of any storage that Spark and Arrow both reach."""

from __future__ import annotations

from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions import as_column, to_integer

# Texts that spreadsheet and delimited files use for "missing".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def open_input(path: str):
    """A seekable binary file for a local path or a storage URI."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    store, inner = fs.FileSystem.from_uri(quote(path, safe=":/%@"))
    return store.open_input_file(inner)


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length) of the files; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def blank_to_null(df: DataFrame) -> DataFrame:
    """Missing-value texts become null in text columns."""
    return df.select(
        *[
            F.when(~as_column(f.name).isin(*MISSING_TEXTS), as_column(f.name)).alias(f.name)
            if isinstance(f.dataType, StringType)
            else as_column(f.name)
            for f in df.schema
        ]
    )


def conform_to(df: DataFrame, schema: StructType | None, extra: tuple[str, ...] = ()) -> DataFrame:
    """Columns of a declared schema, cast leniently from text; the frame as it is without one."""
    if schema is None:
        return df
    return df.select(
        *[_cast(as_column(f.name), f.dataType).alias(f.name) for f in schema],
        *[as_column(c) for c in extra],
    )


def _cast(column: Column, kind) -> Column:
    if isinstance(kind, StringType):
        return column.cast(kind)
    if kind.typeName() in ("integer", "long", "short", "byte"):
        return to_integer(column).try_cast(kind)
    return column.try_cast(kind)
