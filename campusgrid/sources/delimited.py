"""Delimited text: encoding check, delimiter detection and header-based scans."""

from __future__ import annotations

import csv

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.relational import concat_rows
from ..session import ship_package
from .files import blank_to_null, conform_to, list_files, open_input
from .quoted import read_quoted

_DELIMITERS = ",;\t|"


def load_order() -> Column:
    """Sorts rows as they stand in the files: path, block, then place within the scan."""
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def file_encodings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, encoding, multi_line): UTF-8 when every line of the file is valid, else
    ISO-8859-1; multi_line when a line holds an odd number of quotes, as one does whose last
    value goes on in the next line. A line-wise scan, so files are split over tasks and any
    size will do. Paths are written as file listings write them."""
    # Metadata paths are escaped for URIs, where a plus sign stands for itself.
    path_text = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return (
        spark.read.text(path)
        .select(path_text.alias("path"), F.is_valid_utf8("value").alias("ok"), (quotes % 2 == 1).alias("odd"))
        .groupBy("path")
        .agg(
            F.when(F.bool_and("ok"), "UTF-8").otherwise("ISO-8859-1").alias("encoding"),
            F.bool_or("odd").alias("multi_line"),
        )
    )


def pick_delimiter(header_line: str) -> str:
    """Delimiter of a header line; a single-column header gives a comma."""
    try:
        return csv.Sniffer().sniff(header_line, delimiters=_DELIMITERS).delimiter
    except csv.Error:
        return ","


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, separator, names) from the first line of each file; nothing else is read."""
    ship_package(spark)

    def first_lines(batches):
        for batch in batches:
            rows = []
            for name in batch["path"]:
                line = b""
                with open_input(name) as stream:
                    while b"\n" not in line and (block := stream.read(4096)):
                        line += block
                line = line.split(b"\n", 1)[0].rstrip(b"\r")
                try:
                    text = line.decode("utf-8-sig")
                except UnicodeDecodeError:
                    text = line.decode("latin-1")
                separator = pick_delimiter(text)
                rows.append((name, separator, next(csv.reader([text], delimiter=separator), [])))
            yield pd.DataFrame(rows, columns=["path", "separator", "names"])

    return list_files(spark, path).mapInPandas(
        first_lines, "path string, separator string, names array<string>"
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str],
    *,
    schema: StructType | None = None,
    encoding: str = "UTF-8",
    separator: str = ",",
    multi_line: bool = False,
    order_col: str | None = None,
) -> DataFrame:
    """Scan files that share one header. Values stay text unless a schema casts them, so codes
    keep their leading zeros. ``multi_line`` allows line breaks in quotes; such files are read
    twice, by as many tasks as they have ranges."""
    extra = (order_col,) if order_col else ()
    if multi_line:
        table = read_quoted(spark, path, columns, encoding=encoding, separator=separator, order_col=order_col)
        return conform_to(blank_to_null(table), schema, extra)
    raw = StructType([StructField(c, StringType()) for c in columns])
    table = (
        spark.read.schema(raw)
        .option("header", True)
        .option("sep", separator)
        .option("encoding", encoding)
        .option("escape", '"')
        .csv(path)
    )
    if order_col:
        table = table.withColumn(order_col, load_order())
    return conform_to(blank_to_null(table), schema, extra)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: StructType | None = None,
    multi_line: bool | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """Scan text files whose encoding and delimiter are found per file; files that agree on
    encoding, delimiter and header share one scan. Files with line breaks in quotes are found
    and read by ``read_quoted``; ``multi_line`` decides for all files."""
    headers = file_headers(spark, path).join(file_encodings(spark, path), "path", "left")
    groups: dict[tuple, list[str]] = {}
    for row in headers.orderBy("path").toLocalIterator():
        if not row.names:
            continue
        if row.encoding is None:
            raise ValueError(f"{row.path}: the file was listed but its lines were not found")
        whole = row.multi_line if multi_line is None else multi_line
        groups.setdefault((row.encoding, row.separator, tuple(row.names), whole), []).append(row.path)
    if not groups:
        raise FileNotFoundError(f"no text with a header at {path}")
    return concat_rows(
        [
            read_csv(
                spark,
                paths,
                list(names),
                schema=schema,
                encoding=encoding,
                separator=separator,
                multi_line=whole,
                order_col=order_col,
            )
            for (encoding, separator, names, whole), paths in groups.items()
        ]
    )
