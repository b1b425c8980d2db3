"""Zip archives: scans of one member of each archive."""

from __future__ import annotations

import codecs
import io
import json
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.relational import concat_rows
from ..session import ship_package
from .dbf import decode_records, read_header, spark_schema
from .files import blank_to_null, conform_to, open_input
from .xlsx import sheet_frames, sheet_rows

# Which member of an archive is the table, best first.
MEMBER_PRIORITY = ("dbf", "xlsx", "xls", "csv")


def text_encoding(stream) -> str:
    """utf-8 if the whole stream is valid, else latin-1. Reads in blocks."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        while block := stream.read(1 << 20):
            decoder.decode(block)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return "latin-1"
    return "utf-8-sig"


def _csv_frames(box: zipfile.ZipFile, member: str, columns: list[str]):
    with box.open(member) as stream:
        encoding = text_encoding(stream)
    first = 0
    with box.open(member) as stream:
        chunks = pd.read_csv(
            stream, encoding=encoding, dtype=str, usecols=columns, chunksize=20_000, keep_default_na=False
        )
        for chunk in chunks:
            frame = chunk[columns].copy()
            frame["_row"] = range(first, first + len(frame))
            first += len(frame)
            yield frame


def _csv_header(box: zipfile.ZipFile, member: str) -> list[str]:
    with box.open(member) as stream:
        encoding = text_encoding(stream)
    with box.open(member) as stream:
        return list(pd.read_csv(stream, encoding=encoding, dtype=str, nrows=0).columns)


def member_schema(path: str, member: str) -> StructType:
    """Schema of one archive member, from its header."""
    kind = member.rsplit(".", 1)[-1].lower()
    with open_input(path) as stream, zipfile.ZipFile(stream) as box:
        if kind == "dbf":
            with box.open(member) as table:
                return spark_schema(read_header(table))
        if kind == "xlsx":
            first = next(sheet_rows(io.BytesIO(box.read(member))), {})
            names = [first[at] for at in sorted(first)]
        else:
            names = _csv_header(box, member)
    return StructType([StructField(n, StringType()) for n in names])


def member_schemas(spark: SparkSession, chosen: list[tuple[str, str]]) -> DataFrame:
    """(path, member, fields) of the chosen members; ``fields`` is their schema as JSON. Headers are read in tasks."""
    ship_package(spark)

    def headers(batches):
        for batch in batches:
            found = [(p, m, member_schema(p, m).json()) for p, m in zip(batch["path"], batch["member"])]
            yield pd.DataFrame(found, columns=["path", "member", "fields"])

    names = spark.createDataFrame(chosen, "path string, member string").repartition(len(chosen), "path")
    return names.mapInPandas(headers, "path string, member string, fields string")


def read_members(
    spark: SparkSession,
    chosen: list[tuple[str, str]],
    *,
    schema: StructType | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """Scan one member of each archive; all members must have the same kind. Members with
    different headers are combined by column name."""
    if any(member.lower().endswith(".xls") for _, member in chosen):
        raise ValueError("legacy .xls workbooks are not supported; save them as .xlsx")
    groups: dict[str, list[tuple[str, str]]] = {}
    for row in member_schemas(spark, chosen).orderBy("path", "member").toLocalIterator():
        groups.setdefault(row.fields, []).append((row.path, row.member))
    return concat_rows(
        [_read_group(spark, files, StructType.fromJson(json.loads(fields)), schema, order_col) for fields, files in groups.items()]
    )


def _read_group(
    spark: SparkSession,
    chosen: list[tuple[str, str]],
    found: StructType,
    schema: StructType | None,
    order_col: str | None,
) -> DataFrame:
    kind = chosen[0][1].rsplit(".", 1)[-1].lower()
    columns = [f.name for f in (schema or found)]
    raw = StructType([found[c] for c in columns] + [StructField("_row", LongType())])

    texts = pa.schema([(c, pa.string()) for c in columns] + [("_row", pa.int64())])

    def parse(batches):
        for batch in batches:
            for path, member in zip(batch["path"].to_pylist(), batch["member"].to_pylist()):
                with open_input(path) as stream, zipfile.ZipFile(stream) as box:
                    if kind == "dbf":
                        with box.open(member) as table:
                            header = read_header(table)
                            yield from decode_records(
                                header, table, header.records, columns=columns, order_col="_row"
                            )
                        continue
                    frames = (
                        sheet_frames(io.BytesIO(box.read(member)), columns)
                        if kind == "xlsx"
                        else _csv_frames(box, member, columns)
                    )
                    for frame in frames:
                        yield pa.RecordBatch.from_pandas(frame, schema=texts, preserve_index=False)

    # One task per archive: a deflated member can only be read from its start.
    names = spark.createDataFrame(chosen, "path string, member string").repartition(len(chosen), "path")
    table = names.mapInArrow(parse, raw)
    if kind != "dbf":
        table = blank_to_null(table)
    table = conform_to(table, schema, ("_row",))
    return table.withColumnRenamed("_row", order_col) if order_col else table.drop("_row")
