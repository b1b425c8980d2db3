"""First sheet of spreadsheet workbooks, one workbook per task, streamed in batches."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.relational import concat_rows
from ..session import ship_package
from .files import blank_to_null, conform_to, list_files, open_input

_BATCH = 20_000


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _first_sheet(book: zipfile.ZipFile) -> str:
    """Archive path of the first sheet in workbook order."""
    sheet = next(e for e in ElementTree.fromstring(book.read("xl/workbook.xml")).iter() if _local(e.tag) == "sheet")
    wanted = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
    for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if link.attrib["Id"] == wanted:
            target = link.attrib["Target"]
            return target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
    raise ValueError("workbook has no first sheet")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, element in ElementTree.iterparse(stream):
            if _local(element.tag) == "si":
                strings.append(_plain_text(element))
                element.clear()
    return strings


def _plain_text(element) -> str:
    """Text of a string item without its pronunciation hints."""
    parts = []
    for child in element:
        name = _local(child.tag)
        if name == "t":
            parts.append(child.text or "")
        elif name == "r":
            parts.append(_plain_text(child))
    return "".join(parts)


def _column_number(reference: str) -> int:
    number = 0
    for ch in reference:
        if not ch.isalpha():
            break
        number = number * 26 + ord(ch.upper()) - ord("A") + 1
    return number - 1


# Numbers of the built-in date and time formats, and the first days of the two calendars.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_DAY_ZERO = {False: datetime(1899, 12, 30), True: datetime(1904, 1, 1)}


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = set()
    for e in root.iter():
        if _local(e.tag) == "numFmt":
            code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", e.attrib.get("formatCode", "")).lower()
            if re.search(r"[ymdhs]", code) and "general" not in code:
                custom.add(int(e.attrib["numFmtId"]))
    cells = next((e for e in root if _local(e.tag) == "cellXfs"), ())
    return {i for i, e in enumerate(cells) if int(e.attrib.get("numFmtId", 0)) in _DATE_FORMATS | custom}


def _day_zero(book: zipfile.ZipFile) -> datetime:
    settings = (e for e in ElementTree.fromstring(book.read("xl/workbook.xml")).iter() if _local(e.tag) == "workbookPr")
    return _DAY_ZERO[next((e.attrib.get("date1904") in ("1", "true") for e in settings), False)]


def _date_text(raw: str, zero: datetime) -> str:
    """A serial number as a date, or as a time stamp if it has a part of a day."""
    moment = zero + timedelta(seconds=round(float(raw) * 86400))
    return moment.date().isoformat() if float(raw) == int(float(raw)) else moment.isoformat(sep=" ")


def _cell_value(cell, strings: list[str], dates: set[int], zero: datetime) -> str | None:
    kind = cell.attrib.get("t", "n")
    if kind == "inlineStr":
        return next((_plain_text(e) for e in cell if _local(e.tag) == "is"), None)
    raw = next((e.text for e in cell if _local(e.tag) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "b":
        return "true" if raw == "1" else "false"
    if kind == "n" and int(cell.attrib.get("s", 0)) in dates:
        return _date_text(raw, zero)
    return strings[int(raw)] if kind == "s" else raw


def sheet_rows(stream) -> Iterator[dict[int, str]]:
    """Rows of the first sheet as {column number: text}; rows without cells are skipped. Truth
    values are written as true and false, dates and times in ISO form."""
    with zipfile.ZipFile(stream) as book:
        strings = _shared_strings(book)
        dates = _date_styles(book)
        zero = _day_zero(book)
        with book.open(_first_sheet(book)) as sheet:
            for _, element in ElementTree.iterparse(sheet):
                if _local(element.tag) != "row":
                    continue
                row = {}
                for place, cell in enumerate(element):
                    at = _column_number(cell.attrib["r"]) if "r" in cell.attrib else place
                    value = _cell_value(cell, strings, dates, zero)
                    if value is not None:
                        row[at] = value
                element.clear()
                if row:
                    yield row


def sheet_frames(stream, columns: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of the wanted columns (by header name) plus the row number, all as text."""
    rows = sheet_rows(stream)
    header = {name: at for at, name in next(rows, {}).items()}
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"columns not in the sheet: {missing}")
    batch, first = [], 0
    for row in rows:
        batch.append([row.get(header[c]) for c in columns])
        if len(batch) == _BATCH:
            yield _as_frame(batch, columns, first)
            batch, first = [], first + _BATCH
    if batch:
        yield _as_frame(batch, columns, first)


def _as_frame(batch: list[list[str | None]], columns: list[str], first: int) -> pd.DataFrame:
    frame = pd.DataFrame(batch, columns=columns, dtype=object)
    frame["_row"] = range(first, first + len(batch))
    return frame


def sheet_header(path: str) -> list[str]:
    with open_input(path) as stream:
        first = next(sheet_rows(stream), {})
    return [first[at] for at in sorted(first)]


def read_xlsx(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: StructType | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """Scan workbooks. Columns are text unless a schema (by header name) is given; missing-value
    texts become null. Workbooks with different headers are combined by column name."""
    ship_package(spark)
    if schema is not None:
        return _read_sheets(spark, path, [f.name for f in schema], schema, order_col)
    groups: dict[tuple, list[str]] = {}
    for row in sheet_headers(spark, path).orderBy("path").toLocalIterator():
        groups.setdefault(tuple(row.names), []).append(row.path)
    if not groups:
        raise FileNotFoundError(f"no files at {path}")
    return concat_rows([_read_sheets(spark, paths, list(names), None, order_col) for names, paths in groups.items()])


def sheet_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, names) of every workbook, read in tasks."""

    def headers(batches):
        for batch in batches:
            yield pd.DataFrame([(name, sheet_header(name)) for name in batch["path"]], columns=["path", "names"])

    return list_files(spark, path).mapInPandas(headers, "path string, names array<string>")


def _read_sheets(
    spark: SparkSession, path: str | list[str], columns: list[str], schema: StructType | None, order_col: str | None
) -> DataFrame:
    """Workbooks that all have the columns."""
    files = list_files(spark, path)
    raw = StructType([StructField(c, StringType()) for c in columns] + [StructField("_row", LongType())])

    def parse(batches):
        for batch in batches:
            for name in batch["path"]:
                with open_input(name) as stream:
                    yield from sheet_frames(io.BytesIO(stream.read()), columns)

    # One task per workbook: only paths are moved, never contents.
    spread = files.repartition(max(1, files.count()), "path")
    table = conform_to(blank_to_null(spread.mapInPandas(parse, raw)), schema, ("_row",))
    return table.withColumnRenamed("_row", order_col) if order_col else table.drop("_row")
