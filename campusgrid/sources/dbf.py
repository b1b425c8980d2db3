"""dBASE tables as a Spark data source: fixed-width records are read by record range, so one
large file is spread over many tasks, and decoded in columns."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..operators.relational import concat_rows
from ..session import ship_package
from .files import list_files, open_input

_ROWS_PER_BATCH = 20_000


@dataclass(frozen=True)
class DbfField:
    name: str
    kind: str
    width: int
    decimals: int

    def spark_type(self) -> DataType:
        if self.kind == "N":
            return DoubleType() if self.decimals else LongType()
        try:
            return _TYPES[self.kind]()
        except KeyError:
            raise ValueError(f"column {self.name}: dBASE type {self.kind!r} is not supported") from None


# dBASE type codes.
_TYPES = {
    "C": StringType, "F": DoubleType, "D": DateType, "L": BooleanType, "I": LongType,
    "B": DoubleType, "O": DoubleType, "M": StringType,
}


@dataclass(frozen=True)
class DbfHeader:
    records: int
    header_size: int
    record_size: int
    fields: tuple[DbfField, ...]

    def layout(self) -> np.dtype:
        """One record: the deletion mark, then the fields as raw bytes."""
        names = ["mark"] + [f"f{i}" for i in range(len(self.fields))]
        offsets = [0] + [1 + sum(f.width for f in self.fields[:i]) for i in range(len(self.fields))]
        formats = ["S1"] + [f"V{f.width}" for f in self.fields]
        return np.dtype({"names": names, "formats": formats, "offsets": offsets, "itemsize": self.record_size})


def read_header(stream, encoding: str = "latin-1") -> DbfHeader:
    """Header of an open table; the stream is left at the first record."""
    lead = stream.read(32)
    records, header_size, record_size = struct.unpack("<IHH", lead[4:12])
    rest = stream.read(header_size - 32)
    fields = []
    for at in range(0, len(rest) - 31, 32):
        if rest[at] == 0x0D:
            break
        entry = rest[at : at + 32]
        name = entry[:11].split(b"\0")[0].decode(encoding).strip()
        fields.append(DbfField(name, chr(entry[11]), entry[16], entry[17]))
    return DbfHeader(records, header_size, record_size, tuple(fields))


def spark_schema(header: DbfHeader, columns: list[str] | None = None, order_col: str | None = None) -> StructType:
    by_name = {f.name: f for f in header.fields}
    chosen = [by_name[c] for c in columns] if columns else header.fields
    schema = [StructField(f.name, f.spark_type()) for f in chosen]
    return StructType(schema + ([StructField(order_col, LongType())] if order_col else []))


def _texts(raw: np.ndarray, width: int, encoding: str) -> pa.Array:
    return pa.array(np.char.decode(np.ascontiguousarray(raw).view(f"S{width}"), encoding).tolist(), pa.string())


def _decode(field: DbfField, raw: np.ndarray, encoding: str) -> pa.Array:
    """One column of raw record bytes as an Arrow array."""
    if field.kind == "I":
        return pa.array(np.ascontiguousarray(raw).view("<i4").astype("int64"))
    if field.kind in "BO" and field.width == 8:
        return pa.array(np.ascontiguousarray(raw).view("<f8"))
    if field.kind == "M":
        return pa.nulls(len(raw), pa.string())
    text = _texts(raw, field.width, encoding)
    if field.kind == "C":
        return pc.utf8_rtrim(text, characters=" \0")
    text = pc.utf8_trim(text, characters=" \0")
    if field.kind == "L":
        truth = pc.if_else(pc.is_in(text, pa.array(list("TtYy"))), True, pa.scalar(None, pa.bool_()))
        return pc.if_else(pc.is_in(text, pa.array(list("FfNn"))), False, truth)
    if field.kind == "D":
        day = pc.strptime(text, format="%Y%m%d", unit="s", error_is_null=True)
        return pc.cast(day, pa.date32())
    empty = pc.match_substring_regex(text, r"^\**$")
    number = pc.replace_substring(pc.if_else(empty, pa.scalar(None, pa.string()), text), ",", ".")
    if isinstance(field.spark_type(), DoubleType):
        return pc.cast(number, pa.float64())
    return pc.cast(pc.replace_substring_regex(number, r"\.0*$", ""), pa.int64())


def decode_records(
    header: DbfHeader,
    stream,
    count: int,
    *,
    first: int = 0,
    columns: list[str] | None = None,
    encoding: str = "latin-1",
    order_col: str | None = None,
    order_base: int = 0,
    filters: Sequence[Filter] = (),
) -> Iterator[pa.RecordBatch]:
    """Live records from the stream position on, in batches; deleted records are skipped.

    Columns in ``filters`` are decoded first, all others only for the records that pass."""
    layout = header.layout()
    place = {f.name: i for i, f in enumerate(header.fields)}
    chosen = columns or [f.name for f in header.fields]
    while count > 0:
        data = stream.read(header.record_size * min(count, _ROWS_PER_BATCH))
        rows = len(data) // header.record_size
        if not rows:
            return
        table = np.frombuffer(data, dtype=layout, count=rows)
        live = np.flatnonzero(table["mark"] != b"*")
        for column in dict.fromkeys(f.attribute[0] for f in filters):
            raw = table[f"f{place[column]}"][live]
            passed = _passing(_decode(header.fields[place[column]], raw, encoding), [f for f in filters if f.attribute[0] == column])
            live = live[passed]
        arrays = [
            _decode(header.fields[place[c]], table[f"f{place[c]}"][live], encoding) for c in chosen
        ]
        names = list(chosen)
        if order_col:
            arrays.append(pa.array(order_base + first + live, pa.int64()))
            names.append(order_col)
        yield pa.RecordBatch.from_arrays(arrays, names=names)
        first += rows
        count -= rows


_COMPARISONS = {
    EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal,
}


def _decides(test: Filter, kinds: dict[str, str]) -> bool:
    """Whether the reader can apply a filter just as Spark would: comparisons, lists and null tests of one column."""
    kind = kinds.get(test.attribute[0]) if len(getattr(test, "attribute", ())) == 1 else None
    if kind is None or kind == "M":
        return False
    if isinstance(test, (IsNotNull, IsNull)):
        return True
    if isinstance(test, StringStartsWith):
        return kind == "C"
    if isinstance(test, In):
        return all(v is not None for v in test.value)
    return type(test) in _COMPARISONS and test.value is not None


def _passing(values: pa.Array, tests: Sequence[Filter]) -> np.ndarray:
    """Which values pass all tests; a null passes none but the test for it."""
    passed = np.ones(len(values), dtype=bool)
    for test in tests:
        if isinstance(test, IsNotNull):
            found = pc.is_valid(values)
        elif isinstance(test, IsNull):
            found = pc.is_null(values)
        elif isinstance(test, StringStartsWith):
            found = pc.starts_with(values, test.value)
        elif isinstance(test, In):
            found = pc.if_else(pc.is_valid(values), pc.is_in(values, pa.array(list(test.value), values.type)), False)
        else:
            found = _COMPARISONS[type(test)](values, pa.scalar(test.value, values.type))
        passed &= pc.fill_null(found, False).to_numpy(zero_copy_only=False)
    return passed


@dataclass
class _RecordRange(InputPartition):
    path: str
    number: int
    first: int
    count: int


class _DbfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"])
        self.columns = json.loads(options["columns"]) if options.get("columns") else None
        self.encoding = options.get("encoding", "latin-1")
        self.order_col = options.get("ordercolumn")
        self.step = int(options.get("recordspertask", 250_000))
        self.records = json.loads(options["records"])
        self.numbers = json.loads(options["numbers"])
        self.filters: list[Filter] = []

    def partitions(self):
        ranges = [
            _RecordRange(path, number, first, min(self.step, records - first))
            for path, number, records in zip(self.paths, self.numbers, self.records)
            for first in range(0, records, self.step)
        ]
        return ranges or [_RecordRange(self.paths[0], 0, 0, 0)]

    def read(self, part):
        with open_input(part.path) as stream:
            header = read_header(stream, self.encoding)
            stream.seek(header.header_size + part.first * header.record_size)
            yield from decode_records(
                header,
                stream,
                part.count,
                first=part.first,
                columns=self.columns or self._names(),
                encoding=self.encoding,
                order_col=self.order_col,
                order_base=part.number << 32,
                filters=self.filters,
            )

    def _names(self):
        with open_input(self.paths[0]) as stream:
            return [f.name for f in read_header(stream, self.encoding).fields]


class _FilteringDbfReader(_DbfReader):
    """A class of its own: Spark refuses a reader that takes filters where the session has them switched off."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keeps the filters that records can be tested by; the others stay with Spark."""
        with open_input(self.paths[0]) as stream:
            kinds = {f.name: f.kind for f in read_header(stream, self.encoding).fields}
        for test in filters:
            if _decides(test, kinds):
                self.filters.append(test)
            else:
                yield test


class DbfDataSource(DataSource):
    @classmethod
    def name(cls):
        return "dbf"

    def schema(self):
        columns = self.options.get("columns")
        with open_input(json.loads(self.options["paths"])[0]) as stream:
            header = read_header(stream, self.options.get("encoding", "latin-1"))
        return spark_schema(header, json.loads(columns) if columns else None, self.options.get("ordercolumn"))

    def reader(self, schema):
        taken = self.options.get("pushfilters") == "true"
        return _FilteringDbfReader(self.options) if taken else _DbfReader(self.options)


def read_dbf(
    spark: SparkSession,
    path: str | list[str],
    *,
    columns: list[str] | None = None,
    encoding: str = "latin-1",
    order_col: str | None = None,
    records_per_task: int = 250_000,
) -> DataFrame:
    """Scan dBASE tables. ``columns`` decodes only these; ``order_col`` adds the load order.
    Tables with different fields are combined by column name. Where the session has
    ``spark.sql.python.filterPushdown.enabled`` set at this call, records are tested by a query's filters before the
    other columns are decoded; the setting then has to stay. Without it Spark filters the decoded rows."""
    ship_package(spark)
    spark.dataSource.register(DbfDataSource)
    push = str(spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).lower()
    groups: dict[str, list[tuple[str, int, int]]] = {}
    for number, row in enumerate(dbf_headers(spark, path, encoding).orderBy("path").toLocalIterator()):
        groups.setdefault("" if columns else row.fields, []).append((row.path, row.records, number))
    if not groups:
        raise FileNotFoundError(f"no files at {path}")
    frames = []
    for files in groups.values():
        paths, records, numbers = map(list, zip(*files))
        options = {"paths": json.dumps(paths), "encoding": encoding, "recordsPerTask": str(records_per_task),
                   "records": json.dumps(records), "numbers": json.dumps(numbers), "pushFilters": push}
        if columns:
            options["columns"] = json.dumps(columns)
        if order_col:
            options["orderColumn"] = order_col
        frames.append(spark.read.format("dbf").options(**options).load())
    return concat_rows(frames)


def dbf_headers(spark: SparkSession, path: str | list[str], encoding: str = "latin-1") -> DataFrame:
    """(path, records, fields) of every table, read in tasks; ``fields`` are names and types as text."""

    def headers(batches):
        for batch in batches:
            rows = []
            for name in batch["path"]:
                with open_input(name) as stream:
                    header = read_header(stream, encoding)
                fields = json.dumps([(f.name, f.kind, f.decimals > 0) for f in header.fields])
                rows.append((name, header.records, fields))
            yield pd.DataFrame(rows, columns=["path", "records", "fields"])

    return list_files(spark, path).mapInPandas(headers, "path string, records bigint, fields string")


# First bytes of the dBASE versions.
_VERSIONS = {0x02, 0x03, 0x04, 0x05, 0x30, 0x31, 0x32, 0x43, 0x63, 0x83, 0x8B, 0xCB, 0xF5, 0xFB}


def is_dbf(lead: bytes, length: int) -> bool:
    """Whether a file's first 32 bytes and its length are those of a dBASE table."""
    if len(lead) < 32 or lead[0] not in _VERSIONS:
        return False
    records, header_size, record_size = struct.unpack("<IHH", lead[4:12])
    return header_size > 32 and record_size > 0 and header_size + records * record_size <= length
