"""Delimited text with line breaks in quotes, read by several tasks a file.

Whether a line starts a record or goes on inside a quoted value depends on everything before it. A file is cut into
byte ranges that begin after line breaks; each range says where it ends up if it starts outside, and if it starts
inside a quoted value. Going from range to range with these two answers (a running sum of switches since the last range
with one answer only) gives every range its true start, and then each one reads its own records."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import as_column
from ..session import keep, ship_package
from .files import list_files, open_input

#: Bytes of a range: what a task holds beside the one record that goes beyond it.
RANGE_BYTES = 16 << 20


class LineStates:
    """Where a line leads: ``closed(line, inside)`` tells whether a record ends with it.

    A quoted value begins with a quote at the start of a field and ends with a quote that is not doubled; what follows
    up to the separator belongs to the field. Quotes elsewhere are plain characters."""

    def __init__(self, separator: str) -> None:
        sep = re.escape(separator.encode())
        value = rb'(?:[^"]++|"")*+"(?:(?!%s).)*+' % sep
        field = rb'(?:"%s|(?!")(?:(?!%s).)*+)' % (value, sep)
        rest = rb"(?:%s%s)*+\Z" % (sep, field)
        self._outside = re.compile(field + rest, re.DOTALL)
        self._inside = re.compile(value + rest, re.DOTALL)

    def closed(self, line: bytes, inside: bool) -> bool:
        if b'"' not in line:
            return not inside
        return (self._inside if inside else self._outside).match(line) is not None


def _lines(stream, start: int, stop: int) -> Iterator[tuple[bytes, bool]]:
    """Lines (without their line feed) that begin in [start, stop), and after them the following ones, marked False.

    The line that a range begins in the middle of belongs to the range before."""
    at = read = max(start - 1, 0)
    stream.seek(at)
    skip, ahead, held = start > 0, 1 << 12, []
    # Up to the end of the range, then only as far as the last record goes.
    while more := stream.read(min(RANGE_BYTES, stop - read if read < stop else ahead)):
        if read >= stop:
            ahead *= 2
        read += len(more)
        pieces = more.split(b"\n")
        if len(pieces) > 1:
            pieces[0] = b"".join([*held, pieces[0]])
            held = []
        held.append(pieces.pop())
        for line in pieces:
            if skip:
                skip = False
            else:
                yield line, at < stop
            at += len(line) + 1
        if skip and read >= stop - 1:
            return  # no line begins here
    last = b"".join(held)
    if last and not skip:
        yield last, at < stop


def _outcomes(separator: str):
    """Per range: whether a record ends with it, if it starts outside and if it starts inside a quoted value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = LineStates(separator)
        for batch in batches:
            for path, start, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "stop"))):
                inside = [False, True]
                with open_input(path) as stream:
                    for line, own in _lines(stream, start, stop):
                        if not own:
                            break
                        if b'"' in line:
                            inside = [not states.closed(line, state) for state in inside]
                columns = [pa.array([v]) for v in (path, start, stop, *inside)]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "start", "stop", "if_outside", "if_inside"])

    return run


def _records(separator: str, encoding: str, at_a_time: int = 4096):
    """The records that begin in each range as texts, without blank ones and the header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = LineStates(separator)
        for batch in batches:
            for path, start, stop, inside in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "stop", "inside"))):
                found, place = [], 0
                with open_input(path) as stream:
                    for record in _joined(_lines(stream, start, stop), inside, states):
                        place += 1
                        if record and not (start == 0 and place == 1):
                            found.append((place, record.decode(encoding, "replace")))
                        if len(found) == at_a_time:
                            yield _batch(path, start, found)
                            found = []
                yield _batch(path, start, found)

    return run


def _joined(lines: Iterator[tuple[bytes, bool]], inside: bool, states: LineStates) -> Iterator[bytes]:
    """Records that begin with an own line; lines of a record that began before are passed over."""
    skip, parts = inside, []
    for line, own in lines:
        if not parts and not skip and not own:
            return
        closed = states.closed(line, inside)
        if not skip:
            parts.append(line)
        if closed:
            if parts:
                yield b"\n".join(parts).removesuffix(b"\r")
            skip, parts = False, []
        elif skip and not own:
            return  # the record that began before goes on beyond this range
        inside = not closed
    if parts:
        yield b"\n".join(parts).removesuffix(b"\r")


def _batch(path: str, start: int, found: list[tuple[int, str]]) -> pa.RecordBatch:
    places, records = [p for p, _ in found], [r for _, r in found]
    columns = [pa.array([path] * len(found), pa.string()), pa.array([start] * len(found), pa.int64()), pa.array(places, pa.int64()), pa.array(records, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["path", "block", "place", "record"])


def file_ranges(spark: SparkSession, path: str | list[str], separator: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, start, stop, inside): the byte ranges of the files, and whether each starts inside a quoted value."""
    ship_package(spark)
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))
    ranges = list_files(spark, path).select("path", "length", F.explode(starts).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("stop"))
    size = ranges.agg(F.count("*").alias("ranges"), F.sum(F.col("stop") - F.col("start")).alias("bytes")).first()
    # A task for each range while they are few; many small ones share tasks.
    count = max(1, min(size["ranges"], max(4 * spark.sparkContext.defaultParallelism, -(-(size["bytes"] or 0) // RANGE_BYTES))))
    schema = "path string, start bigint, stop bigint, if_outside boolean, if_inside boolean"
    outcomes = ranges.repartition(count).mapInArrow(_outcomes(separator), schema)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    switches = (F.col("if_outside") & ~F.col("if_inside")).cast("int")
    outcomes = outcomes.withColumn("switched", F.sum(switches).over(before.rowsBetween(Window.unboundedPreceding, 0)))
    # A range whose two answers agree settles the state whatever came before.
    settled = F.when(F.col("if_outside") == F.col("if_inside"), F.struct("if_outside", "switched"))
    known = F.last(settled, ignorenulls=True).over(before)
    base, since = F.coalesce(known["if_outside"], F.lit(False)), F.coalesce(known["switched"], F.lit(0))
    odd = (F.coalesce(F.last("switched").over(before), F.lit(0)) - since) % 2 == 1
    return outcomes.select("path", "start", "stop", (base != odd).alias("inside")).repartition(count)


def read_quoted(
    spark: SparkSession, path: str | list[str], columns: list[str], *, encoding: str = "UTF-8", separator: str = ",",
    order_col: str | None = None, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Text columns of files that share one header, quoted line breaks allowed; a record is read whole by the task in
    whose range it begins. ``order_col``: sorts rows as they stand in the files."""
    ranges = keep(file_ranges(spark, path, separator, range_bytes))
    found = ranges.mapInArrow(_records(separator, encoding), "path string, block bigint, place bigint, record string")
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    parsed = found.withColumn("row", F.from_csv("record", F.lit(schema), {"sep": separator, "escape": '"'}))
    order = [F.struct("path", "block", "place").alias(order_col)] if order_col else []
    return parsed.select(*[F.col("row")[c].alias(c) for c in columns], *order)
