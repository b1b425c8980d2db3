"""Fill-in-the-middle training texts: a text is cut at two line ends and its parts are put in another order.

Where lines end is kept as a compressed set of code point offsets (``boundary_set``), so both cuts are two selects by
rank, and other seeds, epochs or forms need the sets only. Choices come from hashes of the document's id. Cutting,
joining and rebuilding texts are JVM expressions; Python sees a text once, to find its line ends."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from campusgrid.llm.boundary_set import BoundarySet
from campusgrid.llm.shelf import prepare
from campusgrid.llm.words import text_bytes

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")

_CUT = StructType([StructField(name, LongType()) for name in ("n", "first", "second")])


def line_ends(column: pa.Array) -> list[np.ndarray]:
    """Per text the offsets in code points after every line; the last line needs no line feed."""
    data, offsets = text_bytes(column)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    feeds = np.flatnonzero(data == 0x0A) + 1
    at = np.searchsorted(feeds, offsets, side="right")
    out = []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        ends = feeds[at[i] : at[i + 1]]
        if b > a and (not len(ends) or ends[-1] != b):
            ends = np.append(ends, b)
        out.append(points[ends] - points[a])
    return out


@F.arrow_udf(BinaryType())
def _boundaries(texts: pa.Array) -> pa.Array:
    return pa.array([BoundarySet.of(ends).to_bytes() for ends in line_ends(texts)], pa.binary())


@F.arrow_udf(_CUT)
def _cuts(sets: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
    """Units, and the offsets after one % (n + 1) and other % (n + 1) units in order."""
    out = []
    for raw, a, b in zip(sets.to_pylist(), one.to_pylist(), other.to_pylist()):
        ends = BoundarySet.from_bytes(raw)
        n = len(ends)
        places = sorted((a % (n + 1), b % (n + 1)))
        first, second = (ends.select(p - 1) if p else 0 for p in places)
        out.append((n, first, second))
    columns = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3
    return pa.StructArray.from_arrays(columns, names=["n", "first", "second"])


def boundary_sets(docs: DataFrame, text_column: str = "text", name: str = "boundaries") -> DataFrame:
    """``docs`` with the line ends of every text as a compressed set; a null text counts as empty. The set can be stored
    and used for any number of seeds."""
    prepare(docs.sparkSession)
    return docs.withColumn(name, _boundaries(F.coalesce(F.col(f"`{text_column}`"), F.lit(""))))


def _usable(marks: Sequence[str]) -> None:
    """A mark must not occur across the edge of a text and a mark, or it could be found in the wrong place."""
    for a in marks:
        for b in marks:
            if not a or any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)))) or (a is not b and a in b):
                raise ValueError(f"marks {a!r} and {b!r} can overlap")


def _number(digest: Column, group: int) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame, *, seed: int = 7, rate: int = 100, spm: int = 50, marks: Sequence[str] = MARKS,
    id_column: str = "doc_id", text_column: str = "text", boundaries: str | None = None,
) -> DataFrame:
    """Per document: ``row`` (its columns), ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` (code points; null
    if plain) and ``output``.

    Lines end after a line feed or with the text. Four numbers come from the SHA-256 of "seed:id": two give the lines
    after which prefix and middle end, the third leaves 100 - ``rate`` percent of the texts plain, the fourth puts
    ``spm`` percent of the others into the form suffix-prefix-middle, the rest into prefix-suffix-middle. Empty and null
    texts (null counts as empty) and texts that contain a mark stay plain. A null id hashes as the empty text, rows with
    one id are cut by the same numbers. Repeated rows and extra columns of any name are kept (inside ``row``); no rows
    give none.

    ``boundaries``: the name of a column of ``docs`` made by ``boundary_sets``; else the sets are made here."""
    _usable(marks)
    prepare(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != boundaries])
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    sets = F.col(f"`{boundaries}`") if boundaries else _boundaries(text)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))), 256)
    named = docs.select(row.alias("row"), text.alias("text"), sets.alias("sets"), digest.alias("digest"))
    cut = named.select("row", "text", "digest", _cuts("sets", _number(F.col("digest"), 0), _number(F.col("digest"), 1)).alias("cut"))
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains("text", F.lit(mark))
    form = (
        F.when((F.col("text") == "") | marked | (_number(F.col("digest"), 2) % 100 >= rate), "plain")
        .when(_number(F.col("digest"), 3) % 100 < spm, "spm")
        .otherwise("psm")
    )
    cut = cut.select(
        "row", "text", form.alias("form"), F.col("cut.n").alias("n"), F.col("cut.first").cast("int").alias("a"),
        F.col("cut.second").cast("int").alias("b"),
    )
    before, after, between = map(F.lit, marks)
    part = lambda a, b: F.substr(F.col("text"), F.lit(1) + a, b - a)
    zero, a, b = F.lit(0), F.col("a"), F.col("b")
    prefix, middle, suffix = part(zero, a), part(a, b), F.substr(F.col("text"), F.lit(1) + b)
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(before, prefix, after, suffix, between, middle))
        .otherwise(F.concat(after, suffix, before, prefix, between, middle))
    )
    chars = lambda size: F.when(F.col("form") != "plain", size.cast("bigint"))
    return cut.select(
        "row", "n", "form", chars(a).alias("prefix_chars"), chars(b - a).alias("middle_chars"), output.alias("output")
    )


def restore(made: DataFrame, marks: Sequence[str] = MARKS) -> DataFrame:
    """``made`` with ``restored``, the text as it was, from ``form`` and ``output`` alone."""
    before, after, between = marks
    output = F.col("output")

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What follows each of the three marks of the output."""
        rest = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, between, 1)
        return one, two, F.substr(rest, F.length(two) + len(between) + 1)

    prefix, suffix, middle = parts(before, after)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(after, before)
    spm = F.concat(prefix, middle, suffix)
    form = F.col("form")
    return made.withColumn("restored", F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output))
