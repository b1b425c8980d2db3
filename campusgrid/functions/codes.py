"""Column expressions for codes, labels and flags. All run inside the JVM."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_NON_ASCII = r"[^\x00-\x7F]"


def as_column(c: str | Column) -> Column:
    """A column by its exact name; names may hold spaces, dots, accents and signs."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def to_integer(c: str | Column) -> Column:
    """Whole number from integers, floats and their text forms; anything else gives null.

    The form is tested first, because a cast that fails costs an exception per row."""
    text = F.trim(as_column(c).cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]{1,18}$"), text.try_cast("bigint")).when(
        text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double").try_cast("bigint")
    )


def zero_pad_code(c: str | Column, width: int = 6) -> Column:
    """Numeric code as text, zero-padded to ``width`` but never cut. Null stays null.

    Accepts integers, floats and their text forms (``19641``, ``19641.0``, ``019641``)."""
    digits = to_integer(c).cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def ordinal_map(c: str | Column, levels: Mapping[str, int], *, ignore_case: bool = True) -> Column:
    """Label to number; a label that is not listed, or null, gives null."""
    value = as_column(c)
    if ignore_case:
        value = F.lower(value)
        levels = {label.lower(): n for label, n in levels.items()}
    pairs = [F.lit(part) for item in levels.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), value)


def flag_equals(c: str | Column, value: str = "1") -> Column:
    """1 where the column equals ``value``, else 0 (also for null)."""
    return F.coalesce((as_column(c).cast("string") == F.lit(value)).cast("int"), F.lit(0))


def flag_present(c: str | Column) -> Column:
    """1 where the column holds anything, else 0."""
    return as_column(c).isNotNull().cast("int")


def yes_no(c: str | Column, yes: str = "SI", no: str = "NO") -> Column:
    """1 for ``yes``, 0 for ``no``, null for anything else."""
    value = as_column(c)
    return F.when(value == yes, 1).when(value == no, 0)


@lru_cache(maxsize=1)
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """How each non-ASCII character reads once decomposed and cut down to ASCII:
    one-to-one pairs as two aligned strings, longer forms as a mapping."""
    single_from, single_to, longer = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        form = unicodedata.normalize("NFKD", ch)
        if form == ch:
            continue
        plain = "".join(p for p in form if ord(p) < 0x80)
        if len(plain) == 1:
            single_from.append(ch)
            single_to.append(plain)
        elif plain:
            longer[ch] = plain
    return "".join(single_from), "".join(single_to), longer


def clean_text(c: str | Column) -> Column:
    """Strip accents (compatibility decomposition), keep ASCII, trim, upper-case. Null stays null.

    Plain text passes through, accented text needs ``translate``, and the few characters that
    unfold into several letters are looked up one by one only in rows that hold one."""
    single_from, single_to, longer = _ascii_forms()
    text = as_column(c)
    value = F.translate(text, single_from, single_to)
    table = F.map_from_arrays(
        F.split(F.lit("".join(longer)), ""),
        F.split(F.lit("\u0001".join(longer.values())), "\u0001"),
    )
    unfolded = F.array_join(
        F.transform(F.split(value, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    has_longer = F.translate(text, "".join(longer), "") != text
    ascii_only = (
        F.when(~text.rlike(_NON_ASCII), text)
        .when(~has_longer, F.regexp_replace(value, _NON_ASCII, ""))
        .otherwise(F.regexp_replace(unfolded, _NON_ASCII, ""))
    )
    return F.upper(F.regexp_replace(ascii_only, r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
