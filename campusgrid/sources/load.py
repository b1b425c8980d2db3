"""Load tables of unknown format: each file is recognised by its first bytes and routed."""

from __future__ import annotations

import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.relational import concat_rows
from ..session import ship_package
from .archive import MEMBER_PRIORITY, read_members
from .dbf import is_dbf, read_dbf
from .delimited import read_delimited
from .files import conform_to, list_files, open_input
from .xlsx import read_xlsx

# Leading bytes of old binary workbooks and of zip archives.
_OLE_MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
_ZIP_MAGIC = (b"PK\x03\x04", b"PK\x05\x06")


def recognise(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, kind, member, listing). Kinds: xlsx, xls, dbf, text, or zip-<extension>; a zip
    without a table has the kind zip-none. Reads leading bytes and archive directories only."""
    ship_package(spark)

    def look(name: str) -> tuple[str, str | None, str | None]:
        with open_input(name) as stream:
            lead = stream.read(32)
            if lead[:8] == _OLE_MAGIC:
                return "xls", None, None
            if lead[:4] in _ZIP_MAGIC:
                with zipfile.ZipFile(stream) as box:
                    members = box.namelist()
                if "xl/workbook.xml" in members:
                    return "xlsx", None, None
                for extension in MEMBER_PRIORITY:
                    hits = [m for m in members if m.lower().endswith("." + extension)]
                    if hits:
                        return f"zip-{extension}", hits[0], None
                return "zip-none", None, ", ".join(members)
            length = stream.seek(0, 2)
        return ("dbf" if is_dbf(lead, length) else "text"), None, None

    def kinds(batches):
        for batch in batches:
            yield pd.DataFrame(
                [(name, *look(name)) for name in batch["path"]], columns=["path", "kind", "member", "listing"]
            )

    return list_files(spark, path).mapInPandas(kinds, "path string, kind string, member string, listing string")


def load_any(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: StructType | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """One frame from files of mixed formats: archives (dbf, then xlsx, then csv inside),
    workbooks, dBASE tables and delimited text. ``order_col`` adds the load order of each
    file and is only available when all files are of one kind."""
    routes: dict[str, list[tuple[str, str | None]]] = {}
    for row in recognise(spark, path).orderBy("path").toLocalIterator():
        if row.kind == "zip-none":
            raise ValueError(f"{row.path}: no dbf, xlsx, xls or csv in the archive; it holds: {row.listing}")
        if row.kind in ("xls", "zip-xls"):
            raise ValueError(f"{row.path}: legacy .xls workbooks are not supported; save them as .xlsx")
        routes.setdefault(row.kind, []).append((row.path, row.member))
    if not routes:
        raise FileNotFoundError(f"no files at {path}")
    if order_col and len(routes) > 1:
        raise ValueError(f"load order needs files of one kind, found {sorted(routes)}")
    frames = []
    for kind, files in routes.items():
        paths = [p for p, _ in files]
        if kind == "text":
            frames.append(read_delimited(spark, paths, schema=schema, order_col=order_col))
        elif kind == "xlsx":
            frames.append(read_xlsx(spark, paths, schema=schema, order_col=order_col))
        elif kind == "dbf":
            table = read_dbf(spark, paths, columns=[f.name for f in schema] if schema else None, order_col=order_col)
            frames.append(conform_to(table, schema, (order_col,) if order_col else ()))
        else:
            frames.append(read_members(spark, files, schema=schema, order_col=order_col))
    return concat_rows(frames)
