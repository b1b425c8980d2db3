"""Files in the source formats, written by hand: their bytes, and tables written as such files by Spark tasks."""

from __future__ import annotations

import io
import struct
import sys
import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campusgrid.session import work_path


#: Rows of a file, on average: what a task holds and encodes at a time.
FILE_ROWS = 100_000


def write_as(df: DataFrame, name: str, suffix: str, encode: Callable[[pd.DataFrame], bytes], files: int = 4) -> str:
    """Write the rows as ``files`` files, more if these were larger than FILE_ROWS, each encoded by the task that holds
    its rows; returns the folder."""
    files = max(files, -(-df.count() // FILE_ROWS))
    folder = work_path(df.sparkSession, name)
    for module in {__name__, encode.__module__}:  # tasks get these functions by value: no worker has this folder on its path
        cloudpickle.register_pickle_by_value(sys.modules[module])

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        path = f"{root}/{rows['_file'].iloc[0]}{suffix}"
        with store.open_output_stream(path) as out:
            out.write(encode(rows.drop(columns="_file")))
        return pd.DataFrame({"path": [path]})

    numbered = df.withColumn("_file", F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    numbered.groupBy("_file").applyInPandas(write, "path string").collect()
    return folder


def texts(row):
    """Values as dBASE texts: blank if there is none, whole numbers without a fraction (a null makes them floats in pandas)."""
    return ["" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v.is_integer() else str(v) for v in row]


def dbf_bytes(fields, records, encoding="latin-1"):
    """fields: (name, type, width, decimals); records: (deleted, raw texts or bytes)."""
    size = 1 + sum(f[2] for f in fields)
    head = struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(records), 32 + 32 * len(fields) + 1, size)
    for name, kind, width, decimals in fields:
        head += struct.pack("<11sc4xBB14x", name.encode(encoding), kind.encode(), width, decimals)
    body = []
    for deleted, values in records:
        body.append(b"*" if deleted else b" ")
        for (_, kind, width, _), value in zip(fields, values):
            raw = value if isinstance(value, bytes) else value.encode(encoding)
            body.append(raw.rjust(width) if kind in "NF" else raw.ljust(width))
    return b"".join([head, b"\r", *body, b"\x1a"])


def _reference(column, row):
    name = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        name = chr(65 + rest) + name
    return f"{name}{row}"


def xlsx_bytes(table, *, sheet="xl/worksheets/sheet1.xml", inline=False, styles=None, kinds=None):
    """First row is the header; None leaves the cell out; numbers and texts as they are. ``styles`` and ``kinds``
    give style numbers (1: a date, 2: an own format with time) and cell types by (row, column)."""
    strings, lines = {}, []
    for r, row in enumerate(table, 1):
        cells = []
        for c, value in enumerate(row):
            ref = _reference(c, r)
            if value is None:
                continue
            if isinstance(value, (int, float)):
                extra = f' s="{styles[r - 1, c]}"' if styles and (r - 1, c) in styles else ""
                extra += f' t="{kinds[r - 1, c]}"' if kinds and (r - 1, c) in kinds else ""
                cells.append(f'<c r="{ref}"{extra}><v>{value}</v></c>')
            elif inline:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>')
            else:
                cells.append(f'<c r="{ref}" t="s"><v>{strings.setdefault(value, len(strings))}</v></c>')
        lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    link = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as box:
        box.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{link}"><sheets><sheet name="a" sheetId="1" r:id="rId7"/>'
            f'<sheet name="b" sheetId="2" r:id="rId8"/></sheets></workbook>',
        )
        target = sheet.removeprefix("xl/")
        box.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="rId8" Type="x" Target="worksheets/other.xml"/><Relationship Id="rId7" Type="x" Target="{target}"/></Relationships>',
        )
        box.writestr(sheet, f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        if styles:
            box.writestr(
                "xl/styles.xml",
                f'<styleSheet xmlns="{main}"><numFmts count="1"><numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd hh:mm"/></numFmts>'
                '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>',
            )
        box.writestr("xl/worksheets/other.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
        items = "".join(f"<si><r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r></si>" for s in strings)
        box.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
    return out.getvalue()


def zip_bytes(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as box:
        for name, data in members.items():
            box.writestr(name, data)
    return out.getvalue()
