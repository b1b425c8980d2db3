"""File sources and sinks."""

from .dbf import dbf_headers, read_dbf
from .delimited import file_encodings, file_headers, read_csv, read_delimited
from .load import load_any, recognise
from .sinks import bucket_count, write_bucketed, write_csv, write_parquet
from .xlsx import read_xlsx

__all__ = [
    "bucket_count",
    "dbf_headers",
    "file_encodings",
    "file_headers",
    "load_any",
    "read_csv",
    "read_dbf",
    "read_delimited",
    "read_xlsx",
    "recognise",
    "write_bucketed",
    "write_csv",
    "write_parquet",
]
