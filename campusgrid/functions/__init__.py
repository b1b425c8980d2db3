"""Column expressions used by the operators and plans."""

from .codes import (
    as_column,
    clean_text,
    flag_equals,
    flag_present,
    ordinal_map,
    to_integer,
    yes_no,
    zero_pad_code,
)
from .rowwise import (
    abs_error,
    category_interaction,
    hash_bucket,
    nan_to_null,
    number,
    present,
    product_interaction,
    row_mean,
    row_sum,
    safe_ratio,
)

__all__ = [
    "abs_error",
    "as_column",
    "category_interaction",
    "clean_text",
    "flag_equals",
    "flag_present",
    "hash_bucket",
    "nan_to_null",
    "number",
    "ordinal_map",
    "present",
    "product_interaction",
    "row_mean",
    "row_sum",
    "safe_ratio",
    "to_integer",
    "yes_no",
    "zero_pad_code",
]
