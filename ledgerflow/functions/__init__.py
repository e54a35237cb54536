"""Scalar column functions (JSON, parsing, names, text rewrite, messages)."""

from ledgerflow.functions.scalars import (  # noqa: F401
    day_of,
    fits_money,
    json_field,
    json_fields,
    literal_like,
    lower_stripped,
    message,
    minus_hours,
    money_sum,
    replace_first_per_line,
    row_to_json,
    split_name,
    string_array,
    strip,
    to_double,
    to_instant,
    to_int,
    to_money,
    upper_stripped,
)
