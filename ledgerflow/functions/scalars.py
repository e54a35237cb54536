"""Column -> Column helpers.

All of them are compositions of built-in expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.schemas import MONEY

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- X1: JSON field as text -------------------------------------------------

def json_field(c: ColumnOrName, key: str) -> Column:
    """``metadata->>'key'``: text of a top-level JSON field, NULL when absent or null.

    The key is a name, never a path: ``a.b`` means the field called ``a.b``.
    """
    return json_fields(c, [key])[0]


def json_fields(c: ColumnOrName, keys: Sequence[str]) -> list[Column]:
    """Several text fields parsed with one ``from_json`` per row (not one parse per key)."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    parsed = F.from_json(_col(c), schema)
    return [parsed.getField(k).alias(k) for k in keys]


def variant(c: ColumnOrName) -> Column:
    """JSON text parsed once into a ``VARIANT``; NULL for text that is no JSON."""
    return F.try_parse_json(_col(c))


def variant_text(v: Column, path: str) -> Column:
    """``v #>> path`` for a parsed document: scalars as text, nested values as normalised JSON text.

    Normal form: members sorted by name, no spaces, numbers without trailing zeros;
    so equal documents give equal text however they were written. JSON null and a
    missing member are NULL. ``path`` is a JSON path such as ``$.nested.type``.
    """
    return F.try_variant_get(v, path, "string")


def variant_value(v: Column, path: str, type_name: str) -> Column:
    """A member as a typed value; NULL where it is missing or does not fit the type."""
    return F.try_variant_get(v, path, type_name)


# --- X2: row to JSON ----------------------------------------------------------

def row_to_json(columns: Sequence[str], **more: Column) -> Column:
    """JSON object of the given columns (and of further named members), keeping NULLs as JSON null."""
    members = [F.col(c) for c in columns] + [c.alias(name) for name, c in more.items()]
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


# --- X3: array literal --------------------------------------------------------

def string_array(values: Iterable[str]) -> Column:
    vals = list(values)
    if not vals:
        return F.array().cast(T.ArrayType(T.StringType()))
    return F.array(*[F.lit(v) for v in vals])


# --- X5 / X6: whitespace and case ----------------------------------------------

# Fixed value: the characters that Python's str.strip() and str.split() take as
# whitespace.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: ColumnOrName) -> Column:
    """``str.strip()``: removes leading/trailing whitespace of any kind (plain
    ``trim`` only removes spaces). ``btrim`` with a character set, no regular
    expression."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def upper_stripped(c: ColumnOrName) -> Column:
    return F.upper(strip(c))


def lower_stripped(c: ColumnOrName) -> Column:
    return F.lower(strip(c))


# --- X7 / X8 / X9 / K5: tolerant parsing ---------------------------------------

# Fixed value: the shape of a plain decimal number (optionally signed, with an
# optional exponent) that Python's float() accepts; Spark's cast would also take
# suffixes such as "2500d".
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_int(c: ColumnOrName) -> Column:
    """``int(text)``: surrounding whitespace allowed, fractions and overflow give NULL."""
    return _try_cast(strip(c), "int")


def to_double(c: ColumnOrName) -> Column:
    """``float(text)`` restricted to plain numbers; anything else gives NULL."""
    s = strip(c)
    return F.when(s.rlike(NUMBER_PATTERN), _try_cast(s, "double"))


# Fixed value: the shape of an ISO date or date and time with optional offset.
# Spark's cast would also take a bare time (as today) or a bare year.
TIMESTAMP_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?(:\d{2})?)?)?$"
)


def to_instant(c: ColumnOrName, ts_type: str = "timestamp") -> Column:
    """ISO-8601 text (offset honoured) to a timestamp; NULL when it is none."""
    s = strip(c)
    return F.when(s.rlike(TIMESTAMP_PATTERN), _try_cast(s, ts_type))


def to_money(c: ColumnOrName) -> Column:
    """Round HALF_UP to ``DECIMAL(12,2)``; NULL when the value does not fit."""
    return _try_cast(_col(c), "decimal(12,2)")


def fits_money(c: ColumnOrName) -> Column:
    """K5: the value is representable as ``NUMERIC(12,2)``."""
    col = _col(c)
    return col.isNull() | to_money(col).isNotNull()


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def cents(c: ColumnOrName) -> Column:
    """Money as a whole number of cents (``BIGINT``), rounded HALF_UP like
    ``NUMERIC(12,2)``. Sums of cents are exact and add primitive longs, where
    a ``DECIMAL(22,2)`` sum buffer would use big-decimal arithmetic; under
    ANSI an overflow raises instead of wrapping."""
    return (_col(c).cast(MONEY) * F.lit(100)).cast("bigint")


def cents_to_money(total_cents: Column) -> Column:
    """A sum of cents back to money, exactly (``DECIMAL(22,2)``)."""
    return (total_cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)")


def money_sum(c: ColumnOrName) -> Column:
    """Exact sum of money values (``DECIMAL(22,2)``).

    Integer addition is associative, so the value does not depend on
    partitioning or the order in which partial aggregates are merged.
    """
    return cents_to_money(F.sum(cents(c)))


# --- X11 / X12 / X13: time ----------------------------------------------------

def day_of(c: ColumnOrName) -> Column:
    """``DATE(ts)`` in the session time zone (pinned to UTC)."""
    return F.to_date(_col(c))


def minus_hours(c: ColumnOrName, hours: int) -> Column:
    return _col(c) - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(hours))


def literal_like(value, dtype: T.DataType) -> Column:
    """A literal cast to a column's own type (e.g. TIMESTAMP_NTZ), folded by Catalyst."""
    return F.lit(value).cast(dtype)


# --- X15: split a full name ---------------------------------------------------

# Fixed value: placeholder for a missing name part.
UNKNOWN = "Unknown"


def split_name(c: ColumnOrName) -> tuple[Column, Column]:
    """First whitespace-separated token, and the rest joined by single spaces.

    One token gives ``(token, 'Unknown')``; no token (blank or NULL) gives
    ``('Unknown', 'Unknown')``.
    """
    cleaned = strip(c)
    parts = F.when(cleaned.isNull() | (cleaned == ""), F.array().cast("array<string>")).otherwise(
        F.split(cleaned, f"[{WHITESPACE}]+")
    )
    n = F.size(parts)
    first = F.when(n >= 1, F.element_at(parts, 1)).otherwise(F.lit(UNKNOWN))
    rest = F.when(n >= 2, F.array_join(F.slice(parts, 2, n), " ")).otherwise(F.lit(UNKNOWN))
    return first, rest


# --- X16: first match per line ------------------------------------------------

def replace_first_per_line(c: ColumnOrName, literal: str, replacement: str) -> Column:
    """``sed 's/lit/rep/'`` on every ``\\n``-separated line of a text.

    ``(?m)`` anchors ``^`` at each line start, ``(?d)`` makes ``\\n`` the only
    line terminator (as for sed), and the lazy prefix stops at the first match.
    """
    import re

    pattern = r"(?md)^([^\n]*?)" + re.escape(literal)
    return F.regexp_replace(_col(c), pattern, "$1" + replacement.replace("$", r"\$"))


# --- X17 / X18: messages and conditions ---------------------------------------

def message(template: str, *cols: ColumnOrName) -> Column:
    """``format_string`` over columns, e.g. ``message('unsupported currency: %s', c)``."""
    return F.format_string(template, *[_col(x) for x in cols])
