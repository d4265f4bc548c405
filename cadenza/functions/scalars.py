"""Scalar column expressions (all built-in Spark functions, no Python UDFs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "to_text", "to_float32_array", "lower_eq", "join_field",
    "join_strings", "array_or_empty", "with_default", "to_timestamp_coerced",
    "iso_date", "all_of", "present_id", "valid_length_id",
    "contains_ci", "tag",
]


def col_of(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def to_text(c) -> Column:
    """cast to STRING (ids are kept as text)."""
    return col_of(c).cast("string")


def to_float32_array(c) -> Column:
    """numeric array -> array<float>."""
    return col_of(c).cast("array<float>")


def lower_eq(c, value: str) -> Column:
    """case-insensitive equality."""
    return F.lower(col_of(c)) == F.lower(F.lit(value))


def join_field(array_col, field: str, sep: str = ",") -> Column:
    """array<struct> -> 'a,b,c' of one field; null or empty array -> null."""
    arr = col_of(array_col)
    return F.when(F.size(arr) > 0,
                  F.array_join(F.transform(arr, lambda e: e[field]), sep))


def join_strings(array_col, sep: str = ",") -> Column:
    """array<string> -> 'a,b'; a missing array gives the empty string."""
    return F.concat_ws(sep, col_of(array_col))


def array_or_empty(c, element_type: str = "string") -> Column:
    """Anything that is not a list becomes an empty list."""
    return F.coalesce(col_of(c), F.array().cast(f"array<{element_type}>"))


def with_default(c, default) -> Column:
    """default for a missing value."""
    return F.coalesce(col_of(c), F.lit(default))


def to_timestamp_coerced(c, numeric: bool | None = None) -> Column:
    """F8: value -> timestamp, unparsable values -> null. Numbers are read as
    epoch milliseconds, text with ``try_to_timestamp``."""
    c = col_of(c)
    if numeric:
        return F.timestamp_millis(c.try_cast("long"))
    return F.try_to_timestamp(c.cast("string"))


def iso_date(c) -> Column:
    """date -> 'yyyy-MM-dd'."""
    return F.date_format(col_of(c), "yyyy-MM-dd")


def all_of(*conditions: Column) -> Column:
    """conjunction of masks."""
    return reduce(lambda a, b: a & b, conditions)


def present_id(c) -> Column:
    """Id neither null nor empty text."""
    c = col_of(c)
    return c.isNotNull() & (c.cast("string") != F.lit(""))


def valid_length_id(c, length: int = 22) -> Column:
    """A text id of exactly ``length`` characters."""
    return F.coalesce(F.length(col_of(c)) == F.lit(length), F.lit(False))


def contains_ci(array_col, value: str) -> Column:
    """The array holds ``value`` ignoring case. A null array is null
    (the row is filtered out), like the SQL EXISTS over UNNEST of NULL."""
    target = F.lower(F.lit(value))
    return F.exists(col_of(array_col), lambda g: F.lower(g) == target)


def tag(value: str) -> Column:
    """P5: constant tag column."""
    return F.lit(value)
