"""Ordering operators: sorted choices, heads, first rows, date-ordered results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sorted_choices(df: DataFrame, col: str, where=None) -> DataFrame:
    """O1: sorted distinct non-null values, optionally inside a filter."""
    if where is not None:
        df = df.filter(where)
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def head(df: DataFrame, n: int, order_by) -> DataFrame:
    """First ``n`` rows in an explicit order (TakeOrderedAndProject)."""
    return df.orderBy(*order_by).limit(n)


def first_row(df: DataFrame, order_by, where=None) -> DataFrame:
    """First row of a selection by an explicit key."""
    if where is not None:
        df = df.filter(where)
    return df.orderBy(*order_by).limit(1)


def date_columns(df: DataFrame):
    """P10: names containing 'date' or 'day' (case-sensitive, as the reference)."""
    return [c for c in df.columns if "date" in c or "day" in c]


def sort_by_date(df: DataFrame, col: str | None = None) -> DataFrame:
    """Order a result by its (detected) date column."""
    col = col or next(iter(date_columns(df)), None)
    return df.orderBy(col) if col else df
