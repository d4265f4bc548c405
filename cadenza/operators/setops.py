"""Set-style operators: union of differently shaped inputs, flattening, splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union-all by column name; a column missing on one side is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def flatten_nested(df: DataFrame, col: str, alias: str) -> DataFrame:
    """Array of arrays -> one row per inner element."""
    return df.withColumn(alias, F.explode(F.flatten(F.col(col))))


def split_dim_fact(df: DataFrame, key: str, dim_cols, fact_cols,
                   stamp=None, stamp_name: str = "date"):
    """U4: one row set -> (dimension, fact) projections sharing ``key``. Rows
    without a key are dropped first (P15). Both outputs are lazy projections
    of the same input; persist it when both are written."""
    base = df.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    dim = base.select(key, *dim_cols)
    fact = base.select(key, *fact_cols)
    if stamp is not None:
        fact = fact.withColumn(stamp_name, stamp)
    return dim, fact
