"""Aggregations: distinct ids, dedupe, value counts, group statistics, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.scalars import present_id


def distinct_ids(df: DataFrame, col: str, alias: str | None = None,
                 as_text: bool = True) -> DataFrame:
    """A1 + P11: distinct values of ``col`` without nulls or empty text
    (partial + final hash aggregate, so hot values are combined map-side)."""
    c = F.col(col).cast("string") if as_text else F.col(col)
    return (df.select(c.alias(alias or col))
            .filter(present_id(alias or col))
            .distinct())


def first_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """A2: one row per ``key``, the one with the smallest ``order_col`` (ties
    broken by the remaining columns). Written as an aggregate of
    ``min(struct(order_col, ...))`` so that a hot key is reduced map-side
    instead of sorted whole in one task."""
    rest = [c for c in df.columns if c not in (key, order_col)]
    packed = F.struct(F.col(order_col), *[F.col(c) for c in rest])
    return (df.groupBy(key).agg(F.min(packed).alias("_first"))
            .select(F.col("_first." + order_col).alias(order_col), key,
                    *[F.col("_first." + c).alias(c) for c in rest])
            .select(*df.columns))


def value_counts(df: DataFrame, col: str, names=("value", "count")) -> DataFrame:
    """A3 + P3: counts per non-null value, largest first (ties by value)."""
    value_name, count_name = names
    return (df.filter(F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
            .toDF(value_name, count_name)
            .orderBy(F.col(count_name).desc(), F.col(value_name)))


def group_means(df: DataFrame, group: str, features, exclude=()) -> DataFrame:
    """A4 + P17: mean of each feature per group, excluded groups removed."""
    if exclude:
        df = df.filter(~F.col(group).isin(list(exclude)))
    return df.groupBy(group).agg(*[F.avg(f).alias(f) for f in features])


def group_bounds(df: DataFrame, group: str, features) -> DataFrame:
    """A5: per-group min and max of every feature in one aggregate."""
    aggs = []
    for f in features:
        aggs += [F.min(f).alias(f"min_{f}"), F.max(f).alias(f"max_{f}")]
    return df.groupBy(group).agg(*aggs)


def with_global_bounds(df: DataFrame, source: DataFrame, feature: str) -> DataFrame:
    """Attach the global min / max of ``feature`` (scalar subqueries, computed
    once and inlined; no join)."""
    both = source.select(F.struct(F.min(feature).alias("lo"),
                                  F.max(feature).alias("hi"))).scalar()
    return (df.withColumn("_g", both)
            .withColumn(f"all_min_{feature}", F.col("_g.lo"))
            .withColumn(f"all_max_{feature}", F.col("_g.hi")).drop("_g"))


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """Number of rows as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def unique_rows(df: DataFrame, keys=None) -> DataFrame:
    """Unique rows (or one row per key)."""
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def exactly_one(df: DataFrame, what: str = "row"):
    """The single row of ``df``; ValueError if there are none or several.
    Reads at most two rows."""
    rows = df.limit(2).collect()
    if not rows:
        raise ValueError(f"no {what} found")
    if len(rows) > 1:
        raise ValueError(f"several {what}s found")
    return rows[0]


def match_status(keys: DataFrame, key: str, df: DataFrame, df_key: str) -> DataFrame:
    """A13 for many keys at once: how many rows of ``df`` each key matches, as
    ``none``, ``one`` or ``several``. ``df`` is counted per key first (partial
    aggregation), so a hot key is one row in the join."""
    counts = (df.filter(F.col(df_key).isNotNull()).groupBy(F.col(df_key).alias("_k"))
              .agg(F.count(F.lit(1)).alias("_n")))
    status = (F.when(F.col("_n").isNull(), "none").when(F.col("_n") == 1, "one")
              .otherwise("several"))
    return (keys.join(counts, keys[key] == counts["_k"], "left")
            .withColumn("status", status).drop("_k", "_n"))


def is_empty(df: DataFrame) -> bool:
    """Emptiness test (reads at most one row)."""
    return df.isEmpty()
