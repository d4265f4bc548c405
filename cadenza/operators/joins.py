"""Joins: name join of two catalogues, dimension lookups, un-nesting, membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.scalars import col_of, contains_ci


#: Rows that stand for "no partner"; left rows without one are dealt over them.
PADS = 64


def left_join_balanced(left: DataFrame, right: DataFrame, left_key: str,
                       right_key: str | None = None) -> DataFrame:
    """Left outer equi-join that stays balanced when one key holds a large share
    of either side, and that evaluates ``left`` once.

    AQE splits a hot key of a left outer join only on the left side; of an
    inner join it splits either. So left rows are first marked by a left join with the distinct
    right keys (pre-aggregated in each task, one row per key), and the right side is
    completed by :data:`PADS` rows of nulls. The join proper is then an inner one: marked rows meet
    their partners, the others (null keys among them) one of the pad rows, dealt
    by their key. A chain of such joins reads every input a constant number of times. The
    plan is lazy and holds no statistics of the data, so it stays right when a table
    behind it changes. With the key named once on both sides (``right_key``
    omitted) the key column is kept once (USING form)."""
    same = right_key is None or right_key == left_key
    at = right.columns.index(left_key if same else right_key)
    # Positions for names: the two sides may share some.
    mine = [f"_l{i}" for i in range(len(left.columns))]
    theirs = [f"_r{i}" for i in range(len(right.columns))]
    key, rows = F.col(mine[left.columns.index(left_key)]), right.toDF(*theirs)
    rows = rows.filter(F.col(theirs[at]).isNotNull())
    known = rows.select(F.col(theirs[at]).alias("_hit")).distinct()
    marked = left.toDF(*mine).join(known, key == F.col("_hit"), "left").withColumn(
        "_pad", F.when(F.col("_hit").isNull(), F.pmod(F.xxhash64(key), F.lit(PADS))))
    kind = right.schema.fields[at].dataType
    pads = left.sparkSession.range(PADS).select(
        *[F.lit(None).cast(f.dataType).alias(c) for c, f in zip(theirs, right.schema.fields)],
        F.lit(None).cast(kind).alias("_key"), F.col("id").alias("_no"))
    complete = rows.select("*", F.col(theirs[at]).alias("_key"),
                           F.lit(None).cast("long").alias("_no")).union(pads)
    joined = marked.join(complete, F.col("_hit").eqNullSafe(F.col("_key"))
                         & F.col("_pad").eqNullSafe(F.col("_no")))
    own = list(zip(mine, left.columns))
    if same:
        own = [c for c in own if c[1] == left_key] + [c for c in own if c[1] != left_key]
    other = [c for k, c in enumerate(zip(theirs, right.columns)) if not (same and k == at)]
    return joined.select(*[F.col(c).alias(name) for c, name in own + other])


def left_join_on_name(left: DataFrame, right: DataFrame, left_key: str,
                      right_key: str) -> DataFrame:
    """Left outer equi-join on a name. Exact and case-sensitive; null names
    never match; a name present n times on the right repeats the left row n
    times. A name that is hot on either side is split by AQE (see
    :func:`left_join_balanced`)."""
    return left_join_balanced(left, right, left_key, right_key)


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str, dim_key: str,
                        value: str, alias: str, default: str = "Unknown",
                        zero_is_missing: bool = True) -> DataFrame:
    """Dimension lookup with a default. A key of 0 (when ``zero_is_missing``),
    a null key or a key absent from ``dim`` yields ``default``. ``dim`` must be
    unique on ``dim_key``. The planner broadcasts ``dim`` if its size in bytes is below
    the session's threshold (AQE: its size at run time); otherwise AQE splits a
    hot key, missing keys included, on the left side."""
    d = dim.select(F.col(dim_key).alias("_lk"), F.col(value).alias("_lv"))
    if zero_is_missing:
        d = d.filter(F.col("_lk") != 0)
    joined = df.join(d, df[key] == d["_lk"], "left")
    return joined.withColumn(alias, F.coalesce(F.col("_lv"), F.lit(default))).drop("_lk", "_lv")


def unnest(df: DataFrame, array_col: str, alias: str) -> DataFrame:
    """One row per array element (``FROM t, UNNEST(a)``). Empty and null
    arrays produce no row."""
    return df.withColumn(alias, F.explode(col_of(array_col)))


def with_member(df: DataFrame, array_col: str, value: str) -> DataFrame:
    """Keep rows whose array contains ``value`` ignoring case; one row
    per input row however many elements match."""
    return df.filter(contains_ci(array_col, value))
