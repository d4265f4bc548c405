"""Column profiles: ``describe``-style numeric summary and type / non-null info.

Quartiles are exact with linear interpolation (the pandas / ``quantile_cont``
definition). Spark's ``percentile`` keeps a value->count map per group in one
task, which grows with the number of distinct values; here the distinct values
get global running counts (see :mod:`cadenza.operators.numbering`) and the few
ranks needed are picked by a join with a small table of target positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators.numbering import global_cumsum

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame):
    """P10: names of numeric columns (schema inspection only)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def long_values(df: DataFrame, cols) -> DataFrame:
    """(column, value) pairs of the non-null values of ``cols`` as double."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.col(c).cast("double").alias("value")) for c in cols])
    return (df.select(F.explode(pairs).alias("_kv")).select("_kv.*")
            .filter(F.col("value").isNotNull()))


def _weighted_values(df: DataFrame, cols) -> DataFrame:
    """(column, value, _w): each distinct non-null value with its count.
    Repeated values collapse map-side, so a value holding a large share of the
    rows costs one row."""
    return long_values(df, cols).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("_w"))


def _ranked_values(df: DataFrame, cols) -> DataFrame:
    """Distinct values with global running counts, pinned by a checkpoint:
    one pass over ``df``, every later step reads the checkpoint."""
    return global_cumsum(_weighted_values(df, cols), ["column", "value"], "_w",
                         name="_cum")


def _quantiles_from_ranked(ranked: DataFrame, probs) -> DataFrame:
    spark = ranked.sparkSession
    # One row per column: where its ranks start and end in the global order.
    spans = (ranked.groupBy("column")
             .agg(F.min(F.col("_cum") - F.col("_w")).alias("before"),
                  F.max("_cum").alias("last")).collect())
    targets = []
    for r in spans:
        n = r["last"] - r["before"]
        for p in probs:
            h = float(p) * (n - 1)
            lo = int(h // 1)
            hi = lo if h == lo else lo + 1
            targets.append((r["column"], float(p), r["before"] + 1 + lo,
                            r["before"] + 1 + hi, h - lo))
    target_df = spark.createDataFrame(
        targets, "column string, p double, lo long, hi long, frac double")
    wanted = spark.createDataFrame(
        sorted({(c, x) for c, _, lo, hi, _ in targets for x in (lo, hi)}),
        "_c string, rank long")
    # Each distinct value covers ranks (cum - w, cum]; the target table is tiny
    # (columns x probabilities x 2) and is broadcast.
    hit = ((ranked["column"] == wanted["_c"]) & (wanted["rank"] > ranked["_cum"] - ranked["_w"])
           & (wanted["rank"] <= ranked["_cum"]))
    picked = ranked.join(F.broadcast(wanted), hit).select("rank", "value")
    lo = picked.withColumnRenamed("rank", "lo").withColumnRenamed("value", "v_lo")
    hi = picked.withColumnRenamed("rank", "hi").withColumnRenamed("value", "v_hi")
    return (F.broadcast(target_df).join(lo, "lo").join(hi, "hi")
            .select("column", "p",
                    (F.col("v_lo") + F.col("frac") * (F.col("v_hi") - F.col("v_lo")))
                    .alias("q")))


def exact_quantiles(df: DataFrame, cols, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Per column and probability, the linearly interpolated quantile.
    Returns (column, p, q).

    Distinct values with their counts get global running counts, which give
    each value its range of ranks; the two ranks around each target are looked
    up with a join against a table of at most columns x probabilities x 2
    rows."""
    return _quantiles_from_ranked(_ranked_values(df, cols), probs)


def describe_numeric(df: DataFrame, cols=None) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max for each numeric
    column; one row per column. The input is read once: every statistic comes
    from the pinned table of distinct values and counts."""
    cols = list(cols or numeric_columns(df))
    ranked = _ranked_values(df, cols)
    sums = ranked.groupBy("column").agg(
        F.sum("_w").alias("count"),
        (F.sum(F.col("value") * F.col("_w")) / F.sum("_w")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    spread = (ranked.join(F.broadcast(sums.select("column", "mean", "count")), "column")
              .groupBy("column").agg(
                  F.sqrt(F.sum(F.col("_w") * (F.col("value") - F.col("mean")) *
                               (F.col("value") - F.col("mean"))) /
                         (F.first("count") - 1)).alias("std")))
    quant = (_quantiles_from_ranked(ranked, (0.25, 0.5, 0.75)).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(name)
          for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]))
    # Every requested column gets a row, also one without any value (count 0).
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return (names.join(sums, "column", "left").join(spread, "column", "left")
            .join(quant, "column", "left")
            .select("column", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
                    "mean", F.when(F.col("count") > 1, F.col("std")).alias("std"),
                    "min", "p25", "p50", "p75", "max"))


def column_profile(df: DataFrame) -> DataFrame:
    """A9 + A7: per column its type and non-null count, plus the row count;
    all counts from one aggregate pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(df.columns)])
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                                 F.lit(t).alias("dtype"), F.col(f"_nn{i}").alias("non_null"))
                        for i, (c, t) in enumerate(df.dtypes)])
    return (counts.select(F.explode(entries).alias("_e"), F.col("_rows").alias("rows"))
            .select("_e.position", "_e.column", "_e.dtype", "_e.non_null", "rows"))


def describe_text(df: DataFrame, cols=None) -> DataFrame:
    """A8 for text columns (what ``describe`` reports when no column is
    numeric): non-null count, number of distinct values, the most frequent
    value (ties: the smallest) and its frequency; one row per column. Values
    are counted per (column, value) with map-side partial aggregation, then
    reduced per column, so no column is collected into one task."""
    cols = list(cols or [f.name for f in df.schema.fields
                         if isinstance(f.dataType, T.StringType)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
                      for c in cols])
    counted = (df.select(F.explode(pairs).alias("_kv")).select("_kv.*")
               .filter(F.col("value").isNotNull())
               .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    return (counted.groupBy("column")
            .agg(F.sum("n").cast("long").alias("count"),
                 F.count(F.lit(1)).cast("long").alias("unique"), best.alias("_b"))
            .select("column", "count", "unique", F.col("_b.value").alias("top"),
                    (-F.col("_b.neg")).cast("long").alias("freq")))

