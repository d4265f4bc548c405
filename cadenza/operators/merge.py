"""Matched-only MERGE: ``MERGE dim USING src ON key WHEN MATCHED THEN UPDATE``.

Parquet tables have no row-level MERGE in Spark, so the merge is a left join of
the target with the source plus a match flag; the result takes the place of the
table (see :func:`merge_into_path`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.sources.sinks import write_full_refresh


def merge_matched(target: DataFrame, source: DataFrame, key: str, updates: dict,
                  check_source_unique: bool = True) -> DataFrame:
    """Every target row is kept; rows whose key matches a source row get
    ``target_col = source_col`` for each pair in ``updates`` (a null source
    value writes null). Unmatched rows on either side are untouched / ignored.
    Target columns that do not exist yet are added as typed nulls.

    Several source rows matching one target row is an error, as in SQL MERGE;
    the check costs one aggregate of the source keys (skip it when the source
    is already unique on ``key``, e.g. the output of a group-by on it)."""
    if check_source_unique:
        dupes = (source.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                 .filter(F.col("_n") > 1).select(key)
                 .join(target.select(key), key, "left_semi"))
        if not dupes.isEmpty():
            raise ValueError(f"MERGE source has several rows for a matched {key}")
    src = source.select(F.col(key).alias("_mk"), F.lit(True).alias("_hit"),
                        *[F.col(s).alias(f"_u_{t}") for t, s in updates.items()])
    joined = target.join(src, target[key] == src["_mk"], "left")
    src_types = dict(source.dtypes)
    out_cols = []
    for c in target.columns:
        if c in updates:
            out_cols.append(F.when(F.col("_hit"), F.col(f"_u_{c}"))
                            .otherwise(target[c]).alias(c))
        else:
            out_cols.append(target[c])
    for t, s in updates.items():
        if t not in target.columns:
            out_cols.append(F.when(F.col("_hit"), F.col(f"_u_{t}"))
                            .otherwise(F.lit(None).cast(src_types[s])).alias(t))
    return joined.select(*out_cols)


def merge_into_path(target: DataFrame, source: DataFrame, key: str, updates: dict,
                    out_path: str, **kw) -> DataFrame:
    """J2 + K1: write the merged table to ``out_path`` and return it. The path may be that
    of ``target`` itself: the merge is staged first and then takes the table's place, so
    the table's readers see the updated rows."""
    merged = merge_matched(target, source, key, updates, **kw)
    write_full_refresh(merged, out_path)
    return merged.sparkSession.read.parquet(out_path)
