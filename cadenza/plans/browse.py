"""Browse flow: genre choices, slider bounds per feature, filtered hit list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.features import range_filter


def slider_bounds(tracks: DataFrame, genre_col: str, genre: str, features,
                  global_default=()) -> DataFrame:
    """A5 + A6: per feature the limits of its slider (the genre's min and max)
    and its default range: the same limits, or the global min and max for the
    features in ``global_default`` (the reference does so for one feature).
    One aggregate pass; returns (feature, lo, hi, value_lo, value_hi)."""
    in_genre = F.col(genre_col) == F.lit(genre)
    aggs = []
    for i, f in enumerate(features):
        aggs += [F.min(F.when(in_genre, F.col(f))).alias(f"lo{i}"),
                 F.max(F.when(in_genre, F.col(f))).alias(f"hi{i}"),
                 F.min(f).alias(f"glo{i}"), F.max(f).alias(f"ghi{i}")]
    row = tracks.agg(*aggs)
    entries = []
    for i, f in enumerate(features):
        use_global = f in global_default
        entries.append(F.struct(
            F.lit(f).alias("feature"), F.col(f"lo{i}").cast("double").alias("lo"),
            F.col(f"hi{i}").cast("double").alias("hi"),
            F.col(f"glo{i}" if use_global else f"lo{i}").cast("double").alias("value_lo"),
            F.col(f"ghi{i}" if use_global else f"hi{i}").cast("double").alias("value_hi")))
    return row.select(F.explode(F.array(*entries)).alias("_b")).select("_b.*")


def browse(tracks: DataFrame, genre_col: str, genre: str, ranges: dict, display) -> DataFrame:
    """P18 + P16 + P8: tracks of ``genre`` whose features lie in ``ranges``
    (closed), with the display columns."""
    return range_filter(tracks, ranges, equals={genre_col: genre}).select(*display)
