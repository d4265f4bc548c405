"""Exact nearest neighbours by squared L2 distance (brute force, like a flat
index). The statistics and the query vector are d numbers each; every row gets
its distance in Arrow batches (one matrix operation per batch), and
``orderBy().limit(k)`` becomes TakeOrderedAndProject (each task keeps k rows; no
full sort, no join)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.aggregates import exactly_one
from cadenza.operators.features import vector_stats


def _distances(id_col: str, vec: str, mean, std, query):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        m, s = np.array(mean), np.array(std)
        # float32 vectors, distances accumulated in double.
        scaled = lambda x: ((x - m) / s).astype(np.float32).astype(np.float64)
        q = scaled(np.array(query, dtype=np.float64))
        for batch in batches:
            flat = batch.column(vec).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            diff = scaled(flat.reshape(batch.num_rows, len(m))) - q
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array((diff * diff).sum(axis=1))],
                                             names=[id_col, "distance"])
    return run


def nearest(df: DataFrame, id_col: str, vec: str, query_id, k: int = 10,
            scale: bool = True, include_self: bool = True,
            digits: int | None = 4) -> DataFrame:
    """J7 + O2 + J9: the ``k`` rows closest to the row ``query_id`` (itself
    included by default), ranked 1..k by (distance, id); ``digits`` only rounds
    the distance that is shown. The query id must match exactly one row (A13). Rows
    without a vector, or with one of another length, have no distance."""
    # Reads at most two rows: the check and the query vector in one scan.
    query = exactly_one(df.filter(F.col(id_col) == F.lit(query_id)).select(vec), "query row")[vec]
    rows = df.filter(F.size(vec) == len(query)).select(id_col, F.col(vec).alias("_vec"))
    mean, std = vector_stats(rows, "_vec") if scale else ([0.0] * len(query), [1.0] * len(query))
    kind = df.schema[id_col].dataType.simpleString()
    scored = rows.mapInArrow(_distances(id_col, "_vec", mean, std, list(query)),
                             f"`{id_col}` {kind}, distance double")
    if not include_self:
        scored = scored.filter(F.col(id_col) != F.lit(query_id))
    return ranked(scored, id_col, k, digits)


def ranked(scored: DataFrame, id_col: str, k: int, digits: int | None) -> DataFrame:
    """O2: the ``k`` rows with the smallest ``distance`` (ties by id), with their rank."""
    top = scored.orderBy("distance", id_col).limit(k)
    # The window runs over the k rows left after the limit.
    rank = F.row_number().over(Window.orderBy("distance", id_col)).cast("long").alias("rank")
    shown = F.col("distance") if digits is None else F.round("distance", digits)
    return top.select(rank, *[c for c in scored.columns if c != "distance"], shown.alias("distance"))
