"""Global row numbers and running totals without a single-task window.

``row_number()`` over an un-partitioned window moves every row into one task.
Instead rows are range-partitioned on the order key and sorted inside each
partition; the position of each row inside its partition is computed in the
same pass and the result is pinned by a reliable checkpoint (a lost executor
then recomputes the same partitions from the checkpoint files, and the range
bounds of the shuffle are fixed once, so a recomputed map stage sends every
key to the same partition). Per-partition totals, one number per partition
as in ``zipWithIndex``, are collected and turned into offsets, which are
broadcast back as a small table. Later reads of the result are plain scans
of the checkpoint.

The order key should be (nearly) unique: range partitioning cannot split
equal keys, so heavy ties must be collapsed first (group them and carry a
weight, as :func:`global_cumsum` allows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.session import ensure_checkpoint_dir, ship_package


def _ranged(df: DataFrame, order_cols, num_partitions):
    ensure_checkpoint_dir(df.sparkSession)
    if num_partitions is None:
        # No fixed count: AQE may merge adjacent ranges to its advisory size,
        # which keeps the global order (merged partitions stay contiguous).
        ranged = df.repartitionByRange(*order_cols)
    else:
        ranged = df.repartitionByRange(num_partitions, *order_cols)
    return ranged.sortWithinPartitions(*order_cols)


def _with_offsets(pinned: DataFrame, total_expr, local_col: str, name: str) -> DataFrame:
    """Add ``name`` = offset of the row's partition + ``local_col``."""
    spark = pinned.sparkSession
    totals = sorted((r["_pid"], r["_t"] or 0) for r in
                    pinned.groupBy("_pid").agg(total_expr.alias("_t")).collect())
    offsets, running = [], 0
    for pid, total in totals:          # one entry per partition
        offsets.append((pid, running))
        running += int(total)
    table = spark.createDataFrame(offsets or [(0, 0)], "_pid long, _off long")
    return (pinned.join(F.broadcast(table), "_pid")
            .withColumn(name, F.col("_off") + F.col(local_col))
            .drop("_pid", local_col, "_off"))


def global_row_number(df: DataFrame, order_cols, name: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in the global order of ``order_cols``."""
    pid = F.spark_partition_id().cast("long")
    # monotonically_increasing_id = partition index << 33 | position.
    pinned = (_ranged(df, order_cols, num_partitions)
              .select("*", pid.alias("_pid"),
                      (F.monotonically_increasing_id() - F.shiftleft(pid, 33) + F.lit(1))
                      .alias("_pos"))
              .checkpoint(eager=True))
    return _with_offsets(pinned, F.count(F.lit(1)), "_pos", name)


def _running_sum(weight_col: str, out_col: str):
    """Per partition: running total of ``weight_col`` over its Arrow batches
    (in order), appended as ``out_col``; no pandas round trip."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        total = 0
        for batch in batches:
            weights = batch.column(batch.schema.get_field_index(weight_col)).cast(pa.int64())
            cum = pc.cumulative_sum(weights, start=total)
            if len(cum):
                total = cum[-1].as_py()
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [cum], names=list(batch.schema.names) + [out_col])
    return run


def global_cumsum(df: DataFrame, order_cols, weight_col: str, name: str = "cum",
                  num_partitions: int | None = None) -> DataFrame:
    """Running total of the integer ``weight_col`` in the global order of
    ``order_cols`` (inclusive of the row itself). The running sum inside each
    partition is one pass over its Arrow batches (``mapInArrow``)."""
    ship_package(df.sparkSession)
    tagged = _ranged(df, order_cols, num_partitions).withColumn(
        "_pid", F.spark_partition_id().cast("long"))
    schema = T.StructType(tagged.schema.fields + [T.StructField("_local", T.LongType())])
    pinned = tagged.mapInArrow(_running_sum(weight_col, "_local"), schema).checkpoint(eager=True)
    return _with_offsets(pinned, F.max("_local"), "_local", name)


def assign_batches(ids: DataFrame, id_col: str, batch_size: int,
                   name: str = "batch_id") -> DataFrame:
    """Split ordered ids into consecutive batches of ``batch_size``
    (batch = floor((rn - 1) / batch_size)); ``ids`` must be distinct."""
    numbered = global_row_number(ids, [id_col], name="_rn")
    return (numbered.withColumn(name, F.floor((F.col("_rn") - 1) / F.lit(batch_size)))
            .withColumn("position", F.col("_rn")).drop("_rn"))
