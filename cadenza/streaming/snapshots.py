"""Incremental snapshot append as a Structured Streaming job.

New files in a landing folder are read with a fixed schema, stamped with their
ingestion day and appended to a day-partitioned parquet table. The checkpoint
records which files were consumed, so a rerun (or a restarted driver) appends
each file exactly once; ``availableNow`` processes the backlog and stops,
which is the streaming form of a daily batch.

Each micro-batch goes through the batch append
(:func:`cadenza.sources.sinks.append_day_partition`) with its number as key, so the
table is a plain partitioned folder: batch appends, several streams and expiry may share it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.sources.sinks import append_day_partition


def stream_day_snapshots(spark: SparkSession, source_path: str, schema: T.StructType,
                         out_path: str, checkpoint_path: str, day_expr=None,
                         date_col: str = "ingestion_date", fmt: str = "parquet",
                         file_glob: str | None = None,
                         max_files_per_trigger: int = 100) -> DataFrame:
    """Append the backlog and return the table. A batch that is repeated after a
    failure is appended once: its key is the stream's id, which Spark keeps in the checkpoint, and
    the batch number."""
    reader = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    stream = reader.load(source_path)
    day = day_expr if day_expr is not None else F.current_date()

    def append(batch: DataFrame, number: int) -> None:
        meta = batch.sparkSession.read.text(f"{checkpoint_path}/metadata").first()[0]
        append_day_partition(batch, out_path, date_col,
                             commit_key=(json.loads(meta)["id"], number))

    query = (stream.withColumn(date_col, day).writeStream
             .foreachBatch(append)
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()          # ends with the backlog, or raises the stream's error
    return spark.read.parquet(out_path)
