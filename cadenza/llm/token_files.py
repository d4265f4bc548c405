"""Token ids as flat binary files with 64-bit document offsets.

Documents are range-partitioned and sorted by id. Each task encodes its texts
(whole, plus the end id) and writes three files under one name:

* ``.bin``  ids side by side, unsigned 16-bit little-endian, or 32-bit if the
  tokenizer has more than 65,536 ids;
* ``.off``  64-bit offsets: where each document begins, and one entry more;
* ``.doc``  64-bit document ids (null as the smallest value).

Names are unique per task attempt, and the row that names a file reaches the
manifest (a Parquet table) only if Spark commits the attempt, so files of lost or
repeated attempts are never read. The base of a partition is the sum of the token
counts of the partitions before it (one number per partition).

Files go to the shared folder of ``spark.checkpoint.dir`` unless a path is given.
Readers map local files into memory; files of another store are read through
``pyarrow.fs``.

Defined cases: null text is empty and holds only the end id; rows with one id
are ordered by text; a null id sorts first; an empty table gives an empty
manifest. The id column must be an integer. Other columns are not read.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import textvec as tv
from cadenza.llm.tokens import binary_rows, encoder
from cadenza.session import ship_package, work_path

NULL_ID = -(1 << 63)
_MANIFEST = "part long, name string, n_docs long, n_tokens long, width int"


def local_path(path: str) -> str | None:
    """The path of a local (or locally mounted) file, None for another store."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return path if "://" not in path else None


def open_output(path: str):
    here = local_path(path)
    if here is not None:
        os.makedirs(os.path.dirname(here), exist_ok=True)
        return open(here, "wb")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(name)


def read_array(path: str, dtype: str) -> np.ndarray:
    here = local_path(path)
    if here is not None:
        if not os.path.getsize(here):
            return np.zeros(0, dtype=dtype)
        return np.memmap(here, dtype=dtype, mode="r")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def _write_task(folder: str, tokenizer: str, end_id: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc = encoder(tokenizer)
        width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 else 4
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:12]}"
        ends, docs, total, out = [np.zeros(1, np.int64)], [], 0, None
        for batch in batches:
            docs += [NULL_ID if x is None else x for x in batch.column("_id").to_pylist()]
            for _, texts in tv.slices(batch.column("_text")):
                out = out or open_output(name + ".bin")
                ids, bounds = enc.encode_with_end(texts, end_id)
                out.write(ids.astype(f"<u{width}").tobytes())
                ends.append(bounds[1:] + total)
                total += len(ids)
        if out is None:
            return
        out.close()
        for ext, values in ((".off", np.concatenate(ends)), (".doc", docs)):
            with open_output(name + ext) as f:
                f.write(np.array(values, dtype="<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([name]), pa.array([len(docs)], pa.int64()),
             pa.array([total], pa.int64()), pa.array([width], pa.int32())],
            names=["part", "name", "n_docs", "n_tokens", "width"])
    return run


def write_token_files(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
                      id_col: str = "doc_id", text_col: str = "text",
                      folder: str | None = None) -> str:
    """Write the files and their manifest; returns the folder."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or work_path(spark, "token-files")
    laid = (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
            .repartitionByRange("_id").sortWithinPartitions("_id", "_text"))
    laid.mapInArrow(_write_task(folder, tokenizer, end_id), _MANIFEST).write.parquet(
        f"{folder}/manifest")
    return folder


def _read_task(max_bytes: int = 4 << 20):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids = read_array(row["name"] + ".bin", f"<u{row['width']}")
                off = read_array(row["name"] + ".off", "<i8")
                docs = read_array(row["name"] + ".doc", "<i8")
                at = 0
                while at < len(docs):
                    to = int(np.searchsorted(off, off[at] + max_bytes // 4, "right")) - 1
                    to = min(max(to, at + 1), len(docs))
                    own = docs[at:to]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if x == NULL_ID else int(x) for x in own], pa.int64()),
                         pa.array(off[at:to] + row["base"]), pa.array(np.diff(off[at:to + 1])),
                         binary_rows(ids[off[at]:off[to]], off[at:to + 1] - off[at], 4)],
                        names=["doc_id", "start", "n_tokens", "ids"])
                    at = to
    return run


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start`` (ids of all documents before it), ``n_tokens``,
    ``ids`` (uint32 little-endian), from the files."""
    ship_package(spark)
    parts = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    # One row per file: a running total over so few rows is one small task.
    order = Window.orderBy("part")
    based = parts.withColumn("base", F.sum("n_tokens").over(order) - F.col("n_tokens"))
    # A task per file: a repartition by number is not merged.
    return based.repartition(max(1, parts.count())).mapInArrow(
        _read_task(), "doc_id long, start long, n_tokens long, ids binary")
