"""Packing along a space-filling curve.

1. Every document is encoded (whole text, then the end id) and gets a hashed
   word vector: words hashed to buckets, weight 1 + log(count), unit length.
   A fixed random projection takes it to a few dimensions.
   Long documents are cut into stretches of at most ``STRETCH`` ids, each a row of its
   own, so rows are of like size whatever the documents are.
2. Coordinates are centred and scaled by the corpus mean and deviation (one
   aggregate), cut to a grid, and turned into the cell's place on a Hilbert
   curve. Range partitioning and sorting by (key, id) lays documents out along the
   curve; ties on the key are split by id and place, so neither copies nor one huge
   document share one task.
3. Each range partition packs its documents one after the other into sequences of
   ``max_tokens``; a document goes on in the next sequence where it is cut.
   What is left at the end of a partition goes into sequences whose lengths
   are powers of two, largest first. So no sequence needs padding, and
   partitions do not depend on each other.

Token ids are landed once, between encoding and sorting, so range sampling and
retries do not encode again. ``sequence_id`` is the partition number shifted by
33 bits plus the number within the partition.

Defined cases: null text is empty and holds only the end id; documents without
words lie at the origin; rows that repeat an id are each packed, ordered by a hash of the text; a null
id sorts first. Columns other than id and text are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import textvec as tv
from cadenza.llm.tokens import binary_rows, encoder
from cadenza.session import ship_package
from cadenza.sources.sinks import land_table

BUCKETS = 1 << 14
STRETCH = 1 << 12


@lru_cache(maxsize=4)
def _directions(dims: int) -> np.ndarray:
    """The random projection (buckets x dims), drawn once per worker."""
    return np.random.default_rng(1891).standard_normal((BUCKETS, dims)).astype(np.float32)


def project(texts: tv.Texts, dims: int) -> np.ndarray:
    """Projected unit vectors of a slice of texts (texts x dims)."""
    texts.split()
    if not len(texts.start):
        return np.zeros((texts.n, dims))
    matrix = _directions(dims)
    keys, doc, count = tv.distinct_in_text(texts.doc, texts.word_hash(tv.LOWER))
    bucket = (keys & np.uint64(BUCKETS - 1)).astype(np.int64)
    weight = 1 + np.log(count)
    size = np.sqrt(np.bincount(doc, weight * weight, texts.n))
    out = np.stack([np.bincount(doc, weight * matrix[bucket, d], texts.n)
                    for d in range(dims)], axis=1)
    return out / np.maximum(size, 1e-9)[:, None]


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of grid cells (rows x dims, 0 to
    2**bits - 1): axes are turned to their transposed Hilbert form from the
    highest bit down, then bits are interleaved."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for d in range(dims):
            is_set = (x[d] & level) > 0
            swap = np.where(is_set, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(is_set, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
        level >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where((x[dims - 1] & level) > 0, turn ^ (level - 1), turn)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def _encode_task(tokenizer: str, end_id: int, dims: int):
    def run(batches):
        import pyarrow as pa

        enc = encoder(tokenizer)
        width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 else 4
        for batch in batches:
            for row, texts in tv.slices(batch.column("_text")):
                ids, bounds = enc.encode_with_end(texts, end_id)
                spot = project(texts, dims)
                size = np.diff(bounds)
                # Row numbers and places of all stretches.
                cuts = -(-size // STRETCH)
                own = np.repeat(np.arange(texts.n), cuts)
                start = (np.arange(len(own)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * STRETCH
                edges = np.append(bounds[:-1][own] + start, len(ids))
                rows = pa.array(own + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(rows), batch.column("_th").take(rows), pa.array(start),
                     pa.array(size[own]), binary_rows(ids, edges, width)]
                    + [pa.array(spot[own, d]) for d in range(dims)],
                    names=["_id", "_th", "_start", "_n", "_ids"] + [f"_p{d}" for d in range(dims)])
    return run


_ROW = ("_id", "_th", "_start", "_n", "_ids")


def _key_task(mean: list, std: list, bits: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            spot = np.stack([batch.column(f"_p{d}").to_numpy() for d in range(len(mean))], axis=1)
            grid = (spot - np.array(mean)) / np.array(std)      # 4 deviations each way
            cells = np.clip((grid + 4) / 8 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hilbert_key(cells, bits))] + [batch.column(c) for c in _ROW],
                names=["_key", *_ROW])
    return run


def _pack_task(max_tokens: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        kind = None
        done, room, seq = [], max_tokens, 0
        open_pieces = []                 # pieces of the sequence being filled

        def piece(doc, start, ids, total, sequence, offset):
            done.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, sequence, offset))

        def close(size):
            """Write the open pieces up to ``size`` tokens as one sequence."""
            nonlocal open_pieces, seq
            offset, rest = 0, []
            for doc, start, ids, total in open_pieces:
                take = min(len(ids), size - offset)
                if take:
                    piece(doc, start, ids[:take], total, base + seq, offset)
                    offset += take
                if take < len(ids):
                    rest.append((doc, start + take, ids[take:], total))
            open_pieces, seq = rest, seq + 1

        def flush():
            nonlocal done
            cols = list(zip(*done))
            done = []
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.int64()),
                 pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.int64())],
                names=["_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        last = None                      # document and place where the last stretch ended
        for batch in batches:
            kind = batch.schema.field("_id").type
            for doc, text, start, total, raw in zip(*[batch.column(c).to_pylist() for c in _ROW[:4]],
                                                    batch.column("_ids")):
                raw = raw.as_buffer()
                width = raw.size // min(STRETCH, total - start)
                ids = np.frombuffer(raw, dtype=f"<u{width}")
                at = 0
                while at < len(ids):
                    take = min(room, len(ids) - at)
                    part = ids[at:at + take]
                    if open_pieces and last == (doc, text, start + at):
                        # The document goes on in this sequence: one piece.
                        before = open_pieces.pop()
                        open_pieces.append((doc, before[1], np.concatenate([before[2], part]), total))
                    else:
                        open_pieces.append((doc, start + at, part, total))
                    at, room = at + take, room - take
                    last = (doc, text, start + at)
                    if room == 0:
                        close(max_tokens)
                        room = max_tokens
                        if len(done) >= 2048:
                            yield flush()
        left = max_tokens - room
        while left:
            size = 1 << (left.bit_length() - 1)
            close(size)
            left -= size
        if done:
            yield flush()
    return run


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0,
         max_tokens: int = 1024, id_col: str = "doc_id", text_col: str = "text",
         dims: int = 4, bits: int = 10) -> DataFrame:
    """One row per piece: id, ``start`` (ids of the document before it),
    ``length``, ``ids`` (uint32 little-endian), ``doc_tokens``,
    ``sequence_id``, ``offset``."""
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    spots = [f"_p{d}" for d in range(dims)]
    row = f"_id {kind}, _th long, _start long, _n long, _ids binary"
    coded = land_table(
        docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"),
                    F.col(text_col).alias("_text")).mapInArrow(
            _encode_task(tokenizer, end_id, dims),
            row + ", " + ", ".join(f"{p} double" for p in spots)), "token_ids")
    stats = coded.filter("_start = 0").agg(*[F.avg(p) for p in spots],
                                           *[F.stddev_pop(p) for p in spots]).first()
    mean = [stats[d] or 0.0 for d in range(dims)]
    std = [stats[dims + d] or 1.0 for d in range(dims)]
    keyed = coded.mapInArrow(_key_task(mean, std, bits), f"_key long, {row}")
    order = ("_key", "_id", "_th", "_start")
    laid = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return laid.mapInArrow(
        _pack_task(max_tokens),
        f"_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long").withColumnRenamed("_id", id_col)
