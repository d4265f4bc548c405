"""Importance resampling towards a target distribution.

1. Features of a text are its runs of 1 to ``max_n`` consecutive words (ASCII letters
   lower-cased; words are runs of letters, digits and characters outside ASCII), repeats
   counted. A feature's bucket is its CRC-32 modulo ``buckets``.
2. Both corpora are counted per bucket: an array per task, one row per bucket after the
   sum. The gain of a bucket is its smoothed log ratio of target to raw share, an array of
   ``buckets`` numbers that every scoring task holds.
3. A document's weight is the floored mean of its features' gains; its score adds Gumbel
   noise drawn from its id, so the highest scores are a draw without replacement.
4. Parallel sorting by regular sampling ranks the eligible documents. Every scoring task
   leaves a sorted run; places at regular distances in the runs give the splitters; rows go
   to their splitters' segment and are merged there; counts of the segments before it
   and the place in its own segment give a row's exact rank. Splitters balance the
   segments and never change a rank.

Defined cases: null texts and texts without a word have no features and weight 0; fewer
than ``min_words`` words are never drawn; equal scores go to the smaller id, a null id last;
repeated rows are ranked one after the other; an empty target gives every bucket the
smoothed share; an empty corpus gives an empty result. Columns other than id and text
are not read.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import textvec as tv
from cadenza.session import ship_package
from cadenza.sources.sinks import land_table

_POLY = np.uint32(0xEDB88320)
_ONES = 0xFFFFFFFF
#: Segments at most, and sampled places per segment: they bound what the driver sorts.
MAX_SEGMENTS, PLACES = 1 << 14, 32
#: A row of a sorted run is numbered run << 33 | place (monotonically_increasing_id).
_PLACE_BITS = 33


def _crc_steps() -> np.ndarray:
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ _POLY, step >> np.uint32(1))
    return step


_STEPS = _crc_steps()


def crc_extend(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray,
               wide: int = 48) -> np.ndarray:
    """CRC-32 registers (before the closing complement) after the bytes ``start`` to ``end``
    of each row. All rows take their k-th byte together; a stretch of more than
    ``wide`` bytes goes through zlib on its own."""
    span = end - start
    out = state.copy()
    for i in np.flatnonzero(span > wide):
        out[i] = zlib.crc32(data[start[i]:end[i]].tobytes(), int(state[i]) ^ _ONES) ^ _ONES
    order = np.argsort(-np.where(span > wide, 0, span), kind="stable")
    span, at, reg = span[order], start[order], out[order]
    more = np.searchsorted(-np.where(span > wide, 0, span), -np.arange(wide), "left")
    for k in range(wide):
        n = more[k]
        if not n:
            break
        head = reg[:n]
        reg[:n] = _STEPS[(head ^ data[at[:n] + k]) & np.uint32(255)] ^ (head >> np.uint32(8))
    out[order] = reg
    return out


def feature_buckets(texts: tv.Texts, max_n: int, buckets: int):
    """``(bucket, text)`` of every feature of a slice, in no order; sets ``texts.words``."""
    texts.split(tv.ALNUM)
    data = tv.LOWER[texts.data]
    space = np.array([32], dtype=np.uint8)
    state = np.full(len(texts.start), _ONES, dtype=np.uint32)
    head, found, owner = np.arange(len(texts.start)), [], []
    for n in range(max_n):
        # ``head`` are the words at which a run of n + 1 words starts.
        if n:
            whole = head + n < texts.first[1:][texts.doc[head]]
            head = head[whole]
            state = _STEPS[(state[whole] ^ space) & np.uint32(255)] ^ (state[whole] >> np.uint32(8))
        state = crc_extend(state, data, texts.start[head + n], texts.end[head + n])
        found.append((state ^ np.uint32(_ONES)) % np.uint32(buckets))
        owner.append(texts.doc[head])
    return np.concatenate(found), np.concatenate(owner)


def _count_task(max_n: int, buckets: int):
    def run(batches):
        import pyarrow as pa

        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in tv.slices(batch.column("_text")):
                total += np.bincount(feature_buckets(texts, max_n, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])],
                                         names=["_bucket", "_n"])
    return run


def bucket_counts(texts: DataFrame, text_col: str, max_n: int, buckets: int) -> np.ndarray:
    """Features per bucket over all texts: at most ``buckets`` numbers reach the driver."""
    per_task = texts.select(F.col(text_col).alias("_text")).mapInArrow(
        _count_task(max_n, buckets), "_bucket long, _n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in per_task.groupBy("_bucket").agg(F.sum("_n")).collect():
        out[bucket] = n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + b) / ((s + 1)(T + b))))`` of each of the b buckets."""
    s, t, b = raw.astype(float), target.astype(float), len(raw)
    ratio = (t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weight_task(gains: np.ndarray, max_n: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row, texts in tv.slices(batch.column("_text")):
                bucket, doc = feature_buckets(texts, max_n, len(gains))
                n = np.bincount(doc, minlength=texts.n)
                # Sums of whole numbers, exact in doubles.
                total = np.bincount(doc, weights=gains[bucket], minlength=texts.n).astype(np.int64)
                weight = total // np.maximum(n, 1)
                part = batch.slice(row, texts.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_u"), pa.array(texts.words, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                    names=["_id", "_u", "_words", "_n", "_weight"])
    return run


def _segment_task(splitters: list):
    """Segment of each row: the number of splitters at or before it in the order of ranks."""
    scores = np.array([-k[0] for k in splitters], dtype=np.int64)
    keys = [(-k[0], k[1] is None, k[1], k[2]) for k in splitters]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            score = -batch.column("_score").to_numpy()
            seg = np.searchsorted(scores, score, "left")
            # Rows on the score of a splitter are told apart by id, then by place.
            tied = np.flatnonzero(np.searchsorted(scores, score, "right") > seg)
            ids = batch.column("_id").take(pa.array(tied)).to_pylist()
            at = batch.column("_at").to_numpy()[tied]
            for i, name, place in zip(tied, ids, at):
                seg[i] = bisect.bisect_right(keys, (score[i], name is None, name, place))
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(seg, pa.int32())],
                                             names=batch.schema.names + ["_seg"])
    return run


def _rank_order():
    return [F.desc("_score"), F.asc_nulls_last("_id"), F.asc("_at")]


def regular_splitters(runs: DataFrame, n: int, segments: int) -> list:
    """Up to ``segments - 1`` keys (score, id, place) that cut ``n`` rows in sorted runs
    into like segments. Every run gives the rows at regular distances, from a start that
    differs by run; about ``PLACES`` per segment reach the driver."""
    if segments < 2:
        return []
    gap = max(1, n // (segments * PLACES))
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    phase = F.pmod(F.xxhash64(F.shiftright("_at", _PLACE_BITS)), F.lit(gap))
    places = (runs.filter(F.pmod(place + phase, F.lit(gap)) == 0)
              .select("_score", "_id", "_at").collect())
    places.sort(key=lambda r: (-r[0], r[1] is None, r[1], r[2]))
    cuts = [len(places) * i // segments for i in range(1, segments)]
    return [tuple(places[c]) for c in sorted(set(cuts)) if c]


def rank_runs(runs: DataFrame, n: int, upto: int, segments: int) -> DataFrame:
    """``runs`` (``_score, _id, _at``; sorted runs of ``n`` rows) with ``rank``, 1 for the
    highest score, null beyond ``upto``."""
    splitters = regular_splitters(runs, n, segments)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema.fields)
    placed = runs.mapInArrow(_segment_task(splitters), fields + ", _seg int")
    held = np.zeros(len(splitters) + 1, dtype=np.int64)
    for seg, k in placed.groupBy("_seg").count().collect():
        held[seg] = k
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(held)[:-1]])
    # Segments that start beyond the draw need no order.
    last = int(np.searchsorted(before, upto, "left")) - 1
    undrawn = placed.filter(F.col("_seg") > last).select(
        *runs.columns, F.lit(None).cast("long").alias("rank"))
    if last < 0:
        return undrawn
    merged = (placed.filter(F.col("_seg") <= last).repartitionById(last + 1, F.col("_seg"))
              .sortWithinPartitions(*_rank_order()))
    spot = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    own = F.when(F.spark_partition_id() == F.col("_seg"), F.lit(before[:last + 1])[F.col("_seg")])
    rank = F.coalesce(own, F.raise_error(F.lit("a segment left its partition")).cast("long")) + spot + 1
    drawn = (merged.withColumn("_rank", rank)
             .select(*runs.columns, F.when(F.col("_rank") <= upto, F.col("_rank")).alias("rank")))
    return drawn.unionByName(undrawn)


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text", target_text_col: str = "text", max_n: int = 2,
                        buckets: int = 10_000, share_pct: int = 25, min_words: int = 20,
                        seed: int = 7) -> DataFrame:
    """One row per document: id, ``n_features``, ``weight``, ``score`` and ``rank``: 1, 2, ...
    for the ``share_pct`` percent with the highest scores of the documents of at least
    ``min_words`` words, else null."""
    spark = docs.sparkSession
    ship_package(spark)
    gains = bucket_gains(bucket_counts(docs, text_col, max_n, buckets),
                         bucket_counts(target, target_text_col, max_n, buckets))
    kind = docs.schema[id_col].dataType.simpleString()
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    first = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256), 1, 8)
    u = (F.conv(first, 16, 10).cast("double") + 0.5) / 4294967296.0
    scored = (docs.select(F.col(id_col).alias("_id"), u.alias("_u"), F.col(text_col).alias("_text"))
              .mapInArrow(_weight_task(gains, max_n),
                          f"_id {kind}, _u double, _words long, _n long, _weight long")
              .select("_id", "_words", "_n", "_weight", (F.col("_weight") + F.floor(
                  -1000 * F.log(-F.log("_u")))).cast("long").alias("_score")))
    # Short texts last: the places of the others in their run have no gaps.
    short = F.col("_words") < min_words
    runs = land_table(scored.sortWithinPartitions(short, F.desc("_score"), F.asc_nulls_last("_id"))
                      .withColumn("_at", F.monotonically_increasing_id()), "scored-runs")
    eligible = runs.filter(~short)
    n = eligible.count()
    segments = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 1000, MAX_SEGMENTS))
    ranked = rank_runs(eligible, n, share_pct * n // 100, segments)
    rest = runs.filter(short).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_features"), F.col("_weight").alias("weight"),
        F.col("_score").alias("score"), "rank")
