"""Quality rules: fixed text statistics, then an n-gram likelihood ratio.

Base rules (of the whole text, exact): counts of words, their characters,
symbols, repeated lines and words in repeated 3-word windows; a text with few
words or mostly repeated windows fails.

Verdict. Overlapping byte n-grams and word pairs are hashed to buckets. One
pass over *all* documents counts the buckets of the raw corpus, and of the trusted
documents among them; each task adds up its own counts, and a grouping by bucket adds the tasks.
With add-one smoothing the two multinomials give every bucket a log ratio
log p(bucket | trusted) - log p(bucket | raw). A document's score is the sum of its
n-grams' ratios divided by their number; it is kept if the score is at least
the threshold. The threshold is a fixed number or, by default, set from the trusted
documents' own scores: their low ``quantile``, less ``slack`` times its distance from
their median (0 at most). So it moves with the corpus, and no document is kept or
dropped by chance.

Trusted documents are all those that ``labels`` rates 1. Their ids meet the texts in a shuffled
hash join; the scores are landed, and the two quantiles are read off the running totals of
the sorted trusted scores, exactly.

Defined cases: null and empty texts have no words, zeros everywhere and fail the
base rules; a text that repeats a trusted id is trusted as well; without any trusted document every
score is 0 and the base rules alone decide. Columns other than id and
text are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import textvec as tv
from cadenza.operators.numbering import global_cumsum
from cadenza.session import ship_package
from cadenza.sources.sinks import land_table

BUCKETS = 1 << 16
_SYMBOL = np.isin(tv.ALL, np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
_HEAD = (tv.ALL & 0xC0) != 0x80            # first byte of a character


def text_rules(texts: tv.Texts) -> dict[str, np.ndarray]:
    """The base counts of a slice of texts (split into words)."""
    data = texts.data
    first, doc = texts.first, texts.doc
    heads = np.concatenate([[0], np.cumsum(_HEAD[data], dtype=np.int64)])
    chars = heads[texts.end] - heads[texts.start]

    # Lines: cut at each \n and at the ends of texts.
    cut = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([texts.lo, cut + 1]))
    end = np.sort(np.concatenate([texts.hi, cut]))
    has = np.searchsorted(texts.start, end) > np.searchsorted(texts.start, start)
    start, end = start[has], end[has]
    line_doc = np.searchsorted(texts.lo, start, side="right") - 1
    _, at, count = tv.distinct_in_text(line_doc, texts.range_hash(start, end))
    dup = np.bincount(at, count - 1, texts.n).astype(np.int64)

    grams, whole = texts.ngrams(texts.word_hash(), 3)
    key = tv.text_key(doc, grams)
    keys, _, count = tv.distinct_in_text(doc[whole], grams[whole])
    again = keys[count > 1]
    hit = np.zeros(len(key), dtype=bool)
    if len(again):
        spot = np.minimum(np.searchsorted(again, key), len(again) - 1)
        hit = (again[spot] == key) & whole
    inside = hit.copy()
    inside[1:] |= hit[:-1]
    inside[2:] |= hit[:-2]
    return {"n_words": np.diff(first), "word_chars": texts.sums(chars),
            "n_symbols": texts.byte_sums(_SYMBOL[data]), "n_dup_lines": dup,
            "n_repeat_words": texts.sums(inside.astype(np.int64))}


def gram_buckets(texts: tv.Texts, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all byte n-grams and of all word pairs of a slice:
    ``(buckets of n-grams by first byte, buckets of pairs, text of a pair)``.
    An n-gram that leaves its text is given bucket -1."""
    data = texts.data.astype(np.uint32)
    code = np.zeros(len(data), dtype=np.uint32)
    for k in range(n):
        part = data[k:]
        code[:len(part)] = code[:len(part)] * np.uint32(0x01000193) + part
    code = code * np.uint32(0x9E3779B1)
    gram = (code >> np.uint32(17)).astype(np.int64)          # the lower half of the buckets
    for k in range(1, n):                                    # n-grams cut by the text's end
        at = texts.hi - k
        gram[at[at >= texts.lo]] = -1
    pair, whole = texts.ngrams(texts.word_hash(), 2)
    pair = (pair[whole] >> np.uint64(49)).astype(np.int64) + BUCKETS // 2
    return gram, pair, texts.doc[whole]


def _count_task(n: int):
    def run(batches):
        import pyarrow as pa

        raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            good = batch.column("_trusted").to_numpy(zero_copy_only=False)
            for row, texts in tv.slices(batch.column("_text")):
                texts.split()
                gram, pair, doc = gram_buckets(texts, n)
                raw += np.bincount(gram[gram >= 0], minlength=BUCKETS)
                raw += np.bincount(pair, minlength=BUCKETS)
                mine = good[row:row + texts.n]
                if mine.any():
                    own = np.repeat(mine, texts.hi - texts.lo) & (gram >= 0)
                    trusted += np.bincount(gram[own], minlength=BUCKETS)
                    trusted += np.bincount(pair[mine[doc]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(trusted[some])],
                                         names=["bucket", "raw", "trusted"])
    return run


def _score_task(n: int, ratio: np.ndarray, rules: bool):
    """Scores of all texts, with the base counts if ``rules``."""
    ratio = np.append(ratio, 0.0)                           # bucket -1: counts for nothing

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row, texts in tv.slices(batch.column("_text")):
                texts.split()
                gram, pair, doc = gram_buckets(texts, n)
                total = np.concatenate([[0.0], np.cumsum(ratio[gram])])
                number = texts.byte_sums(gram >= 0) + np.bincount(doc, minlength=texts.n)
                score = (total[texts.hi] - total[texts.lo]
                         + np.bincount(doc, ratio[pair], texts.n)) / np.maximum(number, 1)
                cols = {"_id": batch.column("_id").slice(row, texts.n), "score": pa.array(score)}
                if rules:
                    cols |= {k: pa.array(v) for k, v in text_rules(texts).items()}
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
    return run


def quantiles(scores: DataFrame, col: str, shares: list[float]) -> list[float] | None:
    """Exact quantiles of a column, interpolated as ``percentile`` does (None without rows).
    That aggregate ends in one task that holds every value; here values are sorted by range."""
    totals = global_cumsum(scores.groupBy(col).agg(F.count(F.lit(1)).alias("n")), [col], "n")
    rows = totals.agg(F.max("cum")).first()[0]
    if not rows:
        return None
    at = [share * (rows - 1) for share in shares]
    ranks = sorted({r for a in at for r in (math.floor(a), math.ceil(a))})
    found = totals.agg(*[F.min(F.when(F.col("cum") > r, F.col(col))) for r in ranks]).first()
    value = dict(zip(ranks, found))
    return [value[a] if a in value else
            (math.ceil(a) - a) * value[math.floor(a)] + (a - math.floor(a)) * value[math.ceil(a)] for a in at]


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", n: int = 4, threshold: float | None = None,
            quantile: float = 0.005, slack: float = 1.5, min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """One row per document: id, ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, score``."""
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    good = (labels.filter((F.col(label_col) == 1) & F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("_id")).distinct()
            .hint("shuffle_hash"))                                       # grows with the labels
    marked = text.join(good.withColumn("_trusted", F.lit(True)), "_id", "left").select(
        "_text", F.coalesce("_trusted", F.lit(False)).alias("_trusted"))
    counts = (marked.mapInArrow(_count_task(n), "bucket long, raw long, trusted long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
              .collect())                                                # BUCKETS rows at most
    raw, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts:
        raw[r["bucket"]], trusted[r["bucket"]] = r["raw"], r["trusted"]
    ratio = np.zeros(BUCKETS)
    for half in (slice(0, BUCKETS // 2), slice(BUCKETS // 2, BUCKETS)):  # one multinomial each
        if trusted[half].sum():
            ratio[half] = (np.log((trusted[half] + 1) / (trusted[half].sum() + BUCKETS // 2))
                           - np.log((raw[half] + 1) / (raw[half].sum() + BUCKETS // 2)))
    scored = text.mapInArrow(
        _score_task(n, ratio, rules=True),
        f"_id {kind}, score double, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long")
    if threshold is None:
        scored = land_table(scored, "quality-scores")
        found = quantiles(scored.join(good, "_id", "left_semi"), "score", [quantile, 0.5])
        threshold = 0.0
        if found is not None:
            low, mid = found
            threshold = min(low - slack * (mid - low), 0.0)
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    return scored.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("score") >= threshold)).alias("kept"), "score")
