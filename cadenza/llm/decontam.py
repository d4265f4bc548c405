"""Benchmark decontamination: BM25 over an inverted index of test items, walked
with block-max WAND.

Index. Test items are cut to entries of near-equal length, at most ``entry_words`` words. Term
weights are BM25 with document frequency, entry number and mean length taken over *all*
entries (Spark aggregates), divided by the entry's own score, so an entry that is
repeated word by word scores 1 and one threshold fits all. A shard of the index
holds postings per term, and per term and block of entries the largest weight.
The index is cut into shards of about ``shard_words`` words by a hash of the
entry, its item and its words, and each shard is applied to all documents in turn; a shard is the
only thing that is broadcast, so its size is bounded whatever the benchmark's size and however many
items share an id or have none. Rows that repeat an item's entry count in the statistics and
are indexed once.

Queries. Every document is cut into passages of twice the longest entry, every
longest entry's length: any occurrence of an entry lies whole in one passage.
For many passages at once, but a bounded number of cells, block maxima are added up per
passage and block of entries that share a term; a passage without a block that could reach the threshold cannot
retrieve anything. The others are run through block-max WAND, which returns *all*
entries at or above the threshold.

Verification. An entry's first half of words is its question, the rest its answer
(or the item table gives both columns). A hit counts if the passage holds
at least ``min_question`` of the question's distinct word pairs and ``min_answer`` of
the answer's. A half of one word is looked for as that word; an entry of three words or
fewer without an answer of its own is all question. An entry of fewer than ``min_words``
words may be retrieved but is never a leak: its words stand in clean documents, too.

Words are lower-cased runs of letters and digits. Defined cases: null and
empty texts have no passage and are clean; test items without words are never
found; an empty benchmark leaves everything clean; rows that repeat an id each get their
own verdict; equal items are all listed; items whose id is null count as one retrieved item and
contaminate like others, but have no id to list. Other columns pass through in
:func:`decontaminate` and are not read in :func:`find_leaks`.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import textvec as tv
from cadenza.session import ship_package
from cadenza.sources.sinks import land_table

K1, B = 1.2, 0.75
BLOCK = 4
CELLS = 1 << 20                  # cells (passage, block of entries) that are bounded at once


def _words(text: str) -> np.ndarray:
    """Word hashes of one text, lower-cased as documents are."""
    import pyarrow.compute as pc

    raw = np.frombuffer(pc.utf8_lower(text).as_py().encode(), dtype=np.uint8)
    return tv.Texts(raw, np.array([0, len(raw)])).split(tv.ALNUM).word_hash(tv.LOWER)


def _pairs(words: np.ndarray) -> np.ndarray:
    """Distinct word pairs in order."""
    return np.unique(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])


def _entry_task(entry_words: int):
    """Items to entries, with each entry's distinct words (for the corpus statistics)."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                question, answer = _words(row["_q"] or ""), _words(row["_a"] or "")
                words = np.concatenate([question, answer])
                if not len(words):
                    continue
                cut = len(question)
                n = -(-len(words) // entry_words)
                for k in range(n):
                    at, to = k * len(words) // n, (k + 1) * len(words) // n
                    size = to - at
                    if len(answer) and at < cut < to:
                        mid = cut - at
                    else:
                        mid = (size + 1) // 2 if size > 3 else size
                    out.append((row["_item"], k, mid, words[at:to].view(np.int64).tolist()))
            cols = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], batch.schema.field("_item").type), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.int64()))],
                names=["_item", "_part", "_mid", "_words"])
    return run


def _half(words: np.ndarray) -> tuple[np.ndarray, bool]:
    """What to look for of a half, and whether that is word pairs (else its single word)."""
    return (_pairs(words), True) if len(words) > 1 else (words, False)


def _runs(new: np.ndarray) -> np.ndarray:
    """First places of runs, given where a run begins after the first place."""
    return np.concatenate([[0], np.flatnonzero(new) + 1]) if len(new) else np.zeros(0, np.int64)


class Index:
    """One shard in flat arrays: entry ``e`` of item ``items[e]`` has the words
    ``words[at[e]:at[e + 1]]``, the first ``mids[e]`` of them its question. ``df_terms`` (sorted) and
    ``df`` are the document frequencies of all terms of the shard. Postings, and blocks of
    :data:`BLOCK` entries with their largest weight, lie in the order of the terms."""

    def __init__(self, entries, df: dict[int, int], n_entries: int, mean_len: float):
        """From a few entries ``(item, middle, words)``; :meth:`of_arrays` takes a whole shard."""
        terms = np.array(sorted(df), dtype=np.uint64)
        self._build([e[0] for e in entries], np.array([e[1] for e in entries], dtype=np.int64),
                    np.cumsum([0] + [len(e[2]) for e in entries]),
                    np.concatenate([np.zeros(0, np.uint64)] + [e[2] for e in entries]),
                    terms, np.array([df[t] for t in terms.tolist()]), n_entries, mean_len)

    @classmethod
    def of_arrays(cls, *arrays) -> Index:
        index = cls.__new__(cls)
        index._build(*arrays)
        return index

    def _build(self, items, mids, at, words, df_terms, df, n_entries: int, mean_len: float):
        self.items, self.mids, self.at, self.words = items, mids, at, words
        self.sizes = np.diff(at)
        self.longest = int(self.sizes.max(initial=1))
        self.n_blocks = -(-len(items) // BLOCK)
        owner = np.repeat(np.arange(len(items)), self.sizes)
        order = np.lexsort((owner, words))
        term, entry = words[order], owner[order]
        # One posting per term and entry.
        first = _runs((term[1:] != term[:-1]) | (entry[1:] != entry[:-1])) if len(term) else order
        tf = np.diff(np.append(first, len(term)))
        term, entry = term[first], entry[first]
        n = df[np.searchsorted(df_terms, term)] if len(term) else np.zeros(0)
        idf = np.log(1 + (n_entries - n + 0.5) / (n + 0.5))
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * self.sizes[entry] / mean_len))
        weight = weight / np.bincount(entry, weight, len(items))[entry] if len(term) else np.zeros(0)
        self.entry, self.weight = entry.astype(np.int64), weight
        first = _runs(term[1:] != term[:-1]) if len(term) else np.zeros(0, np.int64)
        self.terms = term[first]
        self.bounds = np.append(first, len(term)).astype(np.int64)
        self.top = np.maximum.reduceat(weight, first) if len(first) else np.zeros(0)
        block = self.entry // BLOCK
        place = (_runs((term[1:] != term[:-1]) | (block[1:] != block[:-1]))
                 if len(term) else np.zeros(0, np.int64))
        self.blocks = block[place]
        self.block_max = np.maximum.reduceat(weight, place) if len(place) else np.zeros(0)
        self.block_at = np.searchsorted(place, self.bounds)
        self.block_size = np.diff(self.block_at)
        # 16 bits of a hash tell at once that most words are not in the index.
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(self.terms >> np.uint64(48)).astype(np.int64)] = True

    def checks(self, e: int) -> list[tuple[np.ndarray, bool]]:
        """What to look for of both halves of an entry."""
        words = self.words[self.at[e]:self.at[e + 1]]
        return [_half(words[:self.mids[e]]), _half(words[self.mids[e]:])]

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Term numbers of word hashes, -1 for words not in the index."""
        out = np.full(len(words), -1, dtype=np.int64)
        if not len(self.terms):
            return out
        at = np.flatnonzero(self.seen[(words >> np.uint64(48)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(self.terms, words[at]), len(self.terms) - 1)
        ok = self.terms[spot] == words[at]
        out[at[ok]] = spot[ok]
        return out

    def may_reach(self, passage: np.ndarray, term: np.ndarray, n: int, threshold: float) -> np.ndarray:
        """Which of ``n`` passages have a block of entries whose maxima for the
        passage's distinct terms add up to the threshold."""
        if not len(passage) or not self.n_blocks:
            return np.zeros(0, dtype=np.int64)
        # Passages are taken in stretches of about CELLS cells, a passage being whole.
        size = self.block_size[term]
        total = np.concatenate([[0], np.cumsum(size)])
        starts = _runs(passage[1:] != passage[:-1])
        out, lo = [], 0
        while lo < len(passage):
            k = int(np.searchsorted(total, total[lo] + CELLS, "right")) - 1
            j = int(np.searchsorted(starts, k, "right"))
            hi = len(passage) if k >= len(passage) else int(starts[j - 1])
            if hi <= lo:                       # one passage alone is larger
                j = int(np.searchsorted(starts, lo, "right"))
                hi = int(starts[j]) if j < len(starts) else len(passage)
            mine = size[lo:hi]
            where = np.arange(total[hi] - total[lo]) + np.repeat(
                self.block_at[term[lo:hi]] - (total[lo:hi] - total[lo]), mine)
            base = int(passage[lo])
            cell = np.repeat(passage[lo:hi] - base, mine) * self.n_blocks + self.blocks[where]
            cells = (int(passage[hi - 1]) - base + 1) * self.n_blocks
            if cells <= 4 * len(cell):         # most cells are met: a dense sum is shorter
                bound = np.bincount(cell, self.block_max[where], cells)
                hit = np.flatnonzero(bound >= threshold - 1e-9)
            else:
                order = np.argsort(cell, kind="stable")
                cell = cell[order]
                run = _runs(cell[1:] != cell[:-1])
                bound = np.add.reduceat(self.block_max[where[order]], run) if len(run) else np.zeros(0)
                hit = cell[run[bound >= threshold - 1e-9]]
            out.append(np.unique(hit // self.n_blocks) + base)
            lo = hi
        return np.concatenate(out)

    def wand(self, query: list[int], threshold: float) -> list[tuple[int, float]]:
        """All entries that score ``threshold`` or more with these distinct
        terms, by block-max WAND: cursors stay sorted by their entry; the pivot is
        where the lists' maxima could first reach the threshold; the maxima of
        the pivot's block decide whether its entry is scored or the block is skipped."""
        entries, weights, blocks, maxima = (
            memoryview(x) for x in (self.entry, self.weight, self.blocks, self.block_max))
        # Place in the postings, their end, largest weight, place in the blocks, their end.
        cursors = [[int(self.bounds[t]), int(self.bounds[t + 1]), float(self.top[t]),
                    int(self.block_at[t]), int(self.block_at[t + 1])] for t in query]
        hits, slack = [], threshold - 1e-9
        while True:
            cursors = [c for c in cursors if c[0] < c[1]]
            cursors.sort(key=lambda c: entries[c[0]])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[2]
                if bound >= slack:
                    pivot = i
                    break
            if pivot < 0:
                return hits
            doc = entries[cursors[pivot][0]]
            while pivot + 1 < len(cursors) and entries[cursors[pivot + 1][0]] == doc:
                pivot += 1
            block, bound = doc // BLOCK, 0.0
            for c in cursors[:pivot + 1]:
                c[3] = bisect_left(blocks, block, c[3], c[4])
                if c[3] < c[4] and blocks[c[3]] == block:
                    bound += maxima[c[3]]
            if bound < slack:
                # No entry up to the block's end, or to the next list, can reach it.
                to = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    to = min(to, entries[cursors[pivot + 1][0]])
                to = max(to, doc + 1)
            elif entries[cursors[0][0]] == doc:
                score = sum(weights[c[0]] for c in cursors[:pivot + 1])
                if score >= slack:
                    hits.append((doc, score))
                to = doc + 1
            else:
                to = doc
            for c in cursors[:pivot + 1]:
                c[0] = bisect_left(entries, to, c[0], c[1])


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of an Arrow column of lists."""
    import pyarrow as pa

    parts = [c for c in column.chunks if len(c)]
    whole = pa.concat_arrays(parts) if parts else pa.array([], column.type)
    offsets = whole.offsets.to_numpy().astype(np.int64)
    values = whole.values.to_numpy()[offsets[0]:offsets[-1]] if len(whole) else np.zeros(0, np.int64)
    return values.view(np.uint64), offsets - offsets[0] if len(whole) else np.zeros(1, np.int64)


def _leak_task(shared, threshold: float, min_question: float, min_answer: float, min_words: int):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        index = shared.value
        step = index.longest
        for batch in batches:
            found = []
            names = batch.column("_id")
            lower = pc.utf8_lower(pc.fill_null(batch.column("_text"), ""))
            for row, texts in tv.slices(lower):
                texts.split(tv.ALNUM)
                words = texts.word_hash()
                term = index.lookup(words)
                # Only words of the index matter from here on.
                at = np.flatnonzero(term >= 0)
                if not len(at):
                    continue
                # Passage k of a text: words k*step to (k+2)*step; each word is in two.
                place = at - texts.first[texts.doc[at]]
                passages = np.maximum(1, -(-texts.words // step) - 1)
                base = np.concatenate([[0], np.cumsum(passages)])
                doc = texts.doc[at]
                own = np.minimum(place // step, passages[doc] - 1)
                before = place // step - 1
                both = (before >= 0) & (before != own)
                spot = np.concatenate([base[doc] + own, (base[doc] + before)[both]])
                kinds = np.concatenate([term[at], term[at][both]])
                # Distinct (passage, term).
                key = np.unique(spot * len(index.terms) + kinds)
                spot, kinds = key // len(index.terms), key % len(index.terms)
                for p in index.may_reach(spot, kinds, int(base[-1]), threshold):
                    lo, hi = np.searchsorted(spot, [p, p + 1])
                    hits = index.wand(kinds[lo:hi].tolist(), threshold)
                    if not hits:
                        continue
                    d = int(np.searchsorted(base, p, "right")) - 1
                    a = texts.first[d] + (p - base[d]) * step
                    b = min(a + 2 * step, texts.first[d + 1])
                    mine = _pairs(words[a:b])
                    single = np.unique(words[a:b])
                    for e, score in hits:
                        parts = [np.isin(x, mine if pairs else single).mean() if len(x) else 1.0
                                 for x, pairs in index.checks(e)]
                        found.append((names[row + d].as_py(), row + d, index.items[e], float(score),
                                      float(parts[0]), float(parts[1]),
                                      bool(index.sizes[e] >= min_words) and parts[0] >= min_question
                                      and parts[1] >= min_answer))
            cols = list(zip(*found)) if found else [[]] * 7
            key = batch.column("_row")
            yield pa.RecordBatch.from_arrays(
                [key.take(pa.array(cols[1], pa.int64())), pa.array(cols[0], names.type),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.float64()),
                 pa.array(cols[4], pa.float64()), pa.array(cols[5], pa.float64()),
                 pa.array(cols[6], pa.bool_())],
                names=["_row", "_id", "item_id", "score", "question_overlap", "answer_overlap", "leak"])
    return run


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", question_col: str | None = None,
               answer_col: str | None = None, threshold: float = 0.6, min_question: float = 0.7,
               min_answer: float = 0.7, entry_words: int = 256,
               shard_words: int = 2_000_000, min_words: int = 3) -> DataFrame:
    """One row per retrieved (passage, entry): ``_row`` (hash of the text), ``_id``,
    ``item_id`` (as text), ``score``, ``question_overlap, answer_overlap, leak``."""
    spark = docs.sparkSession
    ship_package(spark)
    source = items.select(F.col(item_id).cast("string").alias("_item"),
                          F.col(question_col or item_text).alias("_q"),
                          (F.col(answer_col) if answer_col else F.lit(None).cast("string")).alias("_a"))
    entries = land_table(source.mapInArrow(
        _entry_task(entry_words), "_item string, _part long, _mid long, _words array<long>"), "entries")
    total = entries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("_words")).alias("words")).first()
    n, words = total["n"], total["words"] or 0
    shards = max(1, -(-words // shard_words))
    df = entries.select(F.explode(F.array_distinct("_words")).alias("_w")).groupBy("_w").agg(
        F.count(F.lit(1)).alias("_df"))
    kept = entries.dropDuplicates()
    if shards > 1:
        df = land_table(df, "entry-terms")
        kept = land_table(kept.withColumn(
            "_shard", F.pmod(F.xxhash64("_item", "_part", "_words"), F.lit(shards))), "entry-shards", "_shard")
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.xxhash64(text_col).alias("_row"), F.col(id_col).alias("_id"),
                        F.col(text_col).alias("_text"))
    out = None
    for s in range(shards):
        # One shard of about shard_words words at a time reaches the driver, as Arrow arrays.
        mine = kept.filter(F.col("_shard") == s) if shards > 1 else kept
        rows = mine.orderBy("_item", "_part").toArrow()
        freq = (df.join(mine.select(F.explode("_words").alias("_w")).distinct(), "_w", "left_semi")
                .toArrow())
        own, at = _flat(rows["_words"])
        terms = freq["_w"].to_numpy().view(np.uint64)
        order = np.argsort(terms)                # df_terms of the index are sorted
        index = Index.of_arrays(rows["_item"].to_pylist(), rows["_mid"].to_numpy(), at, own, terms[order],
                                freq["_df"].to_numpy()[order], n, words / max(n, 1))
        part = texts.mapInArrow(
            _leak_task(spark.sparkContext.broadcast(index), threshold, min_question, min_answer,
                       min_words),
            f"_row long, _id {kind}, item_id string, score double, question_overlap double, "
            "answer_overlap double, leak boolean")
        out = part if out is None else out.unionByName(part)
    return out


def leak_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """``docs`` plus ``n_retrieved`` (entries at or above the threshold),
    ``leaked_items`` (sorted ids of verified items), ``best_score``, ``contaminated``;
    columns of ``docs`` with one of these names are replaced."""
    names = docs.columns
    # Numbered names inside, so no input column can clash with a helper column.
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    hits = (find_leaks(plain, items, id_, text, **options)
            .groupBy("_row", "_id").agg(
                (F.countDistinct("item_id") + F.max(F.col("item_id").isNull().cast("int"))).alias("_n"),
                F.max("score").alias("_best"), F.max("leak").alias("_leak"),
                F.array_sort(F.collect_set(F.when(F.col("leak"), F.col("item_id")))).alias("_leaked")))
    joined = plain.withColumn("_th", F.xxhash64(text)).join(
        hits, (F.col("_th") == F.col("_row")) & F.col(id_).eqNullSafe(F.col("_id")), "left")
    leaked = F.coalesce("_leaked", F.expr("cast(array() as array<string>)"))
    results = ("n_retrieved", "leaked_items", "best_score", "contaminated")
    return joined.select(
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(names) if name not in results],
        F.coalesce("_n", F.lit(0)).alias("n_retrieved"), leaked.alias("leaked_items"),
        F.coalesce("_best", F.lit(0.0)).alias("best_score"),
        F.coalesce("_leak", F.lit(False)).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """``docs`` without the contaminated ones."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    return leak_report(plain, items, id_, text, **options).filter(
        ~F.col("contaminated")).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
