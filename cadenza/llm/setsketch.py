"""Near-duplicates from SetSketch registers over word shingles.

1. Sketch. A text's set is its distinct word n-grams. Register i holds the
   smallest of exponentially distributed values of the set's elements,
   rounded down to a power of ``base`` and cut at both ends: element hashes
   h give u = h_i / 2^32, x = -log(1 - u) / rate, and the register is
   clip(floor(1 - log_base(min x)), 0, top). A union's registers are the
   maxima of its parts' registers, so sketches merge.
2. Texts with equal sets (a 116-bit fingerprint and the size) form a class;
   only one representative goes on, so a group of copies costs one row.
3. Bands of registers are hashed to buckets. In each bucket the class with
   the smallest id is the leader, and every other class makes one pair with
   it: linear in the bucket, never all pairs.
4. Joint estimate: the counts of larger, smaller and equal registers and the
   two known sizes give a likelihood of the Jaccard similarity; a pair whose
   best value is ``margin`` below the threshold is dropped (5.6 standard
   errors at 200 registers). Sizes that cannot reach the threshold go first.
5. Verification on full sets, and components of the verified links.
6. What leaders could not show: a bucket that still holds classes of several components is
   open, and its classes are compared with each other by the same estimate, pairs of one
   component left out, in blocks of bounded size; no text is read for that, and a block
   gives no more than the edges of a spanning forest of its likely pairs. Classes that are joined
   by such edges form a family. In a family, every class outside its largest component is a
   query, compared on full sets with all classes of the family that its size allows, in
   blocks of bounded size that give links only. So two classes are linked whether or not a
   leader links to either, texts that share a header and no more are never compared as
   sets, and no step writes all pairs of a group.

Missed links: a pair at similarity 0.8 shares no band with probability 1.2e-7
(40 bands of 5 registers).

Defined cases: null or wordless texts have size 0 and link with nothing; fewer
words than a shingle form one shingle; rows with equal ids are one document
(same component); rows with a null id are left out of the comparison, and have a
null component. Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import textvec as tv
from cadenza.llm.components import components
from cadenza.session import ship_package
from cadenza.sources.sinks import land_table

BASE, RATE, TOP = 1.02, 20.0, 4094
#: Shingles that one block of queries may hold, and texts (or classes of a bucket) of one block.
BLOCK_SHINGLES, BLOCK_TEXTS = 400_000, 2_000


def shingle_sets(texts: tv.Texts, n: int):
    """Distinct shingles of each text of a slice: ``(hashes, bounds)``, where
    text i has ``hashes[bounds[i]:bounds[i + 1]]``, sorted (52-bit)."""
    texts.split()
    words = texts.word_hash(tv.LOWER)
    grams, whole = texts.ngrams(words, n)
    doc = texts.doc
    short = np.flatnonzero((texts.words > 0) & (texts.words < n))
    grams, doc = grams[whole], doc[whole]
    if len(short):
        # The whole sequence is the one shingle.
        span = texts.words[short]
        seq = np.zeros(len(short), dtype=np.uint64)
        for k in range(n - 1):
            has = k < span
            at = texts.first[short] + k
            step = seq * np.uint64(0x9E3779B97F4A7C15) + words[np.minimum(at, len(words) - 1)]
            seq = np.where(has, step, seq)
        grams = np.concatenate([grams, tv.mix(seq ^ span.astype(np.uint64))])
        doc = np.concatenate([doc, short])
    keys, doc, _ = tv.distinct_in_text(doc, grams)
    return keys & np.uint64((1 << 52) - 1), np.searchsorted(doc, np.arange(texts.n + 1))


def _factors(m: int):
    rng = np.random.default_rng(1043)
    odd = rng.integers(0, 1 << 31, m, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, rng.integers(0, 1 << 32, m, dtype=np.uint32)


def registers(hashes: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """Registers (texts x m, uint16); all 0 for an empty set."""
    out = np.zeros((len(bounds) - 1, m), dtype=np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    at = bounds[:-1][full]
    h = tv.mix(hashes).astype(np.uint32)
    least = np.empty((len(full), m), dtype=np.uint32)
    for i, (a, b) in enumerate(zip(*_factors(m))):
        least[:, i] = np.minimum.reduceat(h * a + b, at)
    x = -np.log1p(-(least + 0.5) / 2.0 ** 32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP)
    return out


def _sketch_task(n: int, m: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for row, texts in tv.slices(batch.column("_text")):
                hashes, bounds = shingle_sets(texts, n)
                size = np.diff(bounds)
                sums = []
                for seed in (0x51ED270B, 0x2545F491):
                    c = np.concatenate([np.zeros(1, np.uint64),
                                        np.cumsum(tv.mix(hashes ^ np.uint64(seed << 20)))])
                    sums.append((c[bounds[1:]] - c[bounds[:-1]]).view(np.int64))
                part = batch.slice(row, texts.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_th"), pa.array(size, pa.int64()),
                     pa.array(sums[0]), pa.array(sums[1]),
                     pa.array([r.tobytes() for r in registers(hashes, bounds, m)], pa.binary())],
                    names=["_id", "_th", "_n", "_f1", "_f2", "_regs"])
    return run


def sketch(docs: DataFrame, id_col: str, text_col: str, shingle: int, m: int) -> DataFrame:
    """``_id, _th`` (hash of the text), ``_n`` (set size), ``_f1, _f2``
    (fingerprint of the set), ``_regs`` (registers, uint16 little-endian)."""
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"),
                       F.col(text_col).alias("_text")).mapInArrow(
        _sketch_task(shingle, m),
        f"_id {kind}, _th long, _n long, _f1 long, _f2 long, _regs binary")


def _band_task(bands: int, rows: int, carry=("_id", "_n")):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                regs = np.stack([np.frombuffer(x, dtype="<u2") for x in
                                 part.column("_regs").to_pylist()]).reshape(-1, bands, rows)
                key = np.arange(bands, dtype=np.uint64)[None, :] + np.zeros((len(regs), 1), np.uint64)
                for k in range(rows):
                    key = tv.mix(key * np.uint64(0x9E3779B97F4A7C15)
                                 + regs[:, :, k].astype(np.uint64))
                who = pa.array(np.repeat(np.arange(len(regs)), bands))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.reshape(-1).view(np.int64)), *[part.column(c).take(who) for c in carry]],
                    names=["_key", *carry])
    return run


def likelihood_jaccard(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray,
                       steps: int = 200) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of register rows with known
    set sizes. With u = na / (na + nb), v = nb / (na + nb) and
    p(x) = -log_base(1 - x (base - 1) / base), a register of the first set is
    larger with probability p(u - v J), smaller with p(v - u J)."""
    up, down = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - up - down
    u = (na / (na + nb))[:, None]
    v = 1 - u
    j = np.minimum(u / v, v / u) * (np.arange(steps + 1) / steps)[None, :]
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    pu, pv = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    score = (up * np.log(pu + tiny) + down * np.log(pv + tiny)
             + same * np.log(np.clip(1 - pu - pv, 0, 1) + tiny))
    return j[np.arange(len(j)), score.argmax(1)]


def _estimate_task(least: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                a, b = (np.stack([np.frombuffer(x, dtype="<u2") for x in part.column(c).to_pylist()])
                        for c in ("_ra", "_rb"))
                j = likelihood_jaccard(a, b, part.column("_na").to_numpy().astype(float),
                                       part.column("_nb").to_numpy().astype(float))
                yield part.select(["_lead", "_id", "_na", "_nb"]).filter(pa.array(j >= least))
    return run


def _match_task(shingle: int, pct: int):
    """Rows sorted by block, queries (role 0) before targets (role 1): links of
    each target with the queries of its block, on full sets."""
    def run(batches):
        import pyarrow as pa

        block, sets, ids, index = None, [], [], None
        for batch in batches:
            found_q, found_t = [], []
            blocks = batch.column("_blk").to_pylist()
            roles = batch.column("_role").to_pylist()
            names = batch.column("_id").to_pylist()
            for row, texts in tv.slices(batch.column("_text")):
                hashes, bounds = shingle_sets(texts, shingle)
                for i in range(texts.n):
                    mine = hashes[bounds[i]:bounds[i + 1]]
                    at = row + i
                    if blocks[at] != block:
                        block, sets, ids, index = blocks[at], [], [], None
                    if roles[at] == 0:
                        sets.append(mine.copy())
                        ids.append(names[at])
                        continue
                    if index is None:
                        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                        order = np.argsort(every, kind="stable")
                        index = (every[order], owner[order], np.array([len(s) for s in sets]))
                    every, owner, sizes = index
                    lo = np.searchsorted(every, mine, "left")
                    n_hit = np.searchsorted(every, mine, "right") - lo
                    has = n_hit > 0
                    lo, n_hit = lo[has], n_hit[has]
                    # positions lo, lo+1, ... of every matching stretch
                    where = np.arange(n_hit.sum()) + np.repeat(lo - np.cumsum(n_hit) + n_hit, n_hit)
                    both = np.bincount(owner[where], minlength=len(sizes))
                    ok = 100 * both >= pct * (sizes + len(mine) - both)
                    for q in np.flatnonzero(ok & (both > 0)):
                        if ids[q] != names[at]:
                            found_q.append(ids[q])
                            found_t.append(names[at])
            kind = batch.schema.field("_id").type
            yield pa.RecordBatch.from_arrays([pa.array(found_q, kind), pa.array(found_t, kind)],
                                             names=["_q", "_t"])
    return run


def _verified(rows: DataFrame, texts: DataFrame, shingle: int, pct: int) -> DataFrame:
    """Links from rows ``_blk, _role, _id`` (who is compared where)."""
    kind = texts.schema["_id"].dataType.simpleString()
    # Blocks are bounded, so hashing by block gives even partitions.
    ready = (rows.join(texts, "_id").repartition("_blk").sortWithinPartitions("_blk", "_role")
             .select("_blk", "_role", "_id", "_text"))
    return ready.mapInArrow(_match_task(shingle, pct), f"_q {kind}, _t {kind}").distinct()


def candidate_pairs(reps: DataFrame, bands: int, rows: int) -> DataFrame:
    """``_lead, _id, _na, _nb``: every class that shares a bucket with a smaller one,
    paired with the bucket's smallest class, with both sizes."""
    kind = reps.schema["_id"].dataType.simpleString()
    banded = reps.mapInArrow(_band_task(bands, rows), f"_key long, _id {kind}, _n long")
    # Leaders are pre-aggregated per task; the join may split a bucket with many classes.
    leaders = (banded.groupBy("_key").agg(F.min(F.struct("_id", "_n")).alias("_l"),
                                          F.max("_id").alias("_most"))
               .filter(F.col("_l._id") < F.col("_most"))
               .select("_key", F.col("_l._id").alias("_lead"), F.col("_l._n").alias("_na")))
    return (banded.join(leaders, "_key").filter(F.col("_id") != F.col("_lead"))
            .groupBy("_lead", "_id").agg(F.max("_na").alias("_na"), F.max("_n").alias("_nb")))


def likely_pairs(pairs: DataFrame, reps: DataFrame, pct: int, margin: float) -> DataFrame:
    """Pairs whose sizes can reach the threshold and whose joint estimate is not
    ``margin`` or more below it."""
    kind = reps.schema["_id"].dataType.simpleString()
    regs = reps.select("_id", "_regs")
    return (pairs.filter(100 * F.least("_na", "_nb") >= pct * F.greatest("_na", "_nb"))
            .join(regs.withColumnRenamed("_regs", "_rb"), "_id")
            .join(regs.select(F.col("_id").alias("_lead"), F.col("_regs").alias("_ra")), "_lead")
            .mapInArrow(_estimate_task(pct / 100 - margin),
                        f"_lead {kind}, _id {kind}, _na long, _nb long").distinct())


def _leader_blocks(likely: DataFrame) -> DataFrame:
    """Leaders as queries against their pairs; one with many is dealt to several blocks."""
    load = likely.groupBy("_lead").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / BLOCK_TEXTS, F.sum("_nb") / BLOCK_SHINGLES)).alias("_parts"))
    dealt = likely.join(load, "_lead").select(
        "_lead", "_id", F.pmod(F.xxhash64("_id"), F.col("_parts")).alias("_salt"))
    blk = F.xxhash64("_lead", "_salt").alias("_blk")
    return dealt.select(blk, F.lit(1).alias("_role"), "_id").unionByName(
        dealt.select("_lead", "_salt").distinct().select(
            blk, F.lit(0).alias("_role"), F.col("_lead").alias("_id")))


def _bucket_task(pct: int, least: float):
    """Rows sorted by block: a spanning forest of the pairs of classes of a block that are of different
    components, of sizes that can reach the threshold, and likely by the joint estimate. In
    a block of two deals only classes of different deals are compared."""
    def forest(ids, n, comp, deal, regs):
        _, comp = np.unique(np.array(comp, dtype=object), return_inverse=True)
        n, deal, regs = np.array(n), np.array(deal), np.stack(regs)
        mixed = deal.min() != deal.max()
        tree = np.arange(len(ids))                  # which tree each class is in so far
        for q in range(len(ids) - 1):
            rest = np.arange(q + 1, len(ids))
            fit = (tree[rest] != tree[q]) & (comp[rest] != comp[q]) & (
                100 * np.minimum(n[rest], n[q]) >= pct * np.maximum(n[rest], n[q]))
            if mixed:
                fit &= deal[rest] != deal[q]
            rest = rest[fit]
            # Equal registers first: fewer than ``least`` of them is 7 standard errors off.
            rest = rest[(regs[rest] == regs[q]).sum(1) >= least * regs.shape[1]]
            if not len(rest):
                continue
            j = likelihood_jaccard(np.broadcast_to(regs[q], (len(rest), regs.shape[1])), regs[rest],
                                   np.full(len(rest), float(n[q])), n[rest].astype(float))
            for k in rest[j >= least]:
                if tree[k] != tree[q]:
                    tree[tree == tree[k]] = tree[q]
                    yield ids[q], ids[k]

    def run(batches):
        import pyarrow as pa

        def out(kind, rows):
            cols = list(zip(*rows)) if rows else [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c in cols], names=["_a", "_b"])

        block, held, kind = None, [], None
        for batch in batches:
            kind = batch.schema.field("_id").type
            rows = zip(*[batch.column(c).to_pylist() for c in ("_blk", "_id", "_n", "_comp", "_deal")],
                       batch.column("_regs").to_pylist())
            found = []
            for blk, *row, raw in rows:
                if blk != block:
                    if len(held) > 1:
                        found += forest(*zip(*held))
                    block, held = blk, []
                held.append((*row, np.frombuffer(raw, dtype="<u2")))
            yield out(kind, found)
        if len(held) > 1:
            yield out(kind, list(forest(*zip(*held))))
    return run


def open_edges(classes: DataFrame, bands: int, rows: int, pct: int, margin: float) -> DataFrame:
    """Edges ``_a, _b`` that join all classes (``_id, _n, _regs, _comp``) of different components
    that share a bucket and are likely to link."""
    kind = classes.schema["_id"].dataType.simpleString()
    banded = classes.mapInArrow(_band_task(bands, rows, ("_id", "_comp")),
                                f"_key long, _id {kind}, _comp {kind}")
    buckets = land_table(
        banded.groupBy("_key").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi"),
                                   F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).alias("_deals"))
        .filter(F.col("_lo") != F.col("_hi")).select("_key", "_deals"), "open-buckets")
    # A bucket of several deals gives a block per pair of deals.
    deal = F.pmod(F.xxhash64("_id"), F.col("_deals"))
    dealt = (banded.join(buckets, "_key").select("_key", "_id", deal.alias("_deal"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("_deals") - 1)).alias("_with"))
        .select(F.xxhash64("_key", F.least("_deal", "_with"), F.greatest("_deal", "_with")).alias("_blk"),
                "_id", "_deal"))
    ready = dealt.join(classes, "_id").repartition("_blk").sortWithinPartitions("_blk")
    return ready.select("_blk", "_id", "_n", "_comp", "_deal", "_regs").mapInArrow(
        _bucket_task(pct, pct / 100 - margin), f"_a {kind}, _b {kind}").distinct()


def _family_blocks(nodes: DataFrame, pct: int) -> DataFrame:
    """In families (``nodes``: ``_id, _n, _family, _comp``) every class outside the largest
    component as a query against all classes of its family that its size allows."""
    level = F.floor(F.log(F.col("_n").cast("double")) / np.log(1.1)).alias("_level")
    # Landed: one row per family, so that the joins with it can be broadcast by their size, or split.
    main = land_table(
        nodes.groupBy("_family", "_comp").agg(F.count(F.lit(1)).alias("_c")).groupBy("_family").agg(
            F.max(F.struct("_c", "_comp")).alias("_big"), F.count(F.lit(1)).alias("_comps"),
            F.ceil(F.sum("_c") / BLOCK_TEXTS).alias("_deals"))
        .filter(F.col("_comps") > 1).select("_family", F.col("_big._comp").alias("_main"), "_deals"), "families")
    split = nodes.select("*", level).join(main, "_family")
    queries = split.filter(F.col("_comp") != F.col("_main"))
    # Blocks hold queries of like size: by family, size level and salt. Targets are dealt
    # out as well, so each block reads about BLOCK_TEXTS of them.
    load = land_table(queries.groupBy("_family", "_level").agg(
        F.ceil(F.sum("_n") / BLOCK_SHINGLES).alias("_parts")), "family-loads")
    reach = int(np.ceil(np.log(100 / pct) / np.log(1.1))) + 1
    up_to = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    blk = F.xxhash64("_family", "_level", "_salt", "_deal").alias("_blk")
    asked = (queries.join(load, ["_family", "_level"])
             .withColumn("_salt", F.pmod(F.xxhash64("_id"), F.col("_parts")))
             .withColumn("_deal", up_to("_deals")).select(blk, F.lit(0).alias("_role"), "_id"))
    targets = (split.select("_id", "_family", "_deals", F.explode(F.sequence(
        F.col("_level") - reach, F.col("_level") + reach)).alias("_level"))
        .join(load, ["_family", "_level"])
        .withColumn("_salt", up_to("_parts"))
        .withColumn("_deal", F.pmod(F.xxhash64("_id"), F.col("_deals")))
        .select(blk, F.lit(1).alias("_role"), "_id"))
    return asked.unionByName(targets)


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` (``_id, _comp``) after further links ``_q, _t``: a graph of components only."""
    side = lambda c: comp.select(F.col("_id").alias(c), F.col("_comp").alias(c + "c"))
    ends = (links.join(side("_q"), "_q", "left").join(side("_t"), "_t", "left")
            .select(F.coalesce("_qc", "_q").alias("_q"), F.coalesce("_tc", "_t").alias("_t")))
    joined = components(ends, "_q", "_t").select("node", F.col("component").alias("_to"))
    return land_table(comp.join(joined, F.col("_comp") == F.col("node"), "full").select(
        F.coalesce("_id", "node").alias("_id"), F.coalesce("_to", "_comp").alias("_comp")), "components")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           shingle: int = 5, pct: int = 80, bands: int = 40, rows: int = 5,
                           margin: float = 0.2):
    """``(members, links, comp)``: per document ``_id, _th, _n, _cid`` (its class),
    the verified links ``_q, _t`` between classes, and the component of each
    linked class, as ``_cid, _comp``."""
    sk = land_table(sketch(docs, id_col, text_col, shingle, bands * rows), "sketches")
    own = sk.filter(F.col("_n") > 0).filter(F.col("_id").isNotNull())
    # Landed, so that the join of all documents with their classes has shuffles on both
    # sides, and AQE can split a class with very many copies.
    cls = land_table(own.groupBy("_n", "_f1", "_f2").agg(F.min(F.struct("_id", "_th")).alias("_rep"))
                     .select("_n", "_f1", "_f2", "_rep._id", "_rep._th"), "classes")
    reps = land_table(own.join(cls.select("_id", "_th"), ["_id", "_th"], "left_semi")
                      .select("_id", "_th", "_n", "_regs"), "representatives")
    pairs = land_table(candidate_pairs(reps, bands, rows), "pairs")
    # Texts of the classes that met another class.
    met = pairs.select("_id").unionByName(pairs.select(F.col("_lead").alias("_id"))).distinct()
    keyed = reps.select("_id", "_th").join(met, "_id", "left_semi").distinct()
    texts = land_table(
        docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"),
                    F.col(text_col).alias("_text")).join(keyed, ["_id", "_th"], "left_semi")
        .select("_id", "_text"), "texts")

    likely = land_table(likely_pairs(pairs, reps, pct, margin), "likely")
    links = land_table(_verified(_leader_blocks(likely), texts, shingle, pct), "links")
    comp = components(links, "_q", "_t").select(F.col("node").alias("_id"), F.col("component").alias("_comp"))

    sizes = reps.join(met, "_id", "left_semi").groupBy("_id").agg(F.max(F.struct("_n", "_regs")).alias("_r"))
    classes = land_table(sizes.select("_id", "_r._n", "_r._regs").join(comp, "_id", "left")
                         .withColumn("_comp", F.coalesce("_comp", "_id")), "met-classes")
    edges = open_edges(classes, bands, rows, pct, margin)
    family = components(edges, "_a", "_b").select(F.col("node").alias("_id"), F.col("component").alias("_family"))
    nodes = land_table(classes.select("_id", "_n", "_comp").join(family, "_id"), "family-classes")
    late = land_table(_verified(_family_blocks(nodes, pct), texts, shingle, pct), "late-links")

    members = sk.join(cls.select("_n", "_f1", "_f2", F.col("_id").alias("_cid")),
                      ["_n", "_f1", "_f2"], "left").select("_id", "_th", "_n", "_cid")
    # An id with several texts belongs to several classes: one document still.
    known = members.filter(F.col("_cid").isNotNull() & F.col("_id").isNotNull())
    twice = (known.groupBy("_id").agg(F.min("_th").alias("_t1"), F.max("_th").alias("_t2"))
             .filter("_t1 <> _t2").select("_id"))
    same = known.join(twice, "_id", "left_semi").select(F.col("_id").alias("_q"), F.col("_cid").alias("_t"))
    comp = _merged(comp, late.unionByName(same))
    return (members, links.unionByName(late).unionByName(same).distinct(),
            comp.withColumnRenamed("_id", "_cid"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, pct: int = 80, **options) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (smallest id
    reachable over links and copies, the document's own included), ``kept``."""
    members, _, comp = near_duplicate_classes(docs, id_col, text_col, shingle, pct, **options)
    found = F.when(F.col("_id").isNotNull(), F.coalesce("_comp", "_cid", "_id"))
    return members.join(comp, "_cid", "left").select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), found.alias("component_id"),
        found.eqNullSafe(F.col("_id")).alias("kept"))
