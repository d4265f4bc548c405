"""Importance resampling, filter audit and SimHash: against plain Python, on awkward rows
(nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names) and at the
limits of their structures (splitters on ties, overfull cells)."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from cadenza.llm import filter_audit, resample, simhash
from cadenza.llm import textvec as tv
from cadenza.sources.sinks import land_table
from conftest import SF_SMALL
from test_llm_operators import TEXTS, docs, empty, labels_of  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# importance resampling

def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def brute_resample(rows, target, share=25, least=20, buckets=10_000):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t)[1])
    s, t = count(x for _, x in rows), count(target)
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for i, text in rows:
        words, feats = features(text)
        weight = sum(gain(zlib.crc32(f.encode()) % buckets) for f in feats) // max(1, len(feats))
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(feats), weight, score, len(words) >= least])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(fit):
        r[4] = place + 1 if place < share * len(fit) // 100 else None
    return Counter(tuple(r[:4]) + (r[4] or None,) for r in out)


def test_resample_on_awkward_rows(spark, docs, empty):
    target = spark.createDataFrame([("two words and w1 x1",), (None,), ("",), ("É日本 word's 1st",)], "text string")
    texts = [t for (t,) in target.collect()]
    got = resample.importance_resample(docs, target, share_pct=50, min_words=5)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_resample(TEXTS, texts, 50, 5)
    assert Counter(map(tuple, resample.importance_resample(docs, target.limit(0)).collect())) \
        == brute_resample(TEXTS, [])
    assert resample.importance_resample(empty, target).count() == 0


def test_resample_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = E.queries()["op11_importance_resampling"](spark, SF_SMALL).collect()
    assert Counter(map(tuple, got)) == brute_resample(rows, target)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ09é日 -\n" + "q" * 3, max_size=130), min_size=1, max_size=4))
def test_buckets_are_crc32_of_features(texts):
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0] + [len(d) for d in data])
    bucket, doc = resample.feature_buckets(
        tv.Texts(np.frombuffer(b"".join(data), dtype=np.uint8), bounds), 2, 10_000)
    want = Counter((i, zlib.crc32(f.encode()) % 10_000) for i, t in enumerate(texts) for f in features(t)[1])
    assert Counter(zip(doc.tolist(), bucket.tolist())) == want


def test_ranks_do_not_depend_on_segments(spark):
    """Few scores, so that splitters fall on ties and on ids; repeated and null ids."""
    rng = random.Random(5)
    rows = [(rng.choice([3, 3, 3, 5, 9, -2]), rng.choice([None, *range(400)])) for _ in range(6000)]
    runs = land_table(spark.createDataFrame(rows, "_score long, _id long").repartition(5)
                      .sortWithinPartitions(F.desc("_score"), F.asc_nulls_last("_id"))
                      .withColumn("_at", F.monotonically_increasing_id()), "runs")
    want = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1]))
    for segments, upto in ((1, 6000), (7, 6000), (40, 1500), (40, 0)):
        cut = resample.regular_splitters(runs, len(rows), segments)
        assert len(cut) < segments
        got = resample.rank_runs(runs, len(rows), upto, segments).collect()
        assert Counter((r["_score"], r["_id"]) for r in got) == Counter(rows)
        ranked = sorted((r["rank"], r["_score"], r["_id"]) for r in got if r["rank"])
        assert [r[0] for r in ranked] == list(range(1, upto + 1))
        assert [r[1:] for r in ranked] == want[:upto]


def test_segments_are_even(spark):
    """Regular places of all runs cut the rows into like segments, hot score included."""
    rows = spark.range(40_000).select(F.col("id").alias("_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(5000))).cast("long").alias("_score"))
    runs = land_table(rows.repartition(6).sortWithinPartitions(F.desc("_score"), F.asc_nulls_last("_id"))
                      .withColumn("_at", F.monotonically_increasing_id()), "runs")
    keys = resample.regular_splitters(runs, 40_000, 16)
    task = resample._segment_task(keys)
    seg = runs.mapInArrow(task, "_id long, _score long, _at long, _seg int").groupBy("_seg").count().collect()
    assert len(seg) == 16 and max(r["count"] for r in seg) < 2 * 40_000 / 16


# filter audit

def brute_audit(rows, labels):
    """rows: (id, text, part)."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    items = defaultdict(list)
    for i, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = "".join(c for c, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t])) if bad)
        items[part or ""].append((fails, i in good, i in toxic))
    out = set()
    for part, docs in items.items():
        shap, body = Counter(), []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for s, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shap[f] += len(gone)
                earlier = sum(f in d[0] for d in docs) - len(gone)
                body.append((part, order, s + 1, len(left), len(gone), earlier, sum(d[0] == f for d in docs),
                             sum(d[1] for d in gone), sum(d[2] for d in gone), f))
        out |= {b[:9] + (shap[b[9]],) for b in body}
    return out


def test_audit_on_awkward_rows(spark, docs, empty):
    labels = [(8, 1, 0), (8, 1, 1), (12, None, 1), (None, 1, 1), (2, 0, 0), (17, 1, None), (999, 1, 1)]
    lab = labels_of(spark, [r + ("t", "i") for r in labels])
    labels = [r for r in labels if r[0] is not None]         # a null id matches no label
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = filter_audit.audit(docs, lab).collect()
    assert set(map(tuple, got)) == brute_audit(rows, labels) and len(got) == 600 * 3 + 600
    assert set(map(tuple, filter_audit.audit(docs, lab.limit(0)).collect())) == brute_audit(rows, [])
    assert filter_audit.audit(empty, lab).count() == 0


def test_audit_with_a_hot_text_and_many_parts(spark):
    rows = [(i, "same text #1" if i % 3 else f"own {i}", f"s{i % 700}") for i in range(2100)] + [
        (5, "same text #1", "s5"), (5, "same text #1", "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = set(map(tuple, filter_audit.audit(docs, labels_of(spark, [(7, 1, 1, "", "")])).collect()))
    assert got == brute_audit(rows, [(7, 1, 1)])


def test_removal_steps_are_a_min_plus_product():
    rng = np.random.default_rng(3)
    fails = rng.random((40, 5)) < 0.4
    orders = np.array(list(itertools.permutations(range(5))))
    step = filter_audit.removal_steps(fails, np.argsort(orders, axis=1) + 1)
    for m, k in itertools.product(range(40), range(120)):
        hit = [s + 1 for s, f in enumerate(orders[k]) if fails[m, f]]
        assert step[m, k] == hit[0] if hit else step[m, k] > 5


# SimHash

def brute_classes(nodes, links):
    """Smallest node reachable, of every node."""
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {x: root(x) for x in nodes}


def brute_fingerprint(text, n=3):
    w = WORD.findall((text or "").translate(AZ))
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_simhash(rows):
    marks = [brute_fingerprint(t) for _, t in rows]
    known = [(i, m) for (i, _), m in zip(rows, marks) if i is not None]
    nodes, some = sorted({i for i, _ in known}), sorted(set(known))
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(some, 2) if (x ^ y).bit_count() <= 2]
    comp = brute_classes(nodes, links)
    return Counter((i, f"{m:016x}", None if i is None else comp[i]) for (i, _), m in zip(rows, marks))


def test_simhash_on_awkward_rows(spark, docs, empty):
    got = simhash.simhash_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == brute_simhash(TEXTS)
    assert Counter(map(tuple, simhash.simhash_duplicates(docs, cell_rows=0).collect())) == brute_simhash(TEXTS)
    assert simhash.simhash_duplicates(empty).count() == 0


def test_simhash_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = E.queries()["op13_simhash_near_dedup"](spark, SF_SMALL).collect()
    assert Counter(map(tuple, got)) == brute_simhash(rows)


def test_very_long_text_is_counted_in_blocks():
    text = " ".join(f"w{i % 97} v{i}" for i in range(4000))
    assert simhash.fingerprint(text, block=100) == simhash.fingerprint(text) == brute_fingerprint(text)


def test_embedding_is_a_lower_bound(spark):
    rng = random.Random(11)
    pairs = [(rng.getrandbits(64) - (1 << 63), rng.getrandbits(64) - (1 << 63)) for _ in range(500)]
    pairs += [(a, a ^ (1 << rng.randrange(63))) for a, _ in pairs[:200]]
    e = spark.createDataFrame(pairs, "a long, b long").select(
        "a", "b", simhash.differing_bits(simhash.embed(F.col("a")), simhash.embed(F.col("b"))).alias("l1"))
    ones = lambda x, s: ((x >> 4 * s) & 15).bit_count()
    for r in e.collect():
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        want = sum(abs(ones(a, s) - ones(b, s)) for s in range(16))
        assert r.l1 == want <= (a ^ b).bit_count()


@pytest.mark.parametrize("cell_rows", [0, 8, 60, 10**6])
def test_links_connect_what_all_pairs_connect(spark, cell_rows):
    """Random fingerprints, chains of one and two flips, a dense ball, and the extremes."""
    rng = random.Random(2)
    marks = {0, (1 << 64) - 1, 1, 3, 7, 1 << 63, (1 << 63) | (1 << 31)}
    for _ in range(60):
        x = rng.getrandbits(64)
        marks.add(x)
        for _ in range(rng.randrange(6)):
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.6:
                x ^= 1 << rng.randrange(64)
            marks.add(x)
    ball = rng.getrandbits(64)
    marks |= {ball ^ (1 << i) ^ (1 << j) for i in range(0, 64, 5) for j in range(0, 64, 3)}
    marks = sorted(marks)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    points = spark.createDataFrame([(signed(m),) for m in marks], "_fp long")
    got = [(r["_a"], r["_b"]) for r in simhash.fingerprint_links(points, cell_rows).collect()]
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 and a != b for a, b in got)
    nodes = sorted(map(signed, marks))
    every = [(signed(a), signed(b)) for a, b in itertools.combinations(marks, 2) if (a ^ b).bit_count() <= 2]
    assert brute_classes(nodes, got) == brute_classes(nodes, every)
    if cell_rows == 10**6:
        assert {(min(p), max(p)) for p in got} == {(min(p), max(p)) for p in every}


# components and open buckets of the SetSketch operator

def test_components_in_one_and_in_many_tasks(spark, monkeypatch):
    from cadenza.llm import components as C

    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5, 5), (None, 7), (2000, 1999)]
    df = spark.createDataFrame(edges, "a long, b long")
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = brute_classes({x for e in real for x in e}, real)
    for local in (200_000, 40):
        monkeypatch.setattr(C, "LOCAL_EDGES", local)
        assert {r.node: r.component for r in C.components(df, "a", "b").collect()} == want
    assert C.components(df.limit(0), "a", "b").count() == 0


def test_families_with_a_common_header_read_no_texts(spark, monkeypatch):
    """2,000 texts that share 60 words and nothing else: no pair is verified on full sets."""
    from cadenza.llm import setsketch

    head = " ".join(f"h{i}" for i in range(60))
    docs = spark.createDataFrame([(i, head + " " + " ".join(f"x{i}y{k}" for k in range(60))) for i in range(2000)],
                                 "doc_id long, text string")
    blocks, real = [], setsketch._verified
    monkeypatch.setattr(setsketch, "_verified", lambda rows, *a: (blocks.append(rows.count()), real(rows, *a))[1])
    got = setsketch.near_duplicates(docs, shingle=4).collect()
    assert all(r.kept for r in got) and len(got) == 2000 and blocks == [0, 0]


@pytest.mark.parametrize("block", [2000, 3])
def test_chains_and_shells_of_near_copies(spark, monkeypatch, block):
    """Classes that link to each other but not to their bucket's leader; small blocks, so that
    buckets are dealt to several."""
    from cadenza.llm import setsketch
    from test_llm_operators import brute_components

    monkeypatch.setattr(setsketch, "BLOCK_TEXTS", block)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for fam in range(3):
        text = [f"{w}f{fam % 2}" for w in base]
        for i in range(40):
            if rng.random() < 0.7:
                text = list(text)
            for _ in range(rng.randrange(1, 5)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows, 4, 80))


def test_formulas_and_object_contents_are_text():
    from cadenza.llm import html_crf

    page = ("<article><p>Area <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds."
            "</p><object data='a'><p>No plug-in, see <b>table</b>.</p></object></article>")
    assert [b.text for b in html_crf.blocks(page)] == ["Area x=2 holds.", "No plug-in, see table."]
