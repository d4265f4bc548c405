"""Registered queries and the pipeline over whole tables of sf0.001: against DuckDB SQL where
there is some, else against plain Python on the same rows."""

import html
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from cadenza.llm import toxicity
from cadenza.llm.oracles import ORACLE_SQL
from cadenza.llm.tokens import encoder
from cadenza.sources.sinks import land_table
from cadenza.sources.tables import TABLES
from conftest import SF_SMALL
from test_llm_operators import brute_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(name):
    return pq.read_table(f"{SF_SMALL}/{name}.parquet").to_pydict()


@pytest.fixture(scope="module")
def texts():
    d = table("documents")
    return dict(zip(d["doc_id"], d["text"]))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def run(spark, name):
    return E.queries()[name](spark, SF_SMALL).collect()


def test_all_queries_are_registered():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    res = duck.execute(E.oracle_sql()[key])
    at = [d[0] for d in res.description]
    assert sorted(at) == cols
    want = sorted(repr([r[at.index(c)] for c in cols]) for r in res.fetchall())
    assert sorted(repr([r[c] for c in cols]) for r in df.collect()) == want


def test_quality_query(spark, texts):
    labels = dict(zip(*[table("labels")[c] for c in ("doc_id", "quality")]))
    rows = run(spark, "op3_ngram_quality")
    assert len(rows) == len(texts)
    for r in rows:
        words = WORD.findall(texts[r.doc_id])
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.kept is False if r.base_failed else True
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0 and not r.base_failed]
    assert np.mean(good) > 0.95 and np.mean(bad or [0]) < 0.2


def test_toxicity_query_on_held_out_rows(spark):
    rows = E.queries()["op4_toxicity"](spark, SF_SMALL.replace("sf0.001", "sf0.1")).collect()
    d = pq.read_table(SF_SMALL.replace("sf0.001", "sf0.1") + "/labels.parquet").to_pydict()
    labels = dict(zip(d["doc_id"], d["toxic"]))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([y == p for y, p in held]) > 0.97
    toxic = [p for y, p in held if y]
    assert np.mean(toxic) > 0.85


def leaks(texts, items, least=0.7):
    """Items whose word pairs a text mostly holds."""
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    pairs = {i: set(zip(words(t), words(t)[1:])) for i, t in items.items()}
    out = {}
    for d, t in texts.items():
        w = words(t)
        mine = set(zip(w, w[1:]))
        out[d] = {str(i) for i, p in pairs.items() if p and len(p & mine) >= least * len(p)}
    return out


def test_decontamination_query(spark, texts):
    b = table("benchmark")
    want = leaks(texts, dict(zip(b["item_id"], b["text"])))
    rows = run(spark, "op5_bm25_decontamination")
    assert {r.doc_id: set(filter(None, r.item_ids.split(","))) for r in rows} == want
    assert any(want.values()) and all(r.contaminated == bool(want[r.doc_id]) for r in rows)


def test_packing_query(spark, texts):
    enc = encoder("byte_bpe_50k.json").tokenizer
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in run(spark, "op6_hilbert_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids = enc.encode(t, add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = np.array(ids[r.start:r.start + r.length], dtype="<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(ids)
    padding = 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0


def test_token_file_query(spark, texts):
    enc = encoder("word_bpe_49k.json").tokenizer
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in run(spark, "op7_token_files")}
    at = 0
    for i in sorted(texts):
        ids = enc.encode(texts[i], add_special_tokens=False).ids + [1]
        assert got[i] == (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)


def test_page_query(spark):
    p = table("pages")
    rows = {r.page_id: r for r in run(spark, "op8_html_crf")}
    assert len(rows) == len(p["page_id"])
    for i, url, page in zip(p["page_id"], p["url"], p["html"]):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split())
                 for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(x for x in parts if x)
        assert (rows[i].text, rows[i].url, rows[i].n_chars) == (want, url, len(want))


def test_near_duplicate_query(spark, texts):
    want = brute_components(list(texts.items()), 4, 80)
    rows = run(spark, "op10_setsketch_near_dedup")
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def dedup_plain(rows):
    """Later occurrences of three-line windows, in order of id."""
    seen, out = set(), {}
    for i, t in sorted(rows.items()):
        lines, gone = t.split("\n"), set()
        for k in range(len(lines) - 2):
            win = tuple(lines[k:k + 3])
            if not "".join(win).strip(" \t\n\v\f\r"):
                continue
            if win in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(win)
        text = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        if not gone or text.strip():
            out[i] = text
    return out


def test_pipeline_against_plain_python(spark, texts):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, dict(texts)
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = land_table(stage(spark, docs, SF_SMALL), f"test-{name}")
        if name == "packing":
            break
        assert docs.columns == columns
        got = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            model = toxicity.learn(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
            match, coef = toxicity.Matcher(model["lexicon"], model["exceptions"]), np.array(model["coef"])
            kept = {i: t for i, t in kept.items()
                    if np.dot(match.features(toxicity.fold(t)), coef[1:]) + coef[0] < 0}
        elif name == "line_dedup":
            kept = dedup_plain(kept)
        elif name == "near_dedup":
            kept = {i: kept[i] for i, _, c in brute_components(list(kept.items()), 5, 80) if i == c}
        else:
            b = table("benchmark")
            found = leaks(kept, dict(zip(b["item_id"], b["text"])))
            kept = {i: t for i, t in kept.items() if not found[i]}
        assert {i: r.text for i, r in got.items()} == kept, name
        if name != "toxicity":
            assert all(r.n_chars == len(r.text) for r in got.values() if r.text != texts[r.doc_id])
    enc = encoder("byte_bpe_50k.json").tokenizer
    total = Counter()
    for r in docs.collect():
        total[r.doc_id] += r.length
    assert total == {i: len(enc.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept.items()}


def test_pipeline_stages_on_awkward_rows(spark):
    """Null ids and texts, empty texts, repeated rows and an empty table, through every stage."""
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    long = " ".join(f"word{i} of number {i * 7}" for i in range(3_000))
    rows = [(1, None), (2, ""), (3, "   "), (None, "text without an id"), (None, None), (4, long), (4, long),
            (5, long + " end"), (6, "one\n\n\n\ntwo"), (7, "a plain short text"), (7, "a plain short text")]
    fill = [c for c in real.columns if c not in ("doc_id", "text")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").select(
        F.col("doc_id").cast(real.schema["doc_id"].dataType), "text",
        *[F.lit(None).cast(real.schema[c].dataType).alias(c) for c in fill]).select(real.columns)
    # Only the near copy of the long text goes; rows that repeat an id stay together.
    kept = {"toxicity": 11, "line_dedup": 11, "near_dedup": 10, "decontamination": 10}
    for docs, want in ((odd, kept), (odd.limit(0), dict.fromkeys(kept, 0))):
        for name, stage in corpus_pipeline.STAGES:
            docs = land_table(stage(spark, docs, SF_SMALL), f"odd-{name}")
            if name == "packing":
                break
            assert docs.columns == real.columns, name
            got = Counter(r.doc_id for r in docs.collect())
            assert got.total() == want[name], name
            assert got[None] == 2 * (want[name] > 0) and got[5] == (want[name] == 11)
        n = docs.agg(F.sum("length")).first()[0] or 0
        assert (n > 0) == (want["toxicity"] > 0)
