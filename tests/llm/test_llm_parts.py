"""The operators' building blocks against plain Python."""

import itertools
import math
import random
import re
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cadenza.llm import decontam, html_crf, packing, quality, setsketch, toxicity, warc
from cadenza.llm import textvec as tv
from cadenza.llm.quality import text_rules
from cadenza.llm.tokens import binary_rows, encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, " ", "\n\n", "a", "a b", "É é x", "one  two\tthree\r\nfour", "x" * 5000,
       "a b c a b c a b c", "# * $ % & | < >", "l1\n\nl1\nl2\n l1\nl1", "日本 語。 日本", "😀 a 😀 a 😀 a",
       "tail ", "A-Z a-z", "don't 's It's we're..'s", "“q” ’s it’s", "\x1c a  b", "　 x  y"]


def texts_of(values):
    (row, texts), = tv.slices(pa.array(values))
    assert row == 0
    return texts


def some_texts(n=60, seed=5):
    rng = random.Random(seed)
    words = ["the", "of", "And", "tion", "x.", "a,", "b\nc", "é", "zz", "Q!"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


def test_words_and_slices():
    values = ODD + some_texts()
    got = []
    for _, texts in tv.slices(pa.array(values), max_bytes=200):
        texts.split()
        for i in range(texts.n):
            a, b = texts.first[i], texts.first[i + 1]
            got.append([bytes(texts.data[s:e]).decode() for s, e in zip(texts.start[a:b], texts.end[a:b])])
    assert got == [WORD.findall(v or "") for v in values]


def test_word_hash_is_equal_for_equal_words_only():
    texts = texts_of(["Ab cd ab", "cd AB"]).split()
    plain, folded = texts.word_hash(), texts.word_hash(tv.LOWER)
    assert plain[1] == plain[3] and len(set(plain.tolist())) == 4
    assert folded[0] == folded[2] == folded[4] and len(set(folded.tolist())) == 2


def test_text_rules_against_plain_python():
    values = ODD + some_texts()
    got = text_rules(texts_of(values).split())
    for i, v in enumerate(values):
        v = v or ""
        words = WORD.findall(v)
        lines = [x for x in v.split("\n") if WORD.search(x)]
        grams = list(zip(words, words[1:], words[2:]))
        inside = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", v)),
                len(lines) - len(set(lines)), len(inside))
        assert tuple(int(got[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                              "n_repeat_words")) == want, repr(v[:40])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_tokenizers(name):
    enc = encoder(name)
    values = ODD + some_texts()
    for _ in range(2):                        # new pieces, then cached ones
        texts = texts_of(values)
        ids, bounds = enc.encode(texts)
        for i, v in enumerate(values):
            want = enc.tokenizer.encode(v or "", add_special_tokens=False).ids
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want, repr(v)
    ids, bounds = enc.encode_with_end(texts, 7)
    assert ids[bounds[1:] - 1].tolist() == [7] * len(values)
    rows = binary_rows(ids, bounds, 4)
    assert rows[3].as_py() == ids[bounds[3]:bounds[4]].astype("<u4").tobytes()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_in_a_text_are_taken_as_such(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(public_tokenizers.path(name))
    values = ODD + ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y, z.", "<|endoftext|", "|>",
                    "one, two <|startoftext|>Three<|endoftext|>\n\nfour", "<|EndOfText|> é", "a", "<|endoftext|>"]
    enc = encoder(name)
    for _ in range(2):
        ids, bounds = enc.encode(texts_of(values))
        for i, v in enumerate(values):
            want = fresh.encode(v or "", add_special_tokens=False).ids
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want, repr(v)
    token = fresh.token_to_id("<|endoftext|>")
    assert ids[bounds[-2]:].tolist() == [token] and token in ids[bounds[len(ODD)]:bounds[len(ODD) + 1]]


def test_shingle_sets_against_plain_python():
    values = ODD + some_texts()
    hashes, bounds = setsketch.shingle_sets(texts_of(values), 4)
    sets = []
    for v in values:
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(v or "")]
        sets.append({tuple(words[k:k + 4]) for k in range(len(words) - 3)} if len(words) > 3
                    else {tuple(words)} - {()})
    assert np.diff(bounds).tolist() == [len(s) for s in sets]
    for i, j in itertools.combinations(range(0, len(values), 3), 2):
        both = np.intersect1d(hashes[bounds[i]:bounds[i + 1]], hashes[bounds[j]:bounds[j + 1]])
        assert len(both) == len(sets[i] & sets[j])


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    m = 200
    for share in (0.5, 0.8, 0.95):
        n = 600
        k = int(round(2 * n * share / (1 + share)))
        pool = rng.integers(0, 1 << 52, 2 * n - k, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[n - k:])
        regs = [setsketch.registers(x, np.array([0, len(x)]), m) for x in (a, b, np.unique(pool))]
        assert (np.maximum(regs[0], regs[1]) == regs[2]).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = setsketch.likelihood_jaccard(regs[0], regs[1], np.array([float(len(a))]),
                                           np.array([float(len(b))]))[0]
        assert abs(got - true) < 0.1
    assert not setsketch.registers(np.zeros(0, np.uint64), np.array([0, 0]), m).any()


def test_hilbert_neighbours_are_adjacent_cells():
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.array(list(itertools.product(range(side), repeat=dims)))
        order = np.argsort(packing.hilbert_key(cells, bits))
        assert sorted(packing.hilbert_key(cells, bits).tolist()) == list(range(side ** dims))
        assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()


def test_wand_returns_all_entries_above_threshold():
    rng = np.random.default_rng(8)
    entries = [(str(i), 5, rng.integers(1, 60, rng.integers(5, 30)).astype(np.uint64)) for i in range(80)]
    df = {}
    for e in entries:
        for t in np.unique(e[2]).tolist():
            df[t] = df.get(t, 0) + 1
    index = decontam.Index(entries, df, len(entries), float(np.mean([len(e[2]) for e in entries])))
    dense = np.zeros((len(index.terms), len(entries)))
    for t, (a, b) in enumerate(zip(index.bounds[:-1], index.bounds[1:])):
        dense[t, index.entry[a:b]] = index.weight[a:b]
    for _ in range(60):
        query = np.unique(rng.integers(0, len(index.terms), rng.integers(1, 30)))
        for threshold in (0.2, 0.5, 0.9):
            scores = dense[query].sum(0)
            want = {(int(e), round(float(scores[e]), 9)) for e in np.flatnonzero(scores >= threshold)}
            got = index.wand(query.tolist(), threshold)
            assert {(e, round(s, 9)) for e, s in got} == want
            reach = index.may_reach(np.zeros(len(query), int), query, 1, threshold)
            assert len(reach) or not want


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 8):
        emit, trans = rng.normal(size=n), rng.normal(size=(2, 2))
        best = max(itertools.product((0, 1), repeat=n), key=lambda y: sum(e * v for e, v in zip(emit, y))
                   + sum(trans[a][b] for a, b in zip(y, y[1:])))
        assert html_crf.viterbi(emit.tolist(), trans.tolist()) == list(best)
    assert html_crf.viterbi([], [[0, 0], [0, 0]]) == []


def test_blocks_of_awkward_pages():
    page = ("<html><head><title>t</title><script>var a='</p>';</script></head><body><!-- no --><p>one <b>two"
            "<br>three &amp; &lt;x&gt;<p>four\n\n five<ul><li>a<li>b</ul><div>a < b</div><p title='x>y'>z")
    assert [b.text for b in html_crf.blocks(page)] == [
        "one two three & <x>", "four five", "a", "b", "a < b", "z"]
    for broken in ("", "<", "<p", "</", "<!--", "<a href=\"x>y</a><p>t", "<script>", "&amp", "<p></p>"):
        html_crf.blocks(broken)


def test_head_without_end_tag():
    rest = "<article><h1>Head</h1><p>one</p></article>"
    for head in ("<title>T</title><body>", "<title>T</title>", "<meta charset=utf-8><body class='x'>", "<style>p {}</style>",
                 "<script>1</script></head><body>", "<template><div>no</div></template>\n"):
        assert [b.text for b in html_crf.blocks(f"<html><head>{head}{rest}</html>")] == ["Head", "one"], head
    assert [b.text for b in html_crf.blocks("<head><title>T</title>bare <b>text</b><p>one")] == ["bare text", "one"]
    assert [b.text for b in html_crf.blocks("<head><title>T</title><a href='/'>link</a><p>one")] == ["link", "one"]


def test_crf_learns_page_furniture():
    model = html_crf.train(html_crf.example_pages())
    page = ("<body><header class='site'>Site name</header><div class='cookie notice'>We use cookies, here and there,"
            " on every page you read.</div><div class='content'><h1>Head</h1><p>A sentence of the article, long "
            "enough to look like text, and it ends here.</p><p>Another sentence of the article, long enough too, "
            "ends here.</p></div><div class='comments'><p>I am a reader, and I think so too, always.</p></div>"
            "<footer>&copy; Us</footer></body>")
    assert html_crf.main_text(page, model).split("\n")[1:] == [
        "A sentence of the article, long enough to look like text, and it ends here.",
        "Another sentence of the article, long enough too, ends here."]
    assert html_crf.main_text(None, model) == "" == html_crf.main_text("", model)


def test_fold_and_matcher():
    assert toxicity.fold("You 1D10T, сlоwn!") == " you idiot ciown "
    assert toxicity.fold(None) == "  " and toxicity.fold("lo$er") == " ioser "
    match = toxicity.Matcher({toxicity.fold("clown"): 2.0, " scu": 1.0}, [toxicity.fold("clown fish")])
    found = lambda t: [match.terms[h[0]] for h in match.hits(toxicity.fold(t))]
    assert found("a C10WN and scumbag") == [" ciown ", " scu"]
    assert found("clown fish") == [] and found("clowns") == []
    assert toxicity.Matcher({}).hits(" a ") == []


def test_logistic_fit_separates():
    x = np.array([[0.0], [0.1], [0.2], [1.0], [1.1], [1.3]])
    coef = toxicity.fit_logistic(x, np.array([0, 0, 0, 1, 1, 1.0]))
    assert ((x @ coef[1:] + coef[0] > 0) == [0, 0, 0, 1, 1, 1]).all()
    assert toxicity.fit_logistic(np.zeros((0, 5)), np.zeros(0))[0] < -20


def test_records_split_from_one_stream():
    records = [warc.warc_record("response", str(i), None if i else "http://x/\n", "d", len(p), p, None, "now")
               for i, p in enumerate([b"", b"a" * 70_000, b"\r\n\r\nWARC/1.1\r\n", "é".encode()])]
    import io

    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    one = pack.compress(b"".join(records)) + pack.flush()
    members = b"".join(__import__("gzip").compress(r) for r in records)
    for raw in (one, members):
        assert list(warc.split_records(warc.inflate(io.BytesIO(raw), 1000))) == records
    with pytest.raises(ValueError):
        list(warc.split_records([records[1][:500]]))


def naive_fold(text):
    """Folding, character by character."""
    visible = [c for c in unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text or "").lower())
               if not any(a <= ord(c) <= b for a, b in toxicity.DIACRITICS)
               and unicodedata.category(c) != "Cf"]
    word = lambda c: c.isalnum() or c == "_"
    for mark, letter in (("$", "s"), ("!", "i")):
        for i, c in enumerate(visible):
            before = i > 0 and word(visible[i - 1])
            after = i + 1 < len(visible) and word(visible[i + 1])
            if c == mark and after and (
                    before and (mark == "$" or visible[i + 1] != "_")
                    or mark == "$" and not visible[i + 1].isdecimal() and visible[i + 1] != "_"):
                visible[i] = letter
    out = []
    for c in visible:
        c = toxicity.LOOKALIKES.get(c, "" if c in "'\u2018\u2019" else c)
        if c and (c.isascii() and not c.isalnum() or unicodedata.category(c)[0] in "PSZ"):
            c = " "
        out.append("i" if c == "l" else c)
    return " " + " ".join("".join(out).split()) + " "


def naive_hits(folded, lexicon, exceptions):
    """Every place of every term outside of all exceptions, by plain search."""
    places = lambda p: [i for i in range(len(folded)) if folded.startswith(p, i)]
    covered = {i for p in exceptions if p not in lexicon for a in places(p) for i in range(a, a + len(p) - 1)}
    return sorted((t, i) for t in lexicon for i in places(t) if i not in covered)


def test_fold_and_automaton_against_plain_search():
    rng = random.Random(11)
    words = ["clown", "scum", "fish", "$cum", "sc\u200bum", "c1own", "cl\u043ewn", "scu", "a$b", "cl!own", "x!", "$5",
             "sc\u00famy", "\U0001d564cum", "\uff23lown", "'clown'", "\u201cscum\u201d", "!", "_$_", "\n", ""]
    lexicon = {toxicity.fold("clown"): 2.0, " scu": 1.0, toxicity.fold("fish"): 0.5}
    exceptions = [toxicity.fold("clown fish"), toxicity.fold("fish clown fish"), toxicity.fold("scum a")]
    match = toxicity.Matcher(lexicon, exceptions)
    for _ in range(400):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        folded = toxicity.fold(text)
        assert folded == naive_fold(text), text
        hits = match.hits(folded)
        want = naive_hits(folded, lexicon, exceptions)
        assert sorted((match.terms[t], first) for t, first, _ in hits) == want, folded
        weight = sum(lexicon[t] for t, _ in want)
        got = match.features(folded)
        assert got[0] == pytest.approx(weight / (len(folded.split()) + 20.0))
        assert got[3] == max((lexicon[t] for t, _ in want), default=0.0)


def test_folded_spellings():
    for text in ("$tupid", "st\u00fap1d", "st\u200bupid", "\U0001d564tupid", "\uff33TUPID", "s\u0442upid", "stup!d"):
        assert toxicity.fold(text) == toxicity.fold("stupid"), text
    assert toxicity.fold("stop! It is $5") == toxicity.fold("stop it is 5")


def test_many_excused_hits_take_linear_time():
    match = toxicity.Matcher({toxicity.fold("clown"): 2.0}, [toxicity.fold("clown fish")])
    folded = toxicity.fold("clown fish " * 16_000 + "clown")
    begin = time.time()
    assert [first for _, first, _ in match.hits(folded)] == [16_000 * 11]
    assert time.time() - begin < 3


def test_deep_pages_take_linear_time():
    page = "".join(f"<div class='c{i} deep'>x{i}" for i in range(4_000))
    begin = time.time()
    items = html_crf.blocks(page)
    emit = html_crf.emissions(items, {"in:div": 1.0, "own:div": 0.5, "mark:c": 0.25, "mark:deep": 2.0})
    assert len(items) == 4_000 and emit[-1] == emit[0] == 3.75
    assert len(html_crf.blocks("<p>" + "<b>" * 4_000 + "<h2>x</h2></i>" * 4_000)) == 4_000
    assert time.time() - begin < 5


def test_place_weights_equal_the_feature_lists():
    rng = random.Random(3)
    tags = ["div", "p", "span", "ul", "li", "a", "article", "b", "td"]
    weights = {f"{k}:{t}": rng.random() for k in ("in", "own") for t in tags} | {
        "mark:x": 0.3, "mark:y": -0.7, "own:-": 0.1, "end:open": 0.2, "first": 1.0}
    for _ in range(100):
        page = "".join(rng.choice([f"<{(t := rng.choice(tags))} class='{rng.choice('xyz')}'>", f"</{t}>", "word "])
                       for _ in range(60))
        items = html_crf.blocks(page)
        want = [sum(weights.get(f, 0.0) for f in fs) for fs in html_crf.features(items)]
        assert html_crf.emissions(items, weights) == pytest.approx(want)
        for b, fs in zip(items, html_crf.features(items)):
            assert {f for f in fs if f[:3] in ("in:", "mar")} == {f"in:{t}" for t in b.path} | {
                f"mark:{w}" for w in b.marks}


def test_bound_in_stretches_equals_the_dense_sum(monkeypatch):
    rng = np.random.default_rng(5)
    entries = [(str(i), 3, rng.integers(1, 400, rng.integers(4, 20)).astype(np.uint64)) for i in range(300)]
    df = {}
    for e in entries:
        for t in np.unique(e[2]).tolist():
            df[t] = df.get(t, 0) + 1
    index = decontam.Index(entries, df, len(entries), 12.0)
    key = np.unique(rng.integers(0, 50 * len(index.terms), 900))
    passage, term = key // len(index.terms), key % len(index.terms)
    dense = np.zeros((50, index.n_blocks))
    for p, t in zip(passage, term):
        a, b = index.block_at[t], index.block_at[t + 1]
        dense[p, index.blocks[a:b]] += index.block_max[a:b]
    for threshold in (0.3, 0.5, 0.8):
        want = np.flatnonzero((dense >= threshold - 1e-9).any(1)).tolist()
        for cells in (1, 40, 1_000, 1 << 20):
            monkeypatch.setattr(decontam, "CELLS", cells)
            assert index.may_reach(passage, term, 50, threshold).tolist() == want


def test_log_ratio_score_against_plain_python():
    """Normalised log ratio of byte 4-grams and word pairs, n-gram by n-gram."""
    texts = ["good words make good texts", "spam spam spam!", "", "a", "good spam \u00e9t\u00e9", "words make sense here"]
    trusted = [True, False, False, False, False, True]
    half = quality.BUCKETS // 2

    def buckets(text):
        data = text.encode()
        low = []
        for i in range(len(data) - 3):
            code = 0
            for byte in data[i:i + 4]:
                code = (code * 0x01000193 + byte) & 0xFFFFFFFF
            low.append(((code * 0x9E3779B1) & 0xFFFFFFFF) >> 17)
        return low

    def pairs(text):
        return list(zip(text.split(), text.split()[1:]))

    # A pair's bucket is a hash of the operator's; which pairs share one is all that counts.
    bucket_of = {}
    for t in texts:
        for _, part in tv.slices(pa.array([t])):
            part.split()
            _, got, _ = quality.gram_buckets(part, 4)
            assert len(got) == len(pairs(t)) and (got >= half).all()
            bucket_of |= dict(zip(pairs(t), got.tolist()))
    grams = [buckets(t) + [bucket_of[p] for p in pairs(t)] for t in texts]
    raw, good = Counter(), Counter()
    for g, ok in zip(grams, trusted):
        raw.update(g)
        good.update(g if ok else [])
    ratio = {}
    for low in (True, False):
        mine = [b for b in raw if (b < half) == low]
        total, fine = sum(raw[b] for b in mine), sum(good[b] for b in mine)
        ratio |= {b: math.log((good[b] + 1) / (fine + half)) - math.log((raw[b] + 1) / (total + half))
                  for b in mine}
    want = [sum(ratio[b] for b in g) / max(len(g), 1) for g in grams]

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array(trusted)],
                                       names=["_id", "_text", "_trusted"])
    (counted,) = quality._count_task(4)([batch])
    assert dict(zip(counted["bucket"].to_pylist(), counted["raw"].to_pylist())) == dict(raw)
    assert {b: c for b, c in zip(counted["bucket"].to_pylist(), counted["trusted"].to_pylist()) if c} == dict(good)
    table = np.zeros(quality.BUCKETS)
    table[list(ratio)] = list(ratio.values())
    scored = [r for out in quality._score_task(4, table, rules=False)([batch]) for r in out.to_pylist()]
    assert [r["_id"] for r in scored] == list(range(len(texts)))
    assert [r["score"] for r in scored] == pytest.approx(want)
