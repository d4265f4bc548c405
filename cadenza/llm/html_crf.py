"""Main text of web pages: a linear-chain conditional random field over the leaf
blocks of the page.

Blocks. A tolerant tokenizer keeps a stack of open elements (implied ends of head, p,
li, table cells and the like included) and cuts the page into stretches of text between
block-level tags. Script, style, title and similar contents, comments and markup are
never text. Character references are decoded, white space inside a block becomes one
space, and empty blocks are dropped.

Features of a block: its element and all ancestor tags, the words of their class, id and
role attributes, its length, share of link text, end mark, and first or last place.

Model. Two labels (main text, rest), one weight per feature, and transition weights.
Weights maximise the conditional likelihood of labelled pages (forward-backward,
adaptive gradient ascent); decoding is Viterbi. Pages are labelled in two ways: a bounded
sample of the table's own pages that have exactly one ``article`` or ``main`` element
(blocks inside it, outside of nested asides and the like, are main text), each also in a
copy whose landmark is an anonymous ``div``, so that other cues are learnt; and built-in
example pages (:func:`example_pages`) with menus, notices, adverts, forms, sidebars and comments.

Defined cases: null and empty html, and pages without main text, give an empty text;
rows that repeat a page are each extracted (rows of one id are one page to train on); a table without usable pages is served by the
built-in examples. Other columns are not read.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import ship_package

# Elements of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html iframe legend li main "
    "menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style title noscript template textarea svg annotation head".split())
RAW_TAGS = frozenset("script style title textarea noscript".split())
# What a head may hold; anything else ends an open one, as </head> may be left out.
HEAD_TAGS = frozenset("head base basefont bgsound link meta noframes noscript script style template title".split())
# Start tags that end an open element of the same family.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Elements that end the search for these.
HOLDERS = frozenset("table ul ol dl div section article body".split())
SEARCHED = HOLDERS | {"p"} | {t for ends in CLOSES.values() for t in ends}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*'|[<\"'])*?)(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SUBWORD = re.compile(r"[a-z]+")
LANDMARKS = ("article", "main")
# Elements inside a landmark that are not its text.
ASIDES = frozenset("nav aside form footer header button select figure".split())


class Place:
    """An open element: tag, class words, the element around it, the innermost block element,
    and the features that no element around it has, so that a place costs what it adds."""

    __slots__ = ("tag", "words", "up", "own", "added", "total")

    def __init__(self, tag: str, words: tuple, up: Place | None, active: set):
        self.tag, self.words, self.up, self.total = tag, words, up, None
        self.own = tag if tag in BLOCK_TAGS else up.own if up else "-"
        names = [f"in:{tag}"] if tag in BLOCK_TAGS else []
        if words:
            names += dict.fromkeys(f"mark:{w}" for w in words)
        self.added = [f for f in names if f not in active]

    def chain(self) -> list[Place]:
        """The element and those around it, root first."""
        out, at = [], self
        while at is not None:
            out.append(at)
            at = at.up
        return out[::-1]

    def weigh(self, weights) -> float:
        """Sum of the weights of all features but the innermost element's."""
        todo, at = [], self
        while at is not None and at.total is None:
            todo.append(at)
            at = at.up
        total = at.total if at is not None else 0.0
        for p in reversed(todo):
            total += sum(weights(f, 0.0) for f in p.added)
            p.total = total
        return total


class Block:
    __slots__ = ("text", "place", "linked")

    def __init__(self, text: str, place: Place | None, linked: float):
        self.text, self.place, self.linked = text, place, linked

    @property
    def path(self) -> tuple:
        """Block tags from the root."""
        return tuple(p.tag for p in (self.place.chain() if self.place else ()) if p.tag in BLOCK_TAGS)

    @property
    def marks(self) -> tuple:
        """Class words of the element and all around it."""
        return tuple(w for p in (self.place.chain() if self.place else ()) for w in p.words)


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order: text, place among the open elements, and the share of
    characters inside links. Time is linear in the page, however deep its nesting."""
    out: list[Block] = []
    # Open elements: tag, place (an inline one without class words has that around it), whether
    # the place is its own, the last element that may end a search.
    stack: list[tuple[str, Place | None, bool, int]] = []
    active: set[str] = set()                  # features of the open elements
    open_tags: Counter = Counter()
    parts: list[str] = []
    linked, hidden, links = 0, 0, 0
    at = 0

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join(_html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, stack[-1][1] if stack else None,
                                 min(1.0, linked / max(1, len(text)))))
            parts, linked = [], 0

    def close_to(k: int):
        nonlocal hidden, links
        if any(e[0] in BLOCK_TAGS for e in stack[k:]):
            flush()
        for t, place, own, _ in stack[k:]:
            hidden -= t in HIDDEN_TAGS
            links -= t == "a"
            open_tags[t] -= 1
            if own:
                active.difference_update(place.added)
        del stack[k:]

    size = len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if found is None or found.start() > at:
            text = page[at:found.start() if found else size]
            if stack and stack[-1][0] == "head" and text.strip():
                close_to(len(stack) - 1)
            if not hidden:
                parts.append(text)
                if links:
                    linked += len(text)
        if found is None:
            break
        at = max(found.end(), found.start() + 1)
        tag = found.group(2)
        if not tag:
            continue
        tag = tag.lower()
        if found.group(1):
            if open_tags[tag] > 0:
                close_to(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
            elif tag in BLOCK_TAGS:
                flush()
            continue
        if tag not in HEAD_TAGS and stack and stack[-1][0] == "head":
            close_to(len(stack) - 1)
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
            # A block ends an open paragraph, and list items and cells end their like.
            family = CLOSES.get(tag, ())
            k = stack[-1][3] if stack else -1
            while k >= 0:
                open_tag = stack[k][0]
                below = stack[k - 1][3] if k else -1
                if open_tag == "p" or open_tag in family:
                    close_to(k)
                    if open_tag != "p":
                        break
                elif open_tag in HOLDERS:
                    break
                k = below
        if tag in VOID_TAGS or found.group(3).rstrip().endswith("/") and tag in HIDDEN_TAGS:
            continue
        attrs = found.group(3)
        marks = tuple(w for m in _ATTR.finditer(attrs)
                      for w in _SUBWORD.findall((m[2] or m[3] or m[4] or "").lower())) if attrs else ()
        place = stack[-1][1] if stack else None
        own = bool(marks) or tag in BLOCK_TAGS
        if own:
            place = Place(tag, marks, place, active)
            active.update(place.added)
        open_tags[tag] += 1
        stack.append((tag, place, own, len(stack) if tag in SEARCHED else stack[-1][3] if stack else -1))
        hidden += tag in HIDDEN_TAGS
        links += tag == "a"
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            close_to(len(stack) - 1)
    flush()
    return out


def text_features(block: Block, first: bool, last: bool) -> list[str]:
    n = len(block.text)
    return [f"size:{min(7, int(math.log2(n + 1)) // 2)}", f"linked:{int(block.linked * 3)}",
            "end:mark" if block.text[-1] in ".!?…\"'”)»" else "end:open",
            "commas" if block.text.count(",") > 1 else "plain"] + ["first"] * first + ["last"] * last


def features(items: list[Block]) -> list[list[str]]:
    """All features of each block (for training; :func:`emissions` needs no lists)."""
    out = []
    for i, b in enumerate(items):
        chain = b.place.chain() if b.place else []
        out.append([f for p in chain for f in p.added] + [f"own:{b.place.own if b.place else '-'}"]
                   + text_features(b, i == 0, i == len(items) - 1))
    return out


def emissions(items: list[Block], weights: dict[str, float]) -> list[float]:
    """Score of main text over the rest for each block; places are weighed once."""
    get, last = weights.get, len(items) - 1
    return [(b.place.weigh(get) if b.place else 0.0) + get(f"own:{b.place.own if b.place else '-'}", 0.0)
            + sum(get(f, 0.0) for f in text_features(b, i == 0, i == last)) for i, b in enumerate(items)]


def viterbi(emit: list[float], trans: list[list[float]]) -> list[int]:
    """Best labels of a chain; ``emit[i]`` is the score of label 1 over label 0."""
    if not emit:
        return []
    s0, s1, back = 0.0, emit[0], []
    for e in emit[1:]:
        a0, b0 = s0 + trans[0][0], s1 + trans[1][0]
        a1, b1 = s0 + trans[0][1], s1 + trans[1][1]
        back.append((b0 > a0, b1 > a1))
        s0, s1 = max(a0, b0), max(a1, b1) + e
    label, out = int(s1 > s0), []
    for step in reversed(back):
        out.append(label)
        label = int(step[label])
    out.append(label)
    return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 200, rate: float = 0.1,
          ridge: float = 1e-3, least: int = 3) -> dict:
    """Weights ``{feature: weight}`` and 2 x 2 transitions from labelled pages.
    All pages are padded to one length, so each step handles all of them."""
    pages = [p for p in pages if p[0]]
    seen = Counter(f for feats, _ in pages for fs in feats for f in set(fs))
    names = [f for f, c in sorted(seen.items()) if c >= least]
    number = {f: i for i, f in enumerate(names)}
    n, longest = len(pages), max(len(p[1]) for p in pages)
    size = np.array([len(p[1]) for p in pages])
    real = np.arange(longest)[None, :] < size[:, None]
    label = np.zeros((n, longest), dtype=int)
    cell, feat = [], []
    for k, (feats, labels) in enumerate(pages):
        label[k, :len(labels)] = labels
        for i, fs in enumerate(feats):
            known = [number[f] for f in set(fs) if f in number]
            cell += [k * longest + i] * len(known)
            feat += known
    cell, feat = np.array(cell), np.array(feat)
    follows = real[:, 1:]
    counts = np.zeros((2, 2))
    np.add.at(counts, (label[:, :-1][follows], label[:, 1:][follows]), 1)
    theta = np.zeros(len(names) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        emit = np.zeros((n, longest, 2))
        emit[:, :, 1] = np.bincount(cell, w[feat], n * longest).reshape(n, longest)
        fore, back = emit.copy(), np.zeros_like(emit)
        for i in range(1, longest):
            step = emit[:, i] + np.logaddexp(fore[:, i - 1, :1] + trans[0], fore[:, i - 1, 1:] + trans[1])
            fore[:, i] = np.where(real[:, i, None], step, fore[:, i - 1])
        for i in range(longest - 2, -1, -1):
            nxt = emit[:, i + 1] + back[:, i + 1]
            step = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
            back[:, i] = np.where(real[:, i + 1, None], step, 0.0)
        z = np.logaddexp(fore[:, -1, 0], fore[:, -1, 1])
        p1 = np.where(real, np.exp(fore[:, :, 1] + back[:, :, 1] - z[:, None]), 0.0)
        pair = np.exp(fore[:, :-1, :, None] + trans + (emit + back)[:, 1:, None, :] - z[:, None, None, None])
        grad = np.concatenate([
            np.bincount(feat, (label - p1).reshape(-1)[cell], len(names)),
            (counts - np.where(follows[:, :, None, None], pair, 0.0).sum((0, 1))).reshape(-1)])
        grad = grad / n - ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return {"weights": dict(zip(names, theta[:-4].tolist())), "transitions": theta[-4:].reshape(2, 2).tolist()}


def landmark_pages(page: str) -> list[tuple[list[list[str]], list[int]]]:
    """A page labelled by its only landmark, and the same page without it."""
    for mark in LANDMARKS:
        if len(re.findall(rf"<{mark}\b", page, re.I)) == 1:
            break
    else:
        return []

    def label(b: Block) -> int:
        if mark not in b.path:
            return 0
        return int(not ASIDES & set(b.path[b.path.index(mark) + 1:]))

    items = blocks(page)
    labels = [label(b) for b in items]
    plain = blocks(re.sub(rf"(</?){mark}\b", r"\1div", page, flags=re.I))
    out = [(features(items), labels)]
    if len(plain) == len(items):
        out.append((features(plain), labels))
    return out


def example_pages() -> list[tuple[list[list[str]], list[int]]]:
    """Built-in labelled pages: for each kind of page furniture, an article in one of
    several containers, with the furniture before, inside or after it."""
    long = ("Long sentences, with commas, make up the text of a page, and they go on for a while until "
            "the point is made. Another follows, and it is as long as the first one was, or longer.")
    short = "See also this"
    body = (f"<h1>{short}</h1><p>{long}</p><p>{long}</p><h2>{short}</h2><p>{long}</p>"
            f"<ul><li>{long}</li><li>{long}</li></ul><blockquote><p>{long}</p></blockquote><p>{long}</p>"
            f"<p>{short}.</p><p>{long}</p>")
    holders = [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"),
               ('<div id="main-content"><div class="post body text">', "</div></div>"),
               ('<div class="article entry story">', "</div>"), ("<div>", "</div>"),
               ('<main><article class="post">', "</article></main>"), ('<section role="main">', "</section>")]
    links = "".join(f'<li><a href="/{i}">{short}</a></li>' for i in range(6))
    words = {"nav": f"<ul>{links}</ul>", "text": f"<p>{short}</p><p>{long}</p>", "line": f"{long}",
             "short": f"{short}"}
    shapes = [("nav", "", "nav"), ("header", "", "short"), ("header", "site-header banner", "text"),
              ("footer", "", "line"), ("footer", "", "short"), ("div", "footer", "text"), ("aside", "", "text"),
              ("aside", "sidebar", "nav"), ("div", "sidebar widget", "text"), ("div", "menu", "nav"),
              ("ul", "breadcrumb nav", "short"), ("div", "ad", "line"), ("div", "ads advert advertisement", "text"),
              ("div", "sponsored promo banner", "text"), ("div", "cookie notice consent", "text"),
              ("div", "alert warning notice", "line"), ("form", "", "text"), ("form", "search newsletter", "short"),
              ("section", "comments", "text"), ("div", "comment reply", "line"), ("ol", "comment-list", "text"),
              ("div", "related recommended", "nav"), ("div", "share social", "nav"), ("div", "popup modal", "text"),
              ("div", "subscribe signup", "line"), ("div", "header", "text"), ("div", "copyright legal", "short"),
              ("div", "tags meta byline", "nav")]
    out = []
    for h, (left, right) in enumerate(holders):
        for s, (tag, mark, kind) in enumerate(shapes):
            attr = f' class="{mark}"' if mark else ""
            junk = f'<{tag}{attr} data-junk="1">{words[kind]}</{tag}>'
            text = body
            where = (h + s) % 3
            if where == 1 and "<nav" not in junk:
                text = body.replace("<h2>", junk + "<h2>", 1)
            page = (f"<html><body>{junk if where == 0 else ''}<nav><ul>{links}</ul></nav>"
                    f"{left}{text}{right}{junk if where == 2 else ''}<footer>{short}</footer></body></html>")
            # The junk's blocks are known by a word that is taken out again.
            spotted = blocks(re.sub(r'( data-junk="1")', r'\1 role="zzjunk"', page))
            items = blocks(page)
            outside = [not set(b.path) & {"nav", "footer"} for b in spotted]
            out.append((features(items), [int(o and "zzjunk" not in b.marks)
                                          for o, b in zip(outside, spotted)]))
    return out


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
          train_pages: int = 200) -> dict:
    """The model, from at most ``train_pages`` pages in order of a hash of the
    id (a documented bound) and the built-in examples."""
    low = F.lower(F.col("_html"))
    usable = low.contains("<article") | low.contains("<main")
    every = pages.select(F.xxhash64(id_col).alias("_k"), F.col(html_col).alias("_html"))
    # Only hashes of ids are ranked; html is fetched for the chosen ids alone, one page each.
    chosen = every.filter(usable).select("_k").distinct().orderBy("_k").limit(train_pages)
    rows = (every.join(F.broadcast(chosen), "_k").groupBy("_k")
            .agg(F.min(F.when(usable, F.col("_html"))).alias("_html")).orderBy("_k").collect())
    labelled = [x for r in rows for x in landmark_pages(r["_html"])]
    return train(labelled + example_pages())


def main_text(page: str | None, model: dict) -> str:
    """Blocks that Viterbi labels as main text, joined by line feeds."""
    items = blocks(page or "")
    emit = emissions(items, model["weights"])
    return "\n".join(b.text for b, y in zip(items, viterbi(emit, model["transitions"])) if y)


def extract(pages: DataFrame, model: dict, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` with the html replaced by its main text, as ``text``."""
    ship_package(pages.sparkSession)
    keep = [c for c in pages.columns if c != html_col and c != "text"]
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(x.as_py(), model) for x in batch.column(html_col)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(texts, pa.string())],
                                             names=keep + ["text"])
    return pages.mapInArrow(run, (schema + ", " if schema else "") + "text string")
