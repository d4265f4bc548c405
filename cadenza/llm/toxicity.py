"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton.

Folding. Texts are brought to compatibility decomposition (full-width and mathematical
letters become plain ones) and lower-cased; diacritics and invisible format characters
go; letters of other scripts that look like Latin ones, the digits used for letters, a
dollar sign before a letter and an exclamation mark between letters are folded to letters
(1, i and l fall together, as 1 stands for both); other marks become spaces.

Learning, from labelled rows outside the held-out fold, at most ``train_rows`` of
them in order of a hash of the id (a documented bound). Candidate terms are whole
words and word beginnings of 4 to 8 letters. Spark counts in how many toxic and other
texts each occurs; terms that stand out (likelihood ratio statistic of at
least ``min_g2``) get the log of their rate ratio as weight; of terms that
contain each other the clearest stays; at most ``max_terms`` are kept.
Exception phrases are a hit with its neighbouring word that several harmless
texts hold and no toxic one. A logistic model with the features of
:data:`FEATURES` turns matches into a score.

Scoring. One automaton holds terms and exceptions; a hit inside an exception is
ignored. Matches are weighted, summed and normalised by the number of words.

Labels, language, source and id are no input of a score. Defined cases: null and empty texts
have no match and get the score of a text without words; without any toxic training
row every score is the share of toxic rows, 0; several labels of one id count as toxic if one is;
rows that repeat an id get their own scores. Other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import ship_package
from cadenza.sources.sinks import land_table

# Characters that look like, or stand for, Latin letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ӏ": "l", "ԛ": "q",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "һ": "h", "ѵ": "v", "ѡ": "w",
    "ԝ": "w", "ғ": "f", "ь": "b", "г": "r", "ո": "n", "ս": "u", "օ": "o", "հ": "h", "ց": "g",
    "γ": "y", "ω": "w", "σ": "o", "ϲ": "c", "ϳ": "j", "ø": "o", "đ": "d", "ħ": "h", "ł": "l",
    "ŧ": "t", "ɩ": "i", "ʏ": "y", "ʀ": "r", "ɴ": "n", "ɪ": "i", "ʟ": "l", "ᴀ": "a", "ᴇ": "e", "ᴏ": "o",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a",
}
FEATURES = ("weight per word", "log of weight", "log of distinct terms", "largest weight")
# Blocks of combining diacritical marks.
DIACRITICS = ((0x0300, 0x036F), (0x0483, 0x0489), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF),
              (0x20D0, 0x20FF), (0xFE20, 0xFE2F))
_DOLLAR = re.compile(r"\$(?=[^\W\d_])|(?<=\w)\$(?=\w)")
_BANG = re.compile(r"(?<=\w)!(?=[^\W_])")


class _Visible(dict):
    """Translation without diacritics and format characters, filled as characters come up."""

    def __missing__(self, code: int) -> str:
        gone = (any(a <= code <= b for a, b in DIACRITICS)
                or unicodedata.category(chr(code)) == "Cf")
        self[code] = "" if gone else chr(code)
        return self[code]


class _Fold(dict):
    """Translation to folded letters; marks and white space of other scripts become spaces."""

    def __missing__(self, code: int) -> str:
        self[code] = " " if unicodedata.category(chr(code))[0] in "PSZ" else chr(code)
        return self[code]


def _table() -> _Fold:
    table = {c: " " for c in range(128) if not chr(c).isalnum()}
    table |= {ord(a): b for a, b in LOOKALIKES.items()}
    table |= {ord(c): "" for c in "'\u2018\u2019"}
    # One class for i, l and 1.
    table = {c: "i" if v == "l" else v for c, v in table.items()}
    table[ord("l")] = "i"
    return _Fold(table)


_VISIBLE, _FOLD = _Visible(), _table()


def fold(text: str | None) -> str:
    """Folded words of a text, with a space before, between and after them."""
    text = text or ""
    if text.isascii():
        text = text.lower()
    else:
        # Decomposed again: lower case may bring combining marks of its own.
        text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text).lower()).translate(_VISIBLE)
    if "$" in text:
        text = _DOLLAR.sub("s", text)
    if "!" in text:
        text = _BANG.sub("i", text)
    return " " + " ".join(text.translate(_FOLD).split()) + " "


def _candidate_task(limit: int = 200_000):
    """Counts of candidate terms in toxic and other texts, added up per task."""
    def run(batches):
        import pyarrow as pa

        toxic, other = Counter(), Counter()

        def flush():
            terms = list(toxic.keys() | other.keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(terms), pa.array([toxic[t] for t in terms], pa.int64()),
                 pa.array([other[t] for t in terms], pa.int64())], names=["term", "pos", "neg"])
            toxic.clear()
            other.clear()
            return out

        for batch in batches:
            for text, label in zip(batch.column("_text"), batch.column("_label").to_pylist()):
                words = set(fold(text.as_py()).split())
                terms = {f" {w} " for w in words if len(w) > 2}
                for k in range(4, 9):
                    terms.update(" " + w[:k] for w in words if len(w) > k)
                (toxic if label else other).update(terms)
                if len(toxic) + len(other) > limit:
                    yield flush()
        yield flush()
    return run


class Matcher:
    """The automaton of a lexicon ``{term: weight}`` and exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: list[str] = ()):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        self.terms = list(lexicon)
        self.weights = [lexicon[t] for t in self.terms]
        for i, t in enumerate(self.terms):
            self.auto.add_word(t, (i, len(t)))
        for p in exceptions:
            if p not in lexicon:
                self.auto.add_word(p, (-1, len(p)))
        if len(self.auto):
            self.auto.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, int]]:
        """(term, first, last position) of all hits that no exception covers."""
        if not len(self.auto):
            return []
        found, excused = [], []
        for last, (term, size) in self.auto.iter(folded):
            (excused if term < 0 else found).append((term, last - size + 1, last))
        if found and excused:
            # By first position, with the furthest end so far: one search per hit.
            excused.sort(key=lambda e: e[1])
            starts = [a for _, a, _ in excused]
            reach = list(accumulate((b for _, _, b in excused), max))
            found = [h for h in found if h[1] < starts[0]
                     or reach[bisect_right(starts, h[1]) - 1] <= h[1]]
        return found

    def features(self, folded: str) -> list[float]:
        words = folded.count(" ") - 1
        hits = self.hits(folded)
        total = sum(self.weights[t] for t, _, _ in hits)
        return [total / (words + 20.0), np.log1p(total), np.log1p(len({t for t, _, _ in hits})),
                max((self.weights[t] for t, _, _ in hits), default=0.0)]


def _phrase_task(lexicon: dict):
    """Hits with a neighbouring word: exception candidates."""
    def run(batches):
        import pyarrow as pa

        match = Matcher(lexicon)
        for batch in batches:
            rows = []
            for text, label in zip(batch.column("_text"), batch.column("_label").to_pylist()):
                folded, found = fold(text.as_py()), set()
                for _, first, _ in match.hits(folded):
                    word = folded.index(" ", first + 1)
                    before = folded.rfind(" ", 0, first)
                    after = folded.find(" ", word + 1)
                    if before >= 0:
                        found.add(folded[before:word + 1])
                    if after >= 0:
                        found.add(folded[first:after + 1])
                rows += [(p, label) for p in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())],
                names=["phrase", "label"])
    return run


def _feature_task(lexicon: dict, exceptions: list, coef: list | None):
    """Features of labelled rows, or scores of all rows if ``coef`` is given."""
    def run(batches):
        import pyarrow as pa

        match = Matcher(lexicon, exceptions)
        for batch in batches:
            rows = np.array([match.features(fold(t.as_py())) for t in batch.column("_text")]
                            ).reshape(-1, len(FEATURES))
            if coef is None:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_label"), pa.array(rows.tolist(), pa.list_(pa.float64()))],
                    names=["_label", "x"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array(1 / (1 + np.exp(-(rows @ np.array(coef[1:]) + coef[0]))))],
                    names=["_id", "score"])
    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 3e-3, rounds: int = 50) -> np.ndarray:
    """Coefficients (intercept first) by Newton's method on scaled features."""
    if not len(y) or not y.any():
        return np.concatenate([[-30.0], np.zeros(x.shape[1] if x.ndim == 2 else len(FEATURES))])
    mean, std = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.column_stack([np.ones(len(x)), (x - mean) / std])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) - ridge * len(y) * np.r_[0, w[1:]]
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(np.r_[1e-6, [ridge * len(y)] * len(mean)])
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    coef = w[1:] / std
    return np.concatenate([[w[0] - (coef * mean).sum()], coef])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = 12_000, min_g2: float = 30.0,
          max_terms: int = 500, folds: int = 5) -> dict:
    """The model ``{lexicon, exceptions, coef}``."""
    spark = docs.sparkSession
    ship_package(spark)
    fold_of = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    rows = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold_of != 0))
            .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
            .orderBy(F.xxhash64("_id"), "_id").limit(train_rows))
    train = land_table(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
                       .join(F.broadcast(rows), "_id").select("_text", "_label"), "training_texts")
    n_pos, n_neg = train.agg(F.sum("_label"), F.sum(1 - F.col("_label"))).first()
    n_pos, n_neg = n_pos or 0, n_neg or 0
    if not n_pos:
        return {"lexicon": {}, "exceptions": [], "coef": fit_logistic(np.zeros((0, len(FEATURES))), np.zeros(0)).tolist()}
    count = (train.mapInArrow(_candidate_task(), "term string, pos long, neg long")
             .groupBy("term").agg(F.sum("pos").alias("a"), F.sum("neg").alias("b"))
             .filter(F.col("a") >= 3))
    part = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    share = n_pos / (n_pos + n_neg)
    g2 = 2 * (part(a, (a + b) * share) + part(b, (a + b) * (1 - share)))
    top = (count.withColumn("g2", g2).filter((F.col("a") / n_pos > F.col("b") / max(n_neg, 1))
                                             & (F.col("g2") >= min_g2))
           .orderBy(F.desc("g2"), F.desc(F.length("term")), "term").limit(8 * max_terms).collect())
    lexicon: dict[str, float] = {}
    for r in top:
        term = r["term"]
        if len(lexicon) < max_terms and not any(
                term.startswith(t.rstrip()) or t.startswith(term.rstrip()) for t in lexicon):
            lexicon[term] = float(np.log((r["a"] + 0.5) / (n_pos + 1)) - np.log((r["b"] + 0.5) / (n_neg + 1)))
    excused = (train.mapInArrow(_phrase_task(lexicon), "phrase string, label int")
               .groupBy("phrase").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
               .filter((F.col("a") == 0) & (F.col("b") >= 4))
               .orderBy(F.desc("b"), "phrase").limit(max_terms).collect())
    exceptions = [r["phrase"] for r in excused]
    got = train.mapInArrow(_feature_task(lexicon, exceptions, None), "_label int, x array<double>").collect()
    coef = fit_logistic(np.array([r["x"] for r in got]), np.array([r["_label"] for r in got], dtype=float))
    return {"lexicon": lexicon, "exceptions": exceptions, "coef": coef.tolist()}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``score`` (0 to 1) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        _feature_task(model["lexicon"], model["exceptions"], model["coef"]),
        f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def drop_toxic(docs: DataFrame, model: dict, text_col: str = "text", cutoff: float = 0.5) -> DataFrame:
    """``docs`` without those that score ``cutoff`` or more (one pass, no join)."""
    ship_package(docs.sparkSession)
    lexicon, exceptions, coef = model["lexicon"], model["exceptions"], np.array(model["coef"])

    def run(batches):
        import pyarrow as pa

        match = Matcher(lexicon, exceptions)
        for batch in batches:
            rows = np.array([match.features(fold(t.as_py())) for t in batch.column(text_col)]
                            ).reshape(-1, len(FEATURES))
            keep = 1 / (1 + np.exp(-(rows @ coef[1:] + coef[0]))) < cutoff
            yield batch.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)
