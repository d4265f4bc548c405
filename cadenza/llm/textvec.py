"""Words and word n-grams of a column of texts, as numpy arrays.

A task gets Arrow batches; each batch is walked in slices of bounded size, and
all texts of a slice are split and hashed together. Words are maximal runs of
bytes that are not ASCII white space (space, 0x09 to 0x0D) unless another byte
class is given. Hashes are 64-bit: a polynomial over random byte values whose
prefix sums give the hash of any byte range, then a mixing step.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, so it has an inverse
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * \
    np.uint64(2) + np.uint64(1)

ALL = np.arange(256, dtype=np.uint8)
#: bytes with A-Z folded to a-z
LOWER = np.where((ALL >= 65) & (ALL <= 90), ALL + 32, ALL).astype(np.uint8)
#: words of the contracts: everything but ASCII white space
NOT_SPACE = ~((ALL == 32) | ((ALL >= 9) & (ALL <= 13)))
#: letters, digits and everything outside ASCII
ALNUM = ((ALL >= 48) & (ALL <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (ALL >= 128)

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        for name, x in (("up", _BASE), ("down", _INV)):
            seq = np.full(size, x, dtype=np.uint64)
            seq[0] = 1
            _powers[name] = np.multiply.accumulate(seq)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Texts:
    """Some texts side by side in one byte buffer.

    ``data`` bytes; ``lo``/``hi`` the byte range of each text; after
    :meth:`split`: ``start``/``end`` of each word, ``first`` (index of each
    text's first word, one entry more than texts), ``doc`` (text of a word)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.lo, self.hi = data, bounds[:-1], bounds[1:]
        self.n = len(bounds) - 1
        self._sums: dict[int, np.ndarray] = {}

    def split(self, word_bytes: np.ndarray = NOT_SPACE) -> "Texts":
        inside = word_bytes[self.data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        before[self.lo[self.lo < len(inside)]] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[(self.hi - 1)[self.hi > self.lo]] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, np.append(self.lo, len(inside)))
        self.words = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.words)
        return self

    def range_hash(self, start: np.ndarray, end: np.ndarray, fold: np.ndarray = ALL) -> np.ndarray:
        """Hash of the bytes from ``start`` to ``end`` (after ``fold``)."""
        up, down = _power(len(self.data) + 1)
        key = id(fold)
        if key not in self._sums:
            sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_BYTES[fold][self.data] * up[:-1], out=sums[1:])
            self._sums[key] = sums
        sums = self._sums[key]
        return mix((sums[end] - sums[start]) * down[start])

    def word_hash(self, fold: np.ndarray = ALL) -> np.ndarray:
        return self.range_hash(self.start, self.end, fold)

    def ngrams(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words that start at each word, and whether all n
        belong to the word's text."""
        whole = np.arange(len(hashes)) + n <= self.first[1:][self.doc]
        out = np.zeros(len(hashes), dtype=np.uint64)
        for k in range(n):
            part = hashes[k:] if k else hashes
            out[:len(part)] = out[:len(part)] * _BASE + part
        return mix(out), whole

    def sums(self, per_word: np.ndarray) -> np.ndarray:
        """Sum of a value per word over each text (0 without words)."""
        total = np.zeros(len(per_word) + 1, dtype=per_word.dtype if per_word.dtype.kind == "f"
                         else np.int64)
        np.cumsum(per_word, out=total[1:])
        return total[self.first[1:]] - total[self.first[:-1]]

    def byte_sums(self, per_byte: np.ndarray) -> np.ndarray:
        total = np.zeros(len(per_byte) + 1, dtype=np.int64)
        np.cumsum(per_byte, out=total[1:])
        return total[self.hi] - total[self.lo]


def slices(column, max_bytes: int = 1 << 20):
    """``(first row, Texts)`` for stretches of an Arrow string column; null is
    taken as empty. A stretch has at most ``max_bytes`` bytes, or one text,
    and at most ``MAX_ROWS`` texts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None and data_buf.size \
        else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < n:
        to = int(np.searchsorted(offsets, offsets[row] + max_bytes, side="right")) - 1
        to = min(max(to, row + 1), row + MAX_ROWS, n)
        bounds = offsets[row:to + 1]
        yield row, Texts(data[bounds[0]:bounds[-1]], bounds - bounds[0])
        row = to


#: Rows of a slice, and bits of a hash kept beside the row number in one word.
MAX_ROWS, KEPT_BITS = 1 << 12, np.uint64(52)


def distinct_in_text(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs of a slice, sorted: ``(key, text, count)``.
    A key is the text's number in the slice above 52 bits of the hash, so one
    plain sort of 64-bit words orders the whole slice."""
    keys = np.sort(text_key(doc, hashes))
    new = np.empty(len(keys), dtype=bool)
    new[:1] = True
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    at = np.flatnonzero(new)
    keys = keys[at]
    return keys, (keys >> KEPT_BITS).astype(np.int64), np.diff(np.append(at, len(new)))


def text_key(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return (doc.astype(np.uint64) << KEPT_BITS) | (hashes >> (np.uint64(64) - KEPT_BITS))
