"""Token ids of whole texts by a public tokenizer file, with a cache of pieces.

The files' pre-tokenizers cut a text into runs of letters, digits or marks; a token
never crosses a cut, and a run of white space goes on with what follows it. So a text may
be cut

* before white space that follows something else, and
* between an ASCII letter or digit and an ASCII mark other than the apostrophe
  (which may begin a contraction),

and its ids are the ids of the pieces, side by side. Pieces are found and hashed
for a slice of texts at once, and looked up in a hash table of pieces seen before (by
a 64-bit hash, their length and their first eight bytes); only new pieces go through the tokenizer.
New pieces that begin with white space and end with something else may stand side by
side in one string, by the first rule, and go through it together. Texts with white space
outside ASCII, and texts that hold the string of an added token of the file (such as
``<|endoftext|>``, which the tokenizer takes as that token), are encoded whole.
``tests/llm`` compares with the tokenizer.
"""

from __future__ import annotations

from itertools import chain

import numpy as np

from cadenza.llm import textvec as tv

_SPACE = ~tv.NOT_SPACE
_ALNUM = tv.ALNUM & (tv.ALL < 128)
_MARK = (tv.ALL > 32) & (tv.ALL < 127) & ~_ALNUM & (tv.ALL != ord("'"))
# White space outside ASCII, in UTF-8 (first bytes, last bytes).
_WIDE = ((b"\xc2", (0x85, 0xA0)), (b"\xe1\x9a", (0x80,)),
         (b"\xe2\x80", (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), (b"\xe2\x81", (0x9F,)),
         (b"\xe3\x80", (0x80,)))
_SLOTS = 1 << 21
_FULL = 1_000_000
_JOINED = 256                                     # new pieces in one string


def _whole_texts(texts: tv.Texts, added: list[bytes]) -> np.ndarray:
    """Texts that hold white space outside ASCII (or ASCII separators 0x1C to 0x1F), or
    the string of an added token."""
    data = texts.data
    found = [np.flatnonzero((data >= 0x1C) & (data <= 0x1F))]
    for lead, last in _WIDE:
        at = np.flatnonzero(data == lead[0])
        at = at[at + len(lead) < len(data)]
        for k in range(1, len(lead)):
            at = at[data[at + k] == lead[k]]
        found.append(at[np.isin(data[at + len(lead)], last)])
    for string in added:
        at = np.flatnonzero(data[:max(0, len(data) - len(string) + 1)] == string[0])
        for k in range(1, len(string)):
            at = at[data[at + k] == string[k]]
        found.append(at)
    at = np.concatenate(found)
    return np.unique(np.searchsorted(texts.lo, at, side="right") - 1) if len(at) else at


def _heads(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first eight bytes of each piece (fewer: filled with its length), and its length
    mixed in."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = (end - start).astype(np.uint64)
    gone = np.uint64(8) * (np.uint64(8) - np.minimum(size, np.uint64(8)))
    return (words[start] << gone) ^ (size * np.uint64(0x9E3779B97F4A7C15))


def _kind(piece: str) -> int:
    """How a new piece that may be joined goes through the tokenizer: 2 for a space and ASCII
    letters, else 1. (0: alone.)"""
    return 2 if piece[0] == " " and piece.isascii() and piece[1:].isalpha() else 1


class Encoder:
    """Encodes slices of texts. One per Python worker (see :func:`encoder`)."""

    def __init__(self, path: str):
        import os

        # A task has one core; the library's own threads would spin beside it.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in tokens]
        # Such a token may be found in a text without its string: nothing is cut.
        self.never_cut = any(t.normalized for t in tokens)
        # Pieces side by side must not spell such a token.
        self.joins = not any(c.isspace() for t in tokens for c in t.content)
        self._clear()

    def _clear(self):
        self.key = np.zeros((_SLOTS, 2), dtype=np.uint64)    # hash and head of a slot's piece
        self.code = np.full(_SLOTS, -1, dtype=np.int32)      # number of the piece, -1: free
        self.ids = np.zeros(1 << 20, dtype=np.uint32)        # ids of all pieces
        self.at = np.zeros(_FULL + (1 << 20), dtype=np.int64)    # by number: where its ids begin
        self.size = np.zeros_like(self.at)                   # by number: how many
        self.pieces = self.used = 0

    def _find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of pieces (-1: not seen before), and where the search ended."""
        slot = (a >> np.uint64(43)).astype(np.int64)
        code = np.full(len(a), -1, dtype=np.int64)
        open_ = np.arange(len(a))
        while len(open_):
            s = slot[open_]
            here = self.code[s]
            key = self.key[s]
            same = (here >= 0) & (key[:, 0] == a[open_]) & (key[:, 1] == b[open_])
            code[open_[same]] = here[same]
            open_ = open_[~same & (here >= 0)]
            slot[open_] = (slot[open_] + 1) & (_SLOTS - 1)
        return code, slot

    def _ids(self, words: list[str], kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of one kind (see :func:`_kind`) side by side, and how many each has."""
        if not kind:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            return np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(size.sum())), size
        parts = [words[at:at + _JOINED] for at in range(0, len(words), _JOINED)]
        found, size = [], []
        for part, e in zip(parts, self.tokenizer.encode_batch(["".join(p) for p in parts],
                                                              add_special_tokens=False)):
            if kind == 2:                     # a piece is one word of the pre-tokenizer
                at = np.array(e.word_ids, dtype=np.int64)
            else:                             # a token belongs to the piece of its first character
                ends = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)))
                at = np.searchsorted(ends, np.fromiter((o[0] for o in e.offsets), dtype=np.int64,
                                                       count=len(e.ids)), "right")
            size.append(np.bincount(at, minlength=len(part)))
            found.append(np.array(e.ids, dtype=np.uint32))
        return np.concatenate(found), np.concatenate(size)

    def _add(self, a: np.ndarray, b: np.ndarray, words: list[str], kind: int = 0) -> None:
        """Encode new, distinct pieces of one kind and enter them."""
        for at in range(0, len(words), 8192):
            ids, size = self._ids(words[at:at + 8192], kind)
            n, total = len(size), len(ids)
            while self.used + total > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used:self.used + total] = ids
            if self.pieces + n > len(self.at):
                self.at = np.concatenate([self.at, np.zeros_like(self.at)])
                self.size = np.concatenate([self.size, np.zeros_like(self.size)])
            self.at[self.pieces:self.pieces + n] = self.used + np.cumsum(size) - size
            self.size[self.pieces:self.pieces + n] = size
            left, code = np.arange(at, at + n), np.arange(self.pieces, self.pieces + n)
            self.used, self.pieces = self.used + total, self.pieces + n
            while len(left):
                # Of pieces that want one free slot, the first gets it.
                _, slot = self._find(a[left], b[left])
                slot, first = np.unique(slot, return_index=True)
                self.key[slot, 0], self.key[slot, 1] = a[left[first]], b[left[first]]
                self.code[slot] = code[first]
                rest = np.ones(len(left), dtype=bool)
                rest[first] = False
                left, code = left[rest], code[rest]

    def _gather(self, code: np.ndarray) -> np.ndarray:
        size = self.size[code]
        ends = np.cumsum(size)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[code] - ends + size, size)
        return self.ids[where]

    def encode(self, texts: tv.Texts) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: text i has ``ids[bounds[i]:bounds[i + 1]]`` (uint32)."""
        data, n = texts.data, texts.n
        space, alnum, mark = _SPACE[data], _ALNUM[data], _MARK[data]
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = (space[1:] & ~space[:-1]) | (alnum[:-1] & mark[1:]) | (mark[:-1] & alnum[1:])
        full = texts.hi > texts.lo
        cut[texts.lo[full]] = True
        whole = range(n) if self.never_cut else _whole_texts(texts, self.added)
        for d in whole:
            cut[texts.lo[d] + 1:texts.hi[d]] = False
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(data))
        a, b = texts.range_hash(start, end), _heads(data, start, end)
        if self.pieces > _FULL:
            self._clear()
        code, _ = self._find(a, b)
        new = np.flatnonzero(code < 0)
        if len(new):
            _, first = np.unique(a[new], return_index=True)
            some = new[first]
            raw = data.tobytes()
            join = space[start[some]] & ~space[end[some] - 1]
            if not self.joins:
                join[:] = False
            # White space of other kinds stands only in texts that are one piece.
            one = np.zeros(n, dtype=bool)
            one[np.asarray(whole, dtype=np.int64)] = True
            join &= ~one[np.searchsorted(texts.lo, start[some], "right") - 1]
            words = [raw[x:y].decode() for x, y in zip(start[some], end[some])]
            kinds = np.array([_kind(w) if k else 0 for w, k in zip(words, join)])
            for kind in (0, 1, 2):
                k = np.flatnonzero(kinds == kind)
                if len(k):
                    self._add(a[some[k]], b[some[k]], [words[x] for x in k], kind)
            code[new], _ = self._find(a[new], b[new])
            for k in np.flatnonzero(code < 0):       # equal in one hash only
                if code[k] < 0:
                    self._add(a[k:k + 1], b[k:k + 1], [raw[start[k]:end[k]].decode()])
                    code[k] = self._find(a[k:k + 1], b[k:k + 1])[0][0]
        before = np.concatenate([[0], np.cumsum(self.size[code])])
        return self._gather(code), before[np.searchsorted(start, np.append(texts.lo, len(data)))]

    def encode_with_end(self, texts: tv.Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same, with ``end_id`` after each text."""
        ids, bounds = self.encode(texts)
        out = np.full(len(ids) + texts.n, end_id, dtype=np.uint32)
        own = np.repeat(np.arange(texts.n), np.diff(bounds))
        out[np.arange(len(ids)) + own] = ids
        return out, bounds + np.arange(texts.n + 1)


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """This worker's encoder of a tokenizer file: a path, or a name that the
    installed ``public_tokenizers`` package knows."""
    if name not in _encoders:
        import os

        path = name
        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(name)
        _encoders[name] = Encoder(path)
    return _encoders[name]


def binary_rows(ids: np.ndarray, bounds: np.ndarray, width: int):
    """Arrow binary column: row i holds ids ``bounds[i]`` to ``bounds[i + 1]``,
    unsigned little-endian of ``width`` bytes."""
    import pyarrow as pa

    data = ids.astype(f"<u{width}")
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * width).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
