"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

A byte-level BPE file cuts a text into pretokens and merges inside each of them, so equal pretokens have
equal ids. Pretokens are found for a whole batch with array operations, each distinct one (by its string, not by a
hash) is encoded once by the library and remembered for the life of the worker (up to ``_KEEP`` of them, then the
memory starts anew), and the ids of all texts are gathered from that memory. Texts that hold characters beyond
the Latin blocks, other control characters or a special token's string go to the library as they are.
"""

from __future__ import annotations

import os
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

_LIMIT, _KEEP = 0x250, 1_200_000
_OTHER, _LETTER, _NUMBER, _SPACE, _SLOW = range(5)


def _classes() -> np.ndarray:
    """Character class by code point; everything from ``_LIMIT`` on is one slow entry."""
    out = np.full(_LIMIT + 1, _OTHER, np.uint8)
    for c in range(_LIMIT):
        kind = unicodedata.category(chr(c))
        if c in (0x09, 0x0A, 0x0D, 0x20):
            out[c] = _SPACE
        elif c < 0x20 or 0x7F <= c <= 0xA0 or kind[0] in "ZC":
            out[c] = _SLOW
        elif kind[0] in "LN":
            out[c] = _LETTER if kind[0] == "L" else _NUMBER
    out[_LIMIT] = _SLOW
    return out


_CLASS = _classes()


def pretoken_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True where a pretoken of the byte-level pattern starts (texts are ``offsets`` runs of code points)."""
    n = len(codes)
    kind = _CLASS[codes]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    starts = np.empty(n, dtype=bool)
    starts[0] = True
    starts[1:] = kind[1:] != kind[:-1]
    space = kind == _SPACE
    last = np.zeros(n, dtype=bool)                            # last white space before a visible character
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    starts |= last | first[:n]
    joins = last & (codes == 0x20)                            # a plain space belongs to what follows
    starts[1:][joins[:-1]] = False
    quote = np.flatnonzero((codes == 0x27) & starts)          # 's 't 'm 'd 're 've 'll as own pretokens
    if len(quote):
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        a, b = padded[quote + 1], padded[quote + 2]
        inside = ~first[np.minimum(quote + 1, n)]
        deep = inside & ~first[np.minimum(quote + 2, n)]
        one = inside & np.isin(a, [ord(c) for c in "stmd"])
        two = deep & ~one & np.logical_or.reduce([(a == ord(x)) & (b == ord(y)) for x, y in ("re", "ve", "ll")])
        for hit, size in ((one, 2), (two, 3)):
            q = quote[hit]
            starts[q + 1] = False
            end = q + size
            end = end[end < n]
            starts[end[kind[end] == _LETTER]] = True
    return starts


class TextEncoder:
    """Ids of batches of texts; one per worker and file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}                       # pretoken -> number
        self.at = np.zeros(0, np.int64)                       # first place and number of its ids in ``ids``
        self.many = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _numbers(self, strings: list[str]) -> np.ndarray:
        """Numbers of distinct pretokens; new ones are encoded."""
        if len(self.known) > _KEEP:
            self._forget()
        out = list(map(self.known.get, strings))
        new = [i for i, k in enumerate(out) if k is None]
        if new:
            names, at_first = [strings[i] for i in new], len(self.known)
            found = self._encode(names)
            many = np.fromiter(map(len, found), np.int64, len(found))
            at = len(self.ids) + np.cumsum(many) - many
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(many.sum()))])
            self.at, self.many = np.concatenate([self.at, at]), np.concatenate([self.many, many])
            numbers = range(at_first, at_first + len(new))
            self.known.update(zip(names, numbers))
            for i, k in zip(new, numbers):
                out[i] = k
        return np.array(out, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets per text)."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        codes = np.minimum(points, _LIMIT)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        slow = np.zeros(len(texts), dtype=bool)
        bad = np.flatnonzero(_CLASS[codes] == _SLOW)
        slow[np.searchsorted(offsets, bad, side="right") - 1] = True
        for s in self.special:
            if s in joined:
                slow |= np.array([s in t for t in texts])
        counts = np.zeros(len(texts), np.int64)
        flat = np.zeros(0, np.uint32)
        if len(codes):
            starts = np.flatnonzero(pretoken_starts(codes, offsets))
            text = np.searchsorted(offsets, starts, side="right") - 1
            size = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            places = np.concatenate([[0], np.cumsum(size)])[np.append(starts, len(points))]
            tokens = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(joined.encode())])
            if slow.any():
                keep = ~slow[text]
                tokens, text = tokens.filter(pa.array(keep)), text[keep]
            if len(text):
                coded = tokens.dictionary_encode()
                k = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
                many = self.many[k]
                total = np.cumsum(many)
                place = np.repeat(self.at[k] - (total - many), many) + np.arange(total[-1])
                flat = self.ids[place]
                counts = np.bincount(text, weights=many, minlength=len(texts)).astype(np.int64)
        if slow.any():
            rows = np.flatnonzero(slow).tolist()
            cuts, parts, at = np.concatenate([[0], np.cumsum(counts)]), [], 0
            for r, ids in zip(rows, self._encode([texts[r] for r in rows])):
                parts += [flat[at:cuts[r]], np.array(ids, np.uint32)]
                at = cuts[r]
                counts[r] = len(ids)
            flat = np.concatenate([*parts, flat[at:]])
        return flat, np.concatenate([[0], np.cumsum(counts)])


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
