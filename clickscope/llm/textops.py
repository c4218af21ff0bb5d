"""Vectorised word and n-gram helpers for Arrow string columns.

Everything here works on one Arrow batch at a time and on bounded slices of
it (``SLICE_BYTES`` of text, or one longer document), as whole-array numpy
operations over the UTF-8 bytes: no per-word Python.

Words are the maximal runs of bytes outside ``\\x20 \\x09-\\x0D``; those are
ASCII, so a cut never falls inside a UTF-8 character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Fixed random byte values and odd multipliers (seeded: equal on every task).
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRAM = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        for name, base in (("p", _P), ("inv", _P_INV)):
            a = np.full(n, np.uint64(base))
            a[0] = 1
            _POWERS[name] = np.cumprod(a, dtype=np.uint64)
    return _POWERS["p"], _POWERS["inv"]


class Words:
    """Words of a slice: byte spans, owner document and first word of each."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.buf, self.offs, self.n_docs = buf, offs, len(offs) - 1
        n = len(buf)
        inside = ~_SPACE[buf]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offs] = True
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(n, dtype=bool)
        if n:
            after[-1] = False
            after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offs)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_docs), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of each word (polynomial over random byte values)."""
        b = _LOWER[self.buf] if lower else self.buf
        p, inv = _powers(len(b) + 1)
        run = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[b] * p[: len(b)], dtype=np.uint64, out=run[1:])
        h = (run[self.ends] - run[self.starts]) * inv[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64))

    def grams(self, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each k-word window inside one document, and the word index
        at which it starts."""
        n = len(h) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        g = h[:n] * _GRAM[0]
        for t in range(1, k):
            g = g + h[t:n + t] * _GRAM[t]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        return mix(g[at]), at


def slices(texts: pa.Array | pa.ChunkedArray,
           limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(lo, hi, bytes, offsets)`` of consecutive rows of at most ``limit``
    bytes together (one row may exceed it); null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, ob, db = texts.buffers()
    offs = np.frombuffer(ob, dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(db, dtype=np.uint8) if db is not None and db.size else np.empty(0, np.uint8)
    lo, n = 0, len(texts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def distinct_in_doc(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, hash), ordered by doc then hash."""
    order = np.lexsort((h, doc))
    d, g = doc[order], h[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
    return d[new], g[new]


def shingle_sets(words: Words, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each document: ``(doc, hash)`` ordered by
    both, and the set size of each document.  With 1 to k-1 words the whole
    sequence is the only shingle; without words the set is empty."""
    h = words.hashes(lower)
    g, at = words.grams(h, k)
    doc = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        extra = np.array([_whole(h[words.first[d]:words.first[d + 1]]) for d in short], np.uint64)
        doc, g = np.concatenate([doc, short]), np.concatenate([g, extra])
    doc, g = distinct_in_doc(doc, g)
    return doc, g, np.bincount(doc, minlength=words.n_docs)


def _whole(h: np.ndarray) -> np.uint64:
    terms = h * _GRAM[32 + np.arange(len(h)) % 32]
    return mix(np.array([terms.sum(dtype=np.uint64)]) + np.uint64(len(h)))[0]


def minimizers(words: Words, h: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions of the smallest k-word gram of every ``w``
    consecutive ones (leftmost of equals; of a document with fewer grams, of
    all): two texts that share ``w + k - 1`` words in a row share one."""
    g, at = words.grams(h, k)
    if not len(g):
        return g, at
    chosen = smallest_of(g, words.doc[at], w)
    return g[chosen], at[chosen]


def smallest_of(g: np.ndarray, doc: np.ndarray, w: int) -> np.ndarray:
    """Indices of the smallest of every ``w`` consecutive values of a document
    (leftmost of equals; of a document with fewer, of all)."""
    n = len(g)
    if not n:
        return np.empty(0, np.int64)
    pad = np.concatenate([g, np.full(w - 1, np.uint64(2**64 - 1))])
    odoc = np.concatenate([doc, np.full(w - 1, -1)])
    best, where = g.copy(), np.arange(n)
    for t in range(1, w):
        less = (pad[t:n + t] < best) & (odoc[t:n + t] == doc)
        best = np.where(less, pad[t:n + t], best)
        where = np.where(less, np.arange(t, n + t), where)
    full = odoc[w - 1:] == doc
    first = np.ones(n, dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    return np.unique(where[full | first])
