"""Word shingles of whole documents and their one-permutation MinHash signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .textbytes import NOT_SPACE, mix, words

SHINGLE = 5
_STEP = np.uint64(0xD6E8FEB86659FD93)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's distinct ``k``-word shingles as sorted 64-bit hashes.

    A text of fewer words, but not none, has its whole sequence as its one shingle; a text
    without words (or null) has none."""
    w = words(texts, NOT_SPACE)
    h, off = w.hashes(), w.offsets
    n = np.diff(off)
    padded = np.r_[h, np.zeros(k, np.uint64)]
    size = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    starts = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(n)), size)
    at = off[:-1][doc] + np.arange(len(doc)) - starts[doc]
    left = off[1:][doc] - at
    s = np.zeros(len(doc), np.uint64)
    for i in range(k):
        word = np.where(i < left, padded[at + i], np.uint64(0))
        s = mix(s * _STEP + word)
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    s, doc = s[new], doc[new]
    return s, np.searchsorted(doc, np.arange(len(n) + 1))


def signatures(s: np.ndarray, off: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation hashing: one hash function deals the shingles into ``bins`` bins and
    each bin keeps its least value. Empty bins are filled by optimal densification: bin j
    asks bins g(j, 1), g(j, 2), ... (the same sequence in every document) and copies the
    first that was not empty. Rows of texts without shingles stay ``EMPTY``."""
    docs = len(off) - 1
    doc = np.repeat(np.arange(docs), np.diff(off))
    sig = np.full(docs * bins, EMPTY, np.uint64)
    np.minimum.at(sig, doc * bins + (s % np.uint64(bins)).astype(np.int64), mix(s ^ _STEP))
    sig = sig.reshape(docs, bins)
    free = sig == EMPTY
    free[np.diff(off) == 0] = False
    d, j = np.nonzero(free)
    full = sig.copy()
    attempt = 0
    while len(d):
        attempt += 1
        ask = (mix(j.astype(np.uint64) * _STEP + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        got = full[d, ask]
        ok = got != EMPTY
        sig[d[ok], j[ok]] = got[ok]
        d, j = d[~ok], j[~ok]
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key a band of ``rows`` bins; the band's number is part of the key."""
    docs, bins = sig.shape
    key = np.tile(np.arange(bins // rows, dtype=np.uint64), (docs, 1))
    for i in range(rows):
        key = mix(key * _STEP + sig[:, i::rows][:, :bins // rows])
    return key


def set_digest(s: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over each set: equal sets have equal digests."""
    out = []
    for salt in (np.uint64(1), np.uint64(0xA0761D6478BD642F)):
        run = np.r_[np.zeros(1, np.uint64), np.cumsum(mix(s ^ salt), dtype=np.uint64)]
        out.append(run[off[1:]] - run[off[:-1]])
    return np.stack(out, axis=1)
