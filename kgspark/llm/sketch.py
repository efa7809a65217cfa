"""Word shingles of a text and their fast similarity sketch.

A text's set holds the distinct five-word shingles of its lower-cased (A-Z
only) words, each as a 64-bit hash; with fewer words the whole sequence is the
one shingle, and without words the set is empty.

The sketch places every shingle into one of ``t`` bins, round after round,
each round with a fresh hash: a bin keeps the smallest (round, value).  Round
``i < t`` throws each shingle at a random bin; round ``t + j`` throws all of
them at bin ``j``.  So every bin is filled at the latest after ``2 t`` rounds,
a large set needs one or two, and two sets agree in a bin with a probability
equal to their Jaccard similarity, with concentration as if bins were
independent.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SHINGLE = 5
_U = np.uint64
_STEP = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(SHINGLE)], dtype=np.uint64)
_WORD_CACHE: dict[str, int] = {}
_WORD_CACHE_MAX = 300_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits, elementwise."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def forget() -> None:
    """Empty the cache of word hashes."""
    _WORD_CACHE.clear()


def _word_hashes(words: list[str]) -> np.ndarray:
    cache = _WORD_CACHE
    if len(cache) > _WORD_CACHE_MAX:
        cache.clear()
    try:
        return np.array([cache[w] for w in words], dtype=np.uint64)
    except KeyError:
        for w in set(words).difference(cache):
            cache[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.array([cache[w] for w in words], dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    words = WORDS.findall(text.translate(LOWER) if not text.isascii() else text.lower()) if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = _word_hashes(words)
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = _mix(out + h[k : k + n] * _STEP[k])
    return np.unique(out)


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """``t`` filled bins (uint64) for a non-empty set of 64-bit hashes."""
    bins = np.full(t, np.iinfo(np.uint64).max, dtype=np.uint64)
    n = len(items)
    at = 0
    expected = int(t * (np.log(t) + 1) / n) + 1
    while at < t:
        # as many rounds at once as a typical set of this size needs; rounds are ranked
        # inside the value, so taking more of them changes nothing
        rounds = min(t - at, max(1, expected))
        salt = _mix(np.arange(at, at + rounds, dtype=np.uint64) + _U(0x5851F42D4C957F2D))
        x = _mix(items[None, :] ^ salt[:, None])
        where = ((x >> _U(40)) * _U(t)) >> _U(24)
        value = (x & _U((1 << 40) - 1)) | (np.arange(at, at + rounds, dtype=np.uint64)[:, None] << _U(40))
        np.minimum.at(bins, where.ravel().astype(np.int64), value.ravel())
        at += rounds
        if bins.max() != np.iinfo(np.uint64).max:
            return bins
    for j in np.flatnonzero(bins == np.iinfo(np.uint64).max):
        x = _mix(items ^ _mix(np.array([t + int(j)], dtype=np.uint64) + _U(0x5851F42D4C957F2D)))
        bins[j] = (x.min() & _U((1 << 40) - 1)) | _U((t + int(j)) << 40)
    return bins


def band_keys(bins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key for each band of ``rows`` bins; the band's number is mixed in."""
    part = bins[: bands * rows].reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)
    for k in range(rows):
        key = _mix(key ^ part[:, k])
    return key.view(np.int64)


def set_id(items: np.ndarray) -> bytes:
    """A 128-bit name of a set; equal sets share it."""
    return xxhash.xxh3_128_digest(items.tobytes())


def similar(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """Whether 100 * intersection >= percent * union, on full sorted sets."""
    if not len(a) or not len(b):
        return False
    low, high = (len(a), len(b)) if len(a) < len(b) else (len(b), len(a))
    if 100 * low < percent * high:
        return False
    inter = low + high - len(np.union1d(a, b))
    return 100 * inter >= percent * (low + high - inter)
