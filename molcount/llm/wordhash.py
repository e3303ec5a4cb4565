"""Words of texts as 64-bit hashes, and hashes of runs of words, in numpy.

A word is a maximal run of bytes other than space and 9..13, so texts are cut as bytes; no character
outside ASCII holds one of these. Hashes of words are kept by the Python worker in a table that takes
no more once it has ``CACHE`` words (what comes first is mostly what is frequent); that bounds memory
and changes no result.
"""

from __future__ import annotations

import numpy as np
import xxhash

CACHE = 120_000
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD2 = np.uint64(0xD6E8FEB86659FD93)


class _Table(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE:
            self[word] = h
        return h


_table = _Table()


def hashes(words: list[bytes]) -> np.ndarray:
    """The hash of each word."""
    return np.fromiter(map(_table.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= M1
    x ^= x >> np.uint64(27)
    x *= M2
    x ^= x >> np.uint64(31)
    return x


def runs(h: np.ndarray, k: int, odd: np.uint64 = ODD) -> np.ndarray:
    """A hash of each run of k neighbouring hashes; as many as len(h) - k + 1."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= odd
        out += h[i : i + n]
    return mixed(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours; as many as len(x) - w + 1."""
    n = len(x)
    if n < w:
        return np.empty(0, dtype=x.dtype)
    if w == 1:
        return x.copy()
    pad = -n % w
    y = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, dtype=x.dtype)]).reshape(-1, w)
    left = np.minimum.accumulate(y, axis=1).ravel()
    right = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


PLACE_BITS = np.uint64(20)
CHUNK = 1 << 20


def anchors(grams: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last) of the anchors of all windows of w neighbouring grams.

    A window's anchor is its least gram by the top 44 bits of the hash, the leftmost of equals, so it
    depends on the window's content alone. first..last are the windows (by their first gram) that
    have this anchor. A text of over CHUNK grams is taken in parts that overlap by w - 1.
    """
    out = []
    step = CHUNK - w + 1
    for lo in range(0, max(len(grams) - w + 1, 0), step):
        g = grams[lo : lo + CHUNK]
        packed = (g & ~np.uint64((1 << 20) - 1)) | np.arange(len(g), dtype=np.uint64)
        at = (sliding_min(packed, w) & np.uint64((1 << 20) - 1)).astype(np.int64)
        if not len(at):
            continue
        first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        last = np.append(first[1:], len(at)) - 1
        out.append((at[first] + lo, first + lo, last + lo))
    if not out:
        e = np.empty(0, dtype=np.int64)
        return e, e, e
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def anchors_of(h: np.ndarray, sizes: np.ndarray, k: int, length: int):
    """(gram, text, first, last) of the anchors of all windows of ``length`` words of several texts.

    h holds the texts' hashes one after another, sizes their numbers; grams are runs of k. first and
    last count from the text's first word. Windows stay within texts.
    """
    g, w = runs(h, k), length - k + 1
    ends = np.cumsum(sizes)
    out = []
    step = CHUNK - w + 1
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
    before = ends - sizes
    n = np.maximum(sizes - length + 1, 0)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(before, n)  # of all windows
    for lo in range(0, max(len(g) - w + 1, 0), step):
        a, b = np.searchsorted(starts, [lo, min(lo + step, len(g) - w + 1)])
        if a == b:
            continue
        part = g[lo : lo + CHUNK]
        packed = (part & ~np.uint64((1 << 20) - 1)) | np.arange(len(part), dtype=np.uint64)
        s, who = starts[a:b], owner[a:b]
        at = (sliding_min(packed, w)[s - lo] & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1]) | (who[1:] != who[:-1])) + 1])
        last = np.append(first[1:], len(at)) - 1
        out.append((part[at[first]], who[first], s[first] - before[who[first]], s[last] - before[who[first]]))
    if not out:
        e = np.empty(0, dtype=np.int64)
        return np.empty(0, dtype=np.uint64), e, e, e
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
