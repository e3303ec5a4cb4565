"""Texts to token ids by the tokenizers library, with a table of pieces that stand alone.

The byte-level vocabulary never joins what stands on both sides of certain places into one token: the
start of a run of white space, and the last place of a run of two or more that a word follows. So
texts are cut there, each different piece is encoded once by the library, and the ids of a text are
its pieces' ids in a row. Pieces of at most 23 bytes are found by their bytes in a hash table of numpy
arrays, many at a time; longer ones are encoded where they stand. A missing piece is split as the
library splits and each part goes to the library's model.

Texts with white space beyond ASCII or with the string of a special token, and all texts where the
vocabulary's file names another way of splitting, are encoded whole, by the library alone.

The table takes no more once it has ``CACHE`` pieces (what comes first is mostly what is frequent);
that bounds memory and changes no result. Very long texts are taken in segments of about ``SEGMENT``
bytes, cut at such places. Empty texts have no ids.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import regex

CACHE, PARTS = 1_000_000, 400_000
SEGMENT = 1_000_000
#: Bytes of the longest piece in the table: three words of 64 bits, one byte of them for the length.
LONGEST = 23
#: How the byte-level vocabulary splits (fixed by its format).
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Beyond these letters the classes of a character may differ between versions of Unicode.
FAR = re.compile("[^\x00-\u024f]")
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: The start of a run of white space after a word.
BREAK = re.compile(rb"(?<=[^\t-\r ])[\t-\r ]")

_encoders: dict = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: visible ones for themselves, the others from 256 on, in order."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _masks(word: int) -> np.ndarray:
    """By a piece's size, the bits of its 64-bit word that belong to it."""
    kept = [min(max(n - 8 * word, 0), 8 if word < 2 else 7) for n in range(LONGEST + 2)]
    return np.array([(1 << 8 * k) - 1 for k in kept], dtype=np.uint64)


MASKS = [_masks(k) for k in range(3)]
ODDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


class _Parts(dict):
    """Parts of pieces to their ids by the library's model."""

    def __init__(self, model):
        self.tokenize, self.letters = model.tokenize, _byte_letters()

    def __missing__(self, part: str) -> list[int]:
        letters = "Ġ" + part[1:] if part[0] == " " and part[1:].isalpha() and part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        ids = [x.id for x in self.tokenize(letters)]
        if len(self) < PARTS:
            self[part] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.size = self.t.get_vocab_size()
        self.special = [x.content for x in self.t.get_added_tokens_decoder().values()]
        shape = json.loads(self.t.to_str())
        cut, model = shape["pre_tokenizer"] or {}, shape["model"]
        self.cuts = not shape["normalizer"] and not model.get("dropout") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        self.parts = _Parts(self.t.model)
        self.bits = int(2 * CACHE - 1).bit_length()
        self.slot = np.full(1 << self.bits, -1, dtype=np.int32)
        self.keys = np.empty((CACHE, 3), dtype=np.uint64)
        self.known = self.used = 0  # pieces in the table, their ids
        self.start, self.count = np.empty(CACHE, dtype=np.int64), np.empty(CACHE, dtype=np.int64)
        self.flat = np.empty(4 * CACHE, dtype="<u4")

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> list[list[int]]:
        out: list = []
        far = []
        parts_of = self.parts
        for k, raw in enumerate(pieces):
            s = raw.decode()
            if raw[:1] == b" " and raw[1:].isalpha():  # letters of ASCII alone
                out.append(parts_of[s])
            elif not raw.isascii() and FAR.search(s):
                far.append(k)
                out.append(s)
            else:
                parts = SPLIT.findall(s)
                out.append(parts_of[parts[0]] if len(parts) == 1 else [x for p in parts for x in parts_of[p]])
        for k, ids in zip(far, self.whole([out[k] for k in far]), strict=True):
            out[k] = ids.tolist()
        return out

    def _find(self, keys: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 where there is none. place: where to look first."""
        found = np.full(len(keys), -1, dtype=np.int64)
        todo, at = np.arange(len(keys)), place
        while len(todo):
            e = self.slot[at]
            full = np.flatnonzero(e >= 0)
            todo, at, e = todo[full], at[full], e[full]
            here, asked = self.keys.take(e, axis=0), keys.take(todo, axis=0)
            here ^= asked
            same = (here[:, 0] | here[:, 1] | here[:, 2]) == 0
            found[todo[same]] = e[same]
            todo, at = todo[~same], (at[~same] + 1) & (len(self.slot) - 1)
        return found

    def _enter(self, entries: np.ndarray, place: np.ndarray) -> None:
        while len(entries):
            free = self.slot[place] < 0
            self.slot[place[free]] = entries[free]
            put = self.slot[place] == entries
            entries, place = entries[~put], (place[~put] + 1) & (len(self.slot) - 1)

    def _append(self, ids: list[list[int]]) -> np.ndarray:
        """Ids after the last ones; the entries that hold them. ``known`` and ``used`` stay."""
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        n, total = self.known + len(ids), self.used + int(counts.sum())
        if n > len(self.start):
            self.start, self.count = np.resize(self.start, 2 * n), np.resize(self.count, 2 * n)
        if total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * total)
        self.start[self.known : n] = self.used + np.cumsum(counts) - counts
        self.count[self.known : n] = counts
        self.flat[self.used : total] = [x for row in ids for x in row]
        return np.arange(self.known, n)

    def _segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some segments, none empty, in a row, and how many each has."""
        n = sum(map(len, segments))
        raw = b"".join([*segments, bytes(24)])
        begins = np.cumsum([0, *map(len, segments[:-1])])
        space = SPACE[np.frombuffer(raw, np.uint8, n)]
        first = np.zeros(n + 1, dtype=bool)
        first[begins], first[n] = True, True
        after = np.concatenate([[False], space[:-1]])
        after[begins] = False
        word_next = np.concatenate([~space[1:], [False]]) & ~first[1:]
        at = np.flatnonzero(first[:n] | (space & (~after | word_next)))
        sizes = np.diff(at, append=n)
        short = np.minimum(sizes, LONGEST + 1)
        view = np.ndarray((n + 17,), dtype="<u8", buffer=raw, strides=(1,))
        keys = np.empty((len(at), 3), dtype=np.uint64)
        for k in range(3):
            np.bitwise_and(view[at + 8 * k], MASKS[k][short], out=keys[:, k])
        keys[:, 2] |= short.astype(np.uint64) << np.uint64(56)
        h = keys[:, 0] * ODDS[0]
        for k in (1, 2):
            h ^= h >> np.uint64(29)
            h += keys[:, k]
            h *= ODDS[k]
        h ^= h >> np.uint64(32)
        h *= ODDS[0]
        place = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self._find(keys, place)
        found[sizes > LONGEST] = -1
        missing = np.flatnonzero(found < 0)
        if len(missing):
            # those that the table may keep come first
            missing = missing[np.argsort(sizes[missing] > LONGEST, kind="stable")]
            nth: dict[bytes, int] = {}
            which = np.array([nth.setdefault(raw[a : a + m], len(nth)) for a, m in zip(at[missing].tolist(), sizes[missing].tolist(), strict=True)])
            entries = self._append(self._learn(list(nth)))
            found[missing] = entries[which]
            one = missing[np.unique(which, return_index=True)[1]]  # a place of each different piece, in order
            keep = min(CACHE - self.known, int((sizes[one] <= LONGEST).sum()))
            if keep:
                self.keys[entries[:keep]] = keys[one[:keep]]
                self._enter(entries[:keep].astype(np.int32), place[one[:keep]])
                self.used = int(self.start[entries[keep - 1]] + self.count[entries[keep - 1]])
                self.known += keep
        counts, starts = self.count[found], self.start[found]
        ends = np.cumsum(counts)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(starts - (ends - counts), counts)]
        return ids, np.add.reduceat(counts, np.searchsorted(at, begins))

    def _cuttable(self, s: str) -> bool:
        return self.cuts and not ODD_SPACE.search(s) and not any(x in s for x in self.special)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian 32-bit."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[bytes] = []
        whose: list[int] = []
        n = 0

        def flush():
            nonlocal n
            ids, counts = self._segments(held)
            raw, at = ids.tobytes(), 0
            for i, c in zip(whose, (4 * counts).tolist(), strict=True):
                out[i].append(raw[at : at + c])
                at += c
            held.clear()
            whose.clear()
            n = 0

        for i, s in enumerate(texts):
            if not s:
                continue
            if not self._cuttable(s):
                out[i].append(self.whole([s])[0].tobytes())
                continue
            b, lo = s.encode(), 0
            while lo < len(b):
                hi = len(b)
                if hi - lo > SEGMENT and (m := BREAK.search(b, lo + SEGMENT)):
                    hi = m.start()
                held.append(b[lo:hi])
                whose.append(i)
                n += hi - lo
                lo = hi
                if n >= SEGMENT:
                    flush()
        if held:
            flush()
        return [b"".join(x) for x in out]


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def blocks(batch, columns: list[str], text: str = "text", most: int = 4_000_000):
    """Parts of an Arrow batch of at most about so many bytes of text, one row at least, as lists by column."""
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    lo, total = 0, 0
    for i, n in enumerate([*sizes, most + 1]):
        if total and total + n > most or i == len(sizes):
            if i > lo:
                part = pa.RecordBatch.from_arrays([batch.column(c) for c in columns], names=columns).slice(lo, i - lo)
                yield {c: part.column(k).to_pylist() for k, c in enumerate(columns)}
            lo, total = i, 0
        total += n
