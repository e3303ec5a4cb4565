"""Token ids in wavelet-matrix files: compressed bit planes with rank and select.

A shard file holds whole documents one after another:

    magic ``WVM1`` | header length, 4 bytes | header, JSON | document table | planes

The header gives the number of tokens and documents, the planes' zero counts, and the place of each
section. The document table has int64 ids, one byte each for null ids, and int64 token counts. Plane
k holds bit (bits - 1 - k) of the ids after k stable partitions by the bits above, in blocks of
``BLOCK`` bytes, each compressed alone; the number of ones before each block is in the header's rank
table. So one token, a count or an occurrence is read by decompressing one block for each plane.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import zstandard

MAGIC = b"WVM1"
BLOCK = 16_384


def build(ids: np.ndarray, doc_ids: list, counts: list[int], bits: int, before: int = 0) -> bytes:
    """A shard file; before: tokens of the same range in earlier files."""
    cur = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    pack = zstandard.ZstdCompressor(level=1).compress
    planes, body, at = [], [], 0
    for level in range(bits - 1, -1, -1):
        mask = ((cur >> cur.dtype.type(level)) & cur.dtype.type(1)).view(np.uint8 if cur.itemsize == 1 else cur.dtype).astype(bool)
        raw = np.packbits(mask)
        ones = np.bitwise_count(raw)
        starts = range(0, len(raw), BLOCK)
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(ones, list(starts), dtype=np.int64))]).tolist() if len(raw) else [0]
        places = []
        for s in starts:
            x = pack(raw[s : s + BLOCK].tobytes())
            places.append(at)
            body.append(x)
            at += len(x)
        low = cur[~mask]
        planes.append({"zeros": len(low), "ranks": ranks, "at": [*places, at]})
        cur = np.concatenate([low, cur[mask]])
    known = np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes()
    nulls = np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes()
    table = zstandard.ZstdCompressor(level=3).compress(known + nulls + np.array(counts, dtype="<i8").tobytes())
    head = zlib.compress(json.dumps({"n": len(ids), "docs": len(doc_ids), "bits": bits, "before": before, "table": len(table), "planes": planes}).encode())
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, table, *body])


class Shard:
    """Reads one shard file: access, rank, counting and occurrence lookup."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        size = struct.unpack_from("<I", data, 4)[0]
        self.head = json.loads(zlib.decompress(data[8 : 8 + size]))
        self.n, self.bits, self.before = self.head["n"], self.head["bits"], self.head["before"]
        at = 8 + size
        docs = self.head["docs"]
        table = zstandard.ZstdDecompressor().decompress(data[at : at + self.head["table"]])
        nulls = np.frombuffer(table, np.uint8, docs, 8 * docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(np.frombuffer(table, "<i8", docs), nulls, strict=True)]
        self.counts = np.frombuffer(table, "<i8", docs, 9 * docs)
        self.data, self.base = memoryview(data), at + self.head["table"]
        self._blocks: dict = {}

    def _block(self, k: int, b: int) -> np.ndarray:
        if (k, b) not in self._blocks:
            lo, hi = self.head["planes"][k]["at"][b : b + 2]
            self._blocks[k, b] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.data[self.base + lo : self.base + hi]), np.uint8)
        return self._blocks[k, b]

    def _bit(self, k: int, i: int) -> int:
        x = self._block(k, i // (8 * BLOCK))
        j = i % (8 * BLOCK)
        return int(x[j >> 3] >> (7 - (j & 7))) & 1

    def _ones(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k."""
        b, j = divmod(i, 8 * BLOCK)
        n = self.head["planes"][k]["ranks"][b]
        if j:
            x = self._block(k, b)
            n += int(np.bitwise_count(x[: j >> 3]).sum()) + (int(x[j >> 3]) >> (8 - (j & 7))).bit_count() if j & 7 else int(np.bitwise_count(x[: j >> 3]).sum())
        return n

    def token(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k in range(self.bits):
            bit = self._bit(k, i)
            one = self._ones(k, i)
            out = 2 * out + bit
            i = self.head["planes"][k]["zeros"] + one if bit else i - one
        return out

    def _run(self, token: int, end: int) -> tuple[int, int]:
        lo, hi = 0, end
        for k in range(self.bits):
            a, b = self._ones(k, lo), self._ones(k, hi)
            if token >> (self.bits - 1 - k) & 1:
                z = self.head["planes"][k]["zeros"]
                lo, hi = z + a, z + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences among the first ``end`` tokens."""
        if token >> self.bits:
            return 0
        lo, hi = self._run(token, self.n if end is None else end)
        return hi - lo

    def find(self, token: int, nth: int) -> int:
        """The place of the nth occurrence, from 0."""
        lo, hi = self._run(token, self.n)
        if not 0 <= nth < hi - lo:
            raise IndexError(nth)
        i = lo + nth
        for k in range(self.bits - 1, -1, -1):
            i = self._select(k, token >> (self.bits - 1 - k) & 1, i)
        return i

    def _select(self, k: int, bit: int, i: int) -> int:
        """The place in plane k of what stands at i after its partition."""
        z = self.head["planes"][k]["zeros"]
        want = i - z if bit else i
        lo, hi = 0, self.n
        while hi - lo > 1:  # the last place with at most ``want`` such bits before it
            mid = (lo + hi) // 2
            before = self._ones(k, mid) if bit else mid - self._ones(k, mid)
            lo, hi = (mid, hi) if before <= want else (lo, mid)
        return lo

    def decode(self) -> np.ndarray:
        """All ids, by undoing the partitions from the last plane to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        cur = np.zeros(self.n, dtype=kind)
        unpack = zstandard.ZstdDecompressor().decompress
        for level in range(self.bits):
            p = self.head["planes"][self.bits - 1 - level]
            raw = b"".join(unpack(self.data[self.base + lo : self.base + hi]) for lo, hi in zip(p["at"], p["at"][1:], strict=False))
            mask = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n).view(bool)
            out = np.empty_like(cur)
            out[~mask] = cur[: p["zeros"]]
            out[mask] = cur[p["zeros"] :] | kind(1 << level)
            cur = out
        return cur
