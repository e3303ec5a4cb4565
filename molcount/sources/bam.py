"""BAM as a Python data source and sink.

Source. A file is cut into byte ranges; a range holds the records that begin in blocks that begin in it. A task finds the
first block at or after its range's start, and in it the first record, by a chain of records that hold together.
``ordinal`` is a record's place in the file (the block's offset and the offset in the block), so it rises with the file and
does not depend on the ranges. Filters on contig, pos and end are taken to the file's index (``.bai`` beside it): only the
blocks that it names are read. Rows leave as Arrow batches, with tags as text.

Sink. Each task writes one part, in order of contig and place, with its own header and index, under a name of its
attempt; the commit moves the parts to their names, an abort or a failed task deletes them. A folder of parts is read like a file.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from molcount.sources.stores import exists, listed, opened

#: Letters of packed bases and of CIGAR operations, and those that take places in the reference.
BASES, OPS, TAKES = "=ACMGRSVTWYHKDBN", "MIDNSHP=X", "MDN=X"
SPLIT, BATCH, BUFFER = 64 << 20, 4096, 1 << 20
_PAIRS = np.frombuffer("".join(a + b for a in BASES for b in BASES).encode(), dtype="S2")
_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
_MAGIC = b"\x1f\x8b\x08\x04"
SCHEMA = "file string, ordinal long, qname string, flag int, contig string, pos long, end long, mapq int, cigar string, seq string, quals array<int>, tags map<string,string>"
_ARROW = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("qname", pa.string()), ("flag", pa.int32()), ("contig", pa.string()), ("pos", pa.int64()), ("end", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()), ("seq", pa.string()), ("quals", pa.list_(pa.int32())), ("tags", pa.map_(pa.string(), pa.string()))])


# --- blocks ---------------------------------------------------------------------------------------
def block_size(head: bytes) -> int | None:
    """The length of the compressed block that begins so; none if none does."""
    if len(head) < 18 or head[:4] != _MAGIC:
        return None
    extra, at = struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(12 + extra, len(head)):
        kind, n = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if kind == b"BC" and n == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    return None


class Blocks:
    """The compressed blocks of a file from an offset on, one by one; ``read`` counts those that were inflated."""

    def __init__(self, f, at: int):
        self.f, self.size, self.at, self.held, self.read = f, f.size(), at, b"", 0
        f.seek(at)

    def bytes(self, n: int) -> bytes:
        while len(self.held) < n and (more := self.f.read(max(BUFFER, n - len(self.held)))):
            self.held += more
        return self.held[:n]

    def next(self) -> tuple[int, bytes] | None:
        """(offset, content) of the next block; none at the end."""
        head = self.bytes(64)
        if not head:
            return None
        n = block_size(head)
        if n is None or len(body := self.bytes(n)) < n:
            raise ValueError(f"no compressed block at {self.at}")
        extra = struct.unpack_from("<H", body, 10)[0]
        data, at = zlib.decompress(body[12 + extra : -8], -15), self.at
        self.held, self.at, self.read = self.held[n:], self.at + n, self.read + 1
        return at, data


def first_block(f, lo: int) -> int:
    """The offset of the first block at or after lo: one that another block, or the file's end, follows."""
    size, at = f.size(), lo
    while at < size:
        f.seek(at)
        data = f.read(BUFFER)
        i = data.find(_MAGIC)
        while i >= 0:
            f.seek(at + i)
            n = block_size(f.read(64))
            if n is not None:
                f.seek(at + i + n)
                after = f.read(64)
                if at + i + n == size or block_size(after) is not None:
                    return at + i
            i = data.find(_MAGIC, i + 1)
        at += max(len(data) - 3, 1)
    return size


# --- records --------------------------------------------------------------------------------------
class Header:
    def __init__(self, blocks: Blocks):
        self.marks: list[tuple[int, int]] = []
        self.data = b""
        take = lambda n: self._take(blocks, n)
        if take(4) != b"BAM\1":
            raise ValueError("not a BAM file")
        self.text = take(struct.unpack("<i", take(4))[0]).rstrip(b"\0").decode()
        self.names, self.lengths = [], []
        for _ in range(struct.unpack("<i", take(4))[0]):
            self.names.append(take(struct.unpack("<i", take(4))[0])[:-1].decode())
            self.lengths.append(struct.unpack("<i", take(4))[0])
        # where the first record begins: a block and an offset in it
        self.block, self.within = self._place(blocks)

    _at = 0

    def _take(self, blocks: Blocks, n: int) -> bytes:
        while len(self.data) - self._at < n:
            got = blocks.next()
            if got is None:
                raise ValueError("the header of a BAM file ends early")
            self.marks.append((got[0], len(self.data)))
            self.data += got[1]
        out = self.data[self._at : self._at + n]
        self._at += n
        return out

    def _place(self, blocks: Blocks) -> tuple[int, int]:
        if self._at == len(self.data):
            return blocks.at, 0
        block, start = next(m for m in reversed(self.marks) if m[1] <= self._at)
        return block, self._at - start


def plausible(b: bytes, at: int, header: Header) -> int | None:
    """The place after the record at a place; none if none can begin there, -1 if the bytes end before it is known."""
    if at + 36 > len(b):
        return -1
    n, ref, pos, l_name, _, _, n_ops, _, l_seq, other, other_pos = struct.unpack_from("<iiiBBHHHiii", b, at)
    refs = len(header.names)
    if not 33 <= n < 1 << 28 or not -1 <= ref < refs or not -1 <= other < refs or pos < -1 or other_pos < -1 or l_name < 1 or l_seq < 0:
        return None
    if 32 + l_name + 4 * n_ops + (l_seq + 1) // 2 + l_seq > n or (ref >= 0 and pos > header.lengths[ref]) or (other >= 0 and other_pos > header.lengths[other]):
        return None
    name = b[at + 36 : at + 36 + l_name]
    if len(name) == l_name and (name[-1] or any(not 33 <= c <= 126 for c in name[:-1])):
        return None
    ops = b[at + 36 + l_name : at + 36 + l_name + 4 * n_ops]
    if any(ops[i] & 15 > 8 for i in range(0, len(ops) - 3, 4)):
        return None
    return at + 4 + n


class Records:
    """The records of a file from a place on: (virtual offset, bytes) while they begin before a limit."""

    def __init__(self, blocks: Blocks):
        self.blocks, self.data, self.marks, self.at = blocks, b"", [], 0

    def more(self) -> bool:
        got = self.blocks.next()
        if got is None:
            return False
        if self.at > 1 << 22:  # what has been read goes
            cut = max([m for m in self.marks if m[1] <= self.at], key=lambda m: m[1])[1]
            self.data, self.marks, self.at = self.data[cut:], [(c, s - cut) for c, s in self.marks if s >= cut], self.at - cut
        self.marks.append((got[0], len(self.data)))
        self.data += got[1]
        return True

    def offset(self, at: int) -> int:
        i = len(self.marks) - 1
        while self.marks[i][1] > at:
            i -= 1
        return self.marks[i][0] << 16 | at - self.marks[i][1]

    def synchronise(self, header: Header, limit: int) -> bool:
        """Goes to the first record that begins in the blocks before the limit; false if none does."""
        at, chain = 0, 5
        while True:
            while at >= len(self.data):
                if self.blocks.at >= limit or not self.more():
                    return False
            if self.offset(at) >> 16 >= limit:
                return False
            place, good = at, True
            for _ in range(chain):
                while (then := plausible(self.data, place, header)) == -1:
                    if not self.more():
                        then = place if place == len(self.data) and place > at else None
                        break
                if then is None:
                    good = False
                    break
                if then == place:
                    break
                place = then
            if good:
                self.at = at
                return True
            at += 1

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        while True:
            while len(self.data) - self.at < 4:
                if not self.more():
                    return
            n = struct.unpack_from("<i", self.data, self.at)[0]
            at = self.offset(self.at)
            while len(self.data) - self.at < 4 + n:
                if not self.more():
                    raise ValueError("a BAM file ends within a record")
            yield at, self.data[self.at + 4 : self.at + 4 + n]
            self.at += 4 + n


def tags_of(b: bytes) -> list[tuple[str, str]]:
    """Tags as text; arrays as their type and values, joined by commas."""
    out, at = [], 0
    kinds = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
    while at + 3 <= len(b):
        name, kind = b[at : at + 2].decode("latin-1"), chr(b[at + 2])
        at += 3
        if kind in "ZH":
            end = b.index(0, at)
            value, at = b[at:end].decode("utf-8", "replace"), end + 1
        elif kind == "A":
            value, at = chr(b[at]), at + 1
        elif kind == "B":
            sub, n = chr(b[at]), struct.unpack_from("<i", b, at + 1)[0]
            f = f"<{n}{kinds[sub]}"
            value = ",".join([sub, *(f"{v:g}" if sub == "f" else str(v) for v in struct.unpack_from(f, b, at + 5))])
            at += 5 + struct.calcsize(f)
        else:
            v = struct.unpack_from("<" + kinds[kind], b, at)[0]
            value, at = (f"{v:g}" if kind == "f" else str(v)), at + struct.calcsize(kinds[kind])
        out.append((name, value))
    return out


def fields(b: bytes, names: list[str]) -> tuple:
    """(qname, flag, contig, pos, end, mapq, cigar, seq, quals, tags) of a record."""
    ref, pos, l_name, mapq, _, n_ops, flag, n = struct.unpack_from("<iiBBHHHi", b)
    at = 32 + l_name
    name = b[32 : at - 1].decode("latin-1")
    ops = struct.unpack_from(f"<{n_ops}I", b, at)
    at += 4 * n_ops
    seq = _PAIRS[np.frombuffer(b, dtype=np.uint8, count=(n + 1) // 2, offset=at)].tobytes()[:n].decode()
    at += (n + 1) // 2
    quals = np.frombuffer(b, dtype=np.uint8, count=n, offset=at)
    tags = tags_of(b[at + n :])
    if n_ops == 2 and ops[0] & 15 == 4 and ops[0] >> 4 == n and ops[1] & 15 == 3:  # a string of too many operations stands in a tag
        long_ = next((v for k, v in tags if k == "CG"), None)
        if long_:
            ops, tags = tuple(map(int, long_.split(",")[1:])), [t for t in tags if t[0] != "CG"]
    cigar = "".join(f"{o >> 4}{OPS[o & 15]}" for o in ops) or "*"
    end = pos + sum(o >> 4 for o in ops if OPS[o & 15] in TAKES)
    return name, flag, names[ref] if ref >= 0 else None, pos, end, mapq, cigar, seq or "*", quals if n and quals[0] != 255 else quals[:0], tags


def batch_of(path: str, rows: list[tuple]) -> pa.RecordBatch:
    ordinals, *cols = zip(*rows, strict=True)
    name, flag, contig, pos, end, mapq, cigar, seq, quals, tags = cols
    q = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, quals)]), pa.int32()), pa.array(np.concatenate(quals).astype(np.int32)))
    columns = [pa.array([path] * len(rows)), pa.array(ordinals, pa.int64()), pa.array(name), pa.array(flag, pa.int32()), pa.array(contig, pa.string()), pa.array(pos, pa.int64()), pa.array(end, pa.int64()), pa.array(mapq, pa.int32()), pa.array(cigar), pa.array(seq), q, pa.array(tags, _ARROW.field("tags").type)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


# --- the index ------------------------------------------------------------------------------------
def bin_of(lo: int, hi: int) -> int:
    """The smallest bin that holds [lo, hi)."""
    hi -= 1
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if lo >> shift == hi >> shift:
            return first + (lo >> shift)
    return 0


def bins_of(lo: int, hi: int) -> set[int]:
    """The bins that may hold records that meet [lo, hi)."""
    hi, out = min(hi, 1 << 29) - 1, {0}
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        out.update(range(first + (lo >> shift), first + (hi >> shift) + 1))
    return out


def indexed(path: str) -> list[tuple[dict[int, list[tuple[int, int]]], list[int]]]:
    """For each contig the chunks of virtual offsets by bin, and the least offset by window of 16,384 places."""
    fs, at = opened(path)
    with fs.open_input_file(at) as f:
        b = f.read()
    if b[:4] != b"BAI\1":
        raise ValueError(f"not an index: {path}")
    n, at, out = struct.unpack_from("<i", b, 4)[0], 8, []
    for _ in range(n):
        bins: dict[int, list[tuple[int, int]]] = {}
        n_bins, at = struct.unpack_from("<i", b, at)[0], at + 4
        for _ in range(n_bins):
            number, k = struct.unpack_from("<Ii", b, at)
            v = struct.unpack_from(f"<{2 * k}Q", b, at + 8)
            bins[number] = list(zip(v[::2], v[1::2], strict=True))
            at += 8 + 16 * k
        k, at = struct.unpack_from("<i", b, at)[0], at + 4
        out.append((bins, list(struct.unpack_from(f"<{k}Q", b, at))))
        at += 8 * k
    return out


def chunks(index, contig: int, lo: int, hi: int) -> list[tuple[int, int]]:
    """Rising ranges of virtual offsets that hold all records of a contig that meet [lo, hi)."""
    if not 0 <= contig < len(index) or lo >= hi:
        return []
    bins, windows = index[contig]
    least = windows[min(lo >> 14, len(windows) - 1)] if windows else 0
    found = sorted(c for k in bins_of(lo, hi) & bins.keys() if k != 37450 for c in bins[k] if c[1] > least)
    out: list[tuple[int, int]] = []
    for a, z in found:
        a = max(a, least)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


# --- the source -----------------------------------------------------------------------------------
@dataclass
class Range(InputPartition):
    """Blocks of a file by byte range, or records by ranges of virtual offsets."""

    path: str
    lo: int = 0
    hi: int = 0
    chunks: tuple = ()


class BamReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT))
        self.contigs: set[str] | None = None
        self.low, self.high = 0, 1 << 29

    def pushFilters(self, filters):  # noqa: N802
        """Contigs and bounds of places are remembered; all filters are left to be applied to the rows, too."""
        for f in filters:
            name, value = getattr(f, "attribute", ("",))[-1], getattr(f, "value", None)
            if name == "contig" and isinstance(f, (EqualTo, In)):
                named = {value} if isinstance(f, EqualTo) else set(value)
                self.contigs = named if self.contigs is None else self.contigs & named
            elif name == "pos" and isinstance(f, EqualTo):
                self.low, self.high = max(self.low, value), min(self.high, value + 1)
            elif name == "pos" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.high = min(self.high, value + isinstance(f, LessThanOrEqual))
            elif name == "pos" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, value + isinstance(f, GreaterThan))
            elif name == "end" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                # a record that ends after a place meets it or lies behind it
                self.low = max(self.low, value - isinstance(f, GreaterThanOrEqual))
            yield f

    def partitions(self):
        out = []
        for path, size in listed(self.path, (".bam",)):
            if self.contigs is not None and exists(f"{path}.bai"):
                fs, at = opened(path)
                with fs.open_input_file(at) as f:
                    names = Header(Blocks(f, 0)).names
                index = indexed(f"{path}.bai")
                # zero-length alignments count as one place, as in the index
                found = sorted(c for k, name in enumerate(names) if name in self.contigs for c in chunks(index, k, max(self.low - 1, 0), self.high))
                held, total = [], 0
                for c in found:
                    held.append(c)
                    total += (c[1] >> 16) - (c[0] >> 16)
                    if total >= self.split:
                        out.append(Range(path, chunks=tuple(held)))
                        held, total = [], 0
                if held:
                    out.append(Range(path, chunks=tuple(held)))
            else:
                n = max(1, -(-size // self.split))
                out += [Range(path, i * size // n, (i + 1) * size // n) for i in range(n)]
        return out or [Range("")]

    def records(self, part: Range) -> Iterator[tuple]:
        """Rows of a part; ``blocks_read`` is the number of blocks inflated, the header's not counted."""
        self.blocks_read = 0
        if not part.path:
            return
        fs, at = opened(part.path)
        with fs.open_input_file(at) as f:
            header = Header(Blocks(f, 0))
            if part.chunks:
                for lo, hi in part.chunks:
                    r = Records(Blocks(f, lo >> 16))
                    if r.more():
                        r.at = lo & 0xFFFF
                        for offset, b in r:
                            if offset >= hi:
                                break
                            yield offset, *fields(b, header.names)
                    self.blocks_read += r.blocks.read
                return
            start = header.block if part.lo == 0 else max(first_block(f, part.lo), header.block)
            if start >= part.hi:
                return
            r = Records(Blocks(f, start))
            if start == header.block:
                if not r.more():
                    return
                r.at = header.within
            elif not r.synchronise(header, part.hi):
                return
            for offset, b in r:
                if offset >> 16 >= part.hi:
                    break
                yield offset, *fields(b, header.names)
            self.blocks_read = r.blocks.read

    def read(self, part: Range):
        rows = []
        for r in self.records(part):
            rows.append(r)
            if len(rows) == BATCH:
                yield batch_of(part.path, rows)
                rows = []
        if rows:
            yield batch_of(part.path, rows)


# --- the sink -------------------------------------------------------------------------------------
class Blocked:
    """A stream of compressed blocks; ``offset`` is the virtual offset of the next byte."""

    FULL = 0xFF00

    def __init__(self, f):
        self.f, self.written, self.held = f, 0, bytearray()

    @property
    def offset(self) -> int:
        return self.written << 16 | len(self.held)

    def write(self, b: bytes) -> None:
        if len(self.held) + len(b) > self.FULL and self.held:
            self.flush()
        self.held += b
        while len(self.held) >= self.FULL:
            self.flush()

    def flush(self) -> None:
        data, self.held = bytes(self.held[: self.FULL]), self.held[self.FULL :]
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(data) + c.flush()
        head = struct.pack("<4sIBBH2sHH", _MAGIC, 0, 0, 255, 6, b"BC", 2, len(body) + 25)
        self.f.write(head + body + struct.pack("<II", zlib.crc32(data), len(data)))
        self.written += len(head) + len(body) + 8

    def close(self) -> None:
        while self.held:
            self.flush()
        self.f.write(_END)


_CODE = {c: i for i, c in enumerate(BASES)}
_OP = re.compile(r"(\d+)([MIDNSHP=X])")


def record_of(name: str, flag: int, ref: int, pos: int, mapq: int, cigar: str, seq: str, qual: bytes | None, tags: list[tuple[str, str]]) -> tuple[bytes, int]:
    """A record's bytes and the place after its last base."""
    ops = [(int(n), o) for n, o in _OP.findall(cigar or "")]
    span = sum(n for n, o in ops if o in TAKES)
    seq = "" if seq == "*" else seq
    code = [_CODE.get(c, 15) for c in seq.upper()] + [0] * (len(seq) % 2)
    packed = bytes(a << 4 | b for a, b in zip(code[::2], code[1::2], strict=True))
    title = (name or "*").encode() + b"\0"
    if len(title) > 255:
        raise ValueError(f"a read's name has over 254 bytes: {name[:40]}...")
    extra = b"".join(k.encode() + b"Z" + v.encode() + b"\0" for k, v in tags)
    coded = [n << 4 | OPS.index(o) for n, o in ops]
    if len(coded) > 65535:
        extra += b"CGBI" + struct.pack(f"<i{len(coded)}I", len(coded), *coded)
        coded = [len(seq) << 4 | 4, span << 4 | 3]
    b = struct.pack("<iiBBHHHiiii", ref, pos, len(title), mapq, bin_of(max(pos, 0), max(pos, 0) + max(span, 1)), len(coded), flag, len(seq), -1, -1, 0)
    b += title + struct.pack(f"<{len(coded)}I", *coded) + packed + (qual if qual is not None else b"\xff" * len(seq)) + extra
    return struct.pack("<i", len(b)) + b, pos + max(span, 1)


class Index:
    def __init__(self, refs: int):
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(refs)]
        self.windows: list[list[int]] = [[] for _ in range(refs)]

    def add(self, ref: int, lo: int, hi: int, start: int, end: int) -> None:
        held = self.bins[ref].setdefault(bin_of(lo, hi), [])
        if held and held[-1][1] >> 16 == start >> 16:
            held[-1][1] = end
        else:
            held.append([start, end])
        w = self.windows[ref]
        for i in range(lo >> 14, (hi - 1 >> 14) + 1):
            w.extend([0] * (i + 1 - len(w)))
            w[i] = w[i] or start

    def bytes(self) -> bytes:
        out = [b"BAI\1", struct.pack("<i", len(self.bins))]
        for bins, windows in zip(self.bins, self.windows, strict=True):
            out.append(struct.pack("<i", len(bins)))
            for k, held in bins.items():
                out.append(struct.pack(f"<Ii{2 * len(held)}Q", k, len(held), *(v for c in held for v in c)))
            last, filled = 0, []
            for v in windows:  # a window without records has the offset of the one before
                last = v or last
                filled.append(last)
            out.append(struct.pack(f"<i{len(filled)}Q", len(filled), *filled))
        return b"".join(out)


@dataclass
class Part(WriterCommitMessage):
    part: int
    path: str
    rows: int


class BamWriter(DataSourceArrowWriter):
    """Rows (name, contig, start, cigar, seq, qual; flag, mapq and tags if there are) of one partition as one part."""

    def __init__(self, options, schema, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.contigs = [(n, int(k)) for n, k in json.loads(options["contigs"])]
        self.group, self.overwrite, self.columns = options.get("readGroup", ""), overwrite, schema.fieldNames()
        self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def write(self, iterator):
        context = TaskContext.get()
        fs, top = opened(self.temporary)
        fs.create_dir(top, recursive=True)
        at = f"{top}/{context.partitionId():05d}-{context.taskAttemptId()}.bam"
        try:
            return Part(context.partitionId(), at, self._written(fs, at, iterator))
        except BaseException:
            for name in (at, f"{at}.bai"):
                if fs.get_file_info(name).type == pafs.FileType.File:
                    fs.delete_file(name)
            raise

    def _written(self, fs, at: str, iterator) -> int:
        head = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in self.contigs) + (f"@RG\tID:{self.group}\tSM:{self.group}\n" if self.group else "")
        number, index, n, last = {c: i for i, (c, _) in enumerate(self.contigs)}, Index(len(self.contigs)), 0, (-1, -1)
        group = [("RG", self.group)] if self.group else []
        with fs.open_output_stream(at) as f:
            out = Blocked(f)
            out.write(b"BAM\1" + struct.pack("<i", len(head)) + head.encode() + struct.pack("<i", len(self.contigs)) + b"".join(struct.pack("<i", len(c.encode()) + 1) + c.encode() + b"\0" + struct.pack("<i", k) for c, k in self.contigs))
            out.flush()
            for b in iterator:
                given = {c: b.column(i).to_pylist() for i, c in enumerate(self.columns)}
                for i in range(b.num_rows):
                    get = lambda c, default=None, i=i: given[c][i] if c in given and given[c][i] is not None else default
                    ref, pos = number[given["contig"][i]], int(given["start"][i])
                    if (ref, pos) < last:
                        raise ValueError("rows of a part are not in order of contig and start")
                    last, qual = (ref, pos), get("qual")
                    tags = [t for t in (get("tags", []).items() if isinstance(get("tags", []), dict) else get("tags", [])) if t[0] != "RG"] + group
                    record, end = record_of(get("name", "*"), get("flag", 0), ref, pos, get("mapq", 60), get("cigar", ""), get("seq", "*"), None if qual is None else bytes(ord(c) - 33 for c in qual), tags)
                    if len(out.held) + len(record) > out.FULL and out.held:
                        out.flush()
                    start = out.offset
                    out.write(record)
                    index.add(ref, pos, end, start, out.offset)
                    n += 1
            out.close()
        with fs.open_output_stream(f"{at}.bai") as f:
            f.write(index.bytes())
        return n

    def commit(self, messages):
        fs, top = opened(self.path)
        old = [] if not self.overwrite else [i.path for i in fs.get_file_info(pafs.FileSelector(top)) if i.type == pafs.FileType.File and i.base_name.endswith((".bam", ".bai"))]
        for p in old:
            fs.delete_file(p)
        taken = {i.base_name for i in fs.get_file_info(pafs.FileSelector(top))}
        first = 0 if not taken else 1 + max((int(m[1]) for n in taken if (m := re.fullmatch(r"part-(\d+)\.bam", n))), default=-1)
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.part):
            if m.rows or m.part == 0:
                fs.move(m.path, f"{top}/part-{first + m.part:05d}.bam")
                fs.move(f"{m.path}.bai", f"{top}/part-{first + m.part:05d}.bam.bai")
        self.abort(messages)

    def abort(self, messages):
        fs, top = opened(self.temporary)
        if fs.get_file_info(top).type == pafs.FileType.Directory:
            fs.delete_dir(top)


class Bam(DataSource):
    @classmethod
    def name(cls):
        return "bam"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return BamReader(self.options)

    def writer(self, schema, overwrite):
        return BamWriter(self.options, schema, overwrite)


def write_bam(reads: DataFrame, lengths: DataFrame, path: str, parts: int | None = None, group: str = "L1") -> None:
    """Consensus reads as a folder of BAM parts in order of place, each with its index; contigs stand in order of name.

    lengths: (contig, length), a row for each contig; they reach the driver, as each part's header holds them.
    """
    spark = reads.sparkSession
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Bam)
    contigs = [(r["contig"], int(r["length"])) for r in lengths.select("contig", "length").orderBy("contig").collect()]
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [c for c in ("name", "contig", "start", "cigar", "seq", "qual", "flag", "mapq", "tags") if c in reads.columns]
    # the name, too: a place that very many reads share is not one part
    x = reads.select(*cols).repartitionByRange(n, "contig", "start", "name").sortWithinPartitions("contig", "start", "name")
    x.withColumn("start", F.col("start").cast("long")).write.format("bam").option("contigs", json.dumps(contigs)).option("readGroup", group).mode("overwrite").save(path)
