r"""Secrets in texts and in what is wrapped in them, by a worklist of decoded layers.

A text is a layer; so is what comes of it when percent escapes, Unicode escapes (\xHH, \uHHHH with pairs, \u{...}, \UHHHHHHHH,
&#N; and &#xH;) are replaced, and what a base64 run decodes to (either alphabet, padded or not, lines joined), if
that is text or a compressed stream (gzip, zlib, bzip2, xz, zstd) of text. Each new layer goes on the list, is scanned
by the same rules and unwrapped in turn, until nothing new comes. A layer that has been seen at the same
place is not taken again, so layers that unwrap to themselves, or in a circle, end.

Each character of a layer knows where in the text it comes from: an escape as a whole, the base64
characters of a byte, or the whole run of a compressed stream. A secret's span is that of its first and
last character in the text, in code points, end exclusive; spans of all layers are one set, those of the text itself among them.

The rules (kinds in this order) are the contract's: assign, access, hex; a match whose secret is too short is dropped
after matching, so it still takes its place among non-overlapping ones.

Work is done row by row inside tasks; texts are read whole and nothing is shuffled, so rows that repeat cost what
they weigh and a lost executor's rows are done anew. A compressed stream of over ``LAYER`` characters
is cut there, so that a small text cannot fill a task's memory; ``cut`` counts such streams. Null and empty texts have no spans.
Rows that share a doc_id, or are equal, are rows of their own; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAYER = 16_000_000
#: Kinds of secrets, how they look, and the least length of the group that must be long enough.
KINDS = ("assign", "access", "hex")
RULES = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32),
)
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_LINES = re.compile(r"[A-Za-z0-9+/]{40,}(?:\r?\n[A-Za-z0-9+/]{4,})+={0,2}")
_PARTS = (re.compile(r"[A-Za-z0-9+/]{16,}={0,2}"), re.compile(r"[A-Za-z0-9_-]{16,}={0,2}"), re.compile(r"[A-Za-z0-9]{16,}={0,2}"))
#: How streams begin.
STREAMS = ((b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"BZh", bz2.BZ2Decompressor), (b"\xfd7zXZ\x00", lzma.LZMADecompressor), (b"\x28\xb5\x2f\xfd", None))
_ODD = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")


class Layer:
    """A text, and where each of its characters comes from (None: from itself)."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text, self.start, self.end = text, start, end

    def span(self, lo: int, hi: int) -> tuple[int, int]:
        return (lo, hi) if self.start is None else (int(self.start[lo]), int(self.end[hi - 1]))

    def places(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        if self.start is None:
            at = np.arange(lo, hi, dtype=np.int64)
            return at, at + 1
        return self.start[lo:hi], self.end[lo:hi]

    def key(self) -> tuple:
        """The same text from the same place."""
        return hashlib.sha256(self.text.encode("utf-8", "surrogatepass")).digest(), self.span(0, len(self.text))


def secrets(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) by the rules, kind by kind."""
    for kind, rule, group, least in RULES:
        for m in rule.finditer(text):
            if m.end(group) - m.start(group) >= least:
                yield kind, m.start(), m.end()


def replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match of the pattern replaced by decode(match): pairs of a character and its place in the match; none if it has no match."""
    out, starts, ends, last, changed = [], [], [], 0, False
    for m in pattern.finditer(layer.text):
        got = decode(m[0])
        if got is None:
            continue
        changed = True
        for a, b in ((last, m.start()),):
            s, e = layer.places(a, b)
            out.append(layer.text[a:b])
            starts.append(s)
            ends.append(e)
        s, e = layer.places(m.start(), m.end())
        out.append("".join(c for c, _, _ in got))
        starts.append(s[[a for _, a, _ in got]])
        ends.append(e[[b - 1 for _, _, b in got]])
        last = m.end()
    if not changed:
        return None
    s, e = layer.places(last, len(layer.text))
    return Layer("".join([*out, layer.text[last:]]), np.concatenate([*starts, s]), np.concatenate([*ends, e]))


def characters(data: bytes) -> list[tuple[str, int, int]] | None:
    """(character, first byte, end byte) of UTF-8; none if it isn't that."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    size = [1 if c < "\x80" else len(c.encode()) for c in text]
    at = np.cumsum([0, *size]).tolist()
    return [(c, at[i], at[i + 1]) for i, c in enumerate(text)]


def percent(run: str) -> list[tuple[str, int, int]]:
    """A run of escapes: UTF-8 where it is that, else the ASCII escapes alone, the others as they stand."""
    data = bytes.fromhex(run.replace("%", ""))
    got = characters(data)
    if got is not None:
        return [(c, 3 * a, 3 * b) for c, a, b in got]
    out = []
    for i, v in enumerate(data):
        out += [(chr(v), 3 * i, 3 * i + 3)] if v < 128 else [(run[3 * i + j], 3 * i + j, 3 * i + j + 1) for j in range(3)]
    return out


def unicode(run: str) -> list[tuple[str, int, int]] | None:
    r"""One escape, or a run of \uHHHH in which pairs are one character; lone halves of pairs and numbers beyond the last character stay."""
    if re.match(r"\\u[0-9A-Fa-f]{4}", run):
        units, out, i = [int(run[k + 2 : k + 6], 16) for k in range(0, len(run), 6)], [], 0
        while i < len(units):
            u = units[i]
            if 0xD800 <= u < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1] < 0xE000:
                out.append((chr(0x10000 + ((u - 0xD800) << 10) + units[i + 1] - 0xDC00), 6 * i, 6 * i + 12))
                i += 2
                continue
            out += [(run[6 * i + j], 6 * i + j, 6 * i + j + 1) for j in range(6)] if 0xD800 <= u < 0xE000 else [(chr(u), 6 * i, 6 * i + 6)]
            i += 1
        return out if len(out) < len(run) else None
    digits = run[3:-1] if run[1] in "u#" and run[2] in "{xX" else run[2:-1] if run[0] == "&" else run[2:]
    value = int(digits, 10 if run[0] == "&" and run[2] not in "xX" else 16)
    return None if value > 0x10FFFF or 0xD800 <= value < 0xE000 else [(chr(value), 0, len(run))]


def expanded(data: bytes) -> tuple[bytes, bool] | None:
    """What a compressed stream holds, and whether it was cut at the limit; none if it is no stream."""
    make = next((f for mark, f in STREAMS if data.startswith(mark)), 0)
    if make == 0:
        if len(data) < 2 or data[0] & 15 != 8 or (data[0] << 8 | data[1]) % 31 or data[1] & 32:
            return None
        make = zlib.decompressobj
    try:
        if make is None:
            import io

            import zstandard

            got = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data)).read(LAYER + 1)
        else:
            got = make().decompress(data, LAYER + 1)
    except Exception as e:  # noqa: BLE001  each library has its own errors for a stream that is none
        if isinstance(e, (ImportError, MemoryError)):
            raise
        return None
    return got[:LAYER], len(got) > LAYER


def wrapped(layer: Layer) -> Iterator[tuple[Layer, bool]]:
    """What the layer's base64 runs hold, and whether it was cut."""
    runs = [m.span() for m in _RUN.finditer(layer.text)]
    if "\n" in layer.text:
        runs += [m.span() for m in _LINES.finditer(layer.text)]
    for lo, hi in runs:
        whole = layer.text[lo:hi]
        spans = [(lo, hi)] if "\n" in whole else [(lo + m.start(), lo + m.end()) for p in _PARTS for m in p.finditer(whole)]
        taken: list[tuple[int, int]] = []
        for a, b in sorted(set(spans), key=lambda s: (s[0] - s[1], s[0])):  # the longest first; what lies in one that held a layer is a piece of it
            if any(x <= a and b <= y for x, y in taken):
                continue
            at = [i for i in range(a, b) if layer.text[i] not in "=\r\n"]
            code = "".join(layer.text[i] for i in at) if len(at) < b - a else layer.text[a:b]
            code = code[: len(code) - (len(code) % 4 == 1)]
            if "-" in code or "_" in code:
                code = code.replace("-", "+").replace("_", "/")
            try:
                data = base64.b64decode(code + "=" * (-len(code) % 4), validate=True)
            except (binascii.Error, ValueError):
                continue
            got = expanded(data)
            if got is not None:
                text = got[0].decode("utf-8", "replace")
                if text and len(_ODD.findall(text)) + text.count("�") <= len(text) // 10:
                    s, e = layer.span(a, b)
                    taken.append((a, b))
                    yield Layer(text, np.full(len(text), s), np.full(len(text), e)), got[1]
                continue
            chars = characters(data) if not _ODD.search(data.decode("latin-1")) else None
            if chars:
                taken.append((a, b))
                at = np.array(at)
                s, e = layer.places(a, b)
                first = at[[8 * x // 6 for _, x, _ in chars]] - a
                last = at[[min((8 * y + 5) // 6, len(code)) - 1 for _, _, y in chars]] - a
                yield Layer("".join(c for c, _, _ in chars), s[first], e[last]), False


def unwrapped(layer: Layer) -> Iterator[tuple[Layer, bool]]:
    """The layers one step below."""
    if "%" in layer.text and (x := replaced(layer, _PERCENT, percent)):
        yield x, False
    if ("\\" in layer.text or "&#" in layer.text) and (x := replaced(layer, _UNICODE, unicode)):
        yield x, False
    yield from wrapped(layer)


def scanned(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int, int]:
    """(spans of the text itself, all spans, layers, streams that were cut); spans by start, then kind, then end."""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = sorted(secrets(text), key=order)
    top = Layer(text)
    spans, todo, seen, cut = set(base), [top], set(), 0
    while todo:
        layer = todo.pop()
        if layer is not top:
            spans.update((kind, *layer.span(a, b)) for kind, a, b in secrets(layer.text))
        for child, short in unwrapped(layer):
            if not seen:
                seen.add(top.key())
            if child.text and (key := child.key()) not in seen:
                seen.add(key)
                todo.append(child)
                cut += short
    return base, sorted(spans, key=order), max(len(seen), 1), cut


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long, layers long, cut long"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the numbers of secrets of each kind in the text itself, their digest, all spans, the number of layers and of cut streams."""
    names = [c.split(" ")[0] for c in _OUT.split(", ")]

    def run(batches):
        for b in batches:
            rows = []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                base, spans, layers, cut = scanned(text.as_py())
                n = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((i, *n, hashlib.sha256(written(base).encode()).hexdigest(), written(spans), len(spans), layers, cut))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, _OUT)
