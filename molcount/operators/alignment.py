"""Alignments of short sequences in batches: each step works on a column of many sequences at once."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Scores of an alignment of two reads of a molecule: a gap of k letters costs OPEN + k EXTEND.
MATCH, MISMATCH, OPEN, EXTEND, BAND = 2, -2, 6, 1, 16
#: Up to so many unlike letters an alignment without gaps is the best one of equally long sequences.
UNGAPPED = (2 * (OPEN + EXTEND) + MATCH) // (MATCH - MISMATCH)


def letters(texts: Iterable[str], width: int) -> np.ndarray:
    """A row of bytes for each text, filled with 0."""
    return np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("latin-1", "replace"), dtype=np.uint8).reshape(-1, width)


# --- two sequences from end to end -------------------------------------------------------------------
def _gapped(a: np.ndarray, b: np.ndarray, band: int) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
    """Best alignments of rows of a with rows of b, within a band around the diagonal.

    Gives, for each place of a, the letter of b that stands there (45, '-', where none does), and the letters of b
    between places, as (place of a that follows, number in the gap, letter). Of equal alignments the one that
    prefers, from the end, a letter on a letter, then one of a alone, then one of b alone.
    """
    n, la = a.shape
    lb = b.shape[1]
    lo, hi = min(0, lb - la) - band, max(0, lb - la) + band
    width, none = hi - lo + 1, -(1 << 28)
    d = np.arange(lo, hi + 1)
    padded = np.zeros((n, lb + 2 * (la + width) + 2), dtype=np.uint8)
    shift = la + width
    padded[:, shift : shift + lb] = b
    from_ = np.zeros((la + 1, n, width), dtype=np.uint8)  # 0 letters, 1 a alone, 2 b alone; with bits 4: gap in b goes on, 8: gap in a goes on, 16: before the last gap in a, a alone
    best, gap = np.full((n, width), none), np.full((n, width), none)
    for i in range(la + 1):
        j = i + d
        valid = (j >= 0) & (j <= lb)
        if i == 0:
            here = np.where(j == 0, 0, none)[None, :].repeat(n, 0)
            gap = np.full((n, width), none)
            longer = np.zeros((n, width), dtype=bool)
            alone = np.zeros((n, width), dtype=bool)
        else:
            up = np.full((n, width), none)
            up[:, :-1] = best[:, 1:]
            up_gap = np.full((n, width), none)
            up_gap[:, :-1] = gap[:, 1:]
            opened, extended = up - OPEN - EXTEND, up_gap - EXTEND
            longer = extended > opened
            gap = np.where(longer, extended, opened)
            other = padded[:, shift + i + lo - 1 : shift + i + hi]
            diagonal = best + np.where((other == a[:, i - 1 : i]), MATCH, MISMATCH)
            diagonal[:, j < 1] = none
            alone = gap > diagonal
            here = np.where(alone, gap, diagonal)
        here[:, ~valid] = none
        # a gap in a that ends here began at the best place before it in the row
        reach = np.maximum.accumulate(here + EXTEND * d, axis=1)
        side = np.full((n, width), none)
        side[:, 1:] = reach[:, :-1] - OPEN - EXTEND * d[1:]
        onward = np.zeros((n, width), dtype=bool)
        onward[:, 2:] = side[:, 2:] > here[:, 1:-1] - OPEN - EXTEND
        side[:, ~valid] = none
        beside = side > here
        best = np.where(beside, side, here)
        from_[i] = np.where(beside, 2, alone.astype(np.uint8)) | longer.astype(np.uint8) << 2 | onward.astype(np.uint8) << 3 | alone.astype(np.uint8) << 4
    placed = np.full((n, la), 45, dtype=np.uint8)
    inserted: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    rows, at_i, at_d = np.arange(n), np.full(n, la), np.full(n, lb - la - lo)
    state = np.full(n, -1)  # -1: take the cell's own; 1: in a gap of b; 2: in a gap of a; 3: the cell without a gap in a
    while True:
        live = np.flatnonzero((at_i > 0) | (at_d + lo > 0))
        if not len(live):
            break
        i, k = at_i[live], at_d[live]
        cell = from_[i, rows[live], k]
        own = cell & 3
        without = cell >> 4 & 1
        step = np.where(state[live] == -1, own, np.where(state[live] == 3, without, state[live]))
        for kind in (0, 1, 2):
            r = live[step == kind]
            if not len(r):
                continue
            c = from_[at_i[r], r, at_d[r]]
            if kind == 0:
                placed[r, at_i[r] - 1] = b[r, at_i[r] + at_d[r] + lo - 1]
                at_i[r] -= 1
                state[r] = -1
            elif kind == 1:
                state[r] = np.where(c >> 2 & 1, 1, -1)
                at_i[r] -= 1
                at_d[r] += 1
            else:
                for x, y, z in zip(r.tolist(), at_i[r].tolist(), b[r, at_i[r] + at_d[r] + lo - 1].tolist(), strict=True):
                    inserted[x].append((y, 0, z))
                state[r] = np.where(c >> 3 & 1, 2, 3)
                at_d[r] -= 1
    for x in range(n):
        out: list[tuple[int, int, int]] = []
        for place, _, letter in reversed(inserted[x]):
            out.append((place, out[-1][1] + 1 if out and out[-1][0] == place else 0, letter))
        inserted[x] = out
    return placed, inserted


def differences(centers: list[str], texts: list[str], band: int = BAND, cells: int = 1 << 25) -> list[list[tuple[int, int, str]]]:
    """Where each text, aligned to its center, is unlike it: (place of the center, -1, letter or '-'), and letters
    before a place as (place, number in the gap, letter). Pairs of the same lengths are aligned together."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    groups: dict[tuple[int, int], list[int]] = {}
    for i, (c, t) in enumerate(zip(centers, texts, strict=True)):
        groups.setdefault((len(c), len(t)), []).append(i)
    for (la, lb), at in groups.items():
        if not la or not lb:
            for i in at:
                out[i] = [(p, -1, "-") for p in range(la)] + [(0, k, t) for k, t in enumerate(texts[i])]
            continue
        step = max(1, cells // ((la + 1) * (abs(la - lb) + 2 * band + 1)))
        for lo in range(0, len(at), step):
            some = at[lo : lo + step]
            a, b = letters((centers[i] for i in some), la), letters((texts[i] for i in some), lb)
            todo = np.arange(len(some))
            if la == lb:
                unlike = a != b
                near = unlike.sum(1) <= UNGAPPED
                for r in np.flatnonzero(near).tolist():
                    out[some[r]] = [(int(p), -1, chr(b[r, p])) for p in np.flatnonzero(unlike[r])]
                todo = np.flatnonzero(~near)
            if len(todo):
                placed, inserted = _gapped(a[todo], b[todo], band)
                for k, r in enumerate(todo.tolist()):
                    out[some[r]] = [(int(p), -1, chr(placed[k, p])) for p in np.flatnonzero(placed[k] != a[r])] + [(p, s, chr(x)) for p, s, x in inserted[k]]
    return out


# --- an adapter in reads ------------------------------------------------------------------------------
def adapter_starts(reads: list[str], adapter: str, rate: float = 0.1, overlap: int = 3) -> np.ndarray:
    """Where an adapter begins in each read (its length if nowhere).

    An occurrence is the whole adapter, or a beginning of it of at least ``overlap`` letters at the read's end, with at
    most ``rate`` errors (unlike, missing or further letters) for each of its letters. The best has the largest number of letters
    less two for each error; of equals the first one. N in the adapter fits all letters.
    """
    m, width = len(adapter), max(map(len, reads), default=0)
    size = np.array([len(r) for r in reads], dtype=np.int64)
    best_score, best = np.full(len(reads), -1 << 30), size.copy()
    if not m or not width:
        return best
    x, big = letters(reads, width), 1 << 20
    allowed = [int(rate * i + 1e-9) for i in range(m + 1)]

    def offer(rows, i, key):
        errors, start = key // big, key % big
        score = i - 2 * errors
        ok = (errors <= allowed[i]) & ((score > best_score[rows]) | ((score == best_score[rows]) & (start < best[rows])))
        best_score[rows[ok]], best[rows[ok]] = score[ok], start[ok]

    # errors and start in one number, so that the least has the fewest errors and then the first start
    column = [np.full(len(reads), i * big, dtype=np.int64) for i in range(m + 1)]
    for j in range(width + 1):
        if j:
            new = [np.full(len(reads), j, dtype=np.int64)]
            for i in range(1, m + 1):
                unlike = (x[:, j - 1] != ord(adapter[i - 1])) if adapter[i - 1] != "N" else np.zeros(len(reads), dtype=bool)
                new.append(np.minimum(np.minimum(column[i - 1] + unlike * big, column[i] + big), new[i - 1] + big))
            column = new
        inside, ends = np.flatnonzero(size >= j), np.flatnonzero(size == j)
        if m >= overlap:
            offer(inside, m, column[m][inside])
        for i in range(max(overlap, 1), m):
            offer(ends, i, column[i][ends])
    return best


# --- mates ----------------------------------------------------------------------------------------------
_OTHER = bytes.maketrans(b"ACGTacgt", b"TGCAtgca")


def reverse_complement(text: str) -> str:
    return text.encode("latin-1", "replace").translate(_OTHER).decode("latin-1")[::-1]


def overlaps(first: list[str], second: list[str], least: int = 30, most: int = 5, share: float = 0.2) -> list[tuple[int, int] | None]:
    """(offset, unlike letters) of the reversed complement of each second mate against the first, or none.

    An overlap has ``least`` letters or more, and at most ``most`` unlike ones and that share of them. The best has the smallest share
    of unlike letters, then the most letters, then the smallest offset. Below 0 the insert is shorter than the reads.
    """
    out: list[tuple[int, int] | None] = [None] * len(first)
    groups: dict[tuple[int, int], list[int]] = {}
    for i, (a, b) in enumerate(zip(first, second, strict=True)):
        groups.setdefault((len(a), len(b)), []).append(i)
    for (la, lb), at in groups.items():
        if min(la, lb) < least:
            continue
        a, b = letters((first[i] for i in at), la), letters((reverse_complement(second[i]) for i in at), lb)
        best = np.full(len(at), np.inf)
        size, where, wrong = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        for offset in range(least - lb, la - least + 1):
            lo, hi = max(0, offset), min(la, offset + lb)
            n = hi - lo
            if n < least:
                continue
            unlike = (a[:, lo:hi] != b[:, lo - offset : hi - offset]).sum(1)
            ok = unlike <= min(most, int(share * n + 1e-9))
            better = ok & ((unlike / n < best) | ((unlike / n == best) & (n > size)))
            best[better], size[better], where[better], wrong[better] = unlike[better] / n, n, offset, unlike[better]
        for k, i in enumerate(at):
            if np.isfinite(best[k]):
                out[i] = (int(where[k]), int(wrong[k]))
    return out


def merged(seq1: str, qual1: str, seq2: str, qual2: str, offset: int) -> tuple[str, str]:
    """One read of two mates at an offset: in the overlap the letter of higher quality (of equals the first mate's), with it.
    An insert shorter than the reads is the overlap alone, as what is beyond is adapter."""
    b, q = reverse_complement(seq2), qual2[::-1]
    lo, hi = max(0, offset), min(len(seq1), offset + len(b))
    pairs = [(x, u) if u >= v else (y, v) for x, u, y, v in zip(seq1[lo:hi], qual1[lo:hi], b[lo - offset : hi - offset], q[lo - offset : hi - offset], strict=True)]
    seq, qual = "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)
    if offset < 0:
        return seq, qual
    return seq1[:lo] + seq + b[hi - offset :] + seq1[hi:], qual1[:lo] + qual + q[hi - offset :] + qual1[hi:]
