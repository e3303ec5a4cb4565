"""A family's consensus read, built in plain Python position by position: what the tests hold the operators against."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from molcount.functions.expr import HIGH_COVERAGE, MAX_PHRED, POSTERIOR_ORDER

_OP = re.compile(r"(\d+)([MIDNSHP=X])")


class Column:
    """What the family's reads have at one position."""

    def __init__(self):
        self.bases: list[tuple[str, int]] = []
        self.inserted: Counter = Counter()
        self.deleted: Counter = Counter()

    @property
    def coverage(self) -> int:
        """Bases and deletions; insertions stand between positions."""
        return len(self.bases) + self.deleted.total()

    def top(self) -> tuple[str, float]:
        """The most common of bases and deletions, each length for itself, and its percentage of them."""
        c = Counter(b for b, _ in self.bases)
        c.update({f"D{n}": k for n, k in self.deleted.items()})
        if not c:
            return "N", 0.0
        # ties by A, C, G, T, the shortest deletion, N
        allele = min(c, key=lambda a: (-c[a], "ACGTDN".index(a[0]), a))
        return allele, 100.0 * c[allele] / c.total()

    def call(self) -> tuple[str, int]:
        """Posterior base and quality, or the most common allele where the column is deep."""
        if self.coverage >= HIGH_COVERAGE:
            return self.top()[0], MAX_PHRED
        log = dict.fromkeys(POSTERIOR_ORDER, 0.0)
        for b, q in self.bases:
            if b != "N" and q > 0:
                e = 10 ** (-q / 10)
                for x in log:
                    log[x] += math.log(1 - e) if x == b else math.log(e)
        best = max(POSTERIOR_ORDER, key=lambda x: (round(log[x], 9), -POSTERIOR_ORDER.index(x)))
        wrong = sum(math.exp(v - log[best]) for x, v in log.items() if x != best)
        wrong /= 1 + wrong
        return best, MAX_PHRED if wrong <= 0 else min(MAX_PHRED, round(-10 * math.log10(wrong)))


def columns(reads) -> dict[int, Column]:
    """reads: (pos, cigar, seq, quals). An insertion is held at the next reference base, a deletion at its first base."""
    out: dict[int, Column] = defaultdict(Column)
    for pos, cigar, seq, quals in reads:
        q, r, last = 0, pos, None
        for n, op in ((int(n), op) for n, op in _OP.findall(cigar)):
            if op in "M=X":
                for _ in range(n):
                    if last is not None:
                        dq, dr = q - last[0] - 1, r - last[1] - 1
                        if dq:
                            out[r].inserted[seq[last[0] + 1 : q]] += 1
                        elif dr:
                            out[last[1] + 1].deleted[dr] += 1
                    out[r].bases.append((seq[q], quals[q]))
                    last = (q, r)
                    q, r = q + 1, r + 1
            elif op in "IS":
                q += n
            elif op in "DN":
                r += n
    return out


def assemble(reads, threshold: float = 60.0, indel_threshold: float = 60.0):
    """(start, seq, qual, cigar, splits) of the family, or none where it is ambiguous.

    splits: places in seq where a stretch without enough reads begins.
    """
    reads = list(reads)
    col = columns(reads)
    seq, qual, ops, splits = [], [], [], []
    skip_to, last, clear, low = None, None, True, False

    def gap() -> None:
        nonlocal low
        if not low:
            splits.append(len(seq))
        low = True
        seq.append("N")
        qual.append("!")
        ops.append("M")

    for pos in sorted(col):
        c = col[pos]
        if skip_to is not None and pos < skip_to:
            continue
        if last is not None:
            for _ in range(last + 1, pos):
                gap()
        last = pos
        base, q = None, 0
        if c.coverage < 2:
            gap()
            continue
        if c.inserted:
            text, n = min(c.inserted.items(), key=lambda x: (-x[1], x[0]))
            if 100.0 * n / c.coverage >= indel_threshold:
                seq += text
                qual += "]" * len(text)
                ops += "I" * len(text)
            base, q = c.call()
            if base[0] == "D":
                continue
        elif c.deleted:
            allele, share = c.top()
            if allele[0] == "D":
                length = int(allele[1:])
                if share < indel_threshold:
                    clear = False
                    gap()
                    continue
                ops += "D" * length
                skip_to, last = pos + length, pos + length - 1
                continue
            if share < indel_threshold:
                clear = False
                gap()
                continue
            base, q = c.call()
        else:
            base, q = c.call()
            kinds = Counter(b for b, _ in c.bases)
            if threshold > 0 and len(kinds) > 1 and 100.0 * kinds[base] / len(reads) < threshold:
                clear, base = False, "X"
        low = False
        seq.append(base)
        qual.append(chr(q + 33))
        ops.append("M")
    if not clear or not seq:
        return None
    letters = "".join(ops)
    cigar = "".join(f"{len(m[0])}{m[1]}" for m in re.finditer(r"(.)\1*", letters))
    return min(col), "".join(seq), "".join(qual), cigar, splits
