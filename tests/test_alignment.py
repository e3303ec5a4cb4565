"""Alignments against plain dynamic programs over all cells."""

import random
from collections import Counter

import pytest

from molcount.operators import alignment, consensus, preprocess


def changed(rng, text, k):
    t = list(text)
    for _ in range(k):
        i = rng.randrange(len(t) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            t.insert(i, rng.choice("ACGT"))
        elif t:
            i = min(i, len(t) - 1)
            t[i : i + 1] = [] if kind == 1 else [rng.choice("ACGT")]
    return "".join(t)


def best_score(a, b):
    """The best score of affine gaps, over all cells."""
    none = -(10**9)
    h = [[none] * (len(b) + 1) for _ in range(len(a) + 1)]
    e, f = [r[:] for r in h], [r[:] for r in h]
    h[0][0] = 0
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i:
                e[i][j] = max(h[i - 1][j] - alignment.OPEN, e[i - 1][j]) - alignment.EXTEND
            if j:
                f[i][j] = max(h[i][j - 1] - alignment.OPEN, f[i][j - 1]) - alignment.EXTEND
            d = h[i - 1][j - 1] + (alignment.MATCH if a[i - 1] == b[j - 1] else alignment.MISMATCH) if i and j else none
            h[i][j] = max(h[i][j], d, e[i][j], f[i][j])
    return h[-1][-1]


def applied(a, diff):
    """(text, score) of the alignment that differences of a describe."""
    own, ins = {p: x for p, s, x in diff if s < 0}, {}
    for p, s, x in sorted(d for d in diff if d[1] >= 0):
        assert s == len(ins.setdefault(p, ""))
        ins[p] += x
    text, score, gap = "", 0, False
    for p in range(len(a) + 1):
        if p in ins:
            text, score, gap = text + ins[p], score - alignment.OPEN - alignment.EXTEND * len(ins[p]), False
        if p < len(a):
            x = own.get(p, a[p])
            if x == "-":
                score, gap = score - alignment.EXTEND - (0 if gap else alignment.OPEN), True
            else:
                text, score, gap = text + x, score + (alignment.MATCH if x == a[p] else alignment.MISMATCH), False
    return text, score


def test_alignments_are_best():
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("ACGT") for _ in range(rng.randrange(1, 40)))
        pairs.append((a, changed(rng, a, rng.randrange(0, 9))))
    pairs += [("ACGT", ""), ("", "AC"), ("A" * 30, "A" * 22), ("ACGT" * 5, "TTTT")]
    for (a, b), diff in zip(pairs, alignment.differences([p[0] for p in pairs], [p[1] for p in pairs], band=60), strict=True):
        text, score = applied(a, diff)
        assert text == b and score == best_score(a, b), (a, b, diff)
    # within the usual band the letters are still those of the text
    for (a, b), diff in zip(pairs, alignment.differences([p[0] for p in pairs], [p[1] for p in pairs]), strict=True):
        assert applied(a, diff)[0] == b


def majority(members, threshold):
    """members: (seq, pos). The center's columns and those between its places, by plain counting."""
    count = Counter(s for s, _ in members)
    center = min(count, key=lambda s: (-count[s], s))
    columns = {(p, -1): Counter() for p in range(len(center))}
    for s, n in count.items():
        own = dict.fromkeys(columns, None)
        for p, slot, x in alignment.differences([center], [s])[0]:
            columns.setdefault((p, slot), Counter())[x] += n
            own[(p, slot)] = x
        for p in range(len(center)):
            if own.get((p, -1)) is None:
                columns[(p, -1)][center[p]] += n
    out = ""
    for key in sorted(columns, key=lambda k: (k[0], k[1] < 0, k[1])):
        c = columns[key]
        if key[1] >= 0:
            c["-"] += len(members) - sum(c.values())
        x = min(c, key=lambda v: (-c[v], "ACGTN-".index(v)))
        if x != "-":
            if 100 * c[x] / len(members) < threshold:
                return None
            out += x
    return out or None


@pytest.mark.parametrize("threshold", [0.0, 60.0, 90.0])
def test_aligned_families(spark, threshold):
    rng = random.Random(4)
    rows, want = [], {}
    for k in range(60):
        true = "".join(rng.choice("ACGT") for _ in range(rng.randrange(20, 60)))
        members = [(changed(rng, true, rng.choice((0, 0, 1, 2))), rng.randrange(100, 103)) for _ in range(rng.randrange(2, 14))]
        members = [m for m in members if m[0]]
        rows += [("chr1", k, f"C{k}", 5, i, s, p) for i, (s, p) in enumerate(members)]
        if (w := majority(members, threshold)) is not None:
            want[k] = (w, min(p for _, p in members), len(members))
    rows += [("chr1", 99, "C", 5, 0, None, 1), ("chr1", 98, "C", 1, 0, "ACGT", 1), ("chr1", 97, "C", 2, 0, "AC", 1), ("chr1", 97, "C", 2, 1, "", 1)]
    want[97] = ("AC", 1, 1)
    df = spark.createDataFrame(rows, "contig string, region_start long, centroid string, cluster_count long, ordinal long, seq string, pos long")
    got = {r["region_start"]: (r["seq"], r["start"], r["reads"]) for r in consensus.aligned_consensus(df, threshold).collect()}
    assert got == want


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y and x != "N"), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def adapter_start(read, adapter, rate, overlap):
    best = (-(10**9), 0, len(read))
    for s in range(len(read) + 1):
        for e in range(s, len(read) + 1):
            for i in [len(adapter)] + (list(range(overlap, len(adapter))) if e == len(read) else []):
                if i < overlap:
                    continue
                k = edits(adapter[:i], read[s:e])
                if k <= int(rate * i + 1e-9):
                    best = max(best, (i - 2 * k, -s, s))
    return best[2]


def test_adapters_with_errors():
    rng = random.Random(7)
    for rate, overlap in ((0.1, 3), (0.25, 2), (0.0, 4)):
        for _ in range(25):
            adapter = "".join(rng.choice("ACGTN" if rng.random() < 0.2 else "ACGT") for _ in range(rng.randrange(4, 14)))
            reads = []
            for _ in range(6):
                body = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 14)))
                tail = changed(rng, adapter.replace("N", "A"), rng.choice((0, 0, 1)))
                reads.append((body + tail + "ACG" * rng.randrange(2))[: rng.randrange(1, 30)])
            reads.append("")
            assert alignment.adapter_starts(reads, adapter, rate, overlap).tolist() == [adapter_start(r, adapter, rate, overlap) for r in reads], (adapter, reads)


def test_planted_inserts_are_merged(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for k in range(80):
        insert = "".join(rng.choice("ACGT") for _ in range(rng.choice((40, 70, 100, 130, 165, 190, 260))))
        full = insert + "AGATCGGAAGAGCACACGTCTGAACTCCAGTCACATCACGATCTCGTATGCCGTCTTCTGCTTGAAAACCCCGGGGTTTTACGTACGTACGTTGCATGCA"
        other = alignment.reverse_complement(insert) + "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGTAGATCTCGGTGGTCGCCGTATCATTACCTTGGAACCTTGCAGTCAGTCCATGGACATGCCAGTTAGC"
        a, b = list(full[:100]), list(other[:100])
        qa, qb = ["I"] * len(a), ["I"] * len(b)
        for s, q in ((a, qa), (b, qb)):
            for i in rng.sample(range(min(len(insert), 100)), 2):
                s[i], q[i] = rng.choice("ACGT".replace(s[i], "")), "#"
        rows.append((k, "".join(a), "".join(qa), "".join(b), "".join(qb)))
        want[k] = insert if len(insert) <= 170 else None
    df = spark.createDataFrame(rows + [(900, "ACGT", "IIII", "ACGT", "IIII"), (901, None, None, "A" * 50, "I" * 50)], "k long, seq1 string, qual1 string, seq2 string, qual2 string")
    got = {r["k"]: r for r in preprocess.merge_pairs(df).collect()}
    assert got[900]["merged_seq"] is None and got[901]["merged_seq"] is None
    for k, insert in want.items():
        m = got[k]["merged_seq"]
        assert (m is None) == (insert is None), (k, insert, m)
        if insert:
            # at the ends that one mate alone has, its errors stay
            assert len(m) == len(insert) == len(got[k]["merged_qual"]) and all(x == y or q == "#" for x, y, q in zip(m, insert, got[k]["merged_qual"], strict=True))


def test_prepared_mates(spark):
    rng = random.Random(9)
    insert = "".join(rng.choice("ACGT") for _ in range(90))
    one = spark.createDataFrame([(0, "@a x", insert[:60], "I" * 60), (1, "@b x", "A" * 60, "I" * 60)], "ordinal long, name string, seq string, qual string")
    two = spark.createDataFrame([(0, "@a y", alignment.reverse_complement(insert)[:60], "I" * 60), (1, "@b y", "C" * 25 + "G" * 35, "I" * 60)], "ordinal long, name string, seq string, qual string")
    single, pairs = preprocess.prepared(one, two, 4, 2, dual=True, merge=True)
    s = single.first()
    code = insert[:4] + alignment.reverse_complement(insert)[:4]
    assert single.count() == 1 and (s["name"], s["barcode"], s["seq"]) == (f"@a:{code} x", code, insert[6:-6])
    assert [r["barcode"] for r in pairs.collect()] == ["AAAACCCC"]
    _, pairs = preprocess.prepared(one, two, 4, 2, adapter="C" * 12)
    assert [r["name1"] for r in pairs.collect()] == [f"@a:{insert[:4]} x"]
