"""Byte and word repeats against plain counting of all strings."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from molcount.llm import substrings, windows


def bytes_wanted(rows, n=400):
    seen = Counter()
    for _, t, _ in rows:
        b = (t or "").encode()
        seen.update(b[i : i + n] for i in range(len(b) - n + 1))
    out = []
    for d, t, _ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((d, len(b), int(gone.sum()), len(substrings.spans_of(gone)), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def words_wanted(rows, n=13):
    first = {}
    order = lambda d: float("inf") if d is None else d
    split = [(order(d), (t or "").encode().split()) for d, t, _ in rows]
    for o, w in split:
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(first.get(k, o), o)
    out = []
    for (d, _, _), (o, w) in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < o:
                gone[i : i + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.fixture(scope="module")
def more(rows):
    """Periodic texts, one letter alone, passages in many documents with unlike surroundings."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    p, q = text(900), text(430)
    out = list(rows) + [(200, "a" * 1500, None), (201, "a" * 399, None), (202, "a" * 400, None), (203, "abc" * 250 + text(300), None), (204, text(500) + q + text(100) + q, None)]
    out += [(210 + k, text(rng.randrange(300)) + p[rng.randrange(200) :] + text(rng.randrange(300)), None) for k in range(25)]
    return out


@pytest.mark.parametrize("wide", [400, 3])
def test_repeated_bytes(spark, more, wide):
    df = spark.createDataFrame([(d, t, s, 1) for d, t, s in more], "doc_id long, text string, source string, h int").repartition(4)
    got = substrings.report(spark, df, wide=wide).collect()
    assert Counter(tuple(r) for r in got) == bytes_wanted(more)


@pytest.mark.parametrize("wide", [400, 3])
def test_repeated_passages(spark, more, wide):
    df = spark.createDataFrame([(d, t, s, 1) for d, t, s in more], "doc_id long, text string, source string, h int").repartition(4)
    got = substrings.report(spark, df, substrings.PASSAGE, substrings.PASSAGE_GRAM, wide).collect()
    assert Counter(tuple(r) for r in got) == bytes_wanted(more, substrings.PASSAGE)


def test_passage_of_51_words_goes_by_the_shorter_length(spark):
    """The contract's length leaves a passage of 51 words alone; that of the pipeline cuts it."""
    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(3, 8))) for _ in range(n))
    p = words(51)
    assert substrings.PASSAGE < len(p) < 400
    rows = [(i, f"{words(60)} {p} {words(60)}") for i in range(3)] + [(i, words(200)) for i in range(3, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    far = {r["doc_id"]: r["n_removed"] for r in substrings.report(spark, docs).collect()}
    near = {r["doc_id"]: r["n_removed"] for r in substrings.report(spark, docs, substrings.PASSAGE, substrings.PASSAGE_GRAM).collect()}
    assert set(far.values()) == {0}
    assert all(near[i] >= len(p) for i in range(3)) and all(near[i] == 0 for i in range(3, 6))


def test_cover_ranks_find_equal_strings_at_unlike_places():
    rng = np.random.default_rng(3)
    t = rng.integers(97, 99, 6000).astype(np.uint8)
    for a, b in ((0, 2001), (700, 5003), (3100, 4501)):
        t[b : b + 420] = t[a : a + 420]
    starts = np.arange(len(t) - 399)
    seen = defaultdict(int)
    for i in starts:
        seen[t[i : i + 400].tobytes()] += 1
    assert (substrings.repeated(t, starts, 400) == [seen[t[i : i + 400].tobytes()] > 1 for i in starts]).all()
    zeros = np.zeros(1000, dtype=np.uint8)
    assert substrings.repeated(zeros, np.arange(601), 400).all()


def test_held_windows(spark, more):
    df = spark.createDataFrame([(d, t, s, 1) for d, t, s in more], "doc_id long, text string, source string, at int").repartition(4)
    assert Counter(tuple(r) for r in windows.report(spark, df).collect()) == words_wanted(more)


def test_levels_double():
    assert windows.levels(13) == [7, 13]
    for n in (8, 13, 50):
        k = windows.levels(n)
        assert k[-1] == n and all(b <= 2 * a for a, b in zip(k, k[1:], strict=False))


def test_empty_tables(spark, empty):
    assert substrings.report(spark, empty).count() == 0 and windows.report(spark, empty).count() == 0
