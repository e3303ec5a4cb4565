"""Links and components against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from molcount.llm import common, jaccard
from molcount.llm.common import Scratch, components


def shingle_sets(rows, k=5):
    out = []
    for _, t, _ in rows:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def wanted(rows):
    sets = shingle_sets(rows)
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if b and 100 * a >= 80 * b:
                comp[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[root(i)] = min(ids.get(root(i), r[0]), r[0])
    return Counter((r[0], len(s), ids.get(root(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


@pytest.fixture(scope="module")
def near(rows):
    """Chains of near copies, whose ends are unlike, and sets at exactly 80 %."""
    rng = random.Random(2)
    out = list(rows)
    for base in range(6):
        w = [f"v{rng.randrange(5000)}" for _ in range(rng.randrange(20, 200))]
        for k in range(30):
            w = list(w)
            w[rng.randrange(len(w))] = f"n{k}"
            out.append((1000 + 100 * base + k, " ".join(w), None))
    w = [f"x{i}" for i in range(40)]
    out += [(3000, " ".join(w), None), (3001, " ".join(w[:33]), None), (3002, " ".join(w[:32]), None), (3003, "a b c", None), (3004, "A b  C", None), (3005, "a b", None)]
    out += [(4000 + k, " ".join(w[:20] + [f"y{k}{j}" for j in range(rng.randrange(60))]), None) for k in range(40)]
    return out


@pytest.mark.parametrize("tiny", [False, True])
def test_components_of_links(spark, near, tiny, monkeypatch):
    if tiny:  # every block in chunks, most shingles frequent
        monkeypatch.setattr(jaccard, "CHUNK_DOCS", 3)
        real = jaccard.frequency_classes
        monkeypatch.setattr(jaccard, "frequency_classes", lambda d, k: (np.arange(jaccard.CELLS) % 4).clip(0, 2).astype(np.uint8) if real else None)
    df = spark.createDataFrame([(d, t, s, 1, 2) for d, t, s in near], "doc_id long, text string, source string, key int, block int").repartition(4)
    assert Counter(tuple(r) for r in jaccard.report(spark, df).collect()) == wanted(near)


def test_kept_is_one_of_each_component(spark, docs):
    got = jaccard.join(spark, docs, Scratch(spark, "t")).collect()
    sizes = Counter(r["component_id"] for r in got if r["n_shingles"] and r["kept"])
    assert set(sizes.values()) == {1}
    assert all(r["kept"] for r in got if not r["n_shingles"])


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(7)
    classes = rng.integers(0, 3, jaccard.CELLS).astype(np.uint8)
    for n in [*range(1, 60), 200, 997]:
        for _ in range(4):
            s = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            lose = rng.integers(0, jaccard.spare(len(s)) + 1)
            x = np.delete(s, rng.permutation(len(s))[:lose])
            gain = next(g for g in range(len(s), -1, -1) if 100 * len(x) >= 80 * (len(s) + g))
            y = np.unique(np.concatenate([x, rng.integers(0, 1 << 63, rng.integers(0, gain + 1)).astype(np.uint64)]))
            if len(y):
                assert set(jaccard.keys(s, classes).tolist()) & set(jaccard.keys(y, classes).tolist()), n


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(50)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = components(spark, spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "x")
    assert {r["node"]: r["comp"] for r in got.collect()} == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def jobs_of(spark, group, run):
    """What run returns, and the number of Spark jobs that it takes."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


@pytest.mark.parametrize("few", [0, 30, 10**6])
def test_components_take_few_jobs(spark, few, monkeypatch):
    """Long chains, rising, mixed and joined at their ends, stars and hubs in both orders, with and without contraction."""
    monkeypatch.setattr(common, "FEW", few)
    rng = random.Random(8)
    chain = list(range(5000, 5400))
    rng.shuffle(chain)
    edges = [(i, i + 1) for i in range(400)] + list(zip(chain, chain[1:], strict=False)) + [(9000 + k, 8000) for k in range(200)] + [(9999, 10_000 + k) for k in range(200)]
    edges += [(-(1 << 62), 1 << 62), (7, 7), (20_000, 20_001), (20_001, 20_000), (5000, 1 << 60)]
    least = {x: 0 for x in range(401)} | {x: 5000 for x in [*chain, 1 << 60]} | {x: 8000 for x in [8000, *range(9000, 9200)]} | {x: 9999 for x in [9999, *range(10_000, 10_200)]}
    least |= {-(1 << 62): -(1 << 62), 1 << 62: -(1 << 62), 20_000: 20_000, 20_001: 20_000}
    df = spark.createDataFrame(edges, "a long, b long")
    got, jobs = jobs_of(spark, f"components{few}", lambda: components(spark, df, Scratch(spark, "t"), "x"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(least) and dict(rows) == least
    assert jobs <= (10 if few > 1000 else 120)
    assert components(spark, df.where("a = 7 and b = 7"), Scratch(spark, "t"), "x").count() == 0


def test_frequency_classes_are_made_on_the_executors(spark):
    """Classes of a few texts as the counts of their cells say, in few jobs."""
    texts = [f"p{i} q{i} r{i} s{i} t{i}" for i in range(50)] + ["a b c d e"] * 40 + ["f g h i j"] * 600
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got, jobs = jobs_of(spark, "classes", lambda: jaccard.frequency_classes(df))
    want = np.zeros(jaccard.CELLS, dtype=np.uint8)
    for t, c in (("a b c d e", 1), ("f g h i j", 2)):
        want[(jaccard.shingles(t.encode()) & jaccard.MASK).astype(np.int64)] = c
    assert got.dtype == np.uint8 and np.array_equal(got, want) and jobs < 12


def test_growing_tables_are_not_broadcast(spark, near):
    """Small as they are here, no table of keys, labels or classes goes through the driver's memory."""
    live = spark.createDataFrame([(3, 1), (3, 2), (4, 5)], "key long, ck long")
    df = spark.createDataFrame([(d, t) for d, t, _ in near[:40]], "doc_id long, text string")
    for got in (jaccard._shared(live, Scratch(spark, "t"), "x"), jaccard.join(spark, df, Scratch(spark, "t"))):
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_empty_table(spark, empty):
    assert jaccard.report(spark, empty).count() == 0


def test_rows_of_rare_keys_are_shuffled_once(spark):
    """Keys that several classes have, against plain Python; rows of rare keys cross one exchange and are not joined back."""
    rng = random.Random(9)
    rows = sorted({(rng.randrange(120), rng.randrange(40)) for _ in range(260)}) + [(1, c) for c in range(100, 160)]
    of = {}
    for key, c in rows:
        of.setdefault(key, set()).add(c)
    live = spark.createDataFrame(rows, "key long, ck long")
    got = jaccard._shared(live, Scratch(spark, "t"), "x")
    assert Counter(tuple(r) for r in got.collect()) == Counter((k, c, min(of[k])) for k, c in rows if len(of[k]) > 1)
    rare, often = got._jdf.queryExecution().optimizedPlan().toString().split("Join")  # one join, of the frequent ones
    assert rare.count("Window ") == 1 and "Window " not in often


def test_rare_and_frequent_keys_are_told_apart():
    s = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 300).astype(np.uint64))
    assert not (jaccard.keys(s, np.zeros(jaccard.CELLS, dtype=np.uint8)) & np.uint64(1)).any()
    assert (jaccard.keys(s, np.full(jaccard.CELLS, 2, dtype=np.uint8)) & np.uint64(1)).all()
