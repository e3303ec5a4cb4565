"""Hard negatives and centroid clustering against plain loops over all rows."""

import hashlib
import math

import numpy as np
import pytest

from molcount.llm import ballmeans, negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rid long, ints string, cell int"


def table(spark, rows):
    """rows (id, vector, label), with extra columns of clashing names."""
    return spark.createDataFrame([(i, v, y, 7, "x", 3) for i, v, y in rows], SCHEMA).repartition(3)


def vectors(rng, n, dim, spread=0.3):
    centers = rng.normal(size=(6, dim)) * 0.4
    return (centers[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * spread).tolist()


AWKWARD = [(950, None, 1), (1000, [0.1] * 8, None), (1050, [float("nan")] + [0.1] * 7, 1), (1100, [None] + [0.1] * 7, 1), (1150, [float("-inf")] + [0.1] * 7, 1), (1200, [0.5, 0.5], 1), (1201, [0.4, 0.5], 1), (1202, [0.4, 0.45], 2), (1250, [], 1), (1251, [], 2), (1252, [], 1), (1300, [1e300] + [0.0] * 7, 2), (1301, [1e299] + [0.1] * 7, 2), (1350, [0.0] * 8, 2)]


def mined(rows):
    kept = {}
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = tuple(math.floor(max(-131072.0, min(131072.0, x)) * 256) for x in v)
        kept[(i, (y + 1) % 10 if i is not None and i % 7 == 0 else y, ints)] = None
    late = lambda i: (i is None, i or 0)
    out = []
    for i, y, a in kept:
        if i is None or i % 50:
            continue
        others = [(sum(p * q for p, q in zip(a, x, strict=True)), j, z) for j, z, x in kept if j != i and len(x) == len(a)]
        others.sort(key=lambda o: (-o[0], late(o[1])))
        for s, j, _ in [o for o in others if o[2] == y][:5]:
            window = [o for o in others if o[2] != y and 50 * s <= 100 * o[0] <= 95 * s][:3]
            out += [(i, j, r + 1, o[1], s, o[0]) for r, o in enumerate(window)]
    return sorted(out, key=lambda r: tuple(-1 if x is None else x for x in r))


@pytest.mark.parametrize(("cell", "cell_max", "bucket"), [(2048, 32768, 64), (40, 30, 4)])
def test_hard_negatives_are_those_of_all_rows(spark, monkeypatch, cell, cell_max, bucket):
    for name, value in (("CELL", cell), ("CELL_MAX", cell_max), ("BUCKET", bucket)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(3)
    v = vectors(rng, 600, 8)
    v[100:220] = [v[100]] * 120  # a third of the rows around are copies, with all labels and ids
    rows = [(k, x, int(rng.integers(0, 4))) for k, x in enumerate(v)]
    rows += AWKWARD + [rows[50], rows[60], (50, v[70], 2), (None, v[50], 1), (None, v[51], 2)]
    got = [tuple(r) for r in negatives.mine(spark, table(spark, rows)).collect()]
    assert sorted(got, key=lambda r: tuple(-1 if x is None else x for x in r)) == mined(rows)


def test_the_traversal_leaves_buckets_out(monkeypatch):
    """Few of a clustered cell's buckets are opened for a window of high scores."""
    monkeypatch.setattr(negatives, "BUCKET", 64)
    rng = np.random.default_rng(4)
    x = np.floor(np.array(vectors(rng, 4000, 3, 0.02)) * 256)
    labels = rng.integers(0, 4, 4000)
    cell = negatives.Cell(x, np.arange(4000), labels, int((x * x).sum(1).max()))
    norm, near, far = cell.bounds(x[:50])
    scores = x[:50] @ x.T
    opened = []
    for i in range(50):
        hi = int(scores[i].max())
        lo = int(0.98 * hi)
        got = cell.answer(x[i], norm[i], i, int(labels[i]), near[i], far[i], [(lo, hi)], False, 3)
        ok = [j for j in np.lexsort((np.arange(4000), -scores[i])).tolist() if labels[j] != labels[i] and lo <= scores[i, j] <= hi][:3]
        assert [g[2] for g in got] == ok
        opened.append(int((near[i] <= negatives.radius(norm[i], cell.most, float(scores[i, ok[-1]] if ok else lo)) + cell.margin).sum()))
    assert np.mean(opened) < len(cell.tree.leaves) / 2


def test_long_products_are_exact():
    x = np.array([[2.0**25 - k, 2.0**25, -(2.0**25) + 3 * k] * 8 for k in range(40)])
    cell = negatives.Cell(x, np.arange(40), np.arange(40) % 2, int((x * x).sum(1).max()))
    norm, near, far = cell.bounds(x[:1])
    exact = [(sum(int(a) * int(b) for a, b in zip(x[0], y, strict=True)), j) for j, y in enumerate(x) if j % 2]
    got = cell.answer(x[0], norm[0], 0, 0, near[0], far[0], [(-(1 << 62), 1 << 62)], False, 5)
    assert [g[1:] for g in got] == sorted(exact, key=lambda e: (-e[0], e[1]))[:5]


def test_no_rows(spark):
    assert negatives.mine(spark, table(spark, [])).count() == 0
    assert negatives.mine(spark, table(spark, AWKWARD[:5])).count() == 0
    assert ballmeans.cluster(spark, table(spark, [])).count() == 0
    assert ballmeans.cluster(spark, table(spark, AWKWARD)).count() == 0


def clustered(rows, k, rounds):
    kept = [(i, [math.floor(max(-524288.0, min(524288.0, x)) * 256) for x in v]) for i, v, _ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centers = [v for _, v in start]
    for turn in range(rounds + 1):
        d = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centers] for _, v in kept]
        near = [min(range(len(centers)), key=lambda c, e=e: (e[c], c)) for e in d]
        if turn < rounds:
            for c in range(len(centers)):
                own = [v for (_, v), n in zip(kept, near, strict=True) if n == c]
                centers[c] = [sum(col) // len(own) for col in zip(*own, strict=True)] if own else centers[c]
    total = [sum(e[n] for e, n in zip(d, near, strict=True) if n == c) for c in range(len(centers))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted((i if i is not None else -1, n, e[n], total[n], sum(total), shas[n]) for (i, _), e, n in zip(kept, d, near, strict=True))


@pytest.mark.parametrize("k", [7, 40, 1000])
def test_clusters_are_those_of_plain_rounds(spark, k):
    rng = np.random.default_rng(8)
    v = vectors(rng, 260, 64)
    v[30:90] = [v[30]] * 60  # copies, so that centroids fall together and ties arise
    rows = [(j, x, 1) for j, x in enumerate(v)] + [(5, v[5], 1), (5, v[6], 1), (None, v[9], 1), (400, None, 1), (401, [0.5] * 63, 1), (402, [None] * 64, 1), (403, [float("inf")] * 64, 1), (404, [1e200, -1e200] * 32, None), (405, [0.0] * 64, 1)]
    got = ballmeans.cluster(spark, table(spark, rows), k=k).collect()
    assert sorted((r[0] if r[0] is not None else -1, *tuple(r)[1:6]) for r in got) == clustered(rows, k, 5)


def test_balls_spare_distances():
    """On well parted clusters most members stay in the stable core."""
    rng = np.random.default_rng(9)
    centers = np.floor(rng.normal(size=(12, 64)) * 400).astype(np.int64)
    x = centers[rng.integers(0, 12, 3000)] + rng.integers(-40, 40, (3000, 64))
    near, d, taken = ballmeans.Balls(centers, None).assign(x, np.zeros(3000, dtype=np.int64))
    assert taken == 36_000
    radius = np.array([math.sqrt(d[near == c].max()) for c in range(12)]) + 1
    again, d2, fewer = ballmeans.Balls(centers, radius).assign(x, near)
    assert (again == near).all() and (d2 == d).all() and fewer < 2 * 3000
