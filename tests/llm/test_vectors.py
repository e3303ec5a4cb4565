"""Vector links against all pairs."""

import math

import numpy as np
import pytest

from molcount.llm import vectors


def wanted(rows, threshold=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1], dtype=float) / np.linalg.norm(np.array(rows[i][1], dtype=float)) for i in ok}
    links, comp = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in ok:
        for j in ok:
            if i < j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                comp[root(i)] = root(j)
    least = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            least[root(i)] = min(least.get(root(i), v), v)
    return sorted((v if v is not None else -1, links[i], least.get(root(i)) or -1, v is not None and v == least[root(i)]) for i, (v, _) in enumerate(rows))


@pytest.mark.parametrize(("cell", "centroids", "shard", "split"), [(4000, 1024, 100, 100_000), (40, 1024, 100, 100_000), (40, 3, 40, 60)])
def test_links_and_components(spark, cell, centroids, shard, split, monkeypatch):
    """The last case has two levels of centroids, cells and salted clusters."""
    for name, value in (("SHARD", shard), ("CELL", cell), ("CENTROIDS", centroids), ("SPLIT", split)):
        monkeypatch.setattr(vectors, name, value)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 16))
    x[50:90] = x[50] + rng.normal(size=(40, 16)) * 0.05
    x[100:103] = x[100]
    for k in range(200, 240):
        x[k] = x[k - 1] + rng.normal(size=16) * 0.12
    rows = [(k + 1, v.tolist()) for k, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [float("inf")] + [1.0] * 15), (905, [None] + [1.0] * 15), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, x[0].tolist()), (5, x[7].tolist()), (5, x[7].tolist())]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, node string").repartition(3)
    got = vectors.near(spark, df).collect()
    assert min(r["recall"] for r in got) >= 0.98
    key = lambda r: (r["vec_id"] if r["vec_id"] is not None else -1, r["n_links"], r["component_id"] or -1, r["kept"])
    assert sorted(map(key, got)) == wanted(rows)


def test_empty_table(spark):
    assert vectors.near(spark, spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pruned_lists_reach_all():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = vectors.pruned(x)
    seen = vectors.search(x[:50], x, g, np.array([0, 300]), 0.9)
    true = x[:50] @ x.T
    assert ((seen >= 0.9) == (true >= 0.9)).mean() > 0.9999


def test_audit_of_few_links(spark, monkeypatch):
    """The audit measures where hardly any vector has a link, and says null only where it found none at all."""
    monkeypatch.setattr(vectors, "AUDIT", 5)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 32))
    alone = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = vectors.near(spark, alone).collect()
    assert {(r["n_links"], r["recall"]) for r in got} == {(0, None)}
    x[7] = x[800] + rng.normal(size=32) * 0.01
    pair = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = vectors.near(spark, pair).collect()
    assert {r["vec_id"]: r["component_id"] for r in got if r["n_links"]} == {7: 7, 800: 7}
    assert {r["recall"] for r in got} == {1.0}
