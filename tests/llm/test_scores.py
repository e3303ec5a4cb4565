"""Mixing, fingerprints, the language model and the toxicity network against plain Python."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from molcount.llm import fingerprints, lm, mixing, toxicity
from molcount.llm.common import Scratch

WORD = re.compile("[^\x20\x09-\x0d]+")


# --- mixing ---------------------------------------------------------------------------------------
def test_targets_share_excess_until_none_is_above():
    t = mixing.targets({"a": 10, "b": 100, "c": 1000, None: 0}, {"a": 3, "b": 1, "c": 2, None: 3}, Fraction(3, 2) * 1110)
    assert t["a"] == 20 and t["b"] == 200 and t["c"] == Fraction(3, 2) * 1110 - 220 and t[None] == 0
    assert mixing.in_order(["b", None, "ä", "Z"]) == ["Z", "b", "ä", None]


def test_mix(spark, docs, rows):
    got = mixing.mix(spark, docs).collect()
    sizes = Counter((r[0], len(WORD.findall(r[1] or ""))) for r in rows)
    assert Counter((r["doc_id"], r["size"]) for r in got) == sizes
    by = defaultdict(int)
    for _, t, s in rows:
        by[s] += len(WORD.findall(t or ""))
    order = mixing.in_order(by)
    want = mixing.targets(dict(by), dict(zip(order, mixing.turns(order), strict=True)), Fraction(3, 2) * sum(by.values()))
    source = defaultdict(set)
    for d, t, s in rows:
        source[d, len(WORD.findall(t or ""))].add(s)
    taken = defaultdict(int)
    for r in got:
        (s,) = source[r["doc_id"], r["size"]] if len(source[r["doc_id"], r["size"]]) == 1 else (r["source"],)
        assert r["source_size"] == by[s] and abs(r["target"] - float(want[s])) < 1e-6 and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in by)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix(spark, docs.repartition(5)).collect()))


def test_positions_follow_the_schedule(spark, docs):
    x = mixing.schedule(mixing.mix(spark, docs)).collect()
    place = [r["position"] for r in x]
    assert place == sorted(place) and place[0] >= 0
    # sources with falling weights come earlier than those with rising ones
    mean = defaultdict(list)
    for r in x:
        mean[r["source"]].append(r["position"])
    assert np.mean(mean["s0"]) < np.mean(mean["s1"])


def test_taken_texts(spark, docs):
    t = mixing.taken(spark, docs.select("doc_id", "text", "source"))
    total = sum(len(WORD.findall(r["text"])) for r in t.collect())
    assert total == sum(r["taken"] for r in mixing.mix(spark, docs).collect())


def test_empty_mix(spark, empty):
    assert mixing.mix(spark, empty).count() == 0 and mixing.taken(spark, empty.select("doc_id", "text", "source")).count() == 0


# --- fingerprints -----------------------------------------------------------------------------------
def test_report(spark, docs, rows):
    got = fingerprints.fingerprint_report(docs).collect()
    assert len(got) == len(rows)
    ids = [r for r in rows if r[0] is not None and r[0] not in (80, 78)]
    order = sorted(ids, key=lambda r: r[0])
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for (d, t, _), (_, nxt, _) in zip(order, order[1:], strict=False):
        t, nxt = t or "", nxt or ""
        cut = len(t) // 2
        r = by[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256((t[: len(t) - cut] + nxt[:cut]).encode()).hexdigest()
    same = defaultdict(set)
    for r, (_, t, _) in [(by[d], x) for x in rows for d in [x[0]] if d in by and d != 80]:
        same[t or ""].add(r["fingerprint"])
    assert all(len(v) == 1 for v in same.values())
    for r in got:
        a, b = int(r["fingerprint"], 16), int(r["edited_fingerprint"], 16)
        assert abs(r["near_edited"] - (1 - (a ^ b).bit_count() / 128)) < 1e-12 and 0 <= r["near_next"] <= 1
    long = [r for r in got if r["n_chars"] > 300 and r["doc_id"] not in (77, 78)]
    assert np.mean([r["near_edited"] for r in long]) > np.mean([r["near_next"] for r in long]) + 0.05


def test_last_is_followed_by_first_and_empty(spark, empty):
    d = spark.createDataFrame([(1, "abcd"), (2, "wxyz")], "doc_id long, text string")
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.fingerprint_report(d).collect()}
    assert got == {1: hashlib.sha256(b"abwx").hexdigest(), 2: hashlib.sha256(b"wxab").hexdigest()}
    assert fingerprints.fingerprint_report(empty).count() == 0


def test_near_fingerprints_finds_all(spark):
    rng = np.random.default_rng(1)
    base = [int.from_bytes(rng.bytes(16), "big") for _ in range(40)]
    all_ = set(base)
    for b in base[:20]:
        for n in (1, 2, 3, 4):
            x = b
            for i in rng.choice(128, n, replace=False):
                x ^= 1 << int(i)
            all_.add(x)
    f = spark.createDataFrame([(f"{x:032x}",) for x in all_] * 2, "fingerprint string")
    asked = f.where("substr(fingerprint, 1, 1) < '8'")
    got = [(r["asked"], r["found"], r["distance"]) for r in fingerprints.near_fingerprints(asked, f, 3).collect()]
    want = {(f"{a:032x}", f"{b:032x}", (a ^ b).bit_count()) for a in all_ for b in all_ if a < 1 << 127 and (a ^ b).bit_count() <= 3}
    assert set(got) == want and len(got) == len(want)
    assert len(fingerprints.near_fingerprints(f, f, 3).collect()) == len({(a, b) for a in all_ for b in all_ if (a ^ b).bit_count() <= 3})
    with pytest.raises(ValueError):
        fingerprints.near_fingerprints(f, f, 3, 3)


def test_report_counts_near_documents(spark):
    """Against all pairs of fingerprints: copies, texts with a word changed, empty and null texts, ids that are null or repeat."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    base = [[word() for _ in range(400)] for _ in range(8)]
    rows = [(50 * i, " ".join(b)) for i, b in enumerate(base)]
    rows += [(1000 + i, " ".join([*base[i % 8][: 37 * (i % 5)], word(), *base[i % 8][37 * (i % 5) + 1 :]])) for i in range(80)]
    rows += [(2000 + i, " ".join(base[0])) for i in range(60)] + [(3000, ""), (3001, None), (3050, None), (None, ""), (None, " ".join(base[1])), (100, " ".join(base[2]))]
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, least int").repartition(5)
    got = fingerprints.fingerprint_report(d).collect()
    assert len(got) == len(rows)
    fps = [(r["doc_id"], int(r["fingerprint"], 16)) for r in got]
    some = 0
    for r in got:
        if r["doc_id"] is None or r["doc_id"] % 50:
            assert r["n_near"] is None and r["near_id"] is None
            continue
        near = [i for i, x in fps if (x ^ int(r["fingerprint"], 16)).bit_count() <= fingerprints.RADIUS]
        assert (r["n_near"], r["near_id"]) == (len(near) - 1, min(i for i in near if i is not None))
        some += len(near) > 1
    assert some > 8


def test_edited_texts_of_rows_without_ids(spark):
    """Null ids are ranges of their own, however many; the order is that of doc_id, then of the text's hash."""
    rows = [(i if i < 5 else None, f"text {i} " * 3) for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = fingerprints.edited(d, 16)
    assert got.where("not extra and doc_id is null").select("bucket").distinct().count() > 4
    th = {r["text"]: r["th"] for r in got.where("not extra").collect()}
    order = [t for _, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, th[r[1]]))]
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    mine = {r["text"]: r["edited"] for r in got.where("not extra").collect()}
    assert mine == {t: t[: len(t) - len(t) // 2] + after[t][: len(t) // 2] for t in order}


# --- language model ---------------------------------------------------------------------------------
def held(d, mod):
    return zlib.crc32(("" if d is None else str(d)).encode()) % mod == 2


def test_base_score_and_counts(spark, docs, rows):
    got = lm.score(spark, docs).collect()
    split = [(d, (t or "").encode().lower().split()) for d, t, _ in rows]
    c = Counter()
    for d, w in split:
        if not held(d, 7):
            c.update(w)
            c["end"] += 1
    n, v = sum(c.values()), len(c)
    want = Counter()
    for d, w in split:
        tokens = [*w, "end"]
        want[d, held(d, 7), len(tokens), sum(t in c for t in tokens), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens), 4)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_rare_tokens_join(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 50)
    small = {r["doc_id"]: r for r in lm.score(spark, docs.where("doc_id in (10, 50, 76, 61)")).collect()}
    monkeypatch.setattr(lm, "HEAD", 131_072)
    large = {r["doc_id"]: r for r in lm.score(spark, docs.where("doc_id in (10, 50, 76, 61)")).collect()}
    assert all(abs(small[d]["base_score"] - large[d]["base_score"]) < 1e-6 and small[d]["n_known"] == large[d]["n_known"] for d in large)


def test_probabilities_sum_to_one_and_training_helps():
    rng = np.random.default_rng(2)
    counts = np.sort(rng.integers(1, 1000, 6000))[::-1]
    m = lm.Model(counts, int(counts[lm.SHORT - 1 :].sum()))
    # a language in which each token is followed by one of few
    s = np.zeros(60_000, dtype=np.int32)
    for i in range(1, len(s)):
        s[i] = (s[i - 1] * 7 + rng.integers(1, 4)) % 300
    starts = np.zeros(len(s), dtype=np.int64)
    before = m.log_short(s[:5000], starts[:5000]).mean()
    m.train(s, starts)
    assert m.log_short(s[:5000], starts[:5000]).mean() > before + 0.5
    ctx = s[:3].tolist()
    total = sum(math.exp(m.log_short(np.array([*ctx, k], dtype=np.int32), np.zeros(4, dtype=np.int64))[-1]) for k in range(lm.SHORT))
    assert abs(total - 1) < 1e-4


def test_every_training_text_is_learned_from(spark):
    # each text has a word of its own; the vector of a word moves only where its text is trained on
    rows = [(i, i, f"own{i} own{i} own{i}") for i in range(60)]
    shared, _ = lm.fit(spark, spark.createDataFrame(rows, "doc_id long, th long, text string"), Scratch(spark, "lm"))
    m = shared.ready()[0]
    before = lm.Model(shared.counts, 0).p["context"]
    place = {int(h): i for i, h in enumerate(shared.hashes)}
    words = m.short(np.array([place[lm.hash_of(f"own{i}".encode())] for i in range(60)]))
    assert (m.p["context"][words] != before[words]).any(1).all()


def test_words_met_often_have_vectors_of_their_own():
    n = 20_000
    counts = np.where(np.arange(n) < 12_000, 1000, 10)
    shared = lm.Shared([{"h": i, "c": int(c)} for i, c in enumerate(counts)], int(counts.sum()), n)
    m = shared.ready()[0]
    assert len(set(m.short(np.arange(12_000)).tolist())) == 12_000 and m.short(np.array([n - 1, -1])).tolist() == [m.place[-1]] * 2
    listed = len(m.place) - 1
    assert shared.rest == counts[listed:].sum() + n - listed + 1
    # words past the first 4,095 tell contexts apart, and all continuations sum to one
    after = [m.log_short(np.array([w, 5], dtype=np.int32), np.zeros(2, dtype=np.int64))[-1] for w in m.short(np.array([9000, 11_000]))]
    assert after[0] != after[1]
    k = np.arange(m.size, dtype=np.int32)
    s = np.stack([np.full(m.size, 9000, dtype=np.int32), k], axis=1).ravel()
    assert abs(np.exp(m.log_short(s, np.repeat(np.arange(m.size) * 2, 2))[1::2]).sum() - 1) < 1e-4


def test_empty_model(spark, empty):
    assert lm.score(spark, empty).count() == 0


# --- toxicity -----------------------------------------------------------------------------------------
def test_windows_cover_all_words():
    for n in (1, 5, 31, 32, 33, 47, 48, 49, 500):
        at = toxicity.windows(n)
        assert set(range(n)) <= {i for s in at for i in range(s, s + toxicity.WINDOW)} and all(b - a <= toxicity.STEP for a, b in zip(at, at[1:], strict=False))
        assert n < toxicity.WINDOW or at[-1] + toxicity.WINDOW == n


def test_gradients():
    rng = np.random.default_rng(0)
    words = [b"aa", b"b", b"ccc", b"dddd"]
    net = toxicity.Network({w: i + 1 for i, w in enumerate(words[:3])}, rng.normal(size=4), np.zeros(toxicity.GRAMS), 0.1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    index = rng.integers(0, 4, (5, toxicity.WINDOW))
    mask = np.arange(toxicity.WINDOW)[None, :] < np.array([32, 7, 1, 20, 32])[:, None]
    y, w = np.array([1.0, 0, 1, 0, 1]), np.ones(5)
    loss, g = net.gradients(words, index, mask, y, w)
    for name in ("x0", "u1", "b0", "a", "v", "o", "c", "words", "grams"):
        p = net.p[name]
        if isinstance(g[name], tuple):
            rows, change = g[name]
            at, want = (int(rows[0]), 2), change[0, 2]
        else:
            at = tuple(0 for _ in p.shape)
            want = g[name][at]
        old = p[at]
        p[at] = old + 1e-4
        up = net.gradients(words, index, mask, y, w)[0]
        p[at] = old - 1e-4
        down = net.gradients(words, index, mask, y, w)[0]
        p[at] = old
        assert abs((up - down) / 2e-4 - want) < 2e-4 * max(1, abs(want)), name


def test_learns_words_and_prefixes(spark):
    rng = np.random.default_rng(6)
    out = []
    for i in range(700):
        w = [f"w{rng.integers(800)}" for _ in range(rng.integers(1, 200))]
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            w.insert(int(rng.integers(len(w) + 1)), "awful" if i % 8 else f"zlem{rng.integers(10_000)}")
        out.append((i, " ".join(w), int(bad)))
    docs = spark.createDataFrame([(i, t, 1.5) for i, t, _ in out] + [(None, "w1 w2", 0.0), (900, None, 0.0), (901, "", 0.0), (1, out[1][1], 0.0)], "doc_id long, text string, score double").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in out] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.scored(spark, docs, labels).collect()
    truth = {i: y for i, _, y in out}
    mine = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(got) == len(out) + 4 and np.mean([a == b for a, b in mine]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["held_out"] == held(r["doc_id"], 4) and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    none = toxicity.scored(spark, docs, labels.where("false"))
    assert {r["score"] for r in none.collect()} == {0.0} and toxicity.scored(spark, docs.where("false"), labels).count() == 0


def test_sample_caps_leave_scores_at_the_true_shares(spark):
    rng = np.random.default_rng(8)
    out = [(i, " ".join([*(f"w{k}" for k in rng.integers(300, size=6)), *(["awful"] if i % 9 == 0 else [])]), int(i % 9 == 0)) for i in range(15_000)]
    usable = [y for i, _, y in out if not held(i, 4)]
    assert sum(usable) > toxicity.POSITIVES and usable.count(0) > toxicity.NEGATIVES
    none = [(20_000, None), (20_001, ""), (20_002, " \t\n")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in out] + none, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in toxicity.scored(spark, docs, spark.createDataFrame([(i, y) for i, _, y in out], "doc_id long, toxic int")).collect()}
    assert all(abs(got[i]["score"] - np.mean(usable)) < 1e-9 and got[i]["predicted"] == 0 for i, _ in none)
    assert np.mean([got[i]["predicted"] == y for i, _, y in out if got[i]["held_out"]]) > 0.98


def test_network_is_fitted_beside_the_driver(spark, monkeypatch):
    """The driver's memory holds no training texts: one task fits, and its network is that of a fit in place."""
    texts = [(f"w{i % 7} w{i % 11} é {'awful' if i % 3 == 0 else 'fine'}", int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id long, toxic int")
    usable = sorted((t.encode(), y) for i, (t, y) in enumerate(texts) if not held(i, 4))
    want = toxicity.fit([(t.lower().split(), y) for t, y in usable], Counter(y for _, y in usable))

    driver, fit = os.getpid(), toxicity.fit

    def elsewhere(*given):
        assert os.getpid() != driver, "fitted in the driver"
        return fit(*given)

    monkeypatch.setattr(toxicity, "fit", elsewhere)
    got = {r["text"]: r["score"] for r in toxicity.scored(spark, docs, labels).collect()}
    expected = toxicity.scores(want, [t.encode().lower().split() for t in got])
    assert len(got) > 30 and np.allclose(list(got.values()), expected, atol=1e-4)


def test_sums_of_rows_are_those_of_a_plain_loop():
    rng = np.random.default_rng(2)
    for n in (1, 2, 50, 3000):
        rows, values = (rng.random(n) ** 3 * 400).astype(np.int64), rng.normal(size=(n, 5)).astype(np.float32)
        want = np.zeros((400, 5))
        np.add.at(want, rows, values)
        got, sums = lm._sums(rows, values, 400)
        assert got.tolist() == sorted(set(rows.tolist())) and np.allclose(sums, want[got], atol=1e-3)


def test_most_frequent_are_all_above_one_count(spark):
    rows = [(i, 1 + i % 7) for i in range(500)] + [(1000 + i, 5000 + 40 * i) for i in range(100)]
    counts = spark.createDataFrame(rows, "h long, c long")
    got = [(r["h"], r["c"]) for r in lm.most_frequent(counts, 600)]
    assert got == sorted(rows, key=lambda r: (-r[1], r[0]))
    got = [(r["h"], r["c"]) for r in lm.most_frequent(counts, 250)]
    least = min(c for _, c in got)
    assert len(got) <= 250 and got == sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[1], r[0])) and least == 6
    assert lm.most_frequent(counts.limit(0), 5) == []
