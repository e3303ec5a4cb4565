"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as a learned vector (words of at least ``SEEN`` training texts; all others share one)
beside the mean of learned vectors of its runs of 3 to 5 characters (hashed bytes of the lower-cased
word with its ends marked). One component of each is the log-odds by the training counts, shrunk where
there are few: the word's own, and the highest of its runs. Windows of
``WINDOW`` words, one every ``STEP`` words and one at the end of a text, run through a forward and a
backward gated recurrent layer; attention weights pool their states to one logit. A text's score is
that of its highest window, so every word of a text, however long, is scored in some window.

Training fits the windows by Adam. Texts have labels, windows have none: the window of a text that
counts is the highest one, mined anew every few epochs (first by the log-odds); in clean texts a
random window joins it. The fit uses at most about ``POSITIVES`` and ``NEGATIVES`` labelled texts, chosen by
hash of doc_id; only rows outside the held-out fold are used, and only text enters a score. In the
loss the texts of a class weigh together as much as its share of all these rows' labels, whatever the
sample took of it; the random windows weigh together as much as all texts. The fit is one task's, so
the driver holds the parameters (some MB) and no texts.

Null or empty texts have no windows; their score is the share of positives among all labels outside
the held-out fold. With no usable labels all scores are 0. Labels that are null are ignored; where a doc_id has
several labels the highest counts. Rows that repeat are scored each.

An empty table gives no rows; without labels the scores are 0 as said. Very long texts are scored in all their windows.
"""

from __future__ import annotations

import pickle
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.llm import wordhash
from molcount.llm.common import release
from molcount.llm.lm import held_out

WINDOW, STEP = 32, 16
POSITIVES, NEGATIVES, SEEN = 1_000, 1_600, 3
HIDDEN, DIM, GRAMS = 8, 8, 1 << 17
EPOCHS, MINE, BATCH, RATE = 9, 3, 128, 0.01
#: A small sample is gone through more often, up to so many steps.
LEAST_STEPS = 270
THRESHOLD = 0.3
#: Different words whose runs are held together.
WORDS = 16_384
#: Windows run together.
ROWS = 1024
#: Words scored together.
BLOCK = 200_000


def summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.diff(rows[order], prepend=-1))
    return rows[order][first], np.add.reduceat(values[order], first)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def windows(n: int) -> np.ndarray:
    """Starts of the windows of a text of n words (n > 0)."""
    if n <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    s = np.arange(0, n - WINDOW + 1, STEP)
    return s if s[-1] == n - WINDOW else np.append(s, n - WINDOW)


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each run of 3, 4 and 5 bytes of each marked word, place of each word's first)."""
    if not words:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    b = np.frombuffer(b"".join([b"\x02" + w + b"\x03" for w in words]) + b"\0" * 5, np.uint8).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(owner))  # bytes from here to the word's end
    code, out, who = np.zeros(len(owner), dtype=np.uint64), [], []
    for n in range(1, 6):
        code = (code << np.uint64(8)) | b[n - 1 : n - 1 + len(owner)]
        if n >= 3:
            whole = left >= n
            out.append((wordhash.mixed(code[whole] * np.uint64(8) + np.uint64(n)) & np.uint64(GRAMS - 1)).astype(np.int64))
            who.append(owner[whole])
    who = np.concatenate(who)
    order = np.argsort(who, kind="stable")
    return np.concatenate(out)[order], np.searchsorted(who[order], np.arange(len(words)))


class Network:
    """Parameters, forward pass and gradients."""

    def __init__(self, vocabulary: dict[bytes, int], word_odds: np.ndarray, gram_odds: np.ndarray, prior: float, seed: int = 1):
        rng = np.random.default_rng(seed)
        f = lambda *s, k=0.3: (rng.normal(size=s) * k).astype(np.float32)
        self.vocabulary, self.prior = vocabulary, prior  # 0: all other words
        words, runs = f(len(vocabulary) + 1, DIM), f(GRAMS, DIM)
        words[:, 0], runs[:, 0] = word_odds, gram_odds
        ways = {f"{n}{d}": v for d in (0, 1) for n, v in (("x", f(2 * DIM, 3 * HIDDEN)), ("u", f(HIDDEN, 3 * HIDDEN)), ("b", np.zeros(3 * HIDDEN, dtype=np.float32)))}
        self.p = {"words": words, "grams": runs, **ways, "a": f(2 * HIDDEN, HIDDEN), "v": f(HIDDEN), "o": f(2 * HIDDEN), "c": np.full(1, -1.0, dtype=np.float32)}

    def inputs(self, unique: list[bytes], ids: np.ndarray | None = None):
        """(vectors of the words, word ids, buckets of runs, first run of each)."""
        if ids is None:
            ids = np.fromiter(map(self.vocabulary.get, unique, repeat(0)), dtype=np.int64, count=len(unique))
        g, at = grams(unique)
        n = np.diff(np.append(at, len(g)))[:, None]
        rows = self.p["grams"][g]
        chars = np.add.reduceat(rows, at) / n
        chars[:, 0] = np.maximum.reduceat(rows[:, 0], at)
        return np.concatenate([self.p["words"][ids], chars], axis=1), ids, g, at

    def vectors(self, unique: list[bytes]) -> np.ndarray:
        """Vectors of any number of words; their runs are held for some words at a time."""
        parts = [self.inputs(unique[i : i + WORDS])[0] for i in range(0, len(unique), WORDS)]
        return np.concatenate(parts) if parts else np.empty((0, 2 * DIM), dtype=np.float32)

    def _run(self, d: int, xg: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States of one direction; xg: (steps, windows, 3 HIDDEN) gate inputs."""
        steps, n = xg.shape[:2]
        h, u, out = np.zeros((n, HIDDEN), dtype=np.float32), self.p[f"u{d}"], np.empty((steps, n, HIDDEN), dtype=np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            hu = h @ u
            zr = sigmoid(xg[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(xg[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, hu, z, r, c))
            h = c + z * (h - c)
            out[t] = h
        return out

    def logits(self, vectors: np.ndarray, index: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """index, mask: (windows, WINDOW) places in vectors, and which are words."""
        gates = [vectors @ self.p[f"x{d}"] + self.p[f"b{d}"] for d in (0, 1)]
        return np.concatenate([self._logits(gates, index[i : i + ROWS], mask[i : i + ROWS]) for i in range(0, len(index), ROWS)])

    def _logits(self, gates: list[np.ndarray], index: np.ndarray, mask: np.ndarray) -> np.ndarray:
        steps = index.T
        h = np.concatenate([self._run(d, gates[d][steps]) for d in (0, 1)], axis=2)
        e = np.tanh(h @ self.p["a"]) @ self.p["v"]
        e = np.where(mask.T, e, np.float32(-1e9))
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        return np.einsum("tn,tnh->nh", w, h) @ self.p["o"] + self.p["c"][0]

    def gradients(self, unique: list[bytes], index: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Loss and its gradients by parameter."""
        p = self.p
        vectors, ids, gr, at = self.inputs(unique)
        steps, n = index.T, len(index)
        keeps, hs = ([], []), []
        for d in (0, 1):
            hs.append(self._run(d, (vectors @ p[f"x{d}"] + p[f"b{d}"])[steps], keeps[d]))
        h = np.concatenate(hs, axis=2)
        ta = np.tanh(h @ p["a"])
        e = np.where(mask.T, ta @ p["v"], np.float32(-1e9))
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        pooled = np.einsum("tn,tnh->nh", w, h)
        s = pooled @ p["o"] + p["c"][0]
        q = sigmoid(s)
        loss = float((weight * (np.maximum(s, 0) - s * y + np.log1p(np.exp(-np.abs(s))))).sum() / n)
        ds = (weight * (q - y) / n).astype(np.float32)
        g = {"c": np.array([ds.sum()], dtype=np.float32), "o": ds @ pooled}
        dp = ds[:, None] * p["o"]
        dh = w[:, :, None] * dp
        dw = np.einsum("tnh,nh->tn", h, dp)
        de = w * (dw - (w * dw).sum(0))
        g["v"] = np.einsum("tn,tnk->k", de, ta)
        dta = de[:, :, None] * p["v"] * (1 - ta * ta)
        g["a"] = np.einsum("tnh,tnk->hk", h, dta)
        dh = dh + dta @ p["a"].T
        dv = np.zeros_like(vectors)
        for d in (0, 1):
            u, back = p[f"u{d}"], np.zeros((n, HIDDEN), dtype=np.float32)
            dxg = np.zeros((len(steps), n, 3 * HIDDEN), dtype=np.float32)
            du = np.zeros_like(u)
            for t, h0, hu, z, r, c in reversed(keeps[d]):
                now = dh[t, :, d * HIDDEN : (d + 1) * HIDDEN] + back
                dc = now * (1 - z) * (1 - c * c)
                dz = now * (h0 - c) * z * (1 - z)
                dr = dc * hu[:, 2 * HIDDEN :] * r * (1 - r)
                dxg[t] = np.concatenate([dz, dr, dc], axis=1)
                dhu = np.concatenate([dz, dr, dc * r], axis=1)
                du += h0.T @ dhu
                back = now * z + dhu @ u.T
            flat = np.zeros((len(vectors), 3 * HIDDEN), dtype=np.float32)
            where, total = summed(steps.ravel(), dxg.reshape(-1, 3 * HIDDEN))
            flat[where] = total
            g[f"u{d}"], g[f"x{d}"], g[f"b{d}"] = du, vectors.T @ flat, flat.sum(0)
            dv += flat @ p[f"x{d}"].T
        sizes = np.diff(np.append(at, len(gr)))
        # of tables of vectors only the rows met have gradients; the log-odds stay
        for name, where, change in (("words", ids, dv[:, :DIM]), ("grams", gr, np.repeat(dv[:, DIM:] / sizes[:, None], sizes, axis=0))):
            where, change = summed(where, change)
            change[:, 0] = 0
            g[name] = where, change
        return loss, g


def laid_out(texts: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(different words, index and mask of all windows, text of each window) of texts with words."""
    flat = [w for t in texts for w in t]
    _, first, inverse = np.unique(wordhash.hashes(flat), return_index=True, return_inverse=True)
    unique = [flat[i] for i in first.tolist()]
    sizes = np.array([len(t) for t in texts])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    starts = [windows(n) for n in sizes.tolist()]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    at = np.concatenate(starts)[:, None] + np.arange(WINDOW)[None, :]
    mask = at < sizes[owner][:, None]
    return unique, inverse.astype(np.int32)[np.where(mask, at, 0) + begin[owner][:, None]], mask, owner


def fit(texts: list[tuple[list[bytes], int]], labels: dict[int, int]) -> Network | None:
    """texts: (lower-cased words, label) of the sample; labels: number of all usable labels of each kind."""
    texts = [(w, y) for w, y in texts if w]
    pos, neg = sum(y for _, y in texts), sum(1 - y for _, y in texts)
    if not pos or not neg:
        return None
    seen: dict[bytes, list[int]] = {}
    for w, y in texts:
        for x in set(w):
            seen.setdefault(x, [0, 0])[y] += 1
    odds = lambda a, b: np.clip((np.log((b + 0.5) / (pos + 1)) - np.log((a + 0.5) / (neg + 1))) * (a + b) / (a + b + 8) / 2, -1, 3)
    known = sorted(x for x, c in seen.items() if sum(c) >= SEEN)
    counts = np.array([[0, 0], *[seen[x] for x in known]])
    del seen
    word_odds = odds(counts[:, 0], counts[:, 1])
    word_odds[0] = 0
    gram_counts = np.zeros((GRAMS, 2))
    for w, y in texts:
        gram_counts[np.unique(grams(list(set(w)))[0]), y] += 1
    net = Network({x: i + 1 for i, x in enumerate(known)}, word_odds, odds(gram_counts[:, 0], gram_counts[:, 1]), labels[1] / (labels[0] + labels[1]))
    of_class = np.array([(1 - net.prior) / neg, net.prior / pos]) * len(texts)
    unique, index, mask, owner = laid_out([w for w, _ in texts])
    y = np.array([v for _, v in texts], dtype=np.float32)
    weight = of_class[y.astype(int)].astype(np.float32)
    rng = np.random.default_rng(4)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    turn = 0
    odds_of = net.vectors(unique)
    height = np.maximum(odds_of[:, 0], odds_of[:, DIM])[index].max(1)
    del odds_of
    for epoch in range(max(EPOCHS, -(-LEAST_STEPS // -(-2 * len(texts) // BATCH)))):
        if epoch and epoch % MINE == 0:
            height = net.logits(net.vectors(unique), index, mask)
        order = np.lexsort((height, owner))
        top = order[np.append(np.flatnonzero(np.diff(owner[order])), len(order) - 1)]
        clean = np.flatnonzero(y[owner] == 0)
        some = rng.choice(clean, min(len(clean), len(texts)), replace=False)
        mix = rng.permutation(len(top) + len(some))
        rows = np.concatenate([top, some])[mix]
        weights = np.concatenate([weight[owner[top]], np.full(len(some), len(texts) / len(some), dtype=np.float32)])[mix]
        for i in range(0, len(rows), BATCH):
            r = rows[i : i + BATCH]
            some, inverse = np.unique(index[r], return_inverse=True)
            _, g = net.gradients([unique[j] for j in some.tolist()], inverse.reshape(index[r].shape), mask[r], y[owner[r]], weights[i : i + BATCH])
            turn += 1
            for k, v in g.items():
                at, v = v if isinstance(v, tuple) else (slice(None), v)
                m[k][at] += 0.1 * (v - m[k][at])
                s[k][at] += 0.01 * (v * v - s[k][at])
                net.p[k][at] -= RATE * (m[k][at] / (1 - 0.9**turn)) / (np.sqrt(s[k][at] / (1 - 0.99**turn)) + 1e-8)
    return net


def scores(net: Network | None, texts: list[list[bytes]]) -> np.ndarray:
    """The score of each text: its highest window's."""
    out = np.full(len(texts), net.prior if net else 0.0)
    full = [i for i, w in enumerate(texts) if w]
    if not net or not full:
        return out
    unique, index, mask, owner = laid_out([texts[i] for i in full])
    s = net.logits(net.vectors(unique), index, mask)
    out[full] = sigmoid(np.maximum.reduceat(s, np.searchsorted(owner, np.arange(len(full)))).astype(np.float64))
    return out


def labelled(docs: DataFrame, labels: DataFrame, mod: int = 4) -> tuple[DataFrame, dict[int, int]]:
    """The training sample (text, y), and the number of all usable labels of each kind."""
    y = labels.select("doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"), mod)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    n = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    u = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30))
    cut = lambda k, most: int(min(1.0, most / max(n.get(k, 0), 1)) * (1 << 30))
    some = y.where(u < F.when(F.col("y") == 1, cut(1, POSITIVES)).otherwise(cut(0, NEGATIVES)))
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(some), "doc_id").select("text", "y"), n


def trained(docs: DataFrame, labels: DataFrame, mod: int = 4) -> Network | None:
    """The network of the training sample (about POSITIVES + NEGATIVES texts), which one task fits; only its parameters reach the driver."""
    some, n = labelled(docs, labels, mod)

    def run(batches):
        rows = [(t.as_py(), y) for batch in batches for t, y in zip(batch.column("text").cast(pa.binary()), batch.column("y").to_pylist(), strict=True)]
        if not rows:
            return
        rows.sort()
        words: dict[bytes, bytes] = {}  # a word that is met again is held once
        net = fit([([words.setdefault(w, w) for w in t.lower().split()], y) for t, y in rows], n)
        del rows, words
        yield pa.RecordBatch.from_pydict({"net": pa.array([pickle.dumps(net)], pa.binary())})
        release()

    # a key of one value: all rows meet in one task however many there are
    rows = some.repartition(1, F.col("y") * 0).mapInArrow(run, "net binary").collect()
    return pickle.loads(rows[0]["net"]) if rows else None


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, mod: int = 4) -> DataFrame:
    """docs with held_out, score and predicted beside their columns (which these names replace)."""
    net = spark.sparkContext.broadcast(trained(docs, labels, mod))
    docs = docs.drop("held_out", "score", "predicted").withColumn("held_out", held_out(F.col("doc_id"), mod))

    def run(batches):
        for batch in batches:
            texts, n, lo = [], 0, 0
            column = batch.column("text").cast(pa.binary())
            for i, t in enumerate(column):
                texts.append((t.as_py() or b"").lower().split())
                n += len(texts[-1])
                if n >= BLOCK or i + 1 == len(column):
                    part = batch.slice(lo, i + 1 - lo)
                    s = scores(net.value, texts)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=[*part.schema.names, "score", "predicted"])
                    texts, n, lo = [], 0, i + 1

    from pyspark.sql.types import DoubleType, IntegerType, StructType

    schema = StructType(list(docs.schema.fields)).add("score", DoubleType()).add("predicted", IntegerType())
    return docs.mapInArrow(run, schema)
