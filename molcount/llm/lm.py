"""Document scores of a log-bilinear language model, trained in numpy by noise contrast.

Tokens are lower-cased words and one end for each text. Counts are taken over all training texts.

Model. The short list grows with the counts: it has all tokens met ``OFTEN`` times or more (at least
the ``SHORT`` - 1 most frequent, at most those of the ``HEAD``), and one entry for all others. Its
entries stand in groups by frequency, as many groups as entries in each. The vectors of the last ``ORDER`` tokens, each weighted by place, add up
to a prediction; its products with the groups' vectors give the group's probability, those with the
vectors in the group the token's. Both are normalised by exact sums, in batched matrix products. The
result is mixed with the unigram probability by ``MIX``, and a token outside the short list has the
probability of that entry times its own share there, (c + 1) / (all such tokens + kinds + 1), which
leaves mass for one unknown kind. So the probabilities of all continuations sum to one.

Training. Biases start at the unigram; vectors start random. Each of ``ROUNDS`` rounds takes another
share of the texts by hash, so together they take every training text once. In a round every task
trains on its own texts by noise contrast: a true token is told from ``NOISE`` unigram draws, of its
group among the groups and of itself among its group's tokens. The draws are shared: ``DRAWS`` of
groups by a batch, of tokens by a block of ``PART`` tokens of one group, weighed to ``NOISE`` for each
token. Draws are fixed by the number of tokens that a task holds. The tasks' parameters are averaged by tokens seen.

Counts stay in a table; the most frequent, at most ``HEAD`` and all above one count, are broadcast (a bound of a few MB), the others
are joined to the rarer tokens of each text by hash. Null and empty texts have the end alone. A null
doc_id counts as empty text in the split. Rows that repeat are texts of their own; very long texts are
taken whole. With no training text all counts are 0 and the short list
holds the end and the others. Tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.llm import wordhash
from molcount.llm.common import Scratch, keyed
from molcount.llm.substrings import _merged

#: The smallest list, and the count from which a token is in the list at any size.
SHORT, OFTEN = 64 * 64, 1000
HEAD, ORDER, DIM = 131_072, 4, 16
ROUNDS, NOISE, RATE, MIX, BATCH = 4, 16.0, 0.25, 0.05, 4096
#: Noise draws of a batch's groups, and of a block of PART tokens of one group; both stand for NOISE draws of each token.
DRAWS, PART = (128, 16), 16
#: No word holds a line break.
END = b"\n"
CACHE = 250_000
#: Tokens that are put in groups together, and bytes of products that are taken together (these stay in a core's cache).
ROWS, TILE = 32_768, 1 << 19
#: Tokens that a task trains on together.
HELD = 500_000


def hash_of(token: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(token)).view(np.int64))


class Ids(dict):
    """Words to their rank in the head (by unsigned hash), -1 outside it; takes no more once it is large."""

    def __init__(self, ranks: dict[int, int]):
        self.ranks = ranks

    def __missing__(self, word: bytes) -> int:
        i = self.ranks.get(xxhash.xxh3_64_intdigest(word), -1)
        if len(self) < CACHE:
            self[word] = i
        return i

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))


_ids: dict[bytes, Ids] = {}


def _ids_of(hashes: np.ndarray) -> Ids:
    """The table of a head, which a worker keeps from round to round; it holds one at a time."""
    key = xxhash.xxh3_128_digest(hashes.tobytes())
    if key not in _ids:
        _ids.clear()
        _ids[key] = Ids({h: i for i, h in enumerate(hashes.view(np.uint64).tolist())})
    return _ids[key]


class Model:
    """Parameters as arrays; ``short`` maps ranks of the head to the list (the last entry: all others)."""

    def __init__(self, counts: np.ndarray, others: int, side: int = math.isqrt(SHORT), seed: int = 1):
        """counts: of the head, most frequent first; others: tokens outside the short list; side: groups and entries in each."""
        rng = np.random.default_rng(seed)
        self.side, self.size = side, side * side
        c = np.zeros(self.size)
        n = min(len(counts), self.size - 1)
        c[:n] = counts[:n]
        c[-1] = others
        # the entry of the others stands by its frequency like any token
        order = np.argsort(-c, kind="stable")
        self.place = np.empty(self.size, dtype=np.int32)
        self.place[order] = np.arange(self.size)
        self.uni = ((c + 1) / (c.sum() + self.size))[order]
        group = self.uni.reshape(side, side)
        self.pg = group.sum(1)
        self.pw = group / self.pg[:, None]
        # logs of the noise rates, and running sums to draw by: groups, and words at their group's number on
        self.log_noise = [np.log(NOISE * x).astype(np.float32) for x in (self.pg, self.pw)]
        self.sum_pg = np.append(np.cumsum(self.pg)[:-1], np.inf)
        self.sum_pw = (np.cumsum(self.pw, 1) / self.pw.sum(1, keepdims=True) + np.arange(side)[:, None]).ravel()
        self.p = {
            "context": (rng.normal(size=(self.size + 1, DIM)) * 0.1).astype(np.float32),
            "weight": np.ones((ORDER, DIM), dtype=np.float32) / ORDER,
            "group": (rng.normal(size=(side, DIM + 1)) * 0.1).astype(np.float32),
            "word": (rng.normal(size=(side, side, DIM + 1)) * 0.1).astype(np.float32),
        }
        # the last column is the bias
        self.p["group"][:, DIM], self.p["word"][:, :, DIM] = np.log(self.pg), np.log(self.pw)
        self.g2 = None

    def short(self, ids: np.ndarray) -> np.ndarray:
        """List entries of head ranks."""
        out = np.where((ids >= 0) & (ids < self.size - 1), ids, self.size - 1)
        return self.place[out]

    def contexts(self, s: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The ORDER entries before each token, nearest first; ``size`` before a text's first. starts: of each token's text."""
        at = np.arange(len(s))
        return np.stack([np.where(at - k >= starts, s[np.maximum(at - k, 0)], self.size) for k in range(1, ORDER + 1)], axis=1)

    def predict(self, ctx: np.ndarray) -> np.ndarray:
        """The sum of the weighted vectors, and 1 for the bias."""
        q = np.ones((len(ctx), DIM + 1), dtype=np.float32)
        # rows are taken by ``take``, which is several times as fast as indexing by an array
        q[:, :DIM] = sum(self.p["context"].take(ctx[:, k], axis=0) * self.p["weight"][k] for k in range(ORDER))
        return q

    def log_short(self, s: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log of each token's probability among the list's entries."""
        ctx = self.contexts(s, starts)
        out = np.concatenate([self._log_short(ctx[i : i + ROWS], s[i : i + ROWS]) for i in range(0, len(s), ROWS)])
        return np.log((1 - MIX) * np.exp(out.astype(np.float64)) + MIX * self.uni[s])

    def _log_short(self, ctx: np.ndarray, s: np.ndarray) -> np.ndarray:
        q = self.predict(ctx)
        g, out = s // self.side, np.empty(len(s), dtype=np.float32)
        tile = max(TILE // (4 * self.side), 16)
        for lo in range(0, len(s), tile):
            x, at = q[lo : lo + tile] @ self.p["group"].T, g[lo : lo + tile]
            out[lo : lo + tile] = x[np.arange(len(x)), at] - _logsum(x)
        order = np.argsort(g.astype(np.uint16), kind="stable")
        ends = np.searchsorted(g[order], np.arange(self.side + 1))
        for j in range(self.side):
            for lo in range(ends[j], ends[j + 1], tile):
                r = order[lo : min(lo + tile, ends[j + 1])]
                y = q.take(r, axis=0) @ self.p["word"][j].T
                out[r] += y[np.arange(len(r)), s.take(r) - j * self.side] - _logsum(y)
        return out

    def train(self, s: np.ndarray, starts: np.ndarray) -> None:
        ctx = self.contexts(s, starts)
        if self.g2 is None:
            self.g2 = {k: np.full(v.shape, 0.1, dtype=np.float32) for k, v in self.p.items()}
        rng = np.random.default_rng(len(s))
        turn = rng.permutation(len(s))
        for lo in range(0, len(s), BATCH):
            i = turn[lo : lo + BATCH]
            self._step(ctx.take(i, axis=0), s.take(i), rng)

    def _step(self, ctx: np.ndarray, s: np.ndarray, rng: np.random.Generator) -> None:
        p, n = self.p, len(s)
        before = [p["context"].take(ctx[:, k], axis=0) for k in range(ORDER)]
        q, g = np.ones((n, DIM + 1), dtype=np.float32), s // self.side
        np.einsum("kij,kj->ij", before, p["weight"], out=q[:, :DIM])
        # groups: the true one is pushed up, those drawn for the batch are pushed down, each by sigma(score - log(noise rate))
        drawn, times = np.unique(np.searchsorted(self.sum_pg, rng.random(DRAWS[0], dtype=np.float32)), return_counts=True)
        own, some = p["group"].take(g, axis=0), p["group"].take(drawn, axis=0)
        up = _sigma(self.log_noise[0].take(g) - np.einsum("ij,ij->i", q, own)) - 1
        down = _sigma(self.log_noise[0].take(drawn) - q @ some.T) * (times * (NOISE / DRAWS[0])).astype(np.float32)
        own *= up[:, None]
        dq = down @ some
        dq += own
        order = np.argsort(g.astype(np.uint16), kind="stable")
        counts = np.bincount(g, minlength=self.side)
        met = np.flatnonzero(counts)
        grad = np.zeros_like(p["group"])
        own = q.take(order, axis=0)
        grad[met] = np.add.reduceat(up.take(order)[:, None] * own, (np.cumsum(counts) - counts)[met])
        grad[drawn] += down.T @ q
        self._move("group", grad / n)
        # words: tokens by group in blocks of PART rows, which share their draws; a block's spare rows are 0 and have no gradient
        blocks = -(-counts // PART)
        of, first = np.repeat(np.arange(self.side), blocks), np.cumsum(blocks) - blocks
        slot = np.arange(n) + np.repeat(first * PART - (np.cumsum(counts) - counts), counts)
        word = p["word"].reshape(self.size, DIM + 1)
        drawn = np.searchsorted(self.sum_pw, of[:, None] + rng.random((len(of), DRAWS[1])), side="right")
        drawn = np.minimum(drawn, (of * self.side + self.side - 1)[:, None])  # where the sum rounds up to the next group
        sorted_q, true = np.zeros((len(of) * PART, DIM + 1), dtype=np.float32), s.take(order)
        sorted_q[slot] = own
        sorted_q, w, w_true, rate = sorted_q.reshape(-1, PART, DIM + 1), word.take(drawn, axis=0), word.take(true, axis=0), self.log_noise[1].ravel()
        up = (_sigma(rate.take(true) - np.einsum("ij,ij->i", own, w_true)) - 1)[:, None]
        down = sorted_q @ w.transpose(0, 2, 1)
        down = _sigma(np.subtract(rate.take(drawn)[:, None], down, out=down))
        down *= np.float32(NOISE / DRAWS[1])
        w_true *= up
        w_true += (down @ w).reshape(-1, DIM + 1).take(slot, axis=0)
        w_true += dq.take(order, axis=0)
        dq[order] = w_true
        own *= up
        moved = np.concatenate([own, (down.transpose(0, 2, 1) @ sorted_q).reshape(-1, DIM + 1)])
        rows, grad = _sums(np.concatenate([true, drawn.ravel()]), moved, self.size)
        self._move_rows("word", rows, grad / n)
        dq = dq[:, :DIM].copy()
        turn = np.stack([np.einsum("ij,ij->j", dq, b) for b in before]) / n
        rows, order, first = _sorted(ctx.T.ravel(), self.size + 1)
        wide = dq.take(order % n, axis=0)
        wide *= p["weight"].take(order // n, axis=0)
        self._move_rows("context", rows, _added(wide, first) / n)
        self._move("weight", turn)

    def _move(self, name: str, grad: np.ndarray) -> None:
        grad = grad * np.float32(BATCH / 32)
        self.g2[name] += grad * grad
        self.p[name] -= RATE * grad / np.sqrt(self.g2[name])

    def _move_rows(self, name: str, rows: np.ndarray, grad: np.ndarray) -> None:
        grad = grad * np.float32(BATCH / 32)
        p, g2 = (x[name].reshape(-1, grad.shape[1]) for x in (self.p, self.g2))
        part = grad * grad
        part += g2.take(rows, axis=0)
        g2[rows] = part
        np.sqrt(part, out=part)
        grad *= np.float32(RATE)
        grad /= part
        p[rows] = p.take(rows, axis=0) - grad

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        self.g2 = None


def _logsum(x: np.ndarray) -> np.ndarray:
    """Log of each row's sum of exponentials; x is overwritten."""
    if x.max() < 80 and x.min() > -80:  # no exponential leaves the range of 32-bit floats
        return np.log(np.exp(x, out=x) @ np.ones(x.shape[1], dtype=x.dtype))
    top = x.max(1, keepdims=True)
    return np.log(np.exp(x - top).sum(1)) + top[:, 0]


def _sigma(minus: np.ndarray) -> np.ndarray:
    """The logistic function of the negated values, in their place."""
    with np.errstate(over="ignore"):  # infinity gives the right limit, 0
        np.exp(minus, out=minus)
    minus += 1
    return np.reciprocal(minus, out=minus)


def _sorted(rows: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows, all under ``below``, the order that brings equal ones together, and the first of each."""
    order = np.argsort(rows.astype(np.uint16) if below <= 2**16 else rows, kind="stable")
    rows = rows.take(order)
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    return rows.take(first), order, first


def _added(values: np.ndarray, first: np.ndarray, few: int = 3) -> np.ndarray:
    """The sums of the runs of values that begin at first; most runs are short, and those of up to ``few`` are added together."""
    n = np.diff(first, append=len(values))
    out = values.take(first, axis=0)
    for k in range(1, few):
        some = np.flatnonzero((n > k) & (n <= few))
        out[some] = out.take(some, axis=0) + values.take(first.take(some) + k, axis=0)
    many = np.flatnonzero(n > few)
    if len(many):
        n = n.take(many)
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(first.take(many) - (ends - n), n)
        out[many] = np.add.reduceat(values.take(at, axis=0), ends - n)
    return out


def _sums(rows: np.ndarray, values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Different rows, all under ``below``, and the sums of their values."""
    rows, order, first = _sorted(rows, below)
    return rows, _added(values.take(order, axis=0), first)


def held_out(doc_id, mod: int, rest: int = 2):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(mod)) == rest


def _texts(batch):
    return batch.column("text").cast(pa.binary())


def counted(docs: DataFrame) -> DataFrame:
    """(h, c): tokens of texts by hash."""

    def run(batches):
        held, n = [], 0

        def flush():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

        end = np.array([hash_of(END)], dtype=np.int64).view(np.uint64)
        for batch in batches:
            for t in _texts(batch):
                held += [wordhash.hashes(t.as_py().lower().split()), end]
                n += len(held[-2]) + 1
                if n > 3_000_000:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class Shared:
    """What tasks need: the head's hashes and counts, sums, and the parameters."""

    def __init__(self, head: list, total: int, kinds: int):
        self.hashes = np.array([r["h"] for r in head], dtype=np.int64)
        self.counts = np.array([r["c"] for r in head], dtype=np.int64)
        self.total, self.kinds = total, kinds
        self.flat: np.ndarray | None = None
        self._ready: tuple | None = None
        often = min(max(int((self.counts >= OFTEN).sum()), SHORT - 1), max(HEAD, SHORT - 1))
        self.side = math.isqrt(often) + 1  # the least with a place for the others too
        self.size = self.side**2

    def __getstate__(self):
        return self.__dict__ | {"_ready": None}

    def ready(self) -> tuple[Model, Ids]:
        if self._ready is None:
            m = Model(self.counts, self.total - int(self.counts[: self.size - 1].sum()), self.side)
            if self.flat is not None:
                m.load(self.flat)
            self._ready = m, _ids_of(self.hashes)
        return self._ready

    @property
    def rest(self) -> int:
        """Tokens and kinds outside the short list, and one unknown kind."""
        n = min(len(self.counts), self.size - 1)
        return self.total - int(self.counts[:n].sum()) + max(self.kinds - n, 0) + 1


def _held(batches, m: Model, ids: Ids):
    """(entries, place of the first of each one's text) of some texts after the others."""
    end, held, n = ids[END], [], 0

    def flush():
        lens = [len(x) for x in held]
        return m.short(np.concatenate(held)), np.repeat(np.cumsum(lens) - lens, lens)

    for batch in batches:
        for t in _texts(batch):
            held.append(np.append(ids.of(t.as_py().lower().split()), end))
            n += len(held[-1])
            if n >= HELD:
                yield flush()
                held, n = [], 0
    if held:
        yield flush()


def _trained(spark: SparkSession, docs: DataFrame, shared: Shared, turn: int) -> np.ndarray:
    """Parameters after one round, averaged over the tasks by tokens."""
    sent = spark.sparkContext.broadcast(shared)

    def run(batches):
        m, ids = sent.value.ready()
        m.load(sent.value.flat)
        seen = 0
        for s, starts in _held(batches, m, ids):
            m.train(s, starts)
            seen += len(s)
        if seen:
            flat = m.flat().astype(np.float64) * seen
            for k, part in enumerate(np.array_split(flat, 16)):
                yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "n": pa.array([seen], pa.int64()), "x": [part.astype(np.float32).tobytes()]})

    def add(batches):
        sums: dict = {}
        for batch in batches:
            for k, n, x in zip(*[batch.column(c).to_pylist() for c in ("part", "n", "x")], strict=True):
                a, b = sums.get(k, (0, 0.0))
                sums[k] = a + n, b + np.frombuffer(x, np.float32).astype(np.float64)
        for k, (n, x) in sums.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "n": pa.array([n], pa.int64()), "x": [(x / n).astype(np.float32).tobytes()]})

    mine = docs.where(F.pmod(F.xxhash64("doc_id", "th", F.lit(41)), F.lit(ROUNDS)) == turn).select("text")
    rows = mine.mapInArrow(run, "part int, n long, x binary").repartition(16, "part").mapInArrow(add, "part int, n long, x binary").collect()  # 16 rows
    return np.concatenate([np.frombuffer(r["x"], np.float32) for r in sorted(rows, key=lambda r: r["part"])]) if rows else shared.flat


def most_frequent(counts: DataFrame, most: int = HEAD) -> list:
    """The tokens (h, c) above a count such that at most ``most`` are, by falling count.

    The count is found from a histogram of counts (exact up to 1,024, then 64 steps for each doubling),
    so no task sends more than the tokens that are taken.
    """
    step = F.when(F.col("c") <= 1024, F.col("c")).otherwise(F.floor(F.log2(F.col("c").cast("double")) * 64) + 385).cast("int")
    at = counts.withColumn("step", step)
    taken, cut = 0, 1
    for r in sorted(at.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["step"]):  # some thousand rows
        taken += r["n"]
        if taken > most:
            cut = r["step"] + 1
            break
    return sorted(at.where(F.col("step") >= cut).select("h", "c").collect(), key=lambda r: (-r["c"], r["h"]))


def fit(spark: SparkSession, docs: DataFrame, scratch: Scratch) -> tuple[Shared, DataFrame]:
    """The model and the table of counts from training texts (doc_id, th, text)."""
    counts = scratch.keep(counted(docs), "counts")
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    shared = Shared(most_frequent(counts), sums["n"] or 0, sums["v"])
    shared.flat = shared.ready()[0].flat()
    for turn in range(ROUNDS):
        shared.flat = _trained(spark, docs, shared, turn)
        shared._ready = None
    return shared, counts


SCORED = "doc_id long, held_out boolean, rid long, n_tokens long, head_known long, head_base double, short double, outside long, outside_head double, tail array<struct<h:long,n:int>>"


def score(spark: SparkSession, docs: DataFrame, mod: int = 7) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document."""
    scratch = Scratch(spark, "lm")
    d = keyed(docs).withColumn("held_out", held_out(F.col("doc_id"), mod))
    shared, counts = fit(spark, d.where("not held_out").select("doc_id", "th", "text"), scratch)
    sent = spark.sparkContext.broadcast(shared)

    def run(batches):
        from pyspark import TaskContext

        m, ids = sent.value.ready()
        nth = TaskContext.get().partitionId() << 40
        log_count = np.log10(sent.value.counts + 1.0)
        end = ids[END]

        def scored(part):
            """part: (doc_id, held_out, words) of some texts."""
            nonlocal nth
            lens = np.array([len(w) + 1 for _, _, w in part])
            x = np.concatenate([np.append(ids.of(w), end) for _, _, w in part])
            ends = np.cumsum(lens)
            begins = ends - lens
            s = m.short(x)
            lp = m.log_short(s, np.repeat(begins, lens)) / np.log(10)
            known = x >= 0
            base = np.where(known, log_count[np.maximum(x, 0)], 0.0) if len(log_count) else np.zeros(len(x))
            out = (x < 0) | (x >= m.size - 1)
            add = lambda v: np.add.reduceat(v, begins)
            tails, sizes = [], []
            far = np.flatnonzero(~known)
            cut = np.searchsorted(far, np.append(begins, ends[-1])).tolist()
            for k, (_, _, w) in enumerate(part):
                some = far[cut[k] : cut[k + 1]] - begins[k]
                h, c = np.unique(wordhash.hashes([w[j] if j < len(w) else END for j in some.tolist()]), return_counts=True)
                tails.append((h.view(np.int64), c))
                sizes.append(len(h))
            tail = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.StructArray.from_arrays([pa.array(np.concatenate([t[0] for t in tails])), pa.array(np.concatenate([t[1] for t in tails]).astype(np.int32))], ["h", "n"]))
            n = len(part)
            rid = np.arange(nth, nth + n)
            nth += n
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in part], pa.int64()), pa.array([p[1] for p in part]), pa.array(rid), pa.array(lens), pa.array(add(known.astype(np.int64))), pa.array(add(base)), pa.array(add(lp)), pa.array(add(out.astype(np.int64))), pa.array(add(np.where(out, base, 0.0))), tail], names=[c.split()[0] for c in SCORED.split(", ")])

        for batch in batches:
            part, n = [], 0
            for doc, held, t in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), _texts(batch), strict=True):
                part.append((doc, held, t.as_py().lower().split()))
                n += len(part[-1][2]) + 1
                if n > 100_000:
                    yield scored(part)
                    part, n = [], 0
            if part:
                yield scored(part)

    rows = scratch.keep(_merged(d.select("doc_id", "held_out", "text"), run, SCORED), "scored")
    tail = rows.select("rid", F.explode("tail").alias("t")).select("rid", "t.h", "t.n").join(counts, "h")
    tail = tail.groupBy("rid").agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"))
    x = rows.drop("tail").join(tail, "rid", "left").withColumns({"known": F.coalesce("known", F.lit(0)), "logs": F.coalesce("logs", F.lit(0.0))})
    all_of = float(np.log10(shared.total + shared.kinds + 1))
    rest = float(np.log10(shared.rest))
    return x.select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.col("known")).alias("n_known"), F.lit(shared.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.col("logs") - F.col("n_tokens") * all_of).alias("base_score"), (F.col("short") + F.col("outside_head") + F.col("logs") - F.col("outside") * rest).alias("score"),
    )
