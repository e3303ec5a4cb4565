"""Near-duplicate embeddings by a flat proximity graph over overlapping cluster shards.

1. Clusters. k-means on a sample of at most ``SAMPLE`` vectors gives centroids, one for about every
   ``SHARD`` vectors and ``CENTROIDS`` at most. Tables that need more get a second level: in each
   cluster, k-means on a sample of ``FIT`` vectors a centroid gives up to ``FINE`` centroids of its own, so
   the number of clusters grows with the table up to CENTROIDS * FINE. A vector is a member of its ``OVERLAP`` nearest
   clusters; the nearest is its home. A cluster of more than ``CELL`` members is dealt to cells by
   hash, so no cell outgrows a task.
2. Graph. Each cell builds the lists of its members by robust pruning (of the nearest candidates one
   is kept unless a kept one is nearer to it by a factor; ``FAR`` random ones are candidates too).
   Edges go both ways; a vector's lists of all its cells are united.
3. Search. Every vector is a query in the cells of its ``PROBES`` nearest clusters. The search starts
   at the cell's medoids (and at the vector's own place), goes greedily to the nearest not yet expanded vector, and as long as there
   are unexpanded vectors within the range it goes on, so large groups are found whole. Found vectors
   count only in the cells of their home, so a link counts once.
4. Audit. The links of a stated set of queries are also counted by brute force over all vectors in
   blocks: about ``AUDIT`` by hash of all vectors, and ``LINKED`` by hash of those that the search found linked. Where
   none of them has a link, ``MORE`` times AUDIT others are asked; where none of these has one, the search is
   made once more with twice the probes. While recall is below ``RECALL``, the search is
   repeated with twice the probes and steps, at last in all clusters by brute force.
5. Verification. Each found pair's cosine is taken in double precision; only pairs of at least the
   threshold count.

Vectors that are null, of zero length or norm, or hold null or non-finite components link with
nothing. Vectors of unlike dimensions do not link. Rows that share a vec_id are vectors of their own;
component_id is the smallest vec_id of the component (null where none has one). Equal vectors are one
vector with a number of copies before the graph is built.

Other columns are ignored, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molcount.llm.common import Scratch, components, partitions

SAMPLE, SHARD, CENTROIDS, CELL = 20_000, 1_000, 1_024, 4_000
OVERLAP, PROBES, DEGREE, FAR, ALPHA = 2, 3, 24, 16, 1.2
STEPS, AUDIT, RECALL = 24, 200, 0.98
#: Second level: centroids in a cluster, sampled vectors for each, and rows that one task assigns.
FINE, FIT, SPLIT = 1_024, 16, 100_000
LINKED, MORE = 100, 10
#: Up to so many clusters the sizes of the large ones are broadcast (12 bytes each).
BROADCAST_CLUSTERS = 100_000
THRESHOLD = 0.95
BLOCK = 256


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of one length as doubles."""
    return np.array(col.to_pylist(), dtype=np.float64) if len(col) else np.empty((0, 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Unit centroids of unit rows."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norms = np.linalg.norm(sums, axis=1)
        empty = norms < 1e-12
        c = np.where(empty[:, None], x[rng.choice(len(x), k)], sums / np.where(empty, 1, norms)[:, None])
    return c


def pruned(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, pool: int = 48) -> np.ndarray:
    """Robust-pruned neighbours of each row of x among the rows, -1 where there are fewer."""
    n = len(x)
    out = np.full((n, degree), -1, dtype=np.int64)
    near_n, far_n = min(pool, n - 1), min(FAR, n - 1)
    if near_n < 1:
        return out
    pool, rng = near_n + far_n, np.random.default_rng(n)
    for lo in range(0, n, BLOCK):
        rows = np.arange(lo, min(lo + BLOCK, n))
        s = x[rows] @ x.T
        s[np.arange(len(rows)), rows] = -np.inf
        cand = np.argpartition(-s, near_n - 1, axis=1)[:, :near_n]
        # some of all rows too: groups of near copies need edges that lead out
        cand = np.concatenate([cand, rng.integers(0, n, (len(rows), far_n))], axis=1)
        sims = np.take_along_axis(s, cand, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        # distances between unit vectors; a candidate goes once a kept one is alpha times nearer to it
        far = np.sqrt(np.maximum(2 - 2 * np.where(np.isfinite(sims), sims, 0), 0))
        alive = np.isfinite(sims)
        far = np.where(alive, far, 0)
        at = np.zeros(len(rows), dtype=np.int64)
        for j in range(pool):
            take = alive[:, j] & (at < degree)
            if not take.any():
                continue
            r = np.flatnonzero(take)
            out[rows[r], at[r]] = cand[r, j]
            at[r] += 1
            if j + 1 < pool:
                between = np.sqrt(np.maximum(2 - 2 * np.einsum("rd,rkd->rk", x[cand[r, j]], x[cand[r, j + 1 :]]), 0))
                alive[r[:, None], np.arange(j + 1, pool)[None, :]] &= alpha * between > far[r, j + 1 :]
    return out


def search(queries: np.ndarray, x: np.ndarray, graph: np.ndarray, medoids: np.ndarray, reach: float, steps: int = STEPS, own: np.ndarray | None = None) -> np.ndarray:
    """Similarities of the rows of x that the search has met (-2: not met), for each query.

    Each turn expands a query's nearest unexpanded row. A query ends when its nearest unexpanded row
    is out of reach and it has expanded ``steps`` rows, or when there is none.
    """
    q, n = len(queries), len(x)
    seen = np.full((q, n), -2.0)
    todo = np.full((q, n), -2.0)
    first = queries @ x[medoids].T
    seen[:, medoids] = first
    todo[:, medoids] = first
    if own is not None:  # a query that is a row of x starts there too
        r = np.flatnonzero(own >= 0)
        seen[r, own[r]] = todo[r, own[r]] = 1.0
    live, turns = np.arange(q), 0
    while len(live):
        nearest = todo[live].argmax(1)
        best = todo[live, nearest]
        go = (best > -2) & ((best >= reach) | (turns < steps))
        live, nearest = live[go], nearest[go]
        if not len(live):
            break
        todo[live, nearest] = -2
        near = graph[nearest]
        new = near >= 0
        new &= seen[live[:, None], np.where(new, near, 0)] <= -2
        r, c = np.nonzero(new)
        if len(r):
            row, col = live[r], near[r, c]
            sims = np.einsum("rd,rd->r", queries[row], x[col])
            seen[row, col] = sims
            todo[row, col] = sims
        turns += 1
    return seen


def _classes(spark: SparkSession, vectors: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows with a class key, one row of each different usable vector with its copies and first id)."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, e: s + e * e))
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    v = v.withColumn("ok", F.coalesce(usable, F.lit(False)))
    v = v.withColumn("ok", F.when(F.col("ok"), (norm > 0) & (norm < F.lit(float("inf")))).otherwise(False))
    # -0.0 equals 0.0
    v = v.withColumn("k0", F.when(F.col("ok"), F.xxhash64(F.transform("embedding", lambda e: e + F.lit(0.0)))))
    v = v.withColumn("k1", F.when(F.col("ok"), F.xxhash64(F.lit(9), F.transform("embedding", lambda e: e + F.lit(0.0)))))
    rows = scratch.keep(v.withColumn("rid", F.monotonically_increasing_id()), "rows")
    some = rows.where("ok").groupBy("k0", "k1").agg(F.count(F.lit(1)).alias("copies"), F.min("rid").alias("node"), F.min("vec_id").alias("least"))
    one = some.join(rows.select(F.col("rid").alias("node"), "embedding"), "node")
    return rows, scratch.keep(one, "classes")


def near(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row, and the audited recall (by link and by query, the lower; null where no vector asked about has a link)."""
    scratch = Scratch(spark, "vectors")
    rows, one = _classes(spark, vectors, scratch)
    linked, recalls = None, []
    for dim in sorted(r["d"] for r in one.select(F.size("embedding").alias("d")).distinct().collect()):
        x = one.where(F.size("embedding") == dim)
        got, recall_dim = _links(spark, x, scratch.root.rsplit("/", 1)[0], threshold)
        linked = got if linked is None else linked.unionByName(got)
        recalls.append(recall_dim)
    if linked is None:
        linked = spark.createDataFrame([], "node long, other long, links long")
    edges = linked.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    groups = components(spark, edges, scratch, "groups")
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    c = one.select("k0", "k1", "node", "copies", "least").join(groups, "node", "left").join(links, "node", "left")
    c = c.withColumn("comp", F.coalesce("comp", "node"))
    least = c.groupBy("comp").agg(F.min("least").alias("component_id"))
    c = c.join(least, "comp").select("k0", "k1", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "ok", "k0", "k1").join(c, ["k0", "k1"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), F.lit(min((r for r in recalls if r is not None), default=None)).cast("double").alias("recall"))


def _links(spark, one: DataFrame, top: str, threshold: float) -> tuple[DataFrame, float | None]:
    """(node, other, links): in each cell a query's number of linked vectors (copies counted) and edges that
    keep its groups connected; and the audited recall."""
    scratch = Scratch(spark, "graph")
    n = one.count()
    s = _unit(_some(one, n, SAMPLE, 17))
    if not len(s):
        s = _unit([r["embedding"] for r in one.select("embedding").limit(SAMPLE).collect()])
    k = max(1, min(CENTROIDS, math.ceil(n / SHARD), len(s)))
    centers = spark.sparkContext.broadcast(kmeans(s, k))  # at most CENTROIDS vectors
    fine, clusters = None, k
    if math.ceil(n / SHARD) > CENTROIDS:
        fine = _second(spark, one, centers, scratch)
        clusters = fine[0].count()

    asked = {r["node"]: r["embedding"] for r in _sampled(one, n, AUDIT, 23)}
    truth = _brute(spark, one, asked, threshold)
    probes, steps, turn = PROBES, STEPS, 0
    while True:
        dealt = _dealt(one, centers, k, probes) if fine is None else scratch.keep(_dealt_fine(one, centers, fine, k, probes), f"dealt-{turn}")
        found = scratch.keep(_searched(spark, dealt, clusters, probes, steps, threshold), f"found-{turn}")
        scratch.drop(f"dealt-{turn}")
        if not turn or not any(truth.values()):
            linked = found.where("links > 0").select("node").distinct().orderBy(F.xxhash64("node", F.lit(29)), "node").limit(LINKED)
            more = {r["node"]: r["embedding"] for r in one.join(linked, "node").select("node", "embedding").collect()}
            if not turn and not more and not any(truth.values()):
                more = {r["node"]: r["embedding"] for r in _sampled(one, n, MORE * AUDIT, 37)}
            more = {q: x for q, x in more.items() if q not in truth}
            truth |= _brute(spark, one, more, threshold)
        if any(truth.values()):
            got = {r["node"]: r["n"] for r in found.where(F.col("node").isin(list(truth))).groupBy("node").agg(F.sum("links").alias("n")).collect()}
            shares = [min(got.get(q, 0), t) / t for q, t in truth.items() if t]
            recall = min(sum(min(got.get(q, 0), t) for q, t in truth.items()) / sum(truth.values()), sum(shares) / len(shares))
            if recall >= RECALL or (probes >= clusters and steps >= 1 << 20):
                return found, recall
        elif turn or probes >= clusters:
            return found, None  # two searches found no link, and none of the vectors asked about has one
        scratch.drop(f"found-{turn}")
        probes, steps, turn = min(clusters, 2 * probes), 2 * steps if probes < clusters else 1 << 20, turn + 1


def _sampled(one: DataFrame, n: int, want: int, seed: int) -> list:
    """About want rows (node, embedding) by hash; twice as many at most."""
    limit = int(min(1.0, want / max(n, 1)) * (1 << 31))
    return one.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 31)) < limit).select("node", "embedding").limit(2 * want).collect()


def _some(one: DataFrame, n: int, want: int, seed: int) -> list:
    return [r["embedding"] for r in _sampled(one, n, want, seed)]


def _unit(rows) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x


def _second(spark, one: DataFrame, centers, scratch: Scratch) -> tuple[DataFrame, dict]:
    """(top, sub, embedding): the centroids inside each cluster of the first level, of which the cluster's own is one; and
    the number of vectors whose nearest cluster it is. Samples are by hash: FIT for each centroid, and at least 64 of a cluster."""

    def nearest(batches):
        c = centers.value
        for b in batches:
            x = _matrix(b.column("embedding"))
            if len(x):
                near = np.concatenate([(x[i : i + BLOCK * 8] @ c.T).argmax(1) for i in range(0, len(x), BLOCK * 8)])
                yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int64)), b.column("node")], names=["top", "node"])

    tops = scratch.keep(one.select("node", "embedding").mapInArrow(nearest, "top long, node long"), "tops")
    sizes = {r["top"]: r["n"] for r in tops.groupBy("top").agg(F.count(F.lit(1)).alias("n")).collect()}  # CENTROIDS rows at most
    wanted = {c: min(FINE - 1, -(-m // SHARD)) for c, m in sizes.items()}
    rates = [(c, min(1.0, max(64, FIT * wanted[c]) / m)) for c, m in sizes.items()]
    rate = spark.createDataFrame(rates, "top long, rate double")
    picked = tops.join(F.broadcast(rate), "top").where(F.pmod(F.xxhash64("node", F.lit(41)), F.lit(1 << 31)) < F.col("rate") * (1 << 31)).select("top", "node")

    def fit(key, frame):
        import pandas as pd

        c = int(key[0])
        x = _unit(frame["embedding"].tolist())
        x = x[np.argsort(frame["node"].to_numpy(), kind="stable")]
        sub = np.concatenate([centers.value[c][None, :], kmeans(x, min(wanted[c], len(x)))])
        return pd.DataFrame({"top": c, "sub": np.arange(len(sub)), "embedding": list(sub)})

    table = picked.join(one.select("node", "embedding"), "node").groupBy("top").applyInPandas(fit, "top long, sub long, embedding array<double>")
    return scratch.keep(table, "fine"), sizes


DEALT = "cluster long, node long, rank int, copies long, embedding array<double>"


def _dealt(one: DataFrame, centers, k: int, probes: int) -> DataFrame:
    """Each vector with its nearest clusters by rank."""

    def deal(batches):
        c = centers.value
        for b in batches:
            x = _matrix(b.column("embedding"))
            if not len(x):
                continue
            u = x / np.linalg.norm(x, axis=1, keepdims=True)
            want = min(max(probes, OVERLAP), k)
            sims = u @ c.T
            near = np.argsort(-sims, axis=1, kind="stable")[:, :want]
            rows = np.repeat(np.arange(len(x)), want)
            rank = np.tile(np.arange(want), len(x))
            yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int64)), b.column("node").take(pa.array(rows)), pa.array(rank.astype(np.int32)), b.column("copies").take(pa.array(rows)), b.column("embedding").take(pa.array(rows))], names=["cluster", "node", "rank", "copies", "embedding"])

    return one.select("node", "copies", "embedding").mapInArrow(deal, DEALT)


def _dealt_fine(one: DataFrame, centers, fine: tuple[DataFrame, dict], k: int, probes: int) -> DataFrame:
    """The same over both levels: the nearest centroids inside a vector's nearest clusters of the first level.

    The second level's centroids grow with the table, so they are not broadcast: vectors meet those of their cluster in
    tasks of about SPLIT vectors, to each of which the cluster's centroids are sent (FINE at most).
    """
    table, sizes = fine
    tops = min(k, max(probes, OVERLAP))
    # as a third of all vectors may have one nearest cluster, so may a third have it second
    salts = F.create_map(*[F.lit(v) for c in range(k) for v in (c, max(1, -(-sizes.get(c, 0) * tops // SPLIT)))])
    v = _dealt(one, centers, k, probes).where(F.col("rank") < tops)
    v = v.select(F.col("cluster").alias("top"), F.pmod(F.xxhash64("node", F.lit(43)), F.element_at(salts, F.col("cluster"))).cast("int").alias("salt"), F.lit(1).alias("kind"), F.col("node").alias("id"), "embedding")
    c = table.select("top", F.explode(F.sequence(F.lit(0), F.element_at(salts, F.col("top")) - 1)).alias("salt"), F.lit(0).alias("kind"), F.col("sub").alias("id"), "embedding")
    both = v.unionByName(c).repartition(partitions(one.sparkSession), "top", "salt").sortWithinPartitions("top", "salt", "kind", "id")
    want = max(probes, OVERLAP)

    def assign(batches):
        at, subs, held, matrix = None, [], [], None
        for b in batches:
            key = np.stack([b.column("top").to_numpy(), b.column("salt").to_numpy(), b.column("kind").to_numpy()], axis=1)
            cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if lo == hi:
                    continue
                part = b.slice(lo, hi - lo)
                if tuple(key[lo, :2]) != at:
                    at, subs, held, matrix = tuple(key[lo, :2]), [], [], None
                if key[lo, 2] == 0:
                    subs.append(part.column("id").to_numpy())
                    held.append(_matrix(part.column("embedding")))
                    continue
                if not subs:
                    continue  # no vector's nearest cluster: it has no centroids and no members
                if matrix is None:
                    sub, matrix = np.concatenate(subs), np.concatenate(held)
                for i in range(0, hi - lo, BLOCK * 8):
                    piece = part.slice(i, BLOCK * 8)
                    x = _matrix(piece.column("embedding"))
                    sims = x / np.linalg.norm(x, axis=1, keepdims=True) @ matrix.T
                    near = np.argsort(-sims, axis=1, kind="stable")[:, :want]
                    rows = np.repeat(np.arange(len(x)), near.shape[1])
                    cluster = int(at[0]) * FINE + sub[near.ravel()]
                    yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int64)), piece.column("id").take(pa.array(rows)), pa.array(np.take_along_axis(sims, near, 1).ravel())], names=["cluster", "node", "sim"])

    by_node = Window.partitionBy("node").orderBy(F.desc("sim"), "cluster")
    ranked = both.mapInArrow(assign, "cluster long, node long, sim double").withColumn("rank", F.row_number().over(by_node) - 1).where(F.col("rank") < want)
    return ranked.join(one.select("node", "copies", "embedding"), "node").select("cluster", "node", "rank", "copies", "embedding")


def _brute(spark, one: DataFrame, asked: dict, threshold: float) -> dict:
    """Linked vectors (copies counted) of a bounded set of queries, over all rows in blocks."""
    if not asked:
        return {}
    ids = list(asked)
    shared = spark.sparkContext.broadcast((ids, _unit([asked[i] for i in ids])))

    def run(batches):
        ids, q = shared.value
        total = np.zeros(len(ids), dtype=np.int64)
        for b in batches:
            for i in range(0, len(b), BLOCK * 8):
                part = b.slice(i, BLOCK * 8)
                x = _matrix(part.column("embedding"))
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                hit = (q @ x.T >= threshold) & (np.array(ids)[:, None] != part.column("node").to_numpy()[None, :])
                total += hit @ part.column("copies").to_numpy()
        yield pa.RecordBatch.from_pydict({"node": pa.array(ids, pa.int64()), "n": pa.array(total)})

    return {r["node"]: r["n"] for r in one.select("node", "embedding", "copies").mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).collect()}


def _searched(spark, dealt: DataFrame, clusters: int, probes: int, steps: int, threshold: float) -> DataFrame:
    parts = partitions(spark)
    # only clusters of more than a cell: broadcast where there are few clusters in all, else Spark chooses the join
    large = dealt.where(F.col("rank") < OVERLAP).groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL).select("cluster", F.ceil(F.col("n") / CELL).cast("int").alias("cells"))
    dealt = dealt.join(F.broadcast(large) if clusters <= BROADCAST_CLUSTERS else large, "cluster", "left")
    n_cells = F.coalesce(F.col("cells"), F.lit(1))
    own = F.pmod(F.xxhash64("node", F.lit(31)), n_cells).cast("int")
    # members go to one cell of a cluster, as queries they go to all of them
    dealt = dealt.withColumn("own", own).withColumn("cell", F.explode(F.sequence(F.lit(0), n_cells - 1)))
    member = (F.col("own") == F.col("cell")) & (F.col("rank") < OVERLAP)
    dealt = dealt.withColumns({"member": member, "home": member & (F.col("rank") == 0), "query": F.col("rank") < probes}).where("member or query").select("cluster", "cell", "node", "member", "home", "query", "copies", "embedding")
    order = ["cluster", "cell"]
    names = [*order, "node", "member", "home", "query", "copies", "embedding"]

    def cells_of(batches):
        """The rows of one cell after another; a cell holds at most about CELL members."""
        held, last = [], None
        for b in batches:
            c = np.stack([b.column("cluster").to_numpy(), b.column("cell").to_numpy()], axis=1)
            cut = [0, *(np.flatnonzero((c[1:] != c[:-1]).any(1)) + 1).tolist(), len(c)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if lo == hi:
                    continue
                key = tuple(c[lo])
                if held and key != last:
                    yield pa.Table.from_batches(held)
                    held = []
                last = key
                held.append(b.slice(lo, hi - lo))
        if held:
            yield pa.Table.from_batches(held)

    def lists(batches):
        for t in cells_of(batches):
            x = _matrix(t.column("embedding"))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            g = pruned(x)
            node = t.column("node").to_numpy()
            r, c = np.nonzero(g >= 0)
            a, b = node[r], node[g[r, c]]  # edges go both ways, so that no row is out of reach
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))], names=["node", "to"])

    members = dealt.where("member").select(*names).repartition(parts, *order).sortWithinPartitions(*order)
    adjacency = members.mapInArrow(lists, "node long, to long").groupBy("node").agg(F.collect_set("to").alias("to"))
    x = dealt.join(adjacency, "node", "left").select(*names, "to").repartition(parts, *order).sortWithinPartitions(*order, F.desc("member"))

    def run(batches):
        for t in cells_of(batches):
            t = t.combine_chunks()
            v = _matrix(t.column("embedding"))
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            node, copies = t.column("node").to_numpy(), t.column("copies").to_numpy()
            member, home, query = (t.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("member", "home", "query"))
            m = np.flatnonzero(member)
            if not len(m) or not query.any():
                continue
            xm = v[m]
            place = {int(y): i for i, y in enumerate(node[m].tolist())}
            to = t.column("to").to_pylist()
            near = [[place[y] for y in (to[i] or []) if y in place] for i in m.tolist()]
            width = max(1, max(map(len, near)))
            graph = np.full((len(m), width), -1, dtype=np.int64)
            for i, y in enumerate(near):
                graph[i, : len(y)] = y
            mean = xm.mean(0)
            medoids = np.unique(np.concatenate([[int((xm @ mean).argmax())], np.linspace(0, len(m) - 1, min(len(m), 8)).astype(int)]))
            at_home, weight, names_m = home[m], copies[m], node[m]
            out = []
            asked = np.flatnonzero(query)
            for lo in range(0, len(asked), BLOCK):
                q = asked[lo : lo + BLOCK]
                own = np.array([place.get(int(y), -1) for y in node[q].tolist()])
                seen = search(v[q], xm, graph, medoids, threshold - 1e-9, steps, own) if steps < 1 << 20 else v[q] @ xm.T
                r, c = np.nonzero((seen >= threshold - 1e-9) & at_home[None, :])
                keep = (node[q[r]] != names_m[c]) & (np.einsum("rd,rd->r", v[q[r]], xm[c]) >= threshold)
                r, c = r[keep], c[keep]
                if len(r):
                    total = np.bincount(r, weights=weight[c], minlength=len(q)).astype(np.int64)
                    out += _spanning(node[q], names_m, r, c, total)
            if out:
                a, b, n = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["node", "other", "links"])

    return x.mapInArrow(run, "node long, other long, links long")


def _spanning(queries: np.ndarray, members: np.ndarray, r: np.ndarray, c: np.ndarray, total: np.ndarray) -> list[tuple]:
    """A row with the number of links for each query that has some, and of its pairs only as many edges
    as keep the block's groups connected (rows without a number)."""
    up: dict[int, int] = {}

    def root(i):
        while up.setdefault(i, i) != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = [(int(queries[i]), None, int(total[i])) for i in np.flatnonzero(total).tolist()]
    for a, b in zip(queries[r].tolist(), members[c].tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            up[x] = y
            out.append((a, b, 0))
    return out
