"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from molcount.llm import ballmeans, fingerprints, jaccard, lm, mixing, negatives, packing, secrets, substrings, tokenfiles, toxicity, vectors, windows
from molcount.llm.common import documents


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(spark, documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "held_out", "score", "predicted")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "position0", "position1")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, documents(spark, sf_dir))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(spark, documents(spark, sf_dir))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(spark, documents(spark, sf_dir))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.write_and_read(spark, documents(spark, sf_dir))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(documents(spark, sf_dir))


def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.report(spark, documents(spark, sf_dir))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(spark, documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_ball_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ballmeans.cluster(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("compared")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_toxicity, op2_mixing, op3_packing, op4_jaccard_join, op5_suffix_array, op6_token_files, op7_fingerprints, op8_vector_dedup, op9_window_dedup, op10_lm_score, op11_hard_negatives, op12_ball_means, op13_secrets, pipeline)}

_FINITE = "embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)"


def _ball_sql() -> str:
    """Plain rounds over all centroids."""
    k, rounds = ballmeans.K, ballmeans.ROUNDS
    steps = [
        f"k AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {ballmeans.DIM} AND {_FINITE})",
        "x AS MATERIALIZED (SELECT vec_id, unnest(v) AS v, generate_subscripts(v, 1) AS i FROM k)",
        f"c0 AS MATERIALIZED (SELECT c, unnest(v) AS v, generate_subscripts(v, 1) AS i FROM (SELECT row_number() OVER (ORDER BY sha256(concat('2:', CAST(vec_id AS VARCHAR))), v) - 1 AS c, v FROM k WHERE vec_id IS NOT NULL) WHERE c < {k})",
    ]
    for t in range(rounds + 1):
        steps.append(f"a{t} AS MATERIALIZED (SELECT vec_id, min_by(c, d * {k} + c) AS c, min(d) AS d FROM (SELECT vec_id, c, CAST(sum((x.v - c{t}.v) * (x.v - c{t}.v)) AS BIGINT) AS d FROM x JOIN c{t} USING (i) GROUP BY vec_id, c) GROUP BY vec_id)")
        if t < rounds:
            steps.append(f"m{t} AS MATERIALIZED (SELECT a{t}.c, i, CAST(floor(sum(v) / count(*)) AS BIGINT) AS v FROM x JOIN a{t} USING (vec_id) GROUP BY a{t}.c, i)")
            steps.append(f"c{t + 1} AS MATERIALIZED (SELECT c, i, coalesce(m{t}.v, c{t}.v) AS v FROM c{t} LEFT JOIN m{t} USING (c, i))")
    digest = f"SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c"
    return "WITH " + ",\n".join(steps) + f"\nSELECT vec_id, CAST(c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a{rounds} JOIN ({digest}) USING (c)"


_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
ORACLES: dict[str, str] = {
    "op4_jaccard_join": f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id""",
    "op9_window_dedup": f"""WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
v AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM d, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS i)),
f AS (SELECT s, min(doc_id) AS low FROM v GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM v JOIN f USING (s), range(0, 13) t(k) WHERE low < doc_id),
kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.j) AS text, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d) x ANTI JOIN gone g ON g.doc_id = x.doc_id AND g.j = x.j GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op11_hard_negatives": f"""WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n FROM s WHERE same) WHERE n <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score FROM p JOIN s ON p.anchor_id = s.anchor_id WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op12_ball_means": _ball_sql(),
}
