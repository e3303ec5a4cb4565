"""The pipeline's stages on a small corpus, each against what its operator decides."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipe
from molcount.llm import queries
from molcount.llm import jaccard, packing, toxicity
from molcount.llm.common import Scratch, once


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """(docs, sf_dir) with labels: clean and toxic texts, copies, near copies, a shared passage, awkward rows."""
    rng = random.Random(9)
    words = lambda n, v=900: [f"w{rng.randrange(v)}" for _ in range(n)]
    passage = " ".join(words(140, 50_000))
    out = []
    for i in range(360):
        w = words(rng.randrange(20, 160))
        if i % 4 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), "awful")
        out.append([i, " ".join(w), "en", f"s{i % 4}", 0])
    out.append([400, out[1][1], "en", "s1", 0])
    w = out[2][1].split(" ")
    w[len(w) // 2] = "changed"
    out.append([401, " ".join(w), "en", "s2", 0])
    for k in range(3):
        out.append([410 + k, " ".join(words(40)) + " " + passage + " " + " ".join(words(30)), "de", None, 0])
    few = " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(3, 8))) for _ in range(51))
    for k in range(2):
        out.append([415 + k, " ".join(words(40)) + " " + few + " " + " ".join(words(30)), "de", "s1", 0])
    out += [[420, None, None, "s0", None], [421, "", "en", "s0", 0], [None, "only words here", "en", "s3", 9], [430, "twice the same row of words", "en", "s1", 1], [430, "twice the same row of words", "en", "s1", 1]]
    d = str(tmp_path_factory.mktemp("sf"))
    rows = [tuple(r) for r in out]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(360)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return spark.read.parquet(f"{d}/documents.parquet"), d


def test_stages_in_turn(spark, corpus):
    docs, d = corpus
    scratch = Scratch(spark, "t")
    clean = scratch.keep(pipe.toxic(spark, docs, d), "a")
    marks = toxicity.scored(spark, docs, spark.read.parquet(f"{d}/labels.parquet"))
    assert clean.count() == marks.where("predicted = 0").count() and clean.columns == pipe.COLUMNS
    assert clean.where("text like '%awful%'").count() <= 9 and clean.where("text is null or text = ''").count() == 2

    one = scratch.keep(pipe.near_duplicates(spark, clean, d), "b")
    kept = jaccard.join(spark, clean, Scratch(spark, "t")).where("kept")
    assert one.count() == kept.count() and one.columns == pipe.COLUMNS
    ids = Counter(r["doc_id"] for r in one.select("doc_id").collect())
    assert 400 not in ids and 401 not in ids and ids[430] == 1 and ids[420] == 1 and ids[421] == 1 and ids[None] == 1

    cut = scratch.keep(pipe.repeated_substrings(spark, one, d), "c")
    texts = {r["doc_id"]: r for r in cut.collect()}
    before = {r["doc_id"]: r["text"] for r in one.collect()}
    assert len(texts) == one.count() and all(r["n_chars"] == len(r["text"]) for r in texts.values())
    assert all(len(texts[i]["text"]) < len(before[i]) - 400 for i in (410, 411, 412)) and texts[1]["text"] == before[1]
    # a passage of 51 words, shorter than 400 bytes
    middle = before[415].split(" ")[41:90]
    assert len(" ".join(middle)) < 400 and all(" ".join(middle) in before[i] and middle[10] not in texts[i]["text"] for i in (415, 416))

    mix = scratch.keep(pipe.mixed(spark, cut, d), "e")
    n = lambda df: df.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert abs(n(mix) - 1.5 * n(cut)) <= 5 and mix.columns == pipe.COLUMNS
    assert max(r["n"] for r in mix.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()) <= 2

    got = pipe.packed(spark, mix, d)
    assert sorted(got.columns) == sorted(c.split()[0] for c in packing.PIECES.split(", "))
    assert got.select("doc_id").distinct().count() == mix.select("doc_id").distinct().count()


def test_run_and_registration(spark, corpus):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is queries.pipeline and [n for n, _ in pipe.STAGES] == ["toxicity", "near_duplicates", "repeated_substrings", "mixing", "packing"]
    assert {f"op{i}" for i in range(1, 11)} == {k.split("_")[0] for k in __spark_entry__.queries() if k.startswith("op")}
    got = pipe.run(spark, corpus[1]).agg(F.sum("length").alias("n"), F.max("length").alias("most")).first()
    assert got["n"] > 0 and got["most"] <= 1024


def test_empty_tables(spark, corpus, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{corpus[1]}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipe.run(spark, str(tmp_path)).count() == 0


def test_wordless_texts_pass_where_most_labels_are_toxic(spark, tmp_path):
    spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i, "awful words" if i % 3 else "good words here", "en", "s", 0) for i in range(60)] + [(100, None, "en", "s", None), (101, "", "en", "s", 0), (102, " \n", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"] for r in pipe.toxic(spark, docs, str(tmp_path)).collect()}
    assert {100, 101, 102} <= got and 1 not in got


def test_kept_rows_are_not_broadcast(spark):
    """The join back to the texts gives each row kept once, and its list does not go through the driver."""
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, None)], "doc_id long, text string")
    keep = docs.distinct().where("doc_id is null or doc_id < 3").selectExpr("doc_id", "xxhash64(coalesce(text, '')) as th", "if(doc_id = 2, 2L, 1L) as rows", "true as single")
    got = once(docs, keep, ["doc_id", "text"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, "a"), (2, "b"), (None, None)]
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
