"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. ``run`` writes each stage's rows as Parquet to the shared folder and hands them on.

- toxicity: documents predicted toxic go; the network learns from the labels table beside documents.
- near_duplicates: one document of each component of Jaccard links stays, that with the smallest id.
- repeated_substrings: byte strings of 204 bytes (a little less than a passage of 50 words) that occur
  again anywhere are cut out, at all their places; a character that a cut splits goes whole.
  n_chars is that of the new text. A document that is cut to nothing stays, empty.
- mixing: rows are takes in training order: a document that is taken twice is two rows, one that is
  not taken is none, and the one at a source's end is cut to its words taken (joined by one space).
- packing: pieces of sequences.

Null and empty texts pass the filters and become empty documents; mixing takes no words of them, so
they end there. Rows that repeat are near duplicates of each other. Empty tables give empty results.
Very long texts are processed whole. Stages select the columns of documents, so others, whatever their
names, change nothing. Of near duplicates with the same least id (rows that repeat) one row stays.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.llm import jaccard, mixing, packing, substrings, toxicity
from molcount.llm.common import WORD, Scratch, documents, once

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.scored(spark, docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    wordless = ~F.coalesce("text", F.lit("")).rlike(WORD)
    return scored.where((F.col("predicted") == 0) | wordless).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = jaccard.join(spark, docs, Scratch(spark, "near"))
    keep = marked.groupBy("doc_id", "th").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"), F.max(F.col("n_shingles") > 0).alias("single")).where("kept")
    return once(docs, keep, COLUMNS).select(*COLUMNS)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cut(spark, docs.select(*COLUMNS), substrings.PASSAGE, substrings.PASSAGE_GRAM).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.taken(spark, docs.select(*COLUMNS), mixing.turns, Fraction(3, 2)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs)


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("repeated_substrings", repeated_substrings), ("mixing", mixed), ("packing", packed)]

#: Training a network and packing by a linear program are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
