"""Lines of large text files with their numbers, and formats that go over lines: FASTQ records and FASTA sequences.

Spark's text reader cuts files into blocks at lines, in any store and compression it reads. A line's number is its place in its
block, counted in the task, and the lines of all blocks before, from a small table of a row for each block. Blocks
follow from the session's settings alone; should they differ between the two readings, that is an error and not a wrong number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molcount.operators.intervals import few
from molcount.plans.store import kept

BLOCK = ["file", "block", "length"]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_block_length").alias("length"), "value")


def _runs(b: pa.RecordBatch):
    """(first, after last) of runs of rows of one block; blocks of one file may meet in a task."""
    at, names = b.column("block").to_numpy(), b.column("file").dictionary_encode().indices.to_numpy()
    cut = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (names[1:] != names[:-1])) + 1).tolist(), len(at)]
    return [(lo, hi) for lo, hi in zip(cut, cut[1:], strict=False) if lo < hi]


def numbered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, line, value, before, lines): the line's number in its file, from 0; before and lines are those of its block.

    In a task the lines of a block stand together and in order, unless there are so many blocks that their table is not broadcast.
    """

    def placed(batches):
        last, n = None, 0
        for b in batches:
            at = np.zeros(b.num_rows, dtype=np.int64)
            for lo, hi in _runs(b):
                key = (b.column("file")[lo].as_py(), b.column("block")[lo].as_py())
                if key != last:
                    last, n = key, 0
                at[lo:hi] = np.arange(n, n + hi - lo)
                n += hi - lo
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=[*b.schema.names, "at"])

    counted = _lines(spark, path).groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("lines"))
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    table = kept(counted.withColumn("before", F.coalesce(F.sum("lines").over(w), F.lit(0))), "blocks")
    small = F.broadcast(table) if few(table) else table
    x = _lines(spark, path).mapInArrow(placed, "file string, block long, length long, value string, at long").join(small, BLOCK, "left")
    before = F.when(F.col("before").isNotNull(), F.col("before")).otherwise(F.raise_error(F.concat(F.lit("blocks of a text file changed between two readings: "), "file")).cast("long"))
    return x.select("file", "block", (before + F.col("at")).alias("line"), "value", "before", "lines")


def fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, ordinal, name, seq, qual) of FASTQ files of any size; a record's ordinal is its number in its file, from 0.

    Records within a block are put together in its task, without a shuffle. Lines of records that lie over the border of two
    blocks, at most three on each side, are grouped by their record. Lines are trimmed on the right; an incomplete last record is dropped.
    """
    lines = numbered(spark, path)
    schema = "file string, ordinal long, name string, seq string, qual string"

    def records(batches):
        """Whole records of each run of lines; those of a run's end are held for the next batch of the block."""
        held: tuple | None = None

        def whole(file, line, values):
            skip = -line % 4
            n = (len(values) - skip) // 4
            if n < 1:
                return None
            v = pc.utf8_rtrim_whitespace(values.slice(skip, 4 * n))
            pick = lambda k: v.take(pa.array(np.arange(k, 4 * n, 4)))
            return pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array(np.arange(n, dtype=np.int64) + (line + skip) // 4), pick(0), pick(1), pick(3)], names=["file", "ordinal", "name", "seq", "qual"])

        for b in batches:
            for lo, hi in _runs(b):
                file, block, line = (b.column(c)[lo].as_py() for c in ("file", "block", "line"))
                values = b.column("value").slice(lo, hi - lo)
                if held and held[:2] == (file, block):
                    line, values = held[2], pa.concat_arrays([held[3], values])
                got = whole(file, line, values)
                if got is not None:
                    yield got
                skip = -line % 4
                done = skip + 4 * ((len(values) - skip) // 4) if len(values) > skip else 0
                held = (file, block, line + done, values.slice(done))

    inner = lines.select("file", "block", "line", "value").mapInArrow(records, schema)
    # records that begin in one block and end in another
    first, last = F.col("before"), F.col("before") + F.col("lines")
    record = F.floor(F.col("line") / 4)
    border = lines.where((record * 4 < first) | (record * 4 + 4 > last)).select("file", record.alias("ordinal"), (F.col("line") % 4).alias("k"), F.rtrim("value").alias("value"))
    pick = lambda k: F.max(F.when(F.col("k") == k, F.col("value")))
    over = border.groupBy("file", "ordinal").agg(pick(0).alias("name"), pick(1).alias("seq"), pick(3).alias("qual"), F.count(F.lit(1)).alias("n")).where("n = 4").drop("n")
    return inner.unionByName(over)


CHUNK = 4096


def fasta_chunks(spark: SparkSession, path: str | list[str], chunk: int = CHUNK) -> DataFrame:
    """(contig, chunk, start, bases): pieces of sequences, upper-cased, none longer than a chunk of places nor over its border.

    A task gives its blocks' lines as pieces; a row for each block and contig in it, added up along the file, says where
    they stand. So no sequence is one string and no base is a row.
    """

    def pieces(batches, texts: bool):
        last, seg, contig, count, held, at = None, 0, None, 0, [], 0
        out: list[tuple] = []

        def close():
            if not texts and last is not None:
                out.append((*last, seg, contig, count, None, None))

        def flush():
            nonlocal held, at
            if held:
                text = "".join(held)
                out.append((*last, seg, None, None, at, text))
                at += len(text)
                held = []

        def sent():
            rows, out[:] = list(out), []
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["file", "block", "seg", "contig", "count", "at", "bases"])

        for b in batches:
            for lo, hi in _runs(b):
                key = (b.column("file")[lo].as_py(), b.column("block")[lo].as_py())
                if key != last:
                    flush()
                    close()
                    last, seg, contig, count, at = key, 0, None, 0, 0
                size = 0
                for line in b.column("value").slice(lo, hi - lo).to_pylist():
                    if line.startswith(">"):
                        flush()
                        close()
                        seg, contig, count, at, size = seg + 1, (line[1:].split() or [""])[0], 0, 0, 0
                        continue
                    bases = "".join(line.split()).upper()
                    count += len(bases)
                    if texts:
                        held.append(bases)
                        size += len(bases)
                        if size >= chunk:
                            flush()
                            size = 0
                if texts:
                    flush()
            if out:
                yield sent()
        flush()
        close()
        if out:
            yield sent()

    schema = "file string, block long, seg int, contig string, count long, at long, bases string"
    segments = _lines(spark, path).mapInArrow(lambda x: pieces(x, False), schema).select("file", "block", "seg", "contig", "count")
    w = Window.partitionBy("file").orderBy("block", "seg")
    s = segments.withColumns({"name": F.last("contig", ignorenulls=True).over(w), "number": F.count("contig").over(w)})
    along = Window.partitionBy("file", "number").orderBy("block", "seg").rowsBetween(Window.unboundedPreceding, -1)
    table = kept(s.withColumn("from", F.coalesce(F.sum("count").over(along), F.lit(0))).where("name is not null").select("file", "block", "seg", F.col("name").alias("contig"), "from"), "segments")
    small = F.broadcast(table) if few(table) else table
    x = _lines(spark, path).mapInArrow(lambda y: pieces(y, True), schema).select("file", "block", "seg", "at", "bases").where("bases <> ''").join(small, ["file", "block", "seg"])
    x = x.select("contig", (F.col("from") + F.col("at")).alias("low"), "bases")
    numbers = F.sequence(F.floor(F.col("low") / chunk), F.floor((F.col("low") + F.length("bases") - 1) / chunk))
    x = x.select("contig", "low", "bases", F.explode(numbers).alias("chunk"))
    start = F.greatest(F.col("low"), F.col("chunk") * chunk)
    end = F.least(F.col("low") + F.length("bases"), (F.col("chunk") + 1) * chunk)
    return x.select("contig", "chunk", start.alias("start"), F.substring(F.col("bases"), (start - F.col("low") + 1).cast("int"), (end - start).cast("int")).alias("bases"))


def lengths(chunks: DataFrame) -> DataFrame:
    """(contig, length)."""
    return chunks.groupBy("contig").agg(F.max(F.col("start") + F.length("bases")).alias("length"))


def with_reference(positions: DataFrame, chunks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """positions (contig, ref_pos, ...) with the reference base; those outside the sequences go. An equality join by chunk."""
    p = positions.withColumn("chunk_", F.floor(F.col("ref_pos") / chunk))
    c = chunks.select(F.col("contig").alias("contig_"), F.col("chunk").alias("chunk_c"), F.col("start").alias("start_"), F.col("bases").alias("bases_"))
    meets = (F.col("contig") == F.col("contig_")) & (F.col("chunk_") == F.col("chunk_c")) & F.col("ref_pos").between(F.col("start_"), F.col("start_") + F.length("bases_") - 1)
    x = p.join(c, meets).withColumn("reference", F.substring(F.col("bases_"), (F.col("ref_pos") - F.col("start_") + 1).cast("int"), F.lit(1)))
    return x.drop("chunk_", "contig_", "chunk_c", "start_", "bases_")
