"""Token ids of a corpus in wavelet-matrix shard files, and reading them back.

Documents are dealt to ranges of doc_id (null: last, in ranges of their text hash; ties by text hash),
each range is one task, which sorts it and writes files of at most about ``shard_tokens`` tokens, named by range and number,
so the order of names is the order of documents. A file is written under a temporary name and then
renamed: a task that runs again writes the same bytes under the same name.

Null or empty texts are documents of the end id alone. An empty table writes no file.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.llm import wavelet
from molcount.llm.common import Scratch, id_ranges, keyed, partitions
from molcount.llm.encoding import blocks, default_path, encoder

SHARD_TOKENS = 1_000_000
MANIFEST = "range int, part int, file string, docs long, tokens long"


def put(root: str, name: str, data: bytes) -> None:
    """One file in a store that pyarrow can open (local or mounted folders, HDFS, S3, GCS)."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(root)
    store.create_dir(path, recursive=True)
    part = f"{path}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, f"{path}/{name}")


def write(docs: DataFrame, root: str, path: str | None = None, end: int = 2, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the files and returns the rows of the manifest, not yet run: a row for each file."""
    path = path or default_path()
    bucket, n = id_ranges(docs, 2 * partitions(docs.sparkSession))
    d = keyed(docs).withColumn("range", bucket)
    d = d.repartitionById(n, "range").sortWithinPartitions("range", F.isnull("doc_id"), "doc_id", "th").select("range", "doc_id", "text")

    def run(batches):
        enc, bits = encoder(path), max(int(encoder(path).size - 1).bit_length(), int(end).bit_length())
        tail = np.array([end], dtype="<u4").tobytes()
        now, part, before, ids, names, counts, total = None, 0, 0, [], [], [], 0

        def flush():
            data = wavelet.build(np.frombuffer(b"".join(ids), "<u4"), names, counts, bits, before)
            put(root, name := f"range-{now:08d}-{part:06d}.wvm", data)
            return pa.RecordBatch.from_pydict({"range": pa.array([now], pa.int32()), "part": pa.array([part], pa.int32()), "file": [name], "docs": [len(names)], "tokens": [total]})

        for batch in batches:
            for b in blocks(batch, ["range", "doc_id", "text"]):
                for r, d, x in zip(b["range"], b["doc_id"], enc.encode(b["text"]), strict=True):
                    if names and (r != now or total >= shard_tokens):
                        yield flush()
                        part, before = (0, 0) if r != now else (part + 1, before + total)
                        ids, names, counts, total = [], [], [], 0
                    now = r
                    ids.append(x + tail)
                    names.append(d)
                    counts.append(len(x) // 4 + 1)
                    total += counts[-1]
        if names:
            yield flush()

    return d.mapInArrow(run, MANIFEST)


def read(spark: SparkSession, root: str, starts: dict[int, int]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files; starts: ids before each range."""

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                s = wavelet.Shard(data.as_buffer())
                ids = s.decode().astype("<u4")
                ends = np.cumsum(s.counts)
                begins = ends - s.counts
                base = starts[int(name.rsplit("/", 1)[-1].split("-")[1])] + s.before
                view = memoryview(ids.view(np.uint8)).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(s.doc_ids, pa.int64()), pa.array(begins + base), pa.array(s.counts), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "range-*.wvm").load(root).select("path", "content")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(spark: SparkSession, docs: DataFrame, path: str | None = None, end: int = 2) -> DataFrame:
    scratch = Scratch(spark, "tokens")
    manifest = scratch.keep(write(docs, f"{scratch.root}/files", path, end), "manifest")
    sums = {r["range"]: r["n"] for r in manifest.groupBy("range").agg(F.sum("tokens").alias("n")).collect()}  # at most as many rows as ranges
    if not sums:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    starts, at = {}, 0
    for r in sorted(sums):
        starts[r] = at
        at += sums[r]
    return read(spark, f"{scratch.root}/files", starts)
