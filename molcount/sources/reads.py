"""Readers of raw reads, and the registration of the data sources ``fastq`` and ``bam``."""

from __future__ import annotations

import glob
import gzip

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from molcount.sources.bam import Bam


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    """A partition for each file; files of these formats are not split."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self):
        return [_File(p) for p in sorted(glob.glob(self.path)) or [self.path]]


class FastqReader(_Reader):
    def read(self, part: _File):
        with (gzip.open if part.path.endswith(".gz") else open)(part.path, "rt") as f:
            ordinal = 0
            while name := f.readline():
                seq, _, qual = f.readline().rstrip(), f.readline(), f.readline().rstrip()
                yield part.path, ordinal, name.rstrip(), seq, qual
                ordinal += 1


class Fastq(DataSource):
    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return "file string, ordinal long, name string, seq string, qual string"

    def reader(self, schema):
        return FastqReader(self.options)


def register(spark: SparkSession) -> None:
    """The data sources of this package; a source that takes filters needs the session's leave to."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for kind in (Fastq, Bam):
        spark.dataSource.register(kind)
