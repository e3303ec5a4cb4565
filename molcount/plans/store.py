"""Tables that several steps read, written once to the folder that the cluster's executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []
_kept: dict[int, tuple[DataFrame, str]] = {}


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where that is unset and the master is local."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if top:
        return top.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _local:
        _local.append("file://" + tempfile.mkdtemp(prefix="molcount-"))
    return _local[0]


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written and read again: later steps and lost executors don't redo what led to them."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _kept[id(out)] = (out, path)
    return out


def dropped(df: DataFrame) -> None:
    """The table of a frame that ``kept`` gave goes now; no later step may read it."""
    out, path = _kept.pop(id(df), (None, None))
    if out is not None:
        _delete(out.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session has ended; a cleaner of the shared folder takes the rest
        pass


@atexit.register
def _drop() -> None:
    for out, path in _kept.values():
        _delete(out.sparkSession, path)
