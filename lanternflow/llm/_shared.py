"""What the operators of this subpackage share: the cluster's shared folder, staged
tables that cut lineage, and file access by URI.

Staged tables are Parquet in the folder that ``spark.checkpoint.dir`` names, so a lost
executor costs a re-read and never a recomputation of what came before.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
ASCII_SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; made up only where it is unset and the master is local."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        os.makedirs("/tmp/checkpoints", exist_ok=True)
        where = tempfile.mkdtemp(prefix="lanternflow-", dir="/tmp/checkpoints")
        spark.conf.set("spark.checkpoint.dir", where)
    if "://" not in where and not where.startswith("file:"):
        where = f"file://{os.path.abspath(where)}"
    return where.rstrip("/")


_runs: dict[tuple[str, str], str] = {}


def _in_store(spark: SparkSession, path: str):
    """The store's own file system and the path in it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def workspace(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new folder name, unique to this call, in the shared folder.  It goes when the application ends, unless it is kept."""
    base = shared_dir(spark)
    if keep:
        return f"{base}/lanternflow-{name}-{uuid.uuid4().hex}"
    run = (spark.sparkContext.applicationId, base)
    if run not in _runs:
        _runs[run] = f"{base}/lanternflow-run-{uuid.uuid4().hex}"
        store, root = _in_store(spark, _runs[run])
        store.mkdirs(root)
        store.deleteOnExit(root)
    return f"{_runs[run]}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and return a reader of it."""
    path = workspace(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more, as all that came of it is staged itself."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        store, path = _in_store(df.sparkSession, folder)
        store.delete(path, True)


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it; works for file:, hdfs:, s3:, gs: and others that pyarrow knows."""
    return pafs.FileSystem.from_uri(uri if not uri.startswith("file:/") or uri.startswith("file://") else "file://" + uri[5:])


@contextmanager
def written_once(uri: str) -> Iterator[pa.NativeFile]:
    """Write under an attempt's own name, then move into place, so that a retried or
    speculative task leaves one whole file and never half of one."""
    store, path = opened(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(attempt) as out:
        yield out
    store.move(attempt, path)


def word_count(text: Column) -> Column:
    """Number of words (``WORD``) in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = 1 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of a megabyte, unless the session has a bound of its own: a worker holds each batch several
    times over, in the JVM and in Python, and Spark's default of 64 MB a batch takes an executor past 3 GB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("bB") == str(64 << 20):
        spark.conf.set(key, str(BATCH_BYTES))


def release() -> None:
    """Give the system what Arrow and the C library hold of freed memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # of glibc only
        ctypes.CDLL(None).malloc_trim(0)


def given_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, and its freed memory given back at the end of each task: a worker waits for its next task beside the
    executor's other stages, and what it holds then is missing there."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return runs


def small_table(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A table of the driver's own values, by way of Arrow: rows of Python objects would start a second Python daemon
    with workers of its own on each executor."""
    return spark.createDataFrame(pa.table(columns))


#: Rows up to which a checked table may be broadcast.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int, most: int | None = None) -> DataFrame:
    """df for the other side of a join: broadcast if it has few rows, else as it is, to be shuffled."""
    return F.broadcast(df) if rows <= (BROADCAST_ROWS if most is None else most) else df


def join_hot_apart(rows: DataFrame, table: DataFrame, key: str, n: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with table on key, where table has a row for each key and n says how many rows have it.

    Keys with more than a thousandth of all rows (at most a thousand keys, so they may be broadcast) meet their rows
    where these are; only the others are shuffled.  No task gets more than its share of a hot key."""
    hot = F.col(n) > max(1000, total // 1000)
    few, many = F.broadcast(table.where(hot)), table.where(~hot)
    return rows.join(few, key).unionByName(rows.join(few.select(key), key, "left_anti").join(many, key, how))
