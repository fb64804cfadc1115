"""Tables written once at the boundaries of composite plans, in the folder that all executors share.

What comes after reads a table and not the whole plan before it, so nothing is computed or
compiled twice, and a lost executor costs a re-read.  Tables go when the application ends.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[tuple[str, str], str] = {}


def _root(spark: SparkSession) -> str:
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="lanternflow-")
        spark.conf.set("spark.checkpoint.dir", where)
    if "://" not in where and not where.startswith("file:"):
        where = f"file://{os.path.abspath(where)}"
    key = (spark.sparkContext.applicationId, where)
    if key not in _roots:
        _roots[key] = f"{where.rstrip('/')}/lanternflow-plans-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(_roots[key])
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
    return _roots[key]


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written once."""
    path = f"{_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
