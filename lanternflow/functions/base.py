"""Helpers of the function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body with a name for value: it is computed once, and plans and generated code stay small however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


BATCH_BYTES = 1 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of a megabyte, unless the session has a bound of its own: Spark's 64 MB are held by each worker, besides what it makes of them."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("bB") == str(64 << 20):
        spark.conf.set(key, str(BATCH_BYTES))
