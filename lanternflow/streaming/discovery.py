"""Extension: discovery as a stream.  New CSV or Parquet files are merged into the candidate snapshot batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lanternflow.operators.state import CANDIDATE, merge_candidates


def observations(spark: SparkSession, path: str, schema: str, at: str = "observed_at", late: str = "1 hour") -> DataFrame:
    """A stream of observations without repeats that come within the watermark."""
    stream = spark.readStream.schema(schema).parquet(path)
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(["domain", "source"])


def windowed_counts(stream: DataFrame, at: str, by: str, size: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.window(at, size), by).agg(F.count(F.lit(1)).alias("n"))


def merge_stream(stream: DataFrame, folder: str) -> StreamingQuery:
    """Writes a snapshot for each batch, named by its number: a batch that is run again writes the same one."""

    def merged(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        current = spark.read.schema(CANDIDATE).parquet(f"{folder}/snapshot-{number - 1}") if number else spark.createDataFrame([], CANDIDATE)
        rows = batch.select("domain", "original_url", F.lit(1).cast("long").alias("discovery_count"), F.array_compact(F.array("signal")).alias("signals"), F.lit(None).cast("string").alias("notes"), F.xxhash64("original_url", "source").alias("seq"))
        merge_candidates(current, rows).write.mode("overwrite").parquet(f"{folder}/snapshot-{number}")

    return stream.writeStream.foreachBatch(merged).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
