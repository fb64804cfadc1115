"""Dedupe with an explicit order: never an order that the engine happens to have."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def keep_first(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The row with the smallest seq of each key; null keys are dropped.  One aggregate, so a hot key is combined
    before it is shuffled."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(row, F.col(seq)).alias("r")).select("r.*")


def keep_best(df: DataFrame, key: str, score: Column, seq: str) -> DataFrame:
    """The row with the largest score of each key, ties to the smallest seq; ordered by a key's first appearance."""
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(row, F.struct(score, -F.col(seq))).alias("r"), F.min(seq).alias("first_seq"))
    return best.select("r.*", "first_seq").orderBy("first_seq").drop("first_seq")


def discovery_classes(found: DataFrame, known: DataFrame, key: str, seq: str) -> DataFrame:
    """found with ``class``: duplicate (seen in this run), existing (known before) or new."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(seq))
    seen = known.select(key).distinct().withColumn("__known", F.lit(True))
    out = found.withColumn("__rank", rank).join(seen, key, "left")
    label = F.when(F.col("__rank") > 1, "duplicate").when(F.col("__known"), "existing").otherwise("new")
    return out.withColumn("class", label).drop("__rank", "__known")


def distinct_provenance(rows: DataFrame, keys: Sequence[str], seq: str, existing: DataFrame | None = None) -> DataFrame:
    """The first row of each key by seq, that is not there already; null and empty key parts are the same."""
    parts = {f"__{k}": F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys}
    first = rows.withColumns(parts).withColumn("__n", F.row_number().over(W.partitionBy(*parts).orderBy(seq))).where("__n = 1").drop("__n")
    if existing is not None:
        first = first.join(existing.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"__{k}") for k in keys]).distinct(), list(parts), "left_anti")
    return first.drop(*parts)


def signal_union(df: DataFrame, key: str, signal: str) -> DataFrame:
    """Sorted distinct signals of each key."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(signal)).alias("signals"))


def first_evidence(hits: DataFrame, store: str, signal: str, order: str) -> DataFrame:
    """Each signal once for each store: the hit of its first page."""
    row = F.struct(*[F.col(c) for c in hits.columns])
    return hits.groupBy(store, signal).agg(F.min_by(row, F.col(order)).alias("r")).select("r.*")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key."""
    return df.agg((F.count(key) - F.count_distinct(key)).alias("duplicates"))
