"""Connected components by alternating large and small stars, on staged tables.

Each round reduces with partial aggregates and joins edges with one row a node, so a node
with very many neighbours is a skewed key on one side only, which the engine can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanternflow.llm._shared import discarded, staged


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> a row (node, root) for each node that is not the smallest of its component; root is
    the smallest.  Loops and repeated edges are harmless; null ends are dropped; no edges give no rows."""
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    sign = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == sign or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        sign = tuple(now)
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        before, e = e, staged(small.distinct(), "small-star")
        discarded(large)
        discarded(before)
