"""Mixing sources to target weights by systematic sampling.

Within a source every document expects ``target / source_size`` copies.  Rows are ranged
over the cluster by (source, size, hash) and numbered within their range, in which a source's
rows lie together; each range counts its rows of each source, and the counts of earlier
ranges plus the place in its own range give a row's prefix sum of expected copies.  No row
passes through Python.  One random offset a source is added, drawn from the seed before anything
is counted, and a document is emitted once for each integer boundary that its interval
crosses.  As rows lie by size, errors of neighbours cancel, and a source's words miss its
target by one large document at most.

No source is gathered in one task: a source that holds a third of all rows is spread over
a third of the ranges.  Prefix sums over ranges are taken in the cluster (a source has at
most one row a range there) and broadcast only up to ``BROADCAST_ROWS`` rows.  To the
driver goes a row for each source: its name and its size, which is what a mix's recipe
lists.

Cases: a null text has size 0; a null source is a source of its own, last in order; a null
doc_id is kept; repeated rows are sampled as rows of their own; sources without words take
0 words, their documents follow the rate 0; an empty table gives an empty result; extra
columns are carried through ``mix``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lanternflow.llm._shared import read_table, small, small_table, staged, word_count

SOURCE, SIZE, ORDER, RANGE, PLACE, COPIES = (f"__mix_{x}" for x in ("source", "size", "order", "range", "place", "copies"))
#: Offsets are multiples of this, so that offset plus whole numbers is exact.
GRAIN = 1 << 20
#: monotonically_increasing_id has the row's number in its range below this bit, and the range's number above.
NUMBER_BITS = 33


def cyclic_weights(weights: Sequence[float] = (3.0, 1.0, 2.0)) -> Callable[[int], float]:
    """Weights that repeat over the sources in their order."""
    return lambda k: float(weights[k % len(weights)])


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Share ``share`` of all sizes by weight; a source stops at ``most`` times its size, and what is over goes to the
    others by weight until none is above."""
    out = [0.0] * len(sizes)
    # a source is full first where its cap over its weight is smallest
    order = sorted((k for k in range(len(sizes)) if weights[k] > 0), key=lambda k: sizes[k] / weights[k])
    left, rest = share * sum(sizes), list(accumulate(weights[k] for k in reversed(order)))
    for k in order:
        out[k] = min(most * sizes[k], left * weights[k] / rest.pop())
        left = max(0.0, left - out[k])
    return out


def _copies(docs: DataFrame, weight_of: Callable[[int], float], share: float, most: float, seed: int, name: str) -> tuple[DataFrame, DataFrame]:
    """docs with private columns and COPIES; and a small table of sources: SOURCE, source_size, target."""
    spark = docs.sparkSession
    held = docs.withColumns({SOURCE: F.col("source").cast("string"), SIZE: word_count(F.col("text")), ORDER: F.xxhash64("doc_id", "text")})
    if name == "narrow":
        held = held.select("doc_id", SOURCE, SIZE, ORDER)
    ranged = held.repartitionByRange(F.col(SOURCE).asc_nulls_last(), SIZE, ORDER).sortWithinPartitions(F.col(SOURCE).asc_nulls_last(), SIZE, ORDER)
    placed = staged(ranged.withColumn(PLACE, F.monotonically_increasing_id()), "mix").withColumn(RANGE, F.shiftright(PLACE, NUMBER_BITS))
    counted = staged(placed.groupBy(SOURCE, RANGE).agg(F.count(F.lit(1)).alias("__n"), F.min(PLACE).alias("__least"), F.sum(SIZE).alias("__words")), "mix-counts")
    sizes = {r[0]: r[1] for r in counted.groupBy(SOURCE).agg(F.sum("__words")).collect()}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = targets([sizes[x] for x in names], [weight_of(k) for k in range(len(names))], share, most)
    rates = [t / sizes[x] if sizes[x] else 0.0 for x, t in zip(names, want)]
    goal = small_table(spark, **{SOURCE: pa.array(names, pa.string()), "source_size": pa.array([sizes[x] for x in names], pa.int64()), "target": pa.array(want, pa.float64()), "__rate": pa.array(rates, pa.float64())})
    before = F.coalesce(F.sum("__n").over(W.partitionBy(SOURCE).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before")
    ahead = counted.select(F.col(SOURCE).alias("__s"), F.col(RANGE).alias("__r"), "__least", before)
    rated = goal.select(F.col(SOURCE).alias("__g"), "__rate")
    rows = placed.join(small(ahead, counted.count()), (F.col(RANGE) == F.col("__r")) & F.col(SOURCE).eqNullSafe(F.col("__s"))).join(small(rated, len(names)), F.col(SOURCE).eqNullSafe(F.col("__g")))
    offset = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(SOURCE, F.lit("\0null"))), F.lit(GRAIN)) / F.lit(float(GRAIN))
    rank = F.col("__before") + F.col(PLACE) - F.col("__least")
    crossed = F.floor(offset + F.col("__rate") * (rank + 1)) - F.floor(offset + F.col("__rate") * rank)
    out = rows.withColumn(COPIES, F.least(crossed, F.ceil("__rate")).cast("long"))
    return out.drop("__r", "__s", "__g", "__before", "__least", "__rate", RANGE, PLACE, ORDER), goal.drop("__rate")


def mix(docs: DataFrame, weight_of: Callable[[int], float] | None = None, share: float = 1.5, most: float = 2.0, seed: int = 20) -> DataFrame:
    """The mixed corpus: docs' own columns, each document as often as it was drawn."""
    out, _ = _copies(docs, weight_of or cyclic_weights(), share, most, seed, "whole")
    return out.withColumn(COPIES, F.explode(F.expr(f"array_repeat(0, cast({COPIES} as int))"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_report(docs: DataFrame, weight_of: Callable[[int], float] | None = None, share: float = 1.5, most: float = 2.0, seed: int = 20) -> DataFrame:
    """A row for each document: doc_id, source, size, source_size, target, copies, taken (words the mix takes)."""
    out, goal = _copies(docs.select("doc_id", "source", "text"), weight_of or cyclic_weights(), share, most, seed, "narrow")
    goal = goal.withColumnRenamed(SOURCE, "__g")
    return out.join(small(goal, goal.count()), F.col(SOURCE).eqNullSafe(F.col("__g"))).select(
        "doc_id", F.col(SOURCE).alias("source"), F.col(SIZE).alias("size"), "source_size", "target", F.col(COPIES).alias("copies"), (F.col(COPIES) * F.col(SIZE)).alias("taken")
    )


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read_table(spark, sf_dir, "documents"))


QUERIES = {"op1_mix_sources": op1_mix_sources}
SQL: dict[str, str] = {}
