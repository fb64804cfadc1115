"""Benchmark decontamination by size-partitioned MinHash containment search.

An item leaks into a document if at least ``threshold`` of the item's distinct word
shingles are in the document, however long that is.

Items are partitioned by the size of their shingle set, in powers of two.  A partition
holds a MinHash signature of each of its items: the item's smallest hashes, all items of a
partition as many, namely ``top - ceil(threshold * top) + 1`` for the largest size ``top``
of the partition (or all that the item has).  The shingles of a document, however many, are
probed against all signatures in one pass.  If s of an item's k signature hashes are met,
s / k estimates its containment; a document with ``ceil(threshold * m)`` of the item's m
shingles can miss at most ``m - ceil(threshold * m)`` of the signature, so pairs with fewer
than ``k - (m - ceil(threshold * m))`` hits are dropped, and no leak is.  (Banded minima of
whole documents have no such bound: a short item and a long document share almost none of
them.)  What is left are candidates; their shingles are counted against the whole sets for
the exact containment.  ``candidates`` reports for each partition how many there were and
how many of them are leaks.

All of it is DataFrame operations, and no text is shuffled: a document row is named by its
doc_id and a hash of its text, and candidate rows are found again by that.  Signatures,
sets and candidates are broadcast while they have at most ``BROADCAST_ROWS`` rows, and
shuffled beyond; shingles are spread as rows and counted, and never gathered.

Cases: words are runs of letters and digits, in lower case; items with fewer words than a
shingle are compared as a whole, in shingles of their own length; null and empty texts and
items without words match nothing; null doc_ids and item_ids are kept and match like
others; repeated doc_ids report the best of their rows, and repeated item_ids the best of
theirs; an empty table gives an empty result; extra columns are carried through ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanternflow.llm._shared import read_table, small, staged

WORDS, THRESHOLD, BROADCAST_ROWS = 5, 0.8, 1_000_000
DOC, ITEM, ROW = "__doc", "__item", "__row"


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(tokens: Column, size: int) -> Column:
    """Hashes of the runs of ``size`` tokens, repeats included; none if there are fewer."""
    n = F.size(tokens) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(*[F.get(tokens, i + (k - 1)) for k in range(size)]))).otherwise(F.array().cast("array<bigint>"))


def item_sets(items: DataFrame, size: int = WORDS) -> DataFrame:
    """key, ITEM, width (words in a shingle), m (distinct shingles of the item), part (size partition), hash: a row for each shingle."""
    t = items.select(F.col("item_id").alias(ITEM), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    sets = F.array_distinct(F.coalesce(*[F.when(F.least(F.size("w"), F.lit(size)) == k, shingles(F.col("w"), k)) for k in range(1, size + 1)]))
    t = t.select(F.xxhash64(ITEM, F.concat_ws(" ", "w")).alias("key"), ITEM, F.least(F.size("w"), F.lit(size)).alias("width"), sets.alias("s")).dropDuplicates(["key"])
    m = F.size("s")
    return t.select("key", ITEM, "width", m.alias("m"), F.floor(F.log2(m.cast("double")) + F.lit(1e-9)).cast("int").alias("part"), F.explode("s").alias("hash"))


def _needed(m: Column, threshold: float) -> Column:
    """ceil(threshold * m)."""
    return F.ceil(F.lit(threshold) * m - F.lit(1e-9)).cast("int")


def signatures(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """key, least (hits that a leak has at least), hash: the smallest hashes of each item, as many as its partition asks for."""
    top = sets.groupBy("part").agg(F.max("m").alias("top"))  # a row for each power of two
    lists = sets.groupBy("key", "width", "part", "m").agg(F.array_sort(F.collect_set("hash")).alias("s")).join(F.broadcast(top), "part")
    k = F.least(F.col("m"), F.col("top") - _needed(F.col("top"), threshold) + 1)
    return lists.select("key", (k - (F.col("m") - _needed(F.col("m"), threshold))).alias("least"), F.explode(F.slice("s", F.lit(1), k)).alias("hash"))


def _probes(docs: DataFrame, widths: list[int]) -> DataFrame:
    """DOC, ROW, hash: the shingles of each document row, of all widths that items have, in one pass."""
    text = docs.select(F.col("doc_id").alias(DOC), F.xxhash64("text").alias(ROW), words(F.col("text")).alias("w"))
    # a hash of five words is none of four, so the hash alone tells widths apart
    return text.select(DOC, ROW, F.explode(F.concat(*[shingles(F.col("w"), k) for k in widths])).alias("hash"))


def _found(docs: DataFrame, sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame] | None:
    """Candidate pairs (DOC, ROW, key), and the shared shingles of each that is a leak; None without items."""
    rows = sets.count()
    widths = sorted(r[0] for r in sets.select("width").distinct().collect())  # at most as many as words in a shingle
    if not widths:
        return None
    hits = _probes(docs, widths).join(small(signatures(sets, threshold), rows, BROADCAST_ROWS), "hash").select(DOC, ROW, "key", "least", "hash").distinct()
    pairs = staged(hits.groupBy(DOC, ROW, "key", "least").agg(F.count(F.lit(1)).alias("n")).where("n >= least").select(DOC, ROW, "key"), "candidate-pairs")
    named = pairs.select(F.col(DOC).alias("__d"), F.col(ROW).alias("__r")).distinct()
    again = docs.select("doc_id", "text").join(small(named, pairs.count(), BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__r")), "left_semi")
    held = _probes(again, widths).join(small(sets.select("hash", "key"), rows, BROADCAST_ROWS), "hash").select(DOC, ROW, "key", "hash").distinct()
    shared = held.groupBy(DOC, ROW, "key").agg(F.count(F.lit(1)).alias("shared"))
    return pairs, shared.join(small(sets.select("key", ITEM, "m", "part").distinct(), rows, BROADCAST_ROWS), "key").where(F.col("shared") >= F.lit(threshold) * F.col("m") - F.lit(1e-9))


def leaks(docs: DataFrame, items: DataFrame, size: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment of each leak."""
    found = _found(docs, staged(item_sets(items, size), "item-sets"), threshold)
    if found is None:
        return docs.select("doc_id").limit(0).select("doc_id", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), F.lit(0).cast("long").alias("shared"), F.lit(0).cast("long").alias("item_shingles"), F.lit(0.0).alias("containment"))
    best = found[1].groupBy(DOC, ITEM).agg(F.max(F.struct((F.col("shared") / F.col("m")).alias("containment"), "shared", F.col("m").alias("item_shingles"))).alias("b"))
    return best.select(F.col(DOC).alias("doc_id"), F.col(ITEM).alias("item_id"), "b.shared", F.col("b.item_shingles").cast("long").alias("item_shingles"), "b.containment")


def candidates(docs: DataFrame, items: DataFrame, size: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """part, smallest, candidates, verified: pairs of a document row and an item in each size partition, from 2 ** part shingles on."""
    sets = staged(item_sets(items, size), "item-sets")
    found = _found(docs, sets, threshold)
    if found is None:
        return sets.sparkSession.createDataFrame([], "part int, smallest long, candidates long, verified long")
    parts = small(sets.select("key", "part").distinct(), sets.count(), BROADCAST_ROWS)
    told = found[0].join(parts, "key").groupBy("part").agg(F.count(F.lit(1)).alias("candidates"))
    good = found[1].groupBy("part").agg(F.count(F.lit(1)).alias("verified"))
    return told.join(good, "part", "left").select("part", F.pow(F.lit(2), F.col("part")).cast("long").alias("smallest"), "candidates", F.coalesce("verified", F.lit(0)).alias("verified"))


def clean(docs: DataFrame, items: DataFrame, size: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that hold an item."""
    bad = staged(leaks(docs, items, size, threshold).select(F.col("doc_id").alias(DOC)).distinct(), "leaking")
    return docs.join(small(bad, bad.count(), BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col(DOC)), "left_anti")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_decontamination": op5_decontamination}
SQL = {
    "op5_decontamination": r"""
with iw as (
  select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from benchmark
), s as (
  select item_id, least(len(w), 5) as width,
         list_distinct(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i : i + least(len(w), 5) - 1], ' '))) as s
  from iw where len(w) > 0
), i as (
  select item_id, width, len(s) as m, unnest(s) as g from s
), dw as (
  select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents
), d as (
  select distinct doc_id, k.width, unnest(list_transform(range(1, greatest(len(w) - k.width + 2, 1)), lambda i: array_to_string(w[i : i + k.width - 1], ' '))) as g
  from dw, (select distinct width from s) k
)
select d.doc_id, i.item_id, count(*) as shared, i.m as item_shingles, count(*) / i.m as containment
from d join i on d.g = i.g and d.width = i.width
group by d.doc_id, i.item_id, i.m
having count(*) >= 0.8 * i.m - 1e-9
"""
}
