"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are made where texts are read.  Distinct ones are sorted by Gray rank and
ranged into segments; a directory holds for each segment the bits that all of it share (a
mask and their values).  A fingerprint is sent to those segments whose shared bits differ
from its own in at most ``radius`` places, and only to its own and later ones, so that
each pair meets once.  In a segment a tree is built over the sorted codes: neighbours share
many bits, which are factored into a parent as a masked pattern, level by level.  A search
goes down from the root, adds up the differences in the bits that each level fixes, and
drops whole groups once the sum is over ``radius``.

Links of a segment are reduced to a forest there (a row for each linked fingerprint at
most), and forests are joined to components over the cluster.  Exact copies have one
fingerprint and never meet as pairs.  The driver sees the directory only: a row for each
segment of up to ``SEGMENT`` fingerprints.

Cases: null and empty texts have fingerprint zero and link like any other; texts of fewer
than three words hash as a whole; very long texts are hashed a piece at a time; null
doc_ids count as a document but never as component_id (which is null where all are null);
repeated rows are copies of one another; an empty table gives an empty result; extra
columns are carried through ``deduplicated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanternflow.llm._shared import bounded_batches, given_back, join_hot_apart, read_table, small, staged
from lanternflow.llm.graph import components

RADIUS, SHINGLE, SEED, SEGMENT, SEGMENTS, FAN = 2, 3, 42, 32_768, 64, 4
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(data: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of data, some megabytes at a time."""
    at = 0
    while at < len(data):
        cut = SPACE.search(data, min(at + size, len(data)))
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end + 1


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED, piece: int = 4 << 20) -> bytes:
    """Eight bytes, highest first.  bytes.lower() and bytes.split() treat ASCII only, as asked."""
    from xxhash import xxh64_digest

    ones, total, rest = np.zeros(64, np.int64), 0, []
    for words in _pieces(data.lower(), piece):
        words = rest + words
        if len(words) < shingle:
            rest = words
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
        starts = np.concatenate([[0], ends[:-1] + 1])
        line = b" ".join(words)
        rest = words[1 - shingle :] if shingle > 1 else []
        codes = b"".join([xxh64_digest(line[a:b], seed) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())])
        bits = np.unpackbits(np.frombuffer(codes, np.uint8).reshape(-1, 8), axis=1)
        ones += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += len(bits)
    if not total and rest:
        return xxh64_digest(b" ".join(rest), seed)
    return np.packbits(2 * ones > total).tobytes()


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = b"".join(fingerprint(x or b"", shingle) for x in batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.frombuffer(codes, ">i8").astype(np.int64))], names=["doc_id", "tie", "fp"])

    return run


def row_key() -> Column:
    """Tells rows apart that share a doc_id, and null ids from others."""
    return F.xxhash64("doc_id", "text")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tie (row_key), fp (the 64 bits as a signed long)."""
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("tie"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(given_back(_fingerprints(shingle)), "doc_id long, tie long, fp long")


def gray_rank(code: Column) -> Column:
    """Place of a code in Gray order, as a long that sorts like the unsigned rank."""
    for by in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, by))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """A tree over codes in Gray order (or over patterns: values with masks of the bits that count)."""

    def __init__(self, values: np.ndarray, masks: np.ndarray | None = None, fan: int = FAN):
        masks = np.full(len(values), ALL) if masks is None else masks
        self.fan, self.levels = fan, [(masks, values & masks)]
        while len(self.levels[-1][0]) > 1:
            masks, values = self.levels[-1]
            at = np.arange(0, len(values), fan)
            all_, any_ = np.bitwise_and.reduceat(values, at), np.bitwise_or.reduceat(values, at)
            shared = ~(all_ ^ any_) & np.bitwise_and.reduceat(masks, at)
            self.levels.append((shared, all_ & shared))

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the query, number of the leaf) within radius."""
        if not len(self.levels[0][0]):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        masks, values = self.levels[-1]
        far = np.bitwise_count((queries ^ values[0]) & masks[0]).astype(np.int16)
        near = far <= radius
        q, node, far = q[near], node[near], far[near]
        for up in range(len(self.levels) - 1, 0, -1):
            above, (masks, values) = self.levels[up][0], self.levels[up - 1]
            child = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
            q, far, seen = np.repeat(q, self.fan), np.repeat(far, self.fan), np.repeat(above[node], self.fan)
            real = child < len(masks)
            q, far, seen, child = q[real], far[real], seen[real], child[real]
            far = far + np.bitwise_count((queries[q] ^ values[child]) & masks[child] & ~seen).astype(np.int16)
            near = far <= radius
            q, node, far = q[near], child[near], far[near]
        return q, node


def _route(directory: list[tuple[int, int, int]], radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.array([d[0] for d in directory], np.int64)
        all_, any_ = (np.array([d[k] for d in directory], np.int64).view(np.uint64) for k in (1, 2))
        index = GrayIndex(all_, ~(all_ ^ any_))
        for batch in batches:
            own, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo in range(0, len(fp), 4096):
                q, leaf = index.search(fp[lo : lo + 4096].view(np.uint64), radius)
                later = number[leaf] >= own[lo + q]
                yield pa.RecordBatch.from_arrays([pa.array(number[leaf[later]].astype(np.int32)), pa.array(fp[lo + q[later]])], names=["segment", "fp"])

    return run


def _united(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the sets of a and b; each set is named by its smallest member."""
    while True:
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])


def _links(radius: int, chunk: int = 2048):
    def run(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        codes = members.sort_values("rank")["fp"].to_numpy(np.int64).view(np.uint64)
        asked = queries["fp"].to_numpy(np.int64).view(np.uint64)
        index, nodes = GrayIndex(codes), np.unique(np.concatenate([codes, asked]))
        leaf_node, parent = np.searchsorted(nodes, codes), np.arange(len(nodes))
        for lo in range(0, len(asked), chunk):
            part = asked[lo : lo + chunk]
            q, leaf = index.search(part, radius)
            parent = _united(parent, np.searchsorted(nodes, part)[q], leaf_node[leaf])
        linked = np.flatnonzero(parent != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[linked].view(np.int64), "b": nodes[parent[linked]].view(np.int64)})

    return run


def linked_fingerprints(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """distinct (fp long) -> (node, root): components of fingerprints within radius of one another, without roots."""
    spark = distinct.sparkSession
    segments = max(SEGMENTS, -(-distinct.count() // SEGMENT))
    ranked = distinct.select("fp", gray_rank(F.col("fp")).alias("rank"))
    held = staged(ranked.repartitionByRange(segments, "rank").select(F.spark_partition_id().alias("segment"), "fp", "rank"), "segments")
    directory = sorted((r[0], r[1], r[2], r[3]) for r in held.groupBy("segment").agg(F.bit_and("fp"), F.bit_or("fp"), F.min("rank")).collect())
    if not directory:
        return spark.createDataFrame([], "node long, root long")
    routed = held.select("segment", "fp").mapInArrow(given_back(_route([d[:3] for d in directory], radius)), "segment int, fp long")
    edges = held.groupBy("segment").cogroup(routed.groupBy("segment")).applyInPandas(_links(radius), "a long, b long")
    return components(edges)


def grouped(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, tie, fp, root (names the component), component_id (its smallest doc_id)."""
    rows = staged(fingerprints(docs, shingle), "fingerprints")
    first = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    links = linked_fingerprints(first.select("fp"), radius)
    named = links.union(links.select("root", "root").distinct()).withColumnRenamed("node", "fp")
    least = named.join(first, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    of = first.join(named.join(least, "root"), "fp", "left").select("fp", "n", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id"))
    of = staged(of, "fingerprint-components")
    return join_hot_apart(rows, of, "fp", "n", rows.count()).select("doc_id", "tie", "fp", "root", "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """docs with one row of each component: the one with the smallest doc_id (nulls last), repeated rows once."""
    keys = ["__dedup_id", "__dedup_tie"]
    rows = grouped(docs, shingle, radius).select(F.coalesce("doc_id", F.lit(0)).alias(keys[0]), F.col("tie").alias(keys[1]), F.col("doc_id").isNull().alias("none"), "root")
    rows = staged(rows.groupBy(*keys, "none", "root").agg(F.count(F.lit(1)).alias("n")), "row-keys")
    best = staged(rows.groupBy("root").agg(F.min(F.struct("none", *keys)).alias("best"), F.count(F.lit(1)).alias("__rows")), "first-rows")
    first = join_hot_apart(rows, best, "root", "__rows", rows.count()).select(*keys, (F.struct("none", *keys) == F.col("best")).alias("first"), "n")
    # names of rows: those that go, and those that stay but are repeated
    odd = staged(first.groupBy(*keys).agg(F.max("first").alias("first"), F.sum("n").alias("n")).where("not first or n > 1"), "row-names")
    n, keyed = odd.count(), docs.withColumns({keys[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), keys[1]: row_key()})
    once = keyed.join(small(odd.select(*keys), n), keys, "left_anti")
    again = keyed.join(small(odd.where("first").select(*keys), n), keys, "left_semi").dropDuplicates(keys)
    return once.unionByName(again).drop(*keys)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = grouped(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash_dedup": op7_simhash_dedup}
SQL: dict[str, str] = {}
