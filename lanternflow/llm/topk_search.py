"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row: its non-zero components are terms with weights.  Rows are packed
into blocks where they are read, and blocks are written to the shared folder.  A task takes
a block of queries and a run of candidate files, and streams the candidate blocks of these
files one at a time: for each query of the block, the weighted postings of its terms are
scattered into a dense score array over the candidate block's rows, the k best are selected
by partition and merged with the best so far.  So a task holds two blocks and k rows a
query, nothing but those winners is shuffled, and the grid of all query and candidate blocks
costs reads and never disk.  All query-candidate scores are computed; nothing is pruned or
sampled.

Cases: vectors that are null or hold null or non-finite components take no part, nor do
rows without vec_id; vectors of different length are compared on the terms they share;
candidates with the query's own vec_id are left out; ties go to the smaller vec_id;
repeated rows are candidates of their own; query rows that repeat a vec_id are queries of
their own, each with its own ranks from 1; empty vectors score 0; scores are whole numbers
of 64 bits, and vectors so large that a score could pass them raise OverflowError; an empty
table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lanternflow.llm._shared import opened, read_table, staged

ROWS = 4096


def quantised(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component as long; null for vectors that take no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(F.lit(scale) * v)))


def _blocks(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(ids, vectors):
            size = np.array([len(v) for v in vectors], np.int64)
            body = pickle.dumps((np.array(ids, np.int64), size, np.concatenate(vectors) if vectors else np.zeros(0, np.int64)), protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], names=["body"])

        ids, vectors = [], []
        for batch in batches:
            column = batch.column(1)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            for k, i in enumerate(batch.column(0).to_pylist()):
                ids.append(i)
                vectors.append(flat[ends[k] : ends[k + 1]].astype(np.int64))
                if len(ids) == rows:
                    yield packed(ids, vectors)
                    ids, vectors = [], []
        if ids:
            yield packed(ids, vectors)

    return run


def postings(size: np.ndarray, flat: np.ndarray) -> dict[int, tuple[np.ndarray | None, np.ndarray]]:
    """term -> (rows, or None where all rows have it; weights)."""
    row = np.repeat(np.arange(len(size)), size)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    kept = flat != 0
    row, term, weight = row[kept], term[kept], flat[kept]
    order = np.argsort(term, kind="stable")
    row, term, weight = row[order], term[order], weight[order]
    out, cut = {}, np.flatnonzero(np.diff(term)) + 1
    for r, t, w in zip(np.split(row, cut), np.split(term, cut), np.split(weight, cut)):
        if len(t):
            out[int(t[0])] = (None if len(r) == len(size) else r, w)
    return out


def _largest(flat: np.ndarray) -> float:
    """The largest magnitude, as a float: that of the smallest long has none among longs."""
    return float(np.abs(flat.astype(np.float64)).max()) if len(flat) else 0.0


class Best:
    """The k best candidates so far of each query of a block, by score and then by vec_id."""

    def __init__(self, body: bytes, k: int):
        self.ids, size, flat = pickle.loads(body)
        at = np.cumsum(size) - size
        self.k, self.vectors = k, [flat[a : a + n] for a, n in zip(at, size)]
        self.weight = max((float(np.abs(v.astype(np.float64)).sum()) for v in self.vectors), default=0.0)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in self.vectors]

    def meet(self, body: bytes) -> None:
        """All scores with the rows of a candidate block."""
        ids, size, flat = pickle.loads(body)
        if self.weight * _largest(flat) >= 2.0**63:
            raise OverflowError("components are too large for scores of 64 bits")
        lists = postings(size, flat)
        for j, (q, vector) in enumerate(zip(self.ids, self.vectors)):
            scores = np.zeros(len(ids), np.int64)
            for t in np.flatnonzero(vector):
                if (hit := lists.get(int(t))) is None:
                    continue
                rows, weight = hit
                if rows is None:
                    scores += vector[t] * weight
                else:
                    scores[rows] += vector[t] * weight
            others = np.flatnonzero(ids != q)
            s = scores[others]
            if len(s) > self.k:
                kept = np.flatnonzero(s >= np.partition(s, len(s) - self.k)[len(s) - self.k])
                others, s = others[kept], s[kept]
            s, i = np.concatenate([self.best[j][0], s]), np.concatenate([self.best[j][1], ids[others]])
            first = np.lexsort((i, -s))[: self.k]
            self.best[j] = s[first], i[first]

    def rows(self, at: list[int]) -> Iterator[pa.RecordBatch]:
        n = [len(s) for s, _ in self.best]
        if sum(n):
            row = np.repeat(np.arange(len(n)), n)
            columns = [np.full(len(row), at[0]), np.full(len(row), at[1]), row, self.ids[row], np.concatenate([i for _, i in self.best]), np.concatenate([s for s, _ in self.best])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_file", "query_block", "query_row", "query_id", "vec_id", "score"])


def _bodies(uri: str) -> Iterator[bytes]:
    """The blocks of a file, one at a time."""
    store, path = opened(uri)
    with store.open_input_file(path) as f:
        for batch in pq.ParquetFile(f).iter_batches(batch_size=1, columns=["body"]):
            yield batch.column(0)[0].as_py()


def _cells(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, query_uri, uris in zip(*(batch.column(c).to_pylist() for c in range(3))):
                for block, query_body in enumerate(_bodies(query_uri)):
                    best = Best(query_body, k)
                    for uri in uris:
                        for body in _bodies(uri):
                            best.meet(body)
                    yield from best.rows([number, block])

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, rows: int = ROWS) -> DataFrame:
    """The k best vectors of ``vectors`` for each of ``queries`` (both vec_id, embedding): query_id, rank, vec_id, score."""
    spark = vectors.sparkSession

    def blocks(df: DataFrame, name: str) -> list[str]:
        """Files of blocks, by name: the driver sees names only."""
        x = df.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("x")).where("vec_id is not null and x is not null")
        return sorted(staged(x.mapInArrow(_blocks(rows), "body binary"), name).inputFiles())

    candidate = blocks(vectors, "candidate-blocks")
    query = blocks(queries.repartition(max(1, -(-queries.count() // rows))), "query-blocks")
    # runs of candidate files, so that every core has some even where there is one block of queries
    runs = max(1, min(len(candidate), -(-4 * spark.sparkContext.defaultParallelism // max(1, len(query)))))
    units = [(j, q, candidate[i::runs]) for j, q in enumerate(query) for i in range(runs)]
    dealt = spark.sparkContext.parallelize(units, max(1, len(units)))  # one unit a task, names only
    won = spark.createDataFrame(dealt, "number long, query_uri string, uris array<string>").mapInArrow(_cells(k), "query_file long, query_block long, query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_file", "query_block", "query_row").orderBy(F.desc("score"), "vec_id"))
    return won.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 50 = 0"))


QUERIES = {"op4_exact_topk": op4_exact_topk}
SQL = {
    "op4_exact_topk": """
with v as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as x
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.row, q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id
  where q.vec_id % 50 = 0
), r as (
  select *, row_number() over (partition by row order by score desc, vec_id) as rn from s
)
select query_id, cast(rn as integer) as rank, vec_id, score from r where rn <= 5
"""
}
