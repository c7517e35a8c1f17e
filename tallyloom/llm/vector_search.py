"""Exact top-k search by inner product over KD-trees, one tree per shard.

Rows fall into shards by a hash of their number. A shard's tree splits at the median of its widest
component and keeps tight bounding boxes. A query goes through a tree best-first: the box that allows
the highest inner product first, until no box can beat the k-th result so far. Each query starts in
its own shard; the k-th score found there goes with it to all other shards and prunes them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.durable import Scratch
from tallyloom.llm.base import table
from tallyloom.llm.registry import query

K = 10
SCALE = 1024
SHARD_ROWS = 8192
LEAF_ROWS = 256
#: Queries that meet one tree in one task.
QUERY_ROWS = 8192


class Tree:
    """A KD-tree over integer vectors; nodes are kept in arrays, children after their parent."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> None:
        self.rows, self.ids, self.vectors = rows, ids, vectors
        lo, hi, least, span, child = [], [], [], [], []
        todo = [(0, len(rows), -1)]
        order = np.arange(len(rows))
        while todo:
            a, z, parent = todo.pop()
            own = vectors[order[a:z]]
            low, high = own.min(axis=0), own.max(axis=0)
            here = len(lo)
            lo.append(low)
            hi.append(high)
            least.append(int(ids[order[a:z]].min()))
            span.append((a, z))
            child.append([])
            if parent >= 0:
                child[parent].append(here)
            width = high - low
            if z - a > leaf_rows and len(width) and width.max() > 0:
                axis, middle = int(width.argmax()), (z - a) // 2
                order[a:z] = order[a:z][np.argpartition(own[:, axis], middle)]
                todo += [(a, a + middle, here), (a + middle, z, here)]
        self.rows, self.ids, self.vectors = rows[order], ids[order], vectors[order]
        self.lo, self.hi, self.least, self.span, self.child = np.array(lo), np.array(hi), least, span, child

    def search(self, queries: np.ndarray, own: np.ndarray, bounds: list[tuple[int, int] | None], k: int) -> Iterator[list[tuple[int, int, int]]]:
        """For each query its best (-score, id, row), at most k, that beat its bound (-score, id) if it has one."""
        top = max([1, *(int(np.abs(x).max()) for x in (queries, self.vectors) if x.size)])
        # Sums below 2^53 are exact in doubles; larger ones are summed as integers, under bounds with some slack.
        exact = top * top * max(1, queries.shape[1]) < 1 << 53
        q, v = (queries.astype(float), self.vectors.astype(float)) if exact else (queries, self.vectors)
        up, down, hi, lo = np.maximum(queries, 0.0), np.minimum(queries, 0.0), self.hi.T.astype(float), self.lo.T.astype(float)
        most = up @ hi + down @ lo
        if not exact:
            most += 1e-9 * (up @ np.abs(hi) - down @ np.abs(lo)) + 1
        for i in range(len(q)):
            best: list[tuple[int, int, int]] = []
            bound = bounds[i]
            heap = [(-most[i, 0], self.least[0], 0)]
            while heap:
                score, least, node = heapq.heappop(heap)
                if bound is not None and (score, least) > bound:
                    if score > bound[0]:
                        break
                    continue  # as good as the bound, but all its ids are larger
                if self.child[node]:
                    for c in self.child[node]:
                        heapq.heappush(heap, (-most[i, c], self.least[c], c))
                    continue
                a, z = self.span[node]
                scores = -(v[a:z] @ q[i])
                near = np.arange(a, z)
                if bound is not None:
                    near, scores = near[scores <= bound[0]], scores[scores <= bound[0]]
                if len(near) > 4 * k:  # more than k may tie, so all up to the k-th score stay
                    cut = np.partition(scores, k)[k]
                    near, scores = near[scores <= cut], scores[scores <= cut]
                found = [(int(s), int(self.ids[n]), int(self.rows[n])) for s, n in zip(scores, near) if self.rows[n] != own[i]]
                best = heapq.nsmallest(k, best + [f for f in found if bound is None or f[:2] <= bound])
                if len(best) == k and (bound is None or best[-1][:2] < bound):
                    bound = best[-1][:2]
            yield best


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    cells = column.combine_chunks()
    cells = cells if isinstance(cells, pa.Array) else cells.chunk(0)
    return cells.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(cells), dim)


def _tree_of(rows: pa.Table, leaf_rows: int) -> Tree:
    rows = rows.sort_by("row")
    dim = rows.column("dim")[0].as_py()
    return Tree(rows.column("row").to_numpy(), rows.column("vec_id").to_numpy(), _matrix(rows.column("v"), dim), leaf_rows)


FOUND = "query_row long, query_id long, score long, vec_id long, row long"


def _result(query_rows, query_ids, found) -> pa.Table:
    out = [(r, q, -s, i, n) for r, q, best in zip(query_rows, query_ids, found) for s, i, n in best]
    columns = list(zip(*out)) or [()] * 5
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_row", "query_id", "score", "vec_id", "row"])


def _at_home(k: int, leaf_rows: int):
    def run(rows: pa.Table) -> pa.Table:
        tree = _tree_of(rows, leaf_rows)
        ask = rows.filter(rows.column("asks"))
        queries = _matrix(ask.column("v"), tree.vectors.shape[1]) if len(ask) else np.zeros((0, tree.vectors.shape[1]), np.int64)
        own = ask.column("row").to_numpy()
        return _result(own.tolist(), ask.column("vec_id").to_pylist(), tree.search(queries, own, [None] * len(own), k))

    return run


def _elsewhere(k: int, leaf_rows: int):
    def run(rows: pa.Table, ask: pa.Table) -> pa.Table:
        if not len(rows) or not len(ask):
            return _result([], [], [])
        tree = _tree_of(rows, leaf_rows)
        bounds = [None if s is None else (-s, i) for s, i in zip(ask.column("kth_score").to_pylist(), ask.column("kth_id").to_pylist())]
        own = ask.column("row").to_numpy()
        return _result(own.tolist(), ask.column("vec_id").to_pylist(), tree.search(_matrix(ask.column("v"), tree.vectors.shape[1]), own, bounds, k))

    return run


def top_k(vectors: DataFrame, asks, k: int = K, scale: int = SCALE, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for every row that `asks` (a condition), its k best other rows.

    vectors: vec_id, embedding. Components become floor(scale * x). Rows without vec_id, and vectors that
    are null or hold null or non-finite components, take no part; vectors meet those of their own length.
    Ties go to the smaller vec_id. A row is never its own candidate; other rows of the same vec_id are,
    and each of repeated query rows has its own ranks. Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vector-search")
    sound = F.coalesce(F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))
    x = vectors.select("vec_id", "embedding", asks.alias("asks")).filter(F.col("vec_id").isNotNull() & sound)
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    x = x.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.coalesce("asks", F.lit(False)).alias("asks"), whole.alias("v"), F.size("embedding").alias("dim"))
    x = scratch.write(x, "vectors")
    counts = x.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    shards, chunks = max(1, math.ceil(counts.n / shard_rows)), max(1, math.ceil(counts.q / query_rows))
    x = x.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    home = scratch.write(x.groupBy("shard", "dim").applyInArrow(_at_home(k, leaf_rows), FOUND), "home")
    ranked = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    kth = home.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") == k)
    kth = kth.select("query_row", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
    ask = x.filter("asks").join(kth, F.col("row") == F.col("query_row"), "left").drop("query_row")
    ask = ask.withColumn("chunk", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(chunks)).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("shard"))
    ask = ask.withColumn("shard", F.explode(others))
    ask = ask.select(*[F.col(c).alias(c) for c in ask.columns])  # columns of its own next to the trees'
    trees = x.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    keys = ["shard", "dim", "chunk"]
    away = trees.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInArrow(_elsewhere(k, leaf_rows), FOUND)
    out = home.union(away).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op6_exact_top_k", SQL)
def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)
