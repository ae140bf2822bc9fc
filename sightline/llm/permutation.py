"""Approximate nearest neighbours by a permutation index: pivots, inverted files, footrule, rerank."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import materialize


@dataclass(frozen=True)
class Permutations:
    """``pivots`` vectors are a sample drawn by a hash of their id, the same at any size of table.

    A vector is represented by its ``prefix`` nearest pivots in order. Of a block's ``block_rows``
    vectors the ``rerank`` share with the smallest footrule distance is compared exactly.
    """

    pivots: int = 512
    prefix: int = 128
    rerank: float = 0.35
    nearest: int = 5
    every: int = 50
    block_rows: int = 4096
    block_queries: int = 1024


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Per row the numbers of its ``prefix`` nearest pivots, nearest first, ties by number."""
    near = -(vectors @ pivots.T)
    return np.argsort(near, axis=1, kind="stable")[:, :prefix].astype(np.int32)


class PivotFiles:
    """Inverted files of a block: for each pivot the rows it stands near, and at which place."""

    def __init__(self, own: np.ndarray, pivots: int):
        self.rows, self.prefix = own.shape
        flat = own.ravel()
        entries = np.argsort(flat, kind="stable")
        self.row, self.place = entries // self.prefix, (entries % self.prefix).astype(np.int32)
        self.start = np.searchsorted(flat[entries], np.arange(pivots + 1))

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Distance of every row to a query's order; a pivot outside a row's prefix stands after it."""
        total = np.full(self.rows, (self.prefix - np.arange(len(query))).sum(), np.int32)
        for place, pivot in enumerate(query):
            own = slice(self.start[pivot], self.start[pivot + 1])
            total[self.row[own]] += np.abs(self.place[own] - place) - (self.prefix - place)
        return total


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    arrays = [np.asarray(c.flatten(), np.float64).reshape(-1, width) for c in column.chunks if len(c)]
    return np.concatenate(arrays) if arrays else np.empty((0, width))


def tame(x: np.ndarray) -> np.ndarray:
    """Rows whose squares leave the range of doubles, divided by their largest component: cosines stay."""
    with np.errstate(over="ignore"):
        squares = np.einsum("ij,ij->i", x, x)
    wild = ~((squares > 1e-280) & (squares < 1e280))
    if wild.any():
        x = x.copy()
        x[wild] /= np.abs(x[wild]).max(axis=1)[:, None]
    return x


def search_block(data: pa.Table, queries: pa.Table, pivots: np.ndarray, p: Permutations) -> pa.Table:
    """The nearest rows of one block for each query of one block, exactly scored."""
    width = pivots.shape[1]
    x, q = tame(_matrix(data["embedding"], width)), tame(_matrix(queries["embedding"], width))
    ids, query_ids = data["ids"].to_pylist(), queries["vec_id"].to_pylist()
    x_norm, q_norm = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", q, q))
    prefix = min(p.prefix, len(pivots))
    files = PivotFiles(orders(x / x_norm[:, None], pivots, prefix), len(pivots))
    keep = min(len(x), max(int(np.ceil(p.rerank * len(x))), p.nearest + 1))
    first = np.array([own[0] for own in ids])
    out: list[tuple] = []
    for i, order in enumerate(orders(q / q_norm[:, None], pivots, prefix)):
        distance = files.footrule(order).astype(np.int64) * len(x) + np.arange(len(x))
        chosen = np.argpartition(distance, keep - 1)[:keep]
        score = np.einsum("ij,j->i", x[chosen], q[i]) / (x_norm[chosen] * q_norm[i])
        best = np.lexsort((first[chosen], -score))[: p.nearest + 1]
        found = [(-score[b], v) for b in best for v in ids[chosen[b]] if v != query_ids[i]]
        out += [(query_ids[i], v, -s) for s, v in sorted(found)[: p.nearest]]
    columns = list(zip(*out, strict=True)) or [[], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding``: one row for each id whose vector takes part.

    Null and zero vectors, those with null or non-finite components, rows without an id and
    vectors of another length than the most frequent one take no part. An id in several rows counts
    once, with its smallest vector.
    """
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    own = own.filter(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda v: v != 0))
    own = materialize(own.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    width = own.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").first()
    return own.filter(F.size("embedding") == (width["w"] if width else 0))


def _spread(frame: DataFrame, own: Column, blocks: int, other: str, others: int) -> DataFrame:
    """The rows of a block once for each block of the other side."""
    return frame.withColumn("mine", F.pmod(F.xxhash64(own), F.lit(blocks))).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def nearest_neighbours(vectors: DataFrame, p: Permutations | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of every ``every``-th id, by cosine.

    Equal vectors are one entry of the index that keeps its ``nearest + 1`` smallest ids, which is
    all that any result can show, so a vector that a third of the rows share costs one entry. Every
    entry is posted in the inverted files of its block; each block of queries visits each block of
    entries, so a task holds one block of each. A table with fewer candidates than ``nearest``
    gives them all; an empty one gives no rows. Further columns are ignored.
    """
    p = p or Permutations()
    rows = usable(vectors)
    spark = rows.sparkSession
    order = Window.partitionBy("embedding").orderBy("vec_id")
    entries = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= p.nearest + 1)
    entries = entries.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = materialize(entries, "entries")
    queries = rows.filter(F.pmod("vec_id", F.lit(p.every)) == 0)
    n, n_queries = entries.count(), queries.count()
    result = "query_id long, vec_id long, score double"
    if not n or not n_queries:
        empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        return empty
    sample = entries.orderBy(F.xxhash64(F.get("ids", F.lit(0))), F.get("ids", F.lit(0))).limit(p.pivots).collect()
    pivots = tame(np.array([r["embedding"] for r in sample]))
    pivots /= np.linalg.norm(pivots, axis=1)[:, None]
    blocks, query_blocks = -(-n // p.block_rows), -(-n_queries // p.block_queries)
    left = _spread(entries, F.get("ids", F.lit(0)), blocks, "theirs", query_blocks)
    right = _spread(queries, F.col("vec_id"), query_blocks, "theirs", blocks)
    left = left.select(F.col("mine").alias("block"), F.col("theirs").cast("long").alias("query_block"), "ids", "embedding")
    right = right.select(F.col("theirs").cast("long").alias("block"), F.col("mine").alias("query_block"), "vec_id", "embedding")

    def search(data: pa.Table, asked: pa.Table) -> pa.Table:
        return search_block(data, asked, pivots, p)

    keys = ["block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, result)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= p.nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def exact_neighbours(vectors: DataFrame, sample_every: int, p: Permutations) -> DataFrame:
    """The same result by comparing with every entry: what recall is measured against."""
    whole = Permutations(p.pivots, p.prefix, 1.0, p.nearest, sample_every, p.block_rows, p.block_queries)
    return nearest_neighbours(vectors, whole)
