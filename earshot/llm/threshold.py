"""Exact best inner products by the threshold algorithm over sorted per-dimension lists.

Every dimension has a list of vectors in the order of their component. A query walks all
lists at once, from the end that its own component favours; what it meets for the first
time is scored in full. The components at the walk's depth bound the score of everything
not met yet: once the k-th best score is above that bound the walk stops.

Vectors are dealt into blocks of bounded size with lists of their own, queries into blocks
too; each pair of blocks meets in one task, which passes on ``k`` rows per query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.sources import storage

SCALE = 1024
K = 10
# Vectors and queries of one block.
BLOCK, QUERY_BLOCK = 8192, 2048
# Rows of each list taken in the first step; each step takes twice as many.
FIRST_STEP = 8
# Products up to here are exact in double precision; beyond the second they do not fit a score.
_EXACT, _WHOLE = 1 << 53, 1 << 63


def _largest(numbers: np.ndarray) -> int:
    return max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)))


class SortedLists:
    """Vectors of whole numbers with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        # Row d has the vectors' numbers by ascending component d.
        self.lists = np.argsort(self.vectors.T, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(np.ascontiguousarray(self.vectors.T), self.lists, axis=1)
        self.largest = _largest(self.vectors)

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the best ``k`` but ``own``, best first, ties by id; and how deep the walk went."""
        n, used = len(self.ids), np.flatnonzero(query)
        limit = self.largest * _largest(query) * len(query)
        if limit >= _WHOLE:
            raise ValueError(f"products of components up to {self.largest} may not fit 64 bits")
        kind = np.float64 if limit < _EXACT else np.int64
        vectors, weights = self._as(kind), query.astype(kind)
        met, best_ids, best = np.zeros(n, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        down = used[query[used] > 0], used[query[used] < 0]
        depth, step = 0, FIRST_STEP
        while depth < n:
            until = min(n, depth + step)
            taken = np.concatenate((
                self.lists[down[0], n - until : n - depth].ravel(), self.lists[down[1], depth:until].ravel()
            )) if len(used) else np.arange(n, dtype=np.int32)
            fresh = np.unique(taken[~met[taken]])
            met[fresh] = True
            scored = (vectors[fresh] @ weights).astype(np.int64)
            others = self.ids[fresh] != own
            best_ids = np.concatenate((best_ids, self.ids[fresh][others]))
            best = np.concatenate((best, scored[others]))
            order = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[order], best[order]
            if not len(used):
                depth = n  # every score is 0: no list says more
                break
            bound = int((self.sorted[down[0], n - until] * query[down[0]]).sum() + (self.sorted[down[1], until - 1] * query[down[1]]).sum())
            depth, step = until, step * 2
            # An unmet vector of the same score might have a smaller id: only a larger score ends the walk.
            if len(best) == k and int(best[-1]) > bound:
                break
        return best_ids, best, depth

    def _as(self, kind) -> np.ndarray:
        if self.vectors.dtype != kind:
            self.vectors = self.vectors.astype(kind)
        return self.vectors


def whole_numbers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id`` (long), ``v`` (array<long>): floor of ``scale`` times each component.

    Rows without an id or a vector, with an empty vector, or with a component that is
    missing or not finite, are left out. Components whose products may leave 64 bits are an
    error of the search, whose scores they are too large for.
    """
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    usable = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & (F.size("e") > 0)).filter(usable)
    return kept.select("vec_id", F.transform("e", lambda x: F.floor(F.lit(float(scale)) * x).cast("long")).alias("v"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return np.array(lists.flatten(), np.int64).reshape(len(lists), -1)


def top_products(
    vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """``query_id``, ``rank`` (int, from 1), ``vec_id``, ``score`` (long) of the best ``k`` for every query row.

    ``vectors`` has ``vec_id`` (long, not null) and ``v`` (array<long>), as :func:`whole_numbers`
    gives them; ``is_query`` is a condition on ``vec_id``. A query meets the vectors of its own length under
    other ids, all of them if there are fewer than ``k``. Equal scores are ordered by id.
    Repeated rows: a repeated query is asked once, repeated vectors are candidates each;
    different vectors under one id are queries each. Runs one job, to count.
    """
    members = storage.written(vectors.select("vec_id", "v", F.size("v").alias("width")), "vectors")
    asked = members.filter(is_query).distinct()
    # Per length, as many blocks as its vectors and queries fill. There are few lengths.
    sizes = members.groupBy("width").agg(
        F.ceil(F.count("*") / block).cast("int").alias("_blocks"),
        F.ceil(F.greatest(F.count_if(is_query), F.lit(1)) / query_block).cast("int").alias("_query_blocks"),
    )
    spark = vectors.sparkSession
    sizes = storage.written(sizes, "sizes")
    cells = sizes.agg(F.sum(F.col("_blocks").cast("long") * F.col("_query_blocks"))).head()[0] or 0
    placed = F.xxhash64("vec_id", "v")
    cell = ["width", "block", "query_block"]
    left = asked.join(sizes, "width").select(
        "vec_id", "v", "width", F.pmod(placed, F.col("_query_blocks")).cast("int").alias("query_block"),
        F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("block"),
    )
    # Copies of a row go to different blocks, so a vector of any frequency is no hot block.
    spread = F.xxhash64("vec_id", "v", F.monotonically_increasing_id())
    right = members.withColumn("_spread", spread).join(sizes, "width").select(
        "vec_id", "v", "width", F.pmod("_spread", F.col("_blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("_query_blocks") - 1)).alias("query_block"),
    )
    right = right.toDF(*right.columns)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    partitions = max(1, min(4 * cells, max(tasks, cells)))
    left, right = (df.repartition(partitions, *cell) for df in (left, right))
    schema = "query_id long, query array<long>, vec_id long, score long"

    def run(asking: pa.Table, offering: pa.Table) -> pa.Table:
        out = {"query_id": [], "query": [], "vec_id": [], "score": []}
        if asking.num_rows and offering.num_rows:
            lists = SortedLists(np.array(offering["vec_id"], np.int64), _matrix(offering["v"]))
            for query_id, query in zip(asking["vec_id"].to_pylist(), _matrix(asking["v"])):
                ids, found, _ = lists.top(query, k, query_id)
                out["query_id"] += [query_id] * len(ids)
                out["query"] += [query.tolist()] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += found.tolist()
        return pa.table({
            name: pa.array(values, pa.list_(pa.int64()) if name == "query" else pa.int64()) for name, values in out.items()
        })

    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(run, schema)
    found = found.select("query_id", F.xxhash64("query").alias("_query"), "vec_id", "score")
    order = Window.partitionBy("query_id", "_query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score"
    )
