"""Exact top-k search by inner product: ball trees and branch and bound.

Vectors are quantised to integers and dealt into shards, queries into blocks,
both of bounded size. A task holds one (shard, block) pair: it builds a ball
tree over the shard and searches it for each query, best node first by the
upper bound <q, centre> + |q| radius, and stops at the first node whose bound
is below the query's current kth score. That score is shared: a first pass
over one shard gives every query a floor that the other shards start from.
The floor is the kth best score of real candidates, so nothing is lost.

Defined cases: vectors that are null, or hold null or non-finite components,
take no part; only vectors of one length are compared; a query's own id is
not its candidate (nor are other rows with that id); equal scores go to the
smaller id, repeated rows are candidates each; fewer than k candidates give
fewer rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import cut

SHARD_ROWS = 4096
BLOCK_ROWS = 4096
LEAF = 32
QUANTUM = 1024
FOUND = "query_id long, vec_id long, score long"


class BallTree:
    """Ball tree over integer vectors; nodes in arrays, rows reordered by leaf."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(ids))
        self.nodes: list[tuple[int, int, int, int]] = []   # row range, children (-1: leaf)
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self._points = vectors.astype(np.float64)
        self._build(0, len(ids), leaf)
        self.ids, self.vectors = ids[self.order], vectors[self.order]
        self.centre, self.radius = np.array(self.centres), np.array(self.radii)
        del self._points

    def _build(self, lo: int, hi: int, leaf: int) -> int:
        at = len(self.nodes)
        points = self._points[self.order[lo:hi]]
        centre = points.mean(axis=0)
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(((points - centre) ** 2).sum(axis=1).max())))
        self.nodes.append((lo, hi, -1, -1))
        spread = points.max(axis=0) - points.min(axis=0)
        if hi - lo > leaf and spread.size and spread.max() > 0:
            # Split at the median of the projection on the line between two far points.
            a = points[((points - centre) ** 2).sum(axis=1).argmax()]
            b = points[((points - a) ** 2).sum(axis=1).argmax()]
            mid = (hi - lo) // 2
            self.order[lo:hi] = self.order[lo:hi][np.argsort(points @ (b - a), kind="stable")]
            left = self._build(lo, lo + mid, leaf)
            right = self._build(lo + mid, hi, leaf)
            self.nodes[at] = (lo, hi, left, right)
        return at

    def search(self, qid: int, q: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The best (score, id) pairs for ``q``, at most k, none below ``floor``."""
        norm, qf = float(np.sqrt((q.astype(np.float64) ** 2).sum())), q.astype(np.float64)
        bounds = self.centre @ qf + norm * self.radius
        bounds += 1e-6 + 1e-9 * np.abs(bounds)   # rounding must not cut a true result
        best: list[tuple[int, int]] = []          # min-heap of (score, -id)
        frontier = [(-bounds[0], 0)]
        while frontier:
            bound, node = heapq.heappop(frontier)
            least = best[0][0] if len(best) == k else floor
            if least is not None and -bound < least:
                break
            lo, hi, left, right = self.nodes[node]
            if left >= 0:
                heapq.heappush(frontier, (-bounds[left], left))
                heapq.heappush(frontier, (-bounds[right], right))
                continue
            scores = self.vectors[lo:hi] @ q
            for j in np.nonzero(scores >= least)[0] if least is not None else range(hi - lo):
                if self.ids[lo + j] == qid:
                    continue
                item = (int(scores[j]), -int(self.ids[lo + j]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -i) for s, i in best]


def quantised(vectors: DataFrame, quantum: int = QUANTUM) -> DataFrame:
    """``vec_id, vec`` (integers) of the rows that take part."""
    x = F.col("embedding")
    usable = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                                      & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    ints = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(quantum))).cast("long"))
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("vec"))


def _search_pair(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        dims = len(left["vec"].iloc[0])
        order = np.argsort(left["vec_id"].to_numpy(), kind="stable")
        tree = BallTree(left["vec_id"].to_numpy()[order],
                        np.array(left["vec"].tolist(), np.int64).reshape(len(left), dims)[order])
        out = []
        for qid, q, floor in zip(right["query_id"], right["query"], right["floor"]):
            found = tree.search(qid, np.asarray(q, np.int64), k, None if pd.isna(floor) else int(floor))
            out += [(qid, i, s) for s, i in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of ``vectors`` for
    each row of ``queries``; both frames as ``quantised`` returns them."""
    vectors = cut(vectors)
    queries = cut(queries.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query")))
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    dealt = vectors.withColumn("dims", F.size("vec")) \
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(shards)).cast("int"))
    asked = queries.withColumn("dims", F.size("query")) \
        .withColumn("block", F.pmod(F.xxhash64(F.lit(2), "query_id"), F.lit(blocks)).cast("int"))

    def pairs(candidates: DataFrame, questions: DataFrame, which: list[int]) -> DataFrame:
        """Every shard in ``which`` against every block, one task's group each."""
        left = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = questions.withColumn("shard", F.explode(F.sequence(F.lit(which[0]), F.lit(which[1]))))
        keys = ["dims", "shard", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search_pair(k), FOUND)

    first = cut(pairs(dealt.where("shard = 0"), asked.withColumn("floor", F.lit(None).cast("long")), [0, 0]))
    if shards == 1:
        return _best(first, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    # Repeated query ids share a floor; it must hold for each of them.
    many = queries.groupBy("query_id").agg(F.count(F.lit(1)).alias("copies"))
    floors = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")) \
        .join(many, "query_id").where((F.col("n") == k) & (F.col("copies") == 1)).select("query_id", "floor")
    rest = pairs(dealt.where("shard > 0"), asked.join(floors, "query_id", "left"), [1, shards - 1])
    return _best(first.unionByName(rest), k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
