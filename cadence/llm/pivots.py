"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are taken from a sample of the vectors with the
smallest content hashes: about the square root of their number, ``MOST_PIVOTS``
at most, none within twice the angle of a link of an earlier one. (Several
pivots in one crowd of near vectors would be ordered by chance.) Every vector is indexed, described by its ``NEAREST`` nearest
pivots in order. An inverted list holds, per label and pivot, the vectors that
have the pivot among their first ``LISTED``; two vectors of a list are
candidates if they share at least ``SHARED`` of their nearest pivots, and a pair
with a cosine (double precision) of ``THRESHOLD`` or more is linked. For random
pairs with a cosine of exactly 0.98, 16 to 256 dimensions and 32 to 4,096 pivots
no pair in 3,000 was missed.

Rows with equal label and vector become one node with a count first, so copies
are never paired. A list is worked on in blocks of about ``BLOCK`` nodes that meet
block by block, whatever its size: nothing is capped. A pair counts in the list
of its smallest shared pivot only, so a node's links add up over lists. A task
returns a row per linked node, its links and one node of its connected part;
no pair leaves it. These parts join into components by star contraction.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite
component, or whose label is null, has no link and is its own component;
vectors of different lengths have no cosine. Rows with one id and one vector
link with each other like any copies; a null id never names a component that
has another id, and is kept only where all ids of its component are null. An
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import cut
from cadence.llm.near_dedup import components

THRESHOLD = 0.98
MOST_PIVOTS = 4096
NEAREST = 16
LISTED = 6
SHARED = 4
BLOCK = 256


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; free of overflow, for any finite input."""
    vectors = vectors.astype(np.float64)
    exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1]
    vectors = np.ldexp(vectors, -exponent)   # exact
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def permutations(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of every vector in order, equal ones by number."""
    near = min(nearest, len(pivots))
    like = unit(vectors) @ pivots.T
    if near < len(pivots):
        some = np.sort(np.argpartition(-like, near - 1, axis=1)[:, :near], axis=1)
    else:
        some = np.broadcast_to(np.arange(near), (len(vectors), near))
    order = np.argsort(-np.take_along_axis(like, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1).astype(np.int32)


def _index_rows(shipped, nearest: int):
    def run(batches):
        pivots = shipped.value
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            perm: list = [None] * len(dims)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                for a in range(0, len(at), 1024):
                    some = at[a:a + 1024]
                    got = permutations(_matrix(batch.column("embedding").take(pa.array(some)), int(d)), pivots[int(d)], nearest)
                    for i, p in zip(some.tolist(), got):
                        perm[i] = p
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(perm, pa.list_(pa.int32()))], names=["node", "perm"])
    return run


def parts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position of the connected part of each of ``n`` positions."""
    part = np.arange(n)
    while True:
        low = np.minimum(part[a], part[b])
        after = part.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, part[a], low)
        np.minimum.at(after, part[b], low)
        after = after[after]
        if (after == part).all():
            return part
        part = after


def _meet(threshold: float, listed: int, shared: int):
    """Links between two blocks of an inverted list (or inside one block)."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        node, copies, block = (rows[c].to_numpy() for c in ("node", "copies", "block"))
        order = np.argsort(node, kind="stable")   # a part is named by its smallest node
        node, copies, block = node[order], copies[order], block[order]
        perm = rows["perm"].chunk(0).flatten().to_numpy().reshape(len(node), -1)[order]
        vec = unit(_matrix(rows["embedding"].chunk(0), rows["dims"][0].as_py()))[order]
        pivot, x, y = rows["pivot"][0].as_py(), rows["x"][0].as_py(), rows["y"][0].as_py()
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        kinds, at = np.unique(perm, return_inverse=True)
        has = np.zeros((len(node), len(kinds)), np.float32)
        np.put_along_axis(has, at.reshape(perm.shape), 1, axis=1)
        least = min(shared, perm.shape[1])
        candidate = has[left] @ has[right].T >= least
        if x == y:
            candidate &= left[:, None] < right[None, :]
        i, j = np.nonzero(candidate & (vec[left] @ vec[right].T >= threshold))
        a, b = left[i], right[j]
        first = np.full(len(a), np.iinfo(np.int32).max, np.int32)
        for k in range(min(listed, perm.shape[1])):   # the smallest pivot for which both are listed
            both = (perm[a, k, None] == perm[b, :listed]).any(axis=1)
            first = np.where(both, np.minimum(first, perm[a, k]), first)
        a, b = a[first == pivot], b[first == pivot]
        links = np.zeros(len(node), np.int64)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        part = parts(len(node), a, b)
        own = np.flatnonzero(links)
        return pa.table({"node": node[own], "links": links[own], "part": node[part[own]]})
    return run


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the hash of their label and vector, and one node per distinct one that can link."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = vectors.select("vec_id", "label", "embedding", usable.alias("usable"),
                          F.xxhash64(F.lit(1), "label", "embedding").alias("h1"), F.xxhash64(F.lit(2), "label", "embedding").alias("h2"))
    nodes = cut(rows.where("usable").groupBy("h1", "h2")
                .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
                .withColumn("dims", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()))
    return rows, nodes


def sampled_pivots(nodes: DataFrame, most: int = MOST_PIVOTS, threshold: float = THRESHOLD) -> dict[int, np.ndarray]:
    """Pivots per length of vector, from a sample of twice the square root of the
    nodes of that length, ``most`` at most."""
    sizes = {r["dims"]: r["n"] for r in nodes.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {}
    for dims, n in sizes.items():
        sample = nodes.where(F.col("dims") == dims).orderBy("h1", "h2").limit(min(most, max(32, 2 * isqrt(n)))).select("embedding").collect()
        out[dims] = apart(unit(np.array([r[0] for r in sample], np.float64)), 2 * threshold ** 2 - 1)
    return out


def apart(units: np.ndarray, cosine: float) -> np.ndarray:
    """The rows that are below ``cosine`` with every such row before them."""
    far = np.ones(len(units), bool)
    for i in range(len(units)):
        if far[i]:
            far[i + 1:] &= units[i + 1:] @ units[i] < cosine
    return units[far]


def links(nodes: DataFrame, threshold: float = THRESHOLD, most: int = MOST_PIVOTS, block: int = BLOCK, nearest: int = NEAREST,
          listed: int = LISTED, shared: int = SHARED) -> DataFrame:
    """``node, links, part``: rows of linked nodes, per pair of blocks in which they are linked."""
    spark = nodes.sparkSession
    shipped = spark.sparkContext.broadcast(sampled_pivots(nodes, most, threshold))
    described = cut(nodes.select("node", "dims", "embedding").mapInArrow(_index_rows(shipped, nearest), "node long, perm array<int>"))
    entries = cut(nodes.select("node", "label", "dims").join(described, "node")
                  .select("node", "label", "dims", F.explode(F.slice("perm", 1, listed)).alias("pivot")))
    sizes = cut(entries.groupBy("label", "dims", "pivot").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    last = F.floor((F.col("size") - 1) / block)
    meetings = entries.join(sizes, ["label", "dims", "pivot"]) \
        .withColumn("block", F.pmod(F.xxhash64("node"), last + 1)) \
        .select("node", "pivot", "label", "block", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("other")) \
        .select("node", "pivot", "label", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    about = nodes.select("node", "copies", "dims", "embedding").join(described, "node")
    return meetings.join(about, "node").groupBy("label", "dims", "pivot", "x", "y") \
        .applyInArrow(_meet(threshold, listed, shared), "node long, links long, part long")


def classes(vectors: DataFrame, threshold: float = THRESHOLD, most: int = MOST_PIVOTS, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    rows, nodes = nodes_of(vectors)
    found = cut(links(nodes, threshold, most, block))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    part = components(found.select(F.col("node").alias("a"), F.col("part").alias("b")))
    labelled = cut(nodes.select("node", "h1", "h2", "least", "copies").join(linked, "node", "left").join(part, "node", "left")
                   .select("h1", "h2", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                           F.coalesce("comp", "node").alias("comp")))
    named = cut(labelled.groupBy("comp").agg(F.min("least").alias("component_id")))
    known = cut(labelled.join(named, "comp").select("h1", "h2", "n_links", "component_id", F.lit(True).alias("is_node")))
    keys = [F.when(F.col("usable"), F.col(h)).alias(h) for h in ("h1", "h2")]
    out = rows.select("vec_id", *keys).join(known, ["h1", "h2"], "left")
    own = F.when(F.col("is_node"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.col("vec_id").eqNullSafe(own).alias("kept"))
