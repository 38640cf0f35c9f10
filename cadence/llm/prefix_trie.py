"""Prefix trie of conversations, measured on its Euler tour.

A node is a distinct sequence of first turns; its key is the sum of hashes of
(position, role, text), 128 bits, a running sum over a conversation's turns.
A node is written as its smallest conversation and its depth, and numbered in
that order. The tour has an enter and an exit arc per node. One sort that puts
every node before its children gives each arc its successor: what follows in
the sort, or the exit of the node above. Arcs are then ranked as a list:

1. tasks hold a range of arcs each (neighbours in number are mostly neighbours
   in the tour) and contract every stretch that stays inside to its first arc;
2. stretches are merged by random mates, an arc taking in its successor if
   their coins say so, until at most ``BASE`` are left, which one task ranks;
3. prefix sums go back down the same levels.

Leaves and savings below a node are the difference of the prefix sums at its
two arcs. Sorts run over ranges of (key, order), not by key, so a conversation
or a node with a third of all rows is dealt over many tasks; what a task hands
to the next one is one row each. The digest of a node's ids is taken in a
stream from chunks of ids.

Defined cases: rows without a conv_id belong to no conversation; a null turn
comes first, equal turns are ordered by role and text, repeated rows count each;
null roles and texts are empty; an empty table has no nodes; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import WORD, cut
from cadence.session import scratch_path

BASE = 50_000
RANGE_ROWS = 1 << 18
CHUNK = 65_536


def _sorted(df: DataFrame, *order: str) -> DataFrame:
    """Stored in ranges of ``order``; what comes before in the order is in an earlier task or row."""
    return cut(df.repartitionByRange(*order).sortWithinPartitions(*order))


def _numpy(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def running(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
    """``rows`` with the sums of ``values`` (64 bits, wrapping) over the rows of
    their key before each one (``<value>_before``) and with it (``<value>_sum``).
    ``rows`` comes from ``_sorted`` by the key first. Two narrow passes: what a task's last key has
    summed up goes to the next tasks by the driver, one row per task."""
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        total = np.zeros(len(values), np.int64)
        for batch in batches:
            k = _numpy(batch, key)
            if not len(k):
                continue
            first = k[0] if first is None else first
            if last is None or k[-1] != last:
                total[:] = 0
            last = k[-1]
            total += np.array([_numpy(batch, v)[k == last].sum(dtype=np.int64) for v in values], np.int64)
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first], pa.int64()),
                                              pa.array([last], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))],
                                             names=["task", "first", "last", "total"])

    enter: dict[int, tuple[int, np.ndarray]] = {}
    carry = None
    for r in sorted(rows.mapInArrow(ends, "task int, first long, last long, total array<long>").collect()):
        total = np.array(r["total"], np.int64)
        if carry and carry[0] == r["first"]:
            enter[r["task"]] = carry
        carry = (r["last"], total + carry[1] if carry and carry[0] == r["last"] else total)
    shipped = rows.sparkSession.sparkContext.broadcast(enter)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = shipped.value.get(TaskContext.get().partitionId(), (None, np.zeros(len(values), np.int64)))
        for batch in batches:
            k = _numpy(batch, key)
            if not len(k):
                continue
            start = np.append(True, k[1:] != k[:-1])
            segment = np.maximum.accumulate(np.where(start, np.arange(len(k)), 0))
            cols, ends_now = [], []
            for i, v in enumerate(values):
                x = _numpy(batch, v).astype(np.int64)
                upto = np.cumsum(x)
                before = upto - x
                before = before - before[segment]
                if k[0] == last:
                    before[segment == 0] += total[i]
                cols += [before, before + x]
                ends_now.append(cols[-1][-1])
            last, total = k[-1], np.array(ends_now, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, cols)], names=[*batch.schema.names, *names])

    names = [f"{v}_{what}" for v in values for what in ("before", "sum")]
    schema = rows.select("*", *[F.lit(0).cast("long").alias(n) for n in names]).schema
    return rows.mapInArrow(sums, schema)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, n`` (turns after rebuilding) and the rebuilt turns: ``conv_id, depth, d1, d2, words, last``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), F.lit(1).cast("long").alias("one"),
        F.monotonically_increasing_id().alias("nth"))
    ordered = rows.repartitionByRange("conv_id", "turn", "role", "text", "nth").sortWithinPartitions("conv_id", "turn", "role", "text", "nth")
    ordered = cut(ordered.select("conv_id", "one", F.xxhash64(F.lit(1), "role", "text").alias("d1"), F.xxhash64(F.lit(2), "role", "text").alias("d2"),
                                 F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")))
    turns = running(ordered, "conv_id", ["one"]).withColumnRenamed("one_before", "at").drop("one", "one_sum")
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")) \
        .withColumn("h", borrowed).withColumn("base", F.col("conv_id") - F.col("conv_id") % 20)
    convs = cut(convs)
    bases = convs.where("conv_id = base").select("base", F.least("own", F.lit(3)).alias("given"))
    convs = cut(convs.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("given", F.lit(0))))
                .withColumn("n", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    heads = turns.where("at < 3 AND conv_id % 20 = 0").withColumnRenamed("conv_id", "base")
    lent = convs.join(heads, "base").where("at < m").withColumn("depth", F.col("at") + 1)
    own = turns.join(convs, "conv_id").where("at >= h").withColumn("depth", F.col("m") + F.col("at") - F.col("h") + 1)
    columns = ["conv_id", "depth", "d1", "d2", "words", (F.col("depth") == F.col("n")).alias("last")]
    return convs.select("conv_id", "n"), lent.select(*columns).unionByName(own.select(*columns))


def trie_nodes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbered nodes ``nid, depth, k1, k2, p1, p2, conv_id, n_convs, words`` (keys of the node and of its parent)
    and ``k1, k2, depth, conv_id``: the node at which each conversation ends."""
    convs, turns = rebuilt(conversations)
    tagged = _sorted(turns.withColumn("h1", F.xxhash64(F.lit(3), "depth", "d1", "d2")).withColumn("h2", F.xxhash64(F.lit(4), "depth", "d1", "d2"))
                     .drop("d1", "d2"), "conv_id", "depth")
    keyed = running(tagged, "conv_id", ["h1", "h2"])
    inner = keyed.groupBy("depth", F.col("h1_sum").alias("k1"), F.col("h2_sum").alias("k2")) \
        .agg(F.min("h1_before").alias("p1"), F.min("h2_before").alias("p2"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
             F.min("words").alias("words"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0") \
        .select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs", zero.alias("words"))
    nodes = cut(inner.unionByName(root).repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
                .withColumn("nid", F.monotonically_increasing_id()))
    ends = keyed.where("last").select(F.col("h1_sum").alias("k1"), F.col("h2_sum").alias("k2"), "depth", "conv_id") \
        .unionByName(convs.where("n = 0").select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), "conv_id"))
    return nodes, ends


ARC = "id long, next long, pos long, leaves long, saved long, parent long, parent_conv long"


def tour(nodes: DataFrame) -> DataFrame:
    """The arcs of the Euler tour with their successors and weights: 2 * nid enters, 2 * nid + 1
    leaves a node; children by conv_id. An enter arc weighs its node, an exit arc nothing."""
    saved = (F.col("n_convs") - 1) * F.col("words")
    both = nodes.select("k1", "k2", F.col("depth").alias("k3"), F.lit(0).alias("child"), "conv_id", "nid", saved.alias("saved")) \
        .unionByName(nodes.where("depth > 0").select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("k3"),
                                                     F.lit(1).alias("child"), "conv_id", "nid", F.lit(0).cast("long").alias("saved")))
    rows = _sorted(both, "k1", "k2", "k3", "child", "conv_id").select("child", "nid", "conv_id", "saved")

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, parent = None, (-1, -1)
        for batch in batches:
            child, nid, conv = (_numpy(batch, c) for c in ("child", "nid", "conv_id"))
            if len(child):
                first = (int(child[0]), int(nid[0])) if first is None else first
                at = np.flatnonzero(child == 0)
                parent = (int(nid[at[-1]]), int(conv[at[-1]])) if len(at) else parent
        if first is not None:
            yield pa.RecordBatch.from_pydict({"task": pa.array([TaskContext.get().partitionId()], pa.int32()), "child": pa.array([first[0]], pa.int32()),
                                              "nid": [first[1]], "parent": [parent[0]], "parent_conv": [parent[1]]})

    got = sorted(rows.mapInArrow(edges, "task int, child int, nid long, parent long, parent_conv long").collect())
    state, above = {}, (-1, -1)
    for r, after in zip(got, [*got[1:], None]):
        state[r["task"]] = above, (after["child"], after["nid"]) if after else (0, -1)
        above = (r["parent"], r["parent_conv"]) if r["parent"] >= 0 else above
    shipped = rows.sparkSession.sparkContext.broadcast(state)

    def arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, after = shipped.value.get(TaskContext.get().partitionId(), ((-1, -1), (0, -1)))
        held = np.zeros((4, 0), np.int64)

        def out(rows: np.ndarray, child_after: np.ndarray, nid_after: np.ndarray):
            nonlocal above
            child, nid, conv, saved = rows
            is_parent = child == 0
            at = np.maximum.accumulate(np.where(is_parent, np.arange(len(child)), -1))
            parent = np.where(at < 0, above[0], nid[at])
            parent_conv = np.where(at < 0, above[1], conv[at])
            if len(child):
                above = (int(parent[-1]), int(parent_conv[-1]))
            more = child_after == 1
            leaf = is_parent & ~more
            cols = [2 * nid + child, np.where(more, 2 * nid_after, 2 * parent + 1), np.ones(len(nid), np.int64), leaf.astype(np.int64), saved]
            mask = is_parent   # a parent's row says nothing of what stands above it
            return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(parent, mask=mask), pa.array(parent_conv, mask=mask)],
                                              names=["id", "next", "pos", "leaves", "saved", "parent", "parent_conv"])

        for batch in batches:
            rows = np.concatenate([held, [_numpy(batch, c).astype(np.int64) for c in ("child", "nid", "conv_id", "saved")]], axis=1)
            if rows.shape[1]:
                yield out(rows[:, :-1], rows[0, 1:], rows[1, 1:])
                held = rows[:, -1:]
        yield out(held, np.array([after[0]])[:held.shape[1]], np.array([after[1]])[:held.shape[1]])

    # The root is nobody's child: its exit arc ends the list.
    last = nodes.where("depth = 0").select((2 * F.col("nid") + 1).alias("id"), F.lit(-1).cast("long").alias("next"), F.lit(1).cast("long").alias("pos"),
                                           F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"),
                                           F.lit(None).cast("long").alias("parent"), F.lit(None).cast("long").alias("parent_conv"))
    return rows.mapInArrow(arcs, ARC).unionByName(last)


WEIGHTS = ["pos", "leaves", "saved"]
STRETCH = "id long, head long, pos long, leaves long, saved long, next long, all_pos long, all_leaves long, all_saved long"


def contract(ids: np.ndarray, after: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of a part of a list: for every element the first one of its stretch (as a position), the weights
    between the two, the successor of the stretch and its whole weight (right for first elements)."""
    n = len(ids)
    order = np.argsort(ids)
    at = np.minimum(np.searchsorted(ids[order], after), max(n - 1, 0))
    local = np.where(ids[order][at] == after, order[at], -1) if n else after
    has = np.flatnonzero(local >= 0)
    head, off = np.arange(n), np.zeros((n, weights.shape[1]), np.int64)
    head[local[has]] = has
    off[local[has]] = weights[has]
    while True:   # pointer doubling towards the first element
        above = head[head]
        if (above == head).all():
            break
        off += off[head]
        head = above
    tail = np.empty(n, np.int64)
    ends = np.flatnonzero(local < 0)
    tail[head[ends]] = ends
    tail = tail[head]
    return head, off, after[tail], off[tail] + weights[tail]


def _contract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [np.stack([_numpy(b, c).astype(np.int64) for c in ("id", "next", *WEIGHTS)]) for b in batches]
    rows = np.concatenate(parts, axis=1) if parts else np.zeros((5, 0), np.int64)
    head, off, after, whole = contract(rows[0], rows[1], rows[2:].T)
    first = head == np.arange(len(head))
    for a in range(0, len(head), 100_000):
        s = slice(a, a + 100_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0][s]), pa.array(rows[0][head[s]]), *(pa.array(off[s, k]) for k in range(3)),
             pa.array(after[s], mask=~first[s]), *(pa.array(whole[s, k], mask=~first[s]) for k in range(3))],
            names=["id", "head", *WEIGHTS, "next", *(f"all_{w}" for w in WEIGHTS)])


def prefix_sums(arcs: DataFrame, base: int = BASE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``id, pos, leaves, saved``: sums of the weights of all elements before each one in the list ``id, next``."""
    arcs = arcs.select("id", "next", *WEIGHTS)
    tasks = max(int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-arcs.count() // range_rows))
    stretches = cut(cut(arcs.repartitionByRange(tasks, "id")).mapInArrow(_contract_rows, STRETCH))
    heads = stretches.where("id = head").select("id", "next", *[F.col(f"all_{w}").alias(w) for w in WEIGHTS])
    ranked, few = _rank(heads, base, 0)
    before = ranked.select(F.col("id").alias("head"), *[F.col(w).alias(f"before_{w}") for w in WEIGHTS])
    if few:   # no more than ``base`` rows
        before = F.broadcast(before)
    return stretches.join(before, "head").select("id", *[(F.col(w) + F.col(f"before_{w}")).alias(w) for w in WEIGHTS])


def _table(df: DataFrame) -> DataFrame:
    """Stored as a table. A checkpoint keeps the estimated size of its plan, a product over the
    joins of all levels that gets too long to plan with; a table has the size of its files."""
    path = scratch_path(df.sparkSession, "trie-level")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rank(elements: DataFrame, base: int, level: int) -> tuple[DataFrame, bool]:
    """Prefix sums of a stored list, and whether it has no more than ``base`` elements."""
    if elements.count() <= base:
        return _table(elements.coalesce(1).mapInArrow(_contract_rows, STRETCH).select("id", *WEIGHTS)), True
    heads_up = F.xxhash64("id", F.lit(level)) % 2 == 0
    taker = elements.where(~heads_up).select(F.col("id").alias("head"), F.col("next").alias("id"), *[F.col(w).alias(f"head_{w}") for w in WEIGHTS])
    taken = _table(elements.where(heads_up).join(taker, "id"))
    grown = taken.select(F.col("head").alias("id"), F.col("next").alias("new_next"), *[F.col(w).alias(f"more_{w}") for w in WEIGHTS])
    left = elements.join(taken.select("id"), "id", "left_anti").join(grown, "id", "left") \
        .select("id", F.coalesce("new_next", "next").alias("next"), *[(F.col(w) + F.coalesce(f"more_{w}", F.lit(0))).alias(w) for w in WEIGHTS])
    ranked, _ = _rank(_table(left), base, level + 1)
    sums = ranked.select(F.col("id").alias("head"), *WEIGHTS)
    back = taken.select("id", "head", *[f"head_{w}" for w in WEIGHTS]).join(sums, "head") \
        .select("id", *[(F.col(w) + F.col(f"head_{w}")).alias(w) for w in WEIGHTS])
    return _table(ranked.unionByName(back)), False


def end_digests(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``k1, k2, depth, ends_sha256``: digest of the ids that end at each node, ascending and joined by commas."""
    keys = ["k1", "k2", "depth"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a in range(0, batch.num_rows, chunk):
                part = batch.slice(a, chunk)
                k = np.stack([_numpy(part, c) for c in keys])
                start = np.flatnonzero(np.append(True, (k[:, 1:] != k[:, :-1]).any(axis=0)))
                ids = list(map(str, part.column("conv_id").to_pylist()))
                texts = [",".join(ids[i:j]) for i, j in zip(start, [*start[1:], len(ids)])]
                yield pa.RecordBatch.from_arrays([*(pa.array(x[start]) for x in k), pa.array([task] * len(start), pa.int32()),
                                                  pa.array(np.arange(nth, nth + len(start))), pa.array(texts)], names=[*keys, "task", "nth", "ids"])
                nth += len(start)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = digest = None
        done: list[tuple] = []
        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "ids"))):
                if key == now:
                    digest.update(b"," + ids.encode())
                else:
                    if now:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*done))], names=[*keys, "ends_sha256"])
                done = []
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, digest.hexdigest())], names=[*keys, "ends_sha256"])

    text = _sorted(ends, *keys, "conv_id").mapInArrow(chunks, "k1 long, k2 long, depth long, task int, nth long, ids string")
    return text.repartition(*keys).sortWithinPartitions(*keys, "task", "nth").mapInArrow(digests, "k1 long, k2 long, depth long, ends_sha256 string")


def measure(conversations: DataFrame, base: int = BASE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` per node."""
    nodes, ends = trie_nodes(conversations)
    arcs = cut(tour(nodes))
    sums = prefix_sums(arcs, base, range_rows)
    sign = F.when(F.col("id") % 2 == 1, F.lit(1)).otherwise(F.lit(-1))
    below = sums.groupBy((F.col("id") - F.pmod(F.col("id"), F.lit(2))).alias("enter")) \
        .agg(F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens")) \
        .select(F.expr("enter DIV 2").alias("nid"), "n_leaves", "saved_tokens")
    children = arcs.where("parent IS NOT NULL").groupBy(F.col("parent").alias("nid")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = arcs.where("parent IS NOT NULL").select(F.expr("id DIV 2").alias("nid"), F.col("parent_conv").alias("parent_conv_id"))
    return nodes.join(below, "nid").join(children, "nid", "left").join(parents, "nid", "left") \
        .join(end_digests(ends), ["k1", "k2", "depth"], "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
            "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
