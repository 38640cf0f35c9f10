"""The prefix trie against a plain walk over all prefixes, list ranking against a walk along the list."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends, children = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[:d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = collections.Counter(), collections.Counter()
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(members[node]) - 1) * (len(WORD.findall(node[-1][1])) if node else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]) if p in children else 0, leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def result(df, **sizes):
    return sorted(map(tuple, prefix_trie.measure(df, **sizes).collect()))


def chats(n=400, seed=4):
    """Short conversations with much in common, one very long one, and one text that a third of them hold alone."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        if c % 3 == 0:
            rows.append((c, 0, "user", "hello there"))
        else:
            rows += [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["yes", "no", "go on\tplease", ""])) for t in range(rng.randrange(1, 7))]
    rows += [(101, 10 + t, "user", f"turn {t % 7}") for t in range(600)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"base": 60, "range_rows": 300}])
def test_trie_equals_brute_force(spark, sizes):
    rows = chats()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert result(df, **sizes) == brute(rows)


def test_trie_awkward(spark):
    """Nulls, ties, repeated rows, absent bases, conversations without turns after rebuilding, a long text, negative ids, clashing columns."""
    turnless = next(c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(0, None, None, None), (0, None, None, None), (0, 1, "user", "b"), (0, 1, "user", "a"), (1, 0, "user", "x"), (1, 0, "user", None), (1, 3, None, "x"),
            (None, 0, "user", "no conversation"), (turnless, 0, "user", "gone"), (7, 1, "user", "word " * 200_000), (8, 1, "assistant", "ab"), (28, 1, "assistanta", "b"),
            (-5, 0, "user", "x"), (2 ** 40, 0, "user", "x"), (3, 0, "", " "), (3, 1, "", "\x00")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumns({c: F.lit("x") for c in ("nid", "one", "depth", "h1", "a.b", "child")}).withColumn("m", F.create_map(F.lit(1), F.lit(2)))
    want = [r for r in rows if r[0] is None or r[0] >= 0]
    assert result(df.where("conv_id IS NULL OR conv_id >= 0"), base=12) == brute(want)
    assert len(result(df)) >= len(brute(want))
    assert result(df.where("false")) == [] and result(df.where("conv_id IS NULL")) == []


@pytest.mark.parametrize("base", [900, 10_000])
def test_prefix_sums_of_a_shuffled_list(spark, base):
    """No two neighbours need share a task."""
    n = 3000
    order = list(range(n))
    random.Random(1).shuffle(order)
    rows = [(a, b, 1, a % 3, a) for a, b in zip(order, [*order[1:], -1])]
    got = {r["id"]: tuple(r)[1:] for r in prefix_trie.prefix_sums(
        spark.createDataFrame(rows, "id long, next long, pos long, leaves long, saved long"), base, 100).collect()}
    leaves = saved = 0
    for at, a in enumerate(order):
        assert got[a] == (at, leaves, saved)
        leaves, saved = leaves + a % 3, saved + a


def test_contract_follows_stretches():
    head, off, after, whole = prefix_trie.contract(np.array([5, 1, 9, 2]), np.array([9, 7, 3, 5]), np.array([[1], [2], [4], [8]]))
    assert head.tolist() == [3, 1, 3, 3] and off[:, 0].tolist() == [8, 0, 9, 0]
    assert (after[3], whole[3, 0], after[1], whole[1, 0]) == (3, 13, 7, 2)


def test_digests_in_chunks(spark):
    ends = spark.createDataFrame([(1, 2, 3, i) for i in range(500)] + [(1, 2, 4, 7)], "k1 long, k2 long, depth long, conv_id long")
    got = {r["depth"]: r["ends_sha256"] for r in prefix_trie.end_digests(ends, 7).collect()}
    assert got == {3: hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest(), 4: hashlib.sha256(b"7").hexdigest()}
