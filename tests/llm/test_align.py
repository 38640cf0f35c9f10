"""Cross-tokenizer alignment against a token-by-token version."""

import bisect
import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cadence.llm import align, packing

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    """The result columns of every text, by comparing all spans of a text's tokens."""
    from tokenizers import Tokenizer
    sides, slow = align.Sides(A, B), Tokenizer.from_file(A)
    slow.encode_special_tokens = True
    per, counts = [], collections.Counter()
    for text in texts:
        coded = text and (slow.encode(" " + text, add_special_tokens=False).ids, sides.b.encode(text, out_type=int))
        if not text or b"".join(sides.b_bytes[k] for k in coded[1]) != (" " + text).encode():
            per.append(None)
            continue
        ends = []
        for ids, table in zip(coded, (sides.a_bytes, sides.b_bytes)):
            at = [0]
            for k in ids:
                at.append(at[-1] + len(table[k]))
            ends.append(at)
        links = []
        for i, a in enumerate(coded[0]):
            low, high = ends[0][i], ends[0][i + 1]
            j = bisect.bisect_right(ends[1], low) - 1
            while j < len(coded[1]) and ends[1][j] < high:
                links.append((a, coded[1][j]))
                j += 1
        both = sorted(set(ends[0][1:]) & set(ends[1][1:]))
        groups = [([], []) for _ in both]
        for side in (0, 1):
            for k, end in zip(coded[side], ends[side][1:]):
                groups[bisect.bisect_left(both, end)][side].append(str(k))
        joined = ";".join(",".join(a) + "|" + ",".join(b) for a, b in groups)
        per.append((len(coded[0]), len(coded[1]), len(both), links, hashlib.sha256(joined.encode()).hexdigest()))
        counts.update(links)
    top = collections.Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if p is None else (*p[:3], len(p[3]), sum(counts[x] == top[x[1]] for x in p[3]), sum(counts[x] for x in p[3]), p[4])
            for p in per]


def test_diagonal_cuts_are_equal_work_and_part_no_tie():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (np.append(np.unique([rng.randrange(1, 60) for _ in range(rng.randrange(30))]), 61).astype(np.int64) for _ in range(2))
        steps = rng.randrange(2, 9)
        i, j = align.diagonal_cuts(a, b, steps)
        assert (i[0], j[0], i[-1], j[-1]) == (0, 0, len(a), len(b))
        assert all(abs(n - steps) <= 1 for n in np.diff(i + j)[:-1])
        for x, y in zip(i, j):
            edge = max(a[x - 1] if x else 0, b[y - 1] if y else 0)
            assert (x == len(a) or a[x] > edge) and (y == len(b) or b[y] > edge)


@pytest.mark.parametrize("steps,frequent", [(align.STEPS, align.FREQUENT), (400, 300)])
def test_alignment_equals_brute_force(spark, steps, frequent):
    """Pieces far shorter than documents and looked-up pairs of both kinds give the same rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip([r[0] for r in rows], brute([r[1] for r in rows])))
    got = {r[0]: tuple(r)[1:] for r in align.align(docs, A, B, steps, frequent).collect()}
    assert got == want and len(want) == len(rows)


AWKWARD = [(1, None), (2, ""), (3, "   \n"), (4, "one two"), (5, "one two"), (5, "one two"), (5, "other"), (None, "no id"),
           (6, "plain <|endoftext|> and <s> strings"), (7, "▁ is no space"), (8, "漢字 🙂 é\x00\r\n"), (9, "word " * 30_000)]


def test_alignment_awkward(spark):
    """Nulls, empty and long texts, special strings, texts that one side does not give back, repeated rows and ids, clashing columns."""
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string") \
        .withColumns({c: F.lit("x") for c in ("row", "piece", "pair", "n_a", "a.b", "none")})
    docs = docs.withColumn("kind", F.create_map(F.lit("k"), F.lit(1)))
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, str(r)))
    want = order([(i, *r) for (i, _), r in zip(AWKWARD, brute([t for _, t in AWKWARD]))])
    assert want[6][1:] != (0,) * 6 + ("",)
    assert order(map(tuple, align.align(docs, A, B, 500).collect())) == want
    assert align.align(docs.where("false"), A, B).count() == 0


def test_id_links_mark_the_most_frequent_partner(spark):
    docs = spark.createDataFrame([(1, "one two one"), (2, "two")], "doc_id long, text string")
    rows = align.id_links(docs, A, B).collect()
    assert sum(r["n"] for r in rows) == sum(r[3] for r in [b[:4] for b in brute(["one two one", "two"])])
    assert {r["b"] for r in rows} == {r["b"] for r in rows if r["best"]}


def test_encoder_takes_long_white_space():
    """Ids equal those of the tokenizers file on both sides of the length at which the encoder changes."""
    from tokenizers import Tokenizer
    slow, fast = Tokenizer.from_file(A), packing.Encoder(A)
    for n in (packing.LONG_SPACE - 1, packing.LONG_SPACE, 400_000, 2_000_000):
        text = "a" + " " * n + "x\n<|endoftext|> z"
        assert np.frombuffer(fast(text), "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids
    slow.encode_special_tokens = True
    assert fast.plain(text) == slow.encode(text, add_special_tokens=False).ids
