"""Best-fit decreasing packing of tokenised documents into sequences.

A document becomes token ids and an end id; one longer than a sequence is cut
so that only its first piece may be shorter. Best-fit decreasing looks at
nothing but lengths, and there are at most ``capacity`` of them: the counts
per length (1,024 numbers, whatever the corpus) come to the driver, where
best fit runs over runs of equal bins instead of single ones. A segment tree
over remaining capacities finds the tightest open bin that fits in log time,
and all bins of that capacity take the same pieces at once. This gives the
bins that best-fit decreasing over all pieces gives, for the whole corpus and
not shard by shard, as a short list of placements; each piece finds its own by
its rank among the pieces of its length. Ranks come from counts per (length,
task) that are added up, so no length is ordered in one task.

Defined cases: a null text is empty and has one token, the end; an empty table
gives no pieces; repeated rows are packed each; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import cut, text_slices

CAPACITY = 1024
# A run of white space beyond this exhausts the stack of the fast encoder's pattern.
LONG_SPACE = 50_000
END_ID = 2
# Fixed value: how byte-level BPE splits a text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


class SegmentTree:
    """Which remaining capacities have open bins; the least one at or above a length."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.size
        while at:
            self.count[at] += n
            at >>= 1

    def at_least(self, length: int) -> int | None:
        at = length + self.size
        if self.count[at]:
            return length
        while at > 1:   # climb to the first subtree on the right that is not empty
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def best_fit_decreasing(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Placements of all pieces, and the number of bins.

    ``histogram``: pieces per length. A placement (length, first rank, pieces,
    pieces per bin, first bin, offset) puts the pieces of that length from the
    first rank on into successive bins, each bin's pieces one after another.
    """
    tree, open_bins = SegmentTree(capacity), [[] for _ in range(capacity + 1)]
    placed, bins = [], 0

    def put(first: int, n: int, left: int) -> None:
        if n:
            open_bins[left].append((first, n))
            tree.add(left, n)

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        rank, count = 0, histogram[length]
        while count:
            left = tree.at_least(length)
            if left is None:
                left, per = capacity, capacity // length
                first, n = bins, -(-count // per)
                bins += n
            else:
                (first, n), per = open_bins[left].pop(), left // length
                tree.add(left, -n)
            # A bin stays the tightest one until no further piece of this length fits.
            full = min(n, count // per)
            if full:
                placed.append((length, rank, full * per, per, first, capacity - left))
                put(first, full, left - per * length)
                rank, count = rank + full * per, count - full * per
            rest = n - full
            if rest and count:
                placed.append((length, rank, count, count, first + full, capacity - left))
                put(first + full, 1, left - count * length)
                rest, full, count = rest - 1, full + 1, 0
            put(first + full, rest, left)
    return np.array(placed, np.int64).reshape(-1, 6), bins


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    Reads a byte-level BPE ``tokenizers`` file (ids in merge order) and encodes
    by the same vocabulary and split with ``tiktoken``, which gives the same
    ids in a third of the time. Special tokens are found inside texts. A text
    with a run of more than ``LONG_SPACE`` white-space characters is encoded by
    ``tokenizers``.
    """

    RUN = re.compile(r"\s{%d}" % LONG_SPACE)

    def __init__(self, path: str):
        import tiktoken
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        to_byte = {c: b for b, c in byte_letters().items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.path, self.special, self.all_special = path, special, set(special)
        self.bpe = tiktoken.Encoding("bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> bytes:
        if len(text) >= LONG_SPACE and self.RUN.search(text):
            return np.array(self._slow(text, False), "<u4").tobytes()
        if any(t in text for t in self.special):
            return np.array(self.bpe.encode(text, allowed_special=self.all_special), "<u4").tobytes()
        return np.array(self.bpe.encode_ordinary(text), "<u4").tobytes()

    def plain(self, text: str) -> list[int]:
        """Ids of a text in which special tokens' strings are ordinary text."""
        if len(text) >= LONG_SPACE and self.RUN.search(text):
            return self._slow(text, True)
        return self.bpe.encode_ordinary(text)

    def _slow(self, text: str, plain: bool) -> list[int]:
        from tokenizers import Tokenizer
        slow = Tokenizer.from_file(self.path)
        slow.encode_special_tokens = plain
        return slow.encode(text, add_special_tokens=False).ids

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id."""
        out = {i: t.encode() for t, i in self.special.items()}
        out.update((i, t) for t, i in self.bpe._mergeable_ranks.items())
        return [out.get(i, b"") for i in range(max(out) + 1)]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 for itself, the other bytes in order from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = n % capacity or capacity
    return [(0, min(n, first)), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, task, nth`` (and ``ids``): every
    piece of every document; ``nth`` counts a task's pieces of that length."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = Encoder(tokenizer_path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in text_slices(texts):
                owner, rows, ids = [], [], []
                for i in range(a, b):
                    data = encode(texts[i]) + end
                    for k, (s, n) in enumerate(cut_points(len(data) // 4, capacity)):
                        part = data[4 * s:4 * (s + n)]
                        owner.append(i)
                        rows.append((k, s, n, zlib.crc32(part), seen[n]))
                        seen[n] += 1
                        if with_ids:
                            ids.append(np.frombuffer(part, "<i4"))
                cols = list(zip(*rows))
                out = [batch.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(cols[0], pa.int32()),
                       *(pa.array(c, pa.int64()) for c in cols[1:4]),
                       pa.array([task] * len(rows), pa.int32()), pa.array(cols[4], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
                yield pa.RecordBatch.from_arrays(out + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []),
                                                 names=names + (["ids"] if with_ids else []))

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
                           + (", ids array<int>" if with_ids else ""))


def place(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` with ``sequence_id`` and ``offset`` in place of task and nth.
    ``cut_pieces`` must be stored (a checkpoint or a table), it is read twice."""
    spark = cut_pieces.sparkSession
    per_task = cut(cut_pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placements, _ = best_fit_decreasing(histogram, capacity)
    shipped = spark.sparkContext.broadcast(placements[np.lexsort((placements[:, 1], placements[:, 0]))])

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut_pieces.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    own = [c for c in cut_pieces.columns if c not in ("task", "nth")]
    ranked = ranked.select(*own, "rank")
    schema = ranked.select(*own, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        bounds = np.searchsorted(table[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                own_rows, t = np.nonzero(length == n)[0], table[bounds[n]:bounds[n + 1]]
                r = rank[own_rows]
                p = t[np.searchsorted(t[:, 1], r, side="right") - 1]
                j = r - p[:, 1]
                seq[own_rows] = p[:, 4] + j // p[:, 3]
                off[own_rows] = p[:, 5] + j % p[:, 3] * n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(seq), pa.array(off)],
                                             names=[*own, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and
    ``ids``) for every piece of every document."""
    return place(cut(pieces(docs, tokenizer_path, capacity, end_id, with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids``: the sequences themselves, from ``pack(..., with_ids=True)``.
    A sequence holds at most ``capacity`` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten(F.col("p.ids")).alias("ids"), F.col("p.doc_id").alias("doc_ids"))
