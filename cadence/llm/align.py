"""Alignment of two tokenisations of every document, by merge-path partitioning.

Tokenizer A is a byte-level BPE file and reads a space and the text, B a piece
model that adds this space itself, so both cover the same bytes. A task lays
the byte ends of its documents' tokens end to end, which makes one merge of two
sorted lists however long or short the documents are. Binary searches on
diagonals of that merge cut it into pieces of ``STEPS`` ends each. A piece
holds its own tokens and the one token of either side that reaches into it, so
it is worked on without its neighbours: every distinct end gives one link, the
A and the B token that cover the byte before it; ends of both sides close a
group. Documents cut by a piece's edge leave fragments (the open group's tokens
at both edges and the closed groups between) that are stitched in order.

The pieces are stored once. A first pass counts the links of each id pair,
added up in the tasks before they are shuffled; a second one looks the counts
up. Pairs with at least a ``FREQUENT``-th of all links, at most ``FREQUENT`` of
them, are broadcast; the other ones are joined, and none of those is hot.

Defined cases: a text that is null or empty, or that either tokenizer does not
give back byte for byte, has no tokens; special tokens' strings are plain text;
repeated rows and equal or null ids are documents of their own; an empty table
gives no rows; extra columns are ignored. A text is encoded whole by one task,
and the digest of its groups is taken by one task in a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import cut, text_slices
from cadence.llm.packing import Encoder
from cadence.session import scratch_path

STEPS = 65_536
FREQUENT = 1_000_000
DISTINCT = 1_000_000
SLICE_CHARS = 1_000_000


class Sides:
    """The two tokenizers, with the bytes of every token."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.a = Encoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = self.a.token_bytes()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.lengths = tuple(np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, None unless both give a space and the text back."""
        if not text:
            return None
        given = " " + text
        data = given.encode()
        out = []
        for ids, table in ((self.a.plain(given), self.a_bytes), (self.b.encode(text, out_type=int), self.b_bytes)):
            if b"".join(map(table.__getitem__, ids)) != data:
                return None
            out.append(np.array(ids, np.int64))
        return out[0], out[1]


def diagonal_cuts(a: np.ndarray, b: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two sorted lists (a first on ties) stands after every
    ``steps`` ends, as positions in both, from (0, 0) to the ends of both.
    Equal ends are never parted, so a piece may have one end more or less."""
    total = len(a) + len(b)
    at = np.append(np.arange(0, total, steps), total)
    low, high = np.maximum(0, at - len(b)), np.minimum(at, len(a))
    while (open_ := low < high).any():   # one binary search on every diagonal at once
        mid = (low + high) // 2
        j = at - mid - 1
        take = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(j, 0, len(b) - 1)])
        low = np.where(take, mid + 1, low)
        high = np.where(open_ & ~take, mid, high)
    i, j = low, at - low
    tie = (i > 0) & (j < len(b))
    tie[tie] = a[i[tie] - 1] == b[j[tie]]
    return i, j + tie


def _small(n: int) -> type:
    return np.uint16 if n <= 1 << 16 else np.uint32


def _cut_rows(a_path: str, b_path: str, steps: int, kind: pa.DataType):
    """Stage 1: texts to stored pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, task, rows, pieces = Sides(a_path, b_path), TaskContext.get().partitionId(), 0, 0
        small = tuple(_small(len(n)) for n in sides.lengths)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for first, last in text_slices(texts, SLICE_CHARS):
                coded = [sides.encode(t) for t in texts[first:last]]
                ids = batch.column("doc_id").slice(first, last - first)
                has = np.array([c is not None for c in coded], bool)
                none = ids.filter(pa.array(~has))
                ids = ids.filter(pa.array(has))
                number = (task << 33) + rows + np.arange(len(ids))
                rows += len(ids)
                tok = [np.concatenate([c[s] for c in coded if c is not None] or [np.zeros(0, np.int64)]) for s in (0, 1)]
                end = [np.cumsum(sides.lengths[s][tok[s]]) for s in (0, 1)]
                docs = np.cumsum([int(sides.lengths[0][c[0]].sum()) for c in coded if c is not None]).astype(np.int64)
                at = diagonal_cuts(*end, steps) if len(docs) else (np.zeros(2, np.int64), np.zeros(2, np.int64))
                out = []
                for k in range(len(at[0]) - 1):
                    got = {"piece": (task << 33) + pieces, "none": none if k == 0 else none.slice(0, 0)}
                    pieces += 1
                    begin = [int(end[s][at[s][k] - 1]) if at[s][k] else 0 for s in (0, 1)]
                    base = min(begin)
                    # Everything up to ``edge`` belongs to earlier pieces.
                    edge, stop = max(begin), max(int(end[s][at[s][k + 1] - 1]) if at[s][k + 1] else 0 for s in (0, 1))
                    d0, d1 = np.searchsorted(docs, edge, side="right"), np.searchsorted(docs, stop, side="left")
                    d1 = min(int(d1) + 1, len(docs))
                    for s, name in ((0, "a"), (1, "b")):
                        got[name] = tok[s][at[s][k]:at[s][k + 1] + 1].astype(small[s]).tobytes()
                        got[f"own_{name}"], got[f"{name}_start"] = int(at[s][k + 1] - at[s][k]), begin[s] - base
                    got |= {"rows": number[d0:d1], "ids": ids.slice(d0, d1 - d0), "ends": docs[d0:d1] - base,
                            "starts": bool(d0 < len(docs) and edge == (docs[d0 - 1] if d0 else 0)),
                            "closes": bool(d1 and stop == docs[d1 - 1])}
                    out.append(got)
                if out:
                    kinds = {"piece": pa.int64(), "none": pa.list_(kind), "a": pa.binary(), "b": pa.binary(), "own_a": pa.int32(),
                             "own_b": pa.int32(), "a_start": pa.int64(), "b_start": pa.int64(), "rows": pa.list_(pa.int64()),
                             "ids": pa.list_(kind), "ends": pa.list_(pa.int64()), "starts": pa.bool_(), "closes": pa.bool_()}
                    for g in out:
                        g["none"], g["ids"] = g["none"].to_pylist(), g["ids"].to_pylist()
                    yield pa.RecordBatch.from_arrays([pa.array([g[c] for g in out], t) for c, t in kinds.items()], names=list(kinds))
    return run


PIECE = "piece long, none array<{0}>, a binary, b binary, own_a int, own_b int, a_start long, b_start long, " \
        "rows array<long>, ids array<{0}>, ends array<long>, starts boolean, closes boolean"


class Piece:
    """The tokens, ends and links of one stored piece."""

    def __init__(self, row: dict, lengths: tuple[np.ndarray, np.ndarray]):
        tok, end = [], []
        for s, name in ((0, "a"), (1, "b")):
            tok.append(np.frombuffer(row[name], _small(len(lengths[s]))).astype(np.int64))
            end.append(row[f"{name}_start"] + np.cumsum(lengths[s][tok[s]]))
        self.a, self.b = tok[0][:row["own_a"]], tok[1][:row["own_b"]]
        self.a_end, self.b_end = end[0][:row["own_a"]], end[1][:row["own_b"]]
        over = np.searchsorted(end[1], self.a_end)            # the B token over the byte before an A end
        under = np.searchsorted(end[0], self.b_end)
        self.shared = end[1][over] == self.a_end              # A ends that are B ends, too
        alone = end[0][under] != self.b_end
        base = len(lengths[1])
        self.pairs = self.a * base + tok[1][over], tok[0][under[alone]] * base + self.b[alone]
        self.pair_ends = self.a_end, self.b_end[alone]


def _count_rows(lengths):
    """Links per id pair, added up in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def joined() -> tuple[np.ndarray, np.ndarray]:
            every, n = np.concatenate(keys or [np.zeros(0, np.int64)]), np.concatenate(counts or [np.zeros(0, np.int64)])
            order = np.argsort(every, kind="stable")
            every, n = every[order], n[order]
            new = np.flatnonzero(np.append(True, every[1:] != every[:-1])[:len(every)])
            return every[new], np.add.reduceat(n, new) if len(new) else n

        for batch in batches:
            for row in batch.to_pylist():
                pairs, n = np.unique(np.concatenate(Piece(row, lengths.value).pairs), return_counts=True)
                keys.append(pairs)
                counts.append(n)
                held += len(pairs)
                if held > 2 * DISTINCT:
                    every, n = joined()
                    if len(every) > DISTINCT:
                        yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(n)], names=["pair", "n"])
                        every, n = every[:0], n[:0]
                    keys, counts, held = [every], [n], len(every)
        every, n = joined()
        yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(n)], names=["pair", "n"])
    return run


def _texts(piece: Piece, names: np.ndarray, a: slice, b: slice, groups: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2`` for whole groups; ``groups``: their ends, the last one at the slices' ends."""
    ga, gb = np.searchsorted(groups, piece.a_end[a]), np.searchsorted(groups, piece.b_end[b])
    na, nb = len(ga), len(gb)
    order = np.empty(na + nb, np.int64)
    order[np.arange(na) + np.searchsorted(gb, ga, side="left")] = \
        piece.a[a] * 3 + np.append(ga[1:] != ga[:-1], True)[:na]                    # "," or "|"
    order[np.arange(nb) + np.searchsorted(ga, gb, side="right")] = \
        piece.b[b] * 3 + 2 * np.append(gb[1:] != gb[:-1], True)[:nb]                # "," or ";"
    return "".join(names[order].tolist())[:-1]


PARTS = "row long, doc_id {}, piece long, whole boolean, n_a long, n_b long, n_groups long, n_links long, n_best long, " \
        "count_sum long, rare array<struct<pair: long, n: long>>, groups_sha256 string, head_a string, head_b string, " \
        "closed boolean, body string, tail_a string, tail_b string"


def _look_up_rows(lengths, frequent, kind: pa.DataType):
    """Per document of a piece: numbers, and the groups' digest or its fragment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair_of, count_of, best_of = frequent.value
        most = max(map(len, lengths.value))
        names = np.array([f"{i}{sep}" for i in range(most) for sep in ",|;"], object)
        rare_kind = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
        columns = {"row": pa.int64(), "doc_id": kind, "piece": pa.int64(), "whole": pa.bool_(),
                   **{c: pa.int64() for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}, "rare": rare_kind,
                   "groups_sha256": pa.string(), "head_a": pa.string(), "head_b": pa.string(), "closed": pa.bool_(),
                   "body": pa.string(), "tail_a": pa.string(), "tail_b": pa.string()}
        for batch in batches:
            for row in batch.to_pylist():
                out = [dict.fromkeys(columns) | {"doc_id": i, "whole": True, "piece": row["piece"], "groups_sha256": ""}
                       | dict.fromkeys(("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), 0) for i in row["none"]]
                if row["rows"]:
                    out += _documents(Piece(row, lengths.value), row, names, pair_of, count_of, best_of)
                yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in out], t) for c, t in columns.items()], names=list(columns))
    return run


def _documents(p: Piece, row: dict, names, pair_of, count_of, best_of) -> list[dict]:
    ends = np.array(row["ends"], np.int64)
    cut_at = lambda of: np.append(0, np.searchsorted(of, ends, side="right"))
    per = lambda x, at: np.diff(np.append(0, np.cumsum(x))[at])
    a_at, b_at = cut_at(p.a_end), cut_at(p.b_end)
    groups = p.a_end[p.shared]
    g_at = cut_at(groups)
    links = best = total = 0
    rare: list[list[tuple[int, int]]] = [[] for _ in ends]
    for pairs, at_end in zip(p.pairs, p.pair_ends):
        l_at = cut_at(at_end)
        if len(pair_of):
            k = np.minimum(np.searchsorted(pair_of, pairs), len(pair_of) - 1)
            known = pair_of[k] == pairs
            links, best = links + np.diff(l_at), best + per(best_of[k] & known, l_at)
            total = total + per(np.where(known, count_of[k], 0), l_at)
        else:
            known = np.zeros(len(pairs), bool)
            links = links + np.diff(l_at)
        unknown = np.flatnonzero(~known)
        for d, x in zip((np.searchsorted(l_at, unknown, side="right") - 1).tolist(), pairs[unknown].tolist()):
            rare[d].append((x, 1))
    out = []
    for d, (number, doc_id) in enumerate(zip(row["rows"], row["ids"])):
        starts, closes = d > 0 or row["starts"], d < len(ends) - 1 or row["closes"]
        g = groups[g_at[d]:g_at[d + 1]]
        a, b = slice(a_at[d], a_at[d + 1]), slice(b_at[d], b_at[d + 1])
        got = {"row": number, "doc_id": doc_id, "piece": row["piece"], "whole": starts and closes,
               "n_a": a.stop - a.start, "n_b": b.stop - b.start, "n_groups": len(g), "n_links": links[d],
               "n_best": best[d] if len(pair_of) else 0, "count_sum": total[d] if len(pair_of) else 0,
               "rare": [{"pair": x, "n": n} for x, n in rare[d]]}
        if starts and closes:
            got["groups_sha256"] = hashlib.sha256(_texts(p, names, a, b, g).encode()).hexdigest()
        else:
            comma = lambda ids: ",".join(map(str, ids.tolist()))
            first, last = (g[0], g[-1]) if len(g) else (None, None)
            a1, b1 = (a.stop, b.stop) if first is None else (np.searchsorted(p.a_end, first, side="right"), np.searchsorted(p.b_end, first, side="right"))
            a2, b2 = (a1, b1) if first is None else (np.searchsorted(p.a_end, last, side="right"), np.searchsorted(p.b_end, last, side="right"))
            got |= {"head_a": comma(p.a[a.start:a1]), "head_b": comma(p.b[b.start:b1]), "closed": len(g) > 0,
                    "body": _texts(p, names, slice(a1, a2), slice(b1, b2), g[1:]) if len(g) > 1 else "",
                    "tail_a": comma(p.a[a2:a.stop]), "tail_b": comma(p.b[b2:b.stop])}
        out.append(got)
    return out


def _stitch_rows(kind: pa.DataType):
    """Fragments in the order (row, piece) to one row a document."""
    sums = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict = {}

        def done(r: dict) -> pa.RecordBatch:
            cols = [pa.array([r["row"]], pa.int64()), pa.array([r["doc_id"]], kind), *(pa.array([r[c]], pa.int64()) for c in sums),
                    pa.array([r["hash"].hexdigest()], pa.string())]
            return pa.RecordBatch.from_arrays(cols, names=["row", "doc_id", *sums, "groups_sha256"])

        for batch in batches:
            for r in batch.to_pylist():
                if now and now["row"] != r["row"]:
                    yield done(now)
                    now = {}
                if not now:
                    now = {"row": r["row"], "doc_id": r["doc_id"], "hash": hashlib.sha256(), "open": ([], []), "any": False} | dict.fromkeys(sums, 0)
                for c in sums:
                    now[c] += r[c]
                for k, name in ((0, "a"), (1, "b")):
                    if r[f"head_{name}"]:
                        now["open"][k].append(r[f"head_{name}"])
                if r["closed"]:
                    for part in ("|".join(",".join(x) for x in now["open"]), r["body"]):
                        if part:
                            now["hash"].update((";" * now["any"] + part).encode())
                            now["any"] = True
                    now["open"] = tuple([r[f"tail_{name}"]] if r[f"tail_{name}"] else [] for name in "ab")
        if now:
            yield done(now)
    return run


def align(docs: DataFrame, a_path: str, b_path: str, steps: int = STEPS, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    for every row of ``docs``."""
    pieces, counts, best = counted(docs, a_path, b_path, steps)
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    counts = cut(counts.join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    held = counts.where(F.col("n") * F.lit(frequent) >= F.lit(total))   # at most ``frequent`` rows
    got = held.orderBy("pair").toPandas()
    shipped = spark.sparkContext.broadcast((got["pair"].to_numpy(np.int64), got["n"].to_numpy(np.int64), got["best"].to_numpy(bool)))

    sides = Sides(a_path, b_path)
    lengths = spark.sparkContext.broadcast(sides.lengths)
    arrow = _arrow_kind(docs)
    parts = cut(pieces.mapInArrow(_look_up_rows(lengths, shipped, arrow), PARTS.format(kind)))
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    split = parts.where("NOT whole").repartition("row").sortWithinPartitions("row", "piece") \
        .mapInArrow(_stitch_rows(arrow), f"row long, doc_id {kind}, " + ", ".join(f"{c} long" for c in sums) + ", groups_sha256 string")
    out = parts.where("whole").select("row", "doc_id", *sums, "groups_sha256").unionByName(split)
    seldom = parts.where(F.size("rare") > 0).select("row", F.explode("rare").alias("r")).select("row", "r.pair", F.col("r.n").alias("times")) \
        .groupBy("row", "pair").agg(F.sum("times").alias("times")) \
        .join(counts.where(F.col("n") * F.lit(frequent) < F.lit(total)), "pair") \
        .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("more_best"),
                            F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return out.join(seldom, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def _arrow_kind(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(docs.schema["doc_id"].dataType)


def counted(docs: DataFrame, a_path: str, b_path: str, steps: int = STEPS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored pieces, ``pair, b, n`` (links of an id pair in all documents) and
    ``b, top`` (the highest count of each B id, at most one row an id)."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    path = scratch_path(spark, "align-pieces")
    docs.select("doc_id", "text").mapInArrow(_cut_rows(a_path, b_path, steps, _arrow_kind(docs)), PIECE.format(kind)) \
        .write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)
    sides = Sides(a_path, b_path)
    lengths = spark.sparkContext.broadcast(sides.lengths)
    counts = cut(pieces.mapInArrow(_count_rows(lengths), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
                 .select("pair", (F.col("pair") % F.lit(len(sides.b_bytes))).alias("b"), "n"))
    return pieces, counts, counts.groupBy("b").agg(F.max("n").alias("top"))


def id_links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``a, b, n, best``: how often each A id overlaps each B id, and whether that is the B id's most frequent A id."""
    _, counts, best = counted(docs, a_path, b_path)
    base = F.lit(len(Sides(a_path, b_path).b_bytes))
    return counts.join(F.broadcast(best), "b").select(F.expr("pair DIV 1").alias("pair"), "b", "n", (F.col("n") == F.col("top")).alias("best")) \
        .select(F.floor(F.col("pair") / base).cast("long").alias("a"), "b", "n", "best")
