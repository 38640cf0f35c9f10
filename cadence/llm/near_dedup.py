"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A document is its sequence of five-word shingles (A-Z lower-cased words; one
shingle of all words if there are fewer), each labelled with its occurrence
number. Each of ``SKETCHES`` hash functions takes the ``MINIMA`` smallest
labelled shingles and keeps them in text order; the ordered tuple is one
sketch entry, so agreement falls with edits and with reordering. Documents
that agree in two entries at most ``REACH`` apart (a bucket) and in at least
``LEAST_COMMON`` of all are candidates; of pairs with a similarity of exactly
0.8 about 1 in 2,000 is missed, of those with 0.85 less than 1 in 100,000. A
candidate pair is linked if the best alignment of the two sequences of plain
(not labelled) shingles matches L shingles with L / (n1 + n2 - L) >= THRESHOLD.
Such an alignment leaves at most n1 - L and n2 - L shingles unmatched, so it
lies in the band of that half-width on either side of the diagonal, and only
the band is computed.

Exact copies become one node first. A bucket's leader is its smallest node, and
every node is compared with one leader, the smallest of its buckets': one pair a
node at most, which joins a group that shares many buckets. Only nodes that are not
of one class yet are compared further, in full: pair by pair in a bucket of at most ``SMALL``
nodes; in larger ones blocks of about ``BLOCK`` nodes meet block by block, and two
nodes of different classes are a candidate pair if their entries agree as
above and ``SIGNATURE`` one-byte minima put their similarity within three
standard errors of the threshold or above (of pairs with exactly 0.8 about 1 in
700 falls below). Texts of at most ``SHORT`` shingles bring these along, as
32-bit hashes: their candidate pairs are aligned at once, likely ones first and only while their
classes are apart, and the links leave. Of longer texts the pairs leave, each
once, and are verified by the texts. This step's work grows with the square of a
bucket that stays of several classes, in tasks of bounded size. Links are joined into classes by alternating large-star and
small-star steps; nothing is collected on the driver.

Texts are shuffled only where they are needed: rows whose id cannot be that of a
document in a bucket (for the comparison), or of a copy (for ``keep_one``), are told
by a filter of hashed ids of at most ``FILTER_WORDS`` words and stay where they are. Joins on
the whole id and text digest decide about the others, so a full filter costs disk but no result.

Defined cases: null text is empty; texts without words are copies of each
other; a class is named by its smallest id (a null id sorts first); equal ids
with different texts are different documents; extra columns of any name and
type are ignored by ``classes`` and carried by ``keep_one``.
"""

from __future__ import annotations

import string
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import SPACES, cut, text_or_empty

WIDTH = 5
THRESHOLD = 0.8
SKETCHES = 24
MINIMA = 3
REACH = 2
LEAST_COMMON = 4
SMALL = 16
BLOCK = 4096
SIGNATURE = 512
SHORT = 1024
FILTER_WORDS = 1 << 20


def _digest(words: Column) -> Column:
    # Never null, and said so: else joins test every row's digest for null first.
    return F.coalesce(F.unhex(F.sha2(words.cast("binary"), 256)), F.lit(b""))


def words_text(text: str = "text") -> Column:
    """The words of a text with one space between them, A-Z lower-cased."""
    lower = F.translate(text_or_empty(text), string.ascii_uppercase, string.ascii_lowercase)
    return F.btrim(F.regexp_replace(lower, SPACES, " "), F.lit(" "))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_ODD = _mix(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)
_SIGNATURE_ODD = _mix(np.arange(1001, SIGNATURE + 1001, dtype=np.uint64)) | np.uint64(1)
BANDS = [(i, (i + d) % SKETCHES) for d in range(1, REACH + 1) for i in range(SKETCHES)]


def plain_shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of the shingles of a sequence of word hashes."""
    n = max(1, len(words) - width + 1) if len(words) else 0
    h = np.zeros(n, np.uint64)
    for k in range(min(width, len(words))):
        h = _mix(h + words[k:k + n] + np.uint64(k + 1))
    return h


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of the occurrence-labelled shingles of a sequence of word hashes."""
    h = plain_shingles(words, width)
    n = len(h)
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    run_start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    label = np.empty(n, np.uint64)
    label[order] = (np.arange(n) - run_start).astype(np.uint64)
    return _mix(h + label * np.uint64(0x9E3779B97F4A7C15))


def sketch(keys: np.ndarray) -> np.ndarray:
    """The ordered-minima entry of each hash function."""
    n = len(keys)
    if n <= MINIMA:
        at = np.broadcast_to(np.arange(n), (SKETCHES, n))
    else:
        at = np.empty((SKETCHES, MINIMA), np.int64)
        step = max(1, 2_000_000 // n)   # hash functions at a time, for bounded memory on long texts
        for a in range(0, SKETCHES, step):
            v = keys[None, :] * _ODD[a:a + step, None]
            v ^= v >> np.uint64(29)
            v *= np.uint64(0xBF58476D1CE4E5B9)
            at[a:a + step] = np.sort(np.argpartition(v, MINIMA - 1, axis=1)[:, :MINIMA], axis=1)
    out = np.zeros(SKETCHES, np.uint64)
    for k in range(at.shape[1]):
        out = _mix(out + keys[at[:, k]] + np.uint64(k + 1))
    return out


def signature(keys: np.ndarray) -> bytes:
    """One byte of the smallest shingle under each of ``SIGNATURE`` hash functions."""
    out = np.empty(SIGNATURE, np.uint8)
    step = max(1, 2_000_000 // len(keys))
    for a in range(0, SIGNATURE, step):
        v = keys[None, :] * _SIGNATURE_ODD[a:a + step, None]
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        out[a:a + step] = _mix(v.min(axis=1)) >> np.uint64(56)
    return out.tobytes()


def _increasing(positions: list[int]) -> int:
    """Length of the longest increasing run of positions."""
    tails: list[int] = []
    for x in positions:
        k = bisect_left(tails, x)
        tails[k:k + 1] = [x]
    return len(tails)


def _mask(places: list[int], low: int, width: int) -> int:
    """The bits of the places in the window that begins at ``low``."""
    inside = places[bisect_left(places, low):bisect_left(places, low + width)]
    if len(inside) <= 16:
        return sum(1 << (k - low) for k in inside)
    bits = np.zeros(width, np.uint8)
    bits[np.array(inside) - low] = 1
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def _aligned(x: np.ndarray, y: np.ndarray, need: int = 0) -> int:
    """Length of the longest common subsequence, if it is at least ``need`` (else
    some smaller number), by bit-parallel rows of the band that this allows: bit
    j of ``row`` is 0 where the best alignment with y[:low + j + 1] gains a match."""
    both = min(len(x), len(y))
    differ = np.flatnonzero(x[:both] != y[:both])
    head = int(differ[0]) if len(differ) else both
    x, y = x[head:], y[head:]
    both = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - both:][::-1] != y[len(y) - both:][::-1])
    tail = int(differ[0]) if len(differ) else both
    x, y = x[:len(x) - tail], y[:len(y) - tail]
    need = max(0, need - head - tail)
    if need > min(len(x), len(y)) or not len(x) or not len(y):
        return head + tail
    back, ahead = len(x) - need, len(y) - need   # unmatched on either side at most
    width = back + ahead + 1
    places: dict[int, list[int]] = {}
    for at, k in enumerate(y.tolist()):
        places.setdefault(k, []).append(at)
    full = (1 << width) - 1
    top = 1 << (width - 1)
    row, passed = full, 0
    for i, k in enumerate(x.tolist()):   # the window of row i begins at i - back
        if i:
            passed += not row & 1
            row = row >> 1 | top
        if k in places:
            hit = row & _mask(places[k], i - back, width)
            row = ((row + hit) | (row - hit)) & full
    return head + tail + passed + width - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """L / (n1 + n2 - L) for the best alignment of two sequences of shingles,
    0 if it cannot reach ``threshold``. Shingles may repeat."""
    both = len(a) + len(b)
    if not both:
        return 1.0
    kinds, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    in_a, in_b = np.bincount(x, minlength=len(kinds)), np.bincount(y, minlength=len(kinds))
    shared = np.minimum(in_a, in_b)
    most = int(shared.sum())   # no alignment matches more
    if most < threshold * (both - most) - 1e-9:
        return 0.0
    least = int(np.ceil(threshold * both / (1 + threshold) - 1e-6))   # matches that reach the threshold
    x, y = x[shared[x] > 0], y[shared[y] > 0]
    if len(x) == len(y) == np.count_nonzero(shared):   # each shared shingle once in each
        place = np.empty(len(kinds), np.int64)
        place[y] = np.arange(len(y))
        j = place[x]
        matched = len(j) if (j[1:] > j[:-1]).all() else _increasing(j.tolist())
    else:
        matched = _aligned(x, y, least)
    return matched / (both - matched) if matched >= threshold * (both - matched) - 1e-9 else 0.0


def _word_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
    ends = column.offsets.to_numpy(zero_copy_only=False)
    ends = ends - ends[0]
    return (flat[a:b] for a, b in zip(ends[:-1], ends[1:]))


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        entries = [sketch(shingles(w)).view(np.int64) if len(w) else None for w in _word_hashes(batch.column("words"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"),
                                          pa.array(entries, pa.list_(pa.int64()))], names=["doc_id", "digest", "entries"])


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = list(_word_hashes(batch.column("words")))
        keys = [shingles(w) for w in words]
        entries = [(sketch(k) >> np.uint64(32)).astype(np.uint32).tobytes() for k in keys]
        plain = [(plain_shingles(w) >> np.uint64(32)).astype(np.uint32).tobytes() if len(k) <= SHORT else None for k, w in zip(keys, words)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(entries, pa.binary()), pa.array([signature(k) for k in keys], pa.binary()),
                                          pa.array(plain, pa.binary())], names=["node", "entries", "signature", "plain"])


class _Classes:
    """Classes joined so far by a task (union by the smaller name)."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (up := self.above.get(x, x)) != x:
            self.above[x] = x = self.above.get(up, up)
        return x

    def join(self, x: int, y: int) -> None:
        x, y = sorted((self.find(x), self.find(y)))
        self.above[y] = x


def _block_pairs(threshold: float):
    """Links and candidate pairs of two blocks of a bucket (or inside one block):
    ``a, b, sure``; the links are those that join classes."""
    least = threshold - 3 * (threshold * (1 - threshold) / SIGNATURE) ** 0.5
    least = SIGNATURE * (least + (1 - least) / 256)   # unequal minima share their byte once in 256

    def run(rows: pa.Table) -> pa.Table:
        node, comp, block = (rows[c].to_numpy() for c in ("node", "comp", "block"))
        entries = np.frombuffer(b"".join(rows["entries"].to_pylist()), np.uint32).reshape(-1, SKETCHES)
        signs = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint8).reshape(-1, SIGNATURE)
        first, second, band = rows["x"][0].as_py(), rows["y"][0].as_py(), rows["key"][0].as_py() & 63
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        plain = [k and np.frombuffer(k, np.uint32) for k in rows["plain"].to_pylist()]
        classes, found = _Classes(), []
        for at in range(0, len(left), 128):
            some = left[at:at + 128]
            agree = np.zeros((len(some), len(right)), np.uint8)
            for k in range(SKETCHES):
                agree += entries[some, k, None] == entries[None, right, k]
            ok = (agree >= LEAST_COMMON) & (comp[some, None] != comp[None, right])
            if first == second:
                ok &= node[some, None] < node[None, right]
            i, j = np.nonzero(ok)
            for at_pair in range(0, len(i), 20_000):
                a, b = some[i[at_pair:at_pair + 20_000]], right[j[at_pair:at_pair + 20_000]]
                same = entries[a] == entries[b]
                before = np.zeros(len(a), bool)   # a pair counts in the first bucket that holds both
                for p, q in BANDS[:band]:
                    before |= same[:, p] & same[:, q]
                a, b = a[~before], b[~before]
                alike = (signs[a] == signs[b]).sum(axis=1)
                for k in np.argsort(-alike, kind="stable")[:np.count_nonzero(alike >= least)].tolist():
                    p, q = int(a[k]), int(b[k])
                    sure = plain[p] is not None and plain[q] is not None
                    if classes.find(comp[p].item()) == classes.find(comp[q].item()):
                        continue
                    if sure:
                        if similarity(plain[p], plain[q], threshold) < threshold:
                            continue
                        classes.join(comp[p].item(), comp[q].item())
                    found.append((*sorted((node[p].item(), node[q].item())), sure))
        a, b, sure = zip(*found) if found else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "sure": pa.array(sure, pa.bool_())})
    return run


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number: dict[str, int] = {}
            known: dict[str, np.ndarray] = {}   # a text takes part in many pairs of a batch

            def keys(text: str) -> np.ndarray:
                if text not in known:
                    words = np.array([number.setdefault(w, len(number)) for w in text.split(" ")], np.uint64)
                    known[text] = plain_shingles(_mix(words + np.uint64(1)))
                return known[text]

            ok = [similarity(keys(a), keys(b), threshold) >= threshold
                  for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             names=["a", "b"])
    return run


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: hang the larger (large-star) or all smaller (small-star)
    neighbours of every node on the smallest one."""
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = cut(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    moved = edges.join(least, "a")
    if large:
        moved = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b")))
    return cut(moved.where(F.col("a") != F.col("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``edges`` (a, b): comp is the smallest
    node reached. Alternates large-star and small-star until each node has one
    edge, to a node that has none (a star)."""
    # Edges run from the larger node to the smaller.
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where(F.col("a") != F.col("b")).distinct())
    while True:
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
            .unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up > 0 AND down > 0").isEmpty():
            break
        edges = _star(_star(edges, True), False)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def _buckets(rows: DataFrame) -> DataFrame:
    """``rows`` (key, node) of the buckets with two nodes or more, with the
    bucket's size and its leader, the smallest node.
    The aggregate is cut so that adaptive execution can split a hot bucket."""
    stats = cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("lead")).where("size > 1"))
    return cut(rows.join(stats, "key"))


def _with(node: str, other: str, rows: DataFrame) -> DataFrame:
    """The pairs (a < b) of two columns of nodes."""
    return rows.select(F.least(node, other).alias("a"), F.greatest(node, other).alias("b")).where("a < b")


def _unsettled(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """The rows (key, node, size) of the buckets whose nodes are of several classes
    so far, with each node's class."""
    rows = cut(rows.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    several = cut(rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key"))
    return cut(rows.join(several, "key"))


def _small_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of different classes in unsettled small buckets."""
    small = rows.where(F.col("size") <= SMALL).select("key", "node", "comp")
    other = small.select("key", F.col("node").alias("other"), F.col("comp").alias("other_comp"))
    return _with("node", "other", small.join(other, "key").where("node < other AND comp <> other_comp"))


def _rest(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (``sure``) and candidate pairs of different classes in unsettled
    large buckets, block by block."""
    rows = rows.where(F.col("size") > SMALL)
    words = F.transform(F.split("text", " "), lambda w: F.xxhash64(w))
    about = cut(texts.join(rows.select("node").distinct(), "node").select("node", words.alias("words"))
                .mapInArrow(_signature_rows, "node long, entries binary, signature binary, plain binary"))
    last = F.floor((F.col("size") - 1) / BLOCK)
    blocks = rows.select("key", "node", "comp", F.pmod(F.xxhash64("node"), last + 1).alias("block"),
                         F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("other")) \
        .select("key", "node", "comp", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    return blocks.join(about, "node").groupBy("key", "x", "y").applyInArrow(_block_pairs(threshold), "a long, b long, sure boolean")


def _marked(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: false only where ``key`` is no value of ``wanted`` (one
    column). The filter has a 64-bit word for each value, up to ``FILTER_WORDS``, and is broadcast."""
    words = min(FILTER_WORDS, 1 << max(0, wanted.count() - 1).bit_length())

    def placed(df: DataFrame, column: str) -> DataFrame:
        h = F.xxhash64(F.col(column))
        return df.withColumn("_word", F.pmod(h, F.lit(words))).withColumn("_at", F.shiftrightunsigned(h, 58).cast("int"))

    masks = placed(wanted, wanted.columns[0]).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _at))").alias("_mask"))
    return placed(rows, key).join(F.broadcast(masks), "_word", "left") \
        .withColumn("maybe", F.expr("coalesce(_mask & shiftleft(1L, _at), 0L) <> 0")).drop("_word", "_at", "_mask")


def _components_of_links(nodes: DataFrame, texts_of, threshold: float) -> DataFrame:
    """``node, comp`` of the linked nodes. ``texts_of(nodes)`` gives node, text."""
    entries = nodes.where("entries IS NOT NULL").select("node", "entries")
    # The last six bits of a bucket's key name its two sketch entries.
    rows = entries.select("node", F.explode(F.array(*[
        F.xxhash64(F.col("entries")[i], F.col("entries")[j]).bitwiseAND(~63).bitwiseOR(band)
        for band, (i, j) in enumerate(BANDS)])).alias("key"))
    live = _buckets(rows)
    leaders = cut(live.groupBy("node").agg(F.min("lead").alias("lead")))
    texts = cut(texts_of(leaders.select("node")))   # one shuffle of the texts, for those that can have a link
    common = F.size(F.filter(F.zip_with("ea", "eb", lambda x, y: x == y), lambda same: same))

    def agreeing(pairs: DataFrame) -> DataFrame:
        return cut(pairs.distinct()
                   .join(entries.select(F.col("node").alias("a"), F.col("entries").alias("ea")), "a")
                   .join(entries.select(F.col("node").alias("b"), F.col("entries").alias("eb")), "b")
                   .where(common >= LEAST_COMMON).select("a", "b"))

    def linked(pairs: DataFrame) -> DataFrame:
        return cut(pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
                   .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
                   .mapInArrow(_verify(threshold), "a long, b long"))

    comp = cut(components(linked(_with("node", "lead", leaders))))
    unsettled = _unsettled(live.select("key", "node", "size"), comp)
    if unsettled.isEmpty():
        return comp
    rest = cut(_rest(unsettled, texts, threshold))
    pairs = agreeing(_small_pairs(unsettled).unionByName(rest.where("NOT sure").select("a", "b")))
    return components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b"))
                      .unionByName(linked(pairs)).unionByName(rest.where("sure").select("a", "b")))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, class_size, kept, digest`` for every row of ``docs``:
    class_id is the smallest id of the document's class, and that one is kept."""
    base = docs.select("doc_id", words_text().alias("text"))
    digest = _digest(F.col("text"))
    hashed = F.when(F.col("text") == "", F.array().cast("array<long>")) \
        .otherwise(F.transform(F.split("text", " "), lambda w: F.xxhash64(w)))
    kind = base.schema["doc_id"].dataType.simpleString()
    sketched = cut(base.select("doc_id", digest.alias("digest"), hashed.alias("words"))
                   .mapInArrow(_sketch_rows, f"doc_id {kind}, digest binary, entries array<long>"))
    nodes = cut(sketched.groupBy("digest").agg(F.min(F.struct("doc_id", "entries")).alias("m"), F.count(F.lit(1)).alias("copies"))
                .select("digest", F.col("m.doc_id").alias("rep"), F.col("m.entries").alias("entries"), "copies",
                        F.monotonically_increasing_id().alias("node")))

    def texts_of(wanted: DataFrame) -> DataFrame:
        ids = cut(nodes.join(wanted, "node").select("node", "rep", F.col("digest").alias("rep_digest")))
        rows = _marked(docs.select("doc_id", "text"), "doc_id", ids.select("rep")).where("maybe") \
            .select("doc_id", words_text().alias("text")).withColumn("digest", digest)
        return rows.join(ids, (F.col("digest") == F.col("rep_digest")) & F.col("doc_id").eqNullSafe(F.col("rep"))) \
            .select("node", "text").dropDuplicates(["node"])

    comp = _components_of_links(nodes, texts_of, threshold)
    labelled = nodes.select("node", "digest", "rep", "copies").join(comp, "node", "left") \
        .withColumn("comp", F.coalesce("comp", "node"))
    labelled = cut(labelled)
    named = cut(labelled.groupBy("comp").agg(F.min(F.struct("rep", "digest")).alias("first"), F.sum("copies").alias("class_size")))
    by_digest = cut(labelled.join(named, "comp").select("digest", "first", "class_size"))
    return sketched.select("doc_id", "digest").join(by_digest, "digest").select(
        "doc_id", F.col("first.rep").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("first.rep")) & (F.col("digest") == F.col("first.digest"))).alias("kept"), "digest")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The one document of each class that stays, with all its columns."""
    found = cut(classes(docs, threshold).groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")))
    doubtful = cut(found.where("NOT kept OR n > 1").select("doc_id").distinct())
    # Own column names, so that a document's columns cannot clash with the others.
    own = [f"in_{i}" for i in range(len(docs.columns))]
    own_id, own_text = (own[docs.columns.index(c)] for c in ("doc_id", "text"))
    rows = _marked(docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)]), own_id, doubtful)
    kept = _marked(found.where("kept").select(F.col("doc_id").alias("kept_id"), "digest"), "kept_id", doubtful).where("maybe")
    # All rows of an id that is not doubtful stay. The others are shuffled once: equal
    # digests meet for the join and for the choice among repeated rows.
    rest = rows.where("maybe").withColumn("digest", _digest(words_text(own_text))).join(kept.drop("maybe"), "digest") \
        .where(F.col(own_id).eqNullSafe(F.col("kept_id"))).dropDuplicates(["digest"])
    out = rows.where("NOT maybe").select(*own).unionByName(rest.select(*own))
    return out.select(*[F.col(o).alias(c) for c, o in zip(docs.columns, own)])
