"""Language-model scoring with a log-frequency Bloom filter.

Tokens are words (A-Z lower-cased) and one end per text. Words are counted as
64-bit hashes over all training texts. The filter holds quantised counts of
words, of word pairs and of each word's discounted pair mass: an entry of
level j is inserted j times (entry, 1) ... (entry, j), and is read back by
probing level after level until one is absent.

Every counted word and pair is held, whatever the corpus. The texts become
slices of about ``SLICE_TOKENS`` tokens, kept in a checkpoint that is partitioned by slice.
A slice sends every shard, in one row, the keys of its distinct pairs that
belong there and how often its training texts hold them; this is the only
shuffle of pairs. The shard adds up, builds its bits (about ``SHARD_TOKENS``
training tokens a shard), probes them for the same rows and returns the
levels. Of the slices whose training texts hold a pair, it names one owner: the
pairs that a slice owns, by first word, sum up to the different pairs that the word
begins. A word stands before another token as often as it occurs, so this and its
count give its pair mass. The slices then send the words in the same way, whose
shards return the exact counts for the add-one base score too.

Pair keys have 40 bits within a shard: two of a shard's million or so pairs share one about as
often as once a shard, far below the filter's false positives. Filters of up
to ``BROADCAST_BYTES`` in all are broadcast and the slices probe them; of
larger ones the slices get the shards' answers. Both give the same levels.

    P(w)     = q(w) / Z; a word that was never counted has q = 1
    P(w | h) = max(q(h w) - D, 0) / q(h) + (1 - m(h) / q(h)) P(w)

Defined cases: a null text is empty and has one token, the end; a null id is
neither trained on nor held out; with nothing to learn from, scores are 0;
repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import SPACES, cut, id_crc, text_or_empty
from cadence.session import scratch_path

SLICE_TOKENS = 1_000_000
SHARD_TOKENS = 1 << 20
BROADCAST_BYTES = 32 << 20
BITS_PER_ENTRY = 12
PROBES = 7
LEVELS_PER_OCTAVE = 2
DISCOUNT = 0.75
WORDS, PAIRS, MASS = 1, 2, 3
LEAST = {WORDS: 1.0, PAIRS: 1.0, MASS: 1 - DISCOUNT}
MOST = OWNED = 128   # levels fit in seven bits, the eighth marks owned pairs
_SHARD_BIT = np.uint64(40)
_IN_SHARD = np.uint64((1 << 40) - 1)


def token_hashes(text: str = "text") -> Column:
    """64-bit hashes of a text's words, then of the end (the empty word)."""
    lower = F.translate(text_or_empty(text), string.ascii_uppercase, string.ascii_lowercase)
    body = F.btrim(lower, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(body == "", F.array(F.lit(""))).otherwise(F.split(F.concat(body, F.lit(" ")), SPACES))
    return F.transform(words, lambda w: F.xxhash64(w))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def entry(tag: int, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """Key of a filter entry: a word, a pair of words or a word's pair mass."""
    key = _mix(first.view(np.uint64) + np.uint64(tag * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return _mix(key + second.view(np.uint64)) if second is not None else key


def mass_entry(word_keys: np.ndarray) -> np.ndarray:
    """Key of a word's pair mass, in the shard of the word's own key."""
    return word_keys & ~_IN_SHARD | _mix(word_keys + np.uint64(MASS)) & _IN_SHARD


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys >> _SHARD_BIT) % np.uint64(shards)


class LogFrequencyBloom:
    """Quantised counts in a Bloom filter, one membership per level. ``bits``
    holds the shards one after another, ``size`` the bits of each."""

    def __init__(self, bits: np.ndarray, size: int | np.ndarray):
        self.bits, self.size = bits, np.atleast_1d(np.asarray(size, np.uint64))
        self.start = np.concatenate([[0], np.cumsum(-(-self.size.astype(np.int64) // 8) * 8)[:-1]])

    @classmethod
    def empty(cls, insertions: int) -> LogFrequencyBloom:
        size = max(64, insertions * BITS_PER_ENTRY)
        return cls(np.zeros(-(-size // 8), np.uint8), size)

    def _places(self, keys: np.ndarray, level: int):
        """For each probe, a function from key numbers to bit places."""
        h = _mix(keys + np.uint64(level * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
        step = ((h >> np.uint64(32)) | np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        if len(self.size) == 1:
            size, start = np.broadcast_to(self.size, len(keys)), np.broadcast_to(self.start, len(keys))
        else:
            shard = shard_of(keys, len(self.size)).astype(np.int64)
            size, start = self.size[shard], self.start[shard]
        for i in range(PROBES):
            yield lambda of, i=i: start[of] + ((h[of] + np.uint64(i) * step[of]) % size[of]).astype(np.int64)

    def add(self, keys: np.ndarray, levels: np.ndarray) -> None:
        for level in range(1, int(levels.max(initial=0)) + 1):
            for place in self._places(keys[levels >= level], level):
                at = place(slice(None))
                np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        """Numbers of the keys that have ``level``."""
        alive = np.arange(len(keys))
        for place in self._places(keys, level):
            at = place(alive)
            alive = alive[(self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            if not len(alive):
                break
        return alive

    def levels(self, keys: np.ndarray, most: int) -> np.ndarray:
        """Level of each key: 0 if absent."""
        out = np.zeros(len(keys), np.int16)
        alive = np.arange(len(keys))
        for level in range(1, most + 1):
            alive = alive[self.has(keys[alive], level)]
            if not len(alive):
                break
            out[alive] = level
        return out


def quantise(counts: np.ndarray, least: float) -> np.ndarray:
    """Level of each count: 1 for ``least`` and ``LEVELS_PER_OCTAVE`` more per doubling."""
    if not len(counts):
        return np.zeros(0, np.int16)
    return (1 + np.floor(LEVELS_PER_OCTAVE * np.log2(np.maximum(counts / least, 1)) + 1e-9)).astype(np.int16)


def _level_values(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Mean count of each level (index 0: absent, 0) from its entries and their sum."""
    value = total / np.maximum(n, 1)
    for j in range(1, len(n)):   # levels that hold nothing can only be reached by a false positive
        if not n[j]:
            value[j] = value[j - 1]
    return value


def _slices(batch: pa.RecordBatch, most: int = SLICE_TOKENS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """A batch in runs of rows of about ``most`` tokens: the rows, all their
    tokens and each row's token count. Bounds the working arrays."""
    ends = batch.column("tokens").offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
        part = batch.slice(start, stop - start)
        tokens = part.column("tokens").flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        yield part, tokens, np.diff(ends[start:stop + 1])
        start = stop


def _previous(tokens: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """The token before each token; the end marker before a text's first."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[lengths > 0] if len(lengths) else np.zeros(0, np.int64)
    before[starts.astype(np.int64)] = end
    return before


def _numbered(tokens: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens and the end, the frequent ones first, and each
    token's number (the end's is last)."""
    kinds, at, n = np.unique(np.append(tokens, end), return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return kinds[order], rank[at]


class Probes:
    """The words and pairs of some texts, each once."""

    def __init__(self, kinds: np.ndarray, at: np.ndarray, lengths: np.ndarray):
        self.kinds, self.cur = kinds, at[:-1]
        self.prev = _previous(self.cur, lengths, at[-1])
        pair, self.pair = np.unique(self.prev << 32 | self.cur, return_inverse=True)
        self.first, self.second = pair >> 32, pair & (1 << 32) - 1

    def pair_keys(self, shards: int) -> np.ndarray:
        """Each pair's shard and 40 bits within it."""
        keys = entry(PAIRS, self.kinds[self.first], self.kinds[self.second])
        return shard_of(keys, shards) << _SHARD_BIT | keys & _IN_SHARD

    def log_probs(self, levels: dict, values: dict, total: int) -> np.ndarray:
        """log10 P(token | token before it in its text), given the levels of each kind of entry."""
        q, mass, q2 = (values[tag][np.minimum(levels[tag], len(values[tag]) - 1)] for tag in (WORDS, MASS, PAIRS))
        mass = np.where(q > 0, mass, 0.0)
        p1 = np.where(q > 0, q, 1.0) / (total + 1)
        left = 1 - np.minimum(mass / np.maximum(q, 1e-300), 0.98)
        # A pair counts only if its words are held too.
        q2 = np.where((mass[self.first] > 0) & (q[self.second] > 0), q2, 0.0)
        p = left[self.first] * p1[self.second]
        p += np.maximum(q2 - DISCOUNT, 0) / np.maximum(q[self.first], q2 + 1e-300) * (q2 > 0)
        return np.log10(np.minimum(p, 1.0))[self.pair]


def _packed(x: np.ndarray, kind: type = np.uint32) -> bytes:
    """Mostly small integers, compressed by bytes of one rank."""
    planes = x.astype(kind).view(np.uint8).reshape(len(x), -1).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind: type = np.uint32) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, width * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel().astype(np.int64)


def _short(keys: np.ndarray) -> bytes:
    """The 40 bits of each key within its shard."""
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (keys >> np.uint64(32)).astype(np.uint8).tobytes()


def _long(data: bytes, shard: int) -> np.ndarray:
    n = len(data) // 5
    high = np.frombuffer(data, np.uint8, n, 4 * n).astype(np.uint64) | np.uint64(shard << 8)
    return high << np.uint64(32) | np.frombuffer(data, np.uint32, n)


def _stored_slices(docs: DataFrame, usable: Column, held_out: Column) -> DataFrame:
    """The texts in slices, stored and partitioned by slice: ``slice`` (the number of its first
    row), the rows' ids and flags, token counts, distinct tokens, and the tokens by number."""
    spark = docs.sparkSession
    end = spark.range(1).select(F.xxhash64(F.lit(""))).first()[0]
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.coalesce(usable, F.lit(False)).alias("train"), token_hashes().alias("tokens"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tokens, lengths in (x for whole in batches for x in _slices(whole)):
            kinds, at = _numbered(tokens, end)
            train = part.column("train").to_numpy(zero_copy_only=False).astype(bool)
            whole = pa.array([0, part.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("rid").slice(0, 1), pa.ListArray.from_arrays(whole, part.column("doc_id")),
                 pa.ListArray.from_arrays(whole, part.column("held_out")), pa.ListArray.from_arrays(whole, part.column("train")),
                 pa.ListArray.from_arrays(whole, pa.array(lengths.astype(np.int64))), pa.array([int(lengths[train].sum())], pa.int64()),
                 pa.array([kinds.tobytes()], pa.binary()), pa.array([_packed(at)], pa.binary())],
                names=["slice", "doc_id", "held_out", "train", "lengths", "n_train", "kinds", "at"])

    slices = rows.mapInArrow(run, f"slice long, doc_id array<{kind}>, held_out array<boolean>, train array<boolean>, "
                                  "lengths array<long>, n_train long, kinds binary, at binary")
    return cut(slices.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "slice"))


def _open(row: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens, numbers, lengths of a stored slice, and for each token if it is trained on."""
    lengths, train = (np.array(row[c][i].as_py()) for c in ("lengths", "train"))
    kinds = np.frombuffer(row["kinds"][i].as_py(), np.int64)
    return kinds, _unpacked(row["at"][i].as_py(), int(lengths.sum()) + 1), lengths, np.repeat(train.astype(bool), lengths)


# What a slice sends a shard: keys, their training counts, and for words the owned pairs that they begin.
_SENT = "slice long, shard int, keys binary, n binary, begun binary"
# What a shard returns: levels to slices (and exact counts of words), and its own row.
_RETURNED = ("slice long, shard int, levels binary, mass binary, n binary, size long, bits binary, "
             "held array<long>, total array<double>")


def _by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of keys by shard, the shards that have any, and where each shard starts."""
    shard = shard_of(keys, shards).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    start = np.searchsorted(shard[order], np.arange(shards + 1))
    return order, np.flatnonzero(np.diff(start)), start


def _put_back(column: pa.ChunkedArray, keys: np.ndarray, shards: int) -> np.ndarray:
    """The shards' answers, in order of the shards, in the order of the keys."""
    out = np.empty(len(keys), np.uint8)
    out[_by_shard(keys, shards)[0]] = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return out


def _send_pairs(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                kinds, at, lengths, trained = _open(batch, i)
                p = Probes(kinds, at, lengths)
                keys, n = p.pair_keys(shards), np.bincount(p.pair[trained], minlength=len(p.first))
                order, some, start = _by_shard(keys, shards)
                parts = [order[start[k]:start[k + 1]] for k in some]
                yield pa.record_batch({
                    "slice": pa.array(np.full(len(some), batch["slice"][i].as_py(), np.int64)), "shard": pa.array(some.astype(np.int32)),
                    "keys": pa.array([_short(keys[here]) for here in parts], pa.binary()),
                    "n": pa.array([_packed(n[here]) for here in parts], pa.binary()), "begun": pa.nulls(len(some), pa.binary())})
    return run


def _send_words(shards: int):
    def run(one: pa.Table, answered: pa.Table) -> pa.Table:
        kinds, at, lengths, trained = _open(one, 0)
        p = Probes(kinds, at, lengths)
        owned = _put_back(answered.sort_by("shard")["levels"], p.pair_keys(shards), shards) >= OWNED
        n, begun = np.bincount(p.cur[trained], minlength=len(kinds)), np.bincount(p.first[owned], minlength=len(kinds))
        order, some, start = _by_shard(entry(WORDS, kinds), shards)
        parts = [order[start[k]:start[k + 1]] for k in some]
        return pa.table({
            "slice": pa.array(np.full(len(some), one["slice"][0].as_py(), np.int64)), "shard": pa.array(some.astype(np.int32)),
            "keys": pa.array([kinds[here].tobytes() for here in parts], pa.binary()),
            "n": pa.array([_packed(n[here]) for here in parts], pa.binary()),
            "begun": pa.array([_packed(begun[here]) for here in parts], pa.binary())})
    return run


def _own_row(shard: int, bloom: LogFrequencyBloom, most_bytes: float, *entries: tuple[int, np.ndarray, np.ndarray]) -> dict:
    """A shard's entries and their sum by (tag, level), and its bits if the filter may be small enough to broadcast."""
    cell = np.concatenate([tag * MOST + levels.astype(np.int64) for tag, levels, _ in entries])
    x = np.concatenate([x for _, _, x in entries])
    return {"shard": shard, "size": int(bloom.size[0]), "bits": bloom.bits.tobytes() if len(bloom.bits) <= most_bytes else None,
            "held": np.bincount(cell, minlength=4 * MOST).tolist(), "total": np.bincount(cell, x, 4 * MOST).tolist()}


def _returned(rows: list[dict]) -> pa.Table:
    kinds = {"slice": pa.int64(), "shard": pa.int32(), "levels": pa.binary(), "mass": pa.binary(), "n": pa.binary(),
             "size": pa.int64(), "bits": pa.binary(), "held": pa.list_(pa.int64()), "total": pa.list_(pa.float64())}
    return pa.table({c: pa.array([r.get(c) for r in rows], t) for c, t in kinds.items()})


def _counted(sent: pa.Table, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[slice]]:
    """Of all rows' keys: the distinct ones, the place of each key among them, their counts,
    the count of each key in its row, and where each row is."""
    ends = np.cumsum([len(k) for k in keys]).tolist()
    here = np.concatenate([_unpacked(n, len(k)) for n, k in zip(sent["n"].to_pylist(), keys)])
    kept, of = np.unique(np.concatenate(keys), return_inverse=True)
    return kept, of, np.bincount(of, here, len(kept)), here, [slice(a, b) for a, b in zip([0, *ends], ends)]


def _pair_shard(most_bytes: float):
    def run(sent: pa.Table) -> pa.Table:
        shard = sent["shard"][0].as_py()
        kept, of, n, here, rows = _counted(sent, [_long(k, shard) for k in sent["keys"].to_pylist()])
        held = n > 0
        levels = quantise(n[held], LEAST[PAIRS])
        bloom = LogFrequencyBloom.empty(int(levels.sum(dtype=np.int64)))
        bloom.add(kept[held], levels)
        found = bloom.levels(kept, int(levels.max(initial=0))).astype(np.uint8)[of]
        trained = np.flatnonzero(here)
        found[trained[np.unique(of[trained], return_index=True)[1]]] |= np.uint8(OWNED)
        return _returned([_own_row(shard, bloom, most_bytes, (PAIRS, levels, n[held])),
                          *({"slice": at, "shard": shard, "levels": found[row].tobytes()} for at, row in zip(sent["slice"].to_pylist(), rows))])
    return run


def _word_shard(most_bytes: float):
    def run(sent: pa.Table) -> pa.Table:
        shard = sent["shard"][0].as_py()
        kept, of, n, here, rows = _counted(sent, [np.frombuffer(k, np.int64) for k in sent["keys"].to_pylist()])
        begun = np.concatenate([_unpacked(b, r.stop - r.start) for b, r in zip(sent["begun"].to_pylist(), rows)])
        held = n > 0
        keys, mass = entry(WORDS, kept), n - DISCOUNT * np.bincount(of, begun, len(kept))
        levels, mass_levels = quantise(n[held], LEAST[WORDS]), quantise(mass[held], LEAST[MASS])
        bloom = LogFrequencyBloom.empty(int(levels.sum(dtype=np.int64) + mass_levels.sum(dtype=np.int64)))
        bloom.add(keys[held], levels)
        bloom.add(mass_entry(keys[held]), mass_levels)
        most = int(max(levels.max(initial=0), mass_levels.max(initial=0)))
        found, found_mass = (bloom.levels(k, most).astype(np.uint8)[of] for k in (keys, mass_entry(keys)))
        return _returned([_own_row(shard, bloom, most_bytes, (WORDS, levels, n[held]), (MASS, mass_levels, mass[held])),
                          *({"slice": at, "shard": shard, "levels": found[row].tobytes(), "mass": found_mass[row].tobytes(),
                             "n": _packed(n[of[row]], np.int64)} for at, row in zip(sent["slice"].to_pylist(), rows))])
    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Model:
    """What every task gets: the level values, totals, and the filters of words
    and of pairs (None if they stay in their shards)."""

    def __init__(self, values: dict, total: int, kinds: int, blooms: list | None):
        self.values, self.total, self.kinds, self.blooms = values, total, kinds, blooms

    def filters(self) -> list[LogFrequencyBloom] | None:
        return self.blooms and [LogFrequencyBloom(*parts) for parts in self.blooms]

    def most(self) -> int:
        return max(len(v) for v in self.values.values()) - 1


def train(slices: DataFrame) -> tuple[Model, DataFrame, DataFrame, int]:
    """The model, the shards' answers on words and on pairs, and the number of shards."""
    total = slices.agg(F.coalesce(F.sum("n_train"), F.lit(0))).first()[0]
    shards = -(-total // SHARD_TOKENS) or 1   # there are at most as many pairs as tokens
    most_bytes = 2 * BROADCAST_BYTES / shards
    pairs = _stored(slices.mapInArrow(_send_pairs(shards), _SENT).groupBy("shard").applyInArrow(_pair_shard(most_bytes), _RETURNED),
                    "lm-pairs")
    answers = pairs.where("slice IS NOT NULL").select("slice", "shard", "levels")
    words = _stored(slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_send_words(shards), _SENT)
                    .groupBy("shard").applyInArrow(_word_shard(most_bytes), _RETURNED), "lm-words")

    own = [df.where("slice IS NULL") for df in (words, pairs)]
    n, sums, values = np.zeros(4 * MOST), np.zeros(4 * MOST), {}
    # 1,024 sums, whatever the corpus.
    for cell in own[0].unionByName(own[1]).select(F.posexplode(F.arrays_zip("held", "total")).alias("at", "c")).groupBy("at") \
            .agg(F.sum("c.held").alias("n"), F.sum("c.total").alias("s")).where("n > 0").collect():
        n[cell["at"]], sums[cell["at"]] = cell["n"], cell["s"]
    for tag in LEAST:
        in_tag = n[tag * MOST:(tag + 1) * MOST]
        most = int(np.flatnonzero(in_tag).max(initial=0)) + 1
        values[tag] = _level_values(in_tag[:most], sums[tag * MOST:tag * MOST + most])
    blooms = None
    size = own[0].unionByName(own[1]).agg(F.sum(F.col("size") / 8).alias("bytes"), F.count_if(F.col("bits").isNull()).alias("missing")).first()
    if (size["bytes"] or 0) <= BROADCAST_BYTES and not size["missing"]:
        blooms = []
        for df in own:
            parts = {r["shard"]: r for r in df.select("shard", "size", "bits").collect()}
            blooms.append((np.frombuffer(b"".join(bytes(parts[k]["bits"]) if k in parts else bytes(8) for k in range(shards)), np.uint8),
                           np.array([parts[k]["size"] if k in parts else 64 for k in range(shards)], np.uint64)))
    model = Model(values, total, int(n[WORDS * MOST:(WORDS + 1) * MOST].sum()), blooms)
    return model, words.where("slice IS NOT NULL").select("slice", "shard", "levels", "mass", "n"), answers, shards


def score(docs: DataFrame, usable: Column, held_out: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    slices = _stored_slices(docs, usable, held_out)
    model, words, pairs, shards = train(slices)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    answers = words
    if model.blooms is None:   # a pair's answer has no mass
        answers = answers.unionByName(pairs, allowMissingColumns=True)

    def finish(one: pa.Table, answered: pa.Table) -> pa.Table:
        m = shipped.value
        kinds, at, lengths, _ = _open(one, 0)
        p, answered = Probes(kinds, at, lengths), answered.sort_by("shard")
        word_keys, pair_keys = entry(WORDS, kinds), p.pair_keys(shards)
        from_pairs = pa.compute.is_null(answered["mass"])
        from_words, from_pairs = answered.filter(pa.compute.invert(from_pairs)), answered.filter(from_pairs)
        order, some, start = _by_shard(word_keys, shards)
        counts = np.empty(len(kinds), np.int64)
        counts[order] = np.concatenate([_unpacked(n, start[k + 1] - start[k], np.int64) for n, k in zip(from_words["n"].to_pylist(), some)])
        if m.blooms:
            of_words, of_pairs = m.filters()
            levels = {WORDS: of_words.levels(word_keys, m.most()), MASS: of_words.levels(mass_entry(word_keys), m.most()),
                      PAIRS: of_pairs.levels(pair_keys, m.most())}
        else:
            levels = {WORDS: _put_back(from_words["levels"], word_keys, shards), MASS: _put_back(from_words["mass"], word_keys, shards),
                      PAIRS: _put_back(from_pairs["levels"], pair_keys, shards) & np.uint8(OWNED - 1)}
        owner = np.repeat(np.arange(len(lengths)), lengths)
        count = counts[p.cur]

        def per_text(x: np.ndarray) -> np.ndarray:
            return np.bincount(owner, x, len(lengths))

        return pa.table({
            "doc_id": one["doc_id"].combine_chunks().flatten(), "held_out": one["held_out"].combine_chunks().flatten(),
            "n_tokens": pa.array(lengths.astype(np.int64)), "n_known": pa.array(per_text(count > 0).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(lengths), m.total, np.int64)),
            "base_score": pa.array(per_text(np.log10(count + 1.0)) - lengths * np.log10(m.total + m.kinds + 1)),
            "score": pa.array(per_text(p.log_probs(levels, m.values, m.total)))})

    return slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame) -> DataFrame:
    out = id_crc(F.col("doc_id"), 7) == 2
    return score(docs, ~out, out)
