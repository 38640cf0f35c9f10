"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

Spans that may be disguised (words with a look-alike sign anywhere or a letter
twice or more in a row in any case, and three or more single letters or signs
with any separators between them) become character lattices; the likeliest
path under a character trigram model, found by Viterbi, replaces the span, and
may be the span itself. Everything else has one path only and stays.

The restored text is scored by its character 5-grams. Training counts, per
hashed 5-gram, the toxic and the clean documents that contain it; a document's
evidence is the log odds of its strongest 5-grams, and a logistic regression
on that evidence gives the score. Evidence for the regression comes from the
half of the sample that a document is not in.

The character model counts all rows. The 5-gram weights and the regression use
a sample of at most about ``MAX_PER_CLASS`` labelled rows a class (by a hash of
the id); every text is read whole, and every row is scored.

Defined cases: a null text counts as empty, and an empty text has the score of
no evidence; rows without a label are only scored; labels other than 0 and 1
are ignored; with one class or none in the labels all scores are 0; repeated
label rows count once; extra columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import code_points, cut, id_crc, ngram_hashes, text_or_empty, text_slices

BITS = 20
ORDER = 5
MAX_PER_CLASS = 10_000
TOP = 3
STRONG = 1.5
# Signs that stand for letters.
LOOKALIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
             "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c"}
# A sign read as a letter, kept inside a word, kept at a word's end or as a mark before it; a separator dropped; a double read as one.
SIGN_COST, KEEP_COST, EDGE_COST, DROP_COST, HALVE_COST = 0.7, 6.0, 2.0, 0.1, 4.5
_SIGNS = re.escape("".join(LOOKALIKE))
_LETTER = r"[^\W\d_]"
_MARKS = re.escape("".join(c for c in LOOKALIKE if not c.isdigit()))
_ONE = rf"(?:{_LETTER}|[{_SIGNS}])"
_RUN = rf"[\w{_MARKS}]"
# Single letters or signs apart; a word that holds a letter and a sign or a double.
_SPAN = re.compile(
    rf"(?P<apart>(?<![^\W_]){_ONE}(?:(?:[^\w{_MARKS}]|_)+{_ONE}(?![^\W_])){{2,}})"
    rf"|(?<!{_RUN})(?={_RUN}*?(?:[{_SIGNS}]|(?i:({_LETTER})\2)))(?={_RUN}*?{_LETTER}){_RUN}+")
_MEMO_CHARS = 64   # longer spans are decoded each time
LOOK_BACK = 4096   # steps after which the shared part of all paths is looked for
OTHER = 27   # symbols: 0 boundary, 1-26 letters, 27 anything else


def symbols(chars: np.ndarray) -> np.ndarray:
    """Symbol of each (lower-case) code point."""
    out = np.full(len(chars), OTHER, np.int64)
    az = (chars >= 97) & (chars <= 122)
    out[az] = chars[az] - 96
    out[(chars == 32) | ((chars >= 9) & (chars <= 13))] = 0
    return out


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0 if c == " " else OTHER


class Restorer:
    """Viterbi over character lattices, with a memo of spans."""

    def __init__(self, logp: np.ndarray, memo: int = 100_000):
        self.logp, self.memo, self.most = logp.tolist(), {}, memo
        self.steps: dict = {}

    @staticmethod
    def options(c: str, n: int, edge: bool, apart: bool) -> list[tuple[str, float]]:
        """The possible texts of ``n`` equal characters and their channel costs."""
        if c in LOOKALIKE:
            read = LOOKALIKE[c]
            words = ["".join(x) for x in product(read, repeat=n)] if n <= 3 else [x * n for x in read]
            kept = [*((x, SIGN_COST * n) for x in words), (c * n, EDGE_COST if edge else KEEP_COST)]
            return kept + [(x, SIGN_COST + HALVE_COST) for x in read] if n > 1 else kept
        if apart and not c.isalpha():
            return [("", DROP_COST * n), (c * n, KEEP_COST)]
        if not c.isalpha() or n == 1:
            return [(c * n, 0.0)]
        return [(c, 0.0 if n >= 3 else HALVE_COST), (c * 2, 0.0)]

    def _step(self, c: str, n: int, edge: bool, apart: bool) -> list[tuple[str, float, list[int]]]:
        """The options with the symbols of their texts, where a row of one mark counts once."""
        found = self.steps.get((c, n, edge, apart))
        if found is None:
            found = []
            for text, channel in self.options(c, n, edge, apart):
                read = [_symbol(ch) for ch in text]
                found.append((text, channel, [s for j, s in enumerate(read) if not (j and s == OTHER and text[j] == text[j - 1])]))
            if n <= 8 and len(self.steps) < self.most:
                self.steps[c, n, edge, apart] = found
        return found

    def decode(self, span: str, apart: bool = False) -> str:
        """The likeliest text of a span. Of each step only its options and a back pointer a state are
        held, and what all surviving paths share is written out on the way."""
        found = self.memo.get(span)
        if found is not None:
            return found
        low = span.lower()
        last = len(low.rstrip("".join(LOOKALIKE)))   # only signs from here on
        marks = len(low) - len(low.lstrip("".join(c for c in LOOKALIKE if not c.isdigit())))
        out: list[str] = []
        reads, back = [], []   # per held step: its options and each state's pointer

        def path(t: int, state: int) -> str:
            """Text of the first ``t`` held steps by way of ``state``."""
            texts = []
            for read, pointers in zip(reversed(reads[:t]), reversed(back[:t])):
                pointer = pointers[state]
                texts.append(read[pointer & 15][0])
                state = pointer >> 4
            return "".join(reversed(texts))

        # A state is the last two symbols; a pointer holds the state before and the option taken.
        states, costs, i, look, logp = [(0, 0)], [0.0], 0, LOOK_BACK, self.logp
        while i < len(low):
            n = 1
            while i + n < len(low) and low[i + n] == low[i]:
                n += 1
            number: dict = {}
            nxt, cost, came = [], [], []
            read = self._step(low[i], n, i >= last or i < marks, apart)
            for before, ((a, b), spent) in enumerate(zip(states, costs)):
                for k, (_, channel, symbols_read) in enumerate(read):
                    x, y, c = a, b, spent + channel
                    for s in symbols_read:
                        c -= logp[x][y][s]
                        x, y = y, s
                    at = number.get((x, y))
                    if at is None:
                        number[x, y] = len(nxt)
                        nxt.append((x, y))
                        cost.append(c)
                        came.append(before << 4 | k)
                    elif c < cost[at]:
                        cost[at], came[at] = c, before << 4 | k
            reads.append(read)
            back.append(came)
            states, costs = nxt, cost
            i += n
            if len(reads) >= look:
                alive, t = set(range(len(states))), len(reads)
                while len(alive) > 1 and t:
                    t -= 1
                    alive = {back[t][state] >> 4 for state in alive}
                if t:
                    out.append(path(t, alive.pop()))
                # Two bytes a pointer for the steps on which the paths still differ.
                reads, back = reads[t:], [array("H", pointers) for pointers in back[t:]]
                look = 2 * len(reads) + LOOK_BACK
        best = min(range(len(states)), key=lambda k: costs[k] - logp[states[k][0]][states[k][1]][0])
        out.append(path(len(reads), best))
        found = "".join(out)
        if len(span) <= _MEMO_CHARS and len(self.memo) < self.most:
            self.memo[span] = found
        return found

    def _read(self, m: re.Match) -> str:
        apart = m["apart"] is not None
        if apart and sum(c.isalpha() for c in m[0]) < 2:   # numbers in a row
            return m[0]
        return self.decode(m[0], apart)

    def restore(self, texts: list[str]) -> list[str]:
        """Texts with their disguised spans decoded."""
        return [_SPAN.sub(self._read, t) for t in texts]


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character 5-grams of restored texts: owner row and feature."""
    cleaned = [_NOT_LETTERS.sub(" ", t).strip().lower() for t in texts]
    chars, starts = code_points(cleaned, gap=ORDER)
    owner = np.zeros(len(chars), np.int32)
    owner[starts[1:]] = 1
    owner = np.cumsum(owner, dtype=np.int32)
    h = ngram_hashes(chars, ORDER, BITS)
    # Grams that start inside a word or on the space before one.
    solid = chars != 32
    keep = solid[: len(h)].copy()
    keep |= solid[1: 1 + len(h)]
    return owner[: len(h)][keep], h[keep].astype(np.int64)


def evidence(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Per text: the strongest weight, the mean of the ``TOP`` strongest (0 where
    there are fewer) and the logarithm of the length."""
    out = np.zeros((len(texts), 3))
    for a, b in text_slices(texts, 2_000_000):
        owner, feats = features(texts[a:b])
        w = weights[feats]
        strong = w > STRONG
        pair = np.unique(owner[strong].astype(np.int64) << BITS | feats[strong])
        row, w = pair >> BITS, weights[pair & (1 << BITS) - 1]
        order = np.lexsort((-w, row))
        row, w = row[order], w[order]
        first = np.searchsorted(row, np.arange(b - a + 1))
        nth = np.arange(len(row)) - first[row]
        out[a:b, 0] = np.bincount(row[nth == 0], w[nth == 0], b - a)
        out[a:b, 1] = np.bincount(row[nth < TOP], w[nth < TOP], b - a) / TOP
        out[a:b, 2] = np.log1p([len(t) for t in texts[a:b]])
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method; the last coefficient is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        hess = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (p - y) + l2 * w)
        w -= step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
    return w


def _weights(with_gram: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Smoothed log odds of each 5-gram; rows: clean, toxic."""
    rate = (with_gram + 0.5) / (docs[:, None] + 1)
    return (np.log(rate[1]) - np.log(rate[0])).astype(np.float32)


def _sample(docs: DataFrame, labels: DataFrame, usable: Column, max_per_class: int) -> DataFrame | None:
    """``text, toxic, fold`` of the rows to fit on, stored."""
    labels = labels.where(F.col("toxic").isin(0, 1) & usable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    dealt = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30))
    keep = F.lit(False)
    for toxic, rows in n.items():
        keep |= (F.col("toxic") == toxic) & (dealt < int(min(1.0, max_per_class / rows) * (1 << 30)))
    chosen = labels.where(keep).select(F.col("doc_id").alias("label_id"), "toxic")
    # About 2 * max_per_class rows by construction, so the broadcast is bounded.
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    return cut(rows.select("text", "toxic", F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(2)).cast("int").alias("fold")))


def _train_characters(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) over symbols, from the texts of all rows."""
    n = OTHER + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n ** 3, np.int64)
        for batch in batches:
            texts = [t.lower() for t in batch.column("text").to_pylist()]
            for a, b in text_slices(texts):
                s = symbols(code_points(texts[a:b], gap=2)[0])
                total += np.bincount((s[:-2] * n + s[1:-1]) * n + s[2:], minlength=n ** 3)
        gram = np.nonzero(total)[0]
        yield pa.record_batch({"gram": pa.array(gram, pa.int32()), "n": pa.array(total[gram], pa.int64())})

    sums = docs.select(text_or_empty().alias("text")).mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(n ** 3)
    total[sums["gram"]] = sums["n"]
    total = total.reshape(n, n, n) + 0.1
    return np.log(total / total.sum(axis=2, keepdims=True))


def train(docs: DataFrame, labels: DataFrame, usable: Column, max_per_class: int = MAX_PER_CLASS) -> tuple | None:
    """(character model, 5-gram weights, coefficients), or None with nothing to learn."""
    sample = _sample(docs, labels, usable, max_per_class)
    if sample is None:
        return None
    sc = docs.sparkSession.sparkContext
    logp = _train_characters(docs)
    shipped = sc.broadcast(logp)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, total = Restorer(shipped.value), np.zeros((2, 2, 1 << BITS), np.int32)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            toxic, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("toxic", "fold"))
            for a, b in text_slices(texts, 2_000_000):
                owner, feats = features(restorer.restore(texts[a:b]))
                pair = np.unique(owner.astype(np.int64) << BITS | feats)
                row = (pair >> BITS) + a
                np.add.at(total, (fold[row], toxic[row], pair & (1 << BITS) - 1), 1)
        f, t, g = np.nonzero(total)
        yield pa.record_batch({"fold": pa.array(f, pa.int32()), "toxic": pa.array(t, pa.int32()),
                               "gram": pa.array(g, pa.int32()), "n": pa.array(total[f, t, g], pa.int64())})

    # At most 4 * 2^20 sums, whatever the input.
    sums = sample.mapInArrow(count, "fold int, toxic int, gram int, n long") \
        .groupBy("fold", "toxic", "gram").agg(F.sum("n").alias("n")).toPandas()
    grams = np.zeros((2, 2, 1 << BITS), np.int64)
    grams[sums["fold"], sums["toxic"], sums["gram"]] = sums["n"]
    docs_in = np.zeros((2, 2))
    for r in sample.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect():
        docs_in[r["fold"], r["toxic"]] = r["n"]
    other_half = sc.broadcast([_weights(grams[1 - f], docs_in[1 - f]) for f in (0, 1)])

    def collect_evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shipped.value)
        for batch in batches:
            texts = restorer.restore(batch.column("text").to_pylist())
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            x = np.zeros((len(texts), 3))
            for f in (0, 1):
                at = np.nonzero(fold == f)[0]
                x[at] = evidence([texts[i] for i in at], other_half.value[f])
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(x[:, k]) for k in range(3))],
                                             names=["toxic", "x0", "x1", "x2"])

    fit = sample.mapInArrow(collect_evidence, "toxic int, x0 double, x1 double, x2 double").toPandas()
    coef = fit_logistic(fit[["x0", "x1", "x2"]].to_numpy(), fit["toxic"].to_numpy(float))
    return logp, _weights(grams.sum(axis=0), docs_in.sum(axis=0)), coef


def score(docs: DataFrame, model: tuple | None, held_out: Column) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), text_or_empty().alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp, weights, coef = shipped.value
        restorer = Restorer(logp)
        for batch in batches:
            texts, p = batch.column("text").to_pylist(), np.zeros(batch.num_rows)
            for a, b in text_slices(texts, 2_000_000):
                x = evidence(restorer.restore(texts[a:b]), weights)
                p[a:b] = _sigmoid(x @ coef[:-1] + coef[-1])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                                              pa.array((p >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = id_crc(F.col("doc_id"), 5) == 0
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    return score(docs, train(docs, labels, ~out), out)
