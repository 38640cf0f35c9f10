"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams (1 to 3 characters) per language over labelled
rows. At most about ``MAX_PER_LANG`` rows a language are used, taken by a hash
of the id; beyond that sample nothing is left out, and every text, in training
and in prediction, is read whole. The log-probability matrix (languages by
2^16 n-grams) travels to the tasks; a batch of texts is scored as one sparse
product in numpy. More than ``LANG_BLOCK`` languages are learned and scored in blocks,
of which each carries the best so far on to the next. Text is lower-cased and everything but letters counts as a
space.

Defined cases: a null text, one without a letter, and every text when nothing
could be learned are ``und`` with score 0; rows with a null language are not
trained on; equal scores go to the smaller language value; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import code_points, id_crc, ngram_hashes, text_slices
from cadence.session import scratch_path

BITS = 16
ORDERS = (1, 2, 3)
MAX_PER_LANG = 4000
LANG_BLOCK = 128   # languages whose matrix is held at a time
SMOOTHING = 0.5
_NOT_LETTER = re.compile(r"[\W\d_]+")


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray   # (len(ORDERS) * 2^BITS, langs)
    prior: np.ndarray


def clean(text: str | None) -> str:
    """Lower-cased letters with single spaces between runs of them; "" if no letter."""
    return _NOT_LETTER.sub(" ", text).strip().lower() if text else ""


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of cleaned texts: owner row and feature of each."""
    chars, starts = code_points(texts, gap=2)
    owner = np.zeros(len(chars), np.int32)
    owner[starts[1:]] = 1
    owner = np.cumsum(owner, dtype=np.int32)
    rows, feats = [], []
    for k, n in enumerate(ORDERS):
        h = ngram_hashes(chars, n, BITS)
        # A text is led by two spaces: n-grams of up to three never join two texts' letters.
        keep = chars[: len(h)] != 32
        if n > 1:
            keep |= chars[1: 1 + len(h)] != 32
        rows.append(owner[: len(h)][keep])
        feats.append(h[keep].astype(np.int32) + (k << BITS))
    return np.concatenate(rows), np.concatenate(feats)


def train(docs: DataFrame, usable: Column, max_per_lang: int = MAX_PER_LANG) -> Iterator[Model]:
    """Fit on the ``usable`` rows of ``docs`` (columns doc_id, text, lang): a
    model for each block of languages, in their order; one without languages if there is none."""
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    per_lang = sorted((r["lang"], r["n"]) for r in counted.collect())   # one row a language
    size = len(ORDERS) << BITS
    if not per_lang:
        yield Model([], np.zeros((size, 0), np.float32), np.zeros(0))
    everything = sum(n for _, n in per_lang)
    dealt = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30))
    for start in range(0, len(per_lang), LANG_BLOCK):
        block = per_lang[start:start + LANG_BLOCK]
        keep = F.lit(False)
        for lang, n in block:
            keep |= (F.col("lang") == lang) & (dealt < int(min(1.0, max_per_lang / n) * (1 << 30)))
        yield _fit(rows.where(keep), [lang for lang, _ in block], np.log(np.array([n for _, n in block]) / everything))


def _fit(rows: DataFrame, langs: list[str], prior: np.ndarray) -> Model:
    size = len(ORDERS) << BITS
    index = {lang: i for i, lang in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), size), np.int32)
        for batch in batches:
            cleaned = [clean(t) for t in batch.column("text").to_pylist()]
            which = np.array([index[x] for x in batch.column("lang").to_pylist()], np.int64)
            for a, b in text_slices(cleaned):
                owner, feats = features(cleaned[a:b])
                lang = which[a:b][owner]
                for j in np.unique(lang):
                    total[j] += np.bincount(feats[lang == j], minlength=size)
        lang, feat = np.nonzero(total)
        yield pa.record_batch({"lang": pa.array(lang, pa.int32()), "feat": pa.array(feat, pa.int32()),
                               "n": pa.array(total[lang, feat], pa.int64())})

    # At most len(langs) * 3 * 2^16 sums come to the driver, whatever the input.
    sums = (rows.select("text", "lang").mapInArrow(count, "lang int, feat int, n long")
            .groupBy("lang", "feat").agg(F.sum("n").alias("n"))).toPandas()
    logp = np.empty((size, len(langs)), np.float32)
    for j in range(len(langs)):
        of = sums[sums["lang"] == j]
        n = np.full(size, SMOOTHING)
        n[of["feat"]] += of["n"]
        parts = n.reshape(len(ORDERS), -1)
        logp[:, j] = np.log(parts / parts.sum(axis=1, keepdims=True)).ravel()
    return Model(langs, logp, prior)


def score_texts(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of cleaned texts: the best language's number, its log-probability with the text, and
    the sum over the block's languages, relative to it."""
    best, top, rest = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
    for a, b in text_slices(texts, 1_000_000):
        owner, feats = features(texts[a:b])
        total = np.stack([np.bincount(owner, model.logp[feats, j], b - a) for j in range(len(model.langs))], axis=1) + model.prior
        best[a:b], top[a:b] = total.argmax(axis=1), total.max(axis=1)
        rest[a:b] = np.exp(total - top[a:b, None]).sum(axis=1)
    return best, top, rest


def predict(docs: DataFrame, models: Iterable[Model], columns: list[str] | None = None, held_out: Column | None = None) -> DataFrame:
    """``columns`` of ``docs`` plus ``held_out`` (if given), ``lang_pred`` and ``score``."""
    columns = columns if columns is not None else ["doc_id"]
    spark = docs.sparkSession
    carried = [*columns, *(["held_out"] if held_out is not None else [])]
    rows = docs.select(*columns, *([held_out.alias("held_out")] if held_out is not None else []), F.col("text").alias("_text_in"),
                       F.lit("und").alias("lang_pred"), F.lit(float("-inf")).alias("_top"), F.lit(1.0).alias("_rest"))
    schema = rows.schema
    for f in schema:
        f.nullable = True
    for k, model in enumerate(models):
        if not model.langs:
            break
        if k:   # one block's matrix at a time
            path = scratch_path(spark, "langid-block")
            rows.write.parquet(path)
            rows = spark.read.parquet(path)
        rows = rows.mapInArrow(_better(spark.sparkContext.broadcast((model.langs, model.logp, model.prior)), schema.names), schema)
    return rows.select(*carried, "lang_pred", F.when(F.col("lang_pred") == "und", 0.0).otherwise(1 / F.col("_rest")).alias("score"))


def _better(shipped, names: list[str]):
    """Take a block's best language where it beats the best so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shipped.value)
        for batch in batches:
            cleaned = [clean(t) for t in batch.column("_text_in").to_pylist()]
            best, top, rest = score_texts(cleaned, model)
            top_so_far, rest_so_far = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_top", "_rest"))
            known = np.array([bool(c) for c in cleaned], bool)
            won = known & (top > top_so_far)
            most = np.maximum(top, top_so_far)
            lang = [model.langs[j] if w else old for j, w, old in zip(best, won, batch.column("lang_pred").to_pylist())]
            rest = rest * np.exp(top - most) + rest_so_far * np.exp(top_so_far - most)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names[:-3]), pa.array(lang, pa.string()), pa.array(most), pa.array(rest)], names=names)
    return run


def trained_rows() -> Column:
    """The rows the registered query may learn from."""
    return id_crc(F.col("doc_id"), 4) != 2


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``."""
    return predict(docs, train(docs, trained_rows()), ["doc_id"], F.coalesce(~trained_rows(), F.lit(False)))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that are not ``und``, however near their languages are;
    with nothing learned, all that hold a letter."""
    nothing = Model(["any"], np.zeros((len(ORDERS) << BITS, 1)), np.zeros(1))
    models = (model if model.langs else nothing for model in train(docs, trained_rows()))
    own = [f"_in_{i}" for i in range(len(docs.columns))]
    # Own column names, so that a document's columns cannot clash with the result's.
    wide = docs.select(F.col("text").alias("text"), *[F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)])
    kept = predict(wide, models, own).where(F.col("lang_pred") != "und")
    return kept.select(*[F.col(o).alias(c) for c, o in zip(docs.columns, own)])
