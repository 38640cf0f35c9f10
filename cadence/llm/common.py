"""Shared helpers of the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import checkpoint_dir

# A word: a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made and writes begun meanwhile delete their shuffle files as soon as
    they have run, not when the driver next collects its garbage. For what runs once:
    a second run of such a frame shuffles again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder; what was
    shuffled for it goes once it is written."""
    checkpoint_dir(df.sparkSession)
    with short_shuffles(df.sparkSession):
        once = df.select("*")   # a frame of its own: the caller may run ``df`` again
    return once.checkpoint()


def id_crc(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def id_crc_py(doc_id: int, mod: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % mod


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_slices(texts: list[str], max_chars: int = 4_000_000):
    """Cut a list of texts into runs of about ``max_chars``, so that array
    work on a batch is bounded by its longest text, not by its row count."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > max_chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: list[str], gap: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, ``gap`` spaces before each text
    and after the last, and where each text (with its leading gap) starts."""
    pad = " " * gap
    joined = pad + pad.join(texts) + pad
    lengths = np.fromiter((len(t) + gap for t in texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(texts) else np.zeros(0, np.int64)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), starts


def ngram_hashes(chars: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash of the ``n`` code points that begin at each position, in ``bits`` bits."""
    m = max(0, len(chars) - n + 1)
    h = np.full(m, 0x9E3779B1 * n & 0xFFFFFFFF, np.uint32)
    for k in range(n):
        h ^= chars[k:k + m]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    h *= np.uint32(0xC2B2AE35)
    return h >> np.uint32(32 - bits)
