"""Exact deduplication by distributed MSD radix partitioning.

Texts are compared as UTF-8 bytes after each run of white space is made one
space. The leading digit is the byte length, then come the bytes, a chunk of
successive bytes per level. At each level documents are split by (group,
chunk); a group is done when it is a singleton or its texts have ended, the
rest is split by the next chunk. Equality rests on the bytes themselves, no
digest takes part. Chunks grow by ``GROWTH`` from level to level, so a text of
n bytes ends after log(n) levels.

Every split is a count with partial aggregation (one row per task and key
leaves the map side, however large the group) and a join of documents with
those counts, which adaptive execution splits where a group is hot. Only the
documents still tied after the first level carry their text further.

Defined cases: null text is the empty text; of equal texts the row with the
smallest id stays (null ids last), and of repeated rows with that id exactly
one; extra columns are ignored, or carried along as ``carry``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import SPACES, cut, text_or_empty

FIRST_BYTES = 32
GROWTH = 8


def normalised(text: str = "text"):
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


def classes(docs: DataFrame, first_bytes: int = FIRST_BYTES, growth: int = GROWTH, carry: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` per row of ``docs``
    (and ``row``, the whole input row as a struct, with ``carry``)."""
    kept_cols = ["doc_id", "sha"] + (["row"] if carry else [])
    base = docs.select("doc_id", normalised().alias("norm"), *([F.struct("*").alias("row")] if carry else []))
    base = base.select(
        "doc_id", *(["row"] if carry else []),
        F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), F.monotonically_increasing_id().alias("rid"),
        F.octet_length("norm").alias("bytes"), F.col("norm").cast("binary").alias("body"))
    base = base.withColumn("chunk", F.substring("body", 1, first_bytes))

    # Level 1: byte length and the first bytes. Only tied documents keep a body.
    counts = _count(base, ["bytes", "chunk"])
    tied = (F.col("n") > 1) & (F.col("bytes") > first_bytes)
    level = cut(base.join(counts, ["bytes", "chunk"])
                .select(*kept_cols, "rid", "first", "n", "bytes", tied.alias("open"),
                        F.when(tied, F.expr(f"substring(body, {first_bytes + 1})")).alias("body")))
    done = [_closed(level, kept_cols)]

    # Next levels: the group is named by its first row; compare the next chunk.
    size, offset = first_bytes * growth, first_bytes
    while (left := level.where("open")).select("rid").head(1):
        docs_now = left.select(*kept_cols, "rid", "bytes", F.col("first.rid").alias("group"),
                               F.substring("body", 1, size).alias("chunk"), "body")
        counts = _count(docs_now, ["group", "chunk"])
        offset += size
        tied = (F.col("n") > 1) & (F.col("bytes") > offset)
        level = cut(docs_now.join(counts, ["group", "chunk"])
                    .select(*kept_cols, "rid", "first", "n", "bytes", tied.alias("open"),
                            F.when(tied, F.expr(f"substring(body, {size + 1})")).alias("body")))
        done.append(_closed(level, kept_cols))
        size *= growth

    out = reduce(DataFrame.unionByName, done)
    return out.select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                      (F.col("rid") == F.col("first.rid")).alias("kept"), F.col("sha").alias("text_sha256"),
                      *(["row"] if carry else []))


def _count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and the first row of each (group, chunk); null ids come last. Cut,
    so that the join that follows shuffles both sides itself and adaptive
    execution can split a hot group."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("first")
    return cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), first))


def _closed(level: DataFrame, kept_cols: list[str]) -> DataFrame:
    return level.where("NOT open").select(*kept_cols, "rid", "first", "n")


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = classes(docs, carry=True).where("kept")
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
