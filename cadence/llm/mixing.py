"""Mixing sources to target weights, with DataFrame operations only.

Sizes are words. Sources, in code point order with null last, weigh
``weights`` in turn and share all words; a target stops at ``max_epochs``
times its source's size and the excess is shared again by weight (the
water level is found in closed form over the sources sorted by cap / weight).

The schedule is a low-discrepancy sequence: slot n is the golden-ratio point
frac(n * phi), mapped through the sources' cumulative targets to a source,
and slots are ranked per source. Each source's documents are shuffled (by a
hash of seed and id) and repeated end to end; the words of its target are cut
into as many equal blocks as it has slots, and slot and block are joined on
(source, rank). A source that no point hits gets one slot at the end.

Nothing is ranked or summed over a whole source in one task: rows are dealt
into buckets (by hash) or chunks (by slot number) of about sqrt(n) rows, the
buckets are added up first, and only their sums are ordered per source.

Defined cases: null text is 0 words; null source is a source of its own;
a document without words takes 0; repeated rows each take their own share; an
empty table gives an empty mix; extra columns are ignored. Reruns agree:
order depends on seed, id and content only, and rows equal in these are alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm.common import WORD, cut, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK_WORDS = 256
CELLS = 4096
LEAST_GROUP = 512


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sid, source, source_size, target`` per source; ``sizes`` has one row
    per source (a table as long as the list of sources, so its windows are too)."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("sid", F.row_number().over(by_name) - 1).withColumn("w", turn)
         .withColumn("cap", F.lit(max_epochs) * F.col("source_size")))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    s = s.withColumn("level", level)
    # The level rises while sources are capped and falls after the first that is not.
    return s.select("sid", "source", "source_size",
                    F.least(F.col("cap").cast("double"), F.max("level").over(every) * F.col("w")).alias("target"))


def _prefix(df: DataFrame, part: list[str], order: str, value: str, name: str) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))


def _group_rows(n: int) -> int:
    return max(LEAST_GROUP, math.isqrt(n))


def _point(n: Column) -> Column:
    """frac(n * phi), with n split so that doubles stay exact enough far out."""
    phi, step = (5 ** 0.5 - 1) / 2, 1 << 20
    # frac(step * phi) from integer arithmetic: floor(step * sqrt(5) ...) to 2^-60.
    scaled = ((math.isqrt(5 << 240) - (1 << 120)) // 2) * step % (1 << 120)
    hi, lo = F.floor(n / F.lit(step)), n % F.lit(step)
    x = hi * F.lit(scaled / (1 << 120)) + lo * F.lit(phi)
    return x - F.floor(x)


def schedule(plan: DataFrame, total: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``slot, sid, rank`` for every slot; ``plan`` as ``targets`` returns it."""
    spark, n = plan.sparkSession, -(-total // block_words)
    chunk = _group_rows(n)
    cum = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = plan.where("target > 0").select("sid", (F.sum("target").over(cum) / F.lit(float(max(1, total)))).alias("hi"),
                                            F.max("sid").over(Window.partitionBy()).alias("last"))
    share = share.select("sid", F.coalesce(F.lag("hi").over(Window.orderBy("sid")), F.lit(0.0)).alias("lo"),
                         F.when(F.col("sid") == F.col("last"), F.lit(1.0)).otherwise(F.col("hi")).alias("hi"))
    # Equi-join on cells of [0, 1): each source's interval covers a run of cells.
    cells = share.where("hi > lo").select("sid", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS).cast("int"), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)).cast("int")))
        .alias("cell"))
    points = spark.range(n).select(F.col("id").alias("slot"), _point(F.col("id")).alias("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * CELLS).cast("int"))
    hit = (points.join(cells, "cell").where("u >= lo AND u < hi")
           .select("slot", "sid", F.floor(F.col("slot") / chunk).alias("chunk")))
    hit = hit.withColumn("at", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    counts = _prefix(hit.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("k")), ["sid"], "chunk", "k", "before")
    ranked = hit.join(counts.select("sid", "chunk", "before"), ["sid", "chunk"]) \
        .select("slot", "sid", (F.col("before") + F.col("at")).alias("rank"))
    unhit = (plan.where("target > 0").join(hit.select("sid").distinct(), "sid", "left_anti")
             .select((F.lit(n) + F.col("sid")).alias("slot"), "sid", F.lit(0).cast("long").alias("rank")))
    return ranked.unionByName(unhit)


def row_key(docs: DataFrame) -> Column:
    """128 bits that tell rows with different contents apart, whatever their ids.
    Maps have no hash and their entries no order: they count as sorted entries."""
    told = []
    for f in docs.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.MapType):
            told.append(F.array_sort(F.transform(F.map_entries(c), lambda e: F.xxhash64(e["key"], e["value"]))))
        elif "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString():
            told.append(F.to_json(F.struct(c)))
        else:
            told.append(c)
        told.append(c.isNull())
    return F.struct(F.xxhash64(F.lit(1), *told).alias("a"), F.xxhash64(F.lit(2), *told).alias("b"))


def mix_blocks(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
               block_words: int = BLOCK_WORDS, seed: int = 7, key: Column | None = None) -> DataFrame:
    """Every piece of a document that the mix takes, and documents it does not
    take (``slot`` null): ``doc_id, size, source_size, target, key, row, epoch,
    slot, start, words``. ``key`` is the given one or that of id, source and
    text, ``row`` tells rows apart, ``start`` is the piece's first word in the
    document; ordering by ``slot`` gives the mixed stream."""
    key = row_key(docs.select("doc_id", "source", "text")) if key is None else key
    # The place of a document without words changes nothing: any number spreads them.
    spread = F.when(F.col("size") == 0, F.monotonically_increasing_id())
    narrow = cut(docs.select("doc_id", "source", word_count().alias("size"), key.alias("key")).withColumn("spread", spread))
    head = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    rows, total = head[0], head[1]
    buckets = -(-rows // _group_rows(rows)) if rows else 1
    plan = cut(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs))
    slots = cut(schedule(plan, total, block_words))
    plan = plan.join(slots.groupBy("sid").agg(F.count(F.lit(1)).alias("blocks")), "sid", "left")

    # Where each document begins in its source's shuffled order.
    h = F.xxhash64(F.lit(seed), "doc_id", "key", "spread")
    placed = narrow.withColumn("h", h).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    order = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size", "key")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("within", inside).withColumn("nth", F.row_number().over(order))
    sums = _prefix(placed.groupBy("source", "bucket").agg(F.sum("size").alias("s")), ["source"], "bucket", "s", "base")
    sums = sums.join(plan, sums["source"].eqNullSafe(plan["source"])) \
        .select(sums["source"].alias("src"), F.col("bucket").alias("b"), "base", "sid", "source_size", "target", "blocks")
    d = placed.join(sums, F.col("source").eqNullSafe(F.col("src")) & (F.col("bucket") == F.col("b")))
    d = d.select("doc_id", "size", "source_size", "target", "sid", "blocks", "key",
                 F.struct("sid", "bucket", "nth").alias("row"), (F.col("base") + F.col("within")).alias("begin"),
                 F.floor("target").alias("goal"))

    # Each repeat of a document covers the blocks it touches below the target.
    d = d.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    d = d.withColumn("lo", F.col("epoch") * F.col("source_size") + F.col("begin")) \
        .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("goal")))
    taken = (F.col("hi") > F.col("lo")) & F.col("blocks").isNotNull()
    # Block k holds words [k * goal div blocks, (k + 1) * goal div blocks).
    first = F.expr("((lo + 1) * blocks - 1) div goal")
    last = F.expr("(hi * blocks - 1) div goal")
    d = d.withColumn("rank", F.explode_outer(F.when(taken, F.sequence(first, last))))
    d = d.where("rank IS NOT NULL OR epoch = 0")
    w_lo = F.greatest("lo", F.expr("rank * goal div blocks"))
    w_hi = F.least("hi", F.expr("(rank + 1) * goal div blocks"))
    pieces = d.select("doc_id", "size", "source_size", "target", "sid", "key", "row", "epoch", "rank",
                      (w_lo - F.col("lo")).alias("start"), (w_hi - w_lo).alias("words"))
    joined = pieces.join(slots, ["sid", "rank"], "left")
    return joined.select("doc_id", "size", "source_size", "target", "key", "row", "epoch", "slot", "start",
                         F.when(F.col("slot").isNotNull(), F.col("words")).alias("words"))


def _taken(docs: DataFrame, **options) -> DataFrame:
    return mix_blocks(docs, **options).groupBy("row", "key", "doc_id", "size", "source_size", "target") \
        .agg(F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("taken"))


def taken(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``."""
    return _taken(docs, **options).select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken")


def remix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` repeated as the mix says: a document appears once for each
    whole or half-taken repeat (``taken / size`` rounded half up); documents
    without words stay once. Rows are told apart by all their columns, not by
    id; rows equal in all appear as often as they do together."""
    key = row_key(docs)
    one = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5))
    # Cut: what the mix shuffled is gone before the documents are shuffled.
    copies = cut(_taken(docs, key=key, **options).groupBy("key").agg(F.sum(one).cast("int").alias("copies"))
                 .where("copies > 0").withColumnRenamed("key", "mixed"))
    # Own column names, so that a document's columns cannot clash with the others.
    own = [f"in_{i}" for i in range(len(docs.columns))]
    rows = docs.select(key.alias("key"), *[F.col(f"`{c}`").alias(o) for c, o in zip(docs.columns, own)])
    out = rows.join(copies, F.col("key") == F.col("mixed")).dropDuplicates(["key"])
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))) \
        .select(*[F.col(o).alias(c) for c, o in zip(docs.columns, own)])
