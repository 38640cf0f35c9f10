"""Exact median per group by digit-wise selection, no group ordered in one task.

Values are counted per (key, value) first - a partial aggregate, so repeats are
reduced map-side - and get an order-preserving integer (``ordered_long``). The
counts are added up per (key, integer) and per (key, leading digits), each shuffled by
all of its columns, so a key's rows are spread over the tasks whatever its share.
The middle ranks are then found from the top: cumulative counts over a key's leading
digits locate those of a rank, the ones below them its integer, and the values of
that integer the value. No size is probed while planning. The median is the
mean of the values at ranks floor((n+1)/2) and floor(n/2)+1, the interpolated median.

A window holds the leading digits of one key (at most 2,048 per power of two its values
span), the integers of one leading part (``2 ** DIGIT``) or the distinct values of one
integer, which are less than 2**-31 apart (of their size, if above 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Steps of the integer per power of two, and the bits of its lower digit.
STEPS = 1 << 31
DIGIT = 20


def ordered_long(value: Column, steps: int = STEPS) -> Column:
    """An integer that never falls as a double grows; NaN after all others."""
    scaled = F.signum(value) * F.log2(F.abs(value) + 1) * F.lit(float(steps))
    return F.when(F.isnan(value), F.lit((1 << 63) - 1)).otherwise(F.floor(scaled).cast("long"))


def _holding(counts: DataFrame, by: list[str], digit: str) -> DataFrame:
    """The rows of ``counts`` (``by``, ``digit``, ``_c``) in which a rank of ``_ks`` falls, with these
    ranks counted from the row's first one."""
    upto = Window.partitionBy(*by).orderBy(digit).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("_c").over(upto) - F.col("_c")
    inside = F.filter(F.transform("_ks", lambda k: k - F.col("_before")), lambda k: (k > 0) & (k <= F.col("_c")))
    return counts.withColumn("_before", before).withColumn("_ks", inside).where(F.size("_ks") > 0).drop("_before", "_c")


def exact_median(df: DataFrame, key: str, value: str, alias: str, steps: int = STEPS, digit: int = DIGIT) -> DataFrame:
    """``(key, alias)`` for keys with at least one non-null ``value``."""
    v = F.col(value)
    values = (df.where(v.isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_fine", ordered_long(v.cast("double"), steps)))
    fine = (values.groupBy(key, "_fine").agg(F.sum("_c").alias("_c"))
            .withColumn("_lead", F.shiftright("_fine", digit)))
    lead = fine.groupBy(key, "_lead").agg(F.sum("_c").alias("_c"))
    n = F.sum("_c").over(Window.partitionBy(key))
    ranked = lead.withColumn("_ks", F.array(F.floor((n + 1) / 2).cast("long"), (F.floor(n / 2) + 1).cast("long")))
    at_lead = _holding(ranked, [key], "_lead")
    at_fine = _holding(fine.join(at_lead, [key, "_lead"]), [key, "_lead"], "_fine").drop("_lead")
    at_value = _holding(values.join(at_fine, [key, "_fine"]), [key, "_fine"], value)
    return at_value.groupBy(key).agg(((F.min(value) + F.max(value)) / 2).cast("double").alias(alias))
