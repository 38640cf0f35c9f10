"""User identity resolution for daily activity.

Users are ranked "most complete first" (email present, then username, then
createdAt; ``user_id`` breaks ties). From that ranking:

* lookup (W2 + W3): the most complete user per phone, plus one row per
  ``user_id`` among users without a phone;
* profile (D11 fixed): exactly one lookup row per ``user_id``;
* phone map (J5): phone -> lookup user id (phones are unique in the lookup);
* canonical map (J9, J10, W5): every known ``user_id`` -> its canonical id:
  itself when it is in the lookup, else the lookup id that owns its phone;
* excluded ids (J8, A17): lookup ids whose phone is on the exclusion list.

``resolution`` returns the phone map and the id map, each flagged for
exclusion: product events resolve ``distinct_id`` by phone first and by user
id second; app events and invites resolve ``user_id`` by user id only,
unknown ids keeping themselves. All steps are aggregates or equi-joins over
the users table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.joins import is_small, keep_first

PROFILE_COLS = ["user_id", "phoneNumber", "fullName", "username", "email", "createdAt"]


def _completeness():
    return [F.col("email").isNull(), F.col("username").isNull(), F.col("createdAt").isNull()]


def user_lookup(users: DataFrame) -> DataFrame:
    """W2 + W3: best user per phone, and one row per user id without phone."""
    payload = [c for c in PROFILE_COLS if c != "phoneNumber"]
    order = _completeness() + [F.col("user_id"), F.col("fullName")]
    with_phone = keep_first(users.where(F.col("phoneNumber").isNotNull()), ["phoneNumber"],
                            order, payload)
    without_phone = keep_first(users.where(F.col("phoneNumber").isNull()), ["user_id"],
                               order + [F.col("phoneNumber")],
                               [c for c in PROFILE_COLS if c != "user_id"])
    return with_phone.select(*PROFILE_COLS).unionByName(without_phone.select(*PROFILE_COLS))


def user_profile(lookup: DataFrame) -> DataFrame:
    """One profile row per user id (a user id holding two phones keeps the
    more complete row, then the smaller phone)."""
    order = _completeness() + [F.col("phoneNumber").isNull(), F.col("phoneNumber")]
    return keep_first(lookup, ["user_id"], order, [c for c in PROFILE_COLS if c != "user_id"])


def phone_map(lookup: DataFrame) -> DataFrame:
    """Phone -> lookup user id."""
    return lookup.where(F.col("phoneNumber").isNotNull()).select("phoneNumber", "user_id")


def canonical_map(users: DataFrame, lookup: DataFrame) -> DataFrame:
    """J9 + J10 + W5: every known user id -> canonical user id."""
    self_rows = lookup.select("user_id", F.col("user_id").alias("canonical_id"), F.lit(1).alias("rank"))
    pm = phone_map(lookup).withColumnRenamed("user_id", "canonical_id")
    by_phone = (users.where(F.col("phoneNumber").isNotNull()).select("user_id", "phoneNumber")
                .join(pm, "phoneNumber").select("user_id", "canonical_id", F.lit(2).alias("rank")))
    return keep_first(self_rows.unionByName(by_phone), ["user_id"],
                      [F.col("rank"), F.col("canonical_id")], ["canonical_id"])


def excluded_ids(lookup: DataFrame, excluded: DataFrame) -> DataFrame:
    """Lookup user ids whose phone is excluded (distinct)."""
    ex = excluded.select(F.col("id").alias("phoneNumber")).where(F.col("phoneNumber").isNotNull()).distinct()
    return lookup.join(ex, "phoneNumber", "left_semi").select("user_id").distinct()


def resolution(users: DataFrame, excluded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two maps a key is resolved with, each flagged for exclusion:

    * by phone: ``(key, phone_target, phone_excluded)`` - phone -> lookup id;
    * by id: ``(key, id_target, id_excluded)`` - known user id -> canonical id.

    Product events try the phone map, then the id map; app events and invites
    use the id map, unknown ids keeping themselves. Excluded ids number at
    most one per excluded phone (phones are unique in the lookup), so once
    the exclusion list is proven small they are broadcast, and each map keeps
    the partitioning of the aggregate that built it.
    """
    lookup = user_lookup(users)
    ex_ids = excluded_ids(lookup, excluded).withColumn("_excluded", F.lit(True))
    if is_small(excluded):
        ex_ids = F.broadcast(ex_ids)

    def flagged(df: DataFrame, target: str) -> DataFrame:
        return (df.join(ex_ids.withColumnRenamed("user_id", target), target, "left")
                .withColumn("_excluded", F.coalesce("_excluded", F.lit(False))))

    by_phone = flagged(phone_map(lookup).select(F.col("phoneNumber").alias("key"),
                                                F.col("user_id").alias("phone_target")), "phone_target")
    by_id = flagged(canonical_map(users, lookup).select(F.col("user_id").alias("key"),
                                                        F.col("canonical_id").alias("id_target")), "id_target")
    return (by_phone.withColumnRenamed("_excluded", "phone_excluded"),
            by_id.withColumnRenamed("_excluded", "id_excluded"))
