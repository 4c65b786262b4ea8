"""Counts and ranges of what was observed of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_key(rows: DataFrame, key: str, item: str, rank: str, flag: str, day: str, salts: int = 16) -> DataFrame:
    """(key, best_rank, items, flags, first_day, last_day): distinct items, and the distinct flags in order, joined by "; ".

    One exchange deals rows by key and salt, the salt from the item, so all rows of an item meet and a hot key lies in `salts`
    tasks; both groupings by (key, salt, item) and by (key, salt) are made there. A second one moves a row per key and salt. Null
    items and flags aren't counted; whatever flags there are come out.
    """
    salted = rows.select(key, item, rank, flag, day, F.pmod(F.xxhash64(item), F.lit(salts)).alias("_salt")).repartition(key, "_salt")
    items = salted.groupBy(key, "_salt", item).agg(F.min(rank).alias("rank"), F.collect_set(flag).alias("flags"), F.min(day).alias("first"), F.max(day).alias("last"))
    parts = items.groupBy(key, "_salt").agg(F.min("rank").alias("rank"), F.count(item).alias("n"), F.array_distinct(F.flatten(F.collect_set("flags"))).alias("flags"), F.min("first").alias("first"), F.max("last").alias("last"))
    flags = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("flags")))), "; ")
    return parts.groupBy(key).agg(F.min("rank").alias("best_rank"), F.sum("n").alias("items"), flags.alias("flags"), F.min("first").alias("first_day"), F.max("last").alias("last_day"))
