"""Newest, best and first rows of groups, and samples by hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each key in the given total order; rank names a column for their place.

    Spark limits each group before the shuffle, so a hot key sends n rows a task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = df.withColumn(rank or "_place", place).filter(F.col(rank or "_place") <= n)
    return out if rank else out.drop("_place")


def hash_order(column: str) -> Column:
    """An order that looks random and is the same everywhere."""
    return F.sha2(F.col(column).cast("string"), 256)


def competing(df: DataFrame, key: str, score: str, margin: float) -> DataFrame:
    """Per key the two best scores and whether they are within margin."""
    two = top_per_key(df.select(key, score), [key], [F.desc(score)], 2)
    best = two.groupBy(key).agg(F.sort_array(F.collect_list(score), asc=False).alias("_two"))
    return best.select(key, F.col("_two")[0].alias("best"), F.get("_two", F.lit(1)).alias("second")).withColumn("competing", F.coalesce(F.col("best") - F.col("second") < margin, F.lit(False)))
