"""Exact dedup by a tree-merge of digest runs, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import saved

#: What a text is known by: its SHA-256, and two more facts that a class must agree on.
KEY = ["sha", "n_bytes", "check"]


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_runs(docs: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    """(id, sha, n_bytes, check, run) of every row: the leaves of the merge tree.

    The run comes from the id, so that the copies of one hot text lie in all runs alike.
    """
    text = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    return text.select(
        "id",
        F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.octet_length("norm").cast("long").alias("n_bytes"),
        F.xxhash64("norm").alias("check"),
        F.pmod(F.xxhash64("id", F.lit("run")), F.lit(runs)).cast("int").alias("run"),
    )


def merge_round(runs: DataFrame, fan_in: int) -> DataFrame:
    """Merge each fan_in neighbouring runs into one, keeping the smallest id and the size of each digest."""
    return (
        runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        .groupBy(*KEY, "run")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("size").alias("size"))
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8, rounds: int = 3
) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256.

    Leaves are fan_in ** rounds runs of digests. In each round fan_in neighbouring runs exchange what they
    hold by digest and merge to one, so a text with a third of all rows is reduced a little in every round and
    no task ever gets its rows together. Then the verdict goes down the tree: from the last run to the
    leaves (at most one row per run and text), from the leaves to the rows. A class must agree on
    SHA-256, byte length and XXH64, not on one digest alone.

    Null text counts as empty. Rows with the same id and text are one document and share its verdict. A null
    id never stays if its class has another id; a class of null ids alone has keep_id null and keeps all.
    Other columns of docs are left out, whatever their names.
    """
    leaves = saved(digest_runs(docs, id_col, text_col, fan_in**rounds))
    first = leaves.groupBy(*KEY, "run").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("size"))
    last = reduce(lambda runs, _: merge_round(runs, fan_in), range(rounds), first)
    verdict = first.select(*KEY, "run").join(last.select(*KEY, "keep_id", F.col("size").alias("group_size")), KEY)
    return leaves.join(verdict, [*KEY, "run"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
