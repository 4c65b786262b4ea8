"""Indices, shares and readiness over scored units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def index(score: Column, ai_relevant: Column, digits: int = 4) -> Column:
    """Mean score times 100 over relevant units with a score; null without any."""
    return F.round(F.avg(F.when(ai_relevant & score.isNotNull(), score)) * 100, digits)


def unit_counts() -> list[Column]:
    """How many units there are, are relevant, and are scored, from columns ai_relevant and score."""
    relevant = F.col("ai_relevant")
    return [
        F.count(F.lit(1)).alias("units"),
        F.count(F.when(relevant, 1)).alias("relevant"),
        F.count(F.when(relevant & F.col("score").isNotNull(), 1)).alias("scored"),
    ]


def dense_shares(df: DataFrame, column: str, domain: tuple[str, ...], digits: int = 4) -> DataFrame:
    """(label, n, share) for every label of the domain, 0 where none occurs, of all rows of df."""
    counts = df.agg(F.count(F.lit(1)).alias("all"), *[F.count(F.when(F.col(column) == d, 1)).alias(f"n{i}") for i, d in enumerate(domain)])
    rows = F.explode(F.array(*[F.struct(F.lit(d).alias("label"), F.col(f"n{i}").alias("n")) for i, d in enumerate(domain)]))
    share = F.when(F.col("all") > 0, F.round(F.col("x.n") / F.col("all"), digits)).otherwise(0.0)
    return counts.select("all", rows.alias("x")).select("x.label", "x.n", share.alias("share"))


def sparse_shares(df: DataFrame, column: str, default: str = "unclear", digits: int = 4) -> DataFrame:
    """(label, n, share) of the labels that occur; null and empty count as default."""
    label = F.when(F.coalesce(F.col(column), F.lit("")) == "", default).otherwise(F.col(column))
    counts = df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("all"))
    return counts.join(F.broadcast(total)).select("label", "n", F.round(F.col("n") / F.col("all"), digits).alias("share"))


def amplification(by_lens: DataFrame) -> DataFrame:
    """From rows (lens, idx, n) of coverage and event: gap of the indices and ratio of the counts, null where undefined."""
    pick = lambda lens, c: F.max(F.when(F.col("lens") == lens, F.col(c)))
    one = by_lens.agg(pick("coverage", "idx").alias("coverage_index"), pick("event", "idx").alias("event_index"), pick("coverage", "n").alias("articles"), pick("event", "n").alias("events"))
    gap = F.round(F.col("coverage_index") - F.col("event_index"), 4)
    ratio = F.round(F.col("articles") / F.nullif(F.col("events"), F.lit(0)), 4)
    return one.select("*", gap.alias("gap"), ratio.alias("ratio"))
