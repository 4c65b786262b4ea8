"""Gates: rules over rows as a table of expressions, counted in one pass, with their violators by name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where `broken` is true or unknown; `weight` says how many violations that is."""

    name: str
    broken: Column
    weight: Column = field(default_factory=lambda: F.lit(1))

    def __post_init__(self) -> None:
        object.__setattr__(self, "broken", F.coalesce(self.broken, F.lit(True)))


def counted(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """(gate, violations) of each rule, all by one aggregation over rows; without rows there are no violations."""
    sums = rows.agg(*[F.coalesce(F.sum(F.when(r.broken, r.weight)), F.lit(0)).cast("long").alias(f"r{i}") for i, r in enumerate(rules)])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(r.name).alias("gate"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(rules)])).alias("x")).select("x.*")


def broken_rules(rules: list[Rule]) -> Column:
    """Names of the rules that a row breaks, in the order of rules."""
    return F.filter(F.array(*[F.when(r.broken, r.name) for r in rules]), lambda n: n.isNotNull())


def violators(rows: DataFrame, keys: list[str], rules: list[Rule]) -> DataFrame:
    """(keys, gate): each row once for every rule that it breaks."""
    return rows.select(*keys, F.explode(broken_rules(rules)).alias("gate"))


def quarantined(rows: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that break no rule, the others with the names of their broken rules in `gates`)."""
    marked = rows.withColumn("gates", broken_rules(rules))
    return marked.filter(F.size("gates") == 0).drop("gates"), marked.filter(F.size("gates") > 0)


def passed(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """rows, if all counts of violations are zero; else running it fails and names the gates."""
    bad = counts.agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("violations") > 0, F.concat("gate", F.lit(": "), F.col("violations").cast("string"))))), ", ").alias("_bad"))
    ok = bad.select(F.when(F.col("_bad") == "", True).otherwise(F.raise_error(F.concat(F.lit("gates failed: "), F.col("_bad"))).cast("boolean")).alias("_ok"))
    return rows.join(F.broadcast(ok), F.col("_ok")).drop("_ok")
