"""Rules over labels of units: scores, validation, review reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The states a unit's label may have.
STATUSES = ("expanding", "contracting", "mixed", "non_empowerment", "unclear")
DIRECTIONAL = ("expanding", "contracting", "mixed")


def unit_score(status: Column, degree: Column) -> Column:
    """A third of the degree, signed by direction; 0 for mixed and for none, null if unclear."""
    third = F.round(degree / F.lit(3.0), 6)
    return F.when(status == "expanding", third).when(status == "contracting", -third).when(status.isin("mixed", "non_empowerment"), 0.0)


def validated(rows: DataFrame) -> DataFrame:
    """rows (status, degree, dominant and others) with clamped, defaulted and consistent labels, `issues` and `requires_review`.

    An unknown or missing status is unclear; degrees lie in 0 to 3, are 0 without a direction and at least 1 with one;
    dominant 'none' is null.
    """
    status = F.when(F.col("status").isin(*STATUSES), F.col("status")).otherwise("unclear")
    rows = rows.withColumn("_status", status).withColumn("_degree", F.greatest(F.lit(0), F.least(F.lit(3), F.coalesce("degree", F.lit(0)))))
    directional = F.col("_status").isin(*DIRECTIONAL)
    degree = F.when(~directional, 0).when(F.col("_degree") == 0, 1).otherwise(F.col("_degree"))
    issues = F.array(
        F.when(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)), "unknown status"),
        F.when(directional & (F.col("_degree") == 0), "direction without degree"),
        F.when(F.coalesce(F.col("degree"), F.lit(0)) != F.col("_degree"), "degree out of range"),
    )
    rows = rows.withColumn("issues", F.filter(issues, lambda r: r.isNotNull())).withColumn("degree", degree.cast("int")).withColumn("status", F.col("_status"))
    rows = rows.withColumn("dominant", F.when(F.col("dominant") != "none", F.col("dominant")))
    return rows.withColumn("requires_review", (F.col("status") == "unclear") | (F.size("issues") > 0)).drop("_status", "_degree")


def review_reasons(status: Column, degree: Column, score: Column, ai_relevant: Column, present: Column, dominant_known: Column, dominant_present: Column) -> Column:
    """Contradictions within a label, as an array in fixed order."""
    # The texts of the nine reasons.
    reasons = F.array(
        F.when(status == "unclear", "empowerment status unclear"),
        F.when(status.isin(*DIRECTIONAL) & (degree == 0), "directional empowerment has degree 0"),
        F.when(~status.isin(*DIRECTIONAL) & (degree != 0), "non-scored status has non-zero degree"),
        F.when((status == "non_empowerment") & present, "non-empowerment classification contains present dimensions"),
        F.when(~dominant_known, "dominant dimension is absent from dimension data").when(~dominant_present, "dominant dimension is not marked present"),
        F.when(score.isNull() & (status != "unclear"), "scored status has null unit score"),
        F.when(score.isNotNull() & (status == "unclear"), "unclear status has a numeric unit score"),
        F.when(~ai_relevant & status.isin(*DIRECTIONAL), "AI-irrelevant unit has a directional empowerment classification"),
    )
    return F.filter(reasons, lambda r: r.isNotNull())


def residual_status(status: Column, degree: Column, present: Column, dominant: Column) -> Column:
    """Unclear units that show nothing at all count as having no effect."""
    nothing = (status == "unclear") & (degree == 0) & ~present & dominant.isNull()
    return F.when(nothing, "non_empowerment").otherwise(status)


def confidence(value: Column) -> tuple[Column, Column]:
    """(a number from 0 to 1 or null, why it is null)."""
    number = value.try_cast("double")
    inside = number.between(0, 1)
    fault = F.when(value.isNull(), "missing").when(number.isNull(), "not a number").when(~inside, "out of range")
    return F.when(inside, number), fault


def governance(status: Column) -> Column:
    """The public label of a release by the state of its audit; unknown states are pending."""
    # The states of an audit and their public labels.
    return F.when(status == "complete", "Human-audited public release").when(status == "waived_with_disclosure", "Human-governed release; audit exception disclosed").otherwise("Model-coded, human-governed pilot release")


def binary(column: str, positive: object = 1) -> Column:
    return F.when(F.col(column) == F.lit(positive), 1).otherwise(0)
