"""Decisions about records from scores and answers: to which event an article goes, and what a pair of models agrees on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Thresholds of the representative's similarity, of the pair model and of the verifier.
ASK_STRONG, ASK_SIMILARITY, ASK_MODEL = 0.60, 0.68, 0.30
MERGE_SIMILARITY, MERGE_MODEL, MERGE_CONFIDENCE = 0.70, 0.55, 0.90
TOKEN_MODEL, TOKEN_CONFIDENCE = 0.35, 0.88
MARGIN = 0.035
#: The reasons for a review.
NOT_MET = "Qwen identifies a possible same event, but auto-merge thresholds are not met"
PLAUSIBLE = "more than one event remains plausible"
UNCLEAR = "Qwen is unclear despite meaningful candidate-event evidence"
CONFLICT = "exceptionally strong non-LLM evidence conflicts with Qwen not-same decision"


def flag(test: Column) -> Column:
    """The test, false where it is unknown."""
    return F.coalesce(test, F.lit(False))


def must_ask(best: Column, model: Column, token: Column) -> Column:
    """Is there evidence enough of a match to ask the verifier at all?"""
    return flag(token) | flag(model >= ASK_STRONG) | flag((best >= ASK_SIMILARITY) & (model >= ASK_MODEL))


def resolved(rows: DataFrame) -> DataFrame:
    """rows, all columns, with asked, competing, decision, requires_review and review_reason.

    rows have assigned (an event already given, or null), best and second (similarities of the two best candidate events, null
    without one), model (the pair model's best score), token (a story token is shared), relationship and confidence (the
    verifier's answer, which counts only if it had to be asked).

    An article keeps an event it has. Without a candidate it is a new event. It merges if the verifier says same_event, no other candidate
    is within MARGIN, and either all three scores reach their limits or a shared token goes with the lower ones. Else it is a new
    event, which is reviewed if the verifier says same_event, is unclear despite evidence, or denies very strong evidence.
    """
    asked = F.col("best").isNotNull() & F.col("assigned").isNull() & must_ask(F.col("best"), F.col("model"), F.col("token"))
    rows = rows.withColumn("asked", asked).withColumn("competing", flag(F.col("best") - F.col("second") < MARGIN))
    says = F.when(F.col("asked"), F.col("relationship"))
    token, best, model = flag(F.col("token")), F.col("best"), F.col("model")
    by_scores = flag((best >= MERGE_SIMILARITY) & (model >= MERGE_MODEL) & (F.col("confidence") >= MERGE_CONFIDENCE))
    by_token = token & flag((model >= TOKEN_MODEL) & (F.col("confidence") >= TOKEN_CONFIDENCE))
    merges = flag(says == "same_event") & ~F.col("competing") & (by_scores | by_token)
    unclear = flag(says == "unclear") & (token | flag(best >= 0.72) | flag(model >= 0.55))
    denied = flag(says == "not_same_event") & ((token & flag(model >= 0.60)) | flag((best >= 0.82) & (model >= 0.70)))
    same = flag(says == "same_event") & ~merges
    reasons = F.array(F.when(same, NOT_MET), F.when(same & F.col("competing"), PLAUSIBLE), F.when(unclear, UNCLEAR), F.when(denied, CONFLICT))
    reasons = F.filter(reasons, lambda r: r.isNotNull())
    decision = F.when(F.col("assigned").isNotNull(), "existing_assignment").when(best.isNull(), "new_event").when(merges, "auto_merge").when(F.size(reasons) > 0, "review").otherwise("new_event")
    rows = rows.withColumn("decision", decision).withColumn("requires_review", F.col("decision") == "review")
    return rows.withColumn("review_reason", F.when(F.col("requires_review"), F.array_join(reasons, "; ")))


def ensemble(model: Column, day_gap: Column, relationship: Column, decay: float = 0.20, threshold: float = 0.45) -> tuple[Column, Column]:
    """(the model's score after decay by days, what it and the verifier agree on: same_event, not_same, else review)."""
    adjusted = model * F.exp(-decay * day_gap)
    model_same, verifier_same = flag(adjusted >= threshold), flag(relationship == "same_event")
    return adjusted, F.when(model_same & verifier_same, "same_event").when(~model_same & ~verifier_same, "not_same").otherwise("review")
