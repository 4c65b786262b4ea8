"""Rules about headlines and their English renderings: language, faults, audits, difficulty, and scores of pairs for review."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwright.functions.nested import bound
from loomwright.functions.text import has_han, numbers_in, search_language

#: How sure a detector must be, how alike two renderings, and the probability from which a pair model says same.
SURE, ALIKE, SAME = 0.65, 0.86, 0.45
#: Points for each trait of a headline that is hard to translate.
HARD_FLAG, HARD_PATTERN, HARD_DIGIT, HARD_MARK, HARD_LONG, HARD_CHINESE = 100, 40, 5, 4, 3, 2
HARD_MARKS = '"“”«»：—丨'
#: Signs that plain text writes otherwise, and names of languages.
PLAIN = {"–": "-", "—": "-", "’": "'", "“": '"', "”": '"'}
LANGUAGE_NAMES = {"fr": "French", "zh": "Chinese"}


def kept(reasons: Column) -> Column:
    return F.filter(reasons, lambda r: r.isNotNull())


def language_of(headline: Column, detected: Column, confidence: Column, observed: Column) -> Column:
    """struct(language, method, requires_review, reason): by script, by agreement with the one language searched in, by a sure detector, else for review.

    observed holds the languages of all searches; only if they come to one is it a hint. A null confidence is not sure.
    """
    hints = F.array_distinct(F.filter(F.transform(F.coalesce(observed, F.array().cast("array<string>")), search_language), lambda v: v != ""))
    hint = F.when(F.size(hints) == 1, F.get(hints, F.lit(0)))
    sure = F.coalesce(confidence >= SURE, F.lit(False))
    agrees = F.coalesce(hint == detected, F.lit(False))
    make = lambda language, method, reason: F.struct(language.alias("language"), F.lit(method).alias("method"), F.lit(reason is not None).alias("requires_review"), (F.lit("") if reason is None else reason).alias("reason"))
    override = F.concat(F.lit("low-confidence '"), F.coalesce(detected, F.lit("und")), F.lit("' overridden by '"), hint, F.lit("'"))
    unsure = F.when(F.length(detected) == 2, detected).otherwise("un")
    out = F.when(has_han(headline), make(F.lit("zh"), "han_script+lingua", None)).when(agrees, make(detected, "lingua+search_language", None)).when(sure, make(detected, "lingua", None))
    return out.when(hint.isNotNull(), make(hint, "search_language_override", override)).otherwise(make(unsure, "lingua", F.lit("uncertain source language")))


def rendering_faults(language: Column, original: Column, english: Column) -> Column:
    """Why an English rendering needs review, in order."""
    english, original = F.coalesce(english, F.lit("")), F.coalesce(original, F.lit(""))
    missing = F.filter(numbers_in(original), lambda n: ~F.contains(english, n))
    return kept(F.array(
        F.when(F.trim(english) == "", "empty translation"),
        F.when((language != "en") & (F.trim(english) == F.trim(original)), "translation identical to non-English source"),
        F.when(has_han(english), "Han characters remain in English normalization"),
        F.when(F.size(missing) > 0, F.concat(F.lit("numeric information not preserved: "), F.array_join(missing, ", "))),
    ))


def audit_faults(similarity: Column, first: Column, second: Column, original: Column) -> Column:
    """Why a second model's rendering of a Chinese headline speaks against the first one, in order."""
    return kept(F.array(
        F.when(F.coalesce(similarity < ALIKE, F.lit(True)), "cross-model semantic disagreement"),
        F.when(numbers_in(first) != numbers_in(second), "cross-model numeric disagreement"),
        F.when(has_han(second), "Han characters remain in audit translation"),
        F.when(F.coalesce(F.trim(second) == F.trim(original), F.lit(False)), "audit translation identical to Chinese source"),
    ))


def difficulty(headline: Column, review: Column, language: Column, patterns: tuple[str, ...] = ()) -> Column:
    """How hard a headline is to translate: flagged, with one of the patterns, with digits or marks, long, Chinese."""
    points = lambda test, n: F.when(test, n).otherwise(0)
    out = points(review, HARD_FLAG) + points(headline.rlike(r"\d"), HARD_DIGIT) + points(headline.rlike(f"[{HARD_MARKS}]"), HARD_MARK)
    out = out + points(F.length(headline) >= 70, HARD_LONG) + points(language == "zh", HARD_CHINESE)
    for pattern in patterns:
        out = out + points(F.contains(F.lower(headline), F.lit(pattern.lower())), HARD_PATTERN)
    return out


def information(base: Column, similarity: Column, probability: Column, verdict: Column, same_cluster: Column, cross_language: Column, token: Column) -> Column:
    """struct(score, reasons): what a reviewer's answer about a pair would tell, after a model's and a verifier's verdicts; reasons are sorted."""
    model_same = F.coalesce(probability >= SAME, F.lit(False))
    verifier_same, verifier_not = verdict == "same_event", verdict == "not_same_event"
    unclear = verdict == "unclear"
    differs = ~unclear & (verifier_same != model_same)
    against = (similarity >= 0.78) & (~model_same | verifier_not)
    despite = (similarity < 0.78) & (model_same | verifier_same)
    conflict = (same_cluster & ~model_same & (verifier_not | unclear)) | (~same_cluster & model_same & verifier_same)
    points = lambda test, n: F.when(test, n).otherwise(0.0)
    score = base + points(unclear, 6.0) + points(differs, 7.0) + points(against, 4.0) + points(despite, 4.0) + points(conflict, 5.0)
    reasons = [
        (unclear | differs, "model_disagreement"), (against, "high_similarity_not_same"), (despite, "low_similarity_same"), (cross_language, "cross_language"),
        (token, "story_token_match"), (conflict, "cluster_conflict"),
    ]
    return F.struct(score.alias("score"), F.array_sort(kept(F.array(*[F.when(test, name) for test, name in reasons]))).alias("reasons"))


def positives_first(probability: str, verdict: str, cross_language: str, similarity: str, confidence: str, pair: str) -> list[Column]:
    """An order of pairs: agreed positives, across languages, of low similarity, then by the verifier's and the model's certainty."""
    agreed = (F.col(probability) >= SAME) & (F.col(verdict) == "same_event")
    first = lambda test: F.when(test, 0).otherwise(1)
    return [first(agreed), first(F.col(cross_language)), first(F.col(similarity) < 0.78), F.desc(confidence), F.desc(probability), F.asc(similarity), F.asc(pair)]


@functools.cache
def ascii_forms() -> dict[str, str]:
    """What the ASCII form of each other character is, if it has one: its compatibility decomposition without what is not ASCII."""
    forms = {c: unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode() for c in map(chr, range(128, sys.maxunicode + 1)) if not "\ud800" <= c <= "\udfff"}
    return {c: f for c, f in forms.items() if f} | PLAIN


def ascii_text(value: Column) -> Column:
    """A text in ASCII: dashes and quotes become plain, letters lose their marks, other signs go; null is empty.

    A character's form does not depend on its neighbours, so no text leaves the JVM.
    """
    one = {c: f for c, f in ascii_forms().items() if len(f) == 1}
    several = {c: f for c, f in ascii_forms().items() if len(f) > 1}
    other = r"[^\x00-\x7f]"
    forms = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])

    def spread(text: Column) -> Column:
        # Distinct signs are looked up, as a class of all of them would be tried sign by sign at each place.
        found = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(other), F.lit(0))), lambda c: F.element_at(forms, c).isNotNull())
        return F.aggregate(found, text, lambda out, c: F.replace(out, c, F.element_at(forms, c)))

    plain = bound(F.translate(value, "".join(one), "".join(one.values())), spread)
    return F.coalesce(F.when(value.rlike(other), F.regexp_replace(plain, other, "")).otherwise(value), F.lit(""))


def language_name(code: Column) -> Column:
    out = F.when(F.lit(False), "")
    for short, name in LANGUAGE_NAMES.items():
        out = out.when(code == short, name)
    return out.otherwise(code)


def date_label(start: Column, end: Column) -> Column:
    """A period's days, such as 3 Jan 2024 - 9 Jan 2024."""
    return F.coalesce(F.concat(F.date_format(start, "d MMM yyyy"), F.lit(" - "), F.date_format(end, "d MMM yyyy")), F.lit("Current observation window"))


def source_name(item: Column) -> Column:
    """The name of an item's source, which is a text, or an object with a name or title; blanks become one space."""
    inside = F.try_variant_get(item, "$.source", "map<string,variant>")
    text = lambda k: F.nullif(F.try_variant_get(inside[k], "$", "string"), F.lit(""))
    name = F.when(inside.isNotNull(), F.coalesce(text("name"), text("title"))).otherwise(F.try_variant_get(item, "$.source", "string"))
    return F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s+", " "))


#: The fields of a release's summary, where they stand, and what stands for a missing count.
SUMMARY = [
    ("release_id", "$.release_id", "string", None), ("release_type", "$.release_type", "string", None), ("period_start", "$.period_start", "string", None),
    ("period_end", "$.period_end", "string", None), ("generated_at", "$.generated_at", "string", None), ("articles", "$.counts.ai_relevant_articles", "long", 0),
    ("event_records", "$.counts.ai_relevant_event_records", "long", 0), ("new_event_records", "$.counts.new_event_records", "long", 0),
    ("recurring_event_records", "$.counts.recurring_event_records", "long", 0), ("extra_coverage", "$.counts.extra_coverage", "long", 0),
    ("coverage_index", "$.lenses.coverage.empowerment_index", "double", None), ("event_index", "$.lenses.event.empowerment_index", "double", None),
    ("amplification_gap", "$.amplification.directional_gap", "double", None), ("audit_status", "$.reliability.governance.audit_status", "string", None),
    ("validation_status", "$.reliability.validation_status", "string", None),
]


def release_summary(release: Column) -> list[Column]:
    """The flat columns of a nested release, which is a variant; a missing count is 0, other missing fields are null."""
    field = lambda path, kind, default: F.try_variant_get(release, path, kind) if default is None else F.coalesce(F.try_variant_get(release, path, kind), F.lit(default).cast(kind))
    return [field(path, kind, default).alias(name) for name, path, kind, default in SUMMARY]
