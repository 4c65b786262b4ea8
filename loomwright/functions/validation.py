"""Validation of a model's answer about a unit: every field has a legal value, or a named issue, or the answer is refused with a fault."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.functions.labels import DIRECTIONAL, STATUSES, unit_score
from loomwright.functions.nested import with_once

#: What the fields of an answer may hold.
FRAMES = ("opportunity", "threat", "contested", "descriptive_neutral", "unclear")
BREADTHS = ("broad", "targeted", "concentrated", "unclear")
DIMENSIONS = ("agentic", "creative", "normative", "operational")
DIRECTIONS = ("expanding", "contracting", "mixed", "unclear")
AUTHORITIES = ("increasing", "decreasing", "unchanged", "unclear")
TOPICS = (
    "work_employment", "business_productivity", "consumer_services", "creativity_ip", "education_research", "healthcare",
    "government_regulation", "privacy_security", "infrastructure_investment", "other",
)
SCOPES = ("country", "multi_country", "global", "unclear")

OBJECT = "map<string,variant>"


def opened(value: Column) -> Column:
    """The fields of an object in a variant; an empty map if it is something else."""
    return F.coalesce(F.try_variant_get(value, "$", OBJECT), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>")))


def written(value: Column) -> Column:
    """A value as text, null for JSON's null."""
    return F.try_variant_get(value, "$", "string")


class Field(NamedTuple):
    """A field's value, a variant, and what is read off it once: its text and its kind."""

    value: Column
    text: Column
    kind: Column


def read(values: dict[str, Column]) -> dict[str, Column]:
    """Columns for the fields of values by name; a step of their own computes them once, however often rules look at them."""
    return {k: c for name, v in values.items() for k, c in ((f"_{name}_value", v), (f"_{name}_text", written(v)), (f"_{name}_kind", F.schema_of_variant(v)))}


def field(name: str) -> Field:
    """One of the fields that read() has made columns of."""
    return Field(*[F.col(f"_{name}_{part}") for part in ("value", "text", "kind")])


def filled(f: Field) -> Column:
    """Is a value there, and neither null, empty, zero nor false?"""
    nothing = f.text.isin("[]", "{}", "false") | F.coalesce(f.text.try_cast("double") == 0, F.lit(False))
    return F.coalesce((f.text != "") & ((f.kind == "STRING") | ~nothing), F.lit(False))


def choice(f: Field, legal: tuple[str, ...], default: str) -> tuple[Column, Column]:
    """(a legal text, was another one given); what is missing or empty is the default without fault."""
    given = F.trim(F.when(filled(f), f.text).otherwise(default))
    return F.when(given.isin(*legal), given).otherwise(default), ~F.coalesce(given.isin(*legal), F.lit(False))


def whole(f: Field) -> Column:
    """A whole number: of a number its whole part, of a text only if it is one; null if there is none."""
    digits = F.when(f.text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(f.text).try_cast("long"))
    return F.when(f.kind == "STRING", digits).when(f.kind == "BOOLEAN", (f.text == "true").cast("long")).otherwise(F.try_variant_get(f.value, "$", "double").try_cast("long"))


def between(number: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), number)).cast("int")


def confidence_fault(f: Field, name: str) -> Column:
    """Why a confidence can't be taken: it is missing, no number, or not from 0 to 1."""
    number = F.try_variant_get(f.value, "$", "double")
    return F.when(f.text.isNull(), f"{name} missing").when(number.isNull(), f"{name} not a number").when(~number.between(0, 1), f"{name} out of range")


def iso3s(values: Column) -> Column:
    """Three-letter codes of a list of variants, in upper case and each once; of null none."""
    codes = F.transform(values, lambda v: F.upper(F.regexp_replace(F.coalesce(written(v), F.lit("")), "[^A-Za-z]", "")))
    return F.coalesce(F.array_distinct(F.filter(codes, lambda c: F.length(c) == 3)), F.array().cast("array<string>"))


#: The fields of a dimension, and those of an answer that are read as they are.
PARTS = ("present", "direction", "degree", "confidence", "reasoning")
FIELDS = (
    "empowerment_status", "narrative_frame", "distribution_breadth", "ai_authority_shift", "topic", "geographic_scope", "empowerment_degree", "ai_relevant", "dominant_dimension", "confidence",
    "reasoning",
)


def dimension(name: str) -> Column:
    """(present, direction, degree, confidence, reasoning, fault) of one dimension."""
    item = {part: field(f"{name}_{part}") for part in PARTS}
    present = filled(item["present"])
    direction = F.trim(item["direction"].text)
    degree = F.when(item["degree"].value.isNull(), F.lit(1)).otherwise(whole(item["degree"]))
    fault = F.when(present & (direction == "not_present"), f"{name} present without direction")
    fault = fault.when(present & ~F.coalesce(direction.isin(*DIRECTIONS), F.lit(False)), f"{name} direction invalid").when(present & degree.isNull(), f"{name} degree invalid")
    return F.struct(
        present.alias("present"), F.when(present, direction).alias("direction"), F.when(present, between(degree, 1, 3)).otherwise(0).alias("degree"),
        F.try_variant_get(item["confidence"].value, "$", "double").alias("confidence"), F.substring(F.trim(F.coalesce(F.when(filled(item["reasoning"]), item["reasoning"].text), F.lit(""))), 1, 1500).alias("reasoning"),
        F.coalesce(fault, confidence_fault(item["confidence"], f"{name} confidence")).alias("fault"),
    )


def validated(rows: DataFrame, answer: str) -> DataFrame:
    """rows, all columns, with the fields of the JSON object in `answer` in legal form, `issues`, and `fault`.

    Issues name what was replaced by a default, in the order of the fields; they, and an unclear status, ask for review.
    A fault refuses the whole answer: its first one is named and all fields are null. It is one if the answer is no
    object, the dominant dimension is unknown, a confidence is missing or not from 0 to 1, or a present dimension has no legal direction or degree.
    rows must not have columns named as these fields.
    """
    own = rows.columns
    a = rows.withColumn("_a", F.try_variant_get(F.try_parse_json(answer), "$", OBJECT))
    held = F.try_variant_get(F.col("_a")["country_iso3s"], "$", "array<variant>")
    a = a.withColumns(read({name: F.col("_a")[name] for name in FIELDS}) | {"_held": held, "_dims": opened(F.col("_a")["dimensions"])})
    a = a.withColumns({f"_{d}_object": opened(F.col("_dims")[d]) for d in DIMENSIONS})
    a = a.withColumns(read({f"{d}_{part}": F.col(f"_{d}_object")[part] for d in DIMENSIONS for part in PARTS}))
    parts = {
        "_status": choice(field("empowerment_status"), STATUSES, "unclear"), "_frame": choice(field("narrative_frame"), FRAMES, "unclear"),
        "_breadth": choice(field("distribution_breadth"), BREADTHS, "unclear"), "_authority": choice(field("ai_authority_shift"), AUTHORITIES, "unclear"),
        "_topic": choice(field("topic"), TOPICS, "other"), "_scope": choice(field("geographic_scope"), SCOPES, "unclear"),
    }
    columns = {k: v for k, (v, _) in parts.items()} | {f"{k}_odd": odd for k, (_, odd) in parts.items()}
    columns["_given"] = F.when(field("empowerment_degree").value.isNull() & ~F.map_contains_key("_a", F.lit("empowerment_degree")), F.lit(0)).otherwise(whole(field("empowerment_degree")))
    columns["_relevant"] = ~F.map_contains_key("_a", F.lit("ai_relevant")) | filled(field("ai_relevant"))
    columns["_dominant"] = F.trim(F.when(filled(field("dominant_dimension")), field("dominant_dimension").text).otherwise("none"))
    columns["_codes"] = iso3s(F.col("_held"))
    columns["_confidence"] = F.try_variant_get(field("confidence").value, "$", "double")
    columns["_reasoning"] = F.substring(F.trim(F.coalesce(F.when(filled(field("reasoning")), field("reasoning").text), F.lit(""))), 1, 3000)
    columns["_sure"] = confidence_fault(field("confidence"), "overall confidence")
    a = a.withColumns(columns | {f"_{d}": dimension(d) for d in DIMENSIONS})
    faults = [F.when(F.col("_a").isNull(), "no object"), F.when(~F.col("_dominant").isin("none", *DIMENSIONS), "dominant dimension unknown"), F.col("_sure")]
    a = with_once(a, fault=F.coalesce(*faults, *[F.col(f"_{d}.fault") for d in DIMENSIONS]))

    directional = F.col("_status").isin(*DIRECTIONAL)
    degree = between(F.coalesce("_given", F.lit(0)), 0, 3)
    none = F.col("_status") == "non_empowerment"
    codes = F.when(F.col("_scope") == "global", F.slice("_codes", 1, 0)).when(F.col("_scope") == "country", F.slice("_codes", 1, 1)).otherwise(F.col("_codes"))
    homeless = F.col("_scope").isin("country", "multi_country") & (F.size(codes) == 0)
    is_present = lambda d: F.col(f"_{d}.present") & ~none
    dominant = F.when((F.col("_dominant") != "none") & ~none, F.col("_dominant"))
    shown = reduce(lambda out, d: F.when(dominant == d, is_present(d)).otherwise(out), DIMENSIONS, F.lit(True))
    issues = F.array(
        F.when(F.col("_status_odd"), "status invalid"), F.when(F.col("_given").isNull(), "degree invalid"), F.when(directional & (degree == 0), "degree raised from 0 to 1"),
        F.when(F.col("_frame_odd"), "frame invalid"), F.when(F.col("_breadth_odd"), "breadth invalid"), F.when(F.col("_authority_odd"), "authority invalid"),
        F.when(F.col("_topic_odd"), "topic invalid"), F.when(F.col("_scope_odd"), "scope invalid"), F.when(homeless, "scope without country"),
        *[F.when(none & F.col(f"_{d}.present"), "present dimension without empowerment") for d in DIMENSIONS], F.when(dominant.isNotNull() & ~shown, "dominant dimension not present"),
    )
    a = a.withColumn("_issues", F.filter(issues, lambda r: r.isNotNull()))
    final_degree = F.when(~directional, 0).when(degree == 0, 1).otherwise(degree)
    cleared = lambda d: F.struct(
        is_present(d).alias("present"), F.when(~none, F.col(f"_{d}.direction")).alias("direction"), F.when(none, 0).otherwise(F.col(f"_{d}.degree")).alias("degree"),
        F.col(f"_{d}.confidence").alias("confidence"), F.col(f"_{d}.reasoning").alias("reasoning"),
    )
    unclear = F.col("_status") == "unclear"
    reasons = F.concat("_issues", F.when(unclear, F.array(F.lit("empowerment status unclear"))).otherwise(F.array().cast("array<string>")))
    out = {
        "ai_relevant": F.col("_relevant"), "status": F.col("_status"), "degree": final_degree, "unit_score": unit_score(F.col("_status"), final_degree), "frame": F.col("_frame"),
        "breadth": F.col("_breadth"), "dominant": F.when(shown, dominant), "authority": F.col("_authority"), "topic": F.col("_topic"),
        "scope": F.when(homeless, "unclear").otherwise(F.col("_scope")), "countries": codes, "primary_country": F.get(codes, F.lit(0)), "confidence": F.col("_confidence"),
        "reasoning": F.col("_reasoning"), **{d: cleared(d) for d in DIMENSIONS}, "issues": F.col("_issues"), "requires_review": unclear | (F.size("_issues") > 0),
        "review_reason": F.array_join(F.array_distinct(reasons), "; "),
    }
    return a.select(*own, *[F.when(F.col("fault").isNull(), c).alias(name) for name, c in out.items()], "fault")
