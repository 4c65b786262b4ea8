"""Records of items, their sources' strata, labels passed on, and what a report says about numbers."""

from __future__ import annotations

import functools
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import text
from loomwright.functions.nested import bound, with_once
from loomwright.functions.translation import source_name

#: Fixed value: the note on a label that the residual rule has settled.
RESIDUAL_NOTE = (
    "Deterministic codebook normalization: no supported human empowerment dimension was identified, so the residual category is "
    "non-empowerment rather than unclear."
)
#: The fields that an event of one article takes from that article's label.
COPIED = (
    "ai_relevant", "status", "degree", "unit_score", "frame", "breadth", "dominant", "agentic", "creative", "normative", "operational", "authority", "topic", "scope", "countries", "primary_country",
    "confidence", "reasoning", "requires_review", "review_reason",
)


@functools.cache
def folds() -> dict[str, str]:
    """Characters whose case folding is not their lower case, by Unicode's rules in Python."""
    return {c: c.casefold() for c in map(chr, range(sys.maxunicode + 1)) if not "\ud800" <= c <= "\udfff" and c.casefold() != c.lower()}


def casefold(value: Column) -> Column:
    """A text for comparison without case: lower case, and what only folding makes equal, such as ss for ß."""
    one = {c: f for c, f in folds().items() if len(f) == 1}
    several = {c: f for c, f in folds().items() if len(f) > 1}
    odd = "[" + "".join(folds()) + "]"

    def folded(lower: Column) -> Column:
        out = F.translate(lower, "".join(one), "".join(one.values()))
        for c, f in several.items():
            out = F.replace(out, F.lit(c), F.lit(f))
        # Few texts have such characters; the others pay for one search.
        return F.when(lower.rlike(odd), out).otherwise(lower)

    return bound(F.lower(value), folded)


def normalised(items: DataFrame, item: str, market: dict[str, Column], rank: Column, collected_at: Column) -> DataFrame:
    """The 20 fields of each item, a variant, that has a title and a link; blank fields are null or have their default."""
    field = lambda k: text.normalize_space(F.try_variant_get(F.col(item), f"$.{k}", "string"))
    blank = lambda c: F.nullif(c, F.lit(""))
    rows = with_once(items, _title=field("title"), _link=text.canonical_url(field("link"))).filter("_title <> '' AND _link <> ''")
    kept = [c for c in items.columns if c != item]
    return rows.select(
        *kept, text.hash_id(20, text.normalize_title(F.col("_title")), F.col("_link")).alias("id"), F.col("_title").alias("title"), F.col("_link").alias("link"),
        F.coalesce(blank(source_name(F.col(item))), F.lit("Unknown source")).alias("publisher"), blank(field("iso_date")).alias("iso_date"), blank(field("date")).alias("displayed_date"),
        blank(F.coalesce(blank(field("thumbnail_small")), field("thumbnail"))).alias("thumbnail"), blank(field("type")).alias("result_type"), blank(field("story_token")).alias("story_token"),
        rank.alias("search_rank"), *[market[k].alias(f"search_{k}") for k in ("country", "country_iso2", "country_iso3", "language", "query")], collected_at.alias("collected_at"),
        F.lit("unreviewed").alias("review_status"), F.lit(None).cast("boolean").alias("ai_relevance"), F.lit(None).cast("string").alias("event_country"), F.lit("").alias("notes"),
    )


RULES_SCHEMA = "version string, rules array<struct<stratum:string,publisher_patterns:array<string>,domain_patterns:array<string>,domain_suffixes:array<string>>>"


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rules of a JSON file as one row; a file without rules gives none."""
    rows = spark.read.json(path, schema=RULES_SCHEMA, multiLine=True).select(F.coalesce("rules", F.expr("CAST(array() AS array<struct<stratum:string,publisher_patterns:array<string>,domain_patterns:array<string>,domain_suffixes:array<string>>>)")).alias("_rules"))
    return rows.limit(1)


def with_stratum(sources: DataFrame, rules: DataFrame, publisher: str, url: str) -> DataFrame:
    """sources with `stratum`: that of the first rule of read_rules() that the publisher or the domain meets.

    A rule is met by a part of the publisher's name, by a part of the domain, or by its end; without case. Else official domains are
    primary_official and others unclassified. The one row of rules is broadcast; nothing is shuffled.
    """
    low = lambda values: F.transform(F.coalesce(values, F.array().cast("array<string>")), F.lower)
    rows = sources.withColumn("_name", F.lower(text.normalize_space(F.col(publisher)))).withColumn("_domain", F.coalesce(text.clean_domain(F.col(url)), F.lit("")))
    rows = rows.join(F.broadcast(rules))

    def meets(rule: Column) -> Column:
        part = lambda place: lambda p: (p != "") & F.contains(place, p)
        return F.exists(low(rule["publisher_patterns"]), part(F.col("_name"))) | F.exists(low(rule["domain_patterns"]), part(F.col("_domain"))) | F.exists(low(rule["domain_suffixes"]), lambda s: F.endswith("_domain", s))

    first = F.get(F.filter("_rules", meets), F.lit(0))
    domain = F.col("_domain")
    official = F.endswith(domain, F.lit(".gov")) | F.contains(domain, F.lit(".gov.")) | F.endswith(domain, F.lit(".edu")) | F.endswith(domain, F.lit(".ac.uk"))
    named = F.coalesce(F.nullif(first["stratum"], F.lit("")), F.lit("unclassified"))
    stratum = F.when(first.isNotNull(), named).when(official, "primary_official").otherwise("unclassified")
    return rows.select(*sources.columns, stratum.alias("stratum"))


def singles(members: DataFrame, event: str, unit: str) -> DataFrame:
    """(event, unit) of the events that have one unit."""
    return members.groupBy(event).agg(F.count(F.lit(1)).alias("_n"), F.min(unit).alias(unit)).filter("_n = 1").drop("_n")


def passed_on(labels: DataFrame, event: str, unit: str) -> DataFrame:
    """Labels of events of one article, copied from that article's label, with where they come from.

    labels are those of the units that singles() finds, with event, unit, classification_id and the fields in COPIED.
    """
    lineage = F.struct(F.lit(True).alias("derived_from_singleton_article"), F.col(unit).alias("source_article_id"), F.col("classification_id").alias("source_classification_id"))
    return labels.select(event, *COPIED, lineage.alias("lineage"))


def settled(rows: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """rows, all columns, in which a unit that is unclear and shows nothing counts as having no effect, and `settled`.

    Then its score is 0 and a note is added to its reasoning, once. Dimensions are columns of structs with `present`.
    """
    present = F.lit(False)
    for d in dimensions:
        present = present | F.coalesce(F.col(d)["present"], F.lit(False))
    nothing = (F.col("status") == "unclear") & ~present & (F.coalesce("dominant", F.lit("")) == "") & (F.coalesce("degree", F.lit(0)) == 0)
    nothing = F.coalesce(nothing, F.lit(False))
    reasoning = F.trim(F.coalesce("reasoning", F.lit("")))
    noted = F.when(F.contains(reasoning, F.lit(RESIDUAL_NOTE)), F.col("reasoning")).otherwise(F.trim(F.concat(reasoning, F.lit(" "), F.lit(RESIDUAL_NOTE))))
    new = {"status": F.lit("non_empowerment"), "degree": F.lit(0), "unit_score": F.lit(0.0), "dominant": F.lit(None).cast("string"), "reasoning": noted}
    rows = rows.withColumn("settled", nothing)
    return rows.select(*[F.when(F.col("settled"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns])


def theme(title: Column, topic: Column, names: dict[str, str], rules: list[tuple[str, str]], default: str) -> Column:
    """The name of a model's topic, or else the label of the first rule that the title meets."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[topic]
    return F.coalesce(F.when(topic != "other", known), text.first_rule(title, rules, default))


def signed_or_dash(value: Column, digits: int = 2) -> Column:
    """A number with a plus only if it is positive; null is a dash."""
    return F.when(value.isNull(), "-").otherwise(F.concat(F.when(value > 0, "+").otherwise(""), F.format_string(f"%.{digits}f", value.cast("double"))))


def percent(value: Column) -> Column:
    return F.format_string("%.1f%%", F.coalesce(value.cast("double"), F.lit(0.0)) * 100)


def takeaways(event_index: Column, gap: Column, ratio: Column, narrative: Column, share: Column) -> Column:
    """Four sentences on direction, amplification, volume and narrative, as an array."""
    # Limits and texts of a report's sentences.
    index, gap, ratio = (F.coalesce(c.cast("double"), F.lit(0.0)) for c in (event_index, gap, ratio))
    direction = F.when(F.abs(index) < 5, "close to neutral").when(index > 0, "expansion-oriented").otherwise("contraction-oriented")
    gap_text = F.when(F.abs(gap) < 1, "Article repetition barely changes the direction of the signal.")
    gap_text = gap_text.when(gap > 0, "Article volume makes the public picture more expansion-oriented.").otherwise("Article volume makes the public picture more contraction-oriented.")
    volume = F.when(ratio < 1.1, "Most coverage units represent distinct developments in this release.").otherwise("Repeated coverage materially exceeds unique-event volume.")
    return F.array(
        F.concat(F.lit("The unique-event signal is "), direction, F.lit(" ("), signed_or_dash(index), F.lit(").")),
        F.concat(gap_text, F.lit(" Gap: "), signed_or_dash(gap), F.lit(" points.")),
        F.concat(volume, F.lit(" Coverage/Event ratio: "), F.format_string("%.2f", ratio), F.lit(".")),
        F.concat(F.initcap(F.replace(narrative, F.lit("_"), F.lit(" "))), F.lit(" is the largest article-weighted frame ("), percent(share), F.lit(").")),
    )
