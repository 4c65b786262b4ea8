"""Text, address and identifier functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwright.functions.nested import bound

#: Query parameters that only track a reader.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "mc_cid", "mc_eid")


def normalize_space(value: Column) -> Column:
    """Runs of white space become one blank, ends are trimmed, null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s+", " "))


def normalize_title(value: Column) -> Column:
    """Lower-cased title without signs other than word characters and blanks."""
    return F.regexp_replace(F.lower(normalize_space(value)), r"(?U)[^\w\s]", "")


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor blank, else empty."""
    return F.coalesce(*[F.when(F.trim(v) != "", v) for v in values], F.lit(""))


def clean_domain(url: Column) -> Column:
    """Host in lower case, without port and a leading www."""
    authority = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(authority, r":\d+$", ""), r"^www\.", "")


def canonical_url(url: Column) -> Column:
    """Scheme and authority in lower case, no slash at the end of the path, no tracking parameters, no fragment.

    Parameters are decoded and encoded again; one without a value gets an equals sign.
    """

    def again(part: Column) -> Column:
        encoded = F.url_encode(F.coalesce(F.try_url_decode(part), part))
        return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))

    def parameters(raw: Column) -> Column:
        given = F.filter(F.split(F.regexp_extract(raw, r"\?(.*)$", 1), "&"), lambda p: p != "")
        named = F.transform(given, lambda p: F.struct(F.split(p, "=", 2)[0].alias("name"), F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit("")).alias("value")))
        own = F.filter(named, lambda p: ~F.lower(F.coalesce(F.try_url_decode(p["name"]), p["name"])).isin(*TRACKING))
        pairs = F.transform(own, lambda p: F.concat(again(p["name"]), F.lit("="), again(p["value"])))
        return bound(pairs, lambda p: F.when(F.size(p) > 0, F.concat(F.lit("?"), F.array_join(p, "&"))).otherwise(""))

    def rebuilt(raw: Column) -> Column:
        head = F.lower(F.regexp_extract(raw, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?]*)", 1))
        path = F.regexp_replace(F.regexp_extract(raw, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*([^?]*)", 1), "/+$", "")
        # Most addresses have no parameters to take apart.
        return bound(head, lambda h: F.when(h == "", raw).otherwise(F.concat(h, path, F.when(F.contains(raw, F.lit("?")), parameters(raw)).otherwise(""))))

    return bound(F.regexp_replace(normalize_space(url), "#.*$", ""), rebuilt)


def without_query(url: Column) -> Column:
    """Address in lower-cased host, path without last slash, nothing after it."""
    return F.regexp_replace(F.regexp_replace(canonical_url(url), r"\?.*$", ""), "/+$", "")


def hash_id(length: int, *parts: Column, prefix: str = "") -> Column:
    """The first hex digits of the SHA-256 of the parts, joined by bars."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length))


def pair_id(a: Column, b: Column) -> Column:
    """One id for a pair, whatever its order."""
    return F.concat_ws("__", F.least(a, b), F.greatest(a, b))


def pair_members(pair: Column) -> tuple[Column, Column]:
    """The two ids of a pair's id; null where it is none."""
    parts = F.split(pair, "__", 2)
    return parts[0], F.get(parts, F.lit(1))


def has_han(value: Column) -> Column:
    return F.coalesce(value, F.lit("")).rlike("[\\u3400-\\u4dbf\\u4e00-\\u9fff]")


def numbers_in(value: Column) -> Column:
    """Digit runs, with points and commas between digits."""
    return F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(r"\d+(?:[.,]\d+)*"), F.lit(0))


def search_language(value: Column) -> Column:
    """A language code reduced to its first part; Chinese, French and English by their first letters."""
    low = F.lower(F.coalesce(value, F.lit("")))
    return F.when(low.startswith("zh"), "zh").when(low.startswith("fr"), "fr").when(low.startswith("en"), "en").otherwise(F.split(low, "-")[0])


def has_term(value: Column, terms: list[str], whole_words: set[str]) -> Column:
    """Does the text hold one of the terms? Those in whole_words count only as words of their own."""
    low, found = F.lower(F.coalesce(value, F.lit(""))), F.lit(False)
    for term in terms:
        found = found | (low.rlike(rf"(?<![a-z0-9_]){term}(?![a-z0-9_])") if term in whole_words else low.contains(term))
    return found


def first_rule(value: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose pattern the lower-cased text meets."""
    out, low = None, F.lower(F.coalesce(value, F.lit("")))
    for label, pattern in rules:
        out = F.when(low.rlike(pattern), label) if out is None else out.when(low.rlike(pattern), label)
    return F.lit(default) if out is None else out.otherwise(default)


def signed(value: Column, digits: int) -> Column:
    """A number with its sign, an n-dash-free 'n/a' for null."""
    return F.when(value.isNull(), "n/a").otherwise(F.format_string(f"%+.{digits}f", value))


def clean_codes(values: Column) -> Column:
    """Three-letter codes in upper case, without other signs, each once in order."""
    return F.array_distinct(F.filter(F.transform(values, lambda v: F.upper(F.regexp_replace(v, "[^A-Za-z]", ""))), lambda c: F.length(c) == 3))


def display(*parts: Column) -> Column:
    """Parts that aren't blank, joined by bars."""
    return F.concat_ws(" | ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])
