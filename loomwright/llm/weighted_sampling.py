"""Document fingerprints by consistent weighted sampling of terms, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

#: Terms are runs of characters other than ASCII white space, in lower case.
BLANKS = r"[\x20\x09-\x0D]+"


def uniform(bits: Column) -> Column:
    """A number in (0, 1) from the low 32 bits."""
    return (bits.bitwiseAND(F.lit(0xFFFFFFFF)) + 0.5) / 4294967296.0


def sample_of(term_hash: Column, log_weight: Column, sample: int) -> Column:
    """The logarithm of a term's sampled value in one sample; the term with the smallest one is drawn.

    r and c are gamma variables of shape 2 (the negative logarithm of a product of two uniform ones), beta is uniform,
    all fixed by the term and the sample. The value depends on the weight only through the step t of a grid of width
    r, so equal draws in two texts mean the same term at the same step: their chance is the generalised Jaccard
    similarity of the weights.
    """
    one, two = (F.xxhash64(term_hash, F.lit(2 * sample + k)) for k in (0, 1))
    high = F.shiftrightunsigned(one, 32)
    # Two uniforms of 32 bits from each hash; beta takes middle bits of both.
    r = -F.log(uniform(one) * uniform(high))
    c_log = F.log(-F.log(uniform(two) * uniform(F.shiftrightunsigned(two, 32))))
    beta = uniform(F.shiftrightunsigned(one.bitwiseXOR(two), 16))
    step = F.floor(log_weight / r + beta)
    return c_log - r * (step - beta) - r


def term_rows(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, term_hash, log_weight): the terms of each text and the logarithm of their counts."""
    terms = texts.select(*key, F.explode(F.split(F.lower(text), BLANKS)).alias("term"))
    hashed = terms.filter("term <> ''").select(*key, F.xxhash64("term").alias("term_hash"))
    return hashed.groupBy(*key, "term_hash").agg(F.log(F.count(F.lit(1))).alias("log_weight"))


def signature_columns(samples: int) -> list[Column]:
    return [F.min(sample_of(F.col("term_hash"), F.col("log_weight"), i)).alias(f"s{i}") for i in range(samples)]


def signature(samples: int) -> Column:
    """An array of longs from the columns s0, s1, ...: a digest of each sample's drawn value; a text without terms has zeros."""
    return F.array(*[F.when(F.col(f"s{i}").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(F.col(f"s{i}"))) for i in range(samples)])


def likeness(a: Column, b: Column) -> Column:
    """Share of samples in which two signatures agree: estimates the generalised Jaccard similarity."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda acc, x: acc + x)
    return same / F.size(a)


def as_hex(signature: Column) -> Column:
    """The low 32 bits of each sample as 8 hex digits."""
    return F.concat_ws("", F.transform(signature, lambda v: F.lower(F.lpad(F.hex(v.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))))


def fingerprint(docs: DataFrame, samples: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, signature) of each distinct id. Rows with one id are one document whose terms are added up.

    Null and empty texts have a signature of zeros. Other columns of docs are not read.
    """
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    drawn = term_rows(own, ["id"], "text").groupBy("id").agg(*signature_columns(samples))
    ids = own.select("id").distinct()
    return ids.join(drawn, ids["id"].eqNullSafe(drawn["id"]), "left").select(ids["id"].alias(id_col), signature(samples).alias("signature"))


def range_of(value: Column, limits: list) -> Column:
    """How many of the ascending limits lie below value, looked up in two steps; 0 for null."""
    if not limits:
        return F.lit(0)
    blocks = [limits[i : i + 64] for i in range(0, len(limits), 64)]
    tops = F.array(*[F.lit(b[-1]) for b in blocks])
    block = F.size(F.filter(tops, lambda v: v < value))
    inner = F.array(*[F.array(*map(F.lit, b)) for b in [*blocks, blocks[-1][:1]]])
    within = F.when(block == len(blocks), F.lit(len(limits))).otherwise(block * 64 + F.size(F.filter(inner[block], lambda v: v < value)))
    return F.when(value.isNull(), 0).otherwise(within)


def in_ranges(docs: DataFrame, id_col: str, text_col: str, rows_each: int) -> DataFrame:
    """(range, id, text): about rows_each rows of neighbouring ids in each range; a null id lies before all others.

    The limits come from an approximate quantile sketch; at most 10,000 of them reach the driver.
    """
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = min(10_000, max(1, math.ceil(own.count() / rows_each)))
    limits: list = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        limits = sorted(set(own.agg(F.percentile_approx("id", shares, 20 * parts)).first()[0] or []))
    return own.select(range_of(F.col("id"), limits).cast("int").alias("range"), "id", "text")


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_each: int = 250) -> DataFrame:
    """(range, place, id, text, following, last): following is the text of the next document in descending id order.

    After the last document comes the first. Rows of one id follow each other by text. Texts are shuffled once, to
    ranges of ids; the last row of each range gets its neighbour from a table of one row a range.
    """
    rows = in_ranges(docs, id_col, text_col, rows_each)
    spark = rows.sparkSession
    heads = rows.groupBy("range").agg(F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "text")).alias("head"))
    heads = saved(heads.select("range", F.col("head.text").alias("head")))
    # One integer a range, at most 10,000.
    ranges = sorted((r["range"] for r in heads.select("range").collect()), reverse=True)
    follows = F.map_from_arrays(F.array(*[F.lit(r) for r in [*ranges[1:], *ranges[:1]]]), F.array(*[F.lit(r) for r in ranges])) if ranges else F.lit(None)
    edges = heads.select(follows[F.col("range")].alias("range"), F.col("head").alias("edge")) if ranges else heads.withColumnRenamed("head", "edge")
    tasks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    within = Window.partitionBy("range").orderBy(F.desc_nulls_last("id"), F.desc("text"))
    placed = rows.repartition(tasks, "range").select("*", F.row_number().over(within).alias("place"), F.lead("text").over(within).alias("lead"))
    joined = placed.join(edges, "range", "left")
    return joined.select("range", "place", "id", "text", F.coalesce("lead", "edge").alias("following"), F.col("lead").isNull().alias("last"))


def compare_edited(docs: DataFrame, samples: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_chars, edited_sha256, signature, edited_signature, near_edited, near_next of each row.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many of the next document, or
    all of it. Terms are counted where the texts lie: after the one shuffle to ranges of ids nothing moves but
    the results. Null text counts as empty; repeated rows are documents of their own, next to each other; of null
    ids, which come last, likewise. An empty table gives no rows. Other columns of docs are not read.
    """
    rows = with_next_text(docs, id_col, text_col)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("following", F.lit(1), half))
    rows = rows.select("range", "place", "id", "text", edited.alias("edited"), n.cast("long").alias("n_chars"), "following", "last")
    none = [F.lit(None).cast(t).alias(c) for t, c in ((docs.schema[id_col].dataType, "id"), ("long", "n_chars"), ("string", "sha"))]
    side = lambda k, text: F.struct(F.lit(k).alias("side"), text.alias("text"), *none)
    facts = F.struct(F.lit(3).alias("side"), F.lit("").alias("text"), F.col("id").alias("id"), F.col("n_chars").alias("n_chars"), F.sha2("edited", 256).alias("sha"))
    sides = F.array(side(0, F.col("text")), side(1, F.col("edited")), facts)
    sides = F.when(F.col("last"), F.concat(sides, F.array(side(2, F.col("following"))))).otherwise(sides)
    texts = rows.select("range", "place", F.explode(sides).alias("x"))
    key = ["range", "place", "side", "id", "n_chars", "sha"]
    terms = texts.select("range", "place", *[F.col(f"x.{c}").alias(c) for c in key[2:]], F.explode(F.split(F.lower("x.text"), BLANKS)).alias("term"))
    hashed = terms.select(*key, F.when(F.col("term") != "", F.xxhash64("term")).alias("term_hash"))
    weighed = hashed.groupBy(*key, "term_hash").agg(F.log(F.count(F.lit(1))).alias("log_weight"))
    drawn = weighed.groupBy(*key).agg(*signature_columns(samples)).select(*key, signature(samples).alias("sig"))
    pick = lambda k: F.max(F.when(F.col("side") == k, F.col("sig")))
    documents = drawn.groupBy("range", "place").agg(
        *[F.max(c).alias(c) for c in key[3:]], pick(0).alias("signature"), pick(1).alias("edited_signature"), pick(2).alias("after")
    )
    following = F.coalesce("after", F.lead("signature").over(Window.partitionBy("range").orderBy("place")))
    return documents.select(
        F.col("id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"), "signature", "edited_signature",
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), following).alias("near_next"),
    )
