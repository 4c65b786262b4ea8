"""Near-duplicate documents by SimHash fingerprints."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .pigeonhole import near_links
from .shared import bounded, free, map_arrow, saved, trim

SEED = 42


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each run of `words` words of the text with A-Z in lower case; of all words if there are fewer."""
    found = text.encode("utf-8").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([digest(joined, SEED)], dtype=np.uint64)
    stops = np.cumsum([len(w) + 1 for w in found])
    starts = np.append(0, stops[:-words]).tolist()
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (stops[words - 1 :] - 1).tolist(), strict=True)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """A bit is set if over half the hashes have it; a signed long. No hashes give zero."""
    total = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp long) of each row; null and empty texts have fingerprint zero."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = [majority(shingle_hashes(t or "", words)) for t in batch.column(1).to_pylist()]
            return pa.record_batch([batch.column(0), pa.array(got, pa.int64())], names=[id_col, "fp"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, fp long")


def near_groups(docs: DataFrame, words: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp, component_id) of each row: component_id is the smallest id reachable over links.

    Two documents are linked if their fingerprints differ in at most `distance` bits. Only distinct fingerprints are
    compared, so copies cost nothing and all take their fingerprint's component. A null id is never a component_id
    unless all ids of the component are null. Repeated rows share a component. Other columns of docs are not read.
    """
    rows = saved(fingerprints(docs, words, id_col, text_col).withColumnRenamed(id_col, "id"))
    prints = saved(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = components(near_links(prints.select("fp"), distance))
    prints = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    prints = saved(prints)
    smallest = prints.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = saved(prints.join(smallest, "root").select("fp", "component_id"))
    return rows.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


#: Words of a set's parities, and smallest hashes by which it meets others.
WIDE, LOWEST = 4, 3
ODD = [f"odd{i}" for i in range(WIDE)]
#: What a set of shingles is known by: its size and two digests.
SET = ["n", "digest", "check"]
#: Members of a bucket that are compared in one task.
CROWD = 16_000
#: One document in so many is counted for the order of shingles.
COUNTED = 8


def share_of(n: int, share: float) -> int:
    """The least whole number that is at least this share of n."""
    return math.ceil(n * share - 1e-9)


def common_shingles(docs: DataFrame, words: int, id_col: str, text_col: str, most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, how often) of the shingles that two or more of the documents counted have, at most `most` of them.

    One document in COUNTED is counted, by hash. This gives an order only: any order finds the same groups, and one
    that puts frequent shingles last compares fewer documents.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = [np.unique(shingle_hashes(t or "", words)) for t in batch.column(0).to_pylist()]
            out = pa.record_batch([pa.array(np.concatenate(got).view(np.int64))], names=["shingle"])
            del got
            trim()
            return out

        return step

    some = docs.filter(F.pmod(F.xxhash64(id_col, F.lit("shingles")), F.lit(COUNTED)) == 0).select(text_col)
    counts = map_arrow(some, make, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = counts.orderBy(F.desc("n"), "shingle").limit(most).toArrow()
    hashes, often = found.column("shingle").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], often[order]


def rarest(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """Of a sorted set of hashes, so many of the rarest that a set of this Jaccard similarity has one of them among its own.

    Alike sets share at least `similarity` of each one's members. Whatever the order, if it is one for all sets, the first
    shared member is then among the first n - similarity * n + 1 of both. Here members that aren't common come first.
    """
    known, often = common
    times = np.zeros(len(hashes), dtype=np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        times = np.where(known[at] == hashes, often[at], 0)
    return hashes[np.argsort(times, kind="stable")[: len(hashes) - share_of(len(hashes), similarity) + 1]]


def parities(hashes: np.ndarray) -> list[int]:
    """64 * WIDE bits: does an odd number of the hashes fall to it? Each member that only one of two sets has changes one bit."""
    odd = np.bincount((hashes % np.uint64(64 * WIDE)).astype(np.int64), minlength=64 * WIDE) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def lowest(hashes: np.ndarray) -> list[int]:
    """The smallest value of LOWEST functions of the hashes: alike sets have each in common with their similarity's chance."""
    factors = [(0x9E3779B97F4A7C15 * (2 * i + 1) ^ i << 32) | 1 for i in range(LOWEST)]
    return [int((hashes * np.uint64(f & (1 << 64) - 1)).min().view(np.int64)) for f in factors]


def set_facts(text: str, words: int, common: tuple[np.ndarray, np.ndarray], similarity: float) -> list:
    """Size and digests of the set of shingles, the set as 32-bit hashes, its rarest and lowest members, fingerprint, parities."""
    hashes = np.unique(shingle_hashes(text, words))
    if not len(hashes):
        return [0, 0, 0, hashes.astype(np.int32), hashes.astype(np.int64), [], 0, *[0] * WIDE]
    digests = [int(np.array(xxhash.xxh64_intdigest(hashes.tobytes(), seed), dtype=np.uint64).view(np.int64)) for seed in (SEED, SEED + 1)]
    members = (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return [len(hashes), *digests, members, rarest(hashes, common, similarity).view(np.int64), lowest(hashes), majority(hashes), *parities(hashes)]


def documents_as_sets(docs: DataFrame, words: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(id, n, digest, check, members, rarest, lowest, fp, odd0...) of every row with an id, written once."""
    own = docs.filter(F.col(id_col).isNotNull()).select(id_col, text_col)
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(own, words, id_col, text_col))
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = [pa.int64(), pa.int64(), pa.int64(), ints, longs, longs, pa.int64(), *[pa.int64()] * WIDE]
    names = ["id", *SET, "members", "rarest", "lowest", "fp", *ODD]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = [set_facts(t or "", words, common.value, similarity) for t in batch.column(1).to_pylist()]
            out = pa.record_batch([batch.column(0), *[pa.array([g[i] for g in got], kind) for i, kind in enumerate(kinds)]], names=names)
            del got
            trim()
            return out

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    odd = ", ".join(f"{c} long" for c in ODD)
    return saved(map_arrow(own, make, f"id {kind}, n long, digest long, check long, members array<int>, rarest array<long>, lowest array<long>, fp long, {odd}"))


def may_be_alike(similarity: float, other: dict[str, str]) -> Column:
    """Do sizes and parities allow for the similarity? Wrong for no pair: of two alike sets, at most a fixed share of both sizes is in one only."""
    n, m = F.col("n"), F.col(other["n"])
    apart = reduce(Column.__add__, [F.bit_count(F.col(c).bitwiseXOR(F.col(other[c]))) for c in ODD])
    return (F.least(n, m) >= similarity * F.greatest(n, m)) & (apart <= (n + m) * ((1 - similarity) / (1 + similarity) + 1e-9))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float, most_broadcast: int) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets have the similarity. Only the sets that are in a pair are moved."""
    def of_pairs(pairs: DataFrame, *columns: str) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
        return sets.select("id", *columns).join(bounded(saved(wanted), most_broadcast), "id")

    pairs = saved(pairs)
    names = {c: f"{c}_" for c in ("n", *ODD)}
    facts = saved(of_pairs(pairs, "n", *ODD))
    near = pairs.join(facts.withColumnRenamed("id", "a"), "a").join(facts.withColumnsRenamed({"id": "b", **names}), "b")
    near = saved(near.filter(may_be_alike(similarity, names)).select("a", "b"))
    members = of_pairs(near, "members")
    both = near.join(members.toDF("a", "x"), "a").join(members.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    out = saved(both.filter(common >= similarity * (F.size("x") + F.size("y") - common)).select("a", "b").distinct())
    free(pairs, near, facts)
    return out


def ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def star_pairs(buckets: DataFrame) -> DataFrame:
    """(a, b) of each member of a bucket (kind, bucket, id) with the bucket's smallest id and with one by hash."""
    one = F.min(F.struct(F.xxhash64("bucket", "id"), "id"))["id"]
    heads = buckets.groupBy("kind", "bucket").agg(F.min("id").alias("first"), F.max("id").alias("last"), one.alias("other")).filter("first <> last")
    met = buckets.join(heads.drop("last"), ["kind", "bucket"])
    rows = met.select("id", F.col("first").alias("head")).unionAll(met.select("id", F.col("other").alias("head")))
    return rows.filter("id <> head").select(*ordered("id", "head")).distinct()


def in_cells(met: DataFrame, crowd: int) -> DataFrame:
    """met (bucket, id, ...) with low, high, side and own: the cells in which the members of a bucket meet.

    A bucket of over `crowd` members is cut in blocks, and each pair of blocks is a cell of its own, so its pairs are compared by
    many tasks. In a cell of two blocks, members meet those of the other side only.
    """
    crowds = saved(met.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / crowd).cast("int").alias("blocks")).filter("blocks > 1"))
    placed = met.join(bounded(crowds, 500_000), "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("b", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int"))
    met_in = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met_in.select(*met.columns, F.least("b", "o").alias("low"), F.greatest("b", "o").alias("high"), (F.col("b") > F.col("o")).alias("side"), (F.col("b") == F.col("o")).alias("own"))


def unjoined_pairs(sets: DataFrame, links: DataFrame, similarity: float, most_broadcast: int, crowd: int = CROWD) -> DataFrame:
    """(a, b) of sets that share a rarest member, may be alike, and aren't joined by links yet.

    Buckets whose members are all joined leave first, so a large group of like documents is not compared in pairs.
    """
    roots = saved(components(links).withColumnRenamed("node", "id"))
    rooted = sets.select("id", "rarest").join(bounded(roots, most_broadcast), "id", "left").select(F.explode("rarest").alias("bucket"), "id", F.coalesce("root", "id").alias("root"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("bucket")
    met = saved(rooted.join(mixed, "bucket", "left_semi"))
    facts = saved(sets.select("id", "n", *ODD).join(bounded(saved(met.select("id").distinct()), most_broadcast), "id"))
    met = in_cells(met.join(facts, "id"), crowd)
    names = {c: f"{c}_" for c in ("id", "n", "root", *ODD)}
    cell = ["bucket", "low", "high"]
    other = met.withColumnsRenamed({**{c: f"{c}_" for c in (*cell, "side", "own")}, **names})
    same_cell = reduce(Column.__and__, [F.col(c) == F.col(f"{c}_") for c in cell])
    pairs = met.join(other, same_cell & (F.col("own") | (F.col("side") != F.col("side_"))) & (F.col("id") < F.col("id_")) & (F.col("root") != F.col("root_")) & may_be_alike(similarity, names))
    return pairs.select(F.col("id").alias("a"), F.col("id_").alias("b")).distinct()


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, distance: int = 2, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = 500_000, crowd: int = CROWD) -> DataFrame:
    """(id, group_id) of every document that is in a group with another one; group_id is the group's smallest id.

    Documents are alike if their sets of words-word shingles have this Jaccard similarity. Exact copies of a set leave
    first: one of each stays. Then each document is compared with two others of its component of SimHash fingerprints
    that differ in at most `distance` bits, which the generalised pigeonhole finds, and of each set that shares one of
    its LOWEST members: this joins large groups by a few comparisons a document. Last, all pairs are found that share
    one of their rarest shingles, as alike sets always do, and aren't joined yet, so the groups are those of all alike
    documents. Sizes and parities rule pairs out within the join, and rule out no alike pair; counting shared members decides.
    A shingle that over `crowd` unlike documents share is compared in pairs of blocks, by many tasks. Members are counted by
    32 bits of their hashes: two different ones of a set that agree in these count as one.

    Texts without a word are alike. Null ids are in no group; rows of one id are one document, alike to what any of them
    is like. Null counts as empty; an empty table gives no rows; other columns of docs are not read.
    """
    rows = documents_as_sets(docs, words, similarity, id_col, text_col)
    classes = saved(rows.groupBy(*SET).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size"))
    joined = rows.join(bounded(classes, most_broadcast), SET, "left")
    same = saved(joined.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct())
    sets = joined.filter("first IS NULL OR id = first")
    prints = saved(sets.select("fp").distinct())
    roots = bounded(components(near_links(prints, distance)).withColumnRenamed("node", "fp"), most_broadcast)
    by_print = sets.select("id", "fp").join(roots, "fp", "left").select(F.lit(-1).alias("kind"), F.coalesce("root", "fp").alias("bucket"), "id")
    by_member = sets.select(F.posexplode("lowest").alias("kind", "bucket"), "id")
    links = verified(star_pairs(by_print.unionAll(by_member)), sets, similarity, most_broadcast)
    more = verified(unjoined_pairs(sets, links, similarity, most_broadcast, crowd), sets, similarity, most_broadcast)
    out = components(same.union(links).union(more)).select(F.col("node").alias("id"), F.col("root").alias("group_id"))
    free(rows, classes, same, prints, links, more)
    return out


def one_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = 2_000_000) -> DataFrame:
    """docs without the documents of each group but its smallest id, all columns kept.

    The ids that go are broadcast if they are at most most_broadcast (8 bytes each) and joined by a shuffle beyond that.
    """
    gone = saved(similar_groups(docs, words, similarity, 2, id_col, text_col).filter("id <> group_id").select(F.col("id").alias("_gone")))
    return docs.join(bounded(gone, most_broadcast), F.col(id_col) == F.col("_gone"), "left_anti")


def hex_of(fp: str = "fp"):
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
