"""Order-dependent choices that equal a fold over all rows, made in parallel where their outcome doesn't depend on each other."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.operators.graph import components
from loomwright.operators.ranking import top_per_key
from loomwright.operators.vectors import blocked_pairs, matrix
from loomwright.sources.scratch import saved


class Cluster:
    """Members so far, in the order in which they came."""

    def __init__(self, row_id: object, day: float) -> None:
        self.id, self.first, self.last = row_id, day, day
        self.members: list[object] = []
        self.vectors: list[np.ndarray] = []
        self.tokens: set[str] = set()
        self.total, self.least = 0.0, None  # of the similarities of all pairs of members

    def add(self, row_id: object, day: float, token: str | None, vector: np.ndarray, similar: np.ndarray) -> None:
        self.members.append(row_id)
        self.vectors.append(vector)
        self.first, self.last = min(day, self.first), max(day, self.last)
        if token is not None:
            self.tokens.add(token)
        if len(similar):
            self.total += float(similar.sum())
            self.least = min(float(similar.min()), self.least if self.least is not None else 1.0)

    def rows(self, weak_below: float) -> Iterator[tuple]:
        """(id, cluster_id, size, mean, least, weak) of each member; a cluster of one has no similarities."""
        n = len(self.members)
        pairs = n * (n - 1) // 2
        mean = self.total / pairs if pairs else None
        for member in self.members:
            yield member, self.id, n, mean, self.least, mean is not None and mean < weak_below


def fold(rows: Iterator[tuple], average: float, least: float, span: float, weak_below: float) -> Iterator[tuple]:
    """Clusters of rows (id, day, token, vector) of one component in order; a cluster goes out when no later row can join it."""
    live: list[Cluster] = []
    for row_id, day, token, vector in rows:
        for c in live:
            if day - c.first > span:
                yield from c.rows(weak_below)
        live = [c for c in live if day - c.first <= span]
        best, best_score, best_similar = None, -1.0, np.empty(0)
        for c in live:
            similar = np.array(c.vectors) @ vector
            if token is not None and token in c.tokens:
                score = max(1.0, float(similar.mean()))
            elif similar.mean() >= average and similar.min() >= least:
                score = float(similar.mean())
            else:
                continue
            if score > best_score:
                best, best_score, best_similar = c, score, similar
        if best is None:
            best = Cluster(row_id, day)
            live.append(best)
        best.add(row_id, day, token, vector, best_similar)
    for c in live:
        yield from c.rows(weak_below)


def token_links(rows: DataFrame, span: float) -> DataFrame:
    """(a, b): links that connect what rows of one token at most span days apart connect.

    Rows of one token and one stretch of span days are linked to its smallest id; of two stretches that follow each other,
    the last row of the one to the first of the other. No token's rows need to come together.
    """
    stretch = F.floor(F.col("day") / span) if span > 0 else F.col("day")
    own = rows.filter("token IS NOT NULL").select("key", "token", stretch.alias("stretch"), "day", "id")
    at = ["key", "token", "stretch"]
    heads = saved(own.groupBy(*at).agg(F.min("id").alias("head"), F.min(F.struct("day", "id")).alias("first"), F.max(F.struct("day", "id")).alias("last")))
    inner = own.join(heads.select(*at, "head"), at).filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"))
    after = heads.select("key", "token", (F.col("stretch") - 1).alias("stretch"), F.col("first").alias("next"))
    outer = heads.join(after, at).filter(F.col("next.day") - F.col("last.day") <= span).select(F.col("last.id").alias("a"), F.col("next.id").alias("b"))
    return inner.union(outer)


def greedy_clusters(df: DataFrame, key: str, average: float = 0.82, least: float | None = None, span: float = 4) -> DataFrame:
    """(id, cluster_id, size, mean_similarity, least_similarity, weak) of rows (id, day, rank, headline, token, vector, key).

    Of each key the rows in order of day, rank, headline in lower case and id join one after the other the best cluster so far.
    A cluster takes a row if all its days stay within span and it holds the row's token, which counts 1.0 at least, or
    the row's mean and smallest similarity to the members reach `average` and `least`, 0.05 less if not given; the earliest of
    equals wins. cluster_id is the first member's id. weak: the mean similarity of a cluster's pairs is below
    average + 0.04, 0.95 at most; a cluster of one has no similarities and isn't weak.

    A row can join a cluster only if it shares its token with a member, or is at least `average` alike to one, within the span.
    These links are found by an exact join in blocks, and their connected components are folded each for itself, which gives
    what one fold over all rows gives. A component is read as a stream in order; only clusters that a later row may
    join, and the vectors of their members, are held. Days are not null; null ids are left out, null ranks and headlines come first,
    rows with a null vector join by token only. Vectors have one length.
    """
    least = max(0.0, average - 0.05) if least is None else least
    weak_below = min(0.95, average + 0.04)
    rows = df.select("id", F.col("day").cast("double").alias("day"), "rank", F.lower("headline").alias("headline"), "token", F.col("vector").cast("array<double>").alias("vector"), F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-")).alias("key"))
    rows = saved(rows.filter("id IS NOT NULL AND day IS NOT NULL"))
    alike = blocked_pairs(rows, span, average - 1e-6, key="key").select("a", "b")
    roots = components(alike.union(token_links(rows, span)))
    # A row without links is a component, and a cluster, of its own.
    parts = rows.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("root", "id"))
    size = rows.select(F.max(F.size("vector"))).first()[0] or 1
    order = ["part", "day", "rank", "headline", "id"]
    vector = F.coalesce("vector", F.array_repeat(F.lit(0.0), size))
    dealt = parts.select(*order, "token", vector.alias("vector")).repartition("part").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                if batch.num_rows:
                    columns = [batch.column(c).to_pylist() for c in ("part", "id", "day", "token")]
                    yield from zip(*columns, matrix(batch.column("vector")), strict=True)

        out: list[tuple] = []
        for _, group in itertools.groupby(each(), key=lambda r: r[0]):
            for row in fold((r[1:] for r in group), average, least, span, weak_below):
                out.append(row)
                if len(out) >= 10_000:
                    yield as_batch(out)
                    out = []
        if out:
            yield as_batch(out)

    kind = df.schema["id"].dataType.simpleString()
    names = ["id", "cluster_id", "size", "mean_similarity", "least_similarity", "weak"]

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        ids, heads, *facts = zip(*out, strict=True)
        kinds = [pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(heads), *[pa.array(x, k) for x, k in zip(facts, kinds, strict=True)]], names=names)

    return dealt.mapInArrow(run, f"id {kind}, cluster_id {kind}, size long, mean_similarity double, least_similarity double, weak boolean")


#: The order in which pairs are looked at.
BEST_FIRST = [F.desc, F.desc, F.asc, F.asc]
ORDER = ["priority", "second", "a", "b"]


def ordered_columns() -> list:
    return [way(c) for way, c in zip(BEST_FIRST, ORDER, strict=True)]


def best_open(open_: DataFrame, used: DataFrame, most_each: int) -> DataFrame:
    """Those of the open pairs that are sure to be taken: at both items, fewer pairs come before them than the item has room for."""
    ends = open_.select(F.explode(F.array("a", "b")).alias("item"), *ORDER)
    first = top_per_key(ends, ["item"], ordered_columns(), most_each, "place")
    room = first.join(used, "item", "left").filter(F.col("place") <= most_each - F.coalesce("times", F.lit(0)))
    return room.groupBy(*ORDER).agg(F.count(F.lit(1)).alias("ends")).filter("ends = 2").drop("ends")


def times_of(taken: DataFrame) -> DataFrame:
    return taken.select(F.explode(F.array("a", "b")).alias("item")).groupBy("item").agg(F.count(F.lit(1)).cast("int").alias("times"))


def greedy_match(pairs: DataFrame, used: DataFrame, most_each: int, target: int) -> DataFrame:
    """The first `target` of pairs (priority, second, a, b) that a walk in order takes, each item at most most_each times, with `used` before.

    In each round the pairs go that are the best open ones at both their items; what the walk decides about a pair depends on the
    pairs before it at its items alone, so they are the walk's. Pairs at full items leave. Rounds end when no open pair comes
    before the last one that the target allows.
    """
    start = pairs.groupBy("a", "b").agg(F.max(F.struct("priority", "second")).alias("x")).select("x.*", "a", "b")
    full = lambda counts: counts.filter(F.col("times") >= most_each).select("item")

    def without_full(rows: DataFrame, counts: DataFrame) -> DataFrame:
        return rows.join(full(counts).withColumnRenamed("item", "a"), "a", "left_anti").join(full(counts).withColumnRenamed("item", "b"), "b", "left_anti").select(*ORDER)

    open_, taken, counts = saved(without_full(start, used)), None, used
    while True:
        new = saved(best_open(open_, counts, most_each))
        taken = new if taken is None else saved(taken.union(new).orderBy(*ordered_columns()).limit(target))
        # Earlier pairs count, later ones than the target allows don't matter.
        counts = saved(used.union(times_of(taken)).groupBy("item").agg(F.sum("times").cast("int").alias("times")))
        rest = without_full(open_.join(new, ORDER, "left_anti"), counts)
        if taken.count() >= target:
            last = taken.orderBy(*ordered_columns()).limit(target).orderBy(*[way(c) for way, c in zip([F.asc, F.asc, F.desc, F.desc], ORDER, strict=True)]).first()
            less = lambda c: F.col(c) > F.lit(last[c]) if c in ORDER[:2] else F.col(c) < F.lit(last[c])
            before = F.lit(False)
            for c in reversed(ORDER):
                before = less(c) | ((F.col(c) == F.lit(last[c])) & before)
            rest = rest.filter(before)
        open_ = saved(rest)
        if open_.isEmpty():
            return saved(taken.orderBy(*ordered_columns()).limit(target))


def quota_sample(pairs: DataFrame | Callable[[], DataFrame], quotas: list[tuple[str, int]], most_each: int, total: int, best: DataFrame | None = None, most: int = 0) -> DataFrame:
    """(bucket, a, b) of a sample of pairs (a, b, priority, second, buckets), `total` at most and no item in over most_each of them.

    The buckets of quotas are filled in turn, each with the best pairs that name it and aren't taken yet, up to its quota; then
    the best other pairs fill the sample, with bucket null. Best means a high priority, then a high second, then small
    items. This equals one walk over all pairs for each bucket; it is made in rounds over all rows at once, and only the sizes of samples
    reach the driver. A pair comes once, and not with itself; priority and second are not null.

    `best` (bucket, a, b, priority, second) may hold the first `most` pairs of each bucket, or all if they are fewer, and of all pairs with
    bucket null. A walk that fills its quota from these is the walk over all pairs, so all are only made for a bucket where they don't suffice;
    pairs may be a function that makes them.
    """
    all_pairs = functools.cache(lambda: saved((pairs() if callable(pairs) else pairs).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")))
    first = saved(best) if best is not None else None
    used = (all_pairs() if first is None else first).select(F.col("a").alias("item"), F.lit(0).alias("times")).limit(0)
    samples: list[DataFrame] = []
    left = total
    for bucket, quota in [*quotas, (None, total)]:
        target = min(quota, left)
        if not target:
            continue

        def walk(rows: DataFrame) -> DataFrame:
            for sample in samples:
                rows = rows.join(sample.select("a", "b"), ["a", "b"], "left_anti")
            return greedy_match(rows, used, most_each, target)

        got = None
        if first is not None:
            of_bucket = first.filter(F.col("bucket").eqNullSafe(F.lit(bucket).cast("string")))
            got = walk(of_bucket)
            if got.count() < target and of_bucket.count() >= most:
                got = None
        if got is None:
            got = walk(all_pairs() if bucket is None else all_pairs().filter(F.array_contains("buckets", bucket)))
        samples.append(got.select(F.lit(bucket).cast("string").alias("bucket"), "a", "b"))
        used = saved(used.union(times_of(got)).groupBy("item").agg(F.sum("times").cast("int").alias("times")))
        left -= got.count()
    return reduce(DataFrame.union, samples) if samples else used.select(F.lit(None).cast("string").alias("bucket"), F.col("item").alias("a"), F.col("item").alias("b")).limit(0)
