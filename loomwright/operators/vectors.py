"""Similarity of vectors: an exact join in blocks, best candidates, centroids."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.sources.scratch import saved

#: Vectors of one block, and vectors that name the cells of like vectors.
BLOCK, PIVOTS = 512, 64
#: What a similarity may gain by rounding, or a product by another order of additions.
SLACK = 1e-6


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision, 6 digits."""
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.round(F.aggregate(product, F.lit(0.0), lambda acc, x: acc + x), 6)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def appended(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches sorted by a whole number, cut so that no value stands in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch])
        values = rows[key].to_numpy()
        last = int(np.searchsorted(values, values[-1]))
        if last:
            yield rows.slice(0, last)
        held = rows.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def in_cells(rows: DataFrame, pivots: int) -> DataFrame:
    """rows with `cell`, the place of the nearest of some vectors that are taken by hash: like vectors share cells.

    Cells only decide which vectors share a block, so any choice gives the same pairs.
    """
    some = rows.select("size", "vector", F.xxhash64("id").alias("h")).orderBy("h").limit(pivots).collect()
    by_size: dict[int, np.ndarray] = {}
    for size in {r["size"] for r in some}:
        by_size[size] = np.array([r["vector"] for r in some if r["size"] == size], dtype=float)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, cells = batch.column("size").to_numpy(), np.zeros(batch.num_rows, dtype=np.int32)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                if size in by_size and size:
                    cells[at] = np.argmax(matrix(batch.column("vector").take(pa.array(at))) @ by_size[size].T, axis=1)
            yield appended(batch, cell=pa.array(cells, pa.int32()))

    return rows.mapInArrow(assign, f"{columns_of(rows)}, cell int")


def columns_of(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)


def in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """rows in blocks of at most `block` like vectors of one key, bucket of days and length; written to the shared folder.

    Rows are dealt by ranges of (key, bucket, size, cell, id), so the rows of one day lie in many tasks. The first row of a block also tells
    the block's days, its mean vector, and how far the farthest vector lies from that.
    """
    by = ["key", "bucket", "size", "cell", "id"]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held = None
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held is not None else pa.Table.from_batches([batch])
            while held.num_rows:
                same = np.ones(held.num_rows, dtype=bool)
                for c in by[:-1]:
                    values = held[c].to_numpy()
                    same &= values == values[0]
                n = min(block, held.num_rows if same.all() else int(same.argmin()))
                if n == held.num_rows and n < block:
                    break  # The block may go on in the next batch.
                yield held.slice(0, n)
                held = held.slice(n)
        if held is not None and held.num_rows:
            yield held

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, rows in enumerate(cut(batches)):
            vectors, days, n = matrix(rows["vector"]), rows["day"].to_numpy(), rows.num_rows
            mean = vectors.mean(axis=0)
            radius = float(np.sqrt(((vectors - mean) ** 2).sum(axis=1).max())) if vectors.size else 0.0
            facts = [{"first": float(days.min()), "last": float(days.max()), "mean": mean.tolist(), "radius": radius}, *[None] * (n - 1)]
            kind = pa.struct([("first", pa.float64()), ("last", pa.float64()), ("mean", pa.list_(pa.float64())), ("radius", pa.float64())])
            columns = [*[c.combine_chunks() for c in rows.columns], pa.array([(part << 32) + k] * n, pa.int64()), pa.array(facts, kind)]
            yield pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns], names=[*rows.schema.names, "block", "facts"])

    return saved(dealt.mapInArrow(number, f"{columns_of(rows)}, block long, facts struct<first:double,last:double,mean:array<double>,radius:double>"))


def tiles_of(blocks: DataFrame, gap: float, least: float) -> DataFrame:
    """(x, y) of the blocks that may hold a pair, x <= y: near enough in time, and by their means and radii alike enough.

    With vectors m + u and n + v, no product exceeds m n + |m| |v| + |n| |u| + |u| |v|.
    """
    facts = blocks.filter("facts IS NOT NULL").select("key", "bucket", "size", "block", "facts.*")
    norm = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda acc, x: acc + x * x))
    facts = saved(facts.withColumn("norm", norm))
    x = facts.select("key", "size", F.explode(F.array(*[F.col("bucket") + k for k in (-1, 0, 1)])).alias("bucket"), *[F.col(c).alias(f"x_{c}") for c in ("block", "first", "last", "mean", "radius", "norm")])
    met = x.join(facts, ["key", "bucket", "size"]).filter(F.col("x_block") <= F.col("block"))
    near = (F.col("first") - F.col("x_last") <= gap) & (F.col("x_first") - F.col("last") <= gap)
    product = F.aggregate(F.zip_with("x_mean", "mean", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    most = product + F.col("x_norm") * F.col("radius") + F.col("norm") * F.col("x_radius") + F.col("x_radius") * F.col("radius")
    return met.filter(near & (most >= least - SLACK)).select(F.col("x_block").alias("x"), F.col("block").alias("y"))


#: Which of the pairs (smaller id, larger id, similarity) are of a kind.
Kind = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class Best:
    """The pairs seen so far that may be among the `most` best of one of the kinds; memory is `most` numbers a kind."""

    def __init__(self, kinds: list[Kind], most: int) -> None:
        self.kinds, self.most = kinds, most
        self.held = [np.zeros(0) for _ in kinds]

    def __call__(self, a: np.ndarray, b: np.ndarray, products: np.ndarray) -> np.ndarray:
        chosen = np.zeros(len(products), dtype=bool)
        for k, kind in enumerate(self.kinds):
            # A product is rounded later, so it may still change its kind or its place by SLACK.
            around = [kind(a, b, products + d) for d in (-SLACK, 0.0, SLACK)]
            own = np.concatenate([self.held[k], products[np.logical_and.reduce(around)]])
            if len(own) > self.most:
                own = np.partition(own, len(own) - self.most)[-self.most :]
            self.held[k] = own
            least = own.min() if len(own) == self.most else -np.inf
            chosen |= np.logical_or.reduce(around) & (products >= least - 4 * SLACK)
        return chosen


def blocked_pairs(df: DataFrame, gap: float, least: float, top: int | None = None, key: str | None = None, block: int = BLOCK, pivots: int = PIVOTS, best: tuple[list[Kind], int] | None = None) -> DataFrame:
    """(a, b, similarity) of all pairs of rows (id, day, vector) at most gap days apart with a similarity of at least `least`.

    Each pair comes once, a < b, and its similarity is dot() of the two. With `key`, both have the same value in that column, which is text. With `top`, a is the larger id, and only the best
    `top` of each a are returned from a tile: a superset of the best of all, for a second reduce. With `best` (kinds, most), a task returns
    what may be among the `most` most similar pairs of a kind: again a superset, and a bounded one where pairs are many.

    Rows lie in blocks; each pair of blocks that may hold a pair is a tile of its own, wherever its rows come from, so a day
    with most rows is compared by many tasks. A tile is one product of matrices. Pairs within `least` are multiplied
    again in the order of the vector, so the result does not depend on the blocks. Rows with a null id, day or vector
    are in no pair, nor are vectors of different lengths. Other columns are not read.
    """
    rows = df.select("id", F.col("day").cast("double").alias("day"), "vector", (F.col(key) if key else F.lit("")).alias("key")).dropna()
    rows = rows.select("*", F.size("vector").alias("size"), F.floor(F.col("day") / (gap + 1)).alias("bucket"))
    blocks = in_blocks(in_cells(rows, pivots), block)
    tiles = tiles_of(blocks, gap, least).withColumn("tile", F.xxhash64("x", "y"))
    sides = F.when(F.col("x") == F.col("y"), F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("block"))))
    sides = sides.otherwise(F.array(*[F.struct(F.lit(k).alias("side"), F.col(c).alias("block")) for k, c in enumerate("xy")]))
    dealt = tiles.select("tile", "x", "y", F.explode(sides).alias("s")).select("tile", "x", "y", "s.side", "s.block").join(blocks.select("block", "id", "day", "vector"), "block")
    dealt = dealt.repartition("tile").sortWithinPartitions("tile", "x", "y", "side")
    id_kind = df.schema["id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Best(*best) if best else None
        for rows in whole_runs(batches, "tile"):
            x_block, y_block, side, day, ids = (rows[c].to_numpy() for c in ("x", "y", "side", "day", "id"))
            starts = np.flatnonzero(np.r_[True, (x_block[1:] != x_block[:-1]) | (y_block[1:] != y_block[:-1])])
            for start, end in zip(starts, [*starts[1:], len(side)], strict=True):
                vectors = matrix(rows["vector"].slice(start, end - start))
                cut = int(np.searchsorted(side[start:end], 1))
                left, right = (slice(0, cut), slice(cut, None)) if cut < end - start else (slice(0, None), slice(0, None))
                product = vectors[left] @ vectors[right].T
                near = product >= least - SLACK
                days, own = day[start:end], ids[start:end]
                near &= np.abs(days[left][:, None] - days[right][None, :]) <= gap
                if left == right:
                    near &= own[left][:, None] < own[right][None, :]
                i, j = np.nonzero(near)
                x, y = own[left][i], own[right][j]
                if chosen:
                    kept = chosen(np.minimum(x, y), np.maximum(x, y), product[i, j])
                    i, j, x, y = i[kept], j[kept], x[kept], y[kept]
                products = np.empty(len(i))
                for k in range(0, len(i), 1 << 16):  # In the vector's order, some at a time.
                    products[k : k + (1 << 16)] = np.cumsum(vectors[left][i[k : k + (1 << 16)]] * vectors[right][j[k : k + (1 << 16)]], axis=1)[:, -1]
                a, b = (np.maximum(x, y), np.minimum(x, y)) if top else (np.minimum(x, y), np.maximum(x, y))
                if top and len(a):
                    # Rounded products may tie, so near ties of the last one stay.
                    order = np.lexsort((b, -products, a))
                    firsts = np.flatnonzero(np.r_[True, a[order][1:] != a[order][:-1]])
                    place = np.arange(len(a)) - np.repeat(firsts, np.diff(np.r_[firsts, len(a)]))
                    limit = np.repeat(products[order][np.minimum(firsts + top - 1, np.r_[firsts[1:], len(a)] - 1)], np.diff(np.r_[firsts, len(a)]))
                    order = order[(place < top) | (products[order] >= limit - 2e-6)]
                    a, b, products = a[order], b[order], products[order]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(products)], names=["a", "b", "product"])

    found = dealt.mapInArrow(compare, f"a {id_kind}, b {id_kind}, product double")
    return found.select("a", "b", F.round("product", 6).alias("similarity")).filter(F.col("similarity") >= least)


def cohesion(df: DataFrame, key: str) -> DataFrame:
    """(key, members, first_day, last_day, pairs, mean_similarity, least_similarity) of the clusters of rows (id, day, vector, key).

    A cluster of one has no similarities. Pairs are made in blocks and summed up by task, so a large cluster lies in many tasks.
    """
    rows = df.filter(F.col(key).isNotNull())
    facts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("members"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    own = rows.select("id", F.lit(0).alias("day"), "vector", F.col(key).cast("string").alias("key"))
    pairs = blocked_pairs(own, 0, -1e300, key="key").join(rows.select(F.col("id").alias("a"), key), "a")
    means = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("similarity"), 4).alias("mean_similarity"), F.round(F.min("similarity"), 4).alias("least_similarity"))
    return facts.join(means, key, "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)).cast("long"))


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, place, value) of the mean vectors of each key, normalised to length 1."""
    flat = df.select(key, F.posexplode(vector).alias("place", "x"))
    mean = flat.groupBy(key, "place").agg(F.avg(F.col("x").cast("double")).alias("m"))
    norm = mean.groupBy(key).agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("norm"))
    return mean.join(norm, key).select(key, "place", F.round(F.col("m") / F.nullif(F.col("norm"), F.lit(0.0)), 6).alias("value"))
