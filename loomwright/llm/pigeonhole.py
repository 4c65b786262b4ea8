"""Links between 64-bit fingerprints by the generalised pigeonhole principle."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

BITS = 64
#: Fingerprints in one bucket from which on pairs within it are found by shared neighbours instead.
HOT = 64


@dataclass
class Plan:
    """Parts of the bits, each a mask, and the radius within which each part is probed (-1: not at all)."""

    masks: list[int]
    radii: list[int]


def bit_matrix(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of like size, each grown from its most correlated pair of free bits."""
    if len(bits) > 2:
        deviation = bits - bits.mean(axis=0)
        norm = np.sqrt((deviation**2).sum(axis=0))
        like = np.abs(deviation.T @ deviation) / np.maximum(np.outer(norm, norm), 1e-9)
    else:
        like = np.zeros((BITS, BITS))
    np.fill_diagonal(like, -1.0)
    free, out = set(range(BITS)), []
    for p in range(parts):
        size = len(free) // (parts - p)
        order = sorted(free)
        table = like[np.ix_(order, order)]
        i, j = np.unravel_index(int(table.argmax()), table.shape)
        part = [order[i]] if i == j or size < 2 else [order[i], order[j]]
        while len(part) < size:
            rest = [b for b in order if b not in part]
            part.append(rest[int(like[np.ix_(part, rest)].sum(axis=0).argmax())])
        out.append(sorted(part))
        free -= set(part)
    return out


def ball(bits: int, radius: int) -> int:
    return sum(comb(bits, k) for k in range(radius + 1))


def choose_plan(sample: np.ndarray, total: int, distance: int) -> Plan:
    """The parts and radii with the least estimated work for finding all pairs within `distance`.

    Of m parts with radii that sum to distance - m + 1, one part of every such pair is within its radius. For each
    m, bits are grouped by correlation; a dynamic programme gives each part its radius, where a radius costs its
    probes and the candidates they meet, estimated from the sample's pairs and from even bits.
    """
    bits = bit_matrix(sample)
    best: tuple[float, Plan] | None = None
    for m in range(1, distance + 2):
        parts = correlated_parts(bits, m)
        costs = []
        for part in parts:
            own = bits[:, part].astype(np.float32)
            ones = own.sum(axis=1)
            gap = ones[:, None] + ones[None, :] - 2 * own @ own.T
            pairs = gap[np.triu_indices(len(own), 1)]
            cost = {-1: 0.0}
            for t in range(distance + 1):
                even = ball(len(part), t) / 2.0 ** len(part)
                seen = float((pairs <= t).mean()) if len(pairs) else 0.0
                cost[t] = total * (1 + ball(len(part), t) + total * max(even, seen))
            costs.append(cost)
        reached: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            after: dict[int, tuple[float, list[int]]] = {}
            for used, (spent, radii) in reached.items():
                for t, c in cost.items():
                    at = used + t + 1
                    if at <= distance + 1 and (at not in after or spent + c < after[at][0]):
                        after[at] = (spent + c, [*radii, t])
            reached = after
        spent, radii = reached[distance + 1]
        if best is None or spent < best[0]:
            best = (spent, Plan([sum(1 << b for b in part) for part in parts], radii))
    return best[1]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def flips(mask: int, radius: int) -> list[int]:
    """All patterns of at most radius bits of mask, as signed longs."""
    places = [b for b in range(BITS) if mask >> b & 1]
    return [signed(sum(1 << b for b in some)) for k in range(radius + 1) for some in combinations(places, k)]


def near_links(prints: DataFrame, distance: int = 2, sample_rows: int = 2_000, space: str | None = None) -> DataFrame:
    """(a, b) links that join all fingerprints (column fp, distinct) at `distance` or fewer differing bits.

    The plan is made from at most sample_rows fingerprints by hash and their number. Each fingerprint goes to the
    bucket of its bits in each part that is probed, and probes the buckets within the radius; pairs are verified.
    Pairs of fingerprints that both lie in buckets of over HOT members are not listed: those fingerprints go to all
    values within distance / 2 bits, and each value's fingerprints are linked in a star to their smallest,
    which keeps every component and has a bounded number of rows a fingerprint. Every link holds: two fingerprints
    at one value differ in at most `distance` bits. distance must be even.

    With `space`, a column of small integers, only fingerprints of equal space are linked, and links carry it.
    """
    if distance % 2:
        raise ValueError("distance must be even")
    extra = [space] if space else []
    total = prints.count()
    sample = prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample_rows).collect()
    plan = choose_plan(np.array([r.fp & (2**64 - 1) for r in sample], dtype=np.uint64), max(total, 1), distance)
    used = [(i, m, r) for i, (m, r) in enumerate(zip(plan.masks, plan.radii, strict=True)) if r >= 0]

    def spread(values_of) -> F.Column:
        return F.explode(F.concat(*[values_of(i, mask, radius) for i, mask, radius in used]))

    def masked(mask: int):
        return F.col("fp").bitwiseAND(F.lit(signed(mask)))

    data = prints.select(*extra, "fp", spread(lambda i, mask, _: F.array(F.struct(F.lit(i).alias("piece"), masked(mask).alias("key")))).alias("k")).select(*extra, "fp", "k.piece", "k.key")
    key = [*extra, "piece", "key"]
    count = F.count(F.lit(1)).over(Window.partitionBy(*key))
    data = data.withColumn("n", count)
    if not any(radius for _, _, radius in used):
        # Nothing probes a bucket of one.
        data = data.filter("n > 1")
    data = saved(data.withColumn("hot", F.col("n") > HOT).drop("n"))
    probes = data
    if any(radius for _, _, radius in used):
        masks = F.array(*[F.lit(None).cast("array<long>") if r < 0 else F.array(*[F.lit(x) for x in flips(m, r)]) for m, r in zip(plan.masks, plan.radii, strict=True)])
        probes = data.select(*extra, "fp", "piece", "key", "hot", F.explode(masks[F.col("piece")]).alias("x")).withColumn("key", F.col("key").bitwiseXOR(F.col("x"))).drop("x")
    a, b = data.alias("a"), probes.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in key]
    pairs = a.join(b, [*same, ~(F.col("a.hot") & F.col("b.hot")), F.col("a.fp") != F.col("b.fp")])
    pairs = pairs.filter(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance)
    pairs = pairs.select(*[F.col(f"a.{c}").alias(c) for c in extra], F.least("a.fp", "b.fp").alias("a"), F.greatest("a.fp", "b.fp").alias("b"))
    hot = data.filter("hot").select(*extra, "fp").distinct()
    around = F.explode(F.array(*[F.lit(x) for x in flips((1 << BITS) - 1, distance // 2)]))
    values = hot.select(*extra, "fp", around.alias("x")).select(*extra, "fp", F.col("fp").bitwiseXOR(F.col("x")).alias("value"))
    centres = values.groupBy(*extra, "value").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    stars = values.join(centres, [*extra, "value"]).filter("fp <> a").select(*extra, "a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()
