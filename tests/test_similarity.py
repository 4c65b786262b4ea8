"""Blocked similarity joins and parallel folds against walks over all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwright.operators import graph, greedy, vectors


def rounded(x):
    """Half up on the decimal digits, as Spark and DuckDB round."""
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(float(x))).quantize(Decimal("1e-6"), ROUND_HALF_UP))


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(9, 6))
    rows = []
    for i in range(400):
        v = centres[i % 9] + 0.35 * rng.normal(size=6)
        day = 3 if i % 3 == 0 else int(rng.integers(0, 30))  # a third of all rows on one day
        rows.append((i, day, (v / np.linalg.norm(v)).tolist()))
    rows += [(400, 3, rows[0][2]), (401, 3, None), (None, 3, rows[0][2]), (402, None, rows[0][2]), (403, 3, [1.0, 0.0]), (404, 3, [0.0] * 6), (405, 4, [1.0, 0.0])]
    return rows


@pytest.mark.parametrize(("block", "gap", "least"), [(16, 1, 0.9), (16, 0, 0.5), (512, 2.5, -1.0)])
def test_blocked_pairs_equal_all_pairs(spark, points, block, gap, least):
    df = spark.createDataFrame(points, "id long, day long, vector array<double>").withColumn("tile", F.lit("clash"))
    got = {(r.a, r.b): r.similarity for r in vectors.blocked_pairs(df, gap, least, block=block, pivots=8).collect()}
    want = {}
    for i, d, v in points:
        for j, e, w in points:
            if None in (i, j, d, e, v, w) or i >= j or abs(d - e) > gap or len(v) != len(w):
                continue
            s = rounded(sum(x * y for x, y in zip(v, w, strict=True)))
            if s >= least:
                want[i, j] = s
    assert got == want
    assert vectors.blocked_pairs(df.limit(0), 1, 0.5).count() == 0


def test_best_of_tiles_hold_best_of_all(spark, points):
    df = spark.createDataFrame(points, "id long, day long, vector array<double>")
    of = lambda top: vectors.blocked_pairs(df, 1, 0.5, top, block=16)
    best = {}
    for r in vectors.blocked_pairs(df, 1, 0.5, block=16).collect():
        best.setdefault(r.b, []).append((-r.similarity, r.a))
    got = {}
    for r in of(3).collect():
        got.setdefault(r.a, []).append((-r.similarity, r.b))
    assert {a: sorted(x)[:3] for a, x in got.items()} == {a: sorted(x)[:3] for a, x in best.items()}


def test_far_blocks_are_not_compared(spark):
    rows = [(i, 0, [1.0, 0.01 * (i % 5)] if i < 64 else [-1.0, 0.01 * (i % 5)]) for i in range(128)]
    df = spark.createDataFrame(rows, "id long, day long, vector array<double>")
    own = df.select("*", F.size("vector").alias("size"), F.floor("day").alias("bucket"), F.lit("").alias("key"), F.col("day").cast("double").alias("d")).drop("day").withColumnRenamed("d", "day")
    blocks = vectors.in_blocks(vectors.in_cells(own, 8), 16)
    n = blocks.filter("facts IS NOT NULL").count()
    tiles = vectors.tiles_of(blocks, 0, 0.9).count()
    assert n >= 8 and tiles < n * (n + 1) / 2 * 0.6


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    links = spark.createDataFrame([*chain, (100, 99), (99, 98), (7, 7), (50, 50), (None, 3), (3, None)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 98: 98, 99: 98, 100: 98, 50: 50}


def walk_clusters(rows, average, least, span):
    """Every row against every cluster so far."""
    clusters = []
    for r in sorted(rows, key=lambda r: (r["day"], -1 if r["rank"] is None else r["rank"], r["headline"].lower(), r["id"])):
        best, score = None, -1.0
        for c in clusters:
            days = [m["day"] for m in [*c, r]]
            if max(days) - min(days) > span:
                continue
            sims = [float(np.dot(m["vector"], r["vector"])) for m in c]
            token = r["token"] is not None and any(m["token"] == r["token"] for m in c)
            mean = sum(sims) / len(sims)
            if (token or (mean >= average and min(sims) >= least)) and (s := max(mean, 1.0 if token else mean)) > score:
                best, score = c, s
        if best is None:
            clusters.append([r])
        else:
            best.append(r)
    return clusters


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_one_walk(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, 8))
    rows = []
    for i in range(500):
        v = centres[rng.integers(25)] + 0.3 * rng.normal(size=8)
        token = f"t{rng.integers(30)}" if rng.random() < 0.2 else "hot" if rng.random() < 0.1 else None
        rows.append({"id": i, "day": float(rng.integers(0, 60)) / 2, "rank": int(rng.integers(1, 4)), "headline": f"H{rng.integers(99)}", "token": token, "vector": (v / np.linalg.norm(v)).tolist(), "k": ["x", "y", None][rng.integers(3)]})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "id long, day double, rank int, headline string, token string, vector array<double>, k string").withColumn("part", F.lit(1))
    got = {r.id: r for r in greedy.greedy_clusters(df, "k", 0.82, None, 4).collect()}
    assert len(got) == 500
    several = 0
    for key in ("x", "y", None):
        for c in walk_clusters([r for r in rows if r["k"] == key], 0.82, 0.77, 4):
            sims = [float(np.dot(a["vector"], b["vector"])) for i, a in enumerate(c) for b in c[:i]]
            for m in c:
                r = got[m["id"]]
                assert (r.cluster_id, r.size) == (c[0]["id"], len(c))
                assert r.weak == (bool(sims) and float(np.mean(sims)) < 0.86)
                assert (r.mean_similarity is None) == (not sims) and (not sims or abs(r.mean_similarity - np.mean(sims)) < 1e-9)
            several += len(c) > 1
    assert several > 20


def walk_sample(pairs, quotas, most_each, total):
    ordered = sorted(pairs, key=lambda p: (-p[2], -p[3], p[0], p[1]))
    taken, seen = [], {}
    for bucket, quota in [*quotas, (None, total)]:
        n = 0
        for a, b, _, _, buckets in ordered:
            if n >= quota or len(taken) >= total:
                break
            if bucket is not None and bucket not in buckets or any((a, b) == t[1:] for t in taken):
                continue
            if seen.get(a, 0) < most_each and seen.get(b, 0) < most_each:
                seen[a], seen[b] = seen.get(a, 0) + 1, seen.get(b, 0) + 1
                taken.append((bucket, a, b))
                n += 1
    return taken


@pytest.mark.parametrize(("seed", "most_each", "total"), [(1, 1, 60), (2, 2, 30), (3, 3, 1000)])
def test_sample_equals_one_walk(spark, seed, most_each, total):
    draw = random.Random(seed)
    pairs = {}
    for _ in range(600):
        a, b = draw.randrange(60), 100 + (0 if draw.random() < 0.3 else draw.randrange(60))  # one item in a third of all pairs
        pairs[a, b] = (a, b, float(draw.randrange(6)), float(draw.randrange(4)), draw.sample(["x", "y", "z"], draw.randrange(4)))
    df = spark.createDataFrame(list(pairs.values()), "a long, b long, priority double, second double, buckets array<string>").withColumn("item", F.lit(0))
    quotas = [("x", 12), ("y", 9), ("none", 5), ("z", 14)]
    got = [tuple(r) for r in greedy.quota_sample(df, quotas, most_each, total).collect()]
    assert sorted(got, key=str) == sorted(walk_sample(list(pairs.values()), quotas, most_each, total), key=str)


def test_sample_of_nothing(spark):
    df = spark.createDataFrame([], "a long, b long, priority double, second double, buckets array<string>")
    assert greedy.quota_sample(df, [("x", 3)], 2, 5).count() == 0
    assert greedy.quota_sample(spark.createDataFrame([(1, 1, 1.0, 1.0, ["x"]), (None, 2, 1.0, 1.0, None)], df.schema), [("x", 3)], 2, 5).count() == 0
