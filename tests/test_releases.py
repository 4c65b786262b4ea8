"""Releases appear whole, are refused unless replaced, and keep their revisions; models are plugged in; articles join events in any split."""

import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomwright.operators import models
from loomwright.sources import releases
from loomwright.streaming import events


def test_revisions_stay(spark, tmp_path):
    path = f"file://{tmp_path}/week"
    rows = spark.range(5).withColumn("t", F.lit("a"))
    with pytest.raises(releases.ReleaseError, match="no revision"):
        releases.read_release(spark, path)
    first = releases.write_release(rows, path)
    with pytest.raises(releases.ReleaseError, match="has revision 1"):
        releases.write_release(rows, path)
    found = [first] + [releases.write_release(rows.limit(n), path, replace=True) for n in (3, 2, 0)]
    assert [m["revision"] for m in found] == [1, 2, 3, 4] and [m["rows"] for m in releases.manifests(spark, path)] == [5, 3, 2, 0]
    assert releases.read_release(spark, path).count() == 0 and releases.read_release(spark, path, 1).count() == 5
    assert releases.all_revisions(spark, path).groupBy("revision").count().orderBy("revision").collect()[0]["count"] == 5
    with pytest.raises(releases.ReleaseError, match="no revision 9"):
        releases.read_release(spark, path, 9)


def test_digest_ignores_order(spark, tmp_path):
    rows = spark.range(100).withColumn("t", F.col("id") % 7)
    a = releases.write_release(rows, f"file://{tmp_path}/a")
    b = releases.write_release(rows.orderBy(F.desc("id")).repartition(3), f"file://{tmp_path}/b")
    c = releases.write_release(rows.withColumn("t", F.lit(1).cast("long")), f"file://{tmp_path}/c")
    assert a["digest"] == b["digest"] != c["digest"]


def test_failed_task_changes_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/week"
    releases.write_release(spark.range(5), path)
    bad = spark.range(50).select(F.when(F.col("id") == 49, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        releases.write_release(bad, path, replace=True)
    assert len(releases.manifests(spark, path)) == 1 and releases.read_release(spark, path).count() == 5
    assert sorted(n[:8] for n in os.listdir(tmp_path / "week") if not n.startswith(".")) == ["data-000", "revision"]


def test_other_writer_was_first(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/week"
    releases.write_release(spark.range(5), path)
    seen = releases.manifests
    monkeypatch.setattr(releases, "manifests", lambda s, p: seen(s, p)[:0])
    with pytest.raises(Exception, match="exists"):
        releases.write_release(spark.range(1), path)
    monkeypatch.undo()
    assert releases.read_release(spark, path).count() == 5 and sum(n.startswith("data") for n in os.listdir(tmp_path / "week")) == 1


def test_small_files_are_whole(spark, tmp_path):
    path = f"file://{tmp_path}/x.json"
    releases.write_text(spark, path, "é1")
    releases.write_text(spark, path, "22")
    assert releases.read_text(spark, path) == "22" and not [n for n in os.listdir(tmp_path) if n.endswith(".tmp")]
    with pytest.raises(Exception, match="exists"):
        releases.write_text(spark, path, "3", overwrite=False)
    assert releases.read_text(spark, path) == "22"


# Models


def test_models(spark):
    def lengths():
        """A model that counts letters and refuses what it must not see."""

        def model(rows: pd.DataFrame) -> np.ndarray:
            assert 0 < len(rows) <= 4 and rows["text"].notna().all()
            return rows["text"].str.len() + rows["more"].astype(float)

        return model

    rows = [(i, None if i % 5 == 0 else "x" * (i % 9), None if i % 7 == 3 else i) for i in range(53)]
    df = spark.createDataFrame(rows, "id int, t string, m int").repartition(3)
    inputs = {"text": F.col("t"), "more": F.col("m")}
    got = {r.id: r.score for r in models.scored(df, inputs, "lengths", lengths, F.lit(-1.0), size=4).collect()}
    assert got == {i: -1.0 if t is None or m is None else float(len(t) + m) for i, t, m in rows}
    other = models.scored(df, {"v": F.col("m")}, "double", lambda: lambda rows: rows["v"] * 2.0, size=1000, out="twice")
    assert {r.id: r.twice for r in other.collect()} == {i: None if m is None else 2.0 * m for i, _, m in rows}
    assert {r.score for r in models.scored(df, inputs, "none", default=F.col("id") * 0.5).filter("id = 8").collect()} == {4.0}
    assert models.scored(df.limit(0), inputs, "lengths", lengths).count() == 0
    with pytest.raises(Exception, match="answers for"):
        models.scored(df, {"v": F.col("m")}, "short", lambda: lambda rows: np.zeros(1), size=4).collect()


def test_models_are_loaded_once():
    models.LOADED.clear()
    made = []
    for _ in range(3):
        models.loaded("a", lambda: made.append(1) or (lambda rows: rows))
    assert len(made) == 1
    assert models.in_batches(pd.DataFrame({"v": range(10)}), lambda r: np.full(len(r), len(r)), 4).tolist() == [4.0] * 8 + [2.0] * 2


# The event store


def articles(n, seed):
    rng, draw = np.random.default_rng(seed), random.Random(seed)
    centres = rng.normal(size=(8, 5))
    start = pd.Timestamp("2024-01-01", tz="UTC")
    rows = []
    for i in range(n):
        v = centres[draw.randrange(8)] + 0.25 * rng.normal(size=5)
        token = f"t{draw.randrange(6)}" if draw.random() < 0.2 else None
        rows.append((draw.choice(["nl", "nl", "fr"]), i, (start + pd.Timedelta(hours=7 * i)).to_pydatetime(), token, (v / np.linalg.norm(v)).tolist()))
    return rows


COLUMNS = "market string, id long, ts timestamp, token string, vector array<double>"


@pytest.mark.parametrize("cuts", [[120], [30, 31, 80, 120]])
def test_stream_equals_batch_in_any_split(spark, tmp_path, cuts):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = articles(120, 5)
    want = {r.id: tuple(r) for r in events.resolved_batch(spark.createDataFrame([*rows, (None, 1, rows[0][2], None, rows[0][4]), ("nl", 999, None, None, None)], COLUMNS), keep=12.0).collect()}
    assert len(want) == 120 and {r[3] for r in want.values()} == {"merged", "new_event"}
    start, got = 0, {}
    for k, end in enumerate(cuts):
        # Each run of the stream is a restart from its checkpoint.
        spark.createDataFrame(rows[start:end], COLUMNS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(COLUMNS).parquet(str(tmp_path / "in"))
        run = events.resolved_stream(stream, keep=12.0).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        run.awaitTermination(120)
        assert run.exception() is None
        start = end
    for r in spark.read.parquet(str(tmp_path / "out")).collect():
        assert r.id not in got
        got[r.id] = tuple(r)
    same = lambda x, y: x is None and y is None or x is not None and y is not None and abs(x - y) < 1e-9
    assert set(got) == set(want)
    for i, r in want.items():
        assert got[i][:5] == r[:5] and same(got[i][5], r[5]) and same(got[i][6], r[6])


def test_decisions_can_be_plugged_in(spark):
    rows = articles(60, 6)
    alone = events.resolved_batch(spark.createDataFrame(rows, COLUMNS), decide=lambda article, best, second, token: False)
    assert {r.decision for r in alone.collect()} == {"new_event"}
    assert events.resolved_batch(spark.createDataFrame([], COLUMNS)).count() == 0
