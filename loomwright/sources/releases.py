"""Releases that appear whole: data first, then one rename that makes a revision visible; former revisions stay."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.sources.scratch import remove

MANIFEST = re.compile(r"revision-(\d{6})\.json")


class ReleaseError(Exception):
    """A release that is refused."""


def store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Write a small text file that readers see whole or not at all: a file beside it is renamed to its name.

    Without overwrite, a file of that name is an error, also if another writer has made it meanwhile.
    """
    jvm, (files, where) = spark._jvm, store(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = files.create(beside, False)
    try:
        out.write(bytearray(text.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE if overwrite else rename.NONE
        context.rename(files.makeQualified(beside), files.makeQualified(where), options)
    except Exception:
        files.delete(beside, False)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    files, where = store(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """The manifests of a release's revisions, the oldest first."""
    files, where = store(spark, path)
    if not files.exists(where):
        return []
    names = sorted(s.getPath().getName() for s in files.listStatus(where))
    return [json.loads(read_text(spark, f"{path}/{n}")) for n in names if MANIFEST.fullmatch(n)]


def write_release(df: DataFrame, path: str, replace: bool = False) -> dict:
    """Write df as the next revision of the release in folder path; its manifest.

    Rows go to a folder of their own; then a manifest with the revision's number, rows and digest is renamed to its
    place, which is what makes the revision exist. If a task fails, or another writer takes the number first, nothing has changed for readers, and
    what was written is deleted. A release that is there is refused unless replaced; then it stays as an earlier revision.
    """
    spark = df.sparkSession
    before = manifests(spark, path)
    if before and not replace:
        raise ReleaseError(f"{path} has revision {before[-1]['revision']}; replace it to add another one")
    revision = before[-1]["revision"] + 1 if before else 1
    folder = f"{path}/data-{revision:06d}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(folder)
        written = spark.read.schema(df.schema).parquet(folder)
        # A sum of hashes of rows doesn't depend on their order.
        facts = written.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*written.columns).cast("decimal(38,0)")).cast("string").alias("digest")).first()
        manifest = {"revision": revision, "data": folder.rpartition("/")[2], "rows": facts["rows"], "digest": facts["digest"]}
        write_text(spark, f"{path}/revision-{revision:06d}.json", json.dumps(manifest, sort_keys=True), overwrite=False)
    except Exception:
        remove(spark, folder)
        raise
    return manifest


def read_release(spark: SparkSession, path: str, revision: int | None = None) -> DataFrame:
    """The rows of a revision, the newest if none is named; a release or revision that isn't there is an error."""
    found = [m for m in manifests(spark, path) if revision in (None, m["revision"])]
    if not found:
        raise ReleaseError(f"{path} has no revision {revision or ''}".rstrip())
    return spark.read.parquet(f"{path}/{found[-1]['data']}")


def all_revisions(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all revisions, each with its number in `revision`."""
    found = manifests(spark, path)
    if not found:
        raise ReleaseError(f"{path} has no revision")
    out = None
    for m in found:
        rows = spark.read.parquet(f"{path}/{m['data']}").withColumn("revision", F.lit(m["revision"]))
        out = rows if out is None else out.unionByName(rows)
    return out
