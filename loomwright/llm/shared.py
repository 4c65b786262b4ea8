"""What several operators of this subpackage need: scratch tables and Arrow maps."""

from __future__ import annotations

import contextlib
import ctypes
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.sources.scratch import remove, scratch_dir

#: Crc32 of an id's decimal text, modulo 4; rows with this remainder are held out of every fit.
HELD_OUT_REMAINDER = 2


def held_out(doc_id: Column) -> Column:
    """True for rows no model may learn from. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT_REMAINDER, F.lit(False))


#: Folders of the tables that saved() has made, and lists of those made meanwhile that a caller keeps.
_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_lists: list[list[str]] = []


def saved(df: DataFrame) -> DataFrame:
    """Write df to the shared folder as Parquet and read it again: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[out] = path
    for held in _lists:
        held.append(path)
    return out


def free(*tables: DataFrame) -> None:
    """Delete what saved() wrote for tables that nothing reads any more."""
    for df in tables:
        if path := _folders.pop(df, None):
            remove(df.sparkSession, path)


@contextlib.contextmanager
def listed(paths: list[str]) -> Iterator[None]:
    """Add the folders that saved() makes within to paths."""
    _lists.append(paths)
    try:
        yield
    finally:
        _lists.pop()


@contextlib.contextmanager
def only_last(spark: SparkSession) -> Iterator[None]:
    """Delete what saved() has made within, but for its last table."""
    made: list[str] = []
    with listed(made):
        yield
    remove(spark, *made[:-1])


#: Bytes of a table that is broadcast. The driver holds its rows, their hash table and its written form at once, a multiple of that.
BROADCAST_BYTES = 8 << 20


def bounded(df: DataFrame, most_rows: int, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df, which saved() has made, marked for broadcast if it is small in rows and bytes; else the same join runs by shuffle."""
    wide = [F.sum(F.octet_length(c)) for c, kind in df.dtypes if kind in ("string", "binary")]
    wide += [F.sum(F.size(c)) * 8 for c, kind in df.dtypes if kind.startswith("array<") and kind[6:-1] in ("int", "bigint", "double")]
    rows, *sizes = df.agg(F.count(F.lit(1)), *wide).first()
    return F.broadcast(df) if rows <= most_rows and sum(x or 0 for x in sizes) + 16 * rows * (len(df.columns) + 1) <= most_bytes else df


def small_batches(spark: SparkSession, most_bytes: int = 4 << 20) -> None:
    """From now on the session hands Python batches of at most most_bytes, whatever the number of rows; a lower limit stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int("".join(filter(str.isdigit, str(spark.conf.get(name)))) or 0) > most_bytes:
        spark.conf.set(name, str(most_bytes))


def trim() -> None:
    """Give memory that Python and Arrow hold but don't use back to the system: a worker lives on after its task, beside others."""
    pa.default_memory_pool().release_unused()
    if release := getattr(ctypes.CDLL(None), "malloc_trim", None):
        release(0)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply make()'s function to each Arrow batch of df; make runs once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(run, schema)


def slices(texts: list[str | None], most_chars: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of consecutive runs holding about most_chars; null counts as empty, no text is cut."""
    start, held, size = 0, [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= most_chars:
            yield start, held
            start, held, size = start + len(held), [], 0
    if held:
        yield start, held


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
