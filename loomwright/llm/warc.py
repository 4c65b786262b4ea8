"""WARC archives as seekable Zstandard bundles: independent frames, a seek table at the end, an index of records."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bounded, saved

#: Fixed values of the seekable format: magic numbers of the skippable frame that holds the table, and of its footer.
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, record_type string, bundle string, frame long, at long, length long"
RECORD = "bundle string, frame long, at long, length long, record_id string, record_type string, id string, refers_to string, url string, payload_digest string, payload_bytes long, payload binary"


def record_name(value: object) -> str:
    """The identifier of a page's record; rows of one id share it, and a null id has its own."""
    return "<urn:page>" if value is None else f"<urn:page:{quote(str(value), safe='')}>"


def id_of(name: str | None) -> str | None:
    return unquote(name[len("<urn:page:") : -1]) if name and name.startswith("<urn:page:") else None


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(name: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """A response record, or a revisit record if refers_to names one: that has the headers of the answer but no payload."""
    headers = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = headers + (b"" if refers_to else payload)
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", name), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to:
        fields += [("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def parsed(data: bytes, at: int) -> tuple[dict, int]:
    """(facts of the record that begins at `at`, where the next one begins); a payload that its digest denies is an error."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no record at {at}: {first[:40]!r}")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    start, size = end + 4, int(fields["content-length"])
    block, after = data[start : start + size], start + size + 4
    if len(block) != size or data[after - 4 : after] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut short")
    cut = block.index(b"\r\n\r\n") + 4
    n_bytes = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", block[:cut])[1])
    kind, name, digest = fields["warc-type"], fields["warc-record-id"], fields["warc-payload-digest"].removeprefix("sha1:")
    payload = block[cut:] if kind == "response" else None
    if payload is not None and (len(payload) != n_bytes or base32_sha1(payload) != digest):
        raise ValueError(f"{name}: the payload differs from its digest")
    out = {"at": at, "length": after - at, "record_id": name, "record_type": kind, "id": id_of(name), "refers_to": id_of(fields.get("warc-refers-to"))}
    return out | {"url": fields.get("warc-target-uri"), "payload_digest": digest, "payload_bytes": n_bytes, "payload": payload}, after


class Bundle:
    """A file that is being written: records gather to a frame of about frame_bytes, frames to a file."""

    def __init__(self, store: fs.FileSystem, path: str, frame_bytes: int, level: int) -> None:
        self.out = store.open_output_stream(path, compression=None)  # else the name decides
        self.frame_bytes, self.zip = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.held, self.sizes, self.written = bytearray(), [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Append a record; its frame and place there."""
        if self.held and len(self.held) + len(data) > self.frame_bytes:
            self.flush()
        place = len(self.sizes), len(self.held)
        self.held += data
        return place

    def flush(self) -> None:
        packed = self.zip.compress(bytes(self.held))
        self.out.write(packed)
        self.sizes.append((len(packed), len(self.held)))
        self.written += len(packed)
        self.held.clear()

    def close(self) -> None:
        if self.held:
            self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.out.close()


class Seekable:
    """A written file: its seek table, and frames by number."""

    def __init__(self, uri: str) -> None:
        store, path = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(path)
        end = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != FOOTER:
            raise ValueError(f"{uri} has no seek table")
        entry = 12 if flags & 0x80 else 8
        table = self.file.read_at(frames * entry, end - 9 - frames * entry)
        self.sizes = [struct.unpack_from("<II", table, k * entry) for k in range(frames)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        self.unzip = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> bytes:
        packed, size = self.sizes[k]
        return self.unzip.decompress(self.file.read_at(packed, self.starts[k]), max_output_size=size)


def uri_of(spark: SparkSession, path: str) -> str:
    """A path with the scheme of its store, as the executors open it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return re.sub(r"^file:/(?!/)", "file:///", uri)


def with_originals(pages: DataFrame, id_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """pages with `keep`, the smallest id of the rows that have the same payload, and `copy`: is there such a row with another id.

    Only digests of payloads are grouped. Payloads that occur once need no partner, so the rows that occur more often
    are joined: broadcast if they are few and small, else by digest, which Spark splits where one is hot.
    """
    key = [F.sha1("_payload").alias("_sha"), F.octet_length("_payload").cast("long").alias("_n")]
    own = pages.withColumn("_payload", F.coalesce(F.col(html_col), F.lit("")).cast("binary"))
    groups = own.select(F.col(id_col).alias("_id"), *key).filter(F.col("_n") >= least_bytes).groupBy("_sha", "_n").agg(F.min("_id").alias("keep"), F.count(F.lit(1)).alias("_rows"))
    many = saved(groups.filter("_rows > 1 AND keep IS NOT NULL").select("_sha", "_n", "keep"))
    joined = own.select("*", *key).join(bounded(many, 200_000), ["_sha", "_n"], "left")
    return joined.withColumn("copy", F.col("keep").isNotNull() & ~F.col("keep").eqNullSafe(F.col(id_col)))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = 0, frame_bytes: int = 1 << 20, bundle_bytes: int = 256 << 20, level: int = 3, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record of each row of pages to bundles in folder; INDEX of all records: where each one lies.

    The payload is the html in UTF-8, null as empty. Of records with equal payloads of at least least_bytes, the one
    with the smallest id is a response and the others are revisits of it; rows that repeat an id and its payload are all
    responses, and so are equal payloads that have null ids alone. A null id among others is a revisit.

    Each task fills files of its own, so nothing is shuffled for the writing. A record never spans two frames; a larger one has a
    frame to itself. Files carry the attempt's number: a task that runs again writes other files, and the index, which is
    written to the shared folder, names those of the attempt that counted. A folder may hold files that no index names.
    The folder must be in a store that pyarrow opens: a shared folder, HDFS, S3 or GCS. An empty table gives an empty index.
    Extra columns of pages are not read, whatever their names.
    """
    root = uri_of(pages.sparkSession, folder)
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = with_originals(own, "id", "html", least_bytes).select(F.col("id").cast("string"), "url", F.col("_payload").alias("payload"), F.when(F.col("copy"), F.col("keep").cast("string")).alias("keep"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(root)
        store.create_dir(path, recursive=True)
        task, bundle, name, no = TaskContext.get(), None, "", 0
        for batch in batches:
            out: list[tuple] = []
            for key, url, payload, keep in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bundle and bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
                if not bundle:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{no}.warc.zst"
                    bundle, no = Bundle(store, f"{path}/{name}", frame_bytes, level), no + 1
                data = record(record_name(key), url, payload, record_name(keep) if keep is not None else None, date)
                out.append((record_name(key), "response" if keep is None else "revisit", f"{root}/{name}", *bundle.add(data), len(data)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [*[pa.string()] * 3, *[pa.int64()] * 3], strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])
        if bundle:
            bundle.close()

    return saved(rows.mapInArrow(write, INDEX))


def record_batch(rows: list[dict], payloads: bool) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c, kinds[t]) for c, t in (x.split() for x in RECORD.split(", ") if payloads or not x.startswith("payload "))])
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """RECORD of every record in the bundles that an index names, by reading each bundle from end to end.

    Every payload is decoded and held against its digest; without `payloads` it is then left out. A task holds one frame at a time.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                file = Seekable(uri)
                for k in range(len(file.sizes)):
                    data, at, rows = file.frame(k), 0, []
                    while at < len(data):
                        facts, at = parsed(data, at)
                        rows.append(facts | {"bundle": uri, "frame": k})
                    yield record_batch(rows, payloads)

    schema = RECORD if payloads else RECORD.removesuffix(", payload binary")
    return index.select("bundle").distinct().mapInArrow(read, schema)


def read_records(places: DataFrame) -> DataFrame:
    """RECORD of the records at the places of some rows of an index: only their frames are read, each once a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, file, k, data = None, None, -1, b""
        for batch in batches:
            rows = []
            for bundle, frame, at in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if bundle != uri:
                    uri, file, k = bundle, Seekable(bundle), -1
                if frame != k:
                    k, data = frame, file.frame(frame)
                rows.append(parsed(data, at)[0] | {"bundle": bundle, "frame": frame})
            if rows:
                yield record_batch(rows, True)

    sorted_ = places.select("bundle", "frame", "at").repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "at")
    return sorted_.mapInArrow(read, RECORD)
