"""Byte-level BPE encoding and decoding of a column of texts."""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rank_queue import ByteBpe
from .shared import map_arrow, slices

#: Distinct pre-tokens a worker remembers; beyond that it forgets all and begins again.
REMEMBERED = 300_000


@functools.cache
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe.from_file(path)


class TextEncoder:
    """Encodes texts, and remembers the ids of pre-tokens seen in earlier batches."""

    def __init__(self, path: str, pattern: str) -> None:
        self.bpe = vocabulary(path)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(text) for text in texts]
        new = [w for w in {w for words in split for w in words} if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list({w for words in split for w in words})
        self.known.update(zip(new, self.bpe.encode([w.encode("utf-8") for w in new]), strict=True))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


@functools.cache
def encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(path, pattern)


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids binary, decoded binary) of each row of docs.

    ids holds little-endian unsigned 32-bit integers; decoded the bytes the ids stand for. Each match of pattern
    is encoded by itself. Null and empty texts have no ids. Rows are never combined: repeated rows give repeated
    results. Columns of docs other than these two are not read.
    """

    def make():
        own = encoder(path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids: list[bytes] = []
            for _, texts in slices(batch.column(1).to_pylist()):
                ids += own.encode(texts)
            decoded = [own.bpe.decode(x) for x in ids]
            return pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], names=[id_col, "ids", "decoded"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, ids binary, decoded binary")


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): encode_texts with digests in place of the ids and bytes."""

    def make():
        own = encoder(path, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, sha, back = [], [], []
            for _, texts in slices(batch.column(1).to_pylist()):
                for ids in own.encode(texts):
                    n.append(len(ids) // 4)
                    sha.append(hashlib.sha256(ids).hexdigest())
                    back.append(hashlib.sha256(own.bpe.decode(ids)).hexdigest())
            return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(sha), pa.array(back)], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode_ids(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """encoded with a column `decoded` (binary): the bytes that ids_col stands for; null stays null."""
    @F.pandas_udf("binary")
    def decoded(ids):
        bpe = vocabulary(path)
        return ids.map(lambda x: None if x is None else bpe.decode(x))

    return encoded.withColumn("decoded", decoded(ids_col))
