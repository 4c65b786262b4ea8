"""Bounded-space online packing of tokenised documents into sequences of one length."""

from __future__ import annotations

import functools
import gc
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved, slices, trim

#: Groups whose leftovers merge together in each round.
MERGED_TOGETHER = 64
#: Distinct chunks of one generation, about 70 MB, and characters that one may have altogether; a worker remembers two generations.
REMEMBERED, REMEMBERED_CHARS = 350_000, 8_000_000
#: A run of letters and, after it, a run of marks that never joins letters to a token.
WORD_AND_MARKS = re.compile(r"([^\W\d_]+)([.,;:!?#$%&*|()]*)", re.UNICODE)


class WordTokens:
    """Ids of texts by a tokenizers file whose tokens never span white space.

    A text is split at ASCII blanks, which the vocabulary drops, and each distinct chunk is encoded once. New
    chunks of letters and marks are encoded as two runs, the runs of letters of all new chunks in one call: each
    such run ends with the one token of it that ends a word.
    """

    def __init__(self, path: str, end_id: int, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.end = end_id.to_bytes(4, "little")
        self.remembered, self.chars = remembered, 0
        # Fewer at once take less memory.
        self.at_once = max(1_000, remembered // 10)
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}

    def encode_each(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters alone, by one call over all."""
        found = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = (np.flatnonzero(self.ends_word[found]) + 1) * 4
        if len(stops) != len(words):
            return self.encode_each(words)
        ids, stops = found.tobytes(), stops.tolist()
        return [ids[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def learn(self, chunks: list[str]) -> None:
        match, split, odd = WORD_AND_MARKS.fullmatch, [], []
        for chunk in chunks:
            m = match(chunk)
            if m and (word := m[1]).isalpha():
                split.append((chunk, word.lower() if chunk.isascii() else word, m[2]))
            else:
                odd.append(chunk)
        words, marks = list({w for _, w, _ in split}), list({m for _, _, m in split})
        ids = dict(zip(words, self.encode_words(words), strict=True)) if words else {}
        ends = dict(zip(marks, self.encode_each(marks), strict=True))
        self.known.update([(chunk, ids[w] + ends[m]) for chunk, w, m in split])
        self.known.update(zip(odd, self.encode_each(odd), strict=True))

    def forget(self) -> None:
        """Nothing stays known but the tokenizer."""
        self.known, self.before, self.chars = {"": b""}, {}, 0

    def recall(self, chunks: set[str]) -> set[str]:
        """Chunks that are not known; what was known a generation ago is known again."""
        new = chunks - self.known.keys()
        again = new & self.before.keys()
        self.known.update((c, self.before[c]) for c in again)
        return new - again

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, and after them the end id."""
        split = [text.replace("\n", " ").replace("\t", " ").split(" ") for text in texts]
        chunks = set().union(*split)
        new = self.recall(chunks)
        chars = sum(map(len, new))
        if len(self.known) + len(new) > self.remembered or self.chars + chars > REMEMBERED_CHARS:
            self.before, self.known, self.chars = self.known, {"": b""}, 0
            new = self.recall(chunks)
        self.chars += chars
        new = list(new)
        gc.disable()  # Nothing here is cyclic, and the collector would walk all that is remembered.
        try:
            for i in range(0, len(new), self.at_once):
                self.learn(new[i : i + self.at_once])
        finally:
            gc.enable()
        return [b"".join(map(self.known.__getitem__, chunks)) + self.end for chunks in split]


@functools.cache
def word_tokens(path: str, end_id: int, remembered: int = REMEMBERED) -> WordTokens:
    return WordTokens(path, end_id, remembered)


def encoded(tokens: WordTokens, texts: list[str | None]) -> Iterator[bytes]:
    """Ids of each text. All chunks of a call are known at once, so where little is remembered, few characters are taken at once."""
    for _, some in slices(texts, 8 * tokens.remembered if tokens.remembered < REMEMBERED else 4_000_000):
        yield from tokens(some)


class Windows:
    """At most `most` open windows of `length` tokens. A piece is (id, start, n, doc_tokens, ids)."""

    def __init__(self, length: int, most: int, emit: Callable[[list], None]) -> None:
        self.length, self.most, self.emit = length, most, emit
        self.free: list[tuple[int, int]] = []  # (room left, window), ascending
        self.held: dict[int, list] = {}
        self.next = 0

    def add(self, doc, start: int, ids: bytes, doc_tokens: int) -> None:
        """Whole windows of a long document go out at once; the rest is placed."""
        size, n = self.length, len(ids) // 4
        while n >= size:
            self.emit([(doc, start, size, doc_tokens, ids[: 4 * size])])
            ids, start, n = ids[4 * size :], start + size, n - size
        if n:
            self.place(doc, start, n, ids, doc_tokens)

    def place(self, doc, start: int, n: int, ids: bytes, doc_tokens: int) -> None:
        """Best fit; if none fits and all windows are open, the fullest takes what it can and goes out."""
        at = bisect_left(self.free, (n, -1))
        if at == len(self.free) and len(self.free) == self.most:
            room, window = self.free.pop(0)
            self.emit([*self.held.pop(window), (doc, start, room, doc_tokens, ids[: 4 * room])])
            ids, start, n = ids[4 * room :], start + room, n - room
            at = len(self.free)
        if at == len(self.free):
            room, window = self.length, self.next
            self.next += 1
            self.held[window] = []
        else:
            room, window = self.free.pop(at)
        self.held[window].append((doc, start, n, doc_tokens, ids))
        if room == n:
            self.emit(self.held.pop(window))
        else:
            insort(self.free, (room - n, window))

    def leftovers(self) -> list[list]:
        """What is open, fullest first."""
        return [self.held[window] for _, window in self.free]


def schema_of(kind: str, id_col: str) -> str:
    return (
        f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long,"
        " part long, ids binary"
    )


def rows_of(pieces: list, sequence: int, part: int, keep_ids: bool, out: list[list]) -> None:
    offset = 0
    for doc, start, n, doc_tokens, ids in pieces:
        row = (doc, start, n, zlib.crc32(ids), doc_tokens, sequence, offset, part, ids if keep_ids else None)
        for column, value in zip(out, row, strict=True):
            column.append(value)
        offset += n


def as_batch(columns: list[list], kind: pa.DataType, id_col: str) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * 7, pa.binary()]
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def powers_of_two(n: int) -> list[int]:
    """n as a sum of different powers of two, largest first."""
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


def packed(docs: DataFrame, path: str, end_id: int, length: int, open_windows: int, id_col: str, text_col: str, remembered: int) -> DataFrame:
    """Pieces of each partition; those of windows still open at its end carry their ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tokens = TaskContext.get().partitionId(), word_tokens(path, end_id, remembered)
        state = {"n": 0, "out": [[] for _ in range(9)]}

        def emit(pieces: list, keep_ids: bool = False) -> None:
            rows_of(pieces, (part << 32) + state["n"], part, keep_ids, state["out"])
            state["n"] += 1

        windows, id_kind = Windows(length, open_windows, emit), None
        sparing = remembered < REMEMBERED
        for batch in batches:
            id_kind = batch.schema.field(0).type
            ids = batch.column(0).to_pylist()
            for doc, got in zip(ids, encoded(tokens, batch.column(1).to_pylist()), strict=True):
                windows.add(doc, 0, got, len(got) // 4)
            yield as_batch(state["out"], id_kind, id_col)
            state["out"] = [[] for _ in range(9)]
            if sparing:
                trim()
        for pieces in windows.leftovers():
            emit(pieces, keep_ids=True)
        if id_kind is not None:
            yield as_batch(state["out"], id_kind, id_col)
        if sparing:  # The worker lives on beside what comes next.
            windows = state["out"] = None
            tokens.forget()
            trim()

    return docs.select(id_col, text_col).mapInArrow(run, schema_of(kind, id_col))


def merged(leftovers: DataFrame, round_no: int, length: int, last: bool, id_col: str) -> DataFrame:
    """Leftovers of each group run together and cut into whole windows; at most one stays open in a group.

    In the last round that one is cut at powers of two, which need no padding.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        group = key[0].as_py()
        rows = rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        out: list[list] = [[] for _ in range(9)]
        count, pieces, room = 0, [], length

        def emit(keep_ids: bool = False) -> None:
            nonlocal count, pieces, room
            rows_of(pieces, (round_no << 60) + (group << 24) + count, group, keep_ids, out)
            count, pieces, room = count + 1, [], length

        sizes = [length] * (sum(rows["length"].to_pylist()) // length)
        rest = sum(rows["length"].to_pylist()) - length * len(sizes)
        sizes += powers_of_two(rest) if last else [rest] if rest else []
        todo = iter(sizes)
        room = next(todo, 0)
        for doc, start, doc_tokens, ids in zip(*(rows[c].to_pylist() for c in (id_col, "start", "doc_tokens", "ids")), strict=True):
            while ids:
                n = min(room, len(ids) // 4)
                pieces.append((doc, start, n, doc_tokens, ids[: 4 * n]))
                ids, start, room = ids[4 * n :], start + n, room - n
                if not room:
                    whole = last or count < len(sizes) - bool(rest)
                    emit(keep_ids=not whole)
                    room = next(todo, 0)
        return pa.Table.from_batches([as_batch(out, rows.schema.field(id_col).type, id_col)])

    kind = leftovers.schema[id_col].dataType.simpleString()
    groups = F.floor(F.col("part") / MERGED_TOGETHER).cast("long")
    return leftovers.withColumn("part", groups).groupBy("part").applyInArrow(run, schema_of(kind, id_col))


def pack(
    docs: DataFrame, path: str, end_id: int = 1, length: int = 2048, open_windows: int = 32, id_col: str = "doc_id", text_col: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each partition of docs keeps open_windows open windows and sees its documents once. A document's last piece
    goes to the window it fits best; if none fits, the fullest one is filled from the piece and emitted. What is
    open at the end (at most open_windows windows a partition) merges in rounds of MERGED_TOGETHER neighbouring
    groups, of which each keeps one window open, until one group is left. Sequences have `length` tokens; the very
    last window is cut at powers of two.

    A worker remembers the ids of up to two times `remembered` distinct chunks; fewer cost time, not results. With fewer than
    REMEMBERED it also encodes few characters at once and forgets all chunks when its task ends.

    Null and empty texts are documents of the end id alone. Repeated rows are packed each for itself; ids may
    be null. Other columns of docs are not read. An empty table gives no rows.
    """
    first = saved(packed(docs, path, end_id, length, open_windows, id_col, text_col, remembered))
    done, open_ = [first.filter("ids IS NULL")], first.filter("ids IS NOT NULL")
    groups, round_no = (first.agg(F.max("part")).first()[0] or 0) + 1, 1
    while groups > MERGED_TOGETHER:
        after = saved(merged(open_, round_no, length, False, id_col))
        done.append(after.filter("ids IS NULL"))
        open_ = after.filter("ids IS NOT NULL")
        groups, round_no = -(-groups // MERGED_TOGETHER), round_no + 1
    done.append(merged(open_, round_no, length, True, id_col))
    return reduce(DataFrame.unionByName, done).drop("part", "ids")
