"""Spelling variants: words one edit apart, found by tiles of padded code-point matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free, saved

#: Runs of letters: A-Z, a-z and the code points from C0 to FF.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Code points of a piece of a word, and words of one block of a group.
PIECE, BLOCK = 3, 512
#: Pairs compared in one tile.
TILE = 1 << 16


def deleted(run: Column, h: Column, one_in: int) -> Column:
    """run without its code point at h modulo its length, where one_in divides h."""
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = 199, least_chars: int = 6, least_n: int = 5) -> DataFrame:
    """(word, n) of the words of at least least_chars code points that occur at least least_n times in all documents.

    A word is a maximal run of LETTERS with A-Z in lower case. Of the runs whose crc32, of id and run, one_in divides,
    one code point is deleted: that plants misspellings. A null id plants none, a null text has no words.
    """
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(LETTERS), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    words = runs.select(F.coalesce(deleted(F.col("run"), h, one_in), "run").alias("word")).filter(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_n)


def keyed(words: DataFrame) -> DataFrame:
    """(key, size, piece, word, n): the groups in which a word meets its near words.

    Two words are near if one edit parts them. Cut the shorter one of them, of length `size`, into pieces of
    PIECE code points: the edit lies in one of them (or before or after it), so both words share what is before that
    piece and what is after it. Each word looks for partners of its own length or one more with its own pieces, and
    for shorter ones with the pieces of a word one code point shorter.
    """
    n = F.char_length("word")
    roles = F.explode(F.array(n, n - 1)).alias("size")
    starts = F.sequence(F.lit(0), F.col("size") - 1, F.lit(PIECE))
    cut = words.select("word", "n", roles).filter("size > 0").select("word", "n", "size", F.posexplode(starts).alias("piece", "start"))
    end = F.least(F.col("start") + PIECE, F.col("size"))
    tail = F.col("size") - end
    before, after = F.substring("word", F.lit(1), F.col("start")), F.when(tail > 0, F.substring("word", F.char_length("word") - tail + 1, tail)).otherwise("")
    return cut.select(F.xxhash64("size", "piece", before, after).alias("key"), "size", "piece", "word", "n")


def tiles(words: DataFrame) -> DataFrame:
    """(tile, side, size, piece, word, n): groups in blocks of about BLOCK words, each pair of blocks a tile of its own.

    A word goes to all tiles of its block; side tells which of the two blocks it is in, and tiles of one block have side 0 alone.
    Words that meet nobody are left out.
    """
    own = saved(keyed(words))
    sizes = own.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = own.join(sizes, "key").select("*", blocks.alias("blocks"), F.pmod(F.xxhash64("word", F.lit("block")), blocks).cast("int").alias("b"))
    other = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = F.xxhash64("key", F.least("b", "o"), F.greatest("b", "o"))
    return other.select(tile.alias("tile"), (F.col("b") > F.col("o")).cast("int").alias("side"), (F.col("b") == F.col("o")).alias("own"), "size", "piece", "word", "n")


def padded(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, aligned left and aligned right, in matrices of `width` columns; no word holds the padding's 0."""
    left = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    right = np.array([w[::-1] for w in words], dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    return left, right


def common(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many leading columns of the rows of a and b agree, at most limit."""
    differs = a != b
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])
    return np.minimum(first, limit)


def near_in_tiles(codes: np.ndarray, sides: np.ndarray, own: np.ndarray, sizes: np.ndarray, pieces: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the near pairs among rows sorted by tile.

    Rows d apart are compared for d = 1, 2, ... as long as a tile reaches that far: each step is one comparison of matrices.
    A pair is taken in the first group in which it meets.
    """
    lengths = np.array([len(w) for w in words])
    left, right = padded(words, int(lengths.max()))
    found_i, found_j = [], []
    rows, d = np.arange(len(words)), 1
    while True:
        rows = rows[rows + d < len(words)]
        rows = rows[codes[rows] == codes[rows + d]]
        if not len(rows):
            break
        for start in range(0, len(rows), TILE):
            i = rows[start : start + TILE]
            j = i + d
            short, long = np.minimum(lengths[i], lengths[j]), np.maximum(lengths[i], lengths[j])
            # A group is for pairs whose shorter word has its size; two blocks meet across only. Groups whose keys collide differ in either.
            ok = (short == sizes[i]) & (sizes[i] == sizes[j]) & (pieces[i] == pieces[j]) & (long - short <= 1) & (own[i] | (sides[i] != sides[j]))
            i, j, short, long = i[ok], j[ok], short[ok], long[ok]
            prefix, suffix = common(left[i], left[j], short), common(right[i], right[j], short)
            near = (prefix + suffix >= long - 1) & ~((long == short) & (prefix == short))
            i, j, prefix, suffix, short = i[near], j[near], prefix[near], suffix[near], short[near]
            # The first piece whose end leaves no more than the common suffix; the pair has met at all, so its prefix suffices there.
            first = np.maximum(0, -(-(short - suffix) // PIECE) - 1)
            meets = pieces[i] == first
            found_i.append(i[meets])
            found_j.append(j[meets])
        d += 1
    none = np.empty(0, dtype=int)
    return np.concatenate(found_i or [none]), np.concatenate(found_j or [none])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each pair of near words once in either direction."""

    def compare(rows: pa.Table) -> pa.RecordBatch:
        columns = {c: rows[c].to_numpy() for c in ("tile", "side", "own", "size", "piece", "n")}
        texts = rows["word"].to_pylist()
        i, j = near_in_tiles(columns["tile"], columns["side"], columns["own"], columns["size"], columns["piece"], texts)
        ends, n = np.concatenate([i, j]), columns["n"]
        others = np.concatenate([j, i])
        pick = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([pick.take(pa.array(ends)), pa.array(n[ends]), pick.take(pa.array(others)), pa.array(n[others])], names=["word", "n", "other", "other_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tiles are whole: the last one of what is held waits for the next batch.
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            codes = rows["tile"].to_numpy()
            last = int(np.searchsorted(codes, codes[-1])) if len(codes) else 0
            if last:
                yield compare(rows.slice(0, last))
            held = rows.slice(last).to_batches()
        if held and sum(b.num_rows for b in held):
            yield compare(pa.Table.from_batches(held))

    dealt = tiles(words).repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(run, "word string, n long, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the word that following (word, form) ends at. Each round doubles the steps."""
    reached = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        far = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(reached.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = step.filter("moved").limit(1).count()
        free(reached)
        reached = step
        if not moved:
            return reached.select("word", "root")


def grouped(words: DataFrame, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of each row (word, n) of words, whose words are distinct.

    n_near counts the words that one inserted, deleted or replaced code point parts from the word. Its form is
    the one of them with the largest n, of equal ones the smallest in code-point order, if that n is at least `times` the
    word's; root is where following forms ends, the word itself if it has none.

    Words meet in groups that share all but a piece of three code points at a place, so a group's size depends on
    the alphabet and not on the number of rows; groups of over 512 words are compared in pairs of blocks, each a task's
    tile. Empty and null words have no near words. An empty table gives no rows. Other columns are not read.
    """
    own = saved(words.select("word", "n"))
    pairs = near_pairs(own)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    near = saved(pairs.groupBy("word").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best))
    held = -F.col("best.less") >= times * F.col("n")
    near = near.select("word", "n_near", F.when(held, F.col("best.form")).alias("form"), F.when(held, -F.col("best.less")).alias("form_n"))
    ends = roots(near.filter("form IS NOT NULL"))
    joined = own.join(near, "word", "left").join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
