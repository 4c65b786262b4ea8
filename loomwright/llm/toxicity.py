"""Toxicity: boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, Isotonic
from .shared import held_out, map_arrow, slices, trim

#: Common insults of four languages, the seed of the lexicon.
SEED = frozenset(
    "idiot idiots moron morons stupid dumb loser losers pathetic worthless scum trash clown clowns disgusting fool jerk garbage "
    "vermin filth imbecile idiota estúpido estúpida imbécil basura asqueroso patético payaso inútil idiote stupide débile "
    "crétin ordure minable dégoûtant clochard nul dumm idioten trottel abschaum wertlos widerlich versager müll dreck".split()
)
#: Words that address the reader.
SECOND_PERSON = frozenset("you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine ihr euch usted tú ti ustedes vosotros".split())
#: Words around a lexicon word in which an address to the reader counts.
NEAR = 5
#: Letters of a word's beginning that may be in the lexicon by themselves.
STEMS = (5, 6, 7)

WORD = re.compile(r"[^\W\d_]+(?:[*@$!0-9][^\W\d_]+)*", re.UNICODE)
OBFUSCATED = re.compile(r"[^\W\d_][*@$!0-9]+[^\W\d_]", re.UNICODE)
SPACED = re.compile(r"\b(?:[^\W\d_][ .\-*_]){3,}[^\W\d_]\b", re.UNICODE)
DIGITS = re.compile(r"\d+")
LEET = str.maketrans("01345$@!", "oieassai")
FEATURES = (
    "hits_log", "hits_density", "distinct_hits", "seed_hits_log", "first_half_hits", "second_person_density", "second_person_near_hit",
    "capital_letters", "capital_words", "exclamations", "questions", "punctuation", "repeated_punctuation", "obfuscated", "spaced_letters",
    "digits", "mean_word", "log_words",
)


class Lexicon:
    """Words, and beginnings of words, that toxic texts have."""

    def __init__(self, words: frozenset[str], stems: frozenset[str]) -> None:
        self.words, self.stems = words, stems
        self.heads = frozenset(s[: STEMS[0]] for s in stems)

    def __contains__(self, word: str) -> bool:
        return word in self.words or word[: STEMS[0]] in self.heads and any(word[:k] in self.stems for k in STEMS if len(word) > k)


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of a whole text; all but the counts of words are rates."""
    found = WORD.findall(text)
    words = [w.lower() for w in found]
    words = [w.translate(LEET) if not w.isalpha() else w for w in words]
    n, length = max(len(words), 1), max(len(text), 1)
    hits = [i for i, w in enumerate(words) if w in lexicon]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    you_set = set(you)
    near = sum(any(j in you_set for j in range(i - NEAR, i + NEAR + 1)) for i in hits) if you else 0
    letters = sum(map(len, found)) or 1
    marks = text.count("!"), text.count("?")
    shouted = [w for w in found if len(w) > 2 and w.isupper()]
    plain = len(text) - letters - text.count(" ") - text.count("\n")
    return [
        float(np.log1p(len(hits))),
        len(hits) / n,
        float(len({words[i] for i in hits})),
        float(np.log1p(sum(words[i] in SEED for i in hits))),
        sum(i < n / 2 for i in hits) / n,
        len(you) / n,
        near / n,
        sum(map(len, shouted)) / letters,
        len(shouted) / n,
        marks[0] / n,
        marks[1] / n,
        plain / length,
        (text.count("!!") + text.count("??") + text.count("...")) / n,
        sum(not w.isalpha() for w in found) / n,
        len(SPACED.findall(text)) / n,
        sum(map(len, DIGITS.findall(text))) / length,
        letters / n,
        float(np.log1p(n)),
    ]


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Boosted
    calibration: Isotonic

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        rows = np.array([features(t, self.lexicon) for t in texts])
        return np.clip(self.calibration(self.trees.margin(rows)), 0.0, 1.0)


def learned_lexicon(texts: list[str], label: np.ndarray, least_z: float = 6.0, least_docs: int = 4) -> Lexicon:
    """Words and beginnings of words in more toxic texts than chance allows, by the z-score of their share, and the seed."""
    seen: dict[str, list[int]] = {}
    for text, y in zip(texts, label.tolist(), strict=True):
        words = set(WORD.findall(text.lower()))
        words |= {w[:k] + "*" for w in words for k in STEMS if len(w) > k}
        for w in words:
            pair = seen.setdefault(w, [0, 0])
            pair[0] += y
            pair[1] += 1
    p = float(label.mean()) if len(label) else 0.0
    found = {w for w, (a, n) in seen.items() if a >= least_docs and a - n * p > least_z * (n * p * (1 - p) + 1e-9) ** 0.5 and a / n > min(0.5, 3 * p)}
    return Lexicon(frozenset(w for w in found if w[-1] != "*") | SEED, frozenset(w[:-1] for w in found if w[-1] == "*"))


def first_of_copies(texts: list[str]) -> list[int]:
    """Indexes of texts without those that look like copies of an earlier one: one of two min-hashes of 3 words agrees.

    Copies of one toxic text would make all its words look toxic.
    """
    seen: set[tuple[int, int]] = set()
    kept = []
    for i, text in enumerate(texts):
        words = text.encode("utf-8").split()
        hashes = np.array([zlib.crc32(b" ".join(words[k : k + 3])) for k in range(max(1, len(words) - 2))], dtype=np.uint64)
        both = {(j, int((hashes * np.uint64(odd) & np.uint64(0xFFFFFFFF)).min())) for j, odd in enumerate((1, 0x9E3779B1))}
        if not both & seen:
            kept.append(i)
        seen |= both
    return kept


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most_rows: int = 8_000, most_chars: int = 24_000_000, calibration_share: int = 3) -> ToxicityModel:
    """Learn from a bounded sample: the first most_rows labelled ids by hash that aren't held out.

    Of these, texts are kept in hash order as long as they have most_chars characters together, without those that would pass
    that; each is read whole, copies once. Every
    calibration_share-th row calibrates the margins that trees of the other rows give; the trees used for scores
    learn from the same other rows.
    """
    label = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    label = label.filter("id IS NOT NULL AND y IN (0, 1)").filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y"))
    sample = label.orderBy(F.xxhash64("id"), "id").limit(most_rows)
    # At most most_rows pairs of two integers: small whatever the input.
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).filter("t IS NOT NULL")
    chosen = chosen.join(F.broadcast(sample), "id").select("id", "y", "t", F.length("t").cast("long").alias("n")).filter(F.col("n") <= most_chars)
    rows = []
    held = 0
    for row in chosen.orderBy(F.xxhash64("id"), "id").limit(most_rows).toLocalIterator():
        if held + row.n <= most_chars:
            held += row.n
            rows.append((row.y, row.t))
    rows = [rows[i] for i in first_of_copies([t for _, t in rows])]
    y = np.array([r[0] for r in rows], dtype=float)
    turn = np.arange(len(rows)) % calibration_share
    learn, check = turn != 0, turn == 0
    lexicon = learned_lexicon([t for (_, t), k in zip(rows, learn, strict=True) if k], y[learn])
    x = np.array([features(t, lexicon) for _, t in rows]).reshape(len(rows), len(FEATURES))
    trees = Boosted().fit(x[learn], y[learn])
    return ToxicityModel(lexicon, trees, Isotonic().fit(trees.margin(x[check]), y[check]))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id_col, score double, predicted int) of each row. Null and empty texts get the score of an empty text.

    Repeated rows give repeated results; ids may be null. Other columns of docs are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = [shared.value.score(texts) for _, texts in slices(batch.column(1).to_pylist())]
            got = np.concatenate(parts)
            return pa.record_batch([batch.column(0), pa.array(got), pa.array((got >= threshold).astype(np.int32))], names=[id_col, "score", "predicted"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, score double, predicted int")


def with_verdict(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """docs with score and predicted after its own columns, computed row by row without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        scores = np.concatenate([np.zeros(0), *[shared.value.score(t) for _, t in slices(texts.tolist())]])
        trim()
        return pd.Series(scores)

    return docs.withColumn("score", scored(text_col)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
