"""Language of the words of code-switched text by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bounded, held_out, map_arrow, saved, slices

WORD = re.compile(r"[^\W\d_]+")
#: Feature tables: pairs, triples and quadruples of bytes (those with a blank are the affixes), and whole words.
TABLE = 1 << 16
BLANK = 32
ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; of a run with other signs (such as raised digits), its letters."""
    found = WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for w in ("".join(filter(str.isalpha, w)) for w in found) if w]


def feature_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of the n-gram tables by byte position, first position of each word, lexicon row of each word).

    Row 0 of a table is for n-grams that span words and has no weight.
    """
    data = np.frombuffer(" ".join(["", *words, "", "", ""]).encode("utf-8"), dtype=np.uint8)
    blank = data == BLANK
    n = len(data) - 3
    at = np.flatnonzero(blank)[: len(words)]
    b = data.astype(np.int64)
    inner = [blank[k : n + k] for k in range(4)]
    two = (b[:n] << 8 | b[1 : n + 1]) % (TABLE - 1) + 1
    three = (b[:n] * 7919 + b[1 : n + 1] * 104_729 + b[2 : n + 2] * 1_299_709) % (TABLE - 1) + 1
    four = (b[:n] * 15_485_863 + b[1 : n + 1] * 32_452_843 + b[2 : n + 2] * 49_979_687 + b[3 : n + 3] * 67_867_967) % (TABLE - 1) + 1
    two[inner[0] & inner[1]] = 0
    three[inner[1]] = 0
    four[inner[1] | inner[2]] = 0
    rows = np.stack([two, three + TABLE, four + 2 * TABLE], axis=1)[: len(data) - 3]
    rows[rows[:, 0] == 0, 0] = 0
    power = np.cumprod(np.full(len(data), ODD))
    total = np.cumsum(b.astype(np.uint64) * power)
    ends = np.append(at[1:], len(data) - 3) - 1 if len(words) else at
    word = (total[ends] - total[at]) * np.cumprod(np.full(len(data), INVERSE))[at]
    lexicon = ((word ^ word >> np.uint64(29)) % np.uint64(TABLE - 1)).astype(np.int64) + 1 + 3 * TABLE
    return rows, at, lexicon


@dataclass
class WordField:
    """Weights of a trained field: `weights` is 4 tables by language, `transitions` language by language."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str], most: int = 60_000) -> np.ndarray:
        """Summed feature weights of each word and language."""
        out = [np.zeros((0, len(self.languages)), dtype=np.float32)]
        for i in range(0, len(words), most):
            rows, at, lexicon = feature_rows(words[i : i + most])
            sums = self.weights[rows[:, 0]]
            sums += self.weights[rows[:, 1]]
            sums += self.weights[rows[:, 2]]
            out.append(np.add.reduceat(sums, at, axis=0)[: len(at)] + self.weights[lexicon])
        return np.concatenate(out)

    def marginals(self, emissions: np.ndarray, n_of: np.ndarray) -> np.ndarray:
        """P(language of each word | whole sequence) of the sequences that lie one after the other in emissions."""
        return forward_backward(emissions, self.transitions, n_of)[0]

    def of_texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, int]]:
        """(marginals by word, number of words) of each text."""
        split = [words_of(t) for t in texts]
        n_of = np.array([len(w) for w in split], dtype=np.int64)
        all_words = [w for words in split for w in words]
        del split
        gamma = self.marginals(self.emissions(all_words), n_of)
        stops = np.cumsum(n_of)
        for a, b in zip(stops - n_of, stops, strict=True):
            yield gamma[a:b], int(b - a)


def forward_backward(emissions: np.ndarray, transitions: np.ndarray, n_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals by position, expected transitions summed over all sequences), step by step over all sequences at once."""
    k = len(transitions)
    order = np.argsort(-n_of, kind="stable")
    n_of, start = n_of[order], (np.cumsum(n_of) - n_of)[order]
    move = np.exp(transitions - transitions.max()).astype(np.float32)
    seen = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float32) if len(emissions) else emissions
    alpha, beta = np.empty_like(seen), np.empty_like(seen)
    longest = int(n_of[0]) if len(n_of) else 0
    active = np.searchsorted(-n_of, -np.arange(longest), side="left")
    now = None
    for t in range(longest):
        at = start[: active[t]] + t
        now = seen[at] if t == 0 else (now[: active[t]] @ move) * seen[at]
        now = now / now.sum(axis=1, keepdims=True)
        alpha[at] = now
    expected = np.zeros((k, k))
    now = np.ones((0, k), dtype=np.float32)
    for t in range(longest - 1, -1, -1):
        at = start[: active[t]] + t
        if t + 1 < longest:
            later = seen[at[: len(now)] + 1] * now
            earlier = alpha[at[: len(now)]]
            whole = ((earlier @ move) * later).sum(axis=1, keepdims=True)
            expected += move * (earlier.T @ (later / whole))
            now = later @ move.T
            now = now / now.sum(axis=1, keepdims=True)
        now = np.concatenate([now, np.ones((len(at) - len(now), k), dtype=np.float32)])
        beta[at] = now
    gamma = alpha * beta
    return gamma / np.maximum(gamma.sum(axis=1, keepdims=True), 1e-30), expected


def train(rows: list[tuple[str, str]], sequences: int = 1_500, length: int = 48, epochs: int = 3, rate: float = 0.25, seed: int = 7) -> WordField:
    """Fit by AdaGrad on the log-likelihood of code-switched sequences.

    A sequence is spliced from stretches of words of random rows, so that transitions between languages are
    learned together with the features; each word has its row's language as its label.
    """
    languages = sorted({lang for lang, _ in rows}) or ["und"]
    by_language: list[list[list[str]]] = [[] for _ in languages]
    for lang, text in rows:
        if words := words_of(text):
            by_language[languages.index(lang)].append(words)
    have = [i for i, texts in enumerate(by_language) if texts]
    k = len(languages)
    field = WordField(languages, np.zeros((4 * TABLE, k), dtype=np.float32), np.zeros((k, k), dtype=np.float32))
    if not have:
        return field
    rng = np.random.default_rng(seed)
    words: list[str] = []
    labels: list[int] = []
    for _ in range(sequences):
        n = 0
        while n < length:
            lang = have[rng.integers(len(have))]
            text = by_language[lang][rng.integers(len(by_language[lang]))]
            first = int(rng.integers(len(text)))
            part = text[first : first + min(length - n, 1 + int(rng.geometric(1 / 24)))]
            words += part
            labels += [lang] * len(part)
            n += len(part)
    label = np.array(labels).reshape(sequences, length)
    squares, moved = np.full_like(field.weights, 1e-6), np.full((k, k), 1e-6)
    at_once = 50
    for _ in range(epochs):
        for i in range(0, sequences, at_once):
            part = words[i * length : (i + at_once) * length]
            own = label[i : i + at_once]
            rows_, at, lexicon = feature_rows(part)
            emissions = field.emissions(part)
            gamma, expected = forward_backward(emissions, field.transitions, np.full(len(own), length))
            wrong = -gamma.astype(np.float64)
            wrong[np.arange(len(part)), own.ravel()] += 1
            word_of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(rows_))))
            used = np.concatenate([*(rows_[at[0] :, j] for j in range(3)), lexicon])
            owner = np.concatenate([word_of, word_of, word_of, np.arange(len(at))])
            keep = used % TABLE != 0
            feature, back = np.unique(used[keep], return_inverse=True)
            for j in range(k):
                g = np.bincount(back, wrong[owner[keep], j], len(feature)) / at_once
                squares[feature, j] += g**2
                field.weights[feature, j] += rate * g / np.sqrt(squares[feature, j])
            true = np.zeros((k, k))
            np.add.at(true, (own[:, :-1].ravel(), own[:, 1:].ravel()), 1)
            g = (true - expected) / at_once
            moved += g**2
            field.transitions += (rate * g / np.sqrt(moved)).astype(np.float32)
    return field


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = 300, most_rows: int = 6_000, most_chars: int = 24_000_000) -> WordField:
    """Learn from a bounded sample: about rows_per_language rows of each language by hash of the id, most_rows in all, of which the
    last is the one that reaches most_chars characters.

    Held-out rows and rows without a language or text are never learned from.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("lang"))
    own = own.filter("lang IS NOT NULL AND t IS NOT NULL").filter(~held_out(F.col("id")))
    counts = bounded(saved(own.groupBy("lang").agg((rows_per_language / F.count(F.lit(1))).alias("share"))), 10_000)
    draw = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    order = [F.xxhash64("id"), F.col("id")]
    sample = own.join(counts, "lang").filter(draw < F.col("share")).orderBy(*order).limit(most_rows)
    before = F.sum(F.char_length("t")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    sample = sample.select("lang", "t", F.coalesce(before, F.lit(0)).alias("before")).filter(F.col("before") < most_chars)
    return train([(r.lang, r.t) for r in sample.collect()])


def predict(docs: DataFrame, field: WordField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, segments) of each row.

    lang_pred is the language with the highest mean probability over the words, score that mean, segments the
    runs of words with one likeliest language: array of (lang, first word, words). A null text, or one without a letter,
    is `und` with score 0 and no segments; ties go to the first language by name. Repeated rows give repeated
    results; ids may be null. Other columns of docs are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            langs, scores, segments = [], [], []
            names = shared.value.languages
            for _, texts in slices(batch.column(1).to_pylist(), 8_000_000):
                for gamma, n in shared.value.of_texts(texts):
                    if not n:
                        langs.append("und")
                        scores.append(0.0)
                        segments.append([])
                        continue
                    mean = gamma.mean(axis=0, dtype=np.float64)
                    best = gamma.argmax(axis=1)
                    first = np.append(0, np.flatnonzero(best[1:] != best[:-1]) + 1)
                    langs.append(names[int(mean.argmax())])
                    scores.append(min(1.0, float(mean.max())))
                    runs = zip(best[first].tolist(), first.tolist(), np.diff(np.append(first, n)).tolist(), strict=True)
                    segments.append([{"lang": names[i], "first": a, "words": m} for i, a, m in runs])
            kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))
            return pa.record_batch([batch.column(0), pa.array(langs), pa.array(scores), pa.array(segments, kind)], names=[id_col, "lang_pred", "score", "segments"])

        return step

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, lang_pred string, score double, segments array<struct<lang:string,first:int,words:int>>")
