"""From raw documents to packed training sequences, in five stages that each use one operator.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; all but the last return the columns of documents. Extra
columns are left out, whatever their names. Null and empty texts are kept as they are; of documents with null or empty texts, which are alike,
one stays. Rows that repeat an id are one document to line dedup and near-dedup, and two to the other stages; a null id keeps its
lines and has no near copy. An empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.llm import line_dedup, packing, pii, simhash, toxicity
from loomwright.llm.shared import free, listed, only_last, remove, saved, small_batches, table, trim

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Chunks that packing remembers: fewer than by itself, as workers also hold what other stages need.
REMEMBERED = 60_000


def read(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of documents; texts reach Python in batches of a few megabytes, however long they are."""
    small_batches(spark)
    return docs.select(*COLUMNS)


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """docs with a new text; where it differs, n_chars is counted anew."""
    changed = docs.withColumn("_new", text)
    n = F.when(F.col("_new").eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.char_length("_new").cast("long"))
    return changed.select("doc_id", F.col("_new").alias("text"), "lang", "source", n.alias("n_chars"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go; the model learns from the labels of documents that aren't held out."""
    docs = read(spark, docs)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    trim()  # The sample has left the driver.
    return toxicity.with_verdict(docs, model).filter("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of equal or nearly equal lines, the first stays; documents keep their other lines.

    Of the scratch tables only the numbers of the lines that go stay until the result has been written.
    """
    docs = read(spark, docs)
    with only_last(spark):
        gone = line_dedup.removed_lines(docs)
    return with_text(docs.join(gone, F.col("doc_id") == F.col("_id"), "left"), line_dedup.rest_of(F.col("text"), F.col("_gone")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with like sets of five-word shingles, the smallest doc_id stays.

    Of the scratch tables only the ids that go stay until the result has been written.
    """
    docs = read(spark, docs)
    with only_last(spark):
        return simhash.one_of_each(docs).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in angle brackets; null texts stay null."""
    docs = read(spark, docs)
    model = pii.fit(docs)
    trim()
    found = pii.find(docs, model, keep=tuple(COLUMNS))
    return with_text(found, F.when(F.col("text").isNotNull(), pii.redacted(F.col("text"), F.col("_spans"))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack(read(spark, docs), public_tokenizers.path("word_bpe_49k.json"), remembered=REMEMBERED)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Learned models and edit distances have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written to the shared folder, and what it needed is freed when they are."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        needed: list[str] = []
        with listed(needed):
            result = stage(spark, docs, sf_dir)
        written = saved(result)
        remove(spark, *needed)
        free(docs)
        docs = written
    return STAGES[-1][1](spark, docs, sf_dir)
