import json

from pyspark.sql import functions as F

import corpus_pipeline
from loomwright.llm import line_dedup, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "pii", "packing"]
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "text", "toxic")
    kept = {r.doc_id for r in seen["toxicity"].collect()}
    assert kept == {i for i, r in before.items() if model.score([r.text or ""])[0] < 0.3}
    removed = {(r.id, r.no) for r in line_dedup.line_classes(seen["toxicity"]).collect() if not r.kept}
    for r in seen["line_dedup"].collect():
        lines = before[r.doc_id].text.split("\n")
        assert r.text == "\n".join(t for i, t in enumerate(lines) if (r.doc_id, i) not in removed)
        assert r.n_chars == len(r.text)
    lined, near = ({r.doc_id: r.text for r in seen[n].collect()} for n in ("line_dedup", "near_dedup"))
    assert near.items() <= lined.items() and min(i for i, t in lined.items() if not t.strip()) in near
    assert sum(not t.strip() for t in near.values()) <= 1
    tokens = seen["packing"].groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in tokens} == set(near)
    assert json.dumps(sorted(near))


def test_odd_rows_through_unwritten_stages(spark):
    """Null, empty and long texts, repeated rows, null ids and clashing columns; each stage reads the one before as it is, unwritten."""
    line = "This line of a license stands in many files and only its first place keeps it."
    odd = [(9001, None), (9002, None), (9003, ""), (9004, f"one\n{line}\ntwo words"), (9005, f"other\n{line}\nthree more words"), (None, f"no id\n{line}"), (9006, "write to jane.doe@example.org or not"), (9007, "word " * 30_000)]
    some = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(40).collect()]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in [*odd, odd[3], *some]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("_new", "_id", "_gone", "score", "predicted", "root", "id"):
        docs = docs.withColumn(c, F.lit("clash"))
    out = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, out, SF)
        assert out.columns == corpus_pipeline.COLUMNS
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    # Of the texts without a word, which are alike, the smallest id stays; null ids have no near copy.
    assert [r.text for r in got[9001]] == [None] and not {9002, 9003} & set(got)
    assert [r.text for r in got[None]] == ["no id\n" + line]
    # A row that is given twice is one document: both stay, without the line that an earlier document has.
    assert [r.text for r in got[9004]] == ["one\ntwo words"] * 2 and [r.text for r in got[9005]] == ["other\nthree more words"]
    assert [r.text for r in got[9006]] == ["write to <EMAIL> or not"] and got[9006][0].n_chars == len("write to <EMAIL> or not")
    assert all(r.n_chars == len(r.text) for x in got.values() for r in x if r.text is not None) and len(got[9007][0].text) == 150_000
    packed = corpus_pipeline.STAGES[4][1](spark, out, SF)
    pieces = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in pieces)


def test_empty_table_through_all_stages(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
