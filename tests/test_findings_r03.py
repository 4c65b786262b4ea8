"""Small tables on which the third round's findings showed."""

import unicodedata

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from loomwright.functions import translation
from loomwright.llm import line_dedup, packing, shared
from loomwright.operators import greedy, vectors
from loomwright.plans import queries, record_queries, rule_queries, text_queries

DATA = "/root/testdata/sf0.001"


def test_stories_at_one_place(spark, tmp_path):
    rows = [(1, 7, s, 1) for s in (9, 4, 6, 2, 8)] + [(2, 7, 1, 1), (1, 8, 5, 2), (1, 8, 3, 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert sorted(map(tuple, rule_queries.story_groups(spark, str(tmp_path)).collect())) == [(7, 2, 1), (8, 3, 1)]


def plan_of(spark, df):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_answers_are_read_once(spark):
    assert plan_of(spark, record_queries.singleton_copies(spark, DATA)).count("VariantExpressionEvalUtils.parseJson") == 1


def test_items_are_parsed_once(spark):
    assert plan_of(spark, record_queries.normalised_items(spark, DATA)).count("VariantExpressionEvalUtils.parseJson") == 1


def test_ascii_stays_in_spark(spark):
    texts = ["plain", "", None, "Ünder „ß“ – ﬁ ½ … ㎏ 한 漢 é é \U0001d400\U0001f100 Å", "a\u0085", " ", *[chr(k) + "x" + chr(k + 1) for k in range(128, 0x2100)], "".join(map(chr, range(0xE000, 0x10000)))]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = str.maketrans(translation.PLAIN)
    want = [unicodedata.normalize("NFKD", (t or "").translate(plain)).encode("ascii", "ignore").decode() for t in texts]
    assert [r.plain for r in rows.select("doc_id", translation.ascii_text(F.col("text")).alias("plain")).orderBy("doc_id").collect()] == want
    assert "Python" not in text_queries.ascii_titles(spark, DATA)._jdf.queryExecution().executedPlan().toString()


def test_source_tables_of_odd_rows(spark, tmp_path):
    rows = [(s, o, p, m, f) for s in (None, 0, 1, 2, -5, 6) for o in (None, 1, 2) for p, m, f in ((1, "O", "N"), (1, "F", "n"), (None, None, None), (2, "O", "R"))]
    schema = "l_suppkey long, l_orderkey long, l_partkey long, l_linestatus string, l_returnflag string"
    path = f"{tmp_path}/lineitem.parquet"
    spark.createDataFrame(rows + rows[::7], schema).coalesce(1).write.parquet(path)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{path}/*.parquet')")
        want = db.execute(queries.ORACLE_SQL["source_tables"]).fetchall()
    assert sorted(map(repr, map(tuple, text_queries.source_tables(spark, str(tmp_path)).collect()))) == sorted(map(repr, want))


def test_source_tables_multiply_no_rows(spark):
    plan = plan_of(spark, text_queries.source_tables(spark, DATA))
    assert "Expand" not in plan and "Generate" not in plan


def test_packing_workers_forget(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(4_000))) for i in range(6)], "doc_id long, text string").repartition(1)
    small, usual = ([tuple(r) for r in packing.pack(rows, path, **more).orderBy("doc_id", "start").collect()] for more in ({"remembered": 1_001}, {}))
    assert small == usual

    def known(batches):
        tokens = packing.word_tokens(path, 1, 1_001)
        yield from (pa.record_batch([pa.array([len(tokens.known) + len(tokens.before)])], names=["n"]) for _ in batches)

    assert max(r.n for r in spark.range(8).repartition(8).mapInArrow(known, "n long").collect()) == 1


def test_packing_takes_few_characters_where_little_is_remembered():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"w{i}x{k}" for k in range(500)) for i in range(40)]
    most = []

    class Watched(packing.WordTokens):
        def __call__(self, texts):
            most.append(sum(map(len, texts)))
            return super().__call__(texts)

    tokens = Watched(path, 1, 1_000)
    assert list(packing.encoded(tokens, texts)) == packing.WordTokens(path, 1)(texts) and len(most) > 5


def test_sample_is_made_of_the_best_pairs(spark):
    rows = [(a, b, 1.0 - k / 100, 1.0 - k / 100, ["x"]) for k, (a, b) in enumerate([(1, 2), (1, 3), (1, 4), (1, 5), (6, 7)])]
    pairs = spark.createDataFrame(rows, "a long, b long, priority double, second double, buckets array<string>").coalesce(1)
    asked = []
    for most, made in ((5, 0), (3, 1)):  # Of the first three, a walk takes one.
        best = pairs.orderBy(F.desc("second")).limit(most).select(F.lit("x").alias("bucket"), *greedy.ORDER)
        got = greedy.quota_sample(lambda: asked.append(1) or pairs, [("x", 2)], 1, 2, best, most)
        assert sorted(map(tuple, got.collect())) == [("x", 1, 2), ("x", 6, 7)] and len(asked) == made


def test_best_keeps_the_best_of_each_kind():
    rng = np.random.default_rng(5)
    a, b, s = rng.integers(0, 90, 5_000), rng.integers(90, 180, 5_000), np.round(rng.uniform(0.3, 0.5, 5_000), 3)
    kinds = [lambda a, b, s: (a + b) % 2 == 0, lambda a, b, s: np.floor(s * 20) == 6]
    best = vectors.Best(kinds, 20)
    kept = np.concatenate([best(a[i : i + 500], b[i : i + 500], s[i : i + 500]) for i in range(0, 5_000, 500)])
    for kind in kinds:
        of_kind = kind(a, b, s)
        assert kept[of_kind & (s >= np.sort(s[of_kind])[-20])].all()
    assert kept.sum() < 1_000


def test_the_driver_holds_small_broadcasts_only(spark):
    """100,000 rows of six columns were broadcast before, as were 400,000 ids."""
    ids = shared.saved(spark.range(400_000))
    classes = shared.saved(spark.range(100_000).select("id", *[F.col("id").alias(c) for c in "abcde"]))
    assert shared.bounded(ids, 1_000_000) is ids and shared.bounded(classes, 1_000_000) is classes
    assert shared.bounded(ids, 1_000_000, 64 << 20) is not ids and shared.bounded(shared.saved(spark.range(1_000)), 1_000_000) is not ids


def test_line_classes_that_are_not_broadcast(spark):
    lines = ["A line of a license that stands in very many of all files", "A line that stands in two files, and nearly in a third", "A line that stands in two files, or nearly in a third", "short"]
    rows = [(i, "\n".join([lines[0], lines[1 + i % 3] if i < 40 else f"{i}th line, which is the only one like it: {i * i * 7919}"])) for i in range(200)] + [(None, lines[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    usual = sorted(map(str, line_dedup.line_classes(docs).collect()))
    dealt = line_dedup.line_classes(docs, most_broadcast=0, many=20)
    assert sorted(map(str, dealt.collect())) == usual and len(usual) == 401
    # The 201 copies of one line, and those of another line of over 20, reach many partitions of the shuffle.
    places = spark.range(5_000).select(F.col("id"), F.lit(0).alias("no"), F.lit(7).cast("long").alias("h"), F.lit(3).alias("n"), F.lit(1).alias("m"))
    classes = shared.saved(spark.createDataFrame([(7, 3, 1, (0, 0), 2, True)], "h long, n int, m int, first struct<id long, no int>, n_links long, often boolean"))
    joined = line_dedup.with_classes(places, classes, 0)
    assert joined.filter("n_links = 2 AND first.id = 0").count() == 5_000
    assert "deal" in joined._jdf.queryExecution().optimizedPlan().toString()
