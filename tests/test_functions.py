from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from loomwright.functions import dates, labels, records, text, translation
from loomwright.operators import indices
from loomwright.sources import tables
from loomwright.sources.tables import keyed_replace, merge_upsert, read_csv, write_csv
from loomwright.streaming.weekly import first_sightings, weekly_counts


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_text(spark):
    got = one(
        spark,
        text.normalize_space(F.lit("  a  \t b\n")),
        text.normalize_space(F.lit(None).cast("string")),
        text.normalize_title(F.lit("Ünder-Score_1: OK!")),
        text.canonical_url(F.lit("HTTPS://WWW.Example.COM/A/b//?utm_source=x&q=1&GCLID=2&e=#frag")),
        text.clean_domain(F.lit("https://www.Example.com:8080/x")),
        text.pair_id(F.lit("b"), F.lit("a")),
        text.has_han(F.lit("中")),
        text.search_language(F.lit("zh-TW")),
        text.has_term(F.lit("Said and done"), ["ai"], {"ai"}),
        text.has_term(F.lit("An AI law"), ["ai"], {"ai"}),
    )
    assert got == ("a b", "", "ünderscore_1 ok", "https://www.example.com/A/b?q=1&e=", "example.com", "a__b", True, "zh", False, True)


def test_translation_faults(spark):
    got = one(spark, translation.rendering_faults(F.lit("fr"), F.lit("12 et 3,5"), F.lit("12 and 4")), translation.rendering_faults(F.lit("en"), F.lit(None).cast("string"), F.lit(None).cast("string")))
    assert got == (["numeric information not preserved: 3,5"], ["empty translation"])


def test_casefold(spark):
    words = ["Straße", "GROẞ", "ΣΊΣΥΦΟΣ", "ﬁn ŉ ǰ", "İstanbul", "ſ", "ÀÉ", "漢", "", "Ꭰ", None]
    got = {r.w: r.f for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", records.casefold(F.col("w")).alias("f")).collect()}
    assert got == {w: None if w is None else w.casefold() for w in words}


def test_audit_without_entry_fails(spark):
    from loomwright.operators import gates

    rows = spark.createDataFrame([(1, 0, None), (2, 1, None), (3, 7, "x")], "id int, quality int, text string")
    rules = [gates.Rule("correction without entry", (F.col("quality") == 0) & F.col("text").isNull()), gates.Rule("unsupported verdict", ~F.col("quality").isin(0, 1))]
    with pytest.raises(Exception, match="correction without entry: 1, unsupported verdict: 1"):
        gates.passed(rows, gates.counted(rows, rules)).collect()


def test_dates(spark):
    day, ts = F.lit(date(2024, 1, 17)), F.lit(datetime(2024, 1, 3, 9)).cast("timestamp")
    got = one(spark, *dates.previous_week(day), *dates.month_of(day), dates.iso_week(F.lit(date(2021, 1, 3))), F.date_format(dates.next_release(ts), "yyyy-MM-dd HH"))
    assert got == (date(2024, 1, 8), date(2024, 1, 14), date(2024, 1, 1), date(2024, 1, 31), "2020-W53", "2024-02-03 08")


def test_index_golden(spark):
    """75 scored units whose scores add up to two thirds give 0.8889; 72 give 0.9259; 123 to 120 is 1.025."""
    for n, want in ((75, 0.8889), (72, 0.9259), (43, 1.5504)):
        df = spark.range(n).select(F.when(F.col("id") < 2, F.round(F.lit(1 / 3), 6)).otherwise(0.0).alias("score"))
        assert abs(df.agg(indices.index(F.col("score"), F.lit(True))).first()[0] - want) < 2e-4
    lens = spark.createDataFrame([("coverage", 0.8889, 123), ("event", 0.9259, 120)], "lens string, idx double, n long")
    row = indices.amplification(lens).first()
    assert (row.gap, row.ratio) == (-0.037, 1.025)


def test_scores_and_validation(spark):
    rows = spark.createDataFrame([("expanding", 0, "none"), ("bad", 2, "x"), ("contracting", 9, "x"), (None, None, None)], "status string, degree int, dominant string")
    got = [(r.status, r.degree, r.dominant, r.issues, r.requires_review) for r in labels.validated(rows).collect()]
    assert got[0] == ("expanding", 1, None, ["direction without degree"], True)
    assert got[1][:2] == ("unclear", 0) and got[1][4]
    assert got[2][:2] == ("contracting", 3)
    assert got[3][:2] == ("unclear", 0) and got[3][4]
    assert one(spark, labels.unit_score(F.lit("contracting"), F.lit(2)), labels.unit_score(F.lit("unclear"), F.lit(0))) == (-0.666667, None)


def test_upserts(spark):
    old = spark.createDataFrame([(1, 5, "a"), (2, 6, "b")], "k int, first int, v string")
    new = spark.createDataFrame([(2, 9, "c"), (3, 7, "d")], "k int, first int, v string")
    assert sorted(map(tuple, keyed_replace(old, new, ["k"]).collect())) == [(1, 5, "a"), (2, 9, "c"), (3, 7, "d")]
    assert sorted(map(tuple, merge_upsert(old, new, ["k"], ("first",)).collect())) == [(1, 5, "a"), (2, 6, "c"), (3, 7, "d")]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a,b", ["y", "x", "y"]), ('q"q', [])], "t string, l array<string>")
    write_csv(df, str(tmp_path / "x"))
    got = sorted(map(tuple, read_csv(spark, str(tmp_path / "x"), "t string, l string", ("t",)).collect()))
    assert got[0] == ("a,b", "x; y") and got[1][0] == 'q"q'


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    run = weekly_counts(stream).writeStream.format("memory").queryName("weeks").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    run.awaitTermination(60)
    assert sorted(map(tuple, spark.table("weeks").collect())) == sorted(map(tuple, weekly_counts(events).collect()))
    assert first_sightings(events, "user_id", "ts").count() == events.select("user_id").distinct().count()


def test_upsert_with_nulls_and_first_rows(spark):
    old, new = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "k int, x string, y string"), spark.createDataFrame([(1, None, "z"), (3, "e", None)], "k int, x string, y string")
    assert sorted(map(tuple, merge_upsert(old, new, ["k"]).collect())) == [(1, None, "z"), (2, "c", "d"), (3, "e", None)]
    seen = spark.createDataFrame([("a", 3, "2024-01-03"), ("a", 1, "2024-01-01"), ("a", 2, "2024-01-01"), ("b", 4, "2024-01-02")], "key string, id int, ts string")
    assert sorted((r.key, r.id) for r in first_sightings(seen, "key", "ts").collect()) == [("a", 1), ("b", 4)]


def test_addresses_and_days(spark):
    rows = spark.createDataFrame([("http://A.org/x/?a&b=1%2F2&UTM_source=q&c=%7E+z#f", "2024-03-31T23:30:00Z", "x"), ("http://a.org", "soon", "2024-05-06 rest"), (None, "2024-01-01", None)], "u string, d string, e string")
    got = rows.select(text.canonical_url(F.col("u")).alias("u"), dates.first_day(F.col("d"), F.col("e")).cast("string").alias("d")).collect()
    assert [r.u for r in got] == ["http://a.org/x?a=&b=1%2F2&c=~+z", "http://a.org", ""]
    assert [r.d for r in got] == ["2024-04-01", None, "2024-01-01"]


def test_csv_with_mark_and_missing_fields(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('\ufeff"id","label"\n"1","same"\n"2",""\n"3","a ""b"" c"\n', encoding="utf-8")
    rows = read_csv(spark, str(path), "id int, label string", required=("label",)).collect()
    assert [(r.id, r.label) for r in rows] == [(1, "same"), (3, 'a "b" c')]


def test_files_with_marks_gaps_and_missing_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('\ufeffid,name\n1,"x, ""y"""\n2,\n'.encode())
    rows = tables.read_csv(spark, f"file://{tmp_path}/a.csv", "id int, name string")
    assert [tuple(r) for r in rows.collect()] == [(1, 'x, "y"'), (2, None)]
    kept = tables.read_csv(spark, f"file://{tmp_path}/a.csv", "id int, name string", required=("name",))
    assert [r.id for r in kept.collect()] == [1]
    (tmp_path / "b.csv").write_text("id,other\n1,x\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        tables.read_csv(spark, f"file://{tmp_path}/b.csv", "id int, name string", required=("name",)).collect()
    (tmp_path / "c.json").write_text('{"id": 1,\n "tags": ["a"]}')
    assert tuple(tables.read_json(spark, f"file://{tmp_path}/c.json", "id int, tags array<string>, note string").first()) == (1, ["a"], None)


def test_archive(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, run string")
    for _ in range(2):
        tables.archive(rows, f"file://{tmp_path}/archive", "run")
    back = spark.read.parquet(f"file://{tmp_path}/archive")
    assert sorted((r.id, r.run) for r in back.collect()) == [(1, "a")] * 2 + [(2, "b")] * 2 + [(3, "a")] * 2
    names = {r.release for r in tables.read_files(spark, f"file://{tmp_path}/archive/run=*").collect()}
    assert names == {"run=a", "run=b"}


def test_lookup_without_a_row_fails(spark):
    rows = spark.createDataFrame([(1, "a")], "id int, name string")
    assert [tuple(r) for r in tables.present(rows.filter("id = 1"), "no row").collect()] == [(1, "a")]
    with pytest.raises(Exception, match="no row"):
        tables.present(rows.filter("id = 2"), "no row").collect()
