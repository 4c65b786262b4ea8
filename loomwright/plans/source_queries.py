"""Queries that write tables to files of other kinds and read them back, and releases with revisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwright.plans.queries import query
from loomwright.sources import releases, tables
from loomwright.sources.scratch import remove, saved, scratch_dir
from loomwright.sources.tables import table


def read_back(spark, write, read):
    """What read(folder) gives of what write(folder) has written; the folder goes when the rows are written elsewhere."""
    folder = scratch_dir(spark)
    write(folder)
    rows = saved(read(folder))
    remove(spark, folder)
    return rows


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name || ' "a, b"' || chr(10) || 'é' END AS name, c_mktsegment || CASE WHEN c_mktsegment = 'x' THEN '' ELSE '; x' END AS segments, c_acctbal AS balance FROM customer WHERE c_custkey % 3 <> 0""")
def csv_round_trip(spark, sf_dir):
    """A table as quoted CSV and back: commas, quotes, breaks and letters stay, lists are joined, rows without a name are left out."""
    named = F.when(F.col("c_custkey") % 3 != 0, F.concat("c_name", F.lit(' "a, b"\né')))
    rows = table(spark, sf_dir, "customer").select("c_custkey", named.alias("name"), F.array(F.lit("x"), "c_mktsegment", F.lit("x")).alias("segments"), F.col("c_acctbal").alias("balance"))
    return read_back(spark, lambda d: tables.write_csv(rows, d), lambda d: tables.read_csv(spark, d, "c_custkey long, name string, segments string, balance double", ("name",)))


@query("SELECT conv_id, count(*) AS turns, max(role) FILTER (WHERE turn = 0) AS first_role, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1")
def json_round_trip(spark, sf_dir):
    """Nested records as JSON files and back."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    back = read_back(spark, lambda d: rows.write.json(d), lambda d: spark.read.json(d, schema="conv_id long, turns array<struct<turn:long,role:string,text:string>>"))
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda acc, t: acc + F.length(t["text"]))
    return back.select("conv_id", F.size("turns").cast("long").alias("turns"), F.element_at("turns", 1)["role"].alias("first_role"), chars.alias("chars"))


@query("SELECT ts::DATE AS day, event_type, count(*) * CASE WHEN ts::DATE < DATE '2024-01-10' THEN 2 ELSE 1 END AS n FROM events GROUP BY 1, 2")
def daily_archive(spark, sf_dir):
    """Runs appended to an archive in folders by day; the first days were archived twice."""
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_id", "event_type")

    def write(folder: str) -> None:
        tables.archive(rows.filter("day < DATE '2024-01-10'"), folder, "day")
        tables.archive(rows, folder, "day")

    return read_back(spark, write, lambda d: spark.read.parquet(d).groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n")))


@query("""WITH m AS (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1) SELECT 1 AS revision, status, n FROM m UNION ALL SELECT 2, status, n + 1 FROM m UNION ALL SELECT 3, status, n * 2 FROM m WHERE status <> 'P'""")
def release_revisions(spark, sf_dir):
    """A release that is replaced twice: all three revisions can be read."""
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))

    def write(folder: str) -> None:
        releases.write_release(counts, folder)
        releases.write_release(counts.withColumn("n", F.col("n") + 1), folder, replace=True)
        releases.write_release(counts.filter("status <> 'P'").withColumn("n", F.col("n") * 2), folder, replace=True)

    return read_back(spark, write, lambda d: releases.all_revisions(spark, d).select("revision", "status", "n"))


@query("""SELECT 'orders.parquet' AS release, count(*) AS n, min(o_orderkey) AS least FROM orders""")
def release_files(spark, sf_dir):
    """All tables that a pattern names, each a file or a folder, counted by the table's name."""
    rows = tables.read_files(spark, f"{sf_dir}/order*.parquet")
    return rows.groupBy("release").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("least"))


@query("""SELECT 'y=' || year(o_orderdate) AS release, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders GROUP BY 1""")
def release_folders(spark, sf_dir):
    """Releases that are folders of many files, read by one pattern."""
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), "o_custkey").repartition(6)
    back = read_back(spark, lambda d: rows.write.partitionBy("y").parquet(d), lambda d: tables.read_files(spark, f"{d}/y=*"))
    return back.groupBy("release").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))
