"""Registered queries: lookups, pinned runs, local days, identifiers, release dates, counts of reports and their gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.functions import dates, text
from loomwright.operators.ranking import hash_order
from loomwright.sources import tables
from loomwright.sources.tables import table

from .queries import UNITS_SQL, query, units


@query("SELECT o_orderpriority, o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def pinned_run(spark, sf_dir):
    """The last finished run of one version."""
    rows = table(spark, sf_dir, "orders").filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    return rows.select("o_orderpriority", "o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1)


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey = 7")
def point_lookup(spark, sf_dir):
    """The row of a key; a key without a row is an error."""
    return tables.present(table(spark, sf_dir, "nation").filter("n_nationkey = 7").select("n_nationkey", "n_name"), "no nation 7")


@query("SELECT day, count(*) AS n FROM (SELECT ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Amsterdam')::DATE AS day FROM events) WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY 1")
def local_period(spark, sf_dir):
    """A period's days in local time, both ends included. The scan gets a day more on both sides, in UTC."""
    wide = table(spark, sf_dir, "events").filter((F.col("ts") >= F.lit("2024-01-07").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")))
    days = wide.select(dates.local_date(F.col("ts")).alias("day"))
    return days.filter(F.col("day").between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date"))).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT c_custkey, coalesce(o.o_orderpriority, c_mktsegment) AS shown, o.o_orderkey IS NULL AS original FROM customer LEFT JOIN
    (SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o ON o_custkey = c_custkey""")
def newest_with_fallback(spark, sf_dir):
    """Each row with the newest of its translations, or its own text where it has none."""
    own = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    newest = F.max_by(F.struct("o_orderkey", "o_orderpriority"), F.struct("o_orderdate", "o_orderkey")).alias("o")
    last = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(newest)
    return own.join(last, "c_custkey", "left").select("c_custkey", F.coalesce("o.o_orderpriority", "c_mktsegment").alias("shown"), F.col("o.o_orderkey").isNull().alias("original"))


@query("SELECT p_type AS label, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_type) AS place FROM part GROUP BY 1")
def ordered_distribution(spark, sf_dir):
    """Labels from the most frequent on, by name where counts tie; one row a label reaches the window."""
    counts = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "label")).cast("long"))


@query("SELECT user_id AS publisher, count(*) AS articles, count(DISTINCT event_type) AS events, max(ts) AS last_seen FROM events GROUP BY 1")
def publisher_counts(spark, sf_dir):
    """Rows and distinct events of each publisher, in two aggregations of which the first is by both."""
    pairs = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("ts"))
    return pairs.groupBy(F.col("user_id").alias("publisher")).agg(F.sum("n").alias("articles"), F.count("event_type").alias("events"), F.max("ts").alias("last_seen"))


@query("""SELECT n_name AS market, count(DISTINCT o_orderkey) AS articles, count(DISTINCT c_custkey) AS publishers, count(DISTINCT c_mktsegment) AS languages
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def market_stats(spark, sf_dir):
    """Articles, publishers and languages of each market; orders are counted by customer before they meet the market."""
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = per.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey")
    kinds = rows.groupBy("c_nationkey", "c_mktsegment").agg(F.sum("n").alias("articles"), F.count(F.lit(1)).alias("publishers"))
    stats = kinds.groupBy("c_nationkey").agg(F.sum("articles").alias("articles"), F.sum("publishers").alias("publishers"), F.count("c_mktsegment").alias("languages"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("market"))
    return stats.join(nation, "c_nationkey").drop("c_nationkey")


@query("SELECT l_orderkey, count(*) AS members, count(*) > 1 AS multi, count(*) FILTER (WHERE l_returnflag = 'R') AS review FROM lineitem GROUP BY 1")
def member_counts(spark, sf_dir):
    """Members of each event over all time, and those that need review."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("members"), (F.count(F.lit(1)) > 1).alias("multi"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("review")
    )


@query("SELECT count(*) AS events, count(*) FILTER (WHERE n > 1) AS multi, count(*) FILTER (WHERE n = 1) AS singletons, sum(review)::BIGINT AS review FROM (SELECT count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS review FROM lineitem GROUP BY l_orderkey)")
def cluster_totals(spark, sf_dir):
    m = member_counts(spark, sf_dir)
    return m.agg(F.count(F.lit(1)).alias("events"), F.count(F.when(F.col("multi"), 1)).alias("multi"), F.count(F.when(~F.col("multi"), 1)).alias("singletons"), F.sum("review").alias("review"))


@query("SELECT l_orderkey, count(*) AS members FROM lineitem GROUP BY 1 HAVING count(*) > 1 ORDER BY sha256(l_orderkey::VARCHAR) LIMIT 5")
def multi_member_audit(spark, sf_dir):
    """Five events of several articles for an audit, by hash order."""
    return member_counts(spark, sf_dir).filter("multi").orderBy(hash_order("l_orderkey")).limit(5).select("l_orderkey", "members")


@query(f"WITH {UNITS_SQL} SELECT event_type, count(*) AS total, count(*) FILTER (WHERE ai_relevant) AS ai, count(*) FILTER (WHERE NOT ai_relevant) AS not_ai, count(score) AS scored, count(*) FILTER (WHERE ai_relevant AND score IS NULL) AS excluded FROM scored GROUP BY 1")
def exclusion_counts(spark, sf_dir):
    ai, score = F.col("ai_relevant"), F.col("score")
    n = lambda test: F.count(F.when(test, 1))
    return units(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("total"), n(ai).alias("ai"), n(~ai).alias("not_ai"), F.count(score).alias("scored"), n(ai & score.isNull()).alias("excluded"))


@query("SELECT doc_id, substr(sha256(source || '|' || doc_id), 1, 20) AS candidate_id, substr(sha256(doc_id::VARCHAR), 1, 32) AS article_id, 'evt_' || substr(sha256(source), 1, 24) AS event_id, sha256(text) AS text_id FROM documents")
def hash_ids(spark, sf_dir):
    doc = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.hash_id(20, F.col("source"), doc).alias("candidate_id"), text.hash_id(32, doc).alias("article_id"),
        text.hash_id(24, F.col("source"), prefix="evt_").alias("event_id"), F.sha2("text", 256).alias("text_id"),
    )


@query("""SELECT l_orderkey, l_linenumber, least(l_partkey::VARCHAR, l_suppkey::VARCHAR) || '__' || greatest(l_partkey::VARCHAR, l_suppkey::VARCHAR) AS pair,
    least(l_partkey::VARCHAR, l_suppkey::VARCHAR) AS first, greatest(l_partkey::VARCHAR, l_suppkey::VARCHAR) AS second FROM lineitem""")
def parsed_pairs(spark, sf_dir):
    """Ids of pairs, and the pairs that the ids name."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.pair_id(F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("pair"))
    first, second = text.pair_members(F.col("pair"))
    return rows.select("*", first.alias("first"), second.alias("second"))


@query("SELECT user_id, round(epoch_us(max(ts))::DOUBLE / 86400000000 - epoch_us(min(ts))::DOUBLE / 86400000000, 2) AS gap FROM events GROUP BY 1")
def day_gaps(spark, sf_dir):
    spans = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").cast("timestamp").alias("a"), F.max("ts").cast("timestamp").alias("b"))
    return spans.select("user_id", dates.day_gap(F.col("a"), F.col("b"), 2).alias("gap"))


@query("""WITH d AS (SELECT o_orderkey, o_orderdate::TIMESTAMP AS ts, date_trunc('month', o_orderdate)::TIMESTAMP + INTERVAL 2 DAY + INTERVAL 8 HOUR AS this FROM orders),
    r AS (SELECT o_orderkey, ts, CASE WHEN ts < this THEN this ELSE this + INTERVAL 1 MONTH END AS release FROM d)
    SELECT o_orderkey, strftime(release, '%Y-%m-%d %H:%M') AS release, ceil(date_diff('hour', ts, release) / 24.0)::BIGINT AS days FROM r""")
def next_releases(spark, sf_dir):
    """The next release after a day, and the whole days until then, begun ones counted."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    rows = rows.withColumn("at", dates.next_release(F.col("ts")))
    return rows.select("o_orderkey", F.date_format("at", "yyyy-MM-dd HH:mm").alias("release"), F.ceil((F.unix_seconds("at") - F.unix_seconds("ts")) / 86400).alias("days"))
