"""The registered queries: each a DataFrame program over the tables of a folder, and its equivalent in DuckDB's SQL.

Roles of the driver's columns: events are labelled units (event_type gives the status, event_id the degree and relevance,
user_id the country and the unit behind several articles), lineitem rows are sightings of parts, suppliers are publishers.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import dates, labels, text
from loomwright.operators import greedy, indices, ranking, rollups, vectors
from loomwright.sources.tables import keyed_replace, merge_upsert, table
from loomwright.streaming.weekly import weekly_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


WEEK = ("2024-01-08", "2024-01-14")

UNITS_SQL = """
    units AS (
        SELECT event_id, ts, user_id, event_type,
            CASE event_type WHEN 'purchase' THEN 'expanding' WHEN 'error' THEN 'contracting' WHEN 'signup' THEN 'mixed'
                WHEN 'view' THEN 'non_empowerment' ELSE 'unclear' END AS status,
            CASE WHEN event_type IN ('purchase', 'error', 'signup') THEN 1 + event_id % 3 ELSE 0 END AS degree,
            event_id % 10 <> 0 AS ai_relevant, nullif(user_id % 7, 0) AS country
        FROM events
    ), scored AS (
        SELECT *, CASE status WHEN 'expanding' THEN round(degree / 3.0::DOUBLE, 6) WHEN 'contracting' THEN -round(degree / 3.0::DOUBLE, 6)
            WHEN 'unclear' THEN NULL ELSE 0.0::DOUBLE END AS score
        FROM units
    ), week AS (
        SELECT * FROM scored WHERE ts::DATE BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
    )"""


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the role of labelled units, scored."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "expanding").when(kind == "error", "contracting").when(kind == "signup", "mixed").when(kind == "view", "non_empowerment").otherwise("unclear")
    degree = F.when(kind.isin("purchase", "error", "signup"), 1 + F.col("event_id") % 3).otherwise(0)
    rows = e.select("event_id", "ts", "user_id", "event_type", status.alias("status"), degree.alias("degree"), (F.col("event_id") % 10 != 0).alias("ai_relevant"), F.nullif(F.col("user_id") % 7, F.lit(0)).alias("country"))
    return rows.withColumn("score", labels.unit_score(F.col("status"), F.col("degree")))


def week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units(spark, sf_dir).filter((F.col("ts") >= F.lit(WEEK[0]).cast("timestamp_ntz")) & (F.col("ts") < F.date_add(F.lit(WEEK[1]), 1).cast("timestamp_ntz")))


# Scans, filters, projections


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus IN ('F', 'O') ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def latest_run(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("F", "O"))
    return rows.select("o_orderkey", "o_custkey", "o_orderdate").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1)


@query("SELECT count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'")
def exact_count(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
def period_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "events").filter((F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    return rows.select("event_id", "event_type", "value")


@query("""SELECT o_orderkey, (date_trunc('week', o_orderdate) - INTERVAL 7 DAY)::DATE AS first_day, (date_trunc('week', o_orderdate) - INTERVAL 1 DAY)::DATE AS last_day,
    strftime(o_orderdate, '%G-W%V') AS iso_week, date_trunc('month', o_orderdate)::DATE AS month_first, last_day(o_orderdate::DATE) AS month_last FROM orders""")
def periods(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    first, last = dates.previous_week(day)
    month_first, month_last = dates.month_of(day)
    return table(spark, sf_dir, "orders").select("o_orderkey", first.alias("first_day"), last.alias("last_day"), dates.iso_week(day).alias("iso_week"), month_first.alias("month_first"), month_last.alias("month_last"))


@query("SELECT event_id, coalesce(CAST(props->>'$.missing' AS VARCHAR), CAST(props->>'$.k' AS VARCHAR), '') AS first_value FROM events")
def json_first_key(spark, sf_dir):
    value = text.first_filled(F.get_json_object("props", "$.missing"), F.get_json_object("props", "$.k"))
    return table(spark, sf_dir, "events").select("event_id", value.alias("first_value"))


@query("""SELECT doc_id, coalesce(nullif(trim(source), ''), lang, 'unknown') AS origin, text[1:1500] AS excerpt FROM documents WHERE trim(coalesce(text, '')) <> ''""")
def public_projection(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter(F.trim(F.coalesce("text", F.lit(""))) != "")
    return d.select("doc_id", F.coalesce(F.when(F.trim("source") != "", F.trim("source")), "lang", F.lit("unknown")).alias("origin"), F.substring("text", 1, 1500).alias("excerpt"))


@query("SELECT doc_id, quality, toxic FROM labels WHERE toxic = 1 OR quality = 0")
def review_queue(spark, sf_dir):
    return table(spark, sf_dir, "labels").filter("toxic = 1 OR quality = 0").select("doc_id", "quality", "toxic")


# Joins and sets


@query("""SELECT o.o_orderkey, count(*) AS lines, min(l.l_linenumber) AS best_rank, string_agg(DISTINCT l.l_returnflag || l.l_linestatus, '; ' ORDER BY l.l_returnflag || l.l_linestatus) AS markets
    FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1""")
def observation_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.min("l_linenumber").alias("best_rank"), F.array_join(F.array_sort(F.collect_set(F.concat("l_returnflag", "l_linestatus"))), "; ").alias("markets")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey")


@query("SELECT c.c_custkey, coalesce(t.total, 0.0) AS total, t.o_custkey IS NULL AS without_orders FROM customer c LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) t ON c.c_custkey = t.o_custkey")
def left_with_default(spark, sf_dir):
    totals = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    rows = table(spark, sf_dir, "customer").join(totals, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", F.coalesce("total", F.lit(0.0)).alias("total"), F.col("o_custkey").isNull().alias("without_orders"))


@query("""SELECT n.n_name, r.r_name, count(*) AS suppliers FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE s.s_acctbal > 0 GROUP BY 1, 2""")
def star_join(spark, sf_dir):
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    rows = s.filter("s_acctbal > 0").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n")).join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("n_name", "r_name").agg(F.sum("n").alias("suppliers"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000)")
def anti_join(spark, sf_dir):
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 480000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(large, "c_custkey", "left_anti")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_join(spark, sf_dir):
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(large, "c_custkey", "left_semi")


@query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS articles FROM customer WHERE c_acctbal > 5000 GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS events FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS nation, coalesce(articles, 0) AS articles, coalesce(events, 0) AS events FROM a FULL JOIN b ON a.k = b.k""")
def publisher_full_outer(spark, sf_dir):
    a = table(spark, sf_dir, "customer").filter("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("articles"))
    b = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("events"))
    return a.join(b, "nation", "full_outer").select("nation", F.coalesce("articles", F.lit(0)).alias("articles"), F.coalesce("events", F.lit(0)).alias("events"))


@query("SELECT o_orderkey AS k, 'order' AS kind FROM orders UNION ALL SELECT c_custkey, 'customer' FROM customer")
def union_all(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.lit("order").alias("kind")).union(table(spark, sf_dir, "customer").select("c_custkey", F.lit("customer")))


@query("SELECT l_partkey AS k FROM lineitem UNION SELECT p_partkey FROM part")
def union_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k")).union(table(spark, sf_dir, "part").select("p_partkey")).distinct()


@query("SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def difference(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")).subtract(table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select("l_partkey"))


def dated_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), (F.col("vec_id") % 7).alias("day"), F.col("embedding").alias("vector"))


@query("""SELECT a.vec_id AS a, b.vec_id AS b, round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE)), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND abs(a.vec_id % 7 - b.vec_id % 7) <= 1
    WHERE round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE)), 6) >= 0.3""")
def theta_pairs(spark, sf_dir):
    """All pairs of vectors at most one day apart whose similarity reaches 0.3; days are vec_id % 7."""
    return vectors.blocked_pairs(dated_vectors(spark, sf_dir), 1, 0.3)


CANDIDATES_SQL = """WITH p AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE)), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON a.vec_id > b.vec_id AND abs(a.vec_id % 7 - b.vec_id % 7) <= 1), q AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS place FROM p WHERE similarity >= 0.25)"""


@query(CANDIDATES_SQL + " SELECT a, b, similarity, place FROM q WHERE place <= 3")
def candidate_topk(spark, sf_dir):
    """For each vector the three most similar earlier ones at most one day apart."""
    pairs = vectors.blocked_pairs(dated_vectors(spark, sf_dir), 1, 0.25, top=3)
    return ranking.top_per_key(pairs, ["a"], [F.desc("similarity"), F.asc("b")], 3, "place")


@query(CANDIDATES_SQL + """ SELECT a, max(similarity) FILTER (WHERE place = 1) AS best, max(similarity) FILTER (WHERE place = 2) AS second,
    coalesce(max(similarity) FILTER (WHERE place = 1) - max(similarity) FILTER (WHERE place = 2) < 0.035, false) AS competing FROM q WHERE place <= 3 GROUP BY a""")
def competing_candidates(spark, sf_dir):
    return ranking.competing(candidate_topk(spark, sf_dir), "a", "similarity", 0.035)


# Windows, rankings, samples


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def newest_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return ranking.top_per_key(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_orderkey, l_suppkey, l_extendedprice) = 1")
def min_rank_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return ranking.top_per_key(rows, ["l_partkey"], [F.asc(c) for c in ("l_linenumber", "l_orderkey", "l_suppkey", "l_extendedprice")]).drop("l_suppkey", "l_extendedprice")


@query("SELECT p_brand, p_partkey, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size, -length(p_name), p_name, p_partkey) = 1")
def canonical_member(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name", "p_size")
    return ranking.top_per_key(rows, ["p_brand"], [F.asc("p_size"), F.desc(F.length("p_name")), F.asc("p_name"), F.asc("p_partkey")]).drop("p_size")


@query("SELECT status, event_id FROM (SELECT event_type AS status, event_id FROM events) QUALIFY row_number() OVER (PARTITION BY status ORDER BY sha256(event_id::VARCHAR)) <= 2")
def audit_sample(spark, sf_dir):
    """Two units of each status in hash order."""
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("status"), "event_id")
    return ranking.top_per_key(rows, ["status"], [ranking.hash_order("event_id")], 2)


@query("""WITH s AS (SELECT n_name AS market, s_suppkey, count(DISTINCT l_orderkey) AS articles FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
    SELECT market, s_suppkey, articles, row_number() OVER (PARTITION BY market ORDER BY articles DESC, s_suppkey) AS place FROM s QUALIFY place <= 5""")
def market_topk(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey").distinct().groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("articles"))
    rows = lines.join(table(spark, sf_dir, "supplier"), "s_suppkey").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return ranking.top_per_key(rows.select(F.col("n_name").alias("market"), "s_suppkey", "articles"), ["market"], [F.desc("articles"), F.asc("s_suppkey")], 5, "place")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, lower(c_name), c_custkey LIMIT 20")
def mixed_order_top(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), F.lower("c_name"), "c_custkey").limit(20)


@query("""WITH p AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE)), 6) AS similarity
    FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND abs(a.vec_id % 7 - b.vec_id % 7) <= 1)
    SELECT floor(similarity * 20)::BIGINT AS bin, a, b FROM p WHERE similarity >= 0.3 QUALIFY row_number() OVER (PARTITION BY bin ORDER BY a, b) <= 8""")
def stratified_bins(spark, sf_dir):
    """Eight pairs of each similarity bin."""
    rows = theta_pairs(spark, sf_dir).select(F.floor(F.col("similarity") * 20).alias("bin"), "a", "b")
    return ranking.top_per_key(rows, ["bin"], [F.asc("a"), F.asc("b")], 8)


# Aggregates


@query("SELECT l_partkey, min(l_linenumber) AS best_rank, count(DISTINCT l_orderkey) AS orders, string_agg(DISTINCT lower(l_returnflag), '; ' ORDER BY lower(l_returnflag)) AS flags, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen FROM lineitem GROUP BY 1")
def observation_rollup(spark, sf_dir):
    """Distinct orders, sorted flags and first and last day of each part, by one shuffle of what tasks have combined.

    A part with most rows is combined within tasks: its flags are a set, and of its orders each task keeps each once.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.lower("l_returnflag").alias("flag"), "l_shipdate")
    return rollups.by_key(lines, "l_partkey", "l_orderkey", "l_linenumber", "flag", "l_shipdate").toDF("l_partkey", "best_rank", "orders", "flags", "first_seen", "last_seen")


@query(f"WITH {UNITS_SQL} SELECT event_id, status, degree, score FROM scored")
def unit_score(spark, sf_dir):
    return units(spark, sf_dir).select("event_id", "status", "degree", "score")


INDEX_SQL = "round(avg(score) FILTER (WHERE ai_relevant AND score IS NOT NULL) * 100, 4)"


@query(f"WITH {UNITS_SQL} SELECT CASE WHEN grouping(country) = 1 THEN 'all' ELSE coalesce(country::VARCHAR, 'none') END AS country, count(*) AS units, count(*) FILTER (WHERE ai_relevant) AS relevant, count(*) FILTER (WHERE ai_relevant AND score IS NOT NULL) AS scored, {INDEX_SQL} AS idx, count(*) FILTER (WHERE ai_relevant AND score IS NOT NULL) >= CASE WHEN grouping(country) = 1 THEN 1 ELSE 3 END AS ready, grouping(country)::INTEGER AS is_global FROM week GROUP BY GROUPING SETS ((), (country))")
def empowerment_index(spark, sf_dir):
    """Counts, index and readiness of the week, over all and by country."""
    rows = week(spark, sf_dir).groupingSets([[], ["country"]], "country").agg(*indices.unit_counts(), indices.index(F.col("score"), F.col("ai_relevant")).alias("idx"), F.grouping("country").cast("int").alias("is_global"))
    country = F.when(F.col("is_global") == 1, "all").otherwise(F.coalesce(F.col("country").cast("string"), F.lit("none")))
    return rows.select(country.alias("country"), "units", "relevant", "scored", "idx", (F.col("scored") >= F.when(F.col("is_global") == 1, 1).otherwise(3)).alias("ready"), "is_global")


@query(f"""WITH {UNITS_SQL}, d AS (SELECT unnest(['expanding', 'contracting', 'mixed', 'non_empowerment', 'unclear', 'withheld']) AS label)
    SELECT label, count(status) AS n, round(count(status) / (SELECT count(*) FROM week WHERE ai_relevant), 4) AS share FROM d LEFT JOIN (SELECT * FROM week WHERE ai_relevant) w ON d.label = w.status GROUP BY label""")
def dense_share(spark, sf_dir):
    return indices.dense_shares(week(spark, sf_dir).filter("ai_relevant"), "status", (*labels.STATUSES, "withheld"))


@query("SELECT coalesce(nullif(lang, ''), 'unclear') AS label, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 4) AS share FROM documents GROUP BY 1")
def sparse_distribution(spark, sf_dir):
    return indices.sparse_shares(table(spark, sf_dir, "documents"), "lang")


@query("SELECT 'quality' AS dimension, round(avg(quality), 6) AS share FROM labels UNION ALL SELECT 'toxic', round(avg(toxic), 6) FROM labels")
def dimension_share(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").unpivot(["doc_id"], ["quality", "toxic"], "dimension", "present")
    return rows.groupBy("dimension").agg(F.round(F.avg("present"), 6).alias("share"))


AMPLIFY_SQL = f"""WITH {UNITS_SQL}, e AS (SELECT * FROM week QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1),
    c AS (SELECT {INDEX_SQL} AS idx, count(*) FILTER (WHERE ai_relevant) AS n FROM week), v AS (SELECT {INDEX_SQL} AS idx, count(*) FILTER (WHERE ai_relevant) AS n FROM e)
    SELECT c.idx AS coverage_index, v.idx AS event_index, c.n AS articles, v.n AS events, round(c.idx - v.idx, 4) AS gap, round(c.n / nullif(v.n, 0), 4) AS ratio FROM c, v"""


@query(AMPLIFY_SQL)
def amplification(spark, sf_dir):
    """Index and count of all units against those of the first unit of each user and type."""
    w = week(spark, sf_dir)
    events = ranking.top_per_key(w, ["user_id", "event_type"], [F.asc("ts"), F.asc("event_id")])
    of = lambda df, lens: df.agg(F.lit(lens).alias("lens"), indices.index(F.col("score"), F.col("ai_relevant")).alias("idx"), F.count(F.when(F.col("ai_relevant"), 1)).alias("n"))
    return indices.amplification(of(w, "coverage").union(of(events, "event")))


@query("SELECT sum(n - 1) FILTER (WHERE n > 1)::BIGINT AS excess, count(*) AS events, count(*) FILTER (WHERE n = 1) AS singletons, sum(n)::BIGINT AS articles, sum(n)::BIGINT - count(*) = sum(greatest(n - 1, 0))::BIGINT AS reconciled FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)")
def extra_coverage(spark, sf_dir):
    sizes = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    one = sizes.agg(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)).alias("excess"), F.count(F.lit(1)).alias("events"), F.count(F.when(F.col("n") == 1, 1)).alias("singletons"), F.sum("n").alias("articles"))
    return one.select("*", (F.col("articles") - F.col("events") == F.col("excess")).alias("reconciled"))


@query("""WITH f AS (SELECT user_id, min(ts) AS first FROM events GROUP BY 1) SELECT count(*) FILTER (WHERE first >= TIMESTAMP '2024-01-08') AS new_users, count(*) FILTER (WHERE first < TIMESTAMP '2024-01-08') AS recurring
    FROM f WHERE user_id IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15')""")
def new_vs_recurring(spark, sf_dir):
    ts = lambda d: F.lit(d).cast("timestamp_ntz")
    users = table(spark, sf_dir, "events").filter(F.col("ts") < ts("2024-01-15")).groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last")).filter(F.col("last") >= ts("2024-01-08"))
    return users.agg(F.count(F.when(F.col("first") >= ts("2024-01-08"), 1)).alias("new_users"), F.count(F.when(F.col("first") < ts("2024-01-08"), 1)).alias("recurring"))


@query("SELECT source, count(*) AS articles, count(DISTINCT lang) AS languages, string_agg(DISTINCT lang, '; ' ORDER BY lang) AS langs, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY 1")
def source_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("articles"), F.countDistinct("lang").alias("languages"), F.array_join(F.array_sort(F.collect_set("lang")), "; ").alias("langs"))
    total = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("all"))
    return rows.join(F.broadcast(total)).select("source", "articles", "languages", "langs", F.round(F.col("articles") / F.col("all"), 6).alias("share"))


@query("""WITH d AS (SELECT ts::DATE AS day, user_id FROM events), f AS (SELECT user_id, min(day) AS day FROM d GROUP BY 1), n AS (SELECT day, count(*) AS fresh FROM f GROUP BY 1)
    SELECT day, fresh, sum(fresh) OVER (ORDER BY day)::BIGINT AS cumulative FROM n""")
def cumulative_distinct(spark, sf_dir):
    """Users seen up to each day: counted once at their first day, then summed over the days."""
    from pyspark.sql import Window

    first = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(F.to_date("ts")).alias("day"))
    fresh = first.groupBy("day").agg(F.count(F.lit(1)).alias("fresh"))
    # One row a day.
    return fresh.withColumn("cumulative", F.sum("fresh").over(Window.orderBy("day")))


@query("SELECT date_trunc('month', ts)::DATE AS month, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def month_to_date(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.trunc("ts", "month").alias("month")).agg(F.countDistinct("user_id").alias("users"))


@query("""WITH m AS (SELECT e.label, i AS place, avg(e.embedding[i + 1]::DOUBLE) AS m FROM embeddings e, range(0, 64) t(i) GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(m * m)) AS norm FROM m GROUP BY 1)
    SELECT m.label, m.place::INTEGER AS place, round(m / norm, 6) AS value FROM m JOIN n ON m.label = n.label""")
def centroid(spark, sf_dir):
    return vectors.centroids(table(spark, sf_dir, "embeddings"), "label", "embedding")


@query("""WITH c AS (SELECT count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS tp, count(*) FILTER (WHERE toxic = 0 AND quality = 0) AS fp, count(*) FILTER (WHERE toxic = 1 AND quality = 1) AS fn, count(*) FILTER (WHERE toxic = 0 AND quality = 1) AS tn FROM labels)
    SELECT tp, fp, fn, tn, CASE WHEN tp + fp = 0 THEN 0.0 ELSE round(tp / (tp + fp), 4) END AS precision_, CASE WHEN tp + fn = 0 THEN 0.0 ELSE round(tp / (tp + fn), 4) END AS recall, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE round(2 * tp / (2 * tp + fp + fn), 4) END AS f1, round((tp + tn) / (tp + fp + fn + tn), 4) AS accuracy FROM c""")
def confusion_metrics(spark, sf_dir):
    n = lambda toxic, quality: F.count(F.when((F.col("toxic") == toxic) & (F.col("quality") == quality), 1))
    c = table(spark, sf_dir, "labels").agg(n(1, 0).alias("tp"), n(0, 0).alias("fp"), n(1, 1).alias("fn"), n(0, 1).alias("tn"))
    part = lambda a, b: F.when(b == 0, 0.0).otherwise(F.round(F.try_divide(a, b), 4))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select("tp", "fp", "fn", "tn", part(tp, tp + fp).alias("precision_"), part(tp, tp + fn).alias("recall"), part(2 * tp, 2 * tp + fp + fn).alias("f1"), part(tp + tn, tp + fp + fn + tn).alias("accuracy"))


@query("SELECT date_trunc('week', ts)::DATE AS week, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def weekly_window(spark, sf_dir):
    return weekly_counts(table(spark, sf_dir, "events"))


@query("SELECT label, n FROM (SELECT lang AS label, count(*) AS n FROM documents GROUP BY 1) ORDER BY n DESC, label LIMIT 1")
def dominant_category(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(1)


# Scalar functions


@query(r"SELECT page_id, regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://([^/?#]*)', 1), ':\d+$', ''), '^www\.', '') AS domain FROM pages")
def clean_domain(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.clean_domain(F.col("url")).alias("domain"))


@query(r"""WITH r AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS u FROM pages), x AS (SELECT page_id, i, string_split(regexp_extract(u, '\?(.*)$', 1), '&')[i] AS p FROM r, range(1, 20) t(i)),
    k AS (SELECT page_id, i, string_split(p, '=')[1] AS name, CASE WHEN contains(p, '=') THEN substring(p, position('=' IN p) + 1) ELSE '' END AS v FROM x WHERE coalesce(p, '') <> ''),
    q AS (SELECT page_id, string_agg(replace(url_encode(url_decode(replace(name, '+', ' '))), '%20', '+') || '=' || replace(url_encode(url_decode(replace(v, '+', ' '))), '%20', '+'), '&' ORDER BY i) AS q FROM k WHERE lower(name) NOT IN ('utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'gclid', 'fbclid', 'mc_cid', 'mc_eid') GROUP BY 1),
    c AS (SELECT r.page_id, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?]*)', 1)) || regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*([^?]*)', 1), '/+$', '') || coalesce('?' || q, '') AS canonical FROM r LEFT JOIN q ON r.page_id = q.page_id)
    SELECT page_id, canonical, substring(sha256(canonical), 1, 32) AS article_id FROM c""")
def canonical_url(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", text.canonical_url(F.col("url")).alias("canonical"))
    return rows.select("page_id", "canonical", text.hash_id(32, F.col("canonical")).alias("article_id"))


@query(r"SELECT doc_id, sha256(regexp_replace(lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))), '[^\p{L}\p{N}_\p{M}\s]', '', 'g')) AS title_key FROM documents")
def title_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.normalize_title(F.col("text")), 256).alias("title_key"))


THEMES = [("safety", r"\b(?:security|threat|token|risk)\b"), ("rules", r"licens|\blaw\b|\brights?\b"), ("insult", r"\b(?:idiot|moron|clown)\b")]


@query(r"""SELECT doc_id, regexp_matches(coalesce(text, ''), '[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]') AS han, array_to_string(regexp_extract_all(coalesce(text, ''), '\d+(?:[.,]\d+)*'), ' ') AS numbers,
    CASE WHEN lower(lang) LIKE 'zh%' THEN 'zh' WHEN lower(lang) LIKE 'fr%' THEN 'fr' WHEN lower(lang) LIKE 'en%' THEN 'en' ELSE string_split(lower(coalesce(lang, '')), '-')[1] END AS language FROM documents""")
def text_checks(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", text.has_han(t).alias("han"), F.array_join(text.numbers_in(t), " ").alias("numbers"), text.search_language(F.col("lang")).alias("language"))


@query("SELECT event_id, CASE WHEN value IS NULL THEN 'n/a' ELSE printf('%+.2f', value) END AS signed_value, round(value * exp(-0.2 * (event_id % 8)), 6) AS decayed, 'run_' || strftime(ts, '%Y%m%dT%H%M%SZ') AS run_key FROM events")
def formatted(spark, sf_dir):
    decayed = F.round(F.col("value") * F.exp(-0.2 * (F.col("event_id") % 8)), 6)
    return table(spark, sf_dir, "events").select("event_id", text.signed(F.col("value"), 2).alias("signed_value"), decayed.alias("decayed"), dates.run_key("run", F.col("ts")).alias("run_key"))


@query("""WITH u AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'expanding' WHEN quality = 1 THEN 'odd' WHEN toxic = 1 THEN 'unclear' ELSE 'non_empowerment' END AS raw, (doc_id % 6 - 1)::INTEGER AS deg FROM labels),
    v AS (SELECT *, CASE WHEN raw = 'odd' THEN 'unclear' ELSE raw END AS status, greatest(0, least(3, deg)) AS d FROM u)
    SELECT doc_id, status, CASE WHEN status <> 'expanding' THEN 0 WHEN d = 0 THEN 1 ELSE d END AS degree,
    concat_ws('; ', CASE WHEN raw = 'odd' THEN 'unknown status' END, CASE WHEN status = 'expanding' AND d = 0 THEN 'direction without degree' END, CASE WHEN deg <> d THEN 'degree out of range' END) AS issues,
    status = 'unclear' OR raw = 'odd' OR (status = 'expanding' AND d = 0) OR deg <> d AS requires_review FROM v""")
def validate_label(spark, sf_dir):
    status = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "expanding").when(F.col("quality") == 1, "odd").when(F.col("toxic") == 1, "unclear").otherwise("non_empowerment")
    rows = table(spark, sf_dir, "labels").select("doc_id", status.alias("status"), (F.col("doc_id") % 6 - 1).cast("int").alias("degree"), F.lit("none").alias("dominant"))
    return labels.validated(rows).select("doc_id", "status", "degree", F.array_join("issues", "; ").alias("issues"), "requires_review")


@query(f"""WITH {UNITS_SQL} SELECT event_id, concat_ws('; ', CASE WHEN status = 'unclear' THEN 'empowerment status unclear' END, CASE WHEN status = 'non_empowerment' AND user_id % 5 = 0 THEN 'non-empowerment classification contains present dimensions' END,
    CASE WHEN user_id % 13 = 0 THEN 'dominant dimension is absent from dimension data' WHEN user_id % 11 = 0 THEN 'dominant dimension is not marked present' END, CASE WHEN NOT ai_relevant AND status IN ('expanding', 'contracting', 'mixed') THEN 'AI-irrelevant unit has a directional empowerment classification' END) AS reasons,
    CASE WHEN status = 'unclear' AND user_id % 5 <> 0 THEN 'non_empowerment' ELSE status END AS settled FROM scored""")
def review_reasons(spark, sf_dir):
    u, present = units(spark, sf_dir), F.col("user_id") % 5 == 0
    reasons = labels.review_reasons(F.col("status"), F.col("degree"), F.col("score"), F.col("ai_relevant"), present, F.col("user_id") % 13 != 0, F.col("user_id") % 11 != 0)
    return u.select("event_id", F.array_join(reasons, "; ").alias("reasons"), labels.residual_status(F.col("status"), F.col("degree"), present, F.lit(None)).alias("settled"))


# Nested data, sinks, gates


@query("SELECT conv_id, count(*) AS turns, string_agg(role, '>' ORDER BY turn) AS roles, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1")
def nested_rebuild(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("t"), F.sum(F.length("text")).alias("chars"))
    return turns.select("conv_id", F.size("t").cast("long").alias("turns"), F.array_join(F.transform("t", lambda x: x["role"]), ">").alias("roles"), "chars")


@query("SELECT l_orderkey, unnest(list_sort(list_distinct(list(l_returnflag)))) AS flag FROM lineitem GROUP BY 1")
def explode_distinct(spark, sf_dir):
    sets = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("flags"))
    return sets.select("l_orderkey", F.explode("flags").alias("flag"))


@query("SELECT event_type, ts::DATE AS day, count(*) AS n FROM events WHERE ts::DATE <> DATE '2024-01-10' GROUP BY 1, 2 UNION ALL SELECT event_type, ts::DATE, 2 * count(*) FROM events WHERE ts::DATE = DATE '2024-01-10' GROUP BY 1, 2")
def keyed_replacement(spark, sf_dir):
    """One day's counts recomputed and put in the place of the old ones."""
    old = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    new = old.filter(F.col("day") == F.lit("2024-01-10").cast("date")).select("event_type", "day", (F.col("n") * 2).alias("n"))
    return keyed_replace(old, new, ["event_type", "day"])


@query("""WITH o AS (SELECT user_id, min(ts) AS first_seen, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1), w AS (SELECT user_id, min(ts) AS first_seen, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-09' GROUP BY 1)
    SELECT coalesce(o.user_id, w.user_id) AS user_id, least(o.first_seen, w.first_seen) AS first_seen, coalesce(w.n, o.n) AS n FROM o FULL JOIN w ON o.user_id = w.user_id""")
def merge_preserving_first(spark, sf_dir):
    """Upsert in which the earlier first_seen stays."""
    ts = lambda d: F.lit(d).cast("timestamp_ntz")
    of = lambda test: table(spark, sf_dir, "events").filter(test).groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.count(F.lit(1)).alias("n"))
    return merge_upsert(of(F.col("ts") < ts("2024-01-10")), of(F.col("ts") >= ts("2024-01-09")), ["user_id"], ("first_seen",))


# Folds that depend on order: no SQL equivalent


@query()
def greedy_cluster(spark, sf_dir):
    """Vectors of each label, clustered one after the other in order of day, rank and headline."""
    token = F.when(F.col("vec_id") % 4 == 0, F.concat(F.lit("t"), F.col("vec_id") % 20))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / 3).alias("day"), (F.col("vec_id") % 5).alias("rank"), F.md5(F.col("vec_id").cast("string")).alias("headline"), token.alias("token"), F.col("embedding").alias("vector"), "label")
    return greedy.greedy_clusters(rows, "label", 0.2, 0.1)


#: Pairs of each bucket that greedy_sample looks at before it makes all.
BEST_PAIRS = 4_000


@query()
def greedy_sample(spark, sf_dir):
    """The best pairs of each bucket within quotas, no vector in over two of them, and others up to 90."""
    quotas = [("even", 30), ("b6", 25), ("b7", 20), ("b8", 10)]
    kinds = [lambda a, b, s: (a + b) % 2 == 0, *[lambda a, b, s, k=k: np.floor(s * 20) == k for k in (6, 7, 8)], lambda a, b, s: s == s]

    def bucketed(pairs):
        bins = F.concat(F.lit("b"), F.floor(F.col("similarity") * 20))
        return pairs.select("a", "b", F.round("similarity", 2).alias("priority"), F.col("similarity").alias("second"), F.array(bins, F.when((F.col("a") + F.col("b")) % 2 == 0, "even")).alias("buckets"))

    best = bucketed(vectors.blocked_pairs(dated_vectors(spark, sf_dir), 1, 0.3, best=(kinds, BEST_PAIRS)))
    named = F.array_intersect("buckets", F.array(*[F.lit(name) for name, _ in quotas]))
    best = best.select(F.explode(F.array_append(named, F.lit(None).cast("string"))).alias("bucket"), *greedy.ORDER)
    best = ranking.top_per_key(best, ["bucket"], greedy.ordered_columns(), BEST_PAIRS)
    return greedy.quota_sample(lambda: bucketed(theta_pairs(spark, sf_dir)), quotas, 2, 90, best, BEST_PAIRS)
