"""Further registered queries: label joins, rule matches, sequences, pairs, revisions and checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.operators import ranking
from loomwright.sources.tables import table

from .queries import UNITS_SQL, query, units


@query("""SELECT d.doc_id, coalesce(l.quality, 0) = 1 AS quality, coalesce(l.toxic, 0) = 1 AS toxic, l.doc_id IS NULL AS unlabelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def dimension_map(spark, sf_dir):
    """Each document with all its dimensions, absent ones as false."""
    long = table(spark, sf_dir, "labels").unpivot(["doc_id"], ["quality", "toxic"], "dimension", "present")
    maps = long.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("dimension", "present"))).alias("m"))
    rows = table(spark, sf_dir, "documents").select("doc_id").join(maps, "doc_id", "left")
    has = lambda k: (F.coalesce(F.col("m")[k], F.lit(0)) == 1).alias(k)
    return rows.select("doc_id", has("quality"), has("toxic"), F.col("m").isNull().alias("unlabelled"))


@query("SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place, 'turn_' || lpad((row_number() OVER (PARTITION BY conv_id ORDER BY turn))::VARCHAR, 3, '0') AS label FROM conversations")
def sequence_labels(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", place.alias("place"))
    return rows.withColumn("label", F.concat(F.lit("turn_"), F.lpad(F.col("place").cast("string"), 3, "0")))


@query("""WITH s AS (SELECT p_brand, p_partkey, p_name, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_partkey) AS place FROM part), a AS (SELECT * FROM s WHERE place = 1)
    SELECT a.p_brand, a.p_partkey AS anchor, s.p_partkey AS other FROM a JOIN s ON a.p_brand = s.p_brand AND s.place > 1 QUALIFY row_number() OVER (PARTITION BY a.p_brand ORDER BY s.p_type = a.p_type, s.p_partkey) <= 4""")
def anchor_pairs(spark, sf_dir):
    """The longest name of each brand with up to four others, those of another type first."""
    parts = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name", "p_type")
    anchors = ranking.top_per_key(parts, ["p_brand"], [F.desc(F.length("p_name")), F.asc("p_partkey")]).select("p_brand", F.col("p_partkey").alias("anchor"), F.col("p_type").alias("kind"))
    pairs = parts.join(anchors, "p_brand").filter("p_partkey <> anchor")
    return ranking.top_per_key(pairs, ["p_brand"], [F.asc(F.col("p_type") == F.col("kind")), F.asc("p_partkey")], 4).select("p_brand", "anchor", F.col("p_partkey").alias("other"))


@query("SELECT day, n FROM (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1) ORDER BY day DESC LIMIT 12")
def last_points(spark, sf_dir):
    """The twelve latest days."""
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("day")).limit(12)


@query("SELECT coalesce(nullif(o_orderstatus, ''), 'unrecorded') AS decision, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def decision_counts(spark, sf_dir):
    decision = F.coalesce(F.when(F.col("o_orderstatus") != "", F.col("o_orderstatus")), F.lit("unrecorded"))
    return table(spark, sf_dir, "orders").groupBy(decision.alias("decision")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("customers"))


@query(f"""WITH {UNITS_SQL}, r AS (SELECT country, round(avg(score) FILTER (WHERE ai_relevant) * 100, 4) AS idx, count(*) AS n FROM scored GROUP BY 1)
    SELECT count(*) FILTER (WHERE idx IS NULL) AS without_index, count(*) FILTER (WHERE NOT idx BETWEEN -100 AND 100) AS out_of_range, count(*) FILTER (WHERE n <= 0) AS empty, bool_and(n > 0) AS passed FROM r""")
def index_gate(spark, sf_dir):
    """Indices must exist and lie in -100 to 100, with units behind them."""
    rows = units(spark, sf_dir).groupBy("country").agg(F.round(F.avg(F.when(F.col("ai_relevant"), F.col("score"))) * 100, 4).alias("idx"), F.count(F.lit(1)).alias("n"))
    return rows.agg(
        F.count(F.when(F.col("idx").isNull(), 1)).alias("without_index"), F.count(F.when(~F.col("idx").between(-100, 100), 1)).alias("out_of_range"),
        F.count(F.when(F.col("n") <= 0, 1)).alias("empty"), F.bool_and(F.col("n") > 0).alias("passed"),
    )


@query("""WITH p AS (SELECT event_id, value / 100 AS similarity, (event_id % 97) / 97.0::DOUBLE AS probability, event_id % 2 = 0 AS same_cluster, event_id % 5 = 0 AS cross_language, event_id % 11 = 0 AS token, (event_id % 9)::DOUBLE AS gap FROM events)
    SELECT event_id, round(CASE WHEN probability BETWEEN 0.35 AND 0.65 THEN 4.0 ELSE 0 END + CASE WHEN similarity BETWEEN 0.7 AND 0.92 THEN 2.5 ELSE 0 END + CASE WHEN cross_language THEN 2.5 ELSE 0 END + CASE WHEN token THEN 6.0 ELSE 0 END
        + CASE WHEN same_cluster AND probability < 0.45 OR NOT same_cluster AND probability >= 0.55 THEN 3.0 ELSE 0 END + greatest(0.0, 1.5 - 0.25 * gap), 6) AS score FROM p""")
def candidate_score(spark, sf_dir):
    """How much a reviewer's answer about a pair would tell, from its likeness, model score and conflicts."""
    e = table(spark, sf_dir, "events").select(
        "event_id", (F.col("value") / 100).alias("similarity"), (F.col("event_id") % 97 / 97.0).alias("probability"), (F.col("event_id") % 2 == 0).alias("same_cluster"),
        (F.col("event_id") % 5 == 0).alias("cross_language"), (F.col("event_id") % 11 == 0).alias("token"), (F.col("event_id") % 9).cast("double").alias("gap"),
    )
    part = lambda test, points: F.when(test, points).otherwise(0.0)
    p, same = F.col("probability"), F.col("same_cluster")
    score = part(p.between(0.35, 0.65), 4.0) + part(F.col("similarity").between(0.7, 0.92), 2.5) + part(F.col("cross_language"), 2.5) + part(F.col("token"), 6.0)
    score = score + part((same & (p < 0.45)) | (~same & (p >= 0.55)), 3.0) + F.greatest(F.lit(0.0), 1.5 - 0.25 * F.col("gap"))
    return e.select("event_id", F.round(score, 6).alias("score"))


@query("""WITH r AS (SELECT o_custkey AS release, o_orderdate::DATE AS period_end, o_orderkey FROM orders)
    SELECT release, o_orderkey, row_number() OVER (PARTITION BY release ORDER BY period_end, o_orderkey) AS revision, row_number() OVER (PARTITION BY release ORDER BY period_end DESC, o_orderkey DESC) = 1 AS current_ FROM r""")
def revisions(spark, sf_dir):
    """Rows of one release numbered in order, the last one current, all earlier ones kept."""
    key = Window.partitionBy("release")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("release"), "o_orderkey", F.to_date("o_orderdate").alias("day"))
    number = F.row_number().over(key.orderBy("day", "o_orderkey"))
    return rows.select("release", "o_orderkey", number.alias("revision"), (number == F.count(F.lit(1)).over(key)).alias("current_"))


@query("SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_suppkey)))[1:4], ',') AS first_suppliers, min(l_suppkey) AS head, count(DISTINCT l_suppkey) - 1 AS tail FROM lineitem GROUP BY 1")
def head_and_tail(spark, sf_dir):
    """Distinct suppliers of an order: the first four, the first, and how many follow."""
    sets = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_suppkey")).alias("s"))
    return sets.select("l_orderkey", F.array_join(F.slice("s", 1, 4), ",").alias("first_suppliers"), F.get("s", F.lit(0)).alias("head"), (F.size("s") - 1).cast("long").alias("tail"))


@query("""WITH s AS (SELECT conv_id, list_sort(list_distinct(list(role))) AS roles FROM conversations GROUP BY 1) SELECT a.conv_id AS a, b.conv_id AS b FROM s a JOIN s b ON b.conv_id = a.conv_id + 1 WHERE a.roles <> b.roles""")
def set_inequality(spark, sf_dir):
    """Neighbouring conversations whose sets of roles differ."""
    sets = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_set("role")).alias("roles"))
    a, b = sets.select(F.col("conv_id").alias("a"), F.col("roles").alias("x")), sets.select(F.col("conv_id").alias("b"), F.col("roles").alias("y"))
    return a.join(b, F.col("b") == F.col("a") + 1).filter(F.col("x") != F.col("y")).select("a", "b")


@query("""SELECT l_partkey, min(l_shipdate)::DATE AS first_day, max(l_shipdate)::DATE AS last_day, date_diff('day', min(l_shipdate)::DATE, max(l_shipdate)::DATE) AS span FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def observation_range(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.to_date(F.min("l_shipdate")).alias("first_day"), F.to_date(F.max("l_shipdate")).alias("last_day"), F.count(F.lit(1)).alias("n"))
    return rows.filter("n > 1").select("l_partkey", "first_day", "last_day", F.date_diff("last_day", "first_day").cast("long").alias("span"))
