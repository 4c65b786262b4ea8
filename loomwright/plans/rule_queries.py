"""Registered queries: changes of stored rows, gates, review joins, label rules, nested records and samples.

Roles of the driver's columns are those of queries.py; where a rule needs a field that no table has, it is made from keys.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwright.functions import dates, labels, text
from loomwright.operators.ranking import hash_order, top_per_key
from loomwright.operators.vectors import cohesion as cluster_cohesion
from loomwright.sources import tables
from loomwright.sources.tables import table

from .queries import UNITS_SQL, query, units


def count_if(test):
    return F.count(F.when(test, 1))


# Changes of stored rows


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_custkey % 10 = 0 THEN 'retired' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def conditional_update(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return tables.update_where(rows, (F.col("o_orderstatus") == "O") & (F.col("o_custkey") % 10 == 0), o_orderstatus=F.lit("retired")).drop("o_custkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%')")
def delete_by_key(spark, sf_dir):
    gone = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").startswith("1")).select(F.col("o_orderkey").alias("l_orderkey"))
    return tables.delete_keys(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), gone, ["l_orderkey"])


@query("""WITH new AS (SELECT o_custkey, o_orderkey, 'new' AS state FROM orders WHERE o_orderkey % 4 = 0)
    SELECT o_custkey, o_orderkey, 'old' AS state FROM orders WHERE o_orderkey % 4 <> 0 AND o_custkey NOT IN (SELECT o_custkey FROM new) UNION ALL SELECT * FROM new""")
def snapshot_replace(spark, sf_dir):
    """All rows of the customers in the new snapshot go, and the snapshot comes."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    fresh = F.col("o_orderkey") % 4 == 0
    return tables.keyed_replace(rows.filter(~fresh).withColumn("state", F.lit("old")), rows.filter(fresh).withColumn("state", F.lit("new")), ["o_custkey"])


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def newest_review(spark, sf_dir):
    """One review for each unit and reviewer: a later one replaces the earlier."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return top_per_key(rows, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("""WITH s AS (SELECT user_id, min(ts) AS started FROM events GROUP BY 1), e AS (SELECT user_id, arg_max(CASE event_type WHEN 'purchase' THEN 'success' ELSE 'failed' END, (ts, event_id)) AS status FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1)
    SELECT s.user_id, coalesce(status, 'running') AS status, strftime(started, '%Y%m%dT%H%M%SZ') AS started FROM s LEFT JOIN e ON s.user_id = e.user_id""")
def run_lifecycle(spark, sf_dir):
    """A run starts with its first entry and has the state of the last entry that ends it; without one it still runs."""
    e = table(spark, sf_dir, "events")
    final = F.when(F.col("event_type") == "purchase", "success").otherwise("failed")
    ends = e.filter(F.col("event_type").isin("purchase", "error")).groupBy("user_id").agg(F.max_by(final, F.struct("ts", "event_id")).alias("ended"))
    starts = e.groupBy("user_id").agg(F.min("ts").alias("ts"))
    return starts.join(ends, "user_id", "left").select("user_id", F.coalesce("ended", F.lit("running")).alias("status"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("started"))


@query("""WITH o AS (SELECT p_brand, p_type, min(p_size) AS revision, 'old' AS notes FROM part WHERE p_partkey % 2 = 0 GROUP BY 1, 2), n AS (SELECT p_brand, p_type, max(p_size) AS revision, CASE WHEN p_brand LIKE '%1' THEN NULL ELSE 'new' END AS notes FROM part WHERE p_partkey % 3 = 0 GROUP BY 1, 2)
    SELECT coalesce(o.p_brand, n.p_brand) AS p_brand, coalesce(o.p_type, n.p_type) AS p_type, CASE WHEN n.p_brand IS NULL THEN o.revision ELSE n.revision END AS revision, CASE WHEN n.p_brand IS NULL THEN o.notes ELSE n.notes END AS notes FROM o FULL JOIN n ON o.p_brand = n.p_brand AND o.p_type = n.p_type""")
def model_registry(spark, sf_dir):
    """Registered models by two keys; a registration replaces an earlier one, its nulls too."""
    part, keys = table(spark, sf_dir, "part"), ["p_brand", "p_type"]
    old = part.filter("p_partkey % 2 = 0").groupBy(*keys).agg(F.min("p_size").alias("revision")).withColumn("notes", F.lit("old"))
    new = part.filter("p_partkey % 3 = 0").groupBy(*keys).agg(F.max("p_size").alias("revision")).withColumn("notes", F.when(~F.col("p_brand").endswith("1"), "new"))
    return tables.merge_upsert(old, new.select(*keys, "notes", "revision"), keys)


# Dates and text rules


@query("""WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN 'soon' WHEN 2 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS published, ts - INTERVAL 3 DAY AS seen FROM events)
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN (try_cast(replace(published, 'Z', '') AS TIMESTAMP) + INTERVAL 1 HOUR)::DATE WHEN 3 THEN published::DATE ELSE (date_trunc('second', seen) + INTERVAL 1 HOUR)::DATE END AS day FROM t""")
def article_date(spark, sf_dir):
    """The day in Amsterdam of the first of two texts that is a time; what is none is passed over."""
    ts = F.col("ts")
    made = F.when(F.col("event_id") % 4 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 4 == 1, "soon").when(F.col("event_id") % 4 == 2, "").otherwise(F.date_format(ts, "yyyy-MM-dd"))
    seen = F.date_format(ts - F.expr("INTERVAL 3 DAYS"), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select("event_id", dates.first_day(made, seen).alias("day"))


@query("""WITH v AS (SELECT c_custkey, unnest([substring(c_mktsegment, 1, 3), 'n-l d', c_name, upper(substring(c_mktsegment, 1, 3)), 'Usa']) AS v, unnest([0, 1, 2, 3, 4]) AS pos FROM customer),
    c AS (SELECT c_custkey, upper(regexp_replace(v, '[^A-Za-z]', '', 'g')) AS code, min(pos) AS pos FROM v GROUP BY 1, 2)
    SELECT c_custkey, string_agg(code, ',' ORDER BY pos) AS codes FROM c WHERE length(code) = 3 GROUP BY 1""")
def country_codes(spark, sf_dir):
    segment = F.substring("c_mktsegment", 1, 3)
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(text.clean_codes(F.array(segment, F.lit("n-l d"), "c_name", F.upper(segment), F.lit("Usa"))), ",").alias("codes"))


@query("""WITH c AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'high' ELSE (value / 100)::VARCHAR END AS raw FROM events), n AS (SELECT *, try_cast(raw AS DOUBLE) AS x FROM c)
    SELECT event_id, CASE WHEN x BETWEEN 0 AND 1 THEN round(x, 4) END AS confidence, CASE WHEN raw IS NULL THEN 'missing' WHEN x IS NULL THEN 'not a number' WHEN NOT x BETWEEN 0 AND 1 THEN 'out of range' END AS fault FROM n""")
def confidence_check(spark, sf_dir):
    """Confidences outside 0 to 1, missing ones and words are set aside with a reason."""
    raw = F.when(F.col("event_id") % 9 == 0, None).when(F.col("event_id") % 7 == 0, "high").otherwise((F.col("value") / 100).cast("string"))
    good, fault = labels.confidence(raw)
    return table(spark, sf_dir, "events").select("event_id", F.round(good, 4).alias("confidence"), fault.alias("fault"))


@query("""SELECT page_id, concat_ws(' | ', nullif(trim(regexp_extract(url, '^[a-z]+://([^/]*)', 1)), ''), nullif(CASE WHEN page_id % 2 = 0 THEN ' ' ELSE 'odd' END, ' '), page_id::VARCHAR) AS shown FROM pages""")
def display_text(spark, sf_dir):
    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", text.display(host, F.when(F.col("page_id") % 2 == 0, " ").otherwise("odd"), F.col("page_id").cast("string")).alias("shown"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Human-audited public release' WHEN 'P' THEN 'Human-governed release; audit exception disclosed' ELSE 'Model-coded, human-governed pilot release' END AS label FROM orders""")
def governance_label(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "P", "waived_with_disclosure").otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.governance(status).alias("label"))


# Aggregates


@query(f"""WITH {UNITS_SQL} SELECT country, count(*) AS total, count(*) FILTER (WHERE ai_relevant) AS relevant, count(*) FILTER (WHERE ai_relevant AND score IS NOT NULL) AS scored, count(*) FILTER (WHERE ai_relevant AND score IS NULL) AS excluded,
    count(*) FILTER (WHERE NOT ai_relevant) AS not_relevant, count(*) FILTER (WHERE status = 'unclear') AS review, count(*) FILTER (WHERE event_id % 50 = 0) AS audit, round(avg(value_ / 500) FILTER (WHERE ai_relevant), 4) AS mean_confidence
    FROM (SELECT s.*, e.value AS value_ FROM scored s JOIN events e ON s.event_id = e.event_id) GROUP BY 1""")
def conditional_counts(spark, sf_dir):
    """Units by what became of them, and the mean confidence of the relevant ones."""
    relevant, scored = F.col("ai_relevant"), F.col("score").isNotNull()
    rows = units(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", "value"), "event_id")
    return rows.groupBy("country").agg(
        F.count(F.lit(1)).alias("total"), count_if(relevant).alias("relevant"), count_if(relevant & scored).alias("scored"), count_if(relevant & ~scored).alias("excluded"), count_if(~relevant).alias("not_relevant"),
        count_if(F.col("status") == "unclear").alias("review"), count_if(F.col("event_id") % 50 == 0).alias("audit"), F.round(F.avg(F.when(relevant, F.col("value") / 500)), 4).alias("mean_confidence"),
    )


@query("SELECT count(DISTINCT user_id) AS high, greatest(0, count(DISTINCT user_id) - count(DISTINCT user_id) FILTER (WHERE event_type = 'error')) AS low FROM events")
def distinct_range(spark, sf_dir):
    """Between how many and how many different events there are, if all suspected duplicates are some."""
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.bool_or(F.col("event_type") == "error").alias("suspect"))
    return users.agg(F.count(F.lit(1)).alias("high"), count_if(F.col("suspect")).alias("twice")).select("high", F.greatest(F.lit(0), F.col("high") - F.col("twice")).alias("low"))


@query("""WITH e AS (SELECT vec_id, CASE WHEN vec_id % 50 = 7 THEN -vec_id ELSE vec_id // 8 END AS cluster, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT a.cluster, round(list_inner_product(a.v, b.v), 6) AS s FROM e a JOIN e b ON a.cluster = b.cluster AND a.vec_id < b.vec_id)
    SELECT c.cluster, members, first_day, last_day, coalesce(pairs, 0) AS pairs, mean_similarity, least_similarity
    FROM (SELECT cluster, count(*) AS members, min(vec_id % 7) AS first_day, max(vec_id % 7) AS last_day FROM e GROUP BY 1) c
    LEFT JOIN (SELECT cluster, count(*) AS pairs, round(avg(s), 4) AS mean_similarity, round(min(s), 4) AS least_similarity FROM p GROUP BY 1) x ON c.cluster = x.cluster""")
def cohesion(spark, sf_dir):
    """Members, span of days, mean and smallest similarity of clusters; a cluster of one has a span but no similarity."""
    cluster = F.when(F.col("vec_id") % 50 == 7, -F.col("vec_id")).otherwise(F.floor(F.col("vec_id") / 8))
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), (F.col("vec_id") % 7).alias("day"), cluster.alias("cluster"), F.col("embedding").alias("vector"))
    return cluster_cohesion(e, "cluster")


@query("""WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS k FROM events) SELECT user_id, max(value) AS best, round(avg(value), 4) AS mean_of_top FROM r WHERE k <= 3 GROUP BY 1""")
def top_three_scores(spark, sf_dir):
    best = top_per_key(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], [F.desc("value"), F.col("event_id")], 3)
    return best.groupBy("user_id").agg(F.max("value").alias("best"), F.round(F.avg("value"), 4).alias("mean_of_top"))


@query("""WITH p AS (SELECT CASE WHEN toxic = 1 THEN 'not_same' WHEN quality = 1 THEN 'same' ELSE 'unclear' END AS gold, CASE WHEN doc_id % 5 = 0 THEN 'unclear' WHEN quality = 1 THEN 'same' ELSE 'not_same' END AS said FROM labels),
    c AS (SELECT count(*) AS n, count(*) FILTER (WHERE gold = said) AS hit, count(*) FILTER (WHERE said <> 'unclear') AS decided, count(*) FILTER (WHERE said = 'same' AND gold = 'same') AS tp, count(*) FILTER (WHERE said = 'same' AND gold <> 'same') AS fp, count(*) FILTER (WHERE said = 'not_same' AND gold = 'same') AS fn FROM p)
    SELECT n, round(hit / n, 4) AS accuracy, round(decided / n, 4) AS coverage, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 4) AS precision_, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 4) AS recall, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 4) AS f1 FROM c""")
def three_class_metrics(spark, sf_dir):
    """Accuracy over three answers, the share decided, and precision, recall and F1 of the decided ones."""
    gold = F.when(F.col("toxic") == 1, "not_same").when(F.col("quality") == 1, "same").otherwise("unclear")
    said = F.when(F.col("doc_id") % 5 == 0, "unclear").when(F.col("quality") == 1, "same").otherwise("not_same")
    c = table(spark, sf_dir, "labels").select(gold.alias("g"), said.alias("s")).agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("g") == F.col("s")).alias("hit"), count_if(F.col("s") != "unclear").alias("decided"), count_if((F.col("s") == "same") & (F.col("g") == "same")).alias("tp"),
        count_if((F.col("s") == "same") & (F.col("g") != "same")).alias("fp"), count_if((F.col("s") == "not_same") & (F.col("g") == "same")).alias("fn"),
    )
    part = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 4)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select("n", part(F.col("hit"), F.col("n")).alias("accuracy"), part(F.col("decided"), F.col("n")).alias("coverage"), part(tp, tp + fp).alias("precision_"), part(tp, tp + fn).alias("recall"), part(2 * tp, 2 * tp + fp + fn).alias("f1"))


@query("SELECT user_id, count(*) AS processed, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'view') AS review, count(*) FILTER (WHERE event_type NOT IN ('error', 'view')) AS done FROM events GROUP BY 1")
def run_counters(spark, sf_dir):
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("processed"), count_if(kind == "error").alias("failed"), count_if(kind == "view").alias("review"), count_if(~kind.isin("error", "view")).alias("done"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE quality = 1) AS accepted, count(*) FILTER (WHERE quality = 0) AS needs_correction, count(*) = count(*) FILTER (WHERE quality = 1) + count(*) FILTER (WHERE quality = 0) AND count(DISTINCT doc_id) = count(*) AS passed FROM labels")
def audit_counts(spark, sf_dir):
    """Rows of an audit by verdict; each must have one, and each unit one row."""
    c = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), count_if(F.col("quality") == 1).alias("a"), count_if(F.col("quality") == 0).alias("c"))
    out = c.agg(F.sum("n").alias("total"), F.sum("a").alias("accepted"), F.sum("c").alias("needs_correction"), F.max("n").alias("most"))
    return out.select("total", "accepted", "needs_correction", ((F.col("total") == F.col("accepted") + F.col("needs_correction")) & (F.col("most") == 1)).alias("passed"))


# Joins of review data


@query("""WITH g AS (SELECT doc_id AS a, doc_id + 1 AS b, toxic FROM labels) SELECT g.a, g.b, CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS gold, coalesce(x.lang, 'und') AS lang_a, coalesce(y.lang, 'und') AS lang_b, coalesce(nullif(substring(y.text, 1, 40), ''), 'no text') AS text_b FROM g LEFT JOIN documents x ON g.a = x.doc_id LEFT JOIN documents y ON g.b = y.doc_id""")
def gold_pairs(spark, sf_dir):
    """Labelled pairs with both sides' documents, and a default where a side is missing or blank."""
    docs = table(spark, sf_dir, "documents")
    g = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("a"), (F.col("doc_id") + 1).alias("b"), labels.binary("toxic").alias("gold"))
    x, y = docs.select(F.col("doc_id").alias("a"), F.col("lang").alias("x")), docs.select(F.col("doc_id").alias("b"), F.col("lang").alias("y"), F.substring("text", 1, 40).alias("t"))
    return g.join(x, "a", "left").join(y, "b", "left").select("a", "b", "gold", F.coalesce("x", F.lit("und")).alias("lang_a"), F.coalesce("y", F.lit("und")).alias("lang_b"), F.coalesce(F.nullif("t", F.lit("")), F.lit("no text")).alias("text_b"))


@query("SELECT o.o_orderkey, o.o_orderstatus, e.event_type AS decision FROM orders o JOIN events e ON o.o_orderkey = e.event_id WHERE e.event_type IN ('purchase', 'error') AND o.o_orderstatus = 'O'")
def decided_reviews(spark, sf_dir):
    """Open rows for which a reviewer has decided."""
    decisions = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "error")).select(F.col("event_id").alias("o_orderkey"), F.col("event_type").alias("decision"))
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus").join(decisions, "o_orderkey")


@query("SELECT l_partkey, arg_max(l_orderkey, (l_shipdate, l_orderkey)) AS event FROM lineitem GROUP BY 1")
def last_link(spark, sf_dir):
    """Of several links of an article, the newest counts."""
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.max_by("l_orderkey", F.struct("l_shipdate", "l_orderkey")).alias("event"))


@query("SELECT o_custkey, count(DISTINCT l_suppkey) AS known FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1")
def known_events(spark, sf_dir):
    """How many events a cluster's articles are already in."""
    closed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    return closed.join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey"), "o_orderkey").groupBy("o_custkey").agg(F.countDistinct("l_suppkey").alias("known"))


@query("SELECT l.doc_id, d.source AS assigned, CASE WHEN d.source IS NULL THEN 'new' ELSE 'existing_assignment' END AS decision FROM labels l LEFT JOIN (SELECT * FROM documents WHERE n_chars > 500) d ON l.doc_id = d.doc_id")
def existing_assignment(spark, sf_dir):
    """Units that already have an active assignment keep it; processing again changes nothing."""
    active = table(spark, sf_dir, "documents").filter("n_chars > 500").select("doc_id", F.col("source").alias("assigned"))
    return table(spark, sf_dir, "labels").select("doc_id").join(active, "doc_id", "left").withColumn("decision", F.when(F.col("assigned").isNull(), "new").otherwise("existing_assignment"))


@query("""WITH p AS (SELECT least(l_orderkey, l_partkey) || '__' || greatest(l_orderkey, l_partkey) AS pair FROM lineitem WHERE l_linenumber = 1), known AS (SELECT least(l_orderkey, l_partkey) || '__' || greatest(l_orderkey, l_partkey) AS pair FROM lineitem WHERE l_linenumber = 2)
    SELECT DISTINCT pair, string_split(pair, '__')[1] AS first, string_split(pair, '__')[2] AS second FROM p WHERE pair NOT IN (SELECT pair FROM known)""")
def unlabelled_pairs(spark, sf_dir):
    """Pairs, whatever their order, without those that have a label."""
    rows = table(spark, sf_dir, "lineitem").select("l_linenumber", text.pair_id(F.col("l_orderkey"), F.col("l_partkey")).alias("pair"))
    new = rows.filter("l_linenumber = 1").select("pair").distinct().join(rows.filter("l_linenumber = 2").select("pair"), "pair", "left_anti")
    return new.select("pair", *[part.alias(name) for part, name in zip(text.pair_members(F.col("pair")), ("first", "second"), strict=True)])


# Records and nested data


@query("SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'za' WHEN 1 THEN 'us' WHEN 2 THEN 'in' ELSE 'us' END AS gl, CASE n_regionkey WHEN 2 THEN 'hi' ELSE 'en' END AS hl FROM nation")
def market_codes(spark, sf_dir):
    """Codes of a market by lookup, with a default."""
    gl, hl = (F.create_map(*[F.lit(x) for pair in m.items() for x in pair]) for m in ({0: "za", 1: "us", 2: "in"}, {2: "hi"}))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.coalesce(gl[F.col("n_regionkey")], F.lit("us")).alias("gl"), F.coalesce(hl[F.col("n_regionkey")], F.lit("en")).alias("hl"))


@query("""SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey || ':' || l_returnflag, ' ' ORDER BY l_linenumber, l_partkey, l_returnflag) AS evidence FROM lineitem GROUP BY 1""")
def evidence(spark, sf_dir):
    """The fields of each piece of evidence of an event, in order."""
    one = F.struct("l_linenumber", "l_partkey", "l_returnflag")
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(one)).alias("x"))
    return lists.select("l_orderkey", F.array_join(F.transform("x", lambda e: F.concat_ws(":", e["l_linenumber"], e["l_partkey"], e["l_returnflag"])), " ").alias("evidence"))


@query("""WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS roles, string_agg(lower(text), ' ' ORDER BY turn) AS words FROM conversations GROUP BY 1) SELECT conv_id, len(roles) AS turns FROM c WHERE contains(words, 'the') AND list_contains(roles, 'system')""")
def facet_filter(spark, sf_dir):
    """Groups that hold a word in any part and a facet in their list."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"), F.bool_or(F.contains(F.lower("text"), F.lit("the"))).alias("found"), F.count(F.lit(1)).alias("turns"))
    return c.filter(F.col("found") & F.array_contains("roles", "system")).select("conv_id", "turns")


@query("SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place, role, length(text) AS n FROM conversations")
def flattened(spark, sf_dir):
    """Nested items in order of appearance, each with its place."""
    nested = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.length("text").alias("n")))).alias("items"))
    return nested.select("conv_id", F.posexplode("items").alias("place", "x")).select("conv_id", (F.col("place") + 1).cast("long").alias("place"), "x.role", F.col("x.n").cast("long").alias("n"))


@query("""WITH g AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM lineitem) SELECT l_partkey, l_suppkey, l_orderkey FROM g QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1""")
def story_groups(spark, sf_dir):
    """Stories of all groups, each once where it comes first; of those at one place, that of the smallest supplier."""
    groups = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("stories"))
    return top_per_key(groups.select("l_orderkey", F.explode("stories").alias("s")).select("l_orderkey", "s.*"), ["l_partkey"], [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]).select("l_partkey", "l_suppkey", "l_orderkey")


@query("""WITH s AS (SELECT l_partkey, l_returnflag AS iso, l_linestatus AS lang, l_linenumber FROM lineitem) SELECT l_partkey, count(*) AS searches, string_agg(iso || lang, ' ' ORDER BY iso || lang) AS markets FROM (SELECT DISTINCT l_partkey, iso, lang FROM s) GROUP BY 1""")
def merged_searches(spark, sf_dir):
    """Searches that found a record, each market and language once."""
    sets = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.collect_set(F.concat("l_returnflag", "l_linestatus")).alias("m"))
    return sets.select("l_partkey", F.size("m").cast("long").alias("searches"), F.array_join(F.sort_array("m"), " ").alias("markets"))


@query("""WITH f AS (SELECT o_custkey, o_orderpriority AS p, min(o_orderkey) AS place FROM orders GROUP BY 1, 2) SELECT o_custkey, string_agg(p, ',' ORDER BY place) AS priorities FROM f GROUP BY 1""")
def ordered_unique(spark, sf_dir):
    """Distinct values in the order in which they first occur."""
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("x"))
    return lists.select("o_custkey", F.array_join(F.array_distinct(F.col("x.o_orderpriority")), ",").alias("priorities"))


# Samples


@query("""WITH s AS (SELECT l.doc_id, quality, toxic, sha256(l.doc_id::VARCHAR) AS h FROM labels l), r AS (SELECT *, row_number() OVER (PARTITION BY quality, toxic ORDER BY h) AS k FROM s) SELECT doc_id FROM r ORDER BY CASE WHEN k <= 2 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END, h LIMIT 20""")
def sequential_fill(spark, sf_dir):
    """Two of each stratum, then those with a mark, then others, until 20 are chosen."""
    rows = table(spark, sf_dir, "labels").withColumn("h", hash_order("doc_id"))
    first = top_per_key(rows, ["quality", "toxic"], [F.col("h")], 2).select("doc_id", F.lit(0).alias("turn"))
    rest = rows.join(first, "doc_id", "left_anti").select("doc_id", F.when(F.col("toxic") == 1, 1).otherwise(2).alias("turn"))
    return first.unionByName(rest).orderBy("turn", hash_order("doc_id")).limit(20).select("doc_id")


@query("SELECT event_id, k FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS k FROM events) ORDER BY coalesce(k, '') DESC, event_id LIMIT 50")
def empty_last(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("k"))
    return rows.orderBy(F.desc(F.coalesce("k", F.lit(""))), "event_id").limit(50)


@query("""SELECT doc_id, lang, CASE sha256('blind' || doc_id) < '8' WHEN true THEN 'A' ELSE 'B' END AS side FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256('42:' || doc_id)) <= 12""")
def seeded_sample(spark, sf_dir):
    """Twelve rows of each language by a seeded hash, and which side each is shown on."""
    rows = top_per_key(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], [F.sha2(F.concat(F.lit("42:"), "doc_id"), 256)], 12)
    return rows.withColumn("side", F.when(F.sha2(F.concat(F.lit("blind"), "doc_id"), 256) < "8", "A").otherwise("B"))


# Gates


@query(f"""WITH {UNITS_SQL}, e AS (SELECT user_id, bool_or(ai_relevant AND event_id % 3 <> 0) AS event_relevant FROM scored GROUP BY 1) SELECT count(*) AS violations, count(*) = 0 AS passed FROM scored s JOIN e ON s.user_id = e.user_id WHERE s.ai_relevant AND NOT e.event_relevant""")
def relevance_gate(spark, sf_dir):
    """No relevant unit may belong to an event that isn't."""
    u = units(spark, sf_dir)
    events = u.groupBy("user_id").agg(F.bool_or(F.col("ai_relevant") & (F.col("event_id") % 3 != 0)).alias("event_relevant"))
    return u.filter("ai_relevant").join(events.filter("NOT event_relevant"), "user_id").agg(F.count(F.lit(1)).alias("violations")).withColumn("passed", F.col("violations") == 0)


@query("SELECT count(*) AS pending, count(*) = 0 AS passed FROM orders WHERE o_orderstatus = 'P'")
def pending_gate(spark, sf_dir):
    """Classification waits until no review is pending."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").agg(F.count(F.lit(1)).alias("pending")).withColumn("passed", F.col("pending") == 0)


@query(f"WITH {UNITS_SQL}, f AS (SELECT * FROM scored ORDER BY event_id LIMIT 8) SELECT bool_and(status = 'unclear' AND degree = 0) AS collapsed FROM f")
def collapse_gate(spark, sf_dir):
    """Have the first eight labels all fallen to the defaults?"""
    return units(spark, sf_dir).orderBy("event_id").limit(8).agg(F.bool_and((F.col("status") == "unclear") & (F.col("degree") == 0)).alias("collapsed"))


@query("SELECT o_custkey, CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') = count(*) THEN 'success' WHEN count(*) FILTER (WHERE o_orderstatus = 'F') = 0 THEN 'failed' ELSE 'partial' END AS status FROM orders GROUP BY 1")
def run_status(spark, sf_dir):
    """A run of several searches succeeded, failed, or did so in part."""
    c = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), count_if(F.col("o_orderstatus") == "F").alias("good"))
    return c.select("o_custkey", F.when(F.col("good") == F.col("n"), "success").when(F.col("good") == 0, "failed").otherwise("partial").alias("status"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'no start' WHEN event_id % 7 = 0 THEN 'ends before it starts' WHEN date_trunc('week', ts)::DATE <> ts::DATE THEN 'does not start on Monday' END AS fault FROM events""")
def period_check(spark, sf_dir):
    """Faults of a period's bounds."""
    day = F.to_date("ts")
    start, end = F.when(F.col("event_id") % 5 != 0, day), F.when(F.col("event_id") % 7 == 0, F.date_sub(day, 1)).otherwise(F.date_add(day, 6))
    return table(spark, sf_dir, "events").select("event_id", dates.period_fault(start, end).alias("fault"))


@query("""SELECT count(*) > 0 AS observations, count(*) FILTER (WHERE trim(coalesce(text, '')) <> '') > 0 AS texts, count(DISTINCT source) > 1 AS sources FROM documents""")
def presence_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.agg((F.count(F.lit(1)) > 0).alias("observations"), (count_if(F.trim(F.coalesce("text", F.lit(""))) != "") > 0).alias("texts"), (F.min("source") < F.max("source")).alias("sources"))
