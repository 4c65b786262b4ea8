"""Queries of headlines and their renderings, pairs for review, sources and releases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.functions import text, translation
from loomwright.operators import vectors
from loomwright.operators.ranking import hash_order, top_per_key
from loomwright.plans.queries import query
from loomwright.sources.tables import table

HAN_SQL = r"'[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]'"


@query(rf"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '大' || coalesce(text, '') ELSE coalesce(text, '') END AS head, CASE WHEN doc_id % 17 = 0 THEN 'und' ELSE lang END AS lang, (doc_id % 100) / 100.0::DOUBLE AS conf,
        CASE WHEN doc_id % 3 = 0 THEN 'fr' WHEN doc_id % 3 = 1 AND doc_id % 4 <> 0 THEN lang END AS hint FROM documents), m AS (
    SELECT *, CASE WHEN regexp_matches(head, {HAN_SQL}) THEN 'han_script+lingua' WHEN hint = lang THEN 'lingua+search_language' WHEN conf >= 0.65 THEN 'lingua' WHEN hint IS NOT NULL THEN 'search_language_override' ELSE 'unsure' END AS how FROM d)
    SELECT doc_id, CASE how WHEN 'han_script+lingua' THEN 'zh' WHEN 'search_language_override' THEN hint WHEN 'unsure' THEN CASE WHEN length(lang) = 2 THEN lang ELSE 'un' END ELSE lang END AS language, CASE how WHEN 'unsure' THEN 'lingua' ELSE how END AS method,
        how IN ('search_language_override', 'unsure') AS requires_review, CASE how WHEN 'unsure' THEN 'uncertain source language' WHEN 'search_language_override' THEN 'low-confidence ''' || lang || ''' overridden by ''' || hint || '''' ELSE '' END AS reason FROM m""")
def resolved_language(spark, sf_dir):
    """Language of a headline from its script, a detector's answer and all languages it was searched in; what is unsure is reviewed."""
    i, lang = F.col("doc_id"), F.when(F.col("doc_id") % 17 == 0, "und").otherwise(F.col("lang"))
    head = F.when(i % 13 == 0, F.concat(F.lit("大"), F.coalesce("text", F.lit("")))).otherwise(F.coalesce("text", F.lit("")))
    searched = F.when(i % 3 == 0, F.array(F.lit("FR-ca"), F.lit("fr"), F.lit(""))).when(i % 3 == 1, F.when(i % 4 == 0, F.array(F.lit("zh-CN"), F.lit("en"))).otherwise(F.array("lang", F.concat("lang", F.lit("-x")))))
    found = translation.language_of(head, lang, i % 100 / 100.0, searched)
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("x")).select("doc_id", "x.*")


@query(rf"""WITH d AS (SELECT doc_id, (doc_id % 50) / 50.0::DOUBLE AS similarity, 'a ' || n_chars || ' b' AS first, CASE WHEN doc_id % 4 = 0 THEN 'a ' || n_chars || ',5 b' WHEN doc_id % 7 = 0 THEN ' 中' || n_chars ELSE 'c ' || n_chars END AS second, CASE WHEN doc_id % 7 = 0 THEN '中' || n_chars ELSE '中' END AS original FROM documents)
    SELECT doc_id, concat_ws('; ', CASE WHEN similarity < 0.86 THEN 'cross-model semantic disagreement' END, CASE WHEN doc_id % 4 = 0 THEN 'cross-model numeric disagreement' END, CASE WHEN regexp_matches(second, {HAN_SQL}) THEN 'Han characters remain in audit translation' END,
        CASE WHEN trim(second) = original THEN 'audit translation identical to Chinese source' END) AS faults, CASE WHEN similarity >= 0.86 AND doc_id % 4 <> 0 AND NOT regexp_matches(second, {HAN_SQL}) THEN 'agree' ELSE 'review' END AS status FROM d""")
def translation_audit(spark, sf_dir):
    """Whether a second model's rendering agrees with the first one's, and why not."""
    i, n = F.col("doc_id"), F.col("n_chars").cast("string")
    han = F.concat(F.lit("中"), n)
    second = F.when(i % 4 == 0, F.concat(F.lit("a "), n, F.lit(",5 b"))).when(i % 7 == 0, F.concat(F.lit(" "), han)).otherwise(F.concat(F.lit("c "), n))
    faults = translation.audit_faults(i % 50 / 50.0, F.concat(F.lit("a "), n, F.lit(" b")), second, F.when(i % 7 == 0, han).otherwise("中"))
    rows = table(spark, sf_dir, "documents").select("doc_id", faults.alias("f"))
    return rows.select("doc_id", F.array_join("f", "; ").alias("faults"), F.when(F.size("f") == 0, "agree").otherwise("review").alias("status"))


@query(r"""WITH d AS (SELECT doc_id, lang, 'x ' || n_chars || ' y ' || (n_chars // 7) AS original, CASE doc_id % 6 WHEN 0 THEN ' ' WHEN 1 THEN 'x ' || n_chars || ' y ' || (n_chars // 7) || ' ' WHEN 2 THEN n_chars || ' 漢' WHEN 3 THEN 'x ' || n_chars ELSE 'z ' || n_chars || ', ' || (n_chars // 7) END AS english FROM documents)
    SELECT doc_id, concat_ws('; ', CASE WHEN trim(english) = '' THEN 'empty translation' END, CASE WHEN lang <> 'en' AND trim(english) = trim(original) THEN 'translation identical to non-English source' END, CASE WHEN contains(english, '漢') THEN 'Han characters remain in English normalization' END,
        'numeric information not preserved: ' || nullif(concat_ws(', ', CASE WHEN NOT contains(english, n_chars::VARCHAR) THEN n_chars::VARCHAR END, CASE WHEN NOT contains(english, (n_chars // 7)::VARCHAR) THEN (n_chars // 7)::VARCHAR END), '')) AS faults
    FROM d JOIN (SELECT doc_id, n_chars FROM documents) USING (doc_id)""")
def rendering_faults(spark, sf_dir):
    """Why an English rendering needs review: empty, the source itself, other script, numbers missing."""
    n, seventh = F.col("n_chars").cast("string"), F.floor(F.col("n_chars") / 7).cast("string")
    original, k = F.concat(F.lit("x "), n, F.lit(" y "), seventh), F.col("doc_id") % 6
    english = F.when(k == 0, " ").when(k == 1, F.concat(original, F.lit(" "))).when(k == 2, F.concat(n, F.lit(" 漢"))).when(k == 3, F.concat(F.lit("x "), n)).otherwise(F.concat(F.lit("z "), n, F.lit(", "), seventh))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(translation.rendering_faults(F.col("lang"), original, english), "; ").alias("faults"))


PAIRS_SQL = """p AS (SELECT event_id, (event_id * 37 % 100) / 100.0::DOUBLE AS similarity, (event_id % 97) / 97.0::DOUBLE AS probability, CASE event_id % 3 WHEN 0 THEN 'same_event' WHEN 1 THEN 'not_same_event' ELSE 'unclear' END AS verdict, event_id % 2 = 0 AS same_cluster,
    event_id % 5 = 0 AS cross_language, event_id % 11 = 0 AS token, (event_id * 29 % 40 + 60) / 100.0::DOUBLE AS confidence FROM events)"""


def review_pairs(spark, sf_dir):
    i = F.col("event_id")
    verdict = F.when(i % 3 == 0, "same_event").when(i % 3 == 1, "not_same_event").otherwise("unclear")
    return table(spark, sf_dir, "events").select(
        "event_id", (i * 37 % 100 / 100.0).alias("similarity"), (i % 97 / 97.0).alias("probability"), verdict.alias("verdict"), (i % 2 == 0).alias("same_cluster"),
        (i % 5 == 0).alias("cross_language"), (i % 11 == 0).alias("token"), ((i * 29 % 40 + 60) / 100.0).alias("confidence"),
    )


@query(f"""WITH {PAIRS_SQL}, q AS (SELECT *, probability >= 0.45 AS m FROM p), r AS (SELECT *, verdict = 'unclear' OR (verdict = 'same_event') <> m AS disagree, similarity >= 0.78 AND (NOT m OR verdict = 'not_same_event') AS against, similarity < 0.78 AND (m OR verdict = 'same_event') AS despite,
        CASE WHEN same_cluster THEN NOT m AND verdict <> 'same_event' ELSE m AND verdict = 'same_event' END AS conflict FROM q)
    SELECT event_id, CASE WHEN verdict = 'unclear' THEN 6.0 WHEN disagree THEN 7.0 ELSE 0.0 END::DOUBLE + CASE WHEN against THEN 4 ELSE 0 END + CASE WHEN despite THEN 4 ELSE 0 END + CASE WHEN conflict THEN 5 ELSE 0 END AS score,
        concat_ws(' ', CASE WHEN conflict THEN 'cluster_conflict' END, CASE WHEN cross_language THEN 'cross_language' END, CASE WHEN against THEN 'high_similarity_not_same' END, CASE WHEN despite THEN 'low_similarity_same' END, CASE WHEN disagree THEN 'model_disagreement' END, CASE WHEN token THEN 'story_token_match' END) AS reasons FROM r""")
def information_score(spark, sf_dir):
    """What a reviewer's answer would tell once both models have spoken, with the reasons."""
    found = translation.information(F.lit(0.0), *[F.col(c) for c in ("similarity", "probability", "verdict", "same_cluster", "cross_language", "token")])
    return review_pairs(spark, sf_dir).select("event_id", found.alias("x")).select("event_id", "x.score", F.array_join("x.reasons", " ").alias("reasons"))


@query(f"""WITH {PAIRS_SQL} SELECT event_id, verdict, similarity FROM p ORDER BY CASE WHEN probability >= 0.45 AND verdict = 'same_event' THEN 0 ELSE 1 END, CASE WHEN cross_language THEN 0 ELSE 1 END, CASE WHEN similarity < 0.78 THEN 0 ELSE 1 END, confidence DESC, probability DESC, similarity, event_id LIMIT 75""")
def selection_priority(spark, sf_dir):
    """The 75 pairs to look at first: agreed positives, those across languages and of low similarity before others."""
    order = translation.positives_first("probability", "verdict", "cross_language", "similarity", "confidence", "event_id")
    return review_pairs(spark, sf_dir).orderBy(*order).limit(75).select("event_id", "verdict", "similarity")


@query("""WITH y AS (SELECT year(o_orderdate) AS y, count(*) AS n, count(DISTINCT o_custkey) AS c, round(avg(o_totalprice) / 1e6, 6) AS idx FROM orders GROUP BY 1)
    SELECT 'r' || y AS release_id, 'yearly' AS release_type, y || '-01-01' AS period_start, y || '-12-31' AS period_end, NULL::VARCHAR AS generated_at, n AS articles, c AS event_records, CASE WHEN y % 2 = 0 THEN n - c ELSE 0 END AS new_event_records, 0 AS recurring_event_records, 0 AS extra_coverage,
        idx AS coverage_index, NULL::DOUBLE AS event_index, CASE WHEN y % 3 <> 0 THEN idx END AS amplification_gap, CASE WHEN y % 3 = 0 THEN 'complete' END AS audit_status, NULL::VARCHAR AS validation_status FROM y""")
def release_summaries(spark, sf_dir):
    """Flat rows of nested releases; missing counts are zero, other missing fields null."""
    y = F.col("y")
    counts = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("c"), F.round(F.avg("o_totalprice") / 1e6, 6).alias("idx"))
    inner = [
        F.concat(F.lit("r"), y).alias("release_id"), F.lit("yearly").alias("release_type"), F.concat(y, F.lit("-01-01")).alias("period_start"), F.concat(y, F.lit("-12-31")).alias("period_end"),
        F.struct(F.col("n").alias("ai_relevant_articles"), F.col("c").alias("ai_relevant_event_records"), F.when(y % 2 == 0, F.col("n") - F.col("c")).alias("new_event_records")).alias("counts"),
        F.struct(F.struct(F.col("idx").alias("empowerment_index")).alias("coverage")).alias("lenses"), F.when(y % 3 != 0, F.struct(F.col("idx").alias("directional_gap"))).alias("amplification"),
        F.when(y % 3 == 0, F.struct(F.struct(F.lit("complete").alias("audit_status")).alias("governance"))).alias("reliability"),
    ]
    releases = counts.select(F.parse_json(F.to_json(F.struct(*inner))).alias("release"))
    return releases.select(*translation.release_summary(F.col("release")))


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN event_type || ' x' WHEN 1 THEN event_type WHEN 2 THEN 'T ' || user_id WHEN 3 THEN '' WHEN 4 THEN '' ELSE user_id::VARCHAR END AS name FROM events""")
def source_names(spark, sf_dir):
    """The name of a source that is a text in some items and an object in others."""
    k, kind, user = F.col("event_id") % 6, F.col("event_type"), F.col("user_id").cast("string")
    source = F.when(k == 0, F.concat(F.lit('"  '), kind, F.lit('\\n  x "'))).when(k == 1, F.concat(F.lit('{"name":"'), kind, F.lit('","title":"other"}'))).when(k == 2, F.concat(F.lit('{"name":"","title":"T '), user, F.lit('"}')))
    source = source.when(k == 3, '{"icon":"i"}').when(k == 4, "null").otherwise(user)
    item = F.parse_json(F.concat(F.lit('{"title":"t","source":'), source, F.lit("}")))
    return table(spark, sf_dir, "events").select("event_id", translation.source_name(item).alias("name"))


@query(r"""SELECT doc_id, regexp_replace(strip_accents(translate(coalesce(text, '') || '–“é”—’漢', '–—’“”', '--''""')), '[^\x00-\x7F]', '', 'g') AS plain FROM documents""")
def ascii_titles(spark, sf_dir):
    """Texts in ASCII: plain dashes and quotes, letters without marks, nothing else."""
    return table(spark, sf_dir, "documents").select("doc_id", translation.ascii_text(F.concat(F.coalesce("text", F.lit("")), F.lit("–“é”—’漢"))).alias("plain"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'French' WHEN 1 THEN 'Chinese' ELSE 'nl' END AS language, CASE WHEN o_orderkey % 5 = 0 THEN 'Current observation window' ELSE strftime(o_orderdate, '%-d %b %Y') || ' - ' || strftime(o_orderdate + INTERVAL 6 DAY, '%-d %b %Y') END AS period FROM orders""")
def labels_shown(spark, sf_dir):
    """Names of languages and labels of periods."""
    k = F.col("o_orderkey") % 3
    code = F.when(k == 0, "fr").when(k == 1, "zh").otherwise("nl")
    end = F.when(F.col("o_orderkey") % 5 != 0, F.date_add("o_orderdate", 6))
    return table(spark, sf_dir, "orders").select("o_orderkey", translation.language_name(code).alias("language"), translation.date_label(F.col("o_orderdate"), end).alias("period"))


@query(r"""SELECT page_id, regexp_matches(lower(html), '(?:^|[^a-z0-9_])ad(?:[^a-z0-9_]|$)') OR contains(lower(html), 'cookie') AS found, regexp_replace(lower(regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1)) || regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS place FROM pages""")
def term_matches(spark, sf_dir):
    """Pages that hold a term, a short one only as a word of its own, and their addresses without queries."""
    return table(spark, sf_dir, "pages").select("page_id", text.has_term(F.col("html"), ["ad", "cookie"], {"ad"}).alias("found"), text.without_query(F.col("url")).alias("place"))


@query(r"""WITH s AS (SELECT doc_id, lang, length(text) AS len, CASE WHEN n_chars % 7 = 0 THEN 100 ELSE 0 END + CASE WHEN contains(lower(text), 'wha') THEN 40 ELSE 0 END + CASE WHEN contains(lower(text), 'ing') THEN 40 ELSE 0 END + CASE WHEN regexp_matches(text, '[0-9]') THEN 5 ELSE 0 END + CASE WHEN regexp_matches(text, '["“”«»：—丨]') THEN 4 ELSE 0 END
        + CASE WHEN length(text) >= 70 THEN 3 ELSE 0 END + CASE WHEN lang = 'zh' THEN 2 ELSE 0 END AS difficulty, sha256(doc_id::VARCHAR) AS h FROM documents), p AS (SELECT *, row_number() OVER (ORDER BY difficulty DESC, len DESC, h) AS place FROM s), t AS (SELECT * FROM p WHERE place <= 20),
    missing AS (SELECT l.lang FROM (VALUES ('de'), ('fr')) l(lang) WHERE l.lang NOT IN (SELECT lang FROM t)), extra AS (SELECT * FROM p WHERE lang IN (SELECT lang FROM missing) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY place) = 1)
    SELECT doc_id, lang, difficulty FROM t WHERE place <= 20 - (SELECT count(*) FROM extra) UNION ALL SELECT doc_id, lang, difficulty FROM extra""")
def difficult_sample(spark, sf_dir):
    """The 20 hardest headlines, longer ones first among equals; the last ones give way to the hardest of a language that has none."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.length("text").alias("len"), translation.difficulty(F.col("text"), F.col("n_chars") % 7 == 0, F.col("lang"), ("wha", "ING")).alias("difficulty"), hash_order("doc_id").alias("h"))
    order = [F.desc("difficulty"), F.desc("len"), F.asc("h")]
    wanted = ["de", "fr"]
    # The hardest of all and the hardest of each wanted language: at most 20 and 2 rows, ordered once more.
    best = rows.orderBy(*order).limit(20)
    first = top_per_key(rows.filter(F.col("lang").isin(wanted)), ["lang"], order, 1)
    extra = first.join(best.select("lang").distinct(), "lang", "left_anti").select(*rows.columns)
    ranked = best.withColumn("place", F.expr("row_number() OVER (ORDER BY difficulty DESC, len DESC, h)")).join(F.broadcast(extra.agg(F.count(F.lit(1)).alias("n"))))
    return ranked.filter("place <= 20 - n").select("doc_id", "lang", "difficulty").union(extra.select("doc_id", "lang", "difficulty"))


@query("""WITH p AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::DOUBLE * b.embedding[i]::DOUBLE)), 6) AS similarity, a.vec_id % 9 = b.vec_id % 9 AS token, a.vec_id % 4 <> b.vec_id % 4 AS across
        FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND abs(a.vec_id % 7 - b.vec_id % 7) <= 1), q AS (SELECT * FROM p WHERE similarity >= 0.3),
    t AS (SELECT a, b, similarity, 'story-token match' AS stratum FROM q WHERE token ORDER BY similarity DESC, a, b LIMIT 6), r AS (SELECT a, b, similarity, 'bin ' || floor(similarity * 20)::BIGINT AS stratum, across FROM q WHERE (a, b) NOT IN (SELECT (a, b) FROM t))
    SELECT a, b, similarity, stratum FROM t UNION ALL SELECT a, b, similarity, stratum FROM r QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY NOT across, a, b) <= 8""")
def calibration_sample(spark, sf_dir):
    """Six pairs with a shared token, then eight of each bin of similarity, those across languages first."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), (F.col("vec_id") % 7).alias("day"), F.col("embedding").alias("vector"))
    pairs = vectors.blocked_pairs(rows, 1, 0.3).select("*", (F.col("a") % 9 == F.col("b") % 9).alias("token"), (F.col("a") % 4 != F.col("b") % 4).alias("across"))
    tokens = pairs.filter("token").orderBy(F.desc("similarity"), "a", "b").limit(6).select("a", "b", "similarity", F.lit("story-token match").alias("stratum"), "across")
    others = pairs.join(F.broadcast(tokens.select("a", "b")), ["a", "b"], "left_anti").select("a", "b", "similarity", F.concat(F.lit("bin "), F.floor(F.col("similarity") * 20).cast("string")).alias("stratum"), "across")
    return tokens.union(top_per_key(others, ["stratum"], [F.desc("across"), F.asc("a"), F.asc("b")], 8)).drop("across")


@query("""WITH l AS (SELECT l_suppkey AS source, l_orderkey AS article, l_partkey AS event, l_linestatus AS market, lower(l_returnflag) AS lang FROM lineitem), s AS (SELECT *, CASE WHEN source % 5 = 0 THEN 'unclassified' WHEN source % 5 = 1 THEN 'institutional' ELSE 'news' END AS stratum FROM l)
    SELECT 'publisher' AS kind, source::VARCHAR AS name, count(DISTINCT article) AS articles, count(DISTINCT event) AS events, count(DISTINCT market) AS markets, NULL::DOUBLE AS share FROM s GROUP BY source
    UNION ALL SELECT 'stratum', stratum, count(DISTINCT (source, article)), count(DISTINCT event), count(DISTINCT market), round(count(*) / (SELECT count(*) FROM l), 6) FROM s GROUP BY stratum
    UNION ALL SELECT 'language', lang, count(DISTINCT (source, article)), count(DISTINCT event), count(DISTINCT market), round(count(*) / (SELECT count(*) FROM l), 6) FROM s GROUP BY lang""")
def source_tables(spark, sf_dir):
    """Distinct articles, events and markets of publishers, strata and languages, and shares of all records.

    Each distinct count has narrow groupings of its own. A source has one stratum, so strata are made from what is distinct at the sources.
    """
    source, lang = F.col("l_suppkey").alias("source"), F.lower("l_returnflag").alias("lang")
    rows = table(spark, sf_dir, "lineitem")
    stratum = F.when(F.col("source") % 5 == 0, "unclassified").when(F.col("source") % 5 == 1, "institutional").otherwise("news")
    one, none = F.count(F.lit(1)), F.lit(0).cast("long")

    def counts(df, kind, name, articles=none, events=none, markets=none, n=none):
        figures = {"articles": articles, "events": events, "markets": markets, "n": n}
        return df.select(F.lit(kind).alias("kind"), name.cast("string").alias("name"), *[c.alias(k) for k, c in figures.items()])

    articles = rows.select(source, F.col("l_orderkey").alias("article")).distinct().groupBy("source").agg(F.count("article").alias("known"), one.alias("n"))
    events = rows.select(source, F.col("l_partkey").alias("event")).distinct()
    markets = rows.groupBy(source, F.col("l_linestatus").alias("market")).agg(one.alias("n"))
    in_lang = rows.select(lang, source, F.col("l_orderkey").alias("article")).distinct().groupBy("lang").agg(one.alias("n"))
    events_in_lang = rows.select(lang, F.col("l_partkey").alias("event")).distinct().groupBy("lang").agg(F.count("event").alias("n"))
    markets_in_lang = rows.groupBy(lang, F.col("l_linestatus").alias("market")).agg(one.alias("n"))
    n, publisher, known_market = F.col("n"), F.col("source"), F.col("market").isNotNull().cast("long")
    parts = [
        counts(articles, "publisher", publisher, articles=F.col("known")),
        counts(articles, "stratum", stratum, articles=n),
        counts(events.groupBy("source").agg(F.count("event").alias("n")), "publisher", publisher, events=n),
        counts(events.select(stratum.alias("stratum"), "event").distinct().groupBy("stratum").agg(F.count("event").alias("n")), "stratum", F.col("stratum"), events=n),
        counts(markets, "publisher", publisher, markets=known_market, n=n),
        counts(markets.groupBy(stratum.alias("stratum"), "market").agg(F.sum("n").alias("n")), "stratum", F.col("stratum"), markets=known_market, n=n),
        counts(in_lang, "language", F.col("lang"), articles=n),
        counts(events_in_lang, "language", F.col("lang"), events=n),
        counts(markets_in_lang, "language", F.col("lang"), markets=known_market, n=n),
    ]
    sums = reduce(DataFrame.union, parts).groupBy("kind", "name").agg(*[F.sum(c).alias(c) for c in ("articles", "events", "markets", "n")])
    total = F.broadcast(rows.agg(one.alias("all")))
    share = F.when(F.col("kind") != "publisher", F.round(F.col("n") / F.col("all"), 6))
    return sums.join(total).select("kind", "name", "articles", "events", "markets", share.alias("share"))
