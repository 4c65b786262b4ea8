"""Queries over JSON: noisy answers, canonical records, and search at any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.functions import nested
from loomwright.operators.ranking import top_per_key
from loomwright.plans.queries import query
from loomwright.sources.tables import table

#: The JSON of an answer by event_id % 8, in SQL: nested, with braces in strings, two objects, thoughts, fences, none.
ANSWER_SQL = r"""'{"a":{"k":-1,"b":[{"k":-2}]},"s":"}{\"k\"","k":' || k || '}'"""


@query(r"""WITH e AS (SELECT event_id, CASE WHEN event_id % 8 IN (6, 7) THEN NULL ELSE json_extract_string(props, '$.k')::BIGINT END AS k FROM events)
    SELECT event_id, k, CASE WHEN k IS NOT NULL AND event_id % 8 <> 5 THEN -2 END AS inner_k, CASE WHEN k IS NULL THEN NULL WHEN event_id % 8 = 5 THEN '{"k":' || k || '}' ELSE """ + ANSWER_SQL + r""" END AS object FROM e""")
def noisy_json(spark, sf_dir):
    """The first object in an answer with thoughts, fences, words or other objects around it, whole; null where none decodes."""
    n, k = F.col("event_id") % 8, F.get_json_object("props", "$.k")
    answer = F.concat(F.lit('{"a": {"k": -1, "b": [{"k": -2}]}, "s": "}{\\"k\\"", "k": '), k, F.lit("}"))
    said = F.when(n == 0, answer).when(n == 1, F.concat(F.lit('<think>{"k": 0}</think>\n'), answer)).when(n == 2, F.concat(F.lit("```json\n"), answer, F.lit("\n```")))
    said = said.when(n == 3, F.concat(F.lit("the set {1, 2} and {'k': 3} give "), answer, F.lit(" or {"))).when(n == 4, F.concat(answer, F.lit(' {"k": 0}')))
    said = said.when(n == 5, F.concat(F.lit('{ "open": {'), F.lit('"k":'), k, F.lit("}")))
    said = said.when(n == 6, F.concat(F.lit('{"k": '), k)).otherwise("no answer")
    found = nested.first_object(said)
    rows = table(spark, sf_dir, "events").select("event_id", found.alias("object"))
    return rows.select("event_id", F.get_json_object("object", "$.k").cast("long").alias("k"), F.get_json_object("object", "$.a.b[0].k").cast("int").alias("inner_k"), "object")


@query(r"""SELECT event_id, sha256('{"k":' || json_extract_string(props, '$.k') || ',"note":null,"of":{"at":["' || strftime(ts, '%Y-%m-%d') || '",' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE '"é\"' || event_id || '\u000b"' END
    || '],"share":' || (value / 8)::DOUBLE || '},"type":"' || event_type || '","user":' || user_id || '}') AS digest FROM events""")
def stable_hash(spark, sf_dir):
    """SHA-256 of a nested record as JSON with sorted keys, without blanks, with its nulls."""
    note = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit('é"'), F.col("event_id").cast("string"), F.lit("\x0b")))
    rows = table(spark, sf_dir, "events")
    inner = F.struct((F.col("value") / 8).alias("share"), F.array(F.date_format("ts", "yyyy-MM-dd"), note).alias("at"))
    return rows.select("event_id", nested.stable_hash(rows, user=F.col("user_id"), type=F.col("event_type"), k=F.get_json_object("props", "$.k").cast("long"), note=F.lit(None).cast("string"), of=inner).alias("digest"))


#: A conversation as nested JSON: each turn holds the next ones, as its highlight or in its list of stories with others.
NESTED_SQL = """t AS (
        SELECT conv_id, turn, '{"title":"' || role || '","link":"' || CASE WHEN turn % 3 = 2 THEN '' ELSE 'l' || turn END || '","story_token":' || CASE turn % 5 WHEN 4 THEN 'null' WHEN 3 THEN '""' ELSE '"t' || (turn % 4) || '"' END AS head,
            turn = max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations
    ), j AS (
        SELECT conv_id, '[' || string_agg(CASE WHEN last THEN head || '}' WHEN turn % 2 = 0 THEN head || ',"highlight":' ELSE head || ',"stories":[{"title":"leaf","link":"x","story_token":7,"text":"{\\"story_token\\":1}"},' END, '' ORDER BY turn)
            || string_agg(CASE WHEN last THEN '' WHEN turn % 2 = 0 THEN '}' ELSE ',[]]}' END, '' ORDER BY turn DESC) || ']' AS json FROM t GROUP BY conv_id
    )"""


def conversations_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, json): a nested text for each conversation, two levels or one a turn."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    last = F.element_at("turns", -1)["turn"]

    def head(x: Column) -> Column:
        link = F.when(x["turn"] % 3 == 2, "").otherwise(F.concat(F.lit("l"), x["turn"].cast("string")))
        token = F.when(x["turn"] % 5 == 4, "null").when(x["turn"] % 5 == 3, '""').otherwise(F.concat(F.lit('"t'), (x["turn"] % 4).cast("string"), F.lit('"')))
        own = F.concat(F.lit('{"title":"'), x["role"], F.lit('","link":"'), link, F.lit('","story_token":'), token)
        more = F.when(x["turn"] == last, "}").when(x["turn"] % 2 == 0, ',"highlight":').otherwise(',"stories":[{"title":"leaf","link":"x","story_token":7,"text":"{\\"story_token\\":1}"},')
        return F.concat(own, more)

    tail = lambda x: F.when(x["turn"] == last, "").when(x["turn"] % 2 == 0, "}").otherwise(",[]]}")
    json = F.concat(F.lit("["), F.array_join(F.transform("turns", head), ""), F.array_join(F.transform(F.reverse("turns"), tail), ""), F.lit("]"))
    return turns.select(F.col("conv_id").alias("id"), json.alias("json"))


@query(f"""WITH {NESTED_SQL}, n AS (SELECT conv_id AS id, x.* FROM j, json_tree(j.json) x)
    SELECT p.id, row_number() OVER (PARTITION BY p.id ORDER BY p.node) AS place, json_extract_string(p.value, '$.story_token') AS token, json_extract_string(p.value, '$.title') AS title
    FROM (SELECT conv_id AS id, x.id AS node, json_extract(j.json, x.fullkey) AS value FROM j, json_tree(j.json) x WHERE x.type = 'OBJECT') p
    WHERE coalesce(json_extract_string(p.value, '$.story_token'), '') <> ''""")
def token_nodes(spark, sf_dir):
    """Objects with a token, wherever they are in nested answers, in the order of a walk from the outside in."""
    rows = nested.token_nodes(conversations_as_json(spark, sf_dir), "story_token")
    return rows.select("id", "place", "token", F.get_json_object("text", "$.title").alias("title"))


@query(f"""WITH {NESTED_SQL}, p AS (SELECT conv_id AS id, x.id AS node, json_extract(j.json, x.fullkey) AS value FROM j, json_tree(j.json) x WHERE x.type = 'OBJECT'), q AS (
    SELECT p.id, json_extract_string(p.value, '$.story_token') AS token, json_extract_string(p.value, '$.title') AS seed, node FROM p WHERE coalesce(json_extract_string(p.value, '$.story_token'), '') <> '')
    SELECT id, token, seed FROM q QUALIFY row_number() OVER (PARTITION BY id, token ORDER BY node) = 1""")
def story_tokens(spark, sf_dir):
    """Each token of an answer once, with the title where it comes first."""
    rows = nested.token_nodes(conversations_as_json(spark, sf_dir), "story_token")
    return top_per_key(rows, ["id", "token"], [F.col("place")]).select("id", "token", F.get_json_object("text", "$.title").alias("seed"))


ITEMS_SQL = f"""WITH {NESTED_SQL}, p AS (
        SELECT conv_id AS id, x.id AS node, json_extract(j.json, x.fullkey) AS value FROM j, json_tree(j.json) x
        WHERE x.type = 'OBJECT' AND regexp_full_match(x.fullkey, '\\$\\[\\d+\\](\\.highlight|\\.stories\\[\\d+\\])*')
    ), i AS (
        SELECT id, json_extract_string(value, '$.title') AS title, json_extract_string(value, '$.link') AS link, row_number() OVER (PARTITION BY id ORDER BY node) AS rank
        FROM p WHERE coalesce(json_extract_string(value, '$.title'), '') <> '' AND coalesce(json_extract_string(value, '$.link'), '') <> ''
    )"""


@query(ITEMS_SQL + " SELECT id, rank, title, link FROM i")
def news_items(spark, sf_dir):
    """Items with a title and a link in nested lists of stories and highlights, in order."""
    rows = nested.news_items(conversations_as_json(spark, sf_dir))
    return rows.select("id", F.col("place").alias("rank"), F.get_json_object("text", "$.title").alias("title"), F.get_json_object("text", "$.link").alias("link"))


@query(ITEMS_SQL + " SELECT id, rank, title FROM i WHERE title <> 'user' QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank) <= 3")
def search_ranks(spark, sf_dir):
    """The first three valid items of an answer; a rank counts the invalid items before it too."""
    rows = nested.news_items(conversations_as_json(spark, sf_dir)).select("id", F.col("place").alias("rank"), F.get_json_object("text", "$.title").alias("title"))
    return top_per_key(rows.filter("title <> 'user'"), ["id"], [F.col("rank")], 3)
