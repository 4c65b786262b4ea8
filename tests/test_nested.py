"""JSON in texts against Python's own decoder, encoder and recursion."""

import hashlib
import json
import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from loomwright.functions import nested


def decoded(text):
    """The first object that decodes at a brace."""
    if text is None:
        return None
    text = re.sub(r"<think>.*?</think>", "", text, flags=re.S).strip()
    for m in re.finditer(r"\{", text):
        try:
            return json.JSONDecoder().raw_decode(text[m.start() :])[0]
        except json.JSONDecodeError:
            continue
    return None


def test_first_object(spark):
    texts = [
        '{"a":{"b":1},"c":2}', 'x {no} {"a":"}{","b":[{"c":null}]} tail {', '<think>{"z":1}</think>```json\n{"a": 1}\n```', "none", None, "", "{", "}{", '{"a":1}{"b":2}',
        "{'a':1}", '[{"q":[1,{"r":2}]}]', '{ {"x": "\\"{"}', '{"a":"\\\\"} {"b":1}', '{"é":"\\u00e9"}', "{}", 'a{"b":{"c":{"d":[[[{"e":1}]]]}}}z', '{"open": {"in": 1}', "{" * 300 + '{"k":1}', '{"n":1e5,"m":-0.5,"t":true}',
    ]
    draw = random.Random(2)
    texts += ["".join(draw.choice(['{', '}', '"', "a", ":", "1", ",", "\\", '{"a":1}', "[", "]", " "]) for _ in range(25)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: r.o for r in df.select("id", nested.first_object(F.col("t")).alias("o")).collect()}
    for i, t in enumerate(texts):
        assert (json.loads(got[i]) if got[i] is not None else None) == decoded(t), t


def test_floats(spark):
    draw = random.Random(3)
    values = [0.0, -0.0, 1.0, 0.1, 1e22, 1e16, 1e15, 123456789.125, 1e-5, 0.0001, 1e100, 2.5e-7, -3.25, 1e7, 9.999e-4, 1.5e300] + [draw.uniform(-1, 1) * 10.0 ** draw.randrange(-9, 20) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", nested.float_text(F.col("v")).alias("t")).collect()
    assert all(float(r.t) == r.v for r in rows)
    assert all(len(r.t) == len(repr(r.v)) for r in rows)
    # Of two shortest forms, the one that is not the nearer may be taken.
    assert sum(r.t != repr(r.v) for r in rows) <= 3


SCHEMA = "id int, z string, a struct<y:double,b:array<struct<k:string,i:long>>>, m map<string,array<int>>, f boolean, d date, w decimal(5,2)"


def test_canonical_json(spark):
    texts = ["", 'q"\\', "é🤖漢", "\x00\x1f\n\t\r\b\f/", "a'b", None, "\x7f "]
    rows = [(i, t, (float(i) / 4, [(t, i), None, (None, None)]) if i % 3 else None, {t or "x": [i, None], "B": [], "a": None} if i % 2 else None, bool(i % 2), date(2024, 1, 1 + i) if i else None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    kinds = df.schema
    got = {r.id: (r.j, r.h) for r in df.select("id", nested.canonical(F.struct(*df.columns), kinds).alias("j"), nested.stable_hash(df, **{c: F.col(c) for c in df.columns}).alias("h")).collect()}
    for i, z, a, m, f, d, w in rows:
        inner = a and {"y": a[0], "b": [x and {"k": x[0], "i": x[1]} for x in a[1]]}
        want = json.dumps({"id": i, "z": z, "a": inner, "m": m, "f": f, "d": d and d.isoformat(), "w": w}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        assert got[i] == (want, hashlib.sha256(want.encode()).hexdigest())


def random_tree(draw, depth):
    if depth == 0 or draw.random() < 0.3:
        return draw.choice([None, 0, 1, -2.5, "", "t", '{"tok":"no"}', "[1]", True, False, "é\"\\", [], {}])
    if draw.random() < 0.4:
        return [random_tree(draw, depth - 1) for _ in range(draw.randrange(4))]
    return {k: random_tree(draw, depth - 1) for k in draw.sample(["z", "tok", "a", "x.y", "stories", "b c"], draw.randrange(5))}


def with_token(value, out):
    if isinstance(value, dict):
        if value.get("tok"):
            out.append(value)
        for child in value.values():
            with_token(child, out)
    elif isinstance(value, list):
        for child in value:
            with_token(child, out)
    return out


def deep(n):
    value = {"tok": "last"}
    for k in range(n):
        value = {"tok": k, "a": [value]} if k % 2 else {"a": value, "tok": f"t{k}"}
    return value


def test_tokens_at_any_depth(spark):
    draw = random.Random(7)
    trees = [random_tree(draw, 6) for _ in range(80)] + [deep(n) for n in (1, 2, 5, 10)]
    texts = [json.dumps(t, ensure_ascii=False) for t in trees] + [None, "", "{", '{"tok":']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, json string").withColumn("path", F.lit("clash"))
    got = {}
    for r in nested.token_nodes(df, "tok").orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(json.loads(r.text))
    for i, tree in enumerate(trees):
        assert got.get(i, []) == with_token(tree, []), texts[i]
    assert not set(got) & set(range(len(trees), len(texts)))


def items_of(items):
    for item in items:
        if not isinstance(item, dict):
            continue
        if item.get("title") and item.get("link"):
            yield item
        if isinstance(item.get("highlight"), dict):
            yield from items_of([item["highlight"]])
        if isinstance(item.get("stories"), list):
            yield from items_of(item["stories"])


def random_items(draw, depth):
    def item():
        out = {k: draw.choice(["", "x", f"y{draw.randrange(99)}"]) for k in draw.sample(["title", "link", "more"], draw.randrange(2, 4))}
        parts = [("stories", random_items(draw, depth - 1) if depth and draw.random() < 0.6 else draw.choice([None, "s", {}])), ("highlight", item() if depth and draw.random() < 0.3 else draw.choice([None, [], "h"]))]
        draw.shuffle(parts)
        return out | dict(parts)

    return [draw.choice([item, item, item, lambda: "no", lambda: [item()]])() for _ in range(draw.randrange(4))]


def test_items_of_stories(spark):
    draw = random.Random(9)
    lists = [random_items(draw, 3) for _ in range(60)]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lists)] + [(99, None), (98, '{"title":"t","link":"l"}')], "id int, json string")
    got = {}
    for r in nested.news_items(df).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(json.loads(r.text))
    assert got == {i: list(items_of(x)) for i, x in enumerate(lists) if list(items_of(x))}


def test_nothing_to_walk(spark):
    assert nested.token_nodes(spark.createDataFrame([], "id int, json string"), "tok").count() == 0
    with pytest.raises(Exception, match="."):
        nested.walk(spark.createDataFrame([(1,)], "id int")).count()
