"""JSON in texts: the first object in noisy answers, canonical form, and search at any depth."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DecimalType, DoubleType, FloatType, IntegralType, MapType, StructType

from loomwright.sources.scratch import saved

#: How JSON writes characters that it doesn't take as they are.
ESCAPES = {"\\": "\\\\", '"': '\\"', "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}


def first_object(value: Column) -> Column:
    """The first JSON object that decodes in a text, compact and whole with all it holds; null if none does.

    Thoughts in <think> tags and fences at the ends are taken out. Then decoding is tried at each brace in turn, so
    braces in words or strings before the object, and anything after it, do no harm. Text after a brace is parsed only as far as it is JSON;
    single quotes, NaN and comments are no JSON.
    """
    bare = F.trim(F.regexp_replace(value, r"(?s)<think>.*?</think>", ""))
    bare = F.regexp_replace(bare, r"(?is)^```(?:json)?\s*|\s*```$", "")
    start = F.struct(F.lit(None).cast("string").alias("found"), F.expr("''").alias("rest"))
    start = F.struct(start["found"], F.regexp_extract(bare, r"(?s)(\{.*)", 1).alias("rest"))
    braces = F.greatest(F.regexp_count(bare, F.lit(r"\{")), F.lit(0))

    def step(acc: Column, _: Column) -> Column:
        here = F.when(acc["found"].isNull() & F.try_parse_json(acc["rest"]).isNotNull(), F.get_json_object(acc["rest"], "$"))
        after = F.locate("{", acc["rest"], 2)
        rest = F.when(after > 0, F.call_function("substring", acc["rest"], after)).otherwise("")
        return F.struct(F.coalesce(acc["found"], here).alias("found"), F.when(acc["found"].isNull() & here.isNull(), rest).otherwise(acc["rest"]).alias("rest"))

    found = F.aggregate(F.sequence(F.lit(1), braces), start, step)["found"]
    return F.when(braces > 0, found)


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once a row: they come out of a generator, so a later filter on them isn't pushed below
    and does not compute again what they are made of."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def quoted(value: Column) -> Column:
    """A text as a JSON string; only what must be escaped is, in lower case."""
    plain = [*ESCAPES.items(), *[(chr(c), f"\\u{c:04x}") for c in range(32) if chr(c) not in ESCAPES]]
    escaped = lambda t: reduce(lambda out, x: F.replace(out, F.lit(x[0]), F.lit(x[1])), plain, t)
    return bound(value, lambda t: F.concat(F.lit('"'), F.when(t.rlike(r'[\x00-\x1f"\\]'), escaped(t)).otherwise(t), F.lit('"')))


def fewest_digits(value: Column) -> Column:
    """A positive double's text as Java writes it, with the fewest digits that read back as the same number: Java 17 may write more."""

    def shorter(text: Column) -> Column:
        digits = F.length(F.regexp_replace(F.regexp_extract(text, r"^([\d.]+)", 1), r"^0\.0*|\.0$|\.", ""))
        tries = F.array(*[F.when(digits > k, F.format_string(f"%.{k - 1}E", value)) for k in (14, 15, 16, 17)])
        same = F.filter(tries, lambda t: t.try_cast("double") == value)
        return F.coalesce(F.regexp_replace(F.get(same, F.lit(0)), r"E\+?", "E"), text)

    return bound(value.cast("string"), shorter)


def laid_out(digits: Column, e: Column) -> Column:
    """Digits, of which the first stands for 10 to the e, as plain digits or with an exponent of two digits or more."""
    rest = F.substring(digits, F.lit(2), F.length(digits))
    power = F.abs(e).cast("string")
    scientific = F.concat(F.substring(digits, 1, 1), F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""), F.lit("e"), F.when(e < 0, "-").otherwise("+"), F.lpad(power, F.greatest(F.lit(2), F.length(power)), "0"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    large = bound(F.rpad(digits, F.greatest(e + 2, F.length(digits)), "0"), lambda d: F.concat(F.substring(d, F.lit(1), e + 1), F.lit("."), F.substring(d, e + 2, F.length(d))))
    return F.when(digits == "", "0.0").when((e < -4) | (e >= 16), scientific).when(e < 0, small).otherwise(large)


def float_text(value: Column) -> Column:
    """A double in a shortest form that reads back as itself: plain digits from 0.0001 to below 1e16, else with an exponent."""

    def shown(text: Column) -> Column:
        part = lambda k: F.regexp_extract(text, r"^(\d+)\.?(\d*)(?:E(-?\d+))?$", k)
        exponent = F.coalesce(F.nullif(part(3), F.lit("")).cast("int"), F.lit(0)) + F.length(part(1)) - 1
        facts = F.struct(F.concat(part(1), part(2)).alias("all"), exponent.alias("e"))
        lead = lambda x: F.length(F.regexp_extract(x["all"], "^(0*)", 1))
        trimmed = lambda x: F.regexp_replace(F.regexp_replace(x["all"], "^0+", ""), "0+$", "")
        return bound(bound(facts, lambda x: F.struct(trimmed(x).alias("digits"), (x["e"] - lead(x)).alias("e"))), lambda x: laid_out(x["digits"], x["e"]))

    def written(v: Column) -> Column:
        sign = F.when((v < 0) | (v.cast("string") == "-0.0"), "-").otherwise("")
        odd = F.when(F.isnan(v), "NaN").when(v == float("inf"), "Infinity").when(v == float("-inf"), "-Infinity")
        return odd.otherwise(F.concat(sign, bound(fewest_digits(F.abs(v)), shown)))

    return bound(value, written)


def canonical(value: Column, kind: DataType) -> Column:
    """A value of any nesting as JSON without blanks, keys of structs and maps in order, nulls kept, letters as they are."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        parts = [F.concat(quoted(F.lit(f.name)), F.lit(":"), canonical(value[f.name], f.dataType)) for f in fields]
        text = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    elif isinstance(kind, ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: canonical(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, MapType):
        pairs = F.array_sort(F.map_entries(value), lambda x, y: F.when(x["key"] < y["key"], -1).when(x["key"] > y["key"], 1).otherwise(0))
        text = F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda e: F.concat(quoted(e["key"].cast("string")), F.lit(":"), canonical(e["value"], kind.valueType))), ","), F.lit("}"))
    elif isinstance(kind, (DoubleType, FloatType)):
        text = float_text(value.cast("double"))
    elif isinstance(kind, (IntegralType, BooleanType, DecimalType)):
        text = value.cast("string")
    else:
        text = quoted(value.cast("string"))
    return F.when(value.isNull(), "null").otherwise(text)


def stable_hash(df: DataFrame, **fields: Column) -> Column:
    """SHA-256 of fields of df as canonical JSON."""
    kinds = df.select(*[c.alias(k) for k, c in fields.items()]).schema
    parts = [F.concat(quoted(F.lit(k)), F.lit(":"), canonical(fields[k], kinds[k].dataType)) for k in sorted(fields)]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")), 256)


def children(nodes: DataFrame) -> DataFrame:
    """(id, path, key, text, kind) of what the objects and arrays among nodes hold, one level down.

    Kind is o for an object, a for an array, s for a string and v for other values: a string that looks like an object is none.
    """
    as_text, as_value = "map<string,string>", "map<string,variant>"
    values = F.when(F.col("kind") == "o", F.map_values(F.from_json("text", as_value))).otherwise(F.from_json("text", "array<variant>"))
    texts = F.when(F.col("kind") == "o", F.map_values(F.from_json("text", as_text))).otherwise(F.from_json("text", "array<string>"))
    keys = F.when(F.col("kind") == "o", F.map_keys(F.from_json("text", as_text)))
    held = nodes.select("id", "path", F.posexplode(F.arrays_zip(texts.alias("text"), values.alias("value"), F.coalesce(keys, F.transform(texts, lambda _: F.lit(None).cast("string"))).alias("key"))).alias("place", "x"))
    value = F.col("x.value")
    kind = F.when(F.try_variant_get(value, "$", as_value).isNotNull(), "o").when(F.try_variant_get(value, "$", "array<variant>").isNotNull(), "a")
    kind = kind.when(F.schema_of_variant(value) == "STRING", "s").otherwise("v")
    return held.select("id", F.concat("path", F.array("place")).alias("path"), F.col("x.key").alias("key"), F.col("x.text").alias("text"), kind.alias("kind"))


def walk(df: DataFrame, json: str = "json") -> DataFrame:
    """(id, path, key, text, kind) of all that the JSON of rows (id, json) holds, at any depth; the value itself has an empty path.

    Each round opens the objects and arrays that the round before has found and writes them to the shared folder, until a level holds
    none: as many rounds as the deepest text has levels, over ever fewer rows. Sorted, paths give the order in which a walk from the outside in
    meets the nodes. A null or invalid text has no nodes; of a key that an object repeats, all values are met.
    """
    text = F.trim(json)
    kind = F.when(text.startswith("{"), "o").when(text.startswith("["), "a").when(text.startswith('"'), "s").otherwise("v")
    level = df.filter(F.try_parse_json(json).isNotNull()).select("id", F.expr("CAST(array() AS array<int>)").alias("path"), F.lit(None).cast("string").alias("key"), text.alias("text"), kind.alias("kind"))
    level = saved(level)
    levels = [level]
    while not level.filter("kind IN ('o', 'a')").isEmpty():
        level = saved(children(level.filter("kind IN ('o', 'a')")))
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)


def truthy() -> Column:
    """Is a node's value neither null, empty, zero nor false?"""
    return F.col("text").isNotNull() & F.when(F.col("kind") == "s", F.col("text") != "").when(F.col("kind") == "v", ~F.col("text").rlike(r"^(?:null|false|-?0+(?:\.0*)?(?:[eE][-+]?\d+)?)$")).otherwise(~F.col("text").rlike(r"^(?:\{\s*\}|\[\s*\])$"))


def token_nodes(df: DataFrame, token: str, json: str = "json") -> DataFrame:
    """(id, place, path, token, text) of the objects that have a token, anywhere in the JSON of rows (id, json), in the order of a walk."""
    nodes = walk(df, json)
    tokens = nodes.filter((F.col("key") == token) & truthy()).select("id", F.expr("slice(path, 1, greatest(size(path) - 1, 0))").alias("path"), F.col("text").alias("token"))
    objects = nodes.filter("kind = 'o'").select("id", "path", "text").join(tokens, ["id", "path"])
    place = F.row_number().over(Window.partitionBy("id").orderBy("path")).cast("long")
    return objects.select("id", place.alias("place"), "path", "token", "text")


def news_items(df: DataFrame, json: str = "json") -> DataFrame:
    """(id, place, path, text) of the items in lists of stories: those with a title and a link, then their highlight, then their stories.

    A list holds items; an item's highlight is an item, and its stories are a list of items, at any depth.
    """
    nodes = saved(walk(df, json))
    up = lambda n: F.expr(f"slice(path, 1, greatest(size(path) - {n}, 0))")
    # The way to an item alternates: places in lists, then highlight or stories.
    steps = nodes.filter("kind IN ('o', 'a') AND size(path) > 0").select("id", "path", "key", "kind", "text")
    item = steps.filter("kind = 'o' AND size(path) = 1 AND key IS NULL").select("id", "path", "text", F.array(F.element_at("path", 1)).alias("order"))
    items, last = [item], item
    while not last.isEmpty():
        inner = steps.withColumn("above", up(1)).join(last.select("id", F.col("path").alias("above"), "order"), ["id", "above"])
        highlight = inner.filter("key = 'highlight' AND kind = 'o'").select("id", "path", "text", F.concat("order", F.array(F.lit(0))).alias("order"))
        lists = inner.filter("key = 'stories' AND kind = 'a'").select("id", F.col("path").alias("above"), F.concat("order", F.array(F.lit(1))).alias("order"))
        told = steps.filter("kind = 'o'").withColumn("above", up(1)).join(lists, ["id", "above"]).select("id", "path", "text", F.concat("order", F.array(F.element_at("path", -1))).alias("order"))
        last = saved(highlight.unionByName(told))
        items.append(last)
    found = reduce(DataFrame.unionByName, items).select("*", *[F.try_parse_json("text").alias("_v")])
    has = lambda k: F.coalesce(F.try_variant_get("_v", f"$.{k}", "string"), F.lit("")) != ""
    place = F.row_number().over(Window.partitionBy("id").orderBy("order")).cast("long")
    return found.filter(has("title") & has("link")).select("id", place.alias("place"), "path", "text")
