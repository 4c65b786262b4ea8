"""Line dedup by a segment-partition edit join, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import BROADCAST_BYTES, bounded, saved

#: Lines that are compared in pairs under one key.
CROWD = 2_000
#: Lines of which there are more copies don't come together in one task when the verdict on their class reaches them.
MANY_COPIES = 10_000
#: What a line is known by: XXH64, length, and a second hash.
LINE = ["h", "n", "m"]


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, no, line, h, n, m) of every line, without blanks at its ends; lines are numbered from 0.

    Lines without a character are left out.
    """
    own = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("no", "line"))
    own = own.select("id", "no", F.trim("line").alias("line")).filter("line <> ''")
    return own.select("id", "no", "line", F.xxhash64("line").alias("h"), F.char_length("line").alias("n"), F.hash("line").alias("m"))


def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """(start from 0, size) of the i-th of `parts` segments of a line: the last ones take what is left over."""
    size, over = F.floor(length / parts).cast("int"), length % parts
    longer = F.greatest(F.lit(0), i - (parts - over))
    return size * i + longer, size + F.when(i >= parts - over, 1).otherwise(0)


def places(n: Column, threshold: int, least_chars: int) -> Iterator[tuple[bool, int, Column, Column, Column, Column]]:
    """(own, i, length, start, size, fits) of the segments under which a line of n characters meets others.

    First its own threshold + 1 segments, then those under which it looks for lines as long as itself or up to `threshold`
    shorter. Segment i of the other line is looked for only where it can stand if it is the first one that matches: shifted by at most i
    edits before it, and by at most threshold - i after it.
    """
    own, probes = [], []
    for shorter in range(threshold + 1):
        length = n - shorter
        for i in range(threshold + 1):
            start, size = segment(length, i, threshold + 1)
            low, high = max(-i, shorter - (threshold - i)), min(i, shorter + (threshold - i))
            for shift in range(low, high + 1):
                fits = (length >= least_chars) & (start + shift >= 0) & (start + shift + size <= n)
                at = shorter == 0 and shift == 0
                (own if at else probes).append((at, i, length, start + shift, size, fits))
    return iter([*own, *probes])


def segment_keys(threshold: int, least_chars: int) -> list[Column]:
    """Keys of a line: first those of its own threshold + 1 segments, then those under which it looks for other lines."""
    line = F.col("line")
    return [F.when(fits, F.xxhash64(F.lit(i), length, F.substring(line, start + 1, size))) for _, i, length, start, size, fits in places(F.col("n"), threshold, least_chars)]


def cuts(text: Column, threshold: int, least_chars: int, context: list[Column]) -> Column:
    """Keys of a text as in segment_keys, within a context, each with whether it is its own and with the text without the segment."""
    n = F.char_length(text)
    rest = lambda start, size: F.concat(F.substring(text, F.lit(1), start), F.substring(text, start + size + 1, n))
    keys = [
        F.when(fits, F.struct(F.xxhash64(*context, F.lit(i), length, F.substring(text, start + 1, size)).alias("key"), F.lit(own).alias("own"), rest(start, size).alias("rest")))
        for own, i, length, start, size, fits in places(n, threshold, least_chars)
    ]
    return F.filter(F.array(*keys), lambda k: k.isNotNull())


def parities(line: Column) -> list[Column]:
    """Two longs: does an odd number of the line's characters, and of its pairs of neighbours, fall to each bit?

    An edit changes at most 2 bits of the first and 4 of the second.
    """
    one = F.lit(1).cast("long")
    letters = F.split(line, "")
    flip = lambda acc, bit: acc.bitwiseXOR(F.call_function("shiftleft", one, bit))
    bit_of = lambda *c: F.pmod(F.xxhash64(*c), F.lit(64)).cast("int")
    pairs = F.zip_with(F.slice(letters, 1, F.size(letters) - 1), F.slice(letters, 2, F.size(letters) - 1), lambda x, y: bit_of(x, y))
    zero = F.lit(0).cast("long")
    return [F.aggregate(F.transform(letters, lambda x: bit_of(x)), zero, flip).alias("odd"), F.aggregate(pairs, zero, flip).alias("odd_pairs")]


def with_keys(lines: DataFrame, threshold: int, least_chars: int) -> DataFrame:
    """(id, no, h, n, m, keys) of lines; keys is null where they are shorter than least_chars."""
    keys = F.when(F.col("n") >= least_chars, F.array(*segment_keys(threshold, least_chars)))
    return lines.select("id", "no", *LINE, keys.alias("keys"))


def meetings(keyed: DataFrame, threshold: int, most_broadcast: int) -> DataFrame:
    """(key, h, own) of the lines that share a key with another one, of which one has it as its own; own as a flag.

    Nearly all keys are of one line only, and leave before lines are compared.
    """
    keyed = keyed.filter("keys IS NOT NULL")
    rows = keyed.select("h", F.posexplode("keys").alias("place", "key")).filter("key IS NOT NULL")
    rows = rows.select("key", "h", (F.col("place") <= threshold).alias("own"))
    met = rows.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.max("own").alias("own"))
    met = bounded(saved(met.filter("own AND low <> high").select("key")), most_broadcast)
    return saved(rows.join(met, "key").groupBy("key", "h").agg(F.max("own").alias("own")))


def spread(met: DataFrame, texts: DataFrame, threshold: int, least_chars: int, crowd: int) -> DataFrame:
    """met, in which no key is shared by over `crowd` lines that differ in anything but a few characters.

    Lines of a crowded key leave it for narrower ones. If two lines share a segment and at most `threshold` edits part them, as many part
    what is left of them without it; so what is left is cut into segments in turn, within the context of the key, and so on
    until no key is crowded. Each round shortens the texts by a third. A key under which next to nothing is left stays.
    """
    hot = saved(met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("key"))
    if hot.isEmpty():
        return met
    hot = bounded(hot, 500_000)
    lines = texts.join(met.join(hot, "key", "left_semi").select("h").distinct(), "h")
    cut = lines.select("h", F.explode(cuts(F.col("line"), threshold, least_chars, [])).alias("x")).select("h", "x.*")
    items = saved(cut.join(hot, "key", "left_semi").distinct())
    done = [met.join(hot, "key", "left_anti").select("key", "h", "own")]
    while not items.isEmpty():
        short = items.filter(F.char_length("rest") <= 2 * threshold)
        done.append(short.groupBy("key", "h").agg(F.max("own").alias("own")))
        # A line that only looks for others under the context's key does so under all keys within.
        inner = items.select("h", F.col("own").alias("owned"), F.explode(cuts(F.col("rest"), threshold, threshold + 1, [F.col("key")])).alias("x"))
        rows = saved(inner.select("x.key", "h", (F.col("owned") & F.col("x.own")).alias("own"), "x.rest"))
        sizes = rows.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.max("own").alias("some"), F.count(F.lit(1)).alias("n")).filter("some AND low <> high")
        sizes = saved(sizes.select("key", (F.col("n") > crowd).alias("crowded")))
        met_again = saved(rows.join(sizes, "key"))
        done.append(met_again.filter("NOT crowded").groupBy("key", "h").agg(F.max("own").alias("own")))
        items = saved(met_again.filter("crowded").select("key", "h", "own", "rest").distinct())
    return saved(reduce(DataFrame.unionByName, done))


def candidate_pairs(met: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """(a, b) of lines of meetings() whose parities allow for at most `threshold` edits, a < b."""
    marked = saved(met.join(bounded(saved(texts.select("h", *parities(F.col("line")))), 500_000), "h"))
    x, y = marked.filter("own").toDF("h", "key", "own", "odd", "odd_pairs"), marked.toDF("g", "key", "own_too", "even", "even_pairs")
    # Lines that both have the key as their own are of one length and meet once.
    once = (F.col("h") < F.col("g")) | (~F.col("own_too") & (F.col("h") != F.col("g")))
    near = (F.bit_count(F.col("odd").bitwiseXOR(F.col("even"))) <= 2 * threshold) & (F.bit_count(F.col("odd_pairs").bitwiseXOR(F.col("even_pairs"))) <= 4 * threshold)
    pairs = x.join(y, (x["key"] == y["key"]) & once & near)
    return pairs.select(F.least("h", "g").alias("a"), F.greatest("h", "g").alias("b")).distinct()


def without_common_ends(pairs: DataFrame) -> DataFrame:
    """pairs with line_a and line_b without the beginning and the end that both have; no edit distance depends on them.

    The lengths of both ends are found by halving steps.
    """
    a, b = F.col("line_a"), F.col("line_b")
    n, m = F.char_length(a), F.char_length(b)
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), lambda p: p <= F.col("least"))

    def begin(acc: Column, p: Column) -> Column:
        fits = (p <= F.col("least") - acc) & (F.substring(a, acc + 1, p) == F.substring(b, acc + 1, p))
        return F.when(fits, acc + p).otherwise(acc)

    def end(acc: Column, p: Column) -> Column:
        fits = (p <= F.col("least") - F.col("first") - acc) & (F.substring(a, n - acc - p + 1, p) == F.substring(b, m - acc - p + 1, p))
        return F.when(fits, acc + p).otherwise(acc)

    rows = pairs.select("a", "b", "line_a", "line_b", F.least(n, m).alias("least"))
    rows = rows.select("*", F.aggregate(steps, F.lit(0), begin).alias("first"))
    rows = rows.select("*", F.aggregate(steps, F.lit(0), end).alias("last"))
    cut = lambda line, size: F.substring(line, F.col("first") + 1, size - F.col("first") - F.col("last"))
    return rows.select("a", "b", cut(a, n).alias("line_a"), cut(b, m).alias("line_b"))


def with_distance(pairs: DataFrame, threshold: int) -> DataFrame:
    """pairs (a, b, line_a, line_b) with `distance`: the lines' edit distance if it is at most threshold, else null.

    A banded automaton with a word of bits for each distance. Bit d of word k says that, with k edits, what is read of
    line_a can be followed at place i + d - threshold of line_b. First every character of line_a gets the word of
    places in the band where line_b has the same character; then each such word moves all words at once: along equal
    characters, past a replaced, an added or (within one step) a missing one.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    near = pairs.filter(F.abs(F.char_length("line_a") - F.char_length("line_b")) <= threshold)
    near = without_common_ends(near)
    letters = lambda c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, ""))
    cut = near.select("a", "b", letters("line_a").alias("x"), letters("line_b").alias("y"))

    def mask(c: Column, i: Column) -> Column:
        out = F.lit(0)
        for d in range(width):
            place = i + (d - threshold)
            # A negative place would count from the end.
            other = F.get(F.col("y"), place) if d >= threshold else F.when(place >= 0, F.get(F.col("y"), place))
            out = out + F.when(other == c, 1 << d).otherwise(0)
        return out

    masked = cut.select("a", "b", (F.size("y") - F.size("x")).alias("longer"), F.transform("x", mask).alias("masks"))

    def left_shift(word: Column) -> Column:
        return F.shiftleft(word, 1).bitwiseAND(F.lit(full))

    def step(acc: Column, same: Column) -> Column:
        words = [acc["r0"].bitwiseAND(same)]
        for k in range(1, threshold + 1):
            was = acc[f"r{k - 1}"]
            kept = acc[f"r{k}"].bitwiseAND(same).bitwiseOR(was).bitwiseOR(F.shiftright(was, 1))
            words.append(kept.bitwiseOR(left_shift(words[k - 1])))
        return F.struct(*[w.alias(f"r{k}") for k, w in enumerate(words)])

    start = [1 << threshold]
    for _ in range(threshold):
        start.append((start[-1] | start[-1] << 1) & full)
    first = F.struct(*[F.lit(w).alias(f"r{k}") for k, w in enumerate(start)])
    read = masked.select("a", "b", "longer", F.aggregate("masks", first, step).alias("words"))
    distance = F.lit(None).cast("int")
    for k in range(threshold, -1, -1):
        reached = F.call_function("shiftright", F.col("words")[f"r{k}"], F.col("longer") + threshold).bitwiseAND(F.lit(1)) == 1
        distance = F.when(reached, k).otherwise(distance)
    return read.select("a", "b", distance.alias("distance"))


def ends(links: DataFrame) -> DataFrame:
    """(h) of both ends of each link."""
    return links.select(F.col("a").alias("h")).unionAll(links.select(F.col("b").alias("h")))


def links(lines: DataFrame, keyed: DataFrame, threshold: int, least_chars: int, crowd: int = CROWD, most_broadcast: int = 1_000_000) -> DataFrame:
    """(a, b, distance) of distinct lines, by their hashes, whose edit distance is at most threshold.

    keyed is with_keys() of lines. Texts are picked out of all lines by joins that broadcast the hashes wanted where
    they are at most most_broadcast (8 bytes each), and shuffle the lines beyond that.
    """
    met = meetings(keyed, threshold, most_broadcast)
    wanted = bounded(saved(met.select("h").distinct()), most_broadcast)
    texts = saved(lines.join(wanted, "h").groupBy("h").agg(F.first("line").alias("line")))
    pairs = saved(candidate_pairs(spread(met, texts, threshold, least_chars, crowd), texts, threshold))
    texts = bounded(saved(texts.join(bounded(saved(ends(pairs).distinct()), most_broadcast), "h")), 20_000)
    both = pairs.join(texts.select(F.col("h").alias("a"), F.col("line").alias("line_a")), "a")
    both = both.join(texts.select(F.col("h").alias("b"), F.col("line").alias("line_b")), "b")
    # Few rows with much work each: dealt out by pair, not by size.
    both = both.repartition(2 * int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    # Written before the filter, which would otherwise be pushed into the expressions and repeat them.
    return saved(with_distance(both, threshold)).filter("distance IS NOT NULL")


def with_classes(places: DataFrame, classes: DataFrame, most_broadcast: int) -> DataFrame:
    """places with first and n_links of their line's class (*LINE, first, n_links, often), null where it has none.

    Where classes aren't broadcast, those of lines that stand often are by themselves: there are at most as many as all lines by
    MANY_COPIES. Their places are dealt out by chance in the shuffle, where they meet nothing.
    """
    all_at_once = bounded(classes, most_broadcast)
    if all_at_once is not classes:
        return places.join(all_at_once.drop("often"), LINE, "left")
    often = bounded(saved(classes.filter("often").drop("often").withColumnsRenamed({"first": "first_often", "n_links": "n_often"})), most_broadcast)
    rest = classes.filter("NOT often").drop("often").withColumn("deal", F.lit(0))
    deal = F.when(F.col("first_often").isNull(), 0).otherwise(1 + F.pmod(F.hash("id", "no"), F.lit(1_000)))
    out = places.join(often, LINE, "left").withColumn("deal", deal).join(rest, [*LINE, "deal"], "left")
    return out.select("id", "no", F.coalesce("first_often", "first").alias("first"), F.coalesce("n_often", "n_links").alias("n_links"))


def line_classes(docs: DataFrame, threshold: int = 2, least_chars: int = 24, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = 500_000, crowd: int = CROWD, many: int = MANY_COPIES) -> DataFrame:
    """(id, no, class_id, class_no, n_links, kept) of every line that isn't blank.

    Lines are one class if they are equal, or linked by edit distances of at most threshold, directly or through
    others; lines of fewer than least_chars characters only if they are equal. The class is named by its first
    line by id and number, which alone is kept; n_links counts the other distinct lines that a line is linked to.
    Lines are compared without blanks at their ends. A null id comes before all others. The same row given twice
    has each line twice, at one place, with one verdict. Null and empty texts have no lines; texts of any length are read
    whole. An empty table gives no rows. Columns of docs other than the two named are not read.

    Keys that over `crowd` lines share, such as those of license headers, give way to narrower ones.

    A line that no other line equals or is linked to is its own class; only the others are looked up, by a broadcast if they are
    few (most_broadcast, and a few megabytes) or by a shuffle, which those of over `many` copies don't take part in.
    """
    lines = lines_of(docs, id_col, text_col)
    keyed = saved(with_keys(lines, threshold, least_chars))
    places = keyed.select("id", "no", *LINE)
    found = links(lines, keyed, threshold, least_chars, crowd)
    linked = components(found).withColumnRenamed("node", "h").join(ends(found).groupBy("h").agg(F.count(F.lit(1)).alias("n_links")), "h")
    linked = bounded(saved(linked), most_broadcast)
    distinct = places.groupBy(*LINE).agg(F.min(F.struct("id", "no")).alias("place"), F.count(F.lit(1)).alias("size"))
    distinct = distinct.join(linked, "h", "left").filter("size > 1 OR root IS NOT NULL")
    distinct = saved(distinct.select(*LINE, "size", "place", F.coalesce("n_links", F.lit(0)).alias("n_links"), "root"))
    merged = bounded(saved(distinct.filter("root IS NOT NULL").groupBy("root").agg(F.min("place").alias("first"))), most_broadcast)
    classes = saved(distinct.join(merged, "root", "left").select(*LINE, F.coalesce("first", "place").alias("first"), "n_links", (F.col("size") > many).alias("often")))
    here = F.struct("id", "no")
    out = with_classes(places, classes, most_broadcast).withColumn("first", F.coalesce("first", here))
    return out.select(
        "id", "no", F.col("first.id").alias("class_id"), F.col("first.no").alias("class_no"), F.coalesce("n_links", F.lit(0)).alias("n_links"), here.eqNullSafe(F.col("first")).alias("kept")
    )


def removed_lines(docs: DataFrame, threshold: int = 2, least_chars: int = 24, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = 500_000) -> DataFrame:
    """(_id, _gone): the numbers of the lines of each document that aren't the first of their class.

    Marked for broadcast if there are at most most_broadcast such lines, in a few megabytes.
    """
    gone = line_classes(docs, threshold, least_chars, id_col, text_col).filter(~F.col("kept") & F.col("id").isNotNull())
    gone = saved(gone.select("id", "no").distinct().groupBy("id").agg(F.collect_list("no").alias("_gone")).withColumnRenamed("id", "_id"))
    size = gone.agg(F.sum(F.size("_gone"))).first()[0] or 0
    return bounded(gone, most_broadcast, 2 * BROADCAST_BYTES) if size <= most_broadcast else gone


def rest_of(text: Column, gone: Column) -> Column:
    """text without the lines whose numbers are in gone; null gone leaves it as it is."""
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(gone, i))
    return F.when(gone.isNull(), text).otherwise(F.array_join(kept, "\n"))


def without_repeats(docs: DataFrame, threshold: int = 2, least_chars: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with every line taken out of its text that isn't the first of its class.

    Blank lines, and the order of the others, stay; a text whose lines all go becomes empty.
    """
    gone = removed_lines(docs, threshold, least_chars, id_col, text_col)
    joined = docs.join(gone, F.col(id_col) == F.col("_id"), "left")
    return joined.select(*[rest_of(F.col(c), F.col("_gone")).alias(c) if c == text_col else F.col(c) for c in docs.columns])
