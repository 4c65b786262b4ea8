"""Personal data in texts: generators propose spans, boosted trees score them, calibrated thresholds select them.

All work on rows is in DataFrame functions; only the trees are fitted on the driver, from a bounded sample.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, Isotonic
from .planted import Planter

LOCAL = "A-Za-z0-9._%+-"
#: Kinds in the order in which spans with one start are listed. The first four are found by format alone.
KINDS = ("email", "ip", "card", "phone", "iban", "number", "secret")
#: Formats. A match begins where a run of its first class does, or where the last match ended, so that long runs
#: are scanned once; possessive loops need no stack.
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
#: High-recall generators of further candidates, which overlap each other and the formats above.
GENERATORS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}){1,8}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?![A-Za-z0-9])",
    "number": r"[(+]?[0-9][0-9\x20()./-]{5,}[0-9]",
    "card": r"[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{2,4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*[0-9])[A-Za-z0-9_/+-]{16,}={0,2}",
}
#: Words that stand shortly before a value.
CONTEXTS = {
    "keys": r"(?i)(?:token|secret|passw|pwd|api|key|bearer)[a-z]{0,4}[^A-Za-z]{0,6}$",
    "calls": r"(?i)(?:tel|telefon|phone|fon|call|fax|mobil)[a-z]{0,2}[^A-Za-z]{0,6}$",
    "accounts": r"(?i)(?:card|visa|iban|konto|account|ssn|passport)[^A-Za-z]{0,6}$",
    "mails": r"(?i)(?:mail|contact|write to)[^A-Za-z]{0,6}$",
}
DATE = r"^(?:(?:19|20)[0-9]{2}[-./](?:[0-9]{1,2}[-./][0-9]{1,2}|(?:19|20)[0-9]{2})|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2})(?![0-9])"
FEATURES = (
    "kind", "length", "digits", "letters", "upper", "groups", "dots", "plus", "at", "luhn", "octets", "hex", *CONTEXTS, "assigned", "spaces", "mixed",
    "check", "date", "distinct", "words", "bracket", "glued",
)
SPAN = "array<struct<start:int,kind:int,end:int>>"


#: Signs put around matches, and what stands for them where a text has them itself.
BEGIN, END, OTHER = "\x01", "\x02", "\x03"


def looks_around(pattern: str) -> bool:
    """Does a match depend on what stands beside it? Formats begin where a run begins or the last match ended, so there no earlier place has their text."""
    return re.search(r"\(\?<?[!=]", re.sub(r"^\(\?:\\G\|\(\?<!\[[^\]]*\]\)\)", "", pattern)) is not None


def places(text: Column, pattern: str, kind: int) -> Column:
    """(start, kind, end) in code points of the matches of a left-to-right scan of text, in order.

    Where a pattern looks at no sign beside its match, the next match begins at the first place where its text stands at
    or after the end of the last one. Else the scan puts signs around its matches, and the pieces between the signs
    tell where they stand.
    """
    if not looks_around(pattern):

        def find(acc: Column, match: Column) -> Column:
            at = F.call_function("locate", match, text, acc["next"])
            span = F.struct((at - 1).alias("start"), F.lit(kind).alias("kind"), (at - 1 + F.char_length(match)).alias("end"))
            return F.struct((at + F.char_length(match)).alias("next"), F.concat(acc["out"], F.array(span)).cast(SPAN).alias("out"))

        first = F.struct(F.lit(1).alias("next"), F.array().cast(SPAN).alias("out"))
        return F.aggregate(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), first, find, lambda acc: acc["out"])
    own = F.when(F.contains(text, F.lit(BEGIN)) | F.contains(text, F.lit(END)), F.translate(text, BEGIN + END, OTHER + OTHER)).otherwise(text)
    pieces = F.split(F.regexp_replace(own, F.lit(pattern), F.lit(f"{BEGIN}$0{END}")), BEGIN)

    def step(acc: Column, piece: Column) -> Column:
        n = F.call_function("locate", F.lit(END), piece) - 1
        span = F.struct(acc["at"].alias("start"), F.lit(kind).alias("kind"), (acc["at"] + n).alias("end"))
        return F.struct((acc["at"] + F.char_length(piece) - 1).alias("at"), F.concat(acc["out"], F.array(span)).cast(SPAN).alias("out"))

    start = F.struct(F.char_length(pieces[0]).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(F.slice(pieces, 2, F.size(pieces)), start, step, lambda acc: acc["out"])


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn test?"""

    def step(acc: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, F.char_length(digits) - i, F.lit(1))) - 48
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), step) % 10 == 0


def remainder(c: Column) -> Column:
    """An account number's remainder by 97: its first four characters moved to the end, letters counted from 10 for A."""
    own = F.regexp_replace(c, r"\x20", "")
    turned = F.concat(F.substring(own, F.lit(5), F.char_length(own)), F.substring(own, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, acc * 100 + code - 55).otherwise(acc * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.char_length(turned)), F.lit(0), step)


def valid(kind: str, match: Column) -> Column:
    n = F.char_length(digits_of(match))
    if kind == "ip":
        return match.rlike(OCTETS)
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits_of(match))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def passing(text: Column, spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: valid(kind, F.substring(text, s["start"] + 1, s["end"] - s["start"])))


def base_spans(text: Column) -> Column:
    """All spans of the four formats: per kind leftmost and non-overlapping, matches that fail their test dropped."""
    parts = []
    for kind in BASE:
        found = places(text, BASE[kind], KINDS.index(kind))
        parts.append(found if kind == "email" else passing(text, found, kind))
    return F.sort_array(F.concat(*parts))


def candidates(text: Column) -> Column:
    parts = [places(text, p, KINDS.index(kind)) for kind, p in GENERATORS.items()]
    return F.sort_array(F.concat(*parts))


def cut_out(text: Column, spans: Column) -> Column:
    """spans with what stands in them (c) and up to 24 code points before them, cut out of text once for all features."""

    def cut(s: Column) -> Column:
        c = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        before = F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24)))
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), c.alias("c"), before.alias("before"))

    return F.transform(spans, cut)


def features(span: Column) -> list[Column]:
    """Format and context features of a candidate that cut_out has made, as doubles in the order of FEATURES."""
    c, before = span["c"], span["before"]
    n, digits = F.char_length(c), digits_of(c)
    letters = F.char_length(F.regexp_replace(c, "[^A-Za-z]", ""))
    flags = lambda test: F.when(test, 1.0).otherwise(0.0)
    return [
        span["kind"].cast("double"),
        n.cast("double"),
        F.char_length(digits).cast("double"),
        letters.cast("double"),
        F.char_length(F.regexp_replace(c, "[^A-Z]", "")).cast("double"),
        F.size(F.split(c, "[^0-9]+")).cast("double"),
        F.char_length(F.regexp_replace(c, "[^.]", "")).cast("double"),
        flags(F.startswith(c, F.lit("+"))),
        flags(F.contains(c, F.lit("@"))),
        flags(F.when(F.char_length(digits).between(13, 19), luhn(digits)).otherwise(False)),
        flags(c.rlike(OCTETS)),
        flags(c.rlike("^[0-9a-f]{16,}$")),
        *[flags(before.rlike(words)) for words in CONTEXTS.values()],
        flags(before.rlike("""[=:]\\s?["']?$""")),
        F.char_length(F.regexp_replace(c, r"[^\x20]", "")).cast("double"),
        flags(c.rlike("[0-9][A-Za-z]+[0-9]")),
        flags(F.when(c.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9\x20]{10,40}$"), remainder(c) == 1).otherwise(False)),
        flags(c.rlike(DATE)),
        F.size(F.array_distinct(F.split(c, ""))).cast("double"),
        F.size(F.split(c, "[^A-Za-z]+")).cast("double"),
        flags(F.startswith(c, F.lit("(")) | F.startswith(c, F.lit("0"))),
        flags(before.rlike("[A-Za-z0-9]$")),
    ]


def measured(text: Column, spans: Column) -> Column:
    """spans with their features (x), each computed once whatever number of trees reads it."""

    def measure(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.array(*features(s)).alias("x"))

    return F.transform(cut_out(text, spans), measure)


def unsettled(base: Column, found: Column) -> Column:
    """Candidates that the formats leave open: those that meet no base span, and longer runs of letters and digits around one."""
    wide = [KINDS.index(k) for k in ("iban", "secret")]

    def settled(c: Column, s: Column) -> Column:
        around = c["kind"].isin(wide) & (c["start"] <= s["start"]) & (c["end"] >= s["end"]) & (c["end"] - c["start"] > s["end"] - s["start"])
        return overlaps(s, c) & ~around

    return F.filter(found, lambda c: ~F.exists(base, lambda s: settled(c, s)))


@dataclass
class PiiModel:
    """Trees, and of each kind the calibration, the probability from which on spans are taken, and its margin."""

    trees: Boosted
    calibrations: dict[str, Isotonic]
    thresholds: dict[str, float]
    margins: dict[str, float]


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def prepared(docs: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """keep columns, and text with null as empty."""
    return docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def backgrounds(docs: DataFrame, id_col: str, text_col: str, most_docs: int, width: int = 80) -> list[str]:
    """Up to `width` code points from a place in each of at most most_docs texts, both by hash of the id and text."""
    h = F.xxhash64(F.col(id_col), F.col(text_col), F.lit("pii"))
    text, n = F.col(text_col), F.char_length(text_col)
    piece = F.substring(text, (F.pmod(h, F.greatest(n - width, F.lit(1))) + 1).cast("int"), F.lit(width))
    # A share of the rows leaves twice as many as needed, so what tasks send to the driver doesn't grow with them.
    share = max(1, docs.count() // (2 * most_docs))
    chosen = docs.filter((n > 0) & (F.pmod(F.xxhash64(h), F.lit(share)) == 0))
    rows = chosen.select(h.alias("h"), piece.alias("piece")).orderBy("h", "piece").limit(most_docs)
    return [r.piece for r in rows.collect()] or ["some plain words stand around this value"]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_docs: int = 4_000, most_rows: int = 8_000, precision: float = 0.9) -> PiiModel:
    """Learn from `most_rows` short texts: pieces of at most most_docs documents, each with a planted value.

    Half of the values are personal data, half only look like it (planted.py). A candidate is positive if it covers a whole
    personal value and little else (a fifth of it at most); one that doesn't meet the planted value is left out, as are those that the formats settle.
    Two thirds fit the trees. The others, kind by kind, calibrate the margins and give the thresholds:
    the smallest probability of one half or more from which on candidates reach `precision`. A kind without such a one adds nothing.
    """
    pieces, planter = backgrounds(docs, id_col, text_col, most_docs), Planter()
    kinds = sorted(GENERATORS)
    made = [(*planter.row(kinds[i // 2 % len(kinds)], i % 2 == 0, pieces[i % len(pieces)]), i % 2 == 0, i) for i in range(most_rows)]
    texts = docs.sparkSession.createDataFrame(made, "_text string, _start int, _end int, _good boolean, _no int")
    text, c = F.col("_text"), F.col("_c")
    found = texts.select("*", base_spans(text).alias("_base"), candidates(text).alias("_found"))
    rows = found.select("_start", "_end", "_good", "_no", F.explode(measured(text, unsettled(F.col("_base"), F.col("_found")))).alias("_c"))
    common = F.least(c["end"], "_end") - F.greatest(c["start"], "_start")
    whole = F.greatest(c["end"], "_end") - F.least(c["start"], "_start")
    covers = (c["start"] <= F.col("_start")) & (c["end"] >= F.col("_end")) & (common >= 0.8 * whole)
    label = (F.col("_good") & covers).cast("double")
    sample = rows.filter(common > 0).select("_no", c["start"].alias("start"), c["kind"].alias("kind"), c["x"].alias("x"), label.alias("y")).orderBy("_no", "start", "kind").collect()
    x = np.array([r.x for r in sample], dtype=float).reshape(len(sample), len(FEATURES))
    y, kind = np.array([r.y for r in sample], dtype=float), np.array([r.kind for r in sample], dtype=int)
    held = np.array([r["_no"] // (2 * len(kinds)) % 3 == 0 for r in sample], dtype=bool)
    trees = Boosted(rounds=40, rate=0.3).fit(x[~held], y[~held])
    model = PiiModel(trees, {}, {}, {})
    for name in GENERATORS:
        own = held & (kind == KINDS.index(name))
        margins, good = trees.margin(x[own]), y[own]
        model.calibrations[name] = Isotonic().fit(margins, good)
        p = model.calibrations[name](margins)
        reached = [t for t in np.unique(p) if t >= 0.5 and good[p >= t].mean() >= precision]
        model.thresholds[name] = float(reached[0]) if reached else 2.0
        model.margins[name] = float(margins[p >= reached[0]].min()) if reached else float("inf")
    return model


def find(docs: DataFrame, model: PiiModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep columns, `_text`, `_base` and `_spans`: arrays of (start, kind, end), sorted, of each row.

    _spans are the base spans, which may overlap, and of the candidates that reach their kind's threshold and aren't settled
    by a base span, from the longest to the shortest, those that meet no other one taken. An account number or
    secret that holds a base span within it is added whole. Null text counts as empty; repeated rows give repeated results.
    """
    text = F.col("_text")
    some = text.rlike(r"[0-9@]|\[at\]|\(at\)|[A-Za-z0-9_/+-]{16}")
    empty = F.array().cast(SPAN)
    rows = prepared(docs, text_col, *keep).select("*", F.when(some, base_spans(text)).otherwise(empty).alias("_base"), F.when(some, candidates(text)).otherwise(empty).alias("_found"))
    rows = rows.select(*keep, "_text", "_base", measured(text, unsettled(F.col("_base"), F.col("_found"))).alias("_free"))
    if not model.trees.trees or not np.isfinite(list(model.margins.values())).any():
        return rows.select(*keep, "_text", "_base", F.col("_base").alias("_spans"))
    least = F.array(*[F.lit(model.margins.get(k, float("inf"))) for k in KINDS])
    picked = F.filter("_free", lambda c: model.trees.column([c["x"][i] for i in range(len(FEATURES))]) >= least[c["kind"]])
    ranked = lambda s: F.struct((s["start"] - s["end"]).alias("rank"), s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    rows = rows.select(*keep, "_text", "_base", F.sort_array(F.transform(picked, ranked)).alias("_picked"))

    def add(kept: Column, c: Column) -> Column:
        span = F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
        return F.when(F.exists(kept, lambda o: overlaps(o, c)), kept).otherwise(F.concat(kept, F.array(span)).cast(SPAN))

    alone = F.aggregate("_picked", empty, add)
    return rows.select(*keep, "_text", "_base", F.sort_array(F.concat("_base", alone)).alias("_spans"))


def joined(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])))


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """text with each span replaced by its kind in angle brackets; of overlapping spans the first one names them all."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        more = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), names[s["kind"]])
        meets = s["start"] < acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(meets, acc["out"]).otherwise(more).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, end))
