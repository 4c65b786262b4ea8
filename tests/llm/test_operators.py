"""Each operator on small tables: exact or brute-force results, and nulls, empty texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomwright.llm import bpe, components, exact_dedup, html_extract, language_id, line_dedup, packing, pigeonhole, pii, planted, queries, simhash, toxicity, weighted_sampling
from loomwright.llm.boosting import Boosted, Isotonic

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use themselves.
CLASH = ("id", "run", "fp", "line", "h", "n", "ids", "score", "_text", "side", "part")
ODD = [None, "", " ", "\n\n", "a", "a\tb  c", "a b\nc", "é🤖", "x" * 20_000, "12 " * 3000, "a b c", None, "A b c"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD)] + [(3, ODD[3], "en", "s", 2), (None, "a b c", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# Personal data


def test_places_of_candidates(spark):
    """Where a candidate stands is where the scan has found it, though the same text may stand before."""
    draw = random.Random(31)
    texts = ["1" * 20, "x " + "1" * 19, "4111 1111 1111 1111" * 2, "1" * 13 + " " + "1" * 12, "\x01" + "1" * 20 + "\x02", "", "é🤖" + "12" * 11]
    texts += ["".join(draw.choice(["1", "1", "1111", "-", " ", "A1", "a@b.c", "(at)", "é", "+"]) for _ in range(draw.randrange(30))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for kind, pattern in pii.GENERATORS.items():
        got = {r.id: [(s.start, s.end) for s in r.p] for r in df.select("id", pii.places(F.col("t"), pattern, 0).alias("p")).collect()}
        for i, t in enumerate(texts):
            own = t.translate({1: 3, 2: 3})
            assert got[i] == [m.span() for m in re.finditer(pattern, own)], (kind, t)


# Exact dedup


def test_exact_dedup(spark, odd):
    got = exact_dedup.exact_dedup(odd).collect()
    assert len(got) == odd.count()
    norm = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in [*enumerate(ODD), (3, ODD[3]), (None, "a b c")]:
        groups[norm(t)].append(i)
    for r in got:
        text = "a b c" if r.doc_id is None else norm(ODD[r.doc_id])
        ids = groups[text]
        assert r.keep_id == min(i for i in ids if i is not None)
        assert (r.group_size, r.kept, r.text_sha256) == (len(ids), r.doc_id == r.keep_id, hashlib.sha256(text.encode()).hexdigest())
    assert exact_dedup.exact_dedup(nothing(spark)).count() == 0


# Byte-level BPE


@pytest.fixture(scope="module")
def tik():
    lines = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb")
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(tik):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    draw = random.Random(5)
    words = ["".join(draw.choice("abe") for _ in range(draw.randint(1, 60))) for _ in range(500)] + ["a" * 5001, "ab" * 3000, "🤖" * 50, "the" * 500]
    mixed = ["".join(chr(draw.choice([draw.randint(32, 126), draw.randint(160, 900), draw.randint(0x4E00, 0x4F00)])) for _ in range(60)) for _ in range(200)]
    own = bpe.TextEncoder(path, public_tokenizers.PATTERN)
    for text, ids in zip([*words, *mixed], own.encode([*words, *mixed]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(text)
        assert own.bpe.decode(ids) == text.encode()


def test_bpe_order_with_unusual_ranks():
    """Ranks under which a merge makes a pair of lower rank: one-at-a-time order counts."""
    from loomwright.llm.rank_queue import ByteBpe

    draw = random.Random(1)
    for _ in range(30):
        pieces = [bytes([b]) for b in range(256)] + list({"".join(draw.choice("abc") for _ in range(draw.randint(2, 4))).encode() for _ in range(25)})
        ranks = {p: i for i, p in enumerate(pieces)}
        own = ByteBpe(ranks)
        words = ["".join(draw.choice("abc") for _ in range(draw.randint(0, 14))).encode() for _ in range(60)]
        for word, got in zip(words, own.encode(words), strict=True):
            parts = [bytes([b]) for b in word]
            while True:
                found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
                if not found:
                    break
                i = min(found)[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert np.frombuffer(got, "<u4").tolist() == [ranks[p] for p in parts]


def test_bpe_on_rows(spark, odd, tik):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    for r in bpe.encode_digests(odd, path, public_tokenizers.PATTERN).collect():
        text = "a b c" if r.doc_id is None else ODD[r.doc_id] or ""
        ids = tik.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    encoded = bpe.encode_texts(odd, path, public_tokenizers.PATTERN)
    assert all(r.decoded == r.again for r in bpe.decode_ids(encoded.withColumnRenamed("decoded", "again"), path).collect())
    assert bpe.encode_digests(nothing(spark), path, public_tokenizers.PATTERN).count() == 0


# Packing


@pytest.mark.parametrize("parts, windows", [(1, 2), (3, 4), (70, 2)])
def test_packing(spark, docs, odd, parts, windows):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = docs.filter("doc_id < 60").unionByName(odd.select(docs.columns).withColumn("doc_id", F.col("doc_id") + 1000)).repartition(parts)
    want = sorted((str(r.doc_id), [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in rows.collect())
    pieces = packing.pack(rows, path, open_windows=windows).collect()
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
    for held in sequences.values():
        held.sort(key=lambda p: p.offset)
        assert [p.offset for p in held] == np.cumsum([0, *[p.length for p in held]])[:-1].tolist()
        total = sum(p.length for p in held)
        assert total <= 2048
        # Nothing is padded: a sequence is full, or a power of two.
        assert total & (total - 1) == 0
    ids = {}
    for d, i in want:
        ids.setdefault(d, i)
    for doc, held in by_doc.items():
        whole = ids[str(doc)]
        starts = sorted((p.start, p.length) for p in held)
        copies = sum(1 for d, _ in want if d == str(doc))
        assert sum(n for _, n in starts) == copies * len(whole)
        for p in held:
            assert p.doc_tokens == len(whole)
            assert p.ids_crc32 == zlib.crc32(np.array(whole[p.start : p.start + p.length], "<u4").tobytes())
    assert set(by_doc) == {r.doc_id for r in rows.collect()}


def test_packing_of_nothing(spark):
    assert packing.pack(nothing(spark), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_word_tokens_equal_tokenizers():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, own = Tokenizer.from_file(path), packing.WordTokens(path, 1)
    odd = ["it's don't I'LL 's", "naïve ÉCOLE Straße ΣΑΣ Ω", "a1b2 3.14 x²", "<|startoftext|> hi<|endoftext|>", "éá 조선", "hello,world...!!! (foo)", "İ ǅ ﬁ\x00b\x1cc d"]
    for text, got in zip(odd, own(odd), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


# Language identification


def test_forward_backward_by_brute_force():
    import itertools

    draw = np.random.default_rng(0)
    emissions, move = draw.normal(size=(7, 3)), draw.normal(size=(3, 3))
    got, expected = language_id.forward_backward(emissions, move, np.array([3, 0, 4]))
    pairs = np.zeros((3, 3))
    for first, n in ((0, 3), (3, 4)):
        want, total, moved = np.zeros((n, 3)), 0.0, np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=n):
            w = np.exp(sum(emissions[first + i, p] for i, p in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            total += w
            for i, p in enumerate(path):
                want[i, p] += w
            for a, b in zip(path, path[1:]):
                moved[a, b] += w
        assert np.allclose(got[first : first + n], want / total, atol=1e-5)
        pairs += moved / total
    assert np.allclose(expected, pairs, atol=1e-4)


def test_expected_transitions_of_many_labels():
    draw = np.random.default_rng(1)
    emissions, move = draw.normal(size=(6, 70)), draw.normal(size=(70, 70))
    _, expected = language_id.forward_backward(emissions, move, np.array([6]))
    # Brute force over all pairs of neighbours: what comes before and after by matrix products.
    e, m = np.exp(emissions), np.exp(move)
    want = np.zeros((70, 70))
    for t in range(5):
        before, after = e[0], np.ones(70)
        for i in range(1, t + 1):
            before = (before @ m) * e[i]
        for i in range(5, t + 1, -1):
            after = m @ (e[i] * after)
        joint = before[:, None] * m * (e[t + 1] * after)[None]
        want += joint / joint.sum()
    assert expected.sum() == pytest.approx(5, rel=1e-4) and np.allclose(expected, want, atol=1e-4)


def test_language_id(spark, docs, odd):
    field = language_id.fit(docs)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = {r.doc_id: r for r in language_id.predict(docs, field).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.95 * len(held)
    assert all(sum(s.words for s in r.segments) == len(language_id.words_of(t)) for r, t in ((got[d.doc_id], d.text) for d in docs.collect()))
    for r in language_id.predict(odd, field).collect():
        text = "a b c" if r.doc_id is None else ODD[r.doc_id]
        assert (r.lang_pred == "und") == (not text or not any(map(str.isalpha, text)))
        assert 0 <= r.score <= 1
    empty = language_id.fit(nothing(spark))
    assert language_id.predict(docs.limit(3), empty).count() == 3


# Toxicity


def test_boosting_and_calibration(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(600, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.5)).astype(float)
    trees = Boosted(rounds=20).fit(x, y)
    assert ((trees.margin(x) > 0) == (y > 0)).mean() > 0.95
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:50]], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(trees.column([F.col(c) for c in "abcd"])).collect()]
    assert np.allclose(got, trees.margin(x[:50]))
    rising = Isotonic().fit(trees.margin(x), y)(np.linspace(-5, 5, 99))
    assert (np.diff(rising) >= 0).all() and rising.min() >= 0 and rising.max() <= 1
    assert Boosted().fit(np.zeros((0, 2)), np.zeros(0)).margin(np.zeros((1, 2))).shape == (1,)


def test_toxicity(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum(got[i].predicted == truth[i] for i in held)
    assert right >= 0.93 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    odd_scores = toxicity.score(odd, model).collect()
    assert len(odd_scores) == odd.count() and len({r.score for r in odd_scores if r.doc_id in (0, 1, 11)}) == 1
    kept = toxicity.with_verdict(docs, model).filter("predicted = 0")
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    nobody = toxicity.fit(nothing(spark), labels.filter("false"), "doc_id", "text", "toxic")
    assert toxicity.score(docs.limit(2), nobody).count() == 2


# HTML


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "</p><article>";</script></head><body><header>Site</header><nav><ul><li>x<li>y</ul></nav>
<div class="ad">Buy</div><article><h1>A &amp; B&nbsp;&#8212; C</h1><p><b>One  two<br>three<p>Four <i>fi</i>ve<aside>no</aside></p><div class="comments">bad</div><form>f</form></article><footer>&copy;</footer></body></html>"""


def test_html(spark):
    assert html_extract.main_text(PAGE, frozenset()) == "A & B — C\nOne two three\nFour five"
    assert html_extract.main_text("<p>a<p>b<!-- c --><div hidden>d</div><li>e", frozenset()) == "a\nb\ne"
    for names in ("content no-sidebar", "post login-required", "page-content"):
        assert html_extract.main_text(f"<body><div class='{names}'><p>Real text</p></div><div class='post-comments'>c</div></body>", frozenset()) == "Real text"
    assert html_extract.main_text("<header>Site</header><article><header><h1>Title</h1></header><p>a</p></article>", frozenset()) == "Title\na"
    shared = "<div class='x7'>Same words <b>here</b></div>"
    pages = [(i, f"http://h.org/{i}", f"<body>{shared}<p>Own text {i} of this page</p></body>") for i in range(10)]
    pages += [(10, None, None), (11, "no address", ""), (11, "no address", ""), (12, "http://h.org/12", "<scr<p>a<b"), (13, "http://h.org/9", "<p>" + "w " * 20_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit(2)).withColumn("low", F.lit(3))
    got = defaultdict(list)
    for r in html_extract.extract(df).collect():
        got[r.page_id].append(r)
        assert r.n_chars == len(r.text)
    assert all(got[i][0].text == f"Own text {i} of this page" for i in range(10))
    assert got[10][0].text == "" and len(got[11]) == 2 and got[13][0].text == " ".join(["w"] * 20_000)
    tree = {(r.host, r.pages): r.importance for r in html_extract.style_tree(df).collect()}
    assert min(v for k, v in tree.items() if k[0] == "h.org") == pytest.approx(0.0)
    assert html_extract.extract(df.filter("false")).count() == 0


def test_html_on_pages(spark, texts):
    for r in html_extract.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect():
        lines = r.text.split("\n")
        own = texts[int(re.search(r"/(\d+)", r.url.split("/", 3)[3])[1])]
        assert lines[1:] == [" ".join(x.split()) for x in own.split("\n") if x.strip()]


# SimHash


def brute_prints(text):
    low = text.translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(values, linked):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = list(values)
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_simhash_groups(spark, docs, texts, odd):
    prints = {i: brute_prints(t) for i, t in texts.items()}
    roots = components_of(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i in sorted(prints):
        first.setdefault(roots[prints[i]], i)
    for r in simhash.near_groups(docs).select("doc_id", simhash.hex_of().alias("hex"), "component_id").collect():
        assert (r.hex, r.component_id) == (f"{prints[r.doc_id]:016x}", first[roots[prints[r.doc_id]]])
    rows = simhash.near_groups(odd).collect()
    assert len(rows) == odd.count() and {r.component_id for r in rows if r.doc_id in (0, 1, 2, 3, 11)} == {0}
    assert simhash.near_groups(nothing(spark)).count() == 0


def test_links_of_crowded_fingerprints(spark, monkeypatch):
    """Many fingerprints around few centres: with hot buckets and without, the components are those of all pairs."""
    draw = random.Random(4)
    centres = [draw.getrandbits(64) for _ in range(6)]
    values = set()
    for c in centres:
        for _ in range(60):
            v = c
            for _ in range(draw.randint(0, 7)):
                v ^= 1 << draw.randrange(64)
            values.add(v)
    want = components_of(sorted(values), lambda a, b: (a ^ b).bit_count() <= 2)
    df = spark.createDataFrame([(pigeonhole.signed(v),) for v in values], "fp long")
    for hot in (64, 3):
        monkeypatch.setattr(pigeonhole, "HOT", hot)
        links = pigeonhole.near_links(df, 2).collect()
        assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in links)
        got = {r.node: r.root for r in components.components(pigeonhole.near_links(df, 2)).collect()}
        classes = defaultdict(set)
        for v in values:
            classes[got.get(pigeonhole.signed(v), pigeonhole.signed(v))].add(v)
        wanted = defaultdict(set)
        for v, r in want.items():
            wanted[r].add(v)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, wanted.values()))


def test_plan_radii_cover_all_pairs():
    draw = np.random.default_rng(2)
    sample = draw.integers(0, 2**63, 300, dtype=np.uint64)
    for distance in (0, 2, 4):
        plan = pigeonhole.choose_plan(sample, 10**6, distance)
        assert sum(plan.radii) == distance - len(plan.radii) + 1
        assert sum(plan.masks) == 2**64 - 1 and len(set(plan.masks)) == len(plan.masks)


def test_similar_groups(spark, odd):
    draw = random.Random(8)
    base = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, sets = [], {}
    for i in range(100):
        words = list(base)
        for k in range(0 if i % 9 == 0 else i % 9):
            words[draw.randrange(300)] = f"new{i}{k}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(draw.choice("abcdefgh") * 3 + str(draw.randrange(999)) for _ in range(50))) for i in range(20)] + [(300, rows[0][1].upper())]
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {" ".join(w[k : k + 5]) for k in range(len(w) - 4)}
    want = components_of([i for i, _ in rows], lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    got = {r.id: r.group_id for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got.get(i, i) for i, _ in rows} == want
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {None, 0, 4, 5}
    assert simhash.one_of_each(nothing(spark)).count() == 0


def sets_of_five(rows):
    out = {}
    for i, t in rows:
        w = t.lower().split()
        out[i] = {" ".join(w[k : k + 5]) for k in range(len(w) - 4)}
    return out


def alike(sets):
    return lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])


def test_crowded_buckets_meet_in_cells(spark):
    met = spark.createDataFrame([(b, i) for b, n in ((1, 50), (2, 3), (3, 1)) for i in range(n)], "bucket long, id long")
    cells = [r.asDict() for r in simhash.in_cells(met, 10).collect()]
    assert max(sum((r["bucket"], r["low"], r["high"]) == key for r in cells) for key in {(r["bucket"], r["low"], r["high"]) for r in cells}) < 50
    pairs = sorted((x["bucket"], x["id"], y["id"]) for x in cells for y in cells if all(x[c] == y[c] for c in ("bucket", "low", "high")) and x["id"] < y["id"] and (x["own"] or x["side"] != y["side"]))
    assert pairs == sorted((b, i, j) for b, n in ((1, 50), (2, 3)) for j in range(n) for i in range(j))


def test_similar_groups_of_long_texts(spark):
    """Scattered edits in texts of 2,000 to 20,000 words, at Jaccard similarities around 0.80 to 0.90."""
    draw = random.Random(3)
    vocabulary, weights = [f"w{k}" for k in range(5000)], [1 / (k + 1) for k in range(5000)]
    rows, pairs = [], []
    for size, n in ((2000, 20), (6000, 12), (20000, 4)):
        for _ in range(n):
            words = draw.choices(vocabulary, weights, k=size)
            share = draw.uniform(0.011, 0.023)
            edited = [draw.choices(vocabulary, weights)[0] if draw.random() < share else w for w in words]
            pairs.append((len(rows), len(rows) + 1))
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(edited))]
    sets = sets_of_five(rows)
    want = {p for p in pairs if alike(sets)(*p)}
    assert 20 < len(want) < len(pairs)
    got = {(r.group_id, r.id) for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.id != r.group_id}
    assert got == want, f"{len(got & want)} of {len(want)}"


def test_similar_groups_joined_by_a_chain(spark):
    """Two groups of 300 that only two members join, all in buckets of over 256."""
    base = [f"w{k}" for k in range(400)]

    def text(letter, n, own):
        return " ".join([*base, *[f"{letter}{k}" for k in range(n)], *own])

    rows = [(i, text("x", 80, [f"a{i}"])) for i in range(300)] + [(300 + i, text("y", 80, [f"b{i}"])) for i in range(300)] + [(700, text("x", 40, [])), (701, text("y", 40, []))]
    near = alike(sets_of_five(rows))
    assert near(700, 701) and all(near(700, i) and not near(701, i) and near(701, 300 + i) and not near(700, 300 + i) for i in range(300)) and not near(0, 300)
    got = {r.id: r.group_id for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), crowd=2).collect()}
    assert got == {i: 0 for i, _ in rows}


def test_similar_groups_of_short_texts(spark):
    """Four shingles against the same four and one more: exactly 0.8."""
    draw = random.Random(5)
    rows = []
    for i in range(0, 2000, 2):
        words = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(9)]
        rows += [(i, " ".join(words[:8])), (i + 1, " ".join(words))]
    got = {r.id: r.group_id for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), crowd=50).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}, f"{len(got) // 2} of 1000"


# Weighted sampling


def test_weighted_sampling(spark, docs, texts, odd):
    ids = sorted(texts, reverse=True)

    def likeness(a, b):
        x, y = (Counter(w for w in re.split(r"[\x20\x09-\x0d]+", t.lower()) if w) for t in (a, b))
        return sum((x & y).values()) / max(1, sum((x | y).values()))

    got = {r.doc_id: r for r in weighted_sampling.compare_edited(docs, samples=32).collect()}
    errors = []
    for i, nxt in zip(ids, [*ids[1:], ids[0]], strict=True):
        t, n = texts[i], len(texts[i]) // 2
        edited = t[: len(t) - n] + texts[nxt][:n]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        errors += [got[i].near_edited - likeness(t, edited), got[i].near_next - likeness(t, texts[nxt])]
        assert got[i].near_next == np.mean([a == b for a, b in zip(got[i].signature, got[nxt].signature, strict=True)])
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.1
    assert weighted_sampling.compare_edited(odd).count() == odd.count()
    assert weighted_sampling.compare_edited(nothing(spark)).count() == 0
    single = weighted_sampling.compare_edited(odd.filter("doc_id = 10")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
    prints = {r.doc_id: r.signature for r in weighted_sampling.fingerprint(odd, 8).collect()}
    assert prints[10] == prints[12] and len(prints[4]) == 8 and set(prints[0]) == {0}


# Personal data


BRUTE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BRUTE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_spans(spark, odd):
    draw = random.Random(6)
    parts = ["a@b.c", "é", "4111 1111-1111 1111", "1.2.3.4", "256.1.1.1", "+1 (017) 555-7713", "..", "@", "-", " ", "x_y%z", "0", "12", ".", "+", "4242424242424242", "a.b@c-d.e.f", "\n", "001.02.3.255", "🤖"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 14))) for _ in range(1500)] + ["1 2 " * 3000, "a@" + "b." * 3000, "9" * 30_000, "q" * 30_000, "1.2.3.4.5.6.7.8", "a@b.c_d@e.f"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("doc_id", pii.base_spans(F.col("text")).alias("s")).collect():
        assert [tuple(s) for s in r.s] == brute_spans(texts[r.doc_id]), texts[r.doc_id][:200]


def test_pii_candidates_stand_where_they_match(spark):
    iban = "DE89370400440532013000"
    row = spark.createDataFrame([(1, f"x{iban} and {iban} \x01 {iban} end")], "doc_id long, text string").select(F.col("text").alias("t"), pii.candidates(F.col("text")).alias("s")).first()
    found = [(s.start, s.end) for s in row.s if pii.KINDS[s.kind] == "iban"]
    assert found == [(m.start(), m.end()) for m in re.finditer(r"\b" + iban + r"\b", row.t)]


def test_pii_model(spark, docs, odd, texts):
    sample = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.fit(sample)
    found = pii.find(sample, model, keep=("doc_id", "text")).select("doc_id", "text", "_base", "_spans", pii.redacted(F.col("_text"), F.col("_spans")).alias("clean")).filter("size(_spans) > 0").collect()
    secrets = 0
    for r in found:
        assert set(map(tuple, r._base)) <= set(map(tuple, r._spans))
        secrets += sum(pii.KINDS[s.kind] == "secret" for s in r._spans)
        assert not brute_spans(r.clean)
        pieces, at = [], 0
        for s in r._spans:
            if s.start >= at:
                pieces += [r.text[at : s.start], f"<{pii.KINDS[s.kind].upper()}>"]
            at = max(at, s.end)
        assert r.clean == "".join(pieces) + r.text[at:]
    assert secrets
    # Values drawn with another seed: most personal ones go, few of those that only look like it.
    planter, kinds = planted.Planter(5), sorted(pii.GENERATORS)
    made = [(i, *planter.row(kinds[i // 2 % 5], i % 2 == 0, "plain words stand around a value of some kind")) for i in range(2000)]
    got = pii.find(spark.createDataFrame(made, "doc_id long, text string, s int, e int"), model, keep=("doc_id", "s", "e")).select("doc_id", "s", "e", "_spans").collect()
    covered = {k: [0, 0] for k in kinds}
    for r in got:
        hit = any(min(x.end, r.e) - max(x.start, r.s) >= 0.8 * (max(x.end, r.e) - min(x.start, r.s)) for x in r._spans)
        covered[kinds[r.doc_id // 2 % 5]][r.doc_id % 2] += hit
    assert all(good >= 140 and bad <= 20 for good, bad in covered.values()), covered
    iban = next(t for t in iter(lambda: planter.iban(True), None) if any(k == 2 for _, k, _ in brute_spans(t)))
    plain = [(1, "number 4465758382889438 in a row"), (2, f"IBAN {iban}, thanks"), (3, "2024-01-15 10:30, 1.234.567 and chapter_12_section_3")]
    spans = {r.doc_id: [tuple(s) for s in r._spans] for r in pii.find(spark.createDataFrame(plain, "doc_id long, text string"), model).collect()}
    assert covered["card"][0] and spans[1] == spans[3] == [] and (5, pii.KINDS.index("iban"), 5 + len(iban)) in spans[2]
    assert pii.find(odd, model).count() == odd.count()
    assert pii.find(odd, pii.fit(nothing(spark))).count() == odd.count()


# Lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_edit_distance(spark, threshold):
    draw = random.Random(threshold)
    pairs = []
    for i in range(400):
        a = "".join(draw.choice("abé") for _ in range(draw.randint(1, 20)))
        b = list(a)
        for _ in range(draw.randint(0, 5)):
            at = draw.randint(0, len(b))
            b[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "b"])
        pairs.append((i, -i, a, "".join(b) or "a"))
    got = {r.a: r.distance for r in line_dedup.with_distance(spark.createDataFrame(pairs, "a long, b long, line_a string, line_b string"), threshold).collect()}
    for i, _, a, b in pairs:
        d = distance(a, b)
        assert got.get(i) == (d if d <= threshold else None)


@pytest.mark.parametrize("crowd", [2_000, 2])
def test_line_classes(spark, odd, crowd):
    draw = random.Random(9)
    bases = ["".join(draw.choice("abcdefg ") for _ in range(draw.randint(20, 34))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(draw.randint(0, 6)):
            b = list(draw.choice(bases))
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                at = draw.randrange(len(b))
                b[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "y"])
            lines.append("".join(b))
        rows.append((i, "\n".join(lines)))
    places = [(i, no, t.strip(" ")) for i, text in rows for no, t in enumerate(text.split("\n")) if t.strip(" ")]
    first = {}
    for i, no, t in places:
        first.setdefault(t, (i, no))
    linked = lambda a, b: min(len(a), len(b)) >= 24 and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2
    names = sorted(first, key=first.get)
    degree = {t: sum(t != o and linked(t, o) for o in names) for t in names}
    root = components_of(names, linked)
    heads = {}
    for t in names:
        heads.setdefault(root[t], first[t])
    got = {(r.id, r.no): (r.class_id, r.class_no, r.n_links, r.kept) for r in line_dedup.line_classes(spark.createDataFrame(rows, "doc_id long, text string"), crowd=crowd).collect()}
    assert got == {(i, no): (*heads[root[t]], degree[t], heads[root[t]] == (i, no)) for i, no, t in places}
    kept = line_dedup.without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert line_dedup.without_repeats(nothing(spark)).count() == 0


def test_lines_that_many_share_a_third_with(spark):
    """A crowded segment: 400 lines share their first third, and only neighbours in a chain are within two edits."""
    draw = random.Random(2)
    head = "".join(draw.choice("abcdefgh ") for _ in range(40)).strip() + "x"
    lines = []
    for _ in range(200):
        tail = "".join(draw.choice("abcdefgh") for _ in range(80))
        lines += [head + tail, head + tail[:30] + "z" + tail[31:]]
    rows = [(i, t) for i, t in enumerate(lines)]
    got = line_dedup.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.id, r.class_id, r.n_links) for r in got} == {(i, i - i % 2, 1) for i in range(400)}


def test_crowded_keys_lose_no_link(spark):
    """Most of each line is common, the rest differs by up to three edits: narrower keys find what all pairs find."""
    draw = random.Random(12)
    head = "License text that all the files of a project begin with "
    tails = ["".join(draw.choice("abc") for _ in range(draw.randint(6, 12))) for _ in range(40)]
    lines = set()
    for _ in range(260):
        b = list(draw.choice([head + draw.choice(tails), draw.choice(tails) + head, head[:30] + draw.choice(tails) + head[30:]]))
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            at = draw.randrange(len(b))
            b[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "a"])
        lines.add("".join(b).strip())
    lines = sorted(lines)
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    own = line_dedup.lines_of(df, "doc_id", "text")
    hashes = {r.h: r.id for r in own.select("h", "id").collect()}
    want = {(i, j) for j in range(len(lines)) for i in range(j) if abs(len(lines[i]) - len(lines[j])) <= 2 and distance(lines[i], lines[j]) <= 2}
    keyed = line_dedup.with_keys(own, 2, 24)
    met = line_dedup.meetings(keyed, 2, 1000)
    texts = own.select("h", "line")
    for crowd in (3, 40):
        narrow = line_dedup.spread(met, texts, 2, 24, crowd)
        pairs = {tuple(sorted((hashes[r.a], hashes[r.b]))) for r in line_dedup.candidate_pairs(narrow, texts, 2).collect()}
        assert want <= pairs and len(want) > 100
    most = narrow.groupBy("key").count().agg(F.max("count")).first()[0]
    assert most <= 40 < met.groupBy("key").count().agg(F.max("count")).first()[0]


CONTRACTS = {
    "op1_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op3_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op4_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_weighted_sampling": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op8_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op9_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op10_html_extract": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_registered_queries_keep_their_contracts(spark, texts, name):
    got = queries.QUERIES[name](spark, SF)
    assert CONTRACTS[name].items() <= dict(got.dtypes).items()
    rows = got.collect()
    if name == "op10_html_extract":
        assert len(rows) == 50
    elif name == "op8_packing":
        assert {r.doc_id for r in rows} == set(texts)
    else:
        assert sorted(r.doc_id for r in rows) == sorted(texts)
    if name in ("op1_language_id", "op5_toxicity"):
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    if name == "op2_pii":
        for r in rows:
            spans = brute_spans(texts[r.doc_id])
            named = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
            assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest() and r.n_email == sum(k == 0 for _, k, _ in spans)
            assert set(named.split(",")) - {""} <= set(r.spans.split(","))


def test_components(spark):
    draw = random.Random(3)
    pairs = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)] + [(5, 5), (200, 199), (None, 1)]
    pairs += [(k, k + 1) for k in range(300, 340)]
    nodes = {x for p in pairs if None not in p for x in p}
    real = {frozenset(p) for p in pairs if None not in p}
    want = components_of(sorted(nodes), lambda a, b: frozenset((a, b)) in real)
    assert {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
