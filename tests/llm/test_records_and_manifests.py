"""WARC bundles, spelling variants and the Merkle manifest: brute force, round trips, and odd rows."""

import base64
import hashlib
import random
import struct
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from loomwright.llm import merkle, queries, variants, warc

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# WARC


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h{i % 3}/{i} x", f"<p>page {i}</p>" * (1 + i % 5)) for i in range(60)]
    rows += [(100, "http://a\r\nX: y", rows[7][2]), (101, None, rows[7][2]), (2, "http://again", rows[7][2]), (None, "u", rows[7][2]), (102, "u", None), (103, "u", ""), (104, "u", "é🤖" * 3000)]
    rows += [(105, "u", "WARC/1.1\r\n\r\n"), (None, "v", "only null ids"), (None, "v", "only null ids"), (106, "same", "twice"), (106, "same", "twice"), (107, "same", "twice")]
    return spark.createDataFrame(rows, PAGES).withColumn("keep", F.lit("clash")).withColumn("_n", F.lit(1)).repartition(3)


def base32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_archives_read_back(spark, pages, tmp_path):
    index = warc.write_archives(pages, f"file://{tmp_path}/w", frame_bytes=2000, bundle_bytes=1500)
    found = warc.read_archives(index).collect()
    rows = pages.collect()
    assert len(found) == len(rows) == index.count()
    payload = lambda r: (r.html or "").encode()
    ids = {}
    for r in rows:
        ids.setdefault(payload(r), []).append(r.page_id)
    want = []
    for r in rows:
        known = [i for i in ids[payload(r)] if i is not None]
        first = min(known) if known else None
        copy = first is not None and r.page_id != first
        want.append((r.page_id, "revisit" if copy else "response", first if copy else None, base32(payload(r)), len(payload(r)), None if copy else payload(r)))
    number = lambda t: None if t is None else int(t)
    got = [(number(r.id), r.record_type, number(r.refers_to), r.payload_digest, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r.url for r in found if r.id == "100"} == {"http://a%0D%0AX:%20y"} and {r.url for r in found if r.id == "101"} == {None}


def test_records_by_place(spark, pages, tmp_path):
    index = warc.write_archives(pages, f"file://{tmp_path}/w", frame_bytes=2000, bundle_bytes=1500)
    some = index.filter("record_type = 'response' AND length % 3 = 0")
    assert some.count() > 5
    whole = {(r.bundle, r.frame, r.at): r for r in warc.read_archives(index).collect()}
    for r in warc.read_records(some).collect():
        assert r == whole[r.bundle, r.frame, r.at]
    places = {(r.bundle, r.frame, r.at): (r.record_id, r.length) for r in index.collect()}
    assert places == {k: (r.record_id, r.length) for k, r in whole.items()}
    # A frame is a little over its size at most when one record is; a bundle has several frames.
    assert max(r.frame for r in whole.values()) >= 1


def test_bundles_are_seekable_zstandard(spark, pages, tmp_path):
    index = warc.write_archives(pages, f"file://{tmp_path}/w", frame_bytes=2000)
    total = 0
    for r in index.select("bundle").distinct().collect():
        data = open(r.bundle.removeprefix("file://"), "rb").read()
        # Any Zstandard reader skips the table.
        text = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        total += text.count(b"WARC-Type: ")
        frames, flags, magic = struct.unpack("<IBI", data[-9:])
        assert (flags, magic) == (0, 0x8F92EAB1)
        sizes = [struct.unpack_from("<II", data, len(data) - 9 - 8 * frames + 8 * k) for k in range(frames)]
        assert struct.unpack_from("<II", data, len(data) - 17 - 8 * frames) == (0x184D2A5E, 9 + 8 * frames)
        assert sum(b for _, b in sizes) == len(text) and sum(a for a, _ in sizes) == len(data) - 17 - 8 * frames
        at = 0
        for packed, size in sizes:
            assert len(zstandard.ZstdDecompressor().decompress(data[at : at + packed])) == size
            at += packed
    assert total == pages.count()


def test_small_payloads_are_no_revisits(spark, pages, tmp_path):
    index = warc.write_archives(pages, f"file://{tmp_path}/w", least_bytes=10_000)
    assert {r.record_type for r in index.collect()} == {"response"}
    assert warc.write_archives(pages.limit(0), f"file://{tmp_path}/none").count() == 0
    assert warc.read_archives(index.limit(0)).count() == 0


def test_damage_is_an_error(spark, tmp_path):
    index = warc.write_archives(spark.createDataFrame([(1, "u", "abc" * 50)], PAGES), f"file://{tmp_path}/w")
    path = index.first().bundle.removeprefix("file://")
    data = warc.record("<urn:page:1>", "u", b"abc", None, "2024-01-01T00:00:00Z")
    assert warc.parsed(data, 0)[0]["payload"] == b"abc"
    with pytest.raises(ValueError, match="differs"):
        warc.parsed(data.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"), 0)
    open(path, "wb").write(open(path, "rb").read()[:-1])
    with pytest.raises(Exception, match="seek table|unpack"):
        warc.read_archives(index).collect()


# Spelling variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words, times=5):
    out = {}
    for w, n in words.items():
        friends = [(-words[o], o) for o in words if near(w, o)]
        best = min(friends, default=None)
        form = best[1] if best and -best[0] >= times * n else None
        out[w] = [form, None, n, len(friends), words[form] if form else None]
    for w in out:
        end = w
        while out[end][0]:
            end = out[end][0]
        out[w][1] = end
    return {w: tuple(v) for w, v in out.items()}


@pytest.mark.parametrize(("letters", "sizes", "count"), [("ab", (1, 7), 200), ("abcd", (3, 9), 500), ("aé🤖z", (1, 30), 300)])
def test_groups_equal_all_pairs(spark, letters, sizes, count):
    draw = random.Random(len(letters) + count)
    words = {}
    while len(words) < min(count, 200 if letters == "ab" else count):
        w = "".join(draw.choice(letters) for _ in range(draw.randint(*sizes)))
        for _ in range(draw.randrange(4)):
            i = draw.randrange(len(w) + 1)
            v = draw.choice([w[:i] + draw.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + draw.choice(letters) + w[i + 1 :]])
            if v:
                words[v] = draw.choice([5, 6, 25, 30, 125, 700])
        words[w] = draw.choice([5, 6, 25, 30, 125, 700])
    df = spark.createDataFrame(list(words.items()), "word string, n long").withColumn("size", F.lit("clash"))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.grouped(df).collect()}
    assert got == brute_groups(words)


def test_crowded_group_is_cut_in_blocks(spark):
    words = {f"commonbegin{a}{b}{c}": 5 + (a == b == c == "a") * 100 for a in "abcdefghijkl" for b in "abcdefghijkl" for c in "abcdefghijkl"}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert variants.tiles(df).select("tile").distinct().count() > 10
    got = {r.word: (r.form, r.n_near) for r in variants.grouped(df).collect()}
    assert got == {w: ("commonbeginaaa" if sum(x == "a" for x in w[-3:]) == 2 else None, 33) for w in words}


def test_words_of(spark):
    docs = [(i, t) for i, t in enumerate([None, "", "12 !", "Straße STRASSE Éclair éclair ÷÷÷÷÷÷ 字字字字字字", "wonderful Wonderful_wonderful wonderful's"] * 40)] + [(None, "wonderful " * 50), (5, "x" * 100_000)]
    got = {r.word: r.n for r in variants.words_of(spark.createDataFrame(docs, "doc_id long, text string").withColumn("run", F.lit(1))).collect()}
    import re
    from collections import Counter

    want = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    assert got == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert variants.grouped(spark.createDataFrame([], "word string, n long")).count() == 0
    odd = spark.createDataFrame([("", 9), (None, 9), ("a", 5)], "word string, n long")
    assert sorted((r.word or "", r.n_near) for r in variants.grouped(odd).collect()) == [("", 0), ("", 0), ("a", 0)]


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def way_up(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        yield run[: i % 8], run[i % 8 + 1 :]
        i //= 8


def brute_manifest(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    trees = {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for k, v in trees.items()}
    levels = {k: levels_of([leaf_of(r) for r in v]) for k, v in trees.items()}
    names = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    top = levels_of([levels[k][-1][0] for k in names])
    for j, k in enumerate(names):
        for i, r in enumerate(trees[k]):
            path = [*way_up(levels[k], i), *way_up(top, j)]
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf_of((r[0], text, *r[2:]))
            for left, right in path:
                folded = sha(*left, folded, *right)
            yield r[0], leaf_of(r), levels[k][-1][0], top[-1][0], sha(*[x for left, right in path for x in left + right]), folded, folded == top[-1][0]


@pytest.mark.parametrize(("count", "langs", "climb"), [(1, 1, 4), (9, 1, 4), (300, 12, 1), (150, 100, 2), (5000, 2, 4)])
def test_manifest_equals_recursion(spark, count, langs, climb):
    draw = random.Random(count)
    texts = [None, "", "Ab C é", "x" * 3000, "lower"]
    rows = [(draw.choice([None, i, i // 2, i, i]), draw.choice(texts), draw.choice([None, *[f"l{k}" for k in range(langs)]]), draw.choice([None, "s", "12:x"]), draw.choice([None, 5])) for i in range(count)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, DOCS).withColumn("tree", F.lit("clash")).withColumn("pos", F.lit(0))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.lower_cased(F.col("text"))).otherwise(F.col("text"))
    got = [tuple(r) for r in merkle.manifest(df, {"text": tampered}, climb=climb).collect()]
    assert sorted(got, key=str) == sorted(brute_manifest(rows), key=str)


def test_sweeps(spark):
    for nodes, most, climb in [(1, 1, 4), (1, 9, 1), (64, 64, 2), (65, 65, 4), (8, 64, 1), (4096, 9000, 4), (3, 9000, 4)]:
        digests = [sha(str(i)) for i in range(nodes)]
        root, runs = merkle.forward(digests, most, climb)
        for digest, path in zip(digests, merkle.backward(runs, nodes, most, climb, None), strict=True):
            assert merkle.fold(path, digest)[1] == root
    assert merkle.manifest(spark.createDataFrame([], DOCS), {}).count() == 0


def test_new_queries(spark):
    want = {"op11_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], "op12_variants": ["word", "form", "root", "n", "n_near", "form_n"], "op13_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]}
    for name, columns in want.items():
        got = queries.QUERIES[name](spark, SF)
        assert got.columns == columns and got.count() > 0
