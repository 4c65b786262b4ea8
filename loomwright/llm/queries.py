"""The registered queries of this subpackage, over the tables of one folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, html_extract, language_id, line_dedup, merkle, packing, pii, simhash, toxicity, variants, warc, weighted_sampling
from .shared import held_out, remove, saved, scratch_dir, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    counts = [pii.counted("_base", kind).alias(f"n_{kind}") for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.joined("_base"), 256).alias("base_sha256"), pii.joined("_spans").alias("spans"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.score(docs, toxicity.fit(docs, labels, "doc_id", "text", "toxic"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weighted_sampling.compare_edited(table(spark, sf_dir, "documents"), samples=32)
    hexes = [weighted_sampling.as_hex(F.col(a)).alias(b) for a, b in (("signature", "fingerprint"), ("edited_signature", "edited_fingerprint"))]
    return found.select("doc_id", "n_chars", "edited_sha256", *hexes, "near_edited", "near_next")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("no").alias("line_no"), F.col("class_id").alias("class_doc_id"), F.col("class_no").alias("class_line_no"), "n_links", "kept"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_digests(docs, path, public_tokenizers.PATTERN)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per page is written and all are read back; the archives go when the facts are written."""
    pages, folder = table(spark, sf_dir, "pages"), scratch_dir(spark)
    kind = pages.schema["page_id"].dataType
    read = warc.read_archives(warc.write_archives(pages, folder), payloads=False)
    facts = read.select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
    facts = saved(facts)
    remove(spark, folder)
    return facts


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(variants.words_of(table(spark, sf_dir, "documents")))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.lower_cased(F.col("text"))).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), {"text": tampered})


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_pii": op2_pii,
    "op3_simhash": op3_simhash,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_weighted_sampling": op6_weighted_sampling,
    "op7_line_dedup": op7_line_dedup,
    "op8_packing": op8_packing,
    "op9_bpe": op9_bpe,
    "op10_html_extract": op10_html_extract,
    "op11_warc": op11_warc,
    "op12_variants": op12_variants,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL = {
    "op4_exact_dedup": """
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents
        ), g AS (
            SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
        )
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept,
            sha256(t.norm) AS text_sha256
        FROM t JOIN g ON t.norm = g.norm
    """,
    "op11_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
            FROM pages
        ), digits AS (
            SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT)) AS fives FROM p
        )
        SELECT page_id, payload_bytes,
            list_reduce(list_transform(range(32), lambda i:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((fives[CAST(i // 4 + 1 AS BIGINT)] >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), lambda a, b: a || b) AS payload_digest,
            CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
        FROM digits
    """,
    "op12_variants": """
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS t
        ), runs AS (
            SELECT doc_id, run, count(*) AS times FROM (
                SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
                FROM documents
            ) GROUP BY doc_id, run
        ), hashed AS (
            SELECT run, times, length(run) AS len, xor(list_reduce(
                list_transform(range(octet_length(encode(doc_id || ':' || run))), lambda i: CAST('0x' || substr(hex(encode(doc_id || ':' || run)), CAST(2 * i AS BIGINT) + 1, 2) AS BIGINT)),
                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS h
            FROM runs, crc_table
        ), words AS (
            SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
                SELECT times, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % len AS BIGINT)) || substr(run, CAST(h % len AS BIGINT) + 2) ELSE run END AS word FROM hashed
            ) WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
        ), cuts AS (
            SELECT word, n, i, substr(word, 1, CAST(i AS BIGINT)) || substr(word, CAST(i AS BIGINT) + 2) AS rest
            FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
        ), near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION
            SELECT a.word, w.word, w.n FROM cuts a JOIN words w ON a.rest = w.word
            UNION
            SELECT w.word, a.word, a.n FROM cuts a JOIN words w ON a.rest = w.word
        ), best AS (
            SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n,
                row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near
        ), forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
            FROM words w LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON w.word = b.word
        ), ends AS (
            SELECT word, word AS root FROM forms WHERE form IS NULL
            UNION ALL
            SELECT f.word, e.root FROM forms f JOIN ends e ON f.form = e.word
        )
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
    """,
    "op13_merkle": """
        WITH RECURSIVE crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS t
        ), read AS (
            SELECT d.*, row_number() OVER () AS row,
                CASE WHEN xor(list_reduce(list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS BIGINT) + 1, 1)) AS BIGINT)),
                    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) % 3 = 0
                THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
            FROM documents d, crc_table
        ), fields AS (
            SELECT *, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
                || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head FROM read
        ), leaves AS (
            SELECT row, doc_id, coalesce('=' || lang, '-') AS tree, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                sha256(head || coalesce(octet_length(encode(other)) || ':' || other, '-')) AS changed FROM fields
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves
        ), up AS (
            SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed
            UNION ALL
            SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, level, pos // 8, n
        ), subroots AS (
            SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
        ), top AS (
            SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
            UNION ALL
            SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 8, n
        ), runs AS (
            SELECT tree, level, pos // 8 AS above, list(digest ORDER BY pos) AS run FROM up WHERE n > 1 GROUP BY tree, level, pos // 8
        ), top_runs AS (
            SELECT level, pos // 8 AS above, list(digest ORDER BY pos) AS run FROM top WHERE n > 1 GROUP BY level, pos // 8
        ), folds AS (
            SELECT row, tree, 0 AS level, pos, '' AS siblings, changed AS digest FROM placed
            UNION ALL
            SELECT row, f.tree, f.level + 1, pos // 8,
                siblings || array_to_string(run[:pos % 8], '') || array_to_string(run[pos % 8 + 2:], ''),
                sha256(array_to_string(run[:pos % 8], '') || digest || array_to_string(run[pos % 8 + 2:], ''))
            FROM folds f JOIN runs r ON f.tree = r.tree AND f.level = r.level AND f.pos // 8 = r.above
        ), in_tree AS (
            SELECT row, f.tree, siblings, digest FROM folds f JOIN (SELECT tree, max(level) AS level FROM up GROUP BY tree) h ON f.tree = h.tree AND f.level = h.level
        ), top_folds AS (
            SELECT row, 0 AS level, s.pos, siblings, digest FROM in_tree t JOIN subroots s ON t.tree = s.tree
            UNION ALL
            SELECT row, f.level + 1, pos // 8,
                siblings || array_to_string(run[:pos % 8], '') || array_to_string(run[pos % 8 + 2:], ''),
                sha256(array_to_string(run[:pos % 8], '') || digest || array_to_string(run[pos % 8 + 2:], ''))
            FROM top_folds f JOIN top_runs r ON f.level = r.level AND f.pos // 8 = r.above
        ), done AS (
            SELECT row, sha256(siblings) AS proof_sha256, digest AS folded_root FROM top_folds WHERE level = (SELECT max(level) FROM top)
        )
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
        FROM placed JOIN subroots USING (tree) JOIN done USING (row), (SELECT digest AS root FROM top WHERE n = 1)
    """,
}
