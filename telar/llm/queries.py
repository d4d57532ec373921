"""The queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import extraction, interpolation, language, licenses, mpeg, periodic, simhash, sstable, toxicity, variants, warc, wfst, wumanber
from .common import table, written


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(table(spark, sf_dir, "pages"))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg.media_features(written(mpeg.to_media(table(spark, sf_dir, "documents")), "media"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(table(spark, sf_dir, "pages"), min_bytes=1000)
    return warc.read(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.read_shards(sstable.write_shards(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.scores(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wumanber.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wfst.report(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def tail_repeated(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Of one document in ten (by the hash of its identifier), the words from some place on repeat with a period; a null identifier changes nothing."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"), before=tail_repeated)


def letter_lost(doc_id: int | None, word: str) -> str:
    """One word of a document in 199 (by the hash of both) loses a letter; a null identifier changes nothing."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if doc_id is None or h % 199:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(variants.counted(table(spark, sf_dir, "documents"), change=letter_lost))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_licenses": op2_licenses,
    "op3_extraction": op3_extraction,
    "op4_media": op4_media,
    "op5_warc": op5_warc,
    "op6_token_ids": op6_token_ids,
    "op7_language_model": op7_language_model,
    "op8_decontamination": op8_decontamination,
    "op9_simhash": op9_simhash,
    "op10_pieces": op10_pieces,
    "op11_language": op11_language,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {
    "op5_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < max(page_id) OVER (PARTITION BY d) THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < max(page_id) OVER (PARTITION BY d) THEN max(page_id) OVER (PARTITION BY d) END AS refers_to
        FROM p""",
    "op8_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
        w AS (SELECT DISTINCT item_id, least(len(ws), 10) AS l, array_to_string(ws[i:i + 9], ' ') AS g FROM (SELECT item_id, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM b WHERE len(ws) > 0)),
        g AS (SELECT doc_id, i, l, array_to_string(ws[i:i + l - 1], ' ') AS g FROM (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM w) WHERE len(ws) >= l)),
        h AS (SELECT doc_id, i, l, item_id FROM g JOIN w USING (l, g)),
        n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM h) GROUP BY 1),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)""",
}
