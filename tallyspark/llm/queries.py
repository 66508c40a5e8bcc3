"""The registered queries of this subpackage, over whole tables, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (
    alignment, classifier, fingerprints, fixity, langid, lines, neardups, packing, pieces, prefixes,
    quality, scoring, secrets,
)
from tallyspark.llm.shipping import ship
from tallyspark.session import stage_table


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/documents.parquet")


def _remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(_documents(spark, sf_dir), _remainder(7) == 2)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_identify(_documents(spark, sf_dir), _remainder(4) == 2)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardups.near_duplicates(_documents(spark, sf_dir))


def op8_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, against a replica that lost some and had some changed."""
    pages = ship(spark).read.parquet(f"{sf_dir}/pages.parquet")
    html = F.coalesce("html", F.lit(""))
    changed = F.when(F.col("page_id") % 101 == 3, F.concat(html, F.lit(" "))).when(
        F.col("page_id") % 97 == 5, F.translate(html, "e", "3")).otherwise(html)
    mine, theirs = (fixity.warc_record(F.col("page_id"), F.col("url"), x) for x in (html, changed))
    records = pages.select(
        "page_id", "url", F.octet_length(mine).cast("long").alias("length"),
        F.sha2(mine, 256).alias("digest"), F.octet_length(theirs).cast("long").alias("their_length"),
        F.sha2(theirs, 256).alias("their_digest"))
    placed = stage_table(fixity.layout(records, "page_id", "url", "digest"), "layout")
    replica = placed.filter(~F.coalesce(F.col("page_id") % 211 == 7, F.lit(False))).select(
        "file", "offset", F.col("their_length").alias("length"),
        F.col("their_digest").alias("digest"))
    return fixity.audit(placed.select("file", "offset", "length", "digest"), replica)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest_texts(_documents(spark, sf_dir), _tokenizer("piece_bpe_32k.model"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(_documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias(
        "n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(ship(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classifier.learn_and_score(docs, labels, _remainder(3) == 1)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"),
                           _tokenizer("piece_bpe_32k.model"))


QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_packing": op2_packing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_secret_scan": op6_secret_scan,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_fixity_audit": op8_fixity_audit,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_token_alignment": op13_token_alignment,
}

_RECORD = """concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10),
    'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10), 'WARC-Record-ID: <urn:page:',
    coalesce(CAST(page_id AS VARCHAR), ''), '>', chr(13), chr(10), 'Content-Type: text/html',
    chr(13), chr(10), 'Content-Length: ', strlen({0}), chr(13), chr(10), chr(13), chr(10), {0},
    chr(13), chr(10), chr(13), chr(10))"""

#: The CRC-32 of a decimal number's text, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(
    list_transform(string_split(CAST({0} AS VARCHAR), ''),
        lambda x: [CAST(ord(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: CASE WHEN xor(a, b) & 1 = 1 THEN xor(xor(a, b) >> 1, 3988292384)
        ELSE xor(a, b) >> 1 END))"""

ORACLE_SQL: dict[str, str] = {
    "op11_conversation_trie": f"""
WITH own AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), opened AS (
    SELECT conv_id, turns, {_CRC32.format("conv_id")} % 4 AS h FROM own
), rebuilt AS (
    SELECT o.conv_id, list_concat(
        list_slice(coalesce(b.turns, []), 1, h), list_slice(o.turns, h + 1, len(o.turns))) AS path
    FROM opened o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % {prefixes.FAMILY}
), members AS (
    SELECT conv_id, len(path) AS n_turns, unnest(range(len(path) + 1)) AS depth, path FROM rebuilt
), nodes AS (
    SELECT list_slice(path, 1, depth) AS prefix, depth, min(conv_id) AS conv_id,
        count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
            FILTER (n_turns = depth), '')) AS ends_sha256
    FROM members GROUP BY ALL
), children AS (
    SELECT list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n_children
    FROM nodes WHERE depth > 0 GROUP BY 1
), sized AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE
        (n_convs - 1) * len(regexp_extract_all(n.prefix[n.depth].text, '[^\\x20\\x09-\\x0D]+'))
        END AS saved
    FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix
), below AS (
    SELECT list_slice(prefix, 1, up) AS prefix, count(*) FILTER (n_children = 0) AS n_leaves,
        CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM sized) GROUP BY 1
)
SELECT s.conv_id, s.depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children, b.n_leaves,
    b.saved_tokens, s.ends_sha256
FROM sized s JOIN below b ON b.prefix = s.prefix
LEFT JOIN nodes p ON s.depth > 0 AND p.prefix = list_slice(s.prefix, 1, s.depth - 1)
""",
    "op8_fixity_audit": f"""
WITH bodies AS (
    SELECT page_id, url, coalesce(html, '') AS mine,
        CASE WHEN page_id % 101 = 3 THEN coalesce(html, '') || ' '
             WHEN page_id % 97 = 5 THEN replace(coalesce(html, ''), 'e', '3')
             ELSE coalesce(html, '') END AS theirs
    FROM pages
), records AS (
    SELECT page_id, url, {_RECORD.format("mine")} AS a, {_RECORD.format("theirs")} AS b FROM bodies
), hashed AS (
    SELECT page_id, strlen(a) AS length, sha256(a) AS digest, strlen(b) AS replica_length,
        sha256(b) AS replica_digest,
        row_number() OVER (ORDER BY page_id NULLS FIRST, url NULLS FIRST, sha256(a)) - 1 AS place
    FROM records
), placed AS (
    SELECT *, place // 1000 AS file, CAST(coalesce(sum(length) OVER (
        PARTITION BY place // 1000 ORDER BY place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
    FROM hashed
)
SELECT file, "offset", CASE WHEN page_id % 211 = 7 THEN 'lost' ELSE 'changed' END AS state,
    length, digest,
    CASE WHEN page_id % 211 = 7 THEN NULL ELSE replica_length END AS replica_length,
    CASE WHEN page_id % 211 = 7 THEN NULL ELSE replica_digest END AS replica_digest
FROM placed
WHERE page_id % 211 = 7 OR digest <> replica_digest
""",
}
