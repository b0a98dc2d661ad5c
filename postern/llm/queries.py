"""Registered queries of the operators, at production parameters over whole tables, and their SQL
where SQL can express the result (the others are tested against brute force in tests/llm)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postern.llm import (
    align,
    ann,
    licenses,
    mixture,
    packing,
    quality,
    secret_scan,
    sentencepieces,
    simhash,
    substrings,
    tokenbin,
    turns,
    warc,
)
from postern.llm.common import table
from postern.session import work_dir

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


def op4_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.resolved(warc.read_archives(spark, folder))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents")).drop("detections")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.find_near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "tokens")
    tokenbin.write_tokens(
        table(spark, sf_dir, "documents"), folder, WORD_TOKENIZER, "word", end_id=1, vocabulary=49_408
    )
    return tokenbin.read_tokens(spark, folder)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, "byte", end_id=2)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.count_links(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_MODEL)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damage(table(spark, sf_dir, "conversations")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_learned_partitions,
        op2_secret_scan,
        op3_source_mix,
        op4_repeated_substrings,
        op5_warc_round_trip,
        op6_license_scan,
        op7_simhash,
        op8_quality_rules,
        op9_token_files,
        op10_best_fit_packing,
        op11_token_alignment,
        op12_sentencepiece,
        op13_conversation_repair,
    )
}

# The kinds of secret_scan.RULES once more, spelled out for SQL: kind, pattern, group, least.
_SECRETS = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("google", r"AIza[A-Za-z0-9_-]{35,}", 0, 39),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}[.]eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}", 0, 38),
]
_MATCHES = " UNION ALL ".join(
    f"SELECT rid, {n} AS rule, '{kind}' AS kind, {least} AS least, "
    f"regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {group}) AS g, "
    f"string_split_regex(t, '{pattern}') AS b FROM d"
    for n, (kind, pattern, group, least) in enumerate(_SECRETS)
)
OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_MATCHES}),
one AS (
  SELECT rid, rule, kind, least, unnest(m) AS m, unnest(g) AS g, unnest(b[1:len(m)]) AS before,
    generate_subscripts(m, 1) AS i
  FROM found WHERE len(m) > 0
),
placed AS (
  SELECT *, sum(length(before) + length(m)) OVER (PARTITION BY rid, rule ORDER BY i) AS e FROM one
),
kept AS (
  SELECT rid, rule, kind, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e
  FROM placed WHERE length(g) >= least
),
listed AS (
  SELECT rid,
    count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access,
    count(*) FILTER (rule = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rule) FILTER (rule < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rule) AS spans
  FROM kept GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (rid)
"""

OP5_SQL = """
WITH d AS (
  SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS rid FROM pages
),
h AS (
  SELECT page_id, rid, octet_length(encode(html)) AS n, sha1(html) AS hex,
    max(page_id) OVER (PARTITION BY html) AS first,
    row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, rid) AS place
  FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1,
    1)), 'string_agg', '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place = 1 THEN NULL ELSE first END AS refers_to
FROM h
"""

OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents
),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
),
windows AS (
  SELECT rid, unnest(l) AS win, generate_subscripts(l, 1) AS i
  FROM (SELECT rid, list_transform(range(1, len(ws) - 1),
    lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS l FROM w WHERE len(ws) > 2)
),
repeated AS (
  SELECT rid, count(DISTINCT place) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM windows) WHERE c > 1)
  GROUP BY rid
),
c AS (
  SELECT rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN repeated USING (rid)
),
m AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [1000 * n_symbols // greatest(word_chars, 1), 1000 * n_dup_lines // greatest(n_lines, 1),
     1000 * n_repeat_words // greatest(n_words, 1), 100 * word_chars // greatest(n_words, 1)] AS v
  FROM c
),
sketch AS (
  SELECT lang, source, measure, (value >> k) << k AS value, count(*) AS n
  FROM (SELECT *, greatest(length(bin(value)) - 6, 0) AS k
    FROM (SELECT lang, source, unnest([1, 2, 3, 4]) AS measure, unnest(v) AS value
      FROM m WHERE NOT base_failed))
  GROUP BY ALL
),
levels AS (
  SELECT grouping_id(lang, source) AS level, lang, source, measure, value, sum(n) AS n
  FROM sketch GROUP BY GROUPING SETS ((lang, source, measure, value), (lang, measure, value), (measure, value))
),
quarters AS (
  SELECT level, lang, source, measure, max(total) AS n, min(value) FILTER (4 * upto >= total) AS q1,
    min(value) FILTER (2 * upto >= total) AS q2, min(value) FILTER (4 * upto >= 3 * total) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY value) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, measure) AS total FROM levels)
  GROUP BY level, lang, source, measure
),
fence AS (
  SELECT level, lang, source, measure, q2 + 4 * greatest(2 * (q2 - q1), [20, 90, 90, 150][measure]) AS most,
    CASE WHEN measure = 4 THEN q2 - 4 * greatest(2 * (q3 - q2), 60) ELSE -1 END AS least
  FROM quarters WHERE level = 3 OR n >= 50
),
beyond AS (
  SELECT DISTINCT rid
  FROM (SELECT rid, lang, source, unnest([1, 2, 3, 4]) AS measure, unnest(v) AS value FROM m) AS x
  JOIN fence ON x.measure = fence.measure AND (level = 3 OR x.lang IS NOT DISTINCT FROM fence.lang)
    AND (level > 0 OR x.source IS NOT DISTINCT FROM fence.source)
  WHERE value > most OR value < least
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rid NOT IN (SELECT rid FROM beyond) AS kept
FROM m
"""

ORACLE = {
    "op2_secret_scan": OP2_SQL,
    "op5_warc_round_trip": OP5_SQL,
    "op8_quality_rules": OP8_SQL,
}
