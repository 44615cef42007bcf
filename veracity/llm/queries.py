"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity.llm import (
    alignment,
    chat,
    exact_dedup,
    extract,
    fingerprint,
    jaccard,
    lines,
    mixing,
    packing,
    quality,
    toxicity,
    urls,
    whitening,
)
from veracity.plans.registry import table
from veracity.session import table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.col("failed").alias("failed_rules"))


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query
def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents"))


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.score(table(spark, sf_dir, "documents"))


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a file stream watches a folder: the table's file, or folder of files, is matched by a glob
    path = table_path(sf_dir, "documents*")
    return exact_dedup.dedup(spark, path).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


# DuckDB twins

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE["op3_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) AS n_lines,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '^\P{{Ll}}*\p{{Lu}}\P{{Ll}}*\p{{Lu}}\P{{Ll}}*$'))) AS n_capitals,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words
  FROM d LEFT JOIN cover c USING (doc_id)),
f AS (SELECT *, {" + ".join(f"CASE WHEN {r} THEN {quality.BITS[k]} ELSE 0 END" for k, r in quality.RULES.items())} AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {quality.mask("base")} <> 0 AS base_failed,
  failed & {quality.mask("base") | quality.mask(quality.CURRENT)} = 0 AS kept, failed::INT AS failed_rules
FROM f"""

ORACLE["op5_source_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS}) AS size, md5('42:' || doc_id::VARCHAR) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, ((rank - 1) % 3 + 1)::BIGINT AS weight FROM r),
l AS (
  SELECT *, coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
    sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
    sum(source_size) OVER () AS total FROM w),
v AS (SELECT *, (total - 3 * b)::DOUBLE / rest::DOUBLE AS level FROM l),
u AS (SELECT *, coalesce((SELECT arg_min(level, (source_size / weight, rank)) FROM v WHERE 3 * source_size > weight * level), 0.0) AS top FROM v),
t AS (SELECT source, rank, source_size, least(3.0 * source_size, weight * top)::DOUBLE AS target FROM u),
b1 AS (SELECT *, greatest(1, least(1024, source_size // 256)) AS block_len FROM t WHERE source_size > 0),
b2 AS (SELECT *, (source_size + block_len - 1) // block_len AS n_blocks FROM b1),
b3 AS (SELECT *, target * n_blocks / source_size AS slots FROM b2),
b4 AS (SELECT *, sum(slots) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS upto FROM b3),
b5 AS (SELECT *, max(upto) OVER () AS total FROM b4),
b6 AS (SELECT *, CASE WHEN rank = max(rank) OVER () THEN {mixing.SPAN} ELSE floor(upto / total * {mixing.SPAN})::BIGINT END AS hi FROM b5),
b7 AS (SELECT *, coalesce(lag(hi) OVER (ORDER BY rank), 0) AS lo FROM b6),
k AS (SELECT k, (k * {mixing.STEP}) % {mixing.SPAN} AS point FROM (SELECT unnest(range((SELECT ceil(max(total))::BIGINT FROM b5))) AS k)),
p AS (SELECT rank, n_blocks, row_number() OVER (PARTITION BY rank ORDER BY k) - 1 AS n FROM k JOIN b7 ON point >= lo AND point < hi),
times AS (SELECT rank, n % n_blocks AS block, count(*) AS times FROM p WHERE n < 3 * n_blocks GROUP BY ALL),
x AS (
  SELECT doc_id, size, t.rank, t.source_size, t.target,
    sum(size) OVER (PARTITION BY t.rank ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
y AS (
  SELECT x.*, block_len, unnest(range((start // block_len)::BIGINT, ((start + size - 1) // block_len + 1)::BIGINT)) AS block
  FROM x JOIN b2 USING (rank) WHERE size > 0),
z AS (
  SELECT doc_id, start, rank, sum((least(start + size, (y.block + 1) * block_len) - greatest(start, y.block * block_len)) * coalesce(times, 0)) AS taken
  FROM y LEFT JOIN times USING (rank, block) GROUP BY ALL)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM x LEFT JOIN z USING (doc_id, start, rank)"""

ORACLE["op9_ngram_jaccard_join"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON reach.r = edge.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r) AS component_id
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY ALL"""

ORACLE["op13_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
