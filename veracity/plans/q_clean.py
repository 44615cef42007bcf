"""Driver queries for ingest cleaning, audits and checks (phase 2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.functions.text import format_duration, safe_float
from veracity.operators import clean as K
from veracity.plans.registry import query, table
from veracity.plans.sqlparts import WS_SQL
from veracity.schema import LABEL_ALIASES

def strip_sql(x: str) -> str:
    """DuckDB twin of ``py_strip``."""
    return "regexp_replace(" + x + ", '^[" + WS_SQL + "]+|[" + WS_SQL + "]+$', '', 'g')"


def _alias_lists():
    out = {"real": [], "fake": [], "satire": []}
    for k, v in LABEL_ALIASES.items():
        out[v].append(k)
    return out


def raw_articles(spark, sf_dir):
    """Documents with a raw label string spelled by one of its aliases (varied case and
    padding), the source as group and the document id as string id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    cls = F.when(F.col("toxic") == 1, "satire").when(F.col("quality") == 1, "real").when(
        F.col("quality").isNotNull(), "fake")
    lists = _alias_lists()
    pick = F.col("doc_id") % 4
    raw = F.lit(None).cast("string")
    for c, names in lists.items():
        arr = F.array(*[F.lit(n) for n in names])
        raw = F.when(cls == c, F.element_at(arr, (pick % len(names)).cast("int") + 1)).otherwise(raw)
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("  "), F.upper(raw), F.lit(" "))).otherwise(raw)
    return j.select(F.col("doc_id").cast("string").alias("id"), "doc_id", "text", raw.alias("label"),
                    F.col("source").alias("group_id"))


LABELS_SQL = "CASE WHEN l.toxic = 1 THEN 'satire' WHEN l.quality = 1 THEN 'real' WHEN l.quality IS NOT NULL THEN 'fake' END"


@query("clean_articles", f"""
SELECT d.doc_id, {LABELS_SQL} AS label_norm,
       CASE WHEN l.toxic = 1 OR l.quality <> 1 THEN 1 WHEN l.quality = 1 THEN 0 END AS suspicious_target,
       CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality <> 1 THEN 0 ELSE -1 END AS stage2_target,
       length({strip_sql('d.text')}) AS text_len, d.source AS group_id
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE length({strip_sql('d.text')}) > 0
""")
def q_clean_articles(spark, sf_dir):
    a = K.with_labels(K.clean_text(raw_articles(spark, sf_dir)))
    return a.select("doc_id", "label_norm", "suspicious_target", "stage2_target",
                    F.length("text").cast("bigint").alias("text_len"), "group_id")


@query("title_merge", f"""
WITH t AS (SELECT conv_id, max(text) FILTER (WHERE turn = 0) AS title FROM conversations GROUP BY conv_id),
a AS (SELECT c.conv_id, c.turn, t.title, CASE WHEN c.turn = 0 THEN NULL ELSE c.text END AS body
      FROM conversations c LEFT JOIN t ON t.conv_id = c.conv_id)
SELECT conv_id, turn,
  md5({strip_sql(strip_sql("coalesce(title, '')") + " || chr(10) || " + strip_sql("coalesce(body, '')"))}) AS digest,
  length({strip_sql(strip_sql("coalesce(title, '')") + " || chr(10) || " + strip_sql("coalesce(body, '')"))}) AS n_chars
FROM a
""")
def q_title_merge(spark, sf_dir):
    """Every turn is an article; the first turn of its conversation is the title."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    t = c.where("turn = 0").groupBy("conv_id").agg(F.max("text").alias("title"))
    a = c.join(t, "conv_id", "left").withColumn("text", F.when(F.col("turn") == 0, None).otherwise(F.col("text")))
    m = K.merge_title(a)
    return m.select("conv_id", "turn", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("n_chars"))


@query("row_key", """
SELECT doc_id, row_number() OVER (ORDER BY md5('42' || ':' || doc_id)) - 1 AS row_key,
       printf('news-%07d', row_number() OVER (ORDER BY md5('42' || ':' || doc_id))) AS id
FROM documents
""")
def q_row_key(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string")))
                                                 .alias("o"))
    k = K.with_row_key(d, ["o"])
    k = k.withColumn("id", F.format_string("news-%07d", F.col("row_key") + 1))
    return k.select("doc_id", "row_key", "id")


SCORE_SQL = "c_acctbal / 10000"


def _cust_score(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", (F.col("c_acctbal") / 10000).alias("s"),
                                                   "c_acctbal")


for _pol, _expr in (("missing", f"CASE WHEN {SCORE_SQL} < 0 THEN NULL ELSE {SCORE_SQL} END"),
                    ("zero", f"CASE WHEN {SCORE_SQL} < 0 THEN 0.0 ELSE {SCORE_SQL} END"),
                    ("rescale", f"({SCORE_SQL} + 1.0) / 2.0")):
    def _mk(pol):
        name = "rescale_minus1_1" if pol == "rescale" else pol

        def run(spark, sf_dir):
            s = _cust_score(spark, sf_dir)
            return s.select("c_custkey", K.negative_policy("s", name).alias("score"))
        return run
    query(f"negative_policy_{_pol}", f"SELECT c_custkey, CAST({_expr} AS DOUBLE) AS score FROM customer")(
        _mk(_pol))


@query("negative_audit", """
SELECT c_acctbal, count(*) AS n FROM customer WHERE c_acctbal < 0 GROUP BY c_acctbal
""")
def q_negative_audit(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    return c.groupBy("c_acctbal").agg(F.count(F.lit(1)).alias("n")).orderBy("c_acctbal")


@query("negative_audit_by_label", """
SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal < 0 GROUP BY c_mktsegment
""")
def q_negative_audit_by_label(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    return K.value_counts(c, "c_mktsegment")


@query("negative_sample", """
SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 50
""")
def q_negative_sample(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    return c.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy("c_custkey").limit(50)


@query("negative_repair", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer
""")
def q_negative_repair(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", K.negative_policy("c_acctbal", "zero").alias("c_acctbal"))


RANGE_COLS = {
    "balance_share": "c_acctbal / 10000",
    "nation_share": "c_nationkey / 20",
}


@query("range_check", """
WITH s AS (SELECT c_custkey, c_acctbal / 10000 AS balance_share, c_nationkey / 20 AS nation_share FROM customer),
b AS (SELECT 'balance_share' AS col, c_custkey FROM s WHERE balance_share < 0 OR balance_share > 1
      UNION ALL SELECT 'nation_share', c_custkey FROM s WHERE nation_share < 0 OR nation_share > 1),
c AS (SELECT * FROM (VALUES ('balance_share'), ('nation_share')) t(col))
SELECT c.col AS "column", count(b.c_custkey) AS bad_rows,
       coalesce((SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM
                 (SELECT c_custkey AS k FROM b b2 WHERE b2.col = c.col ORDER BY c_custkey LIMIT 10)), '') AS sample
FROM c LEFT JOIN b ON b.col = c.col GROUP BY c.col
""")
def q_range_check(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 10000).alias("balance_share"), (F.col("c_nationkey") / 20).alias("nation_share"))
    return K.check_range(c, ["balance_share", "nation_share"], "c_custkey")


@query("validate", f"""
WITH a AS (
  SELECT d.doc_id, d.text, {LABELS_SQL} AS label_norm, (d.n_chars % 113) / 100 AS emotion_score
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
r AS (
  SELECT 'blank_text' AS rule, doc_id FROM a WHERE text IS NULL OR {strip_sql('text')} = ''
  UNION ALL SELECT 'unknown_label', doc_id FROM a WHERE label_norm IS NULL
  UNION ALL SELECT 'emotion_score_out_of_range', doc_id FROM a WHERE emotion_score < 0 OR emotion_score > 1),
names AS (SELECT * FROM (VALUES ('blank_text'), ('unknown_label'), ('emotion_score_out_of_range')) t(rule))
SELECT names.rule, count(r.doc_id) AS bad_rows,
  coalesce((SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM
            (SELECT doc_id AS k FROM r r2 WHERE r2.rule = names.rule ORDER BY doc_id LIMIT 10)), '') AS sample
FROM names LEFT JOIN r ON r.rule = names.rule GROUP BY names.rule
""")
def q_validate(spark, sf_dir):
    a = K.with_labels(raw_articles(spark, sf_dir))
    d = table(spark, sf_dir, "documents").select("doc_id", ((F.col("n_chars") % 113) / 100).alias("emotion_score"))
    a = a.join(d, "doc_id")
    return K.validate(a, K.article_rules(a), "doc_id")


@query("value_counts", f"""
SELECT {LABELS_SQL} AS label_norm, count(*) AS n FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
GROUP BY 1
""")
def q_value_counts(spark, sf_dir):
    a = K.with_labels(raw_articles(spark, sf_dir))
    return K.value_counts(a, "label_norm", dropna=False)


@query("duplicate_ids", """
SELECT md5(text) AS text_md5, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1
""")
def q_duplicate_ids(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.md5("text").alias("text_md5"))
    return K.duplicate_keys(d, "text_md5")


@query("class_counts", f"""
SELECT {LABELS_SQL} AS label_norm, count(*) AS n, count(DISTINCT d.source) AS n_groups
FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1
""")
def q_class_counts(spark, sf_dir):
    a = K.with_labels(raw_articles(spark, sf_dir)).where(F.col("label_norm").isNotNull())
    return a.groupBy("label_norm").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("group_id").alias("n_groups"))


@query("durations", """
SELECT event_id,
  CASE WHEN (value - 10) * 37.3 < 0 THEN '--:--:--' ELSE
    printf('%02d:%02d:%02d', CAST(round_even((value - 10) * 37.3, 0) AS BIGINT) // 3600,
           (CAST(round_even((value - 10) * 37.3, 0) AS BIGINT) % 3600) // 60,
           CAST(round_even((value - 10) * 37.3, 0) AS BIGINT) % 60) END AS duration
FROM events
""")
def q_durations(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", format_duration((F.col("value") - 10) * 37.3).alias("duration"))


@query("safe_float", """
SELECT event_id,
  CASE event_id % 5
    WHEN 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE)
    WHEN 1 THEN CAST(json_extract_string(props, '$.k') || '0' AS DOUBLE)
    WHEN 2 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) + 0.5
    ELSE NULL END AS value
FROM events
""")
def q_safe_float(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    m = F.col("event_id") % 5
    raw = (F.when(m == 0, k).when(m == 1, F.concat(k, F.lit("_0")))
           .when(m == 2, F.concat(F.lit(" \u3000"), k, F.lit(".5 "))).when(m == 3, F.concat(k, F.lit("d")))
           .otherwise(F.concat(F.lit("x"), k)))
    return e.select("event_id", safe_float(raw).alias("value"))


@query("stage2_subset", f"""
SELECT d.doc_id, {LABELS_SQL} AS label_norm
FROM documents d JOIN labels l ON l.doc_id = d.doc_id
WHERE ({LABELS_SQL}) IN ('fake', 'satire')
""")
def q_stage2_subset(spark, sf_dir):
    a = K.with_labels(K.clean_text(raw_articles(spark, sf_dir)))
    return a.where(F.col("label_norm").isin("fake", "satire")).select("doc_id", "label_norm")

