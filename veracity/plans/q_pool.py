"""Driver queries for pooling, evidence and composed jobs (phases 7 and 9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.operators import pooling as PL
from veracity.plans import jobs as J
from veracity.plans.q_scores import RULE, SCORED, SCORED_ALL, SQL_DECIDE, THRESHOLD, _reason_sql, scored
from veracity.plans.q_tokens import CHUNK_TOK_SQL, word_token_frame
from veracity.plans.registry import query, table
from veracity.plans.sqlparts import DOC_WORDS
from veracity.schema import LABEL_DISPLAY, REASON_STAGE1

# ----------------------------------------------------------------------------- phase 9: pooling
# embeddings: a row is a token of the chunk ``label``; score = ((vec_id * 37) % 100) / 10,
# content tokens are those with vec_id % 9 <> 0


def _emb(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", "embedding", (((F.col("vec_id") * 37) % 100) / 10).alias("score"),
                    ((F.col("vec_id") % 9) != 0).alias("content"),
                    (((F.col("vec_id") * 13) % 50) / 10).alias("chunk_score"))


def _pool_sql(score: str, mask: str | None) -> str:
    m = mask or "TRUE"
    return f"""
WITH e AS (SELECT vec_id, label, embedding, {score} AS s, {m} AS c FROM embeddings),
g AS (SELECT label, max(CASE WHEN c THEN 1 ELSE 0 END) AS any_c FROM e GROUP BY label),
u AS (SELECT e.*, (e.c OR g.any_c = 0) AS use FROM e JOIN g ON g.label = e.label),
mx AS (SELECT label, max(s) AS mx FROM u WHERE use GROUP BY label),
w AS (SELECT u.*, CASE WHEN use THEN exp(s - mx.mx) ELSE 0.0 END AS ex FROM u JOIN mx ON mx.label = u.label),
z AS (SELECT label, sum(ex) AS z FROM w GROUP BY label),
ww AS (SELECT w.label, w.embedding, w.ex / z.z AS weight FROM w JOIN z ON z.label = w.label)
SELECT label, CAST(d - 1 AS INTEGER) AS dim, round(sum(weight * CAST(embedding[d] AS DOUBLE)), 6) AS value
FROM ww, range(1, len(embedding) + 1) r(d) GROUP BY label, d
"""


@query("softmax_pool_token", _pool_sql("((vec_id * 37) % 100) / 10", "(vec_id % 9 <> 0)"))
def q_softmax_pool_token(spark, sf_dir):
    out = PL.softmax_pool(_emb(spark, sf_dir), ["label"], "score", "embedding", "content")
    return out.select("label", "dim", F.round("value", 6).alias("value"))


@query("softmax_pool_chunk", _pool_sql("((vec_id * 13) % 50) / 10", None))
def q_softmax_pool_chunk(spark, sf_dir):
    out = PL.softmax_pool(_emb(spark, sf_dir), ["label"], "chunk_score", "embedding")
    return out.select("label", "dim", F.round("value", 6).alias("value"))


# attention evidence: token weight = ((doc_id*13 + tok_pos*7 + chunk_idx*3) % 100) / 100,
# chunk weight = ((chunk_idx % 3) + 1) / 3
ATT_SQL = f"""
WITH t AS (SELECT doc_id, start, "end",
             (((doc_id * 13 + tok_pos * 7 + chunk_idx * 3) % 100) / 100) * (((chunk_idx % 3) + 1) / 3) AS prob
           FROM ({CHUNK_TOK_SQL})),
wd AS ({DOC_WORDS}),
a AS (
  SELECT t.doc_id, t.prob,
    CASE WHEN greatest(w.start, t.start) < least(w."end", t."end") THEN w.word_idx
         WHEN greatest(nx.start, t.start) < least(nx."end", t."end") THEN nx.word_idx END AS word_idx
  FROM t ASOF LEFT JOIN wd w ON w.doc_id = t.doc_id AND t.start >= w.start
  LEFT JOIN wd nx ON nx.doc_id = t.doc_id AND nx.word_idx = coalesce(w.word_idx + 1, 0)),
m AS (SELECT doc_id, word_idx, max(prob) AS score FROM a WHERE word_idx IS NOT NULL GROUP BY ALL),
s AS (SELECT wd.doc_id, wd.word_idx, wd.word, coalesce(m.score, 0.0) AS score
      FROM wd LEFT JOIN m ON m.doc_id = wd.doc_id AND m.word_idx = wd.word_idx)
SELECT doc_id, CAST(rk AS INTEGER) AS rank, word, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word_idx) AS rk FROM s) WHERE rk <= 8
"""


@query("attention_evidence", ATT_SQL)
def q_attention_evidence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    of_chunks = F.array_distinct(F.flatten(F.transform("words", lambda w: w["tokens"]["chunk_idx"])))
    chunks = word_token_frame(docs).select("doc_id", F.explode(of_chunks).alias("chunk_idx")).distinct().withColumn(
        "chunk_weight", ((F.col("chunk_idx") % 3) + 1) / 3)

    def weight(t):
        return ((F.col("doc_id") * 13 + t["tok_pos"] * 7 + t["chunk_idx"] * 3) % 100) / 100

    ev = PL.attention_evidence(word_token_frame, chunks, docs, "doc_id", weight, 8)
    e = ev.select("doc_id", F.posexplode("evidence").alias("i", "e"))
    return e.select("doc_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("e.word").alias("word"),
                    F.round("e.score", 6).alias("score"))


# ----------------------------------------------------------------------------- phase 7: composed jobs


def _tables(spark, sf_dir, labelled=True):
    s = scored(spark, sf_dir, labelled)
    stage1 = s.select("row_key", F.col("p").alias("suspicious_probability"))
    idx = s.select("row_key", "emotion_index", "exaggeration_index")
    irony = s.select("row_key", "irony_index")
    labels = s.select("row_key", "label_norm")
    return stage1, idx, irony, labels


@query("validation_scores", f"""
SELECT row_key, label_norm, stage2_label, round(emotion_index, 6) AS emotion_index,
       round(exaggeration_index, 6) AS exaggeration_index, round(irony_index, 6) AS irony_index
FROM ({SCORED}) WHERE label_norm IN ('fake', 'satire')
""")
def q_validation_scores(spark, sf_dir):
    stage1, idx, irony, labels = _tables(spark, sf_dir)
    v = J.assemble_validation(labels, idx, irony)
    return v.select("row_key", "label_norm", "stage2_label",
                    *[F.round(c, 6).alias(c) for c in ("emotion_index", "exaggeration_index", "irony_index")])


_DISPLAY = "CASE " + " ".join(f"WHEN v = '{k}' THEN '{d}'" for k, d in LABEL_DISPLAY.items()) + " END"


@query("end_to_end_report", f"""
WITH s AS (SELECT label_norm AS truth, {SQL_DECIDE} AS pred FROM ({SCORED})),
g AS (SELECT * FROM (VALUES ('real'), ('fake'), ('satire')) t(v)),
pl AS (SELECT {_DISPLAY} AS label,
         (SELECT count(*) FROM s WHERE truth = g.v AND pred = g.v) AS tp,
         (SELECT count(*) FROM s WHERE pred = g.v) AS predicted,
         (SELECT count(*) FROM s WHERE truth = g.v) AS support FROM g),
plm AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
               CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1 FROM pl),
tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM plm)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS DOUBLE) AS support FROM plm
UNION ALL SELECT 'accuracy', NULL, NULL, round(CASE WHEN n > 0 THEN tp / n ELSE 0 END, 6), CAST(n AS DOUBLE) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS DOUBLE) FROM tot
UNION ALL SELECT 'weighted avg', round(CASE WHEN n > 0 THEN wp / n ELSE 0 END, 6),
       round(CASE WHEN n > 0 THEN wr / n ELSE 0 END, 6), round(CASE WHEN n > 0 THEN wf / n ELSE 0 END, 6),
       CAST(n AS DOUBLE) FROM tot
""")
def q_end_to_end_report(spark, sf_dir):
    stage1, idx, irony, labels = _tables(spark, sf_dir)
    rep = J.end_to_end_report(J.assemble_scores(stage1, idx, irony, labels), THRESHOLD, RULE)
    return rep.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("detect", f"""
SELECT row_key,
  CASE WHEN p < CAST({THRESHOLD!r} AS DOUBLE) THEN '{LABEL_DISPLAY['real']}'
       WHEN {SQL_DECIDE} = 'satire' THEN '{LABEL_DISPLAY['satire']}' ELSE '{LABEL_DISPLAY['fake']}' END AS final_label,
  p >= CAST({THRESHOLD!r} AS DOUBLE) AS stage1_passed,
  CASE WHEN p < CAST({THRESHOLD!r} AS DOUBLE) THEN '{REASON_STAGE1}'
       ELSE {_reason_sql()} END AS decision_reason,
  CASE WHEN p >= CAST({THRESHOLD!r} AS DOUBLE) THEN round(irony_index, 6) END AS irony_index
FROM ({SCORED_ALL})
""")
def q_detect(spark, sf_dir):
    stage1, idx, irony, _ = _tables(spark, sf_dir, labelled=False)

    def stage2(survivors):
        return survivors.join(idx, "row_key").join(irony, "row_key")

    d = J.detect_from_scores(stage1, stage2, THRESHOLD, RULE)
    return d.select("row_key", "final_label", "stage1_passed", "decision_reason",
                    F.round("irony_index", 6).alias("irony_index"))
