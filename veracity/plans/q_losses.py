"""Driver queries for the loss aggregates and evaluation records.

Token targets come from the span stand-ins (``chunk_token_scores``); token logits are
``4·pr − 2`` with ``pr = ((doc_id·13 + tok_pos·7 + chunk_idx·3) % 100) / 100``;
attention scores ``s = (same % 100) / 10``."""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.operators import losses as L
from veracity.operators import metrics as M
from veracity.plans.q_scores import SCORED, _softplus_sql, scored
from veracity.plans.q_tokens import TOKSCORE_SQL, chunk_token_scores
from veracity.plans.registry import query, table

R = 6
_H = "((doc_id * 13 + tok_pos * 7 + chunk_idx * 3) % 100)"


def tokens(spark, sf_dir):
    t = chunk_token_scores(spark, sf_dir)
    h = (F.col("doc_id") * 13 + F.col("tok_pos") * 7 + F.col("chunk_idx") * 3) % 100
    return t.select("*", (4 * (h / 100) - 2).alias("z"), (h / 10).alias("s"),
                    (2 - 4 * (h / 100)).alias("zx"), (((F.col("doc_id") + F.col("tok_pos")) % 5) / 4).alias("xt"))


TOK_SQL = f"""
  SELECT *, 4 * ({_H} / 100) - 2 AS z, {_H} / 10 AS s, 2 - 4 * ({_H} / 100) AS zx,
         ((doc_id + tok_pos) % 5) / 4 AS xt
  FROM ({TOKSCORE_SQL})"""


def _bce_sql(y: str, z: str, w: str = "1.0") -> str:
    return f"({w} * {y} * {_softplus_sql('-' + z)} + (1 - {y}) * {_softplus_sql(z)})"


def _ce_sql(tok: str, conf: str | None) -> str:
    w = f"0.25 + 0.75 * least(1, greatest(0, {conf}))" if conf else "1.0"
    return f"""
  SELECT coalesce(avg(ce * w), 0.0) AS rationale_ce FROM (
    SELECT doc_id, -s1 / tt AS ce, {w} AS w FROM (
      SELECT doc_id, chunk_idx, sum(target * ln(greatest(a, 1e-8))) AS s1, sum(target) AS tt FROM (
        SELECT e.*, ex / zz AS a FROM (
          SELECT t.*, exp(t.s - m.m) AS ex FROM ({tok}) t
          JOIN (SELECT doc_id, chunk_idx, max(s) AS m FROM ({tok}) GROUP BY ALL) m USING (doc_id, chunk_idx)) e
        JOIN (SELECT doc_id, chunk_idx, sum(exp(t.s - m.m)) AS zz FROM ({tok}) t
              JOIN (SELECT doc_id, chunk_idx, max(s) AS m FROM ({tok}) GROUP BY ALL) m USING (doc_id, chunk_idx)
              GROUP BY ALL) z USING (doc_id, chunk_idx))
      GROUP BY ALL) WHERE tt > 0)"""


@query("masked_token_bce", f"""
SELECT round(coalesce(avg({_bce_sql('target', 'z')}), 0.0), 6) AS masked_token_bce FROM ({TOK_SQL})
""")
def q_masked_token_bce(spark, sf_dir):
    return L.masked_token_bce(tokens(spark, sf_dir), "target", "z").select(
        F.round("masked_token_bce", R).alias("masked_token_bce"))


@query("rationale_ce", f"""
SELECT round(rationale_ce, 6) AS rationale_ce FROM ({_ce_sql(TOK_SQL, '((doc_id * 7919) % 1000) / 1000')})
""")
def q_rationale_ce(spark, sf_dir):
    conf = table(spark, sf_dir, "documents").select("doc_id", (((F.col("doc_id") * 7919) % 1000) / 1000)
                                                    .alias("confidence"))
    out = L.rationale_ce(tokens(spark, sf_dir), "doc_id", "target", "s", conf)
    return out.select(F.round("rationale_ce", R).alias("rationale_ce"))


LAB_TOK_SQL = f"SELECT t.* FROM ({TOK_SQL}) t JOIN labels l ON l.doc_id = t.doc_id"
TOTAL_T = "CASE WHEN row_key % 3 <> 0 THEN ((row_key * 17) % 101) / 100 END"


@query("stage1_loss", f"""
WITH b AS (SELECT avg({_bce_sql('y', 'logit')}) AS bce,
                  coalesce(avg(({TOTAL_T} - p) * ({TOTAL_T} - p)), 0.0) AS total_mse FROM ({SCORED})),
c AS ({_ce_sql(LAB_TOK_SQL, None)})
SELECT round(bce, 6) AS bce, round(rationale_ce, 6) AS rationale_ce, round(total_mse, 6) AS total_mse,
       round(bce + 0.2 * rationale_ce + 0.1 * total_mse, 6) AS loss FROM b, c
""")
def q_stage1_loss(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn(
        "total_t", F.when(F.col("row_key") % 3 != 0, ((F.col("row_key") * 17) % 101) / 100))
    t = tokens(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    out = L.stage1_loss(s, t, "doc_id", "logit", "y", 1.0, "target", "s", "total_t", "p")
    return out.select(*[F.round(c, R).alias(c) for c in ("bce", "rationale_ce", "total_mse", "loss")])


DOC_IDX_SQL = """
  SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN ((doc_id * 3) % 11) / 10 END AS emotion_score,
         CASE WHEN doc_id % 4 = 1 THEN ((doc_id * 5) % 11) / 10 END AS exaggeration_score,
         (n_chars % 997) / 997 AS emotion_pred, ((doc_id * 104729) % 1000) / 1000 AS exaggeration_pred
  FROM documents"""


def doc_idx(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    return d.select("doc_id", F.when(doc % 4 == 0, ((doc * 3) % 11) / 10).alias("emotion_score"),
                    F.when(doc % 4 == 1, ((doc * 5) % 11) / 10).alias("exaggeration_score"),
                    ((F.col("n_chars") % 997) / 997).alias("emotion_pred"),
                    (((doc * 104729) % 1000) / 1000).alias("exaggeration_pred"))


INDEX_LOSS_SQL = f"""
  WITH t AS ({TOK_SQL}), d AS ({DOC_IDX_SQL})
  SELECT (SELECT coalesce(avg({_bce_sql('target', 'z')}), 0.0) FROM t) AS emotion_bce,
         (SELECT coalesce(avg({_bce_sql('xt', 'zx')}), 0.0) FROM t) AS exaggeration_bce,
         (SELECT coalesce(avg((emotion_score - emotion_pred) * (emotion_score - emotion_pred)), 0.0) FROM d)
           AS emotion_mse,
         (SELECT coalesce(avg((exaggeration_score - exaggeration_pred) * (exaggeration_score - exaggeration_pred)),
                          0.0) FROM d) AS exaggeration_mse,
         (SELECT avg(abs(emotion_score - emotion_pred)) FROM d) AS emotion_mae,
         (SELECT avg(abs(exaggeration_score - exaggeration_pred)) FROM d) AS exaggeration_mae
"""


def _index_loss(spark, sf_dir):
    return L.index_loss(tokens(spark, sf_dir), doc_idx(spark, sf_dir), "target", "z", "xt", "zx",
                        "emotion_score", "emotion_pred", "exaggeration_score", "exaggeration_pred")


@query("index_loss", f"""
SELECT round(emotion_bce, 6) AS emotion_bce, round(exaggeration_bce, 6) AS exaggeration_bce,
       round(emotion_mse, 6) AS emotion_mse, round(exaggeration_mse, 6) AS exaggeration_mse,
       round(emotion_bce + exaggeration_bce + 0.5 * (emotion_mse + exaggeration_mse), 6) AS loss
FROM ({INDEX_LOSS_SQL})
""")
def q_index_loss(spark, sf_dir):
    out = _index_loss(spark, sf_dir)
    return out.select(*[F.round(c, R).alias(c) for c in
                        ("emotion_bce", "exaggeration_bce", "emotion_mse", "exaggeration_mse", "loss")])


@query("evaluate_index", f"""
SELECT round(emotion_bce + exaggeration_bce + 0.5 * (emotion_mse + exaggeration_mse), 6) AS loss,
       round(emotion_mae, 6) AS emotion_mae, round(exaggeration_mae, 6) AS exaggeration_mae
FROM ({INDEX_LOSS_SQL})
""")
def q_evaluate_index(spark, sf_dir):
    loss = _index_loss(spark, sf_dir).select("loss")
    d = doc_idx(spark, sf_dir)
    e = M.mae_rmse(d, "emotion_score", "emotion_pred").select(F.col("mae").alias("emotion_mae"))
    x = M.mae_rmse(d, "exaggeration_score", "exaggeration_pred").select(F.col("mae").alias("exaggeration_mae"))
    from veracity.operators.prefix import attach
    out = attach(attach(loss, e), x)
    return out.select(*[F.round(c, R).alias(c) for c in ("loss", "emotion_mae", "exaggeration_mae")])


IRONY_SQL = f"""
  WITH b AS (SELECT avg({_bce_sql('irony_score', '(4 * irony_index - 2)')}) AS bce, count(*) AS n,
                    avg(abs(irony_score - irony_index)) AS mae,
                    sqrt(avg((irony_score - irony_index) * (irony_score - irony_index))) AS rmse FROM ({SCORED})),
  c AS ({_ce_sql(LAB_TOK_SQL, None)})
  SELECT bce, rationale_ce, n, bce + 0.2 * rationale_ce AS loss, mae, rmse FROM b, c
"""


def _irony(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("iz", 4 * F.col("irony_index") - 2)
    t = tokens(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    return s, L.irony_loss(s, t, "doc_id", "iz", "irony_score", "target", "s")


@query("irony_loss", f"""
SELECT round(bce, 6) AS bce, round(rationale_ce, 6) AS rationale_ce, n, round(loss, 6) AS loss FROM ({IRONY_SQL})
""")
def q_irony_loss(spark, sf_dir):
    _, out = _irony(spark, sf_dir)
    return out.select(F.round("bce", R).alias("bce"), F.round("rationale_ce", R).alias("rationale_ce"), "n",
                      F.round("loss", R).alias("loss"))


@query("evaluate_irony", f"""
SELECT round(loss, 6) AS loss, round(mae, 6) AS mae, round(rmse, 6) AS rmse FROM ({IRONY_SQL})
""")
def q_evaluate_irony(spark, sf_dir):
    s, out = _irony(spark, sf_dir)
    from veracity.operators.prefix import attach
    m = M.mae_rmse(s, "irony_score", "irony_index").select("mae", "rmse")
    r = attach(out.select("loss"), m)
    return r.select(*[F.round(c, R).alias(c) for c in ("loss", "mae", "rmse")])
