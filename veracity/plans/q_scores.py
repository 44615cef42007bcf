"""Driver queries for metrics, tuning and decisions (phases 5–7).

Stand-in scores are deterministic integer formulas with one division, identical in
Spark and DuckDB (see FIXTURES.md); labels come from ``labels``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.functions.rules import decide, decision_reason, stage2_reason, stage2_rule, stage2_target, suspicious_target
from veracity.operators import metrics as M
from veracity.operators import tuning as C
from veracity.plans.registry import query, table
from veracity.schema import CLASS_ORDER, LABEL_DISPLAY

R6 = 6  # published doubles are rounded to 6 decimals

# fixed rule / threshold used by the decision queries
RULE = {
    "exaggeration_threshold": 0.3,
    "irony_threshold": 0.5,
    "irony_high_threshold": 0.75,
    "irony_dominance_margin": 0.1,
    "emotion_high_threshold": 0.6,
}
THRESHOLD = 0.4
TEMPERATURE = 1.7


def scored(spark, sf_dir, labelled: bool = True):
    """Documents (those with a label, or all) with stand-in model outputs."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "inner" if labelled else "left")
    doc = F.col("doc_id")
    return j.select(
        doc.alias("row_key"),
        F.col("source").alias("group_id"),
        F.when(F.col("toxic") == 1, "satire").when(F.col("quality") == 1, "real").otherwise("fake").alias("label_norm"),
        (((doc * 7919) % 1000) / 1000).alias("p"),
        (((F.col("n_chars")) % 997) / 997).alias("emotion_index"),
        (((doc * 104729) % 1000) / 1000).alias("exaggeration_index"),
        (((doc * 7907 + F.col("n_chars")) % 1000) / 1000).alias("irony_index"),
        (((doc * 31) % 101) / 100).alias("irony_score"),
    ).select("*", (4 * F.col("p") - 2).alias("logit"),
             suspicious_target("label_norm").alias("y"), stage2_target("label_norm").alias("stage2_label"))


SCORED = """
  SELECT d.doc_id AS row_key, d.source AS group_id,
         CASE WHEN l.toxic = 1 THEN 'satire' WHEN l.quality = 1 THEN 'real' ELSE 'fake' END AS label_norm,
         ((d.doc_id * 7919) % 1000) / 1000 AS p,
         (d.n_chars % 997) / 997 AS emotion_index,
         ((d.doc_id * 104729) % 1000) / 1000 AS exaggeration_index,
         ((d.doc_id * 7907 + d.n_chars) % 1000) / 1000 AS irony_index,
         ((d.doc_id * 31) % 101) / 100 AS irony_score,
         4 * (((d.doc_id * 7919) % 1000) / 1000) - 2 AS logit,
         CASE WHEN l.toxic = 1 OR l.quality <> 1 THEN 1 ELSE 0 END AS y,
         CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 1 THEN -1 ELSE 0 END AS stage2_label
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id
"""
SCORED_ALL = SCORED.replace("JOIN labels", "LEFT JOIN labels")


def _r(c, name):
    return F.round(F.col(c) if isinstance(c, str) else c, R6).alias(name)


def _lit(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


SQL_RULE = {k: _lit(v) for k, v in RULE.items()}
SQL_JOINT = f"(exaggeration_index >= {SQL_RULE['exaggeration_threshold']} AND irony_index >= {SQL_RULE['irony_threshold']})"
SQL_DOMINANT = (f"(irony_index >= {SQL_RULE['irony_high_threshold']} "
                f"AND irony_index >= emotion_index + {SQL_RULE['irony_dominance_margin']} "
                f"AND irony_index >= exaggeration_index + {SQL_RULE['irony_dominance_margin']})")
SQL_EMO = (f"(emotion_index >= {SQL_RULE['emotion_high_threshold']} AND exaggeration_index < "
           f"{SQL_RULE['exaggeration_threshold']} AND irony_index < {SQL_RULE['irony_threshold']})")
SQL_DECIDE = (f"CASE WHEN p < {_lit(THRESHOLD)} THEN 'real' WHEN {SQL_JOINT} OR {SQL_DOMINANT} "
              f"THEN 'satire' ELSE 'fake' END")


def with_prediction(df):
    e, x, i = "emotion_index", "exaggeration_index", "irony_index"
    return df.withColumn("prediction", decide("p", THRESHOLD, e, x, i, RULE))


# ----------------------------------------------------------------------------- phase 5: metrics


@query("confusion", f"""
WITH s AS (SELECT label_norm, {SQL_DECIDE} AS prediction FROM ({SCORED})),
g AS (SELECT * FROM (VALUES ('real'), ('fake'), ('satire')) t(v))
SELECT a.v AS truth, b.v AS pred, CAST(count(s.label_norm) AS BIGINT) AS n
FROM g a, g b LEFT JOIN s ON s.label_norm = a.v AND s.prediction = b.v
GROUP BY 1, 2
""")
def q_confusion(spark, sf_dir):
    return M.confusion(with_prediction(scored(spark, sf_dir)), "label_norm", "prediction", CLASS_ORDER)


@query("accuracy", f"""
SELECT round(avg(CASE WHEN label_norm = {SQL_DECIDE} THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS n FROM ({SCORED})
""")
def q_accuracy(spark, sf_dir):
    s = with_prediction(scored(spark, sf_dir))
    return s.agg(_r(F.avg((F.col("label_norm") == F.col("prediction")).cast("double")), "accuracy"),
                 F.count(F.lit(1)).alias("n"))


BIN_SQL = """
WITH c AS (
  SELECT count(*) FILTER (WHERE y = 1 AND pr = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND pr = 1) AS fp,
         count(*) FILTER (WHERE y = 1 AND pr <> 1) AS fn, count(*) FILTER (WHERE y <> 1 AND pr <> 1) AS tn,
         count(*) AS n
  FROM (SELECT y, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pr FROM ({scored})))
SELECT tp, fp, fn, tn,
  round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0 END, 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1
FROM c
""".format(scored=SCORED)


@query("binary_prf", BIN_SQL)
def q_binary_prf(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("pr", (F.col("p") >= 0.5).cast("int"))
    out = M.binary_prf(s, "y", "pr")
    return out.select("tp", "fp", "fn", "tn", *[_r(c, c) for c in ("accuracy", "precision", "recall", "f1")])


PER_LABEL_SQL = f"""
  s AS (SELECT label_norm AS truth, {SQL_DECIDE} AS pred FROM ({SCORED})),
  g AS (SELECT * FROM (VALUES ('real', 0), ('fake', 1), ('satire', 2)) t(v, o)),
  pl AS (
    SELECT g.v AS label, g.o,
      (SELECT count(*) FROM s WHERE truth = g.v AND pred = g.v) AS tp,
      (SELECT count(*) FROM s WHERE pred = g.v) AS predicted,
      (SELECT count(*) FROM s WHERE truth = g.v) AS support
    FROM g),
  plm AS (
    SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
              CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1
    FROM pl)
"""


@query("macro_f1", f"""
WITH {PER_LABEL_SQL}
SELECT round(avg(f1) FILTER (WHERE support + predicted > 0), 6) AS macro_f1 FROM plm
""")
def q_macro_f1(spark, sf_dir):
    s = with_prediction(scored(spark, sf_dir))
    return M.macro_f1(s, "label_norm", "prediction", CLASS_ORDER).select(_r("macro_f1", "macro_f1"))


_DISPLAY_CASE = "CASE " + " ".join(f"WHEN label = '{k}' THEN '{v}'" for k, v in LABEL_DISPLAY.items()) + " END"


@query("classification_report", f"""
WITH {PER_LABEL_SQL},
tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
               sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM plm)
SELECT {_DISPLAY_CASE} AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS DOUBLE) AS support FROM plm
UNION ALL SELECT 'accuracy', NULL, NULL, round(CASE WHEN n > 0 THEN tp / n ELSE 0 END, 6), CAST(n AS DOUBLE) FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS DOUBLE) FROM tot
UNION ALL SELECT 'weighted avg', round(CASE WHEN n > 0 THEN wp / n ELSE 0 END, 6),
       round(CASE WHEN n > 0 THEN wr / n ELSE 0 END, 6), round(CASE WHEN n > 0 THEN wf / n ELSE 0 END, 6),
       CAST(n AS DOUBLE) FROM tot
""")
def q_classification_report(spark, sf_dir):
    s = with_prediction(scored(spark, sf_dir))
    rep = M.classification_report(s, "label_norm", "prediction", CLASS_ORDER,
                                  [LABEL_DISPLAY[c] for c in CLASS_ORDER])
    return rep.select("label", _r("precision", "precision"), _r("recall", "recall"), _r("f1", "f1"), "support")


AUC_SQL = f"""
WITH s AS (SELECT y, p FROM ({SCORED})),
pairs AS (SELECT sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END) AS u
          FROM s a JOIN s b ON a.y = 1 AND b.y <> 1),
c AS (SELECT count(*) FILTER (WHERE y = 1) AS P, count(*) FILTER (WHERE y <> 1) AS N FROM s)
SELECT round(CASE WHEN P > 0 AND N > 0 THEN u / (P * N) END, 6) AS roc_auc FROM pairs, c
"""


@query("roc_auc", AUC_SQL)
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(scored(spark, sf_dir), "y", "p").select(_r("roc_auc", "roc_auc"))


AP_SQL = f"""
WITH s AS (SELECT y, p FROM ({SCORED})),
h AS (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM s GROUP BY p),
c AS (SELECT p, pos, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM h
      WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT round(CASE WHEN sum(pos) > 0 THEN sum(pos * (cp / (cp + cn))) / sum(pos) END, 6) AS average_precision FROM c
"""


@query("average_precision", AP_SQL)
def q_average_precision(spark, sf_dir):
    return M.average_precision(scored(spark, sf_dir), "y", "p").select(_r("average_precision", "average_precision"))


@query("mae_rmse", f"""
SELECT round(avg(abs(irony_score - irony_index)), 6) AS mae,
       round(sqrt(avg((irony_score - irony_index) * (irony_score - irony_index))), 6) AS rmse,
       count(*) AS n FROM ({SCORED_ALL})
""")
def q_mae_rmse(spark, sf_dir):
    out = M.mae_rmse(scored(spark, sf_dir, labelled=False), "irony_score", "irony_index")
    return out.select(_r("mae", "mae"), _r("rmse", "rmse"), "n")


@query("quantiles_sketch", f"""
SELECT round(CAST(unnest({[*C.DECILES, 0.75]!r}) AS DOUBLE), 6) AS q, TRUE AS within
""")
def q_quantiles_sketch(spark, sf_dir):
    """G17 by sketch: the share of values below and up to each result encloses q, but for the stated error."""
    s = scored(spark, sf_dir, labelled=False).select("emotion_index")
    got = C.approximate_quantiles(s, "emotion_index", [*C.DECILES, 0.75], 1000)
    n = s.agg(F.count("emotion_index").alias("n"))
    below = s.groupBy("emotion_index").agg(F.count(F.lit(1)).alias("c")).join(F.broadcast(got), F.col("emotion_index") <= F.col("value"))
    rank = below.groupBy("q").agg(F.sum("c").alias("upto"), F.sum(F.when(F.col("emotion_index") < F.col("value"), F.col("c")).otherwise(0)).alias("under"))
    from veracity.operators.prefix import attach
    r = attach(rank, n)
    return r.select(_r("q", "q"), ((F.col("under") <= (F.col("q") + 0.001) * F.col("n") + 1) & (F.col("upto") >= (F.col("q") - 0.001) * F.col("n") - 1)).alias("within"))


@query("quantiles", f"""
SELECT unnest(CAST({[*C.DECILES, 0.75]!r} AS DOUBLE[])) AS q,
       unnest(list_transform(quantile_cont(emotion_index, {[*C.DECILES, 0.75]!r}), lambda v: round(v, 6))) AS value
FROM ({SCORED_ALL})
""")
def q_quantiles(spark, sf_dir):
    out = C.quantiles(scored(spark, sf_dir, labelled=False), "emotion_index", [*C.DECILES, 0.75])
    return out.select("q", _r("value", "value"))


def _softplus_sql(x: str) -> str:
    return f"(greatest({x}, 0) + ln(1 + exp(-abs({x}))))"


BCE_ROW = f"(y * {_softplus_sql('-logit')} + (1 - y) * {_softplus_sql('logit')})"


@query("evaluate_binary", f"""
WITH b AS ({BIN_SQL.replace('SELECT tp, fp', 'SELECT tp, fp', 1)}),
l AS (SELECT avg({BCE_ROW}) AS loss FROM ({SCORED})),
a AS ({AUC_SQL}), ap AS ({AP_SQL})
SELECT round(l.loss, 6) AS loss, b.accuracy AS "accuracy@0.5", b.f1 AS "f1@0.5", b.recall AS "recall@0.5",
       a.roc_auc, ap.average_precision FROM b, l, a, ap
""")
def q_evaluate_binary(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("pr", (F.col("p") >= 0.5).cast("int")).cache()
    loss = s.agg(_r(F.avg(M.bce_with_logits("logit", F.col("y").cast("double"))), "loss"))
    b = M.binary_prf(s, "y", "pr").select(_r("accuracy", "accuracy@0.5"), _r("f1", "f1@0.5"),
                                          _r("recall", "recall@0.5"))
    auc = M.roc_auc(s, "y", "p").select(_r("roc_auc", "roc_auc"))
    ap = M.average_precision(s, "y", "p").select(_r("average_precision", "average_precision"))
    from veracity.operators.prefix import attach
    return attach(attach(attach(loss, b), auc), ap)


@query("class_weight", f"""
SELECT count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg,
       round(least(20.0, greatest(0.25, count(*) FILTER (WHERE y <> 1) / greatest(1, count(*) FILTER (WHERE y = 1)))), 6)
       AS class_weight FROM ({SCORED})
""")
def q_class_weight(spark, sf_dir):
    return M.class_weight(scored(spark, sf_dir), "y").select("pos", "neg", _r("class_weight", "class_weight"))


@query("bce", f"""
WITH w AS (SELECT least(20.0, greatest(0.25, count(*) FILTER (WHERE y <> 1) / greatest(1, count(*) FILTER (WHERE y = 1))))
                  AS cw FROM ({SCORED}))
SELECT round(avg(cw * y * {_softplus_sql('-logit')} + (1 - y) * {_softplus_sql('logit')}), 6) AS bce
FROM ({SCORED}), w
""")
def q_bce(spark, sf_dir):
    s = scored(spark, sf_dir)
    from veracity.operators.prefix import attach
    j = attach(s, M.class_weight(s, "y").select("class_weight"))
    return j.agg(_r(F.avg(M.bce_with_logits("logit", F.col("y").cast("double"), F.col("class_weight"))), "bce"))


# ----------------------------------------------------------------------------- phase 6: tuning


@query("apply_temperature", f"""
SELECT row_key, round(1 / (1 + exp(-logit / {_lit(TEMPERATURE)})), 6) AS calibrated FROM ({SCORED_ALL})
""")
def q_apply_temperature(spark, sf_dir):
    s = scored(spark, sf_dir, labelled=False)
    return s.select("row_key", _r(C.apply_temperature("logit", TEMPERATURE), "calibrated"))


_GRID_SQL = "(SELECT unnest(CAST({0!r} AS DOUBLE[])) AS t)"


@query("suspicion_threshold", f"""
WITH s AS (SELECT y, p FROM ({SCORED})),
cand AS (SELECT DISTINCT t FROM (SELECT p AS t FROM s UNION ALL {_GRID_SQL.format(C.SUSPICION_GRID)})),
P AS (SELECT count(*) FILTER (WHERE y = 1) AS P FROM s),
m AS (SELECT cand.t, count(*) FILTER (WHERE s.y = 1 AND s.p >= cand.t) AS tp,
             count(*) FILTER (WHERE s.y <> 1 AND s.p >= cand.t) AS fp
      FROM cand, s GROUP BY cand.t),
r AS (SELECT t AS threshold,
        CASE WHEN P > 0 THEN tp / P ELSE 0 END AS recall,
        CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
        CASE WHEN 2 * tp + fp + (P - tp) > 0 THEN 2 * tp / (2 * tp + fp + (P - tp)) ELSE 0 END AS f1
      FROM m, P)
SELECT round(threshold, 6) AS threshold, round(recall, 6) AS recall, round(precision, 6) AS precision,
       round(f1, 6) AS f1,
       (SELECT CAST(max(CASE WHEN recall >= 0.95 THEN 1.0 ELSE 0.0 END) AS DOUBLE) FROM r) AS target_recall_satisfied
FROM r ORDER BY (recall >= 0.95) DESC, f1 DESC, precision DESC, threshold DESC LIMIT 1
""")
def q_suspicion_threshold(spark, sf_dir):
    out = C.choose_suspicion_threshold(scored(spark, sf_dir), "y", "p", 0.95)
    return out.select(*[_r(c, c) for c in ("threshold", "recall", "precision", "f1")], "target_recall_satisfied")


def token_rows(spark, sf_dir):
    """Words of all documents with stand-in token targets and probabilities."""
    from veracity.operators.words import word_rows
    w = word_rows(table(spark, sf_dir, "documents"), "doc_id")
    return w.select("doc_id", "word_idx",
                    (((F.col("doc_id") + F.col("word_idx")) % 7) / 6).alias("target"),
                    (((F.col("doc_id") * 31 + F.col("word_idx") * 17) % 100) / 100).alias("prob"))


def _token_rows_sql():
    from veracity.plans.sqlparts import DOC_WORDS
    return f"""
    SELECT w.doc_id, w.word_idx, ((w.doc_id + w.word_idx) % 7) / 6 AS target,
           ((w.doc_id * 31 + w.word_idx * 17) % 100) / 100 AS prob
    FROM ({DOC_WORDS}) w"""


@query("token_threshold", f"""
WITH s AS ({_token_rows_sql()}),
g AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS k FROM {_GRID_SQL.format(C.TOKEN_GRID)}),
m AS (SELECT g.k, g.t,
        count(*) FILTER (WHERE s.target >= 0.5 AND s.prob >= g.t) AS tp,
        count(*) FILTER (WHERE s.target < 0.5 AND s.prob >= g.t) AS fp,
        count(*) FILTER (WHERE s.target >= 0.5) AS P
      FROM g, s GROUP BY g.k, g.t),
r AS (SELECT k, t AS threshold,
        CASE WHEN 2 * tp + fp + (P - tp) > 0 THEN 2 * tp / (2 * tp + fp + (P - tp)) ELSE 0 END AS f1,
        CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
        CASE WHEN P > 0 THEN tp / P ELSE 0 END AS recall FROM m)
SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1, round(precision, 6) AS precision,
       round(recall, 6) AS recall FROM r ORDER BY f1 DESC, recall DESC, k ASC LIMIT 1
""")
def q_token_threshold(spark, sf_dir):
    out = C.choose_token_threshold(token_rows(spark, sf_dir), "target", "prob")
    return out.select(*[_r(c, c) for c in ("threshold", "f1", "precision", "recall")])


def _cands_sql(col: str, defaults: list[float]) -> str:
    return f"""(SELECT DISTINCT least(1.0, greatest(0.0, v)) AS threshold FROM (
        SELECT unnest(quantile_cont({col}, {C.DECILES!r})) AS v FROM ({SCORED}) WHERE stage2_label >= 0
        UNION ALL SELECT unnest(CAST({[float(x) for x in defaults]!r} AS DOUBLE[]))))"""


@query("candidate_thresholds", f"""
SELECT CAST(row_number() OVER (ORDER BY threshold) - 1 AS INTEGER) AS k, round(threshold, 6) AS threshold
FROM {_cands_sql('exaggeration_index', C.RULE_EXAGGERATION_DEFAULTS)}
""")
def q_candidate_thresholds(spark, sf_dir):
    s = scored(spark, sf_dir).where(F.col("stage2_label") >= 0)
    out = C.candidate_thresholds(s, "exaggeration_index", C.RULE_EXAGGERATION_DEFAULTS)
    return out.select("k", _r("threshold", "threshold"))


@query("emotion_high", f"""
SELECT round(coalesce(greatest(0.05, quantile_cont(emotion_index, 0.75)), 0.15), 6) AS emotion_high_threshold
FROM ({SCORED}) WHERE stage2_label >= 0
""")
def q_emotion_high(spark, sf_dir):
    s = scored(spark, sf_dir).where(F.col("stage2_label") >= 0)
    return spark.createDataFrame([(round(C.emotion_high_value(s, "emotion_index"), R6),)],
                                 "emotion_high_threshold double")


@query("tune_rule", f"""
WITH s AS (SELECT * FROM ({SCORED}) WHERE stage2_label >= 0),
xc AS (SELECT threshold AS xt, row_number() OVER (ORDER BY threshold) AS kx
       FROM {_cands_sql('exaggeration_index', C.RULE_EXAGGERATION_DEFAULTS)}),
ic AS (SELECT threshold AS it, row_number() OVER (ORDER BY threshold) AS ki
       FROM {_cands_sql('irony_index', C.RULE_IRONY_DEFAULTS)}),
hc AS (SELECT threshold AS ht, row_number() OVER (ORDER BY threshold) AS kh
       FROM {_cands_sql('irony_index', C.RULE_IRONY_HIGH_DEFAULTS)}),
mc AS (SELECT m, row_number() OVER (ORDER BY m) AS km FROM (SELECT unnest(CAST({C.RULE_MARGINS!r} AS DOUBLE[])) AS m)),
rules AS (SELECT * FROM xc, ic, hc, mc WHERE ht >= it),
ev AS (
  SELECT kx, ki, kh, km, xt, it, ht, m,
    count(*) FILTER (WHERE y1 = 1 AND pr = 1) AS tp, count(*) FILTER (WHERE y1 = 0 AND pr = 1) AS fp,
    count(*) FILTER (WHERE y1 = 1 AND pr = 0) AS fn, count(*) FILTER (WHERE y1 = 0 AND pr = 0) AS tn
  FROM (SELECT r.*, s.stage2_label AS y1,
          CASE WHEN (s.exaggeration_index >= r.xt AND s.irony_index >= r.it)
                 OR (s.irony_index >= r.ht AND s.irony_index >= s.emotion_index + r.m
                     AND s.irony_index >= s.exaggeration_index + r.m) THEN 1 ELSE 0 END AS pr
        FROM rules r, s)
  GROUP BY ALL),
sc AS (
  SELECT *,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1_1,
    CASE WHEN 2 * tn + fn + fp > 0 THEN 2 * tn / (2 * tn + fn + fp) ELSE 0 END AS f1_0,
    (tp + fn > 0 OR tp + fp > 0) AS pr1, (tn + fp > 0 OR tn + fn > 0) AS pr0 FROM ev),
fin AS (
  SELECT *, CASE WHEN pr1::INT + pr0::INT > 0 THEN
      ((CASE WHEN pr1 THEN f1_1 ELSE 0 END) + (CASE WHEN pr0 THEN f1_0 ELSE 0 END)) / (pr1::INT + pr0::INT)
      ELSE 0 END AS macro_f1,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS satire_recall,
    CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0 END AS accuracy FROM sc)
SELECT round(xt, 6) AS exaggeration_threshold, round(it, 6) AS irony_threshold,
       round(ht, 6) AS irony_high_threshold, round(m, 6) AS irony_dominance_margin,
       round(macro_f1, 6) AS macro_f1, round(satire_recall, 6) AS satire_recall, round(accuracy, 6) AS accuracy,
       tp, fp, fn, tn,
       (SELECT round(coalesce(greatest(0.05, quantile_cont(emotion_index, 0.75)), 0.15), 6) FROM s)
         AS emotion_high_threshold
FROM fin ORDER BY macro_f1 DESC, satire_recall DESC, accuracy DESC, kx, ki, kh, km LIMIT 1
""")
def q_tune_rule(spark, sf_dir):
    s = scored(spark, sf_dir).where(F.col("stage2_label") >= 0)
    out = C.tune_stage2_rule(s)
    return out.select(
        *[_r(c, c) for c in ("exaggeration_threshold", "irony_threshold", "irony_high_threshold",
                             "irony_dominance_margin", "macro_f1", "satire_recall", "accuracy")],
        "tp", "fp", "fn", "tn", _r("emotion_high_threshold", "emotion_high_threshold"))


# ----------------------------------------------------------------------------- phase 7: decisions


@query("stage2_rule", f"""
SELECT row_key, CASE WHEN {SQL_JOINT} OR {SQL_DOMINANT} THEN 1 ELSE 0 END AS stage2_rule
FROM ({SCORED}) WHERE stage2_label >= 0
""")
def q_stage2_rule(spark, sf_dir):
    s = scored(spark, sf_dir).where(F.col("stage2_label") >= 0)
    return s.select("row_key", stage2_rule("emotion_index", "exaggeration_index", "irony_index", RULE)
                    .alias("stage2_rule"))


def _reason_sql():
    from veracity.schema import REASON_DOMINANT, REASON_EMOTION_ONLY, REASON_JOINT, REASON_OTHER
    return (f"CASE WHEN {SQL_JOINT} THEN '{REASON_JOINT}' WHEN {SQL_DOMINANT} THEN '{REASON_DOMINANT}' "
            f"WHEN {SQL_EMO} THEN '{REASON_EMOTION_ONLY}' ELSE '{REASON_OTHER}' END")


@query("stage2_reason", f"""
SELECT {_reason_sql()} AS reason, count(*) AS n FROM ({SCORED_ALL}) GROUP BY 1
""")
def q_stage2_reason(spark, sf_dir):
    s = scored(spark, sf_dir, labelled=False)
    return s.groupBy(stage2_reason("emotion_index", "exaggeration_index", "irony_index", RULE).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))


def _cascade_sql():
    from veracity.schema import REASON_STAGE1
    return f"""
SELECT row_key, {SQL_DECIDE} AS final_label,
       CASE WHEN p < {_lit(THRESHOLD)} THEN '{REASON_STAGE1}' ELSE {_reason_sql()} END AS decision_reason,
       p >= {_lit(THRESHOLD)} AS stage1_passed
FROM ({SCORED_ALL})"""


@query("cascade", _cascade_sql())
def q_cascade(spark, sf_dir):
    s = scored(spark, sf_dir, labelled=False)
    e, x, i = "emotion_index", "exaggeration_index", "irony_index"
    return s.select("row_key", decide("p", THRESHOLD, e, x, i, RULE).alias("final_label"),
                    decision_reason("p", THRESHOLD, e, x, i, RULE).alias("decision_reason"),
                    (F.col("p") >= THRESHOLD).alias("stage1_passed"))
