"""Loss functions as aggregates over scored tables.

Training with them is not built here; evaluating them over predictions and targets is
an ordinary aggregation.  Losses are means over rows / tokens / chunks (the original
averages batch means, which depends on the batch size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.functions.text import clip01
from veracity.operators.metrics import bce_with_logits
from veracity.operators.pooling import softmax_weights
from veracity.schema import (
    INDEX_SCORE_LOSS_WEIGHT,
    IRONY_RATIONALE_LOSS_WEIGHT,
    RATIONALE_LOSS_WEIGHT,
    TOTAL_ATTENTION_LOSS_WEIGHT,
)


def masked_token_bce(tokens: DataFrame, target: str, logit: str, pos_weight: float = 1.0,
                     mask: str | None = None) -> DataFrame:
    """L2: mean BCE over content tokens (``end > start``) of annotated documents
    (``mask``); 0.0 when there is none."""
    m = (F.col("end") > F.col("start")) & (F.col(mask) if mask else F.lit(True))
    return tokens.where(m).agg(_mean_bce(target, logit, pos_weight).alias("masked_token_bce"))


def _mean_bce(target: str, logit: str, pos_weight: float = 1.0) -> Column:
    return F.coalesce(F.avg(bce_with_logits(logit, F.col(target).cast("double"), pos_weight)), F.lit(0.0))


def rationale_ce(tokens: DataFrame, key: str, target: str, score: str, confidence: DataFrame | None = None,
                 conf_col: str = "confidence") -> DataFrame:
    """L3: per chunk, targets normalised to sum 1 (chunks summing to 0 dropped),
    −Σ t·log(max(a, 1e-8)) with ``a`` the softmax of ``score`` over the chunk's content
    tokens, weighted by 0.25 + 0.75·clip01(confidence) (1 when missing); mean over chunks.
    ``confidence`` is a per-document table joined on ``key`` (J6)."""
    content = tokens.where(F.col("end") > F.col("start"))
    a = softmax_weights(content, [key, "chunk_idx"], score)
    per_chunk = a.groupBy(key, "chunk_idx").agg(
        F.sum(F.col(target) * F.log(F.greatest(F.col("weight"), F.lit(1e-8)))).alias("s"),
        F.sum(target).alias("t"))
    per_chunk = per_chunk.where(F.col("t") > 0).withColumn("ce", -F.col("s") / F.col("t"))
    if confidence is not None:
        per_chunk = per_chunk.join(confidence.select(key, conf_col), key, "left")
        w = F.when(F.col(conf_col).isNull(), F.lit(1.0)).otherwise(0.25 + 0.75 * clip01(conf_col))
    else:
        w = F.lit(1.0)
    return per_chunk.agg(F.coalesce(F.avg(F.col("ce") * w), F.lit(0.0)).alias("rationale_ce"))


def mse(df: DataFrame, truth: str, pred: str, name: str = "mse") -> DataFrame:
    ok = F.col(truth).isNotNull() & F.col(pred).isNotNull()
    d = F.col(truth) - F.col(pred)
    return df.agg(F.coalesce(F.avg(F.when(ok, d * d)), F.lit(0.0)).alias(name))


def _one(*frames: DataFrame) -> DataFrame:
    from veracity.operators.prefix import attach
    out = frames[0]
    for f in frames[1:]:
        out = attach(out, f)
    return out


def stage1_loss(docs: DataFrame, tokens: DataFrame, key: str, logit: str, label: str, pos_weight: float,
                attention_target: str, attention_score: str, total_target: str, total_pred: str,
                confidence: DataFrame | None = None) -> DataFrame:
    """L4: BCE(doc) + 0.20·L3 + 0.10·MSE(total attention, annotated rows)."""
    bce = docs.agg(F.avg(bce_with_logits(logit, F.col(label).cast("double"), pos_weight)).alias("bce"))
    ce = rationale_ce(tokens, key, attention_target, attention_score, confidence)
    m = mse(docs, total_target, total_pred, "total_mse")
    t = _one(bce, ce, m)
    return t.select("*", (F.col("bce") + RATIONALE_LOSS_WEIGHT * F.col("rationale_ce")
                          + TOTAL_ATTENTION_LOSS_WEIGHT * F.col("total_mse")).alias("loss"))


def index_loss(tokens: DataFrame, docs: DataFrame, e_target: str, e_logit: str, x_target: str, x_logit: str,
               e_score: str, e_pred: str, x_score: str, x_pred: str) -> DataFrame:
    """Two masked token BCEs (L2, both in one pass over the tokens) + 0.50·(two MSEs on documents with a score)."""
    bce = tokens.where(F.col("end") > F.col("start")).agg(_mean_bce(e_target, e_logit).alias("emotion_bce"),
                                                          _mean_bce(x_target, x_logit).alias("exaggeration_bce"))
    me = mse(docs, e_score, e_pred, "emotion_mse")
    mx = mse(docs, x_score, x_pred, "exaggeration_mse")
    t = _one(bce, me, mx)
    return t.select("*", (F.col("emotion_bce") + F.col("exaggeration_bce") + INDEX_SCORE_LOSS_WEIGHT
                          * (F.col("emotion_mse") + F.col("exaggeration_mse"))).alias("loss"))


def irony_loss(docs: DataFrame, tokens: DataFrame, key: str, logit: str, target: str, attention_target: str,
               attention_score: str) -> DataFrame:
    """Soft-target BCE on the documents with a score + 0.20·L3; no such row is an error when the loss is read."""
    valid = docs.where(F.col(target).isNotNull())
    bce = valid.agg(F.avg(bce_with_logits(logit, F.col(target).cast("double"))).alias("bce"),
                    F.count(F.lit(1)).alias("n"))
    ce = rationale_ce(tokens, key, attention_target, attention_score)
    none = F.raise_error(F.lit(f"no row with {target}")).cast("double")
    t = _one(bce, ce).withColumn("bce", F.when(F.col("n") > 0, F.col("bce")).otherwise(none))
    return t.select("bce", "rationale_ce", "n",
                    (F.col("bce") + IRONY_RATIONALE_LOSS_WEIGHT * F.col("rationale_ce")).alias("loss"))
