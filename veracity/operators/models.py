"""Scorers re-aimed at ``pyspark.ml`` (M1–M8).

The neural networks of the original are single-device programs; here the same
inputs, targets and outputs are learned with distributed ``pyspark.ml`` estimators:

* M1 suspicion classifier: tokens → hashed term frequencies → IDF → weighted logistic
  regression (class weight G5); the raw logit feeds temperature scaling (C1).
* M3 / M4 soft-label regressors: each row is used twice, as label 1 with weight y and
  as label 0 with weight 1−y — exactly binary cross-entropy with soft targets.
* M2 token taggers: a token's features are its own hashed text and its neighbours'
  inside the chunk (``tokens.token_rows``), one weighted logistic regression per target.
* M5–M7 score a table with evidence: words ranked by their share of the fitted margin
  (stage 1, irony) or by the largest probability of their tokens (index models).
* M8: any Python scorer applied per Arrow batch with ``mapInPandas``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.text import WS
from veracity.operators import offsets as O
from veracity.operators import tokens as TK
from veracity.operators import units as U
from veracity.operators.metrics import class_weight
from veracity.schema import DEFAULT_EVIDENCE_K, DEFAULT_INDEX_STRIDE, DEFAULT_MAX_LENGTH


def text_pipeline(text: str = "text", features: str = "features", num_features: int = 1 << 18,
                  label: str = "label", weight: str = "weight", reg: float = 0.01, max_iter: int = 50) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=f"{WS}+", toLowercase=False),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol=features),
        LogisticRegression(featuresCol=features, labelCol=label, weightCol=weight, regParam=reg,
                           maxIter=max_iter, rawPredictionCol="_raw", probabilityCol="_prob"),
    ])


def fit_suspicion(train: DataFrame, text: str = "text", target: str = "suspicious_target", **kw) -> PipelineModel:
    """M1: weighted logistic regression on TF-IDF; positives weighted by the class weight."""
    cw = class_weight(train, target).first()["class_weight"]
    data = train.select(text, F.col(target).cast("double").alias("label"),
                        F.when(F.col(target) == 1, F.lit(float(cw))).otherwise(F.lit(1.0)).alias("weight"))
    return text_pipeline(text, **kw).fit(data)


def score_logit(model: PipelineModel, df: DataFrame, temperature: float = 1.0) -> DataFrame:
    """M5 core: adds ``logit`` (margin of class 1) and ``suspicious_probability`` = σ(logit/T)."""
    out = model.transform(df)
    logit = vector_to_array(F.col("_raw"))[1]  # binary rawPrediction is [-margin, margin]
    return out.withColumn("logit", logit).withColumn(
        "suspicious_probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit") / F.lit(float(temperature))))
    ).drop("_tokens", "_tf", "features", "_raw", "_prob", "prediction")


def soft_label_rows(df: DataFrame, target: str) -> DataFrame:
    """Each row twice: label 1 with weight y, label 0 with weight 1−y (rows with a target)."""
    y = F.col(target).cast("double")
    src = df.where(y.isNotNull())
    pos = src.withColumn("label", F.lit(1.0)).withColumn("weight", y)
    neg = src.withColumn("label", F.lit(0.0)).withColumn("weight", F.lit(1.0) - y)
    return pos.unionByName(neg).where(F.col("weight") > 0)


def fit_soft_regressor(train: DataFrame, target: str, text: str = "text", **kw) -> PipelineModel:
    """M3 / M4: soft-target BCE on a [0, 1] score."""
    data = soft_label_rows(train.select(text, target), target).select(text, "label", "weight")
    return text_pipeline(text, **kw).fit(data)


def score_soft(model: PipelineModel, df: DataFrame, out: str) -> DataFrame:
    """M7 core: the probability of class 1 as the predicted score."""
    res = model.transform(df)
    return res.withColumn(out, vector_to_array(F.col("_prob"))[1]).drop(
        "_tokens", "_tf", "features", "_raw", "_prob", "prediction")


def tagger_counts(features: DataFrame, targets: list[str]) -> DataFrame:
    """Equal rows of ``token_rows(..., features=True)`` as one: ``tok, left, right`` and, for each target, the sums of
    y and 1 − y and the number of rows with y ≥ 0.5 and below."""
    aggs = []
    for t in targets:
        y = F.col(t).cast("double")
        aggs += [F.sum(y).alias(f"{t}_y"), F.sum(F.lit(1.0) - y).alias(f"{t}_rest"),
                 F.count_if(y >= 0.5).alias(f"{t}_pos"), F.count_if(y < 0.5).alias(f"{t}_neg")]
    return features.groupBy("tok", "left", "right").agg(*aggs)


def token_hasher(num_features: int) -> FeatureHasher:
    return FeatureHasher(inputCols=["tok", "left", "right"], outputCol="features", numFeatures=num_features)


def hashed(rows: DataFrame, num_features: int) -> DataFrame:
    """Tokens or their counts with the ``features`` of the taggers in place of ``tok, left, right``: hashing costs more than a
    pass of the fit, so rows that are fitted or scored several times are hashed once, before they are kept."""
    return token_hasher(num_features).transform(rows).drop("tok", "left", "right")


def fit_tagger(features: DataFrame, target: str, num_features: int = 1 << 18, reg: float = 0.01,
               max_iter: int = 50, counts: DataFrame | None = None) -> PipelineModel:
    """M2: one weighted token classifier for the soft ``target`` of ``token_rows(..., features=True)``.

    Each token counts as label 1 with weight y times G7's weight of positives (y ≥ 0.5), and as
    label 0 with weight 1 − y; rows without a target are left out.  Equal tokens with equal neighbours are one
    row with the sum of their weights, so the loss is the same and what the fit holds grows with
    the distinct ones.  ``counts``: ``tagger_counts`` of the features, best ``hashed`` to the same number of features, where they are at hand."""
    from veracity.operators.metrics import positive_weight
    if counts is None:
        counts = hashed(tagger_counts(features, [target]), num_features).persist()
        try:
            return fit_tagger(features, target, num_features, reg, max_iter, counts)
        finally:
            counts.unpersist()
    counts = counts if "features" in counts.columns else hashed(counts, num_features)
    n = counts.agg(F.coalesce(F.sum(f"{target}_pos"), F.lit(0)).alias("p"), F.coalesce(F.sum(f"{target}_neg"), F.lit(0)).alias("n"))
    pw = n.select(positive_weight(F.col("p"), F.col("n"))).first()[0]
    sides = F.array(F.struct(F.lit(1.0).alias("label"), (F.col(f"{target}_y") * F.lit(float(pw))).alias("weight")),
                    F.struct(F.lit(0.0).alias("label"), F.col(f"{target}_rest").alias("weight")))
    data = counts.where(F.col(f"{target}_y").isNotNull()).select("features", F.explode(sides).alias("s")).select(
        "features", "s.*").where("weight > 0")
    fitted = LogisticRegression(labelCol="label", weightCol="weight", regParam=reg, maxIter=max_iter,
                                rawPredictionCol="_raw", probabilityCol="_prob").fit(data)
    return PipelineModel(stages=[token_hasher(num_features), fitted])


def score_tagger(model: PipelineModel, features: DataFrame, out: str = "prob") -> DataFrame:
    """Adds ``out``, the probability of the target; ``hashed`` rows keep their features."""
    known = "features" in features.columns
    res = (model.stages[-1] if known else model).transform(features)
    return res.withColumn(out, vector_to_array(F.col("_prob"))[1]).drop(*([] if known else ["features"]), "_raw", "_prob", "prediction")


def score_with(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """M8: an external scorer applied per Arrow batch (load the model once per worker
    inside ``fn``'s closure or a module-level cache)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def word_evidence(model: PipelineModel, docs: DataFrame, key: str, text: str = "text", k: int = DEFAULT_EVIDENCE_K,
                  out: str = "evidence") -> DataFrame:
    """Evidence of a text model: per document, the k words with the largest share of
    |tf · weight| (first occurrence offsets), as ``array<struct<word,start,end,score>>``.

    A word's weight is what a document of that one word adds to the margin of the fitted
    stages, so every word is ranked; one that training has not seen has score 0.  Documents without
    words have no row.  Words are weighed once a slice of documents (``units``), only the finished rows are
    shuffled; of rows with the same key one counts."""
    stages = model.stages
    htf = next(s for s in stages if isinstance(s, HashingTF))
    rest = stages[next(i for i, s in enumerate(stages) if s is htf):]
    lr = rest[-1]

    def cut(texts: pa.Array):
        words, strings = O.Texts(texts).words()
        strings = strings.dictionary_encode()
        size = max(1, len(strings.dictionary))
        own, at, tf = np.unique(words.documents() * size + strings.indices.to_numpy(zero_copy_only=False),
                                return_index=True, return_counts=True)
        first = np.searchsorted(own // size, np.arange(len(texts) + 1))
        flat = (own % size, tf, words.index()[at], words.start[at], words.end[at])
        return [strings.dictionary], [(x, first) for x in flat]

    def weigh(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn(htf.getInputCol(), F.array(F.coalesce("_word", F.lit(""))))
        for stage in rest:
            rows = stage.transform(rows)
        return rows.withColumn("_weight", vector_to_array(F.col(lr.getRawPredictionCol()))[1] - F.lit(float(lr.intercept)))

    def finish(units: pa.RecordBatch, rows: pa.RecordBatch, n: dict[str, U.Flat]) -> pa.RecordBatch:
        (unit, first), (tf, _), (place, _) = n["_unit"], n["_times"], n["_place"]
        doc = np.repeat(np.arange(rows.num_rows), np.diff(first))
        share = np.abs(tf * units.column("_weight").to_numpy(zero_copy_only=False)[unit])
        total = np.bincount(doc, share, rows.num_rows)[doc]
        score = np.divide(share, total, out=np.zeros(len(share)), where=total > 0)
        at, begin = U.best(score, place, doc, rows.num_rows, k)
        found = U.listed(begin, word=units.column("_word").take(pa.array(unit[at])), start=pa.array(n["_start"][0][at], pa.int32()),
                         end=pa.array(n["_end"][0][at], pa.int32()), score=pa.array(score[at], pa.float64()))
        some = pa.array(np.flatnonzero(np.diff(first)))
        return pa.RecordBatch.from_arrays([rows.column(key).take(some), found.take(some)], [key, out])

    kind = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("start", T.IntegerType()),
                                     T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    rows = U.scored_in_place(docs, [key], text, ["_word"], ["_unit", "_times", "_place", "_start", "_end"], cut, weigh, ["_weight"],
                             finish, T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField(out, kind)]))
    return rows.groupBy(key).agg(F.max(out).alias(out))


def stage1_evidence(model: PipelineModel, docs: DataFrame, key: str, text: str = "text",
                    k: int = DEFAULT_EVIDENCE_K) -> DataFrame:
    """M5 evidence (see ``word_evidence``)."""
    return word_evidence(model, docs, key, text, k, "stage1_evidence")


def score_stage1(docs: DataFrame, models: dict[str, PipelineModel], key: str, temperature: float = 1.0,
                 text: str = "text", k: int = 0) -> DataFrame:
    """M5: ``(key, logit, suspicious_probability, predicted_total_attention[, stage1_evidence])``."""
    out = score_logit(models["stage1"], docs.select(key, text), temperature)
    if "total_attention" in models:
        out = score_soft(models["total_attention"], out, "predicted_total_attention")
    else:
        out = out.withColumn("predicted_total_attention", F.lit(None).cast("double"))
    out = out.select(key, "logit", "suspicious_probability", "predicted_total_attention")
    return out.join(stage1_evidence(models["stage1"], docs, key, text, k), key, "left") if k else out


def score_index(docs: DataFrame, models: dict[str, PipelineModel], thresholds: dict[str, float], key: str,
                text: str = "text", tokenizer: O.Tokenizer | None = None, max_length: int = DEFAULT_MAX_LENGTH,
                stride: int = DEFAULT_INDEX_STRIDE, k: int = 0) -> DataFrame:
    """M6: ``(key, <name>_index[, <name>_evidence])`` for each tagger in ``models``.

    A word's score is the maximum over its tokens and chunks (A11), the index the share of words from the
    model's threshold on (A12), the evidence the k best words (A13).  A token's margin is the intercept
    and what the token, its left and its right each add to it by the fitted stages, which weigh every
    distinct one once a slice of documents (``units``), without a shuffle.  Documents without words have index 0.0
    and no evidence.  ``key`` must be unique."""
    names = list(models)
    window = TK._window(max_length, stride)
    tokenizer = tokenizer or O.pieces()

    intercepts = {n: float(model.stages[-1].intercept) for n, model in models.items()}

    def score(rows: DataFrame) -> DataFrame:
        for name, model in models.items():
            raw = vector_to_array(F.col(model.stages[-1].getRawPredictionCol()))[1]
            rows = model.transform(rows).withColumn(f"_w_{name}", raw - F.lit(intercepts[name])).drop("features", "_raw", "_prob", "prediction")
        return rows

    def finish(units: pa.RecordBatch, rows: pa.RecordBatch, n: dict[str, U.Flat]) -> pa.RecordBatch:
        (code, tokens), (place, first), (word, _), (start, words), (end, _) = (n[x] for x in numbers)
        n_words = np.diff(words)
        at = np.repeat(words[:-1], np.diff(first)) + word
        heads = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
        doc = np.repeat(np.arange(rows.num_rows), n_words)
        cols = [rows.column(x) for x in (key, "_whole")]
        for name in names:
            best = np.zeros(len(start))
            if len(at):
                weights = units.column(f"_w_{name}").to_numpy(zero_copy_only=False)
                margin = intercepts[name] + TK.unit_margins(weights, code, tokens, place, first)
                best[at[heads]] = np.maximum.reduceat(1 - 1 / (1 + np.exp(margin)), heads)
            high = np.bincount(doc, best >= float(thresholds[name]), rows.num_rows)
            cols.append(pa.array(high / np.maximum(n_words, 1), pa.float64()))
            if k:
                top, begin = U.best(best, np.arange(len(best)), doc, rows.num_rows, k)
                cols.append(U.listed(begin, start=pa.array(start[top], pa.int32()), end=pa.array(end[top], pa.int32()),
                                     score=pa.array(best[top], pa.float64())))
        return pa.RecordBatch.from_arrays(cols, out.fieldNames())

    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                     T.StructField("score", T.DoubleType())]))
    out = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("_whole", T.StringType())])
    for name in names:
        out = out.add(f"{name}_index", T.DoubleType())
        out = out.add(f"_e_{name}", span) if k else out
    numbers = ["_code", "_place", "_word", "_start", "_end"]
    src = docs.select(key, F.col(text).cast("string").alias("_whole"))
    rows = U.scored_in_place(src, [key, "_whole"], "_whole", ["tok", "left", "right"], numbers,
                             lambda texts: TK.token_units(texts, tokenizer, window), score, [f"_w_{n}" for n in names], finish, out)
    # a row without a key is scored as one without words
    known = F.col(key).isNotNull()

    def evidence(n: str) -> Column:
        return F.when(known & (F.size(f"_e_{n}") > 0), F.transform(F.col(f"_e_{n}"), lambda e: F.struct(
            F.substring(F.col("_whole"), e["start"] + 1, e["end"] - e["start"]).alias("word"), e["start"].alias("start"),
            e["end"].alias("end"), e["score"].alias("score")))).alias(f"{n}_evidence")

    return rows.select(key, *(F.when(known, F.col(f"{n}_index")).otherwise(F.lit(0.0)).alias(f"{n}_index") for n in names),
                       *(evidence(n) for n in names if k))


def score_irony(docs: DataFrame, model: PipelineModel, key: str, text: str = "text", k: int = 0) -> DataFrame:
    """M7: ``(key, irony_index[, irony_evidence])``."""
    out = score_soft(model, docs.select(key, text), "irony_index").select(key, "irony_index")
    return out.join(word_evidence(model, docs, key, text, k, "irony_evidence"), key, "left") if k else out
