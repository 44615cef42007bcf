"""Driver queries for the ``pyspark.ml`` scorers and the training job (phase 10–11).

Fitted models are not expressible in SQL.  These queries give, for every row of the real output,
what SQL can tell of it (rows, number of evidence words, support of the report) and whether the
rest holds (ranges, offsets of evidence, the condition a fit meets at its optimum, equal results of
two ways); ``score_with`` has a closed formula."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from veracity.functions.text import py_strip
from veracity.operators import models as MD
from veracity.operators import splits as S
from veracity.operators import tuning as C
from veracity.operators.metrics import bce_with_logits, class_weight, positive_weight
from veracity.operators.offsets import pieces
from veracity.operators.prefix import attach
from veracity.plans import jobs as J
from veracity.plans.q_splits import GROUP_SPLIT_SQL, LABELLED_SQL
from veracity.plans.q_tokens import MAX_LENGTH, PIECE, STRIDE, annotated, chunk_token_scores
from veracity.plans.registry import query, table
from veracity.plans.sqlparts import DOC_WORDS
from veracity.plans.training import run_training
from veracity.schema import CLASS_ORDER, LABEL_DISPLAY
from veracity.session import ensure_checkpoint_dir, table_path
from veracity.sources import articles as A
from veracity.sources.bundle import load_bundle, save_bundle
from veracity.streaming.detect import detect_with_bundle, read_stream


def articles(spark, sf_dir):
    """Labelled documents as ARTICLE-like rows with deterministic soft scores."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id")
    label = F.when(F.col("toxic") == 1, "satire").when(F.col("quality") == 1, "real").otherwise("fake")
    return j.select(
        F.col("doc_id").alias("row_key"), "text", F.col("source").alias("group_id"), label.alias("label_norm"),
        F.when(label.isin("fake", "satire"), 1).otherwise(0).alias("suspicious_target"),
        (((F.col("doc_id") * 31) % 101) / 100).alias("irony_score"),
        (((F.col("doc_id") * 17) % 101) / 100).alias("total_attention"),
        F.when(F.col("doc_id") % 4 != 3, ((F.col("doc_id") * 3) % 11) / 10).alias("emotion_score"),
        F.when(F.col("doc_id") % 4 != 2, ((F.col("doc_id") * 5) % 11) / 10).alias("exaggeration_score"))


def split(spark, sf_dir):
    return S.group_split(articles(spark, sf_dir), "group_id", "row_key")


SPLIT_SQL = GROUP_SPLIT_SQL.replace("FROM documents)", f"FROM ({LABELLED_SQL}) z)").replace(
    "FROM documents d", f"FROM ({LABELLED_SQL}) d")
HELD_OUT_SQL = f"SELECT doc_id AS row_key FROM ({SPLIT_SQL}) WHERE split <> 'train'"


def balanced(scored, y, p, weight=None):
    """One row ``balanced``: the weighted means of prediction and target agree, as they do where the loss is
    least in the intercept (within 0.02, for the steps that are left)."""
    w = F.lit(1.0) if weight is None else weight
    return scored.agg((F.abs(F.sum(w * (F.col(p) - F.col(y))) / F.sum(w)) < 0.02).alias("balanced"))


@query("fit_suspicion", f"SELECT doc_id AS row_key, split, TRUE AS sigmoid_ok, TRUE AS balanced FROM ({SPLIT_SQL}) WHERE split <> 'train'")
def q_fit_suspicion(spark, sf_dir):
    """M1: scores of the held-out rows; ``balanced`` on the rows it was fitted on."""
    s = split(spark, sf_dir)
    train = s.where(F.col("split") == "train")
    model = MD.fit_suspicion(train, num_features=1 << 16, max_iter=30)
    out = MD.score_logit(model, s.where(F.col("split") != "train"))
    weight = class_weight(train, "suspicious_target").first()["class_weight"]
    own = balanced(MD.score_logit(model, train), "suspicious_target", "suspicious_probability",
                   F.when(F.col("suspicious_target") == 1, F.lit(float(weight))).otherwise(1.0))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit")))
    return attach(out.select("row_key", "split", (F.abs(p - F.col("suspicious_probability")) < 1e-9).alias("sigmoid_ok")), own)


def training_articles(spark, sf_dir):
    """``articles`` with annotation cells: the emotion cells of ``q_tokens.annotated``; for exaggeration the
    second word as a phrase, every 6th cell missing."""
    cells = annotated(spark, sf_dir)
    second = F.try_element_at("words", F.lit(2))["word"]
    cell = F.to_json(F.array(F.struct(second.alias("phrase"), ((F.col("doc_id") % 7) / 7).alias("score"))))
    cells = cells.select(F.col("doc_id").alias("row_key"), "emotion_spans",
                         F.when(F.col("doc_id") % 6 != 0, cell).alias("exaggeration_spans"))
    return articles(spark, sf_dir).join(cells, "row_key")


SMALL = {"num_features": 1 << 12, "max_iter": 5, "piece": PIECE, "max_length": MAX_LENGTH, "stride": STRIDE}
_BUNDLES: dict[tuple[str, str], str] = {}


def trained_bundle(spark, sf_dir):
    """Models and metadata as loaded from a bundle that ``run_training`` saved, made once an application and table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUNDLES:
        path = A.scratch_path(spark, "trained-bundle")
        run_training(training_articles(spark, sf_dir), path, **SMALL)
        _BUNDLES[key] = path
    return load_bundle(spark, _BUNDLES[key])


def evidence_ok(text, evidence):
    """Every word stands at its offsets, scores fall, and all are between 0 and 1."""
    text, e = F.col(text), F.col(evidence)
    at = F.forall(e, lambda x: (F.substring(text, x["start"] + 1, x["end"] - x["start"]) == x["word"])
                  & (x["score"] >= 0) & (x["score"] <= 1 + 1e-9))
    falling = F.transform(e, lambda x: -x["score"])
    return F.coalesce(at & (falling == F.array_sort(falling)), F.lit(True))


def n_evidence(evidence):
    return F.coalesce(F.size(evidence), F.lit(0)).cast("bigint")


N_WORDS_SQL = f"SELECT doc_id, count(*) AS n, count(DISTINCT word) AS d FROM ({DOC_WORDS}) GROUP BY doc_id"

@query("score_stage1", f"""
SELECT s.doc_id AS row_key, least(8, coalesce(n.d, 0)) AS n_evidence, TRUE AS evidence_ok, TRUE AS scores_ok
FROM ({SPLIT_SQL}) s LEFT JOIN ({N_WORDS_SQL}) n ON n.doc_id = s.doc_id WHERE s.split <> 'train'
""")
def q_score_stage1(spark, sf_dir):
    """M5 with both models on the held-out rows."""
    models, meta = trained_bundle(spark, sf_dir)
    test = S.group_split(articles(spark, sf_dir), "group_id", "row_key").where("split <> 'train'").select("row_key", "text")
    out = MD.score_stage1(test, models, "row_key", meta["stage1_temperature"], k=8).join(test, "row_key")
    p, a = "suspicious_probability", "predicted_total_attention"
    return out.select("row_key", n_evidence("stage1_evidence").alias("n_evidence"), evidence_ok("text", "stage1_evidence").alias("evidence_ok"),
                      (F.col(p).between(0, 1) & F.col(a).between(0, 1)).alias("scores_ok"))


@query("score_index", f"""
SELECT d.doc_id, least(8, coalesce(n.n, 0)) AS n_emotion, least(8, coalesce(n.n, 0)) AS n_exaggeration,
       TRUE AS evidence_ok, TRUE AS whole_shares
FROM documents d LEFT JOIN ({N_WORDS_SQL}) n ON n.doc_id = d.doc_id
""")
def q_score_index(spark, sf_dir):
    """M6 on all documents: both indexes are whole shares of the words, the evidence is the document's own words."""
    models, meta = trained_bundle(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = J.index_scores(docs, models, meta, "doc_id", k=8).join(docs, "doc_id")
    n = F.size(F.regexp_extract_all("text", F.lit(r"(\S+)"), 1))
    share = lambda c: (F.col(c).between(0, 1) & (F.abs(F.col(c) * n - F.round(F.col(c) * n)) < 1e-6))
    return out.select("doc_id", n_evidence("emotion_evidence").alias("n_emotion"), n_evidence("exaggeration_evidence").alias("n_exaggeration"),
                      (evidence_ok("text", "emotion_evidence") & evidence_ok("text", "exaggeration_evidence")).alias("evidence_ok"),
                      (share("emotion_index") & share("exaggeration_index")).alias("whole_shares"))


@query("score_irony", f"""
SELECT d.doc_id, least(8, coalesce(n.d, 0)) AS n_evidence, TRUE AS evidence_ok, TRUE AS in_range
FROM documents d LEFT JOIN ({N_WORDS_SQL}) n ON n.doc_id = d.doc_id
""")
def q_score_irony(spark, sf_dir):
    """M7 on all documents."""
    models, _ = trained_bundle(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = MD.score_irony(docs, models["irony"], "doc_id", k=8).join(docs, "doc_id")
    return out.select("doc_id", n_evidence("irony_evidence").alias("n_evidence"), evidence_ok("text", "irony_evidence").alias("evidence_ok"),
                      F.col("irony_index").between(0, 1).alias("in_range"))


@query("detect_bundle", f"""
SELECT d.doc_id AS row_key, least(8, coalesce(n.d, 0)) AS n_evidence, TRUE AS same, TRUE AS gate_ok, TRUE AS evidence_ok
FROM documents d LEFT JOIN ({N_WORDS_SQL}) n ON n.doc_id = d.doc_id
""")
def q_detect_bundle(spark, sf_dir):
    """All documents as a table and as a file stream, by one reloaded bundle.

    ``same``: both give the same row, evidence included; ``gate_ok``: stage 2 ran exactly for the rows
    that pass stage 1, and the others are real."""
    models, meta = trained_bundle(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    path = table_path(sf_dir, "documents").replace("documents.parquet", "documents*.parquet")
    out = A.scratch_path(spark, "detect-bundle")
    detect_with_bundle(read_stream(spark, path, docs.schema), models, meta, f"{out}/data", f"{out}/checkpoint", key="doc_id")
    batch = J.detect(docs, models, meta, key="doc_id")
    evidence = [c for c in batch.columns if c.endswith("_evidence")]

    def rounded(df):
        for c in evidence:
            df = df.withColumn(c, F.transform(c, lambda e: F.struct(e["word"], e["start"], e["end"], F.round(e["score"], 6))))
        for c, kind in df.dtypes:
            if kind == "double":
                df = df.withColumn(c, F.round(c, 6))
        return df.select("doc_id", F.to_json(F.struct(*batch.columns)).alias("row"))

    stream = rounded(spark.read.parquet(f"{out}/data").select(*batch.columns))
    same = rounded(batch).join(stream.withColumnRenamed("row", "other"), "doc_id", "full").select(
        "doc_id", F.col("row").eqNullSafe(F.col("other")).alias("same"))
    text = docs.select("doc_id", py_strip("text").alias("text"))
    j = batch.join(same, "doc_id").join(text, "doc_id")
    second = F.col("emotion_index").isNotNull() & F.col("irony_index").isNotNull()
    gate = (F.col("stage1_passed") == second) & (F.col("stage1_passed") | (F.col("final_label") == LABEL_DISPLAY["real"]))
    ok = [evidence_ok("text", c) for c in evidence]
    return j.select(F.col("doc_id").alias("row_key"), n_evidence("stage1_evidence").alias("n_evidence"), "same", gate.alias("gate_ok"),
                    (ok[0] & ok[1] & ok[2] & ok[3]).alias("evidence_ok"))


def _soft_fit(spark, sf_dir, target, out):
    s = split(spark, sf_dir)
    train = s.where(F.col("split") == "train")
    model = MD.fit_soft_regressor(train, target, num_features=1 << 16, max_iter=30)
    held_out = MD.score_soft(model, s.where(F.col("split") != "train"), out)
    own = balanced(MD.score_soft(model, train, out), target, out)
    return attach(held_out.select("row_key", F.col(out).between(0, 1).alias("in_range")), own)


@query("fit_irony", f"SELECT row_key, TRUE AS in_range, TRUE AS balanced FROM ({HELD_OUT_SQL})")
def q_fit_irony(spark, sf_dir):
    """M3: scores of the held-out rows; ``balanced`` on the rows it was fitted on."""
    return _soft_fit(spark, sf_dir, "irony_score", "irony_index")


@query("fit_total_attention", f"SELECT row_key, TRUE AS in_range, TRUE AS balanced FROM ({HELD_OUT_SQL})")
def q_fit_total_attention(spark, sf_dir):
    """M4, as M3."""
    return _soft_fit(spark, sf_dir, "total_attention", "predicted_total_attention")


@query("fit_taggers", "SELECT doc_id, TRUE AS whole_share, TRUE AS balanced FROM documents")
def q_fit_taggers(spark, sf_dir):
    """M2 + M6: token tagger on span-derived targets, then word scores and the index, a whole share of
    the words; ``balanced`` on the tokens it was fitted on."""
    rows = chunk_token_scores(spark, sf_dir, features=True).withColumnRenamed("target", "emotion")
    # fitted on three documents of four by the hash of the id, scored on all
    train = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0)
    ensure_checkpoint_dir(spark)
    counts = MD.hashed(MD.tagger_counts(train, ["emotion"]), 1 << 16).checkpoint()
    model = MD.fit_tagger(train, "emotion", num_features=1 << 16, max_iter=20, counts=counts)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    idx = MD.score_index(docs, {"emotion": model}, {"emotion": 0.5}, "doc_id", tokenizer=pieces(PIECE),
                         max_length=MAX_LENGTH, stride=STRIDE)
    n = F.size(F.regexp_extract_all("text", F.lit(r"(\S+)"), 1))
    x = F.col("emotion_index")
    whole = x.between(0, 1) & (F.abs(x * n - F.round(x * n)) < 1e-6)
    # the sums over equal tokens give the same weighted means as the tokens
    marked = counts.agg(F.sum("emotion_pos").alias("p"), F.sum("emotion_neg").alias("n")).select(
        positive_weight(F.col("p"), F.col("n")).alias("_pw"))
    y = F.col("_pw") * F.col("emotion_y")
    scored = attach(MD.score_tagger(model, counts), marked).select(
        "prob", (y + F.col("emotion_rest")).alias("w"), (y / (y + F.col("emotion_rest"))).alias("y"))
    own = balanced(scored, "y", "prob", F.col("w"))
    return attach(idx.join(docs, "doc_id").select("doc_id", whole.alias("whole_share")), own)


def _len_score(pdf: pd.DataFrame) -> pd.DataFrame:
    n = pdf["text"].str.len()
    return pd.DataFrame({"doc_id": pdf["doc_id"], "score": (n % 997) / 997})


@query("score_with", "SELECT doc_id, round((length(text) % 997) / 997, 6) AS score FROM documents")
def q_score_with(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = MD.score_with(d, _len_score, "doc_id long, score double")
    return out.select("doc_id", F.round("score", 6).alias("score"))


@query("bundle_roundtrip", f"SELECT row_key, TRUE AS same, TRUE AS nan_to_null FROM ({HELD_OUT_SQL})")
def q_bundle_roundtrip(spark, sf_dir):
    """Save the suspicion model with its metadata, load it back, score again."""
    s = split(spark, sf_dir)
    model = MD.fit_suspicion(s.where(F.col("split") == "train"), num_features=1 << 16, max_iter=30)
    path = A.scratch_path(spark, "bundle")
    save_bundle(spark, {"stage1": model}, {"stage1_temperature": 1.0, "stage1_threshold": {"threshold": 0.5},
                                           "loss": float("nan")}, path)
    models, meta = load_bundle(spark, path)
    test = s.where(F.col("split") != "train")
    a = MD.score_logit(model, test).select("row_key", F.col("suspicious_probability").alias("p0"))
    b = MD.score_logit(models["stage1"], test).select("row_key", F.col("suspicious_probability").alias("p1"))
    return a.join(b, "row_key").select("row_key", (F.abs(F.col("p0") - F.col("p1")) < 1e-12).alias("same"),
                                       F.lit(meta["loss"] is None).alias("nan_to_null"))


@query("fit_temperature", "SELECT TRUE AS positive, TRUE AS best, TRUE AS loss_ok")
def q_fit_temperature(spark, sf_dir):
    """C1 on the stand-in logits: no temperature a little higher or lower has a smaller loss."""
    from veracity.plans.q_scores import scored
    s = scored(spark, sf_dir)
    y = F.col("y").cast("double")
    fitted = C.fit_temperature(s, "logit", y)
    at = attach(s.withColumn("_y", y), fitted.select(F.col("temperature").alias("_t"), F.col("loss").alias("_l")))
    loss = lambda f: F.avg(bce_with_logits(F.col("logit") / (F.col("_t") * f), F.col("_y")))
    r = at.agg(F.first("_t").alias("t"), F.first("_l").alias("l"), loss(1.0).alias("here"), loss(1.01).alias("up"), loss(0.99).alias("down"))
    return r.select((F.col("t") > 0).alias("positive"), ((F.col("here") <= F.col("up") + 1e-9) & (F.col("here") <= F.col("down") + 1e-9)).alias("best"),
                    (F.abs(F.col("here") - F.col("l")) < 1e-6).alias("loss_ok"))


@query("run_training", f"""
WITH t AS (SELECT a.label_norm AS v FROM ({SPLIT_SQL}) s JOIN ({LABELLED_SQL}) a ON a.doc_id = s.doc_id WHERE s.split = 'test'),
g AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{LABEL_DISPLAY[c]}')" for c in CLASS_ORDER)}) x(v, label))
SELECT label, CAST((SELECT count(*) FROM t WHERE t.v = g.v) AS DOUBLE) AS support, TRUE AS in_range, TRUE AS same, 4 AS loaded FROM g
UNION ALL SELECT label, CAST((SELECT count(*) FROM t) AS DOUBLE), TRUE, TRUE, 4
FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) x(label)
""")
def q_run_training(spark, sf_dir):
    """The whole training job on the labelled documents, and once more from its bundle.

    ``same``: the second run, which loads every fitted step, has the same report."""
    data, path = training_articles(spark, sf_dir), A.scratch_path(spark, "training")
    first = run_training(data, path, A.scratch_path(spark, "progress"), **SMALL)["report"]
    again = run_training(data, path, **SMALL)
    cols = ("precision", "recall", "f1", "support")
    in_range = F.forall(F.array("precision", "recall", "f1"), lambda x: x.isNull() | x.between(0, 1))
    key = lambda df: df.select("label", "support", in_range.alias("in_range"), F.to_json(F.struct(*cols)).alias("r"))
    b = key(again["report"]).select("label", F.col("r").alias("_r"))
    return key(first).join(b, "label").select("label", "support", "in_range", F.col("r").eqNullSafe(F.col("_r")).alias("same"),
                                              F.lit(len(again["loaded"])).alias("loaded"))
