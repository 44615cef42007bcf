"""What keeps the work of a query bounded on tables of any size."""

import pyarrow as pa
from pyspark.sql import functions as F

from veracity.operators import losses as L
from veracity.operators import models as MD
from veracity.operators import offsets as O
from veracity.operators import tokens as TK
from veracity.plans import registry
from veracity.session import BATCH, BATCH_BYTES


def test_batches_of_a_query_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(registry, "QUERIES", {})
    monkeypatch.setattr(registry, "ORACLE", {})

    @registry.query("sizes")
    def sizes(spark, sf_dir):
        texts = spark.range(0, 1500, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
        return texts.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long")

    before = spark.conf.get(BATCH_BYTES)
    try:
        seen = [r["n"] for r in registry.QUERIES["sizes"](spark, "").collect()]
        assert sum(seen) >= 30_000_000 and max(seen) <= 2 * BATCH
        spark.conf.set(BATCH_BYTES, "1k")
        registry.QUERIES["sizes"](spark, "")
        assert spark.conf.get(BATCH_BYTES) == "1k"
    finally:
        spark.conf.set(BATCH_BYTES, before)


def _texts(spark):
    words = ["alpha", "be", "gamma-delta", "<s>", "é😀é😀é", "w", "</s>"]
    rows = [(i, " ".join(words[(i * j + j) % len(words)] for j in range(3 + i * 7)) + "\n") for i in range(12)]
    return spark.createDataFrame([*rows, (100, None), (101, ""), (102, " \n")], "id long, text string").repartition(2).cache()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_scores_are_those_of_every_token_without_a_shuffle(spark):
    docs = _texts(spark)
    some = docs.where("length(text) > 3")
    rows = TK.token_rows(some, "id", tokenizer=O.pieces(4), max_length=12, stride=3, words=True, features=True)
    models = {}
    for n in ("a", "b"):
        target = F.pmod(F.hash("tok", F.lit(n)), F.lit(11)) / 10
        models[n] = MD.fit_tagger(rows.where("tok_pos is not null").withColumn("y", target), "y", num_features=64, max_iter=5)
    out = MD.score_index(docs, models, {"a": 0.5, "b": 0.45}, "id", tokenizer=O.pieces(4), max_length=12, stride=3, k=3)
    assert _plan(out).count("Exchange") == _plan(docs).count("Exchange")
    found = {r["id"]: r for r in out.collect()}
    assert sorted(found) == sorted(r["id"] for r in docs.collect())
    for r in (found[100], found[101], found[102]):
        assert r["a_index"] == 0.0 and r["a_evidence"] is None and r["b_evidence"] is None
    for n, threshold in (("a", 0.5), ("b", 0.45)):
        scores = {}
        for r in MD.score_tagger(models[n], rows).collect():
            key = (r["id"], r["word_idx"], r["word_start"], r["word_end"])
            scores[key] = max(scores.get(key, 0.0), r["prob"] if r["tok_pos"] is not None else 0.0)
        for i in {k[0] for k in scores}:
            own = sorted(((-round(s, 9), k[1], k[2], k[3]) for k, s in scores.items() if k[0] == i))
            share = sum(-s >= threshold for s, *_ in own) / len(own)
            assert abs(found[i][f"{n}_index"] - share) < 1e-9
            assert [(e["start"], e["end"], -round(e["score"], 9)) for e in found[i][f"{n}_evidence"]] == [
                (a, b, s) for s, _, a, b in own[:3]]


def test_word_evidence_shuffles_only_finished_rows(spark):
    docs = _texts(spark)
    train = docs.where("length(text) > 3").withColumn("y", F.pmod(F.hash("id"), F.lit(11)) / 10)
    model = MD.fit_soft_regressor(train, "y", num_features=64, max_iter=5)
    out = MD.word_evidence(model, docs, "id", k=2)
    plan = _plan(out)
    assert "Window" not in plan and plan.count("Exchange") <= _plan(docs).count("Exchange") + 1
    found = {r["id"]: r["evidence"] for r in out.collect()}
    texts = {r["id"]: r["text"] for r in train.collect()}
    assert found.keys() == texts.keys()
    alone = spark.createDataFrame([(w,) for w in sorted({w for t in texts.values() for w in t.split()})], "text string")
    bare = model.stages[-1].intercept
    weight = {r["text"]: r["logit"] - bare for r in MD.score_logit(model, alone).collect()}
    for i, text in texts.items():
        share = {w: abs(text.split().count(w) * weight[w]) for w in text.split()}
        total = sum(share.values()) or 1
        best = sorted(((-round(s / total, 9), text.split().index(w), w) for w, s in share.items()))[:2]
        assert [(e["word"], -round(e["score"], 9)) for e in found[i]] == [(w, s) for s, _, w in best]
        assert all(text[e["start"]:e["end"]] == e["word"] and text.split()[:1] for e in found[i])


def test_equal_tokens_are_fitted_as_one_row(spark):
    rows = spark.createDataFrame([("a", "l", "r", 1.0)] * 5 + [("a", "l", "r", 0.25)] * 3 + [("b", "l", "r", 0.0), ("b", "l", "r", None)],
                                 "tok string, left string, right string, y double")
    counts = {r["tok"]: r for r in MD.tagger_counts(rows, ["y"]).collect()}
    assert [(r["y_y"], r["y_rest"], r["y_pos"], r["y_neg"]) for r in (counts["a"], counts["b"])] == [(5.75, 2.25, 5, 3), (0.0, 1.0, 0, 1)]
    model = MD.fit_tagger(rows, "y", num_features=16, max_iter=20)
    p = {r["tok"]: r["prob"] for r in MD.score_tagger(model, rows).collect()}
    assert p["a"] > p["b"]


def test_index_loss_reads_the_tokens_once(spark):
    tokens = spark.range(20).select(F.lit(0).alias("start"), (F.col("id") % 3).cast("int").alias("end"), (F.col("id") % 2).alias("t"),
                                    F.col("id").cast("double").alias("z"))
    seen = tokens.mapInArrow(lambda batches: batches, tokens.schema)
    docs = spark.createDataFrame([(1.0, 0.5)], "s double, p double")
    out = L.index_loss(seen, docs, "t", "z", "t", "z", "s", "p", "s", "p")
    assert _plan(out).split("== Initial Plan ==")[0].count("MapInArrow") == 1
    one = L.masked_token_bce(tokens, "t", "z").first()[0]
    r = out.first()
    assert abs(r["emotion_bce"] - one) < 1e-12 and abs(r["loss"] - (2 * one + 0.25)) < 1e-9
