"""Loader, step-wise bundle, span policy and scoring with a bundle."""

import uuid

import pytest
from pyspark.sql import functions as F

from veracity.operators import models as MD
from veracity.operators import offsets as O
from veracity.operators import tokens as TK
from veracity.plans import training as TR
from veracity.session import ensure_checkpoint_dir
from veracity.sources.bundle import Stages, load_bundle


def folder(spark):
    return f"{ensure_checkpoint_dir(spark)}/training-{uuid.uuid4().hex}"


RAW = "n long, `제목` string, `내용` string, `라벨` string, emotion_score string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_load_articles(spark):
    rows = [(3, "t", " body ", "Real", "0.5"), (1, None, "one", "FAKE", "-0.5"), (2, "", "  ", "fake", "x"), (4, "only", None, "satire", "1")]
    got = TR.load_articles(raw(spark, rows), ["n"]).orderBy("row_key").collect()
    assert [(r["row_key"], r["id"], r["text"], r["label_norm"], r["emotion_score"]) for r in got] == [
        (0, "news-0000001", "one", "fake", None), (1, "news-0000003", "t\nbody", "real", 0.5), (2, "news-0000004", "only", "satire", 1.0)]
    assert [r["irony_spans"] for r in got] == [None] * 3
    zero = TR.load_articles(raw(spark, rows), ["n"], negative="zero").orderBy("row_key")
    assert [r[0] for r in zero.select("emotion_score").collect()] == [0.0, 0.5, 1.0]


def test_load_articles_names_every_broken_rule(spark):
    rows = [(1, None, "a", "maybe", "0.5"), (2, None, "b", "real", "1.5"), (3, None, "c", "real", "-1")]
    with pytest.raises(ValueError, match=r"emotion_score_above_one: 1 rows \(1\).*emotion_score_negative: 1 rows \(2\).*unknown_label: 1 rows \(0\)"):
        TR.load_articles(raw(spark, rows), ["n"], negative="error")
    with pytest.raises(ValueError, match="missing required columns.*text"):
        TR.load_articles(spark.createDataFrame([(1, "x")], "id long, label string"), ["id"])
    with pytest.raises(ValueError, match="order columns"):
        TR.load_articles(raw(spark, rows), ["nowhere"])


def test_steps_run_once_and_go_on_after_a_failure(spark):
    path, ran = folder(spark), []

    def step(name, fail=False):
        def run():
            ran.append(name)
            if fail:
                raise RuntimeError("lost")
            return {}, {name: len(ran), "nan": float("nan")}
        return run

    first = Stages(spark, path, {"a": 1})
    assert first.run("one", step("one")) == {"one": 1, "nan": None}
    with pytest.raises(RuntimeError):
        first.run("two", step("two", fail=True))
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, path)
    again = Stages(spark, path, {"a": 1})
    again.run("one", step("one"))
    again.run("two", step("two"))
    again.finish()
    assert ran == ["one", "two", "two"] and again.loaded == ["one"]
    assert load_bundle(spark, path) == ({}, {"config": {"a": 1}, "one": 1, "two": 3, "nan": None, "models": []})
    with pytest.raises(ValueError, match="another configuration"):
        Stages(spark, path, {"a": 2}).run("one", step("one"))


def test_span_policies_stop_the_job(spark):
    schema = "row_key long, text string, emotion_spans string, exaggeration_spans string"
    df = spark.createDataFrame([(1, "one two", '["one"]', "[]"), (2, "three", None, "[]")], schema)
    got = {r["row_key"]: r["_emotion_list"] for r in TR.annotated_rows(df, "exclude", "train").collect()}
    assert list(got) == [1] and [(s["start"], s["end"], s["score"]) for s in got[1]] == [(0, 3, 1.0)]
    assert TR.annotated_rows(df, "empty", "train").count() == 2
    with pytest.raises(ValueError, match=r"train: missing_spans: 1 rows \(2\)"):
        TR.annotated_rows(df, "error", "train")
    with pytest.raises(ValueError, match="no validation row"):
        TR.annotated_rows(df.where("row_key = 2"), "exclude", "validation")
    bad = spark.createDataFrame([(1, "one", "{broken", "[]")], schema)
    with pytest.raises(ValueError, match="unreadable annotations"):
        TR.annotated_rows(bad, "exclude", "train")


def test_score_index_against_its_tokens(spark):
    docs = spark.createDataFrame([(1, "bad good bad badly"), (2, "good day"), (3, " "), (4, None)], "id long, text string")
    spans = docs.where("id = 1").withColumn("spans", F.expr("array(struct(0 AS start, 3 AS end, 0.9 AS score))"))
    rows = TK.token_rows(spans, "id", tokenizer=O.pieces(3), max_length=4, stride=1, spans={"emotion": "spans"}, features=True)
    model = MD.fit_tagger(rows, "emotion", num_features=64, max_iter=5)
    got = {r["id"]: r for r in MD.score_index(docs, {"emotion": model}, {"emotion": 0.5}, "id", tokenizer=O.pieces(3),
                                              max_length=4, stride=1, k=2).collect()}
    assert set(got) == {1, 2, 3, 4}
    tokens = MD.score_tagger(model, TK.token_rows(docs, "id", tokenizer=O.pieces(3), max_length=4, stride=1, words=True, features=True))
    best = {}
    for r in tokens.collect():
        at = (r["id"], r["word_idx"], r["word_start"], r["word_end"])
        best[at] = max(best.get(at, 0.0), r["prob"])
    for i, text in ((1, "bad good bad badly"), (2, "good day")):
        words = sorted((w, s, e, p) for (d, w, s, e), p in best.items() if d == i)
        assert got[i]["emotion_index"] == sum(p >= 0.5 for *_, p in words) / len(words)
        top = sorted(words, key=lambda x: (-x[3], x[0]))[:2]
        assert [tuple(x) for x in got[i]["emotion_evidence"]] == [(text[s:e], s, e, p) for _, s, e, p in top]
    assert got[3]["emotion_index"] == got[4]["emotion_index"] == 0.0 and not got[3]["emotion_evidence"]


def test_soft_targets_weigh_both_sides(spark):
    rows = spark.createDataFrame([("a", "l", "r", 0.25), ("a", "l", "r", None)] * 20, "tok string, left string, right string, y double")
    p = MD.score_tagger(MD.fit_tagger(rows, "y", num_features=16, reg=0.0), rows).first()["prob"]
    assert abs(p - 0.25) < 1e-3
