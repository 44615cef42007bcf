"""Readers that must not lose rows, and values without a target or number."""

import json

from pyspark.sql import functions as F

from veracity.functions.rules import suspicious_target
from veracity.operators.clean import check_range, with_numeric_scores
from veracity.sources.articles import read_articles_json


def test_json_envelopes_side_by_side(spark, tmp_path):
    rec = lambda i, **k: {"id": str(i), "text": f"t{i}", "label": "real", **k}
    docs = [[rec(1), rec(2, items=[{"id": "x", "text": "inner"}])], rec(3), []]
    docs += [{k: [rec(10 + i)]} for i, k in enumerate(["data", "records", "items", "news", "articles"])]
    docs += [{"data": [rec(20, emotion_spans=[{"text": "한글", "score": 0.5}])], "other": 1}]
    for i, d in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(d, ensure_ascii=False), encoding="utf-8-sig" if i % 2 else "utf-8")
    got = {r["id"]: r for r in read_articles_json(spark, str(tmp_path)).collect()}
    assert sorted(got) == sorted(["1", "2", "3", "10", "11", "12", "13", "14", "20"])
    assert got["2"]["text"] == "t2"
    assert json.loads(got["20"]["emotion_spans"]) == [{"text": "한글", "score": 0.5}]


def test_targets_and_numbers(spark):
    df = spark.createDataFrame([("fake",), ("satire",), ("real",), ("x",), (None,)], "label string")
    assert [r[0] for r in df.select(suspicious_target("label")).collect()] == [1, 1, 0, None, None]
    s = spark.createDataFrame([("1_0",), ("NAN",), ("0.5",), (" 1 ",), (None,), ("abc",)], "emotion_score string")
    got = [r[0] for r in with_numeric_scores(s, ["emotion_score"]).collect()]
    assert got == [None, None, 0.5, 1.0, None, None]
    x = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, 0.5)], "k long, v double")
    assert check_range(x, ["v"], "k").select(F.col("bad_rows")).first()[0] == 1


def test_stratified_split_takes_null_labels(spark):
    from veracity.operators.splits import stratified_split

    df = spark.createDataFrame([(i, ["a", "b", None][i % 3], "text") for i in range(90)], "k long, label string, text string")
    out = stratified_split(df, "label", "k", 0.2, 0.1)
    assert out.columns == ["k", "label", "text", "split"] and out.count() == 90
    test = out.where("split = 'test'").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in test} == {"a": 6, "b": 6, None: 6}
