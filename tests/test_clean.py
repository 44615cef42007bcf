from pyspark.sql import functions as F

from veracity.operators import clean as K


def test_negative_policies(spark):
    df = spark.createDataFrame([(1, -0.5), (2, 0.0), (3, 1.0), (4, 1.2), (5, None)], "k int, x double")
    get = lambda pol: [r[0] for r in df.orderBy("k").select(K.negative_policy("x", pol)).collect()]
    assert get("missing") == [None, 0.0, 1.0, 1.2, None]
    assert get("zero") == [0.0, 0.0, 1.0, 1.2, None]
    assert get("rescale_minus1_1") == [0.25, 0.5, 1.0, 1.1, None]
    v = K.validate(df, K.negative_policy_violations("x", "error"), "k").collect()
    assert {r["rule"]: (r["bad_rows"], r["sample"]) for r in v} == {"above_one": (1, "4"), "negative": (1, "1")}


def test_span_policies_and_report(spark):
    rows = [("1", 1, "fake", "[]", None), ("2", 2, "satire", "  ", "[]"), ("3", 3, "fake", '["a"]', "[]")]
    df = spark.createDataFrame(rows, "id string, row_key long, label string, emotion_spans string, "
                                     "exaggeration_spans string")
    assert sorted(r["row_key"] for r in K.apply_span_policy(df, "exclude").collect()) == [3]
    filled = K.apply_span_policy(df, "empty").orderBy("row_key").collect()
    assert [(r["emotion_spans"], r["exaggeration_spans"]) for r in filled] == [("[]", "[]"), ("[]", "[]"), ('["a"]', "[]")]
    rep = K.missing_span_report({"train": df.where("row_key < 3"), "validation": df.where("row_key >= 3")})
    assert sorted((r["split"], r["row_key"]) for r in rep.collect()) == [("train", 1), ("train", 2)]


def test_conform_and_title(spark):
    df = spark.createDataFrame([(" 7 ", "제목 ", " 본문　", "진짜 ")], ["넘버링 ", "title", "내용", "라벨"])
    c = K.merge_title(K.conform_columns(df))
    assert c.columns == ["id", "title", "text", "label"]
    assert c.first()["text"] == "제목\n본문"
    ids = K.with_generated_ids(c.drop("id"), ["label"]).first()["id"]
    assert ids == "news-0000001"
