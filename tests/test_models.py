from pyspark.ml.feature import HashingTF


def test_stage1_evidence_ranks_words_without_weight(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF

    from veracity.operators.models import stage1_evidence
    train = spark.createDataFrame([(["good"], 0.0), (["bad"], 1.0)] * 3, "t array<string>, label double")
    model = Pipeline(stages=[HashingTF(inputCol="t", outputCol="v", numFeatures=1 << 16), IDF(inputCol="v", outputCol="f"),
                             LogisticRegression(featuresCol="f", regParam=0.1)]).fit(train)
    docs = spark.createDataFrame([(1, "new bad other words"), (2, "all unseen"), (3, "a b c d e f g h bad")],
                                 "id long, text string")
    got = {r["id"]: r["stage1_evidence"] for r in stage1_evidence(model, docs, "id").collect()}
    assert [e["word"] for e in got[1]] == ["bad", "new", "other", "words"]
    assert [round(e["score"], 6) for e in got[1]] == [1, 0, 0, 0]
    assert [(e["word"], e["score"]) for e in got[2]] == [("all", 0), ("unseen", 0)]
    assert [e["word"] for e in got[3]] == ["bad", *"abcdefg"]


def test_soft_label_rows(spark):
    from veracity.operators.models import soft_label_rows
    df = spark.createDataFrame([("a", 0.25), ("b", 1.0), ("c", None)], "text string, y double")
    rows = sorted((r["text"], r["label"], r["weight"]) for r in soft_label_rows(df, "y").collect())
    assert rows == [("a", 0.0, 0.75), ("a", 1.0, 0.25), ("b", 1.0, 1.0)]
