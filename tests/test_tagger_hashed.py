"""Tokens of the taggers are hashed once, before they are kept, fitted and scored."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from veracity.operators import models as MD

ROWS = [(w, None if i == 0 else "ab"[i % 2] * 3, "end", float(i % 3 == 0)) for i, w in enumerate(["one", "two", "three", "two", "four", "한국", "one"] * 5)]


def _rows(spark):
    return spark.createDataFrame(ROWS, "tok string, left string, right string, y double")


def test_fit_and_scores_are_those_of_the_words(spark):
    counts = MD.tagger_counts(_rows(spark), ["y"])
    kept = MD.hashed(counts, 64).cache()
    assert "features" in kept.columns and not {"tok", "left", "right"} & set(kept.columns)
    a, b, c = (MD.fit_tagger(_rows(spark), "y", num_features=64, max_iter=8, counts=x) for x in (kept, counts, None))
    pw = _rows(spark).agg(F.least(F.lit(30.0), F.greatest(F.lit(0.5), F.count_if(F.col("y") < 0.5) / F.count_if(F.col("y") >= 0.5)))).first()[0]
    sides = F.array(F.struct(F.lit(1.0).alias("label"), (F.col("y_y") * F.lit(pw)).alias("weight")),
                    F.struct(F.lit(0.0).alias("label"), F.col("y_rest").alias("weight")))
    data = counts.select("tok", "left", "right", F.inline(sides)).where("weight > 0")
    plain = Pipeline(stages=[MD.token_hasher(64), LogisticRegression(weightCol="weight", regParam=0.01, maxIter=8)]).fit(data)
    for m in (a, b, c):
        assert max(abs(x - y) for x, y in zip(m.stages[-1].coefficients.toArray(), plain.stages[-1].coefficients.toArray())) < 1e-6
    by_word = sorted(r["prob"] for r in MD.score_tagger(a, counts).collect())
    by_hash = MD.score_tagger(a, kept)
    assert "features" in by_hash.columns and by_word == sorted(r["prob"] for r in by_hash.collect())


def test_passes_of_a_fit_do_not_hash_again(spark, monkeypatch):
    kept, calls = MD.hashed(MD.tagger_counts(_rows(spark), ["y"]), 64).cache(), []
    real = MD.FeatureHasher.transform
    monkeypatch.setattr(MD.FeatureHasher, "transform", lambda self, *a: calls.append(1) or real(self, *a))
    model = MD.fit_tagger(_rows(spark), "y", num_features=64, max_iter=3, counts=kept)
    MD.score_tagger(model, kept).count()
    assert not calls
