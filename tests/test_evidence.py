"""The best words of a document: what a batch leaves out before the shuffle changes nothing."""

import random

import pytest
from pyspark.sql import functions as F

from veracity.operators import offsets as O
from veracity.operators import pooling as PL
from veracity.operators import tokens as TK


@pytest.fixture
def texts(spark):
    """Texts of equal and different words, some under one key, one key NULL; batches hold a few rows."""
    rng = random.Random(5)
    rows = [(i % 17, " ".join(rng.choice(["a", "bcdefg", "hij", "é😀é😀é"]) for _ in range(rng.randrange(60)))) for i in range(30)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    yield spark.createDataFrame([*rows, (50, None), (51, " \n"), (None, "a b c"), (52, rows[0][1]), (52, rows[0][1])],
                                "k long, text string").repartition(3).cache()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


SIZES = {"tokenizer": O.matches(r"\S\s?\S|[a-h]"), "max_length": 12, "stride": 3}


def _sorted(df):
    return sorted(str(tuple(r)) for r in df.collect())


def _prob(t=None):
    """NaN, NULL, negative and equal values, of a token in long form or beside its word."""
    start, chunk = (F.col(x) if t is None else t[x] for x in ("start", "chunk_idx"))
    h = (start * 5 + chunk * 3) % 7
    return F.when(h == 0, F.lit(float("nan"))).when(h == 1, F.lit(None)).when(h == 2, F.lit(-0.5)).otherwise(h / 10)


def test_words_hold_their_tokens(spark, texts):
    names = ["chunk_idx", "pos", "tok_pos", "start", "end"]
    flat = TK.token_rows(texts, "k", words=True, **SIZES).where("word_idx is not null")
    words = TK.word_tokens(texts, "k", **SIZES).select("k", F.posexplode("words").alias("word_idx", "w"))
    rows = words.select("k", "word_idx", "w.start", "w.end", F.explode_outer("w.tokens").alias("t"))
    place = [F.when(F.col("tok_pos").isNotNull(), F.col(x)) for x in names]
    assert _sorted(rows.select("k", "word_idx", "start", "end", *(f"t.{x}" for x in names))) == _sorted(
        flat.select("k", "word_idx", "word_start", "word_end", *place))


def test_best_words_are_those_of_all_words(spark, texts):
    all_words = TK.word_maxima(TK.token_rows(texts, "k", words=True, **SIZES).withColumn("prob", _prob()), "k")
    for k in (1, 4):
        few = TK.word_maxima(TK.word_tokens(texts, "k", **SIZES), "k", _prob, best=k, docs=texts)
        assert few.count() < all_words.count()
        want, got = (TK.top_evidence_rows(w, "k", k).where("k is not null").select("k", "word_idx", "start", "end", "score", "rank")
                     for w in (all_words, few))
        assert _sorted(got) == _sorted(want)
        assert _sorted(TK.evidence(few, texts, "k", k=k)) == _sorted(TK.evidence(all_words, texts, "k", k=k))


def test_only_the_best_words_are_shuffled(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(200))) for i in range(3)], "k long, text string").coalesce(1)
    few = TK.word_maxima(TK.word_tokens(docs, "k"), "k", lambda t: t["tok_pos"] / 1000, best=2)
    assert _sorted(few.select("k", "word_idx")) == [str((k, w)) for k in range(3) for w in (198, 199)]


@pytest.mark.parametrize("first", [0, 1])
def test_attention_evidence_is_that_of_every_token(spark, texts, first):
    """Chunks without a weight, with a NULL one, with several and negative ones; numbers from 0 on or with gaps."""
    weights = spark.createDataFrame(
        [(k, c, w) for k in [*range(17), 52] for c in range(first, 9) for w in ([0.5, -1.0] if c % 4 == 3 else [None, 0.25][:1 + k % 2] if c % 3 == 2 else [c / 7])]
        + [(1, None, 9.0), (None, 0, 9.0)], "k long, chunk_idx int, chunk_weight double")
    flat = TK.token_rows(texts, "k", words=True, **SIZES).withColumn("weight", _prob()).join(weights, ["k", "chunk_idx"], "left")
    want = TK.evidence(TK.word_maxima(flat.withColumn("prob", F.col("weight") * F.col("chunk_weight")), "k"), texts, "k", k=3)
    got = PL.attention_evidence(lambda docs, keep: TK.word_tokens(docs, "k", keep=keep, **SIZES), weights, texts, "k", _prob, 3)
    assert _sorted(got) == _sorted(want)
