from pyspark.sql import functions as F

from veracity.operators import tokens as TK
from veracity.operators.words import word_rows


def test_chunk_counts(spark):
    # max_length 6 → W = 4 content tokens per chunk; stride 1 → step 3
    rows = [(n, [{"start": i, "end": i + 1} for i in range(n)]) for n in (0, 4, 5, 10)]
    df = spark.createDataFrame(rows, "k long, toks array<struct<start:int,end:int>>")
    ct = TK.chunk_tokens(df, "k", "toks", 6, 1)
    n = {r["k"]: r["c"] for r in ct.groupBy("k").agg(F.countDistinct("chunk_idx").alias("c")).collect()}
    assert n == {0: 1, 4: 1, 5: 2, 10: 3}
    # every token is covered; neighbouring chunks share `stride` tokens
    cov = {(r["k"], r["tok_pos"]) for r in ct.where("tok_pos is not null").collect()}
    assert cov == {(k, i) for k, _ in rows for i in range(k)}
    c10 = ct.where("k = 10 and tok_pos is not null").groupBy("chunk_idx").agg(F.collect_set("tok_pos").alias("s"))
    s = {r["chunk_idx"]: set(r["s"]) for r in c10.collect()}
    assert s[0] == {0, 1, 2, 3} and s[1] == {3, 4, 5, 6} and s[2] == {6, 7, 8, 9}


def test_assign_words_edges(spark):
    text = "  ab cd   ef"
    docs = spark.createDataFrame([(1, text)], "k long, text string")
    words = word_rows(docs, "k")  # ab(2,4) cd(5,7) ef(10,12)
    toks = spark.createDataFrame(
        [(1, 0, 0, 3), (1, 1, 3, 6), (1, 2, 7, 9), (1, 3, 8, 11), (1, 4, 4, 4), (1, 5, 0, 1)],
        "k long, t int, start int, end int")
    got = {r["t"]: r["word_idx"] for r in TK.assign_words(toks, words, "k").collect()}
    # before the first word → first word; across two words → the earlier; gap → next; special → none
    assert got == {0: 0, 1: 0, 2: None, 3: 2, 4: None, 5: None}
