import re

from veracity.operators.phrases import find_phrases
from veracity.operators.words import word_rows, word_rows_native

TEXTS = [
    (1, "aaaa bb　cc dd\u001cee  aaaa"),
    (2, "  the cat sat on the mat; the cat sat."),
    (3, "x"),
    (4, "😀 emoji 😀 emoji"),
]
PHRASES = [(10, "aa"), (11, "cat sat"), (12, "the cat sat on"), (13, "t; the"), (14, "moji 😀 em"),
           (15, "at"), (16, "sat."), (17, " cat")]


def test_word_forms_agree(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    a = sorted(tuple(r) for r in word_rows(df, "doc_id").collect())
    b = sorted(tuple(r) for r in word_rows_native(df, "doc_id").select("doc_id", "word_idx", "start", "end", "word").collect())
    want = sorted((d, i, m.start(), m.end(), m.group(0)) for d, t in TEXTS for i, m in enumerate(re.finditer(r"\S+", t)))
    assert a == want
    assert b == want


def test_find_phrases_brute_force(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    ph = spark.createDataFrame(PHRASES, "item_id long, text string")
    got = sorted(tuple(r) for r in find_phrases(docs, ph).collect())
    want = sorted((d, i, m.start(), m.end()) for d, t in TEXTS for i, p in PHRASES
                  for m in re.finditer(re.escape(p), t))
    assert got == want


def test_find_phrases_without_usable_phrases(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    ph = spark.createDataFrame([(1, "   "), (2, "")], "item_id long, text string")
    assert find_phrases(docs, ph).count() == 0
