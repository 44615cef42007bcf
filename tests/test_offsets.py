"""Flat offset arithmetic, token rows and phrase search against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veracity.operators import offsets as O
from veracity.operators import phrases as P
from veracity.operators import tokens as TK

ALPHABET = ["a", "é", "日", " ", "　", "\u001c", "🙂", "\u0085", " ", "b", "\n"]


def batches(n=200, seed=3):
    rng = random.Random(seed)
    for _ in range(n):
        yield rng, ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 6))] + [None]


def words_of(text):
    return [m.span() for m in re.finditer(r"\S+", text or "")]


def word_of(words, s, e):
    before = [j for j, x in enumerate(words) if x[0] <= s]
    for j in (before[-1] if before else -1, before[-1] + 1 if before else 0):
        if 0 <= j < len(words) and max(words[j][0], s) < min(words[j][1], e):
            return j
    return -1


def best_span(spans, s, e):
    return min(1.0, max(0.0, max((x[2] for x in spans if max(x[0], s) < min(x[1], e)), default=0.0)))


@pytest.mark.parametrize("tokenizer", [O.pieces(2), O.windows(3), O.matches(r"\w|\s+\w")])
def test_tokens_words_and_spans(tokenizer):
    for rng, texts in batches():
        arr = pa.array(texts, pa.string())
        t = O.Texts(arr)
        w, strings = t.words()
        want = [words_of(x) for x in texts]
        assert [list(zip(w.start[a:b], w.end[a:b], strict=True)) for a, b in zip(w.first, w.first[1:], strict=False)] == want
        assert strings.to_pylist() == t.cut(w).to_pylist() == [m for x in texts for m in re.findall(r"\S+", x or "")]
        tokens = tokenizer(arr, t, w)
        doc = tokens.documents()
        pairs = list(zip(doc, tokens.start, tokens.end, strict=True))
        assert O.assign(tokens, w).tolist() == [word_of(want[d], s, e) for d, s, e in pairs]
        spans = [[(s, s + rng.randint(0, 9), rng.choice([0, .2, .5, .9, 1.3, -1])) for s in
                  (rng.randint(0, 30) for _ in range(rng.randint(0, 6)))] for _ in texts]
        first = np.concatenate([[0], np.cumsum([len(x) for x in spans])])
        flat = np.array([x for y in spans for x in y], float).reshape(-1, 3)
        ranges = O.Ranges(first, flat[:, 0].astype(int), flat[:, 1].astype(int))
        assert O.span_maximum(tokens, ranges, flat[:, 2]).tolist() == [best_span(spans[d], s, e) for d, s, e in pairs]


def test_many_spans_do_not_meet_every_token():
    import time

    n = 200_000
    tokens = O.Ranges(np.array([0, n]), np.arange(n) * 2, np.arange(n) * 2 + 2)
    spans = O.Ranges(np.array([0, n]), np.arange(n), 2 * n - np.arange(n))  # each inside the one before
    t = time.time()
    got = O.span_maximum(tokens, spans, np.arange(n) / n)
    assert time.time() - t < 20 and got[n // 2] == (n - 1) / n and got[0] == 1 / n


def test_token_rows(spark):
    rows = [(i, t, [(0, 5, 0.4), (2, 9, 0.8)] if i % 2 else None, "k") for i, t in enumerate(
        t for _, ts in batches(20, 9) for t in ts)]
    rows.append((len(rows), "word " * 300, [(7, 1200, 0.6)], "k"))
    df = spark.createDataFrame(rows, "k long, text string, spans array<struct<start:int,end:int,score:double>>, word_idx string")
    got = TK.token_rows(df.repartition(3), "k", tokenizer=O.matches(r"[^\sb]+"), max_length=6, stride=1,
                        spans={"target": "spans"}, words=True, features=True).collect()
    want = []
    for k, text, spans, _ in rows:
        toks = [m.span() for m in re.finditer(r"[^\sb]+", text or "")]
        words = words_of(text)
        n = len(toks)
        touched = set()
        for c in range(1 if n <= 4 else -(-(n - 4) // 3) + 1):
            inside = toks[3 * c:3 * c + 4]
            for j, (s, e) in enumerate(inside):
                w = word_of(words, s, e)
                touched.add(w)
                ws, we = words[w] if w >= 0 else (None, None)
                want.append((k, c, j + 1, 3 * c + j, s, e, w if w >= 0 else None, ws, we, best_span(spans or [], s, e), text[s:e],
                             text[slice(*inside[j - 1])] if j else "<s>", text[slice(*inside[j + 1])] if j + 1 < len(inside) else "</s>"))
        want += [(k, None, None, None, s, e, w, s, e, 0.0, None, None, None) for w, (s, e) in enumerate(words) if w not in touched]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_word_maxima_and_words(spark):
    df = spark.createDataFrame([(1, "ab bb cd"), (2, ""), (3, None)], "k long, text string")
    t = TK.token_rows(df, "k", tokenizer=O.matches("[acd]"), words=True).withColumn("prob", F.col("start") / 10)
    got = TK.with_words(TK.word_maxima(t, "k"), df, "k").orderBy("word_idx").select("k", "word", "start", "end", "score").collect()
    assert [tuple(r) for r in got] == [(1, "ab", 0, 2, 0.0), (1, "bb", 3, 5, 0.0), (1, "cd", 6, 8, 0.7)]


PHRASES = ["aa", "cat sat", "the cat sat on", "t; the", "moji 😀 em", "at", "sat.", " cat", " ", "  ", "\n", "　", " \n", "aa", "", None,
           "the", "he cat", "x" * 50, "a", "e"]
TEXTS = ["aaaa bb　cc dd\u001cee  aaaa", "  the cat sat on the mat; the cat sat.", "x", "😀 emoji 😀 emoji", "", None, "   ",
         "a \n b \n\n c", "x" * 160, "aaaaaaa"]


@pytest.mark.parametrize("dictionary", [P.DICTIONARY, 0])
def test_phrases_by_automaton_and_by_join(spark, dictionary):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    phrases = spark.createDataFrame([(f"p{i}", p) for i, p in enumerate(PHRASES)], "item_id string, text string")
    got = sorted(tuple(r) for r in P.find_phrases(docs, phrases, dictionary=dictionary).collect())
    want = sorted((d, f"p{i}", m.start(), m.end()) for d, t in enumerate(TEXTS) for i, p in enumerate(PHRASES)
                  if t and p for m in re.finditer(re.escape(p), t))
    assert got == want


def test_no_phrase(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    none = spark.createDataFrame([(1, ""), (2, None)], "item_id long, text string")
    assert P.phrase_hits(docs, none).where("size(hits) > 0").count() == 0
    assert P.find_phrases(docs, none.where("false")).count() == 0


def test_word_marks_in_both_forms(spark):
    from veracity.operators.spans import mark_words, marked_word_count
    from veracity.operators.words import word_rows, word_spans

    rng = random.Random(5)
    rows = [(k, t, [(s, s + rng.randint(1, 9), rng.choice([0.1, 0.5, 0.9])) for s in (rng.randint(0, 30) for _ in range(4))])
            for k, t in enumerate(t for _, ts in batches(20, 4) for t in ts if t)]
    df = spark.createDataFrame(rows, "k long, text string, spans array<struct<start:int,end:int,score:double>>")
    long = df.select("k", F.explode("spans").alias("s")).select("k", "s.*")
    marked = mark_words(word_rows(df, "k"), long, "k")
    a = {r["k"]: r["n"] for r in marked.groupBy("k").agg(F.count_if("marked").alias("n")).collect()}
    b = {r["k"]: r["n"] for r in df.select("k", marked_word_count(word_spans("text"), "spans").alias("n")).collect()}
    want = {k: sum(any(c >= 0.5 and max(x, s) < min(y, e) for s, e, c in spans) for x, y in words_of(t)) for k, t, spans in rows}
    assert {k: a.get(k, 0) for k in want} == b == want


def test_special_tokens_in_both_forms(spark):
    docs = spark.createDataFrame([(1, "abcdefg hij"), (2, ""), (3, "a b c d e f g h")], "k long, text string")
    from veracity.operators.words import word_spans
    a = TK.token_rows(docs, "k", tokenizer=O.pieces(3), max_length=5, stride=1, specials=True)
    b = TK.chunk_tokens(docs.select("k", TK.piece_tokens(word_spans("text"), 3).alias("t")), "k", "t", 5, 1)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str) and a.columns == b.columns
    with pytest.raises(ValueError):
        TK.token_rows(docs, "k", specials=True, words=True)
