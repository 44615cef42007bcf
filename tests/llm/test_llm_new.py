"""Whitening (11), cross-tokenizer alignment (12) and streaming exact dedup (13) against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from veracity.llm import alignment, exact_dedup, whitening
from veracity.plans.registry import table
from veracity.session import ensure_checkpoint_dir

SF001 = "/root/testdata/sf0.001"

# ----------------------------------------------------------------------------- 11


@pytest.mark.parametrize("d", [1, 2, 3, 7, 40])
@pytest.mark.parametrize("kind", ["spread", "clusters", "identity", "nearly rank one"])
def test_leading_eigenvectors(d, kind):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(200, d)) * 10.0 ** rng.uniform(-3, 3, d)
    if kind == "clusters":
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        v = q @ np.diag(np.repeat([9.0, 4.0, 4.0, 1.0], d)[:d]) @ q.T
    elif kind == "identity":
        v = 5 * np.eye(d)
    else:
        if kind == "nearly rank one":
            a = np.repeat(a[:, :1], d, 1) + 1e-6 * rng.normal(size=a.shape)
        v = a.T @ a / len(a)
    v = (v + v.T) / 2
    values, vectors = whitening.leading(v, 16)
    want = np.linalg.eigvalsh(v)[::-1][:16]
    assert np.allclose(values, want, rtol=0, atol=1e-13 * want[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(v @ vectors - vectors * values).max() < 1e-13 * want[0]


def test_sturm_counts():
    rng = np.random.default_rng(3)
    diag, off = rng.normal(size=9), rng.normal(size=8)
    values = np.linalg.eigvalsh(np.diag(diag) + np.diag(off, 1) + np.diag(off, -1))
    at = np.linspace(-4, 4, 50)
    assert whitening.count_below(diag, off, at).tolist() == [(values < x).sum() for x in at]


def brute_whitening(rows, k=16):
    good = [(i, v) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    x = {i: np.floor(64 * np.array(v, float)).astype(int) + 1_000_000 for i, v in good}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, s = len(fit), fit.sum(0)
    v = np.cov(fit.T, bias=True).reshape(fit.shape[1], -1)
    return x, n, s, v


def test_whitening_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [float(np.float32(rng.gauss(j, 1 + j))) for j in range(5)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(0, rows[0][1])]  # copies, a repeated row
    bad = [(5000, None), (5001, []), (5002, [1.0, None, 1.0, 1.0, 1.0]), (5003, [float("nan")] * 5),
           (5004, [1.0, 2.0, float("-inf"), 1.0, 1.0]), (5005, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 7, "c") for i, v in rows + bad], "vec_id long, embedding array<float>, n int, x string")
    got = whitening.whiten(df.repartition(7)).toPandas()
    x, n, s, v = brute_whitening(rows)
    assert len(got) == 5 * len(rows) and set(got.vec_id) == set(x) and set(got.n) == {n}
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert (got.identity_error < 1e-9).all() and got.identity_error.nunique() == 1
    for c in range(5):
        part = got[got.component == c + 1].sort_values("vec_id")
        want = np.array([(x[i] - s / n) @ vectors[:, c] / np.sqrt(values[c]) for i in part.vec_id])
        sign = np.sign(want @ part.whitened.to_numpy())
        assert np.abs(sign * want - part.whitened).max() < 1e-9
        assert np.allclose(part.explained, values[c] / np.trace(v), rtol=1e-10)
    for i, dev in zip(got.vec_id, got.deviation, strict=True):
        assert dev == sum((n * int(e) - int(t)) ** 2 for e, t in zip(x[i], s, strict=True))


def test_whitening_without_rows_or_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whiten(spark.createDataFrame(rows, schema))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert got.count() == 0


def test_whitening_of_large_entries_is_exact(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 3.0]), (3, [7.0, 5.0]), (4, [3e15, 1.0])]
    got = {r.vec_id: r for r in whitening.whiten(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("component = 1").collect()}
    x, n, s, _ = brute_whitening(rows)
    for i, r in got.items():
        want = sum((n * int(e) - int(t)) ** 2 for e, t in zip(x[i], s, strict=True))
        assert r.deviation == (want if want < 2 ** 63 else None)


# ----------------------------------------------------------------------------- 12


def odd_texts(n, seed=0):
    rng = random.Random(seed)
    alphabet = ["a", "b", "the", " ", " ", "  ", "\n", "\t", "é", "é", " ", "　", " ", "\u0085", "\u001c", "日本語",
                "🙂", "👩‍👩‍👧", "ü", "'s", "'", "12", ".", "“", "”", "—", "…", "。", "<|endoftext|>", "<s>", "<0x0A>", "▁", "ﬁ",
                "\x00", "\x7f", "﻿", "᠎", "Ж", "ال", "word", "Wörter", "#", "\r\n"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(n)]


class Whole:
    """Both tokenizers on whole texts, one text and one token at a time."""

    def __init__(self):
        a, b = alignment.default_vocabularies()
        self.v = alignment.Vocabularies(a, b, fast=False)

    def align(self, text):
        if not text:
            return [], [], []
        a = self.v.a.encode(" " + text, add_special_tokens=False).ids
        b = self.v.b.encode(text)
        want = (" " + text).encode()
        spelled = [[table.get(i, b"?") for i in ids] for table, ids in ((self.v.a_bytes, a), (self.v.b_bytes, b))]
        if b"".join(spelled[0]) != want or b"".join(spelled[1]) != want:
            return [], [], []
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for e in both:
            i2, j2 = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            links.append((a[i2 - 1], b[j2 - 1]))
            i, j = i2, j2
        return groups, links, (len(a), len(b))

    def score(self, texts):
        every = [self.align(t) for t in texts]
        counts = Counter(x for _, links, _ in every for x in links)
        best = defaultdict(int)
        for (_, b), n in counts.items():
            best[b] = max(best[b], n)
        return [(*(n or (0, 0)), len(g), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                 hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for g, links, n in every]


def test_alignment_against_whole_texts(spark):
    texts = [None, "", " ", "  ", "a", "a ", " a", "▁a", "The cat  sat on the mat.\nNicht wahr?", "x" * 3000, "word " * 4000]
    texts += odd_texts(600) + ["same text", "same text"]
    rows = [(i, t, -1, "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, codes string")
    got = alignment.score(docs.repartition(5)).orderBy("doc_id").collect()
    want = Whole().score(texts)
    assert [tuple(r)[1:] for r in got] == want
    groups = {r.doc_id: r.groups for r in alignment.align(docs, with_groups=True).collect()}
    assert all((hashlib.sha256(groups[r.doc_id].encode()).hexdigest() if groups[r.doc_id] else "") == r.groups_sha256 for r in got)


def test_alignment_of_the_documents(spark):
    docs = table(spark, SF001, "documents")
    got = {r.doc_id: tuple(r)[1:] for r in alignment.score(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert got == dict(zip([r.doc_id for r in rows], Whole().score([r.text for r in rows]), strict=True))


def test_alignment_of_nothing_and_string_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.score(docs).count() == 0
    docs = spark.createDataFrame([("p", "one two"), ("p", "one two"), (None, None)], "doc_id string, text string")
    assert sorted((r.doc_id or "", r.n_groups, r.count_sum) for r in alignment.score(docs).collect()) == [("", 0, 0), ("p", 2, 4), ("p", 2, 4)]


def test_fast_encoding_and_units_give_the_same_ids():
    paths = alignment.default_vocabularies()
    fast, slow = alignment.Vocabularies(*paths), alignment.Vocabularies(*paths, fast=False)
    assert fast.ranked is not None and slow.ranked is None and fast.cuts
    units = [(" " + t).encode() for t in odd_texts(3000, 5)]
    assert fast.encode(units) == slow.encode(units)


def test_intervals_that_overlap_share_a_group():
    a, b = np.array([0, 2, 5, 7]), np.array([0, 3, 5])
    ga, gb, n = alignment.coalesce(a, np.array([2, 5, 7, 9]), b, np.array([3, 5, 9]))
    assert (ga.tolist(), gb.tolist(), n) == ([0, 0, 1, 1], [0, 0, 1], 2)


def test_links_are_bounded_by_the_vocabularies(spark):
    v = alignment.Vocabularies(*alignment.default_vocabularies())
    assert v.possible_links() < 400_000
    aligned = alignment.align(table(spark, SF001, "documents"))
    for r in alignment.link_counts(aligned, v.b_size).collect():
        a, b = v.a_bytes[r.code // v.b_size], v.b_bytes[r.code % v.b_size]
        assert a.endswith(b) or b.endswith(a)


# ----------------------------------------------------------------------------- 13


def folder(spark):
    import uuid

    return f"{ensure_checkpoint_dir(spark)}/exact-{uuid.uuid4().hex}"


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    last = lambda ids: max(ids, key=lambda i: (i is not None, i or 0))
    return sorted(((i, last(groups[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=str)


ROWS = ([(i, f"text {i % 40}") for i in range(200)] + [(300, None), (301, ""), (302, " "), (303, None)]
        + [(7, "text 7"), (7, "text 7"), (None, "text 3"), (None, "alone"), (400, "é"), (401, "é"), (402, "x" * 200_000), (403, "x" * 200_000)]
        + [(1000 + i, "hot") for i in range(9000)])
SCHEMA = "doc_id long, text string, kept string, digest int"


def checked(got, rows):
    got = got.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_dedup(rows)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept) == {r.text_sha256 for r in got} and set(kept.values()) == {1}
    assert all(r.keep_id == r.doc_id for r in got if r.kept)


def test_stream_dedup_against_brute_force(spark):
    path = folder(spark)
    spark.createDataFrame([(*r, "k", 1) for r in ROWS], SCHEMA).repartition(4).write.parquet(path)
    checked(exact_dedup.dedup(spark, path, batch=1), ROWS)  # a batch for each file


@pytest.mark.parametrize("chars", [0, 1, 2])
def test_texts_that_only_share_a_digest_stay_apart(spark, chars):
    path = folder(spark)
    spark.createDataFrame([(*r, "k", 1) for r in ROWS[:450]], SCHEMA).repartition(3).write.parquet(path)
    weak = lambda text: F.left(exact_dedup.sha256(text), F.lit(chars))
    checked(exact_dedup.dedup(spark, path, digest=weak), ROWS[:450])


def test_state_stays_from_run_to_run(spark):
    path, state = folder(spark), folder(spark)
    first, second = ROWS[:150], ROWS[150:230]
    for part in (first, second):
        spark.createDataFrame([(*r, "k", 1) for r in part], SCHEMA).coalesce(2).write.mode("append").parquet(path)
        exact_dedup.ingest(spark, path, state)
        known = exact_dedup.ledger(spark, state)
        assert known.agg(F.sum("group_size")).first()[0] == len(first) + len(second) * (part is second)
    exact_dedup.ingest(spark, path, state)  # nothing new
    checked(exact_dedup.verdicts(spark.read.parquet(path), exact_dedup.ledger(spark, state)), first + second)


def test_stream_dedup_of_an_empty_table(spark):
    path = folder(spark)
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert exact_dedup.dedup(spark, path).count() == 0


# ----------------------------------------------------------------------------- 3


def test_capitals_of_long_words(spark):
    import time

    from veracity.llm import quality

    words = ["AB", "A", "AbC", "A1B", "ÄÖ", "日本", "A\u0085B", "A B", "x", "1A2", "ABc"]
    rows = [(i, w, "w", "l") for i, w in enumerate(words)] + [(100, "A" * 1_000_000 + "a", "", ""), (101, "A" * 1_000_000, "", ""),
                                                             (102, "1" * 1_000_000 + "A", "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _w string, _l string")
    began = time.time()
    got = quality.ledger(df).collect()
    assert time.time() - began < 30
    want = [int(sum(c.isupper() for c in t) >= 2 and not any(c.islower() for c in t)) for _, t, *_ in rows]
    assert [r["n_capitals"] for r in sorted(got, key=lambda r: r["doc_id"])] == want
    assert {(r["doc_id"], r["_w"], r["_l"]) for r in got} == {(r[0], r[2], r[3]) for r in rows}


def test_quality_stage_keeps_columns_with_clashing_names(spark):
    import corpus_pipeline

    text = " ".join(f"word{i}" for i in range(80))
    df = spark.createDataFrame([(1, text, -7, "w"), (2, "short", -7, "w"), (1, text, -7, "w"), (3, None, 1, None)],
                               "doc_id long, text string, n_words int, _w string")
    got = corpus_pipeline.quality_rules(spark, df, SF001)
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [(1, text, -7, "w")] * 2


def test_sample_of_repeated_ids_is_the_same_each_time(spark):
    from veracity.llm import toxicity

    rows = [(i % 9, f"text {i}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, toxic int")
    got = [toxicity.sample(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels, 2, 2)
           for r, n in ((rows, 3), (rows[::-1], 7))]
    assert got[0][0] == got[1][0] and got[0][1].tolist() == got[1][1].tolist() and len(got[0][0]) == 8
