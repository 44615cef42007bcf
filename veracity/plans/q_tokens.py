"""Driver queries for spans, annotations, tokens and word evidence (phases 3–4).

Span stand-ins (FIXTURES.md): every benchmark passage found in a document (score 1.0)
and every occurrence of the document's own third word (score (doc_id % 10) / 10).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.functions.text import py_strip
from veracity.operators import clean as K
from veracity.operators import tokens as TK
from veracity.operators.annotations import parse_spans
from veracity.operators.metrics import positive_weight
from veracity.operators.offsets import pieces, windows
from veracity.operators.phrases import find_phrases, phrase_hits, phrase_starts
from veracity.operators.spans import merge_spans, word_ratio
from veracity.operators.words import word_rows, word_spans
from veracity.plans.registry import query, table
from veracity.plans.sqlparts import BENCH_HITS, DOC_WORDS

MAX_LENGTH, STRIDE = 64, 16  # small windows so that documents span many chunks
W, STEP = MAX_LENGTH - 2, MAX_LENGTH - 2 - STRIDE
PIECE = 4


# ----------------------------------------------------------------------------- shared derivations


def docs_with_words(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.withColumn("words", word_spans("text"))


SPAN_ARRAY = "array<struct<start:int,end:int,score:double>>"


def docs_with_spans(spark, sf_dir):
    """Documents with ``spans``: the benchmark passages in them and their third word, beside the text."""
    dw = docs_with_words(spark, sf_dir)
    d = phrase_hits(dw, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    bench = F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), F.lit(1.0).alias("score")))
    w3 = F.try_element_at("words", F.lit(3))["word"]
    plen, score = F.length(w3), (F.col("doc_id") % 10) / 10
    own = F.transform(phrase_starts("text", w3), lambda s: F.struct(
        s.alias("start"), (s + plen).cast("int").alias("end"), score.alias("score")))
    return d.select("doc_id", "text", F.concat(bench.cast(SPAN_ARRAY), own.cast(SPAN_ARRAY)).alias("spans"))


def doc_spans(spark, sf_dir):
    d = docs_with_spans(spark, sf_dir)
    return d.select("doc_id", F.explode(merge_spans("spans")).alias("s")).select("doc_id", "s.start", "s.end", "s.score")


THIRD_SQL = f"""
  SELECT doc_id, CAST(start AS INTEGER) AS start, CAST(start + plen AS INTEGER) AS "end", score FROM (
    SELECT doc_id, plen, score, sum(length(piece)) OVER w + (k - 1) * plen AS start, k, n FROM (
      SELECT d.doc_id, length(w.word) AS plen, (d.doc_id % 10) / 10 AS score, p.piece, p.k,
             len(string_split(d.text, w.word)) AS n
      FROM documents d JOIN ({DOC_WORDS}) w ON w.doc_id = d.doc_id AND w.word_idx = 2,
           unnest(string_split(d.text, w.word)) WITH ORDINALITY AS p(piece, k))
    WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  WHERE k < n
"""

SPANS_SQL = f"""
  SELECT doc_id, start, "end", max(score) AS score FROM (
    SELECT doc_id, start, "end", 1.0 AS score FROM ({BENCH_HITS})
    UNION ALL SELECT doc_id, start, "end", score FROM ({THIRD_SQL}))
  GROUP BY doc_id, start, "end"
"""


def annotated(spark, sf_dir):
    """Documents with an annotation cell: benchmark passages and the third word as
    phrases, the first word by explicit offsets; every 5th cell missing, every 7th
    ``[]``."""
    dw = docs_with_words(spark, sf_dir)
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("phrase"))
    # the phrases found in a document are read off its text
    hit = phrase_hits(dw, bench, phrase="phrase")
    items = F.array_distinct(F.transform("hits", lambda h: F.col("text").substr(h["start"] + 1, h["end"] - h["start"])))
    w1, w3 = F.try_element_at("words", F.lit(1)), F.try_element_at("words", F.lit(3))
    own = F.array(
        F.to_json(F.struct(w3["word"].alias("phrase"), ((F.col("doc_id") % 10) / 10).alias("score"))),
        F.to_json(F.struct(w1["start"].alias("start"), w1["end"].alias("end"), F.lit(0.7).alias("score"))),
    )
    j = hit.withColumn("bench_items", items)
    bench_json = F.transform("bench_items", lambda p: F.to_json(F.struct(p.alias("phrase"), F.lit(1.0).alias("score"))))
    cell = F.concat(F.lit("["), F.array_join(F.concat(bench_json, own), ","), F.lit("]"))
    cell = (F.when(F.col("doc_id") % 5 == 0, F.lit(None).cast("string"))
            .when(F.col("doc_id") % 7 == 0, F.lit("[]")).otherwise(cell))
    return j.select("doc_id", "text", "words", cell.alias("emotion_spans"))


ANN_SPANS_SQL = f"""
  SELECT doc_id, start, "end", max(score) AS score FROM (
    SELECT doc_id, start, "end", 1.0 AS score FROM ({BENCH_HITS})
    UNION ALL SELECT doc_id, start, "end", score FROM ({THIRD_SQL})
    UNION ALL SELECT doc_id, start, "end", 0.7 FROM ({DOC_WORDS}) WHERE word_idx = 0)
  WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0
  GROUP BY doc_id, start, "end"
"""
AVAILABLE_SQL = "(doc_id % 5 <> 0)"


# ----------------------------------------------------------------------------- phase 3


@query("word_spans", f"SELECT * FROM ({DOC_WORDS})")
def q_word_spans(spark, sf_dir):
    return word_rows(table(spark, sf_dir, "documents"), "doc_id")


@query("phrase_spans", f"SELECT * FROM ({BENCH_HITS})")
def q_phrase_spans(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_phrases(d, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query("merge_spans", f"SELECT doc_id, start, \"end\", round(score, 6) AS score FROM ({SPANS_SQL})")
def q_merge_spans(spark, sf_dir):
    return doc_spans(spark, sf_dir).select("doc_id", "start", "end", F.round("score", 6).alias("score"))


@query("props_parse", f"""
SELECT d.doc_id, (d.doc_id % 5 <> 0) AS available, count(s.start) AS n_spans,
       coalesce(string_agg(s.start || '-' || s."end", ',' ORDER BY s.start, s."end"), '') AS offsets,
       round(coalesce(sum(s.score), 0), 6) AS score_sum
FROM documents d LEFT JOIN ({ANN_SPANS_SQL}) s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
""")
def q_props_parse(spark, sf_dir):
    a = parse_spans(annotated(spark, sf_dir), "emotion_spans", "text", "p")
    spans = F.col("p.spans")
    return a.select(
        "doc_id", F.col("p.available").alias("available"), F.size(spans).cast("bigint").alias("n_spans"),
        F.array_join(F.transform(spans, lambda s: F.concat(s["start"].cast("string"), F.lit("-"),
                                                           s["end"].cast("string"))), ",").alias("offsets"),
        F.round(F.aggregate(spans, F.lit(0.0), lambda acc, s: acc + s["score"]), 6).alias("score_sum"))


RATIO_SQL = f"""
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE marked) AS n_marked FROM (
    SELECT w.doc_id, w.word_idx, bool_or(s.doc_id IS NOT NULL) AS marked
    FROM ({DOC_WORDS}) w LEFT JOIN (SELECT * FROM ({ANN_SPANS_SQL}) WHERE score >= 0.5) s
      ON s.doc_id = w.doc_id AND greatest(w.start, s.start) < least(w."end", s."end")
    GROUP BY w.doc_id, w.word_idx)
  GROUP BY doc_id
"""


@query("word_ratio", f"""
SELECT d.doc_id, round(CASE WHEN coalesce(r.n_words, 0) > 0 THEN r.n_marked / r.n_words ELSE 0.0 END, 6) AS ratio
FROM documents d LEFT JOIN ({RATIO_SQL}) r ON r.doc_id = d.doc_id
""")
def q_word_ratio(spark, sf_dir):
    a = parse_spans(annotated(spark, sf_dir), "emotion_spans", "text", "p")
    return a.select("doc_id", F.round(word_ratio("words", "p.spans"), 6).alias("ratio"))


@query("index_targets", f"""
SELECT d.doc_id,
  round(CASE WHEN d.doc_id % 4 = 0 THEN (d.doc_id % 10) / 10
             WHEN {AVAILABLE_SQL.replace('doc_id', 'd.doc_id')}
             THEN CASE WHEN coalesce(r.n_words, 0) > 0 THEN r.n_marked / r.n_words ELSE 0.0 END END, 6)
    AS emotion_target
FROM documents d LEFT JOIN ({RATIO_SQL}) r ON r.doc_id = d.doc_id
""")
def q_index_targets(spark, sf_dir):
    a = parse_spans(annotated(spark, sf_dir), "emotion_spans", "text", "p")
    explicit = F.when(F.col("doc_id") % 4 == 0, (F.col("doc_id") % 10) / 10)
    target = F.coalesce(explicit, F.when(F.col("p.available"), word_ratio("words", "p.spans")))
    return a.select("doc_id", F.round(target, 6).alias("emotion_target"))


def _split_tag(col="doc_id"):
    return F.when(F.substring(F.md5(F.concat(F.lit("split:"), F.col(col).cast("string"))), 1, 1) < "c",
                  "train").otherwise("validation")


SPLIT_TAG_SQL = "CASE WHEN substr(md5('split:' || doc_id), 1, 1) < 'c' THEN 'train' ELSE 'validation' END"
EXAG_SQL = "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE '[]' END"


def span_frame(spark, sf_dir):
    a = annotated(spark, sf_dir).drop("words")
    a = a.withColumn("exaggeration_spans", F.when(F.col("doc_id") % 6 == 0, F.lit(None).cast("string"))
                     .otherwise(F.lit("[]")))
    return a.select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("row_key"),
                    F.lit("fake").alias("label"), "emotion_spans", "exaggeration_spans", _split_tag().alias("split"))


@query("missing_span_report", f"""
SELECT {SPLIT_TAG_SQL} AS split, CAST(doc_id AS VARCHAR) AS id, doc_id AS row_key,
       doc_id % 5 = 0 AS emotion_missing, doc_id % 6 = 0 AS exaggeration_missing
FROM documents WHERE doc_id % 5 = 0 OR doc_id % 6 = 0
""")
def q_missing_span_report(spark, sf_dir):
    f = span_frame(spark, sf_dir)
    parts = {s: f.where(F.col("split") == s).drop("split") for s in ("train", "validation")}
    rep = K.missing_span_report(parts)
    return rep.select("split", "id", "row_key", py_strip(F.coalesce("emotion_spans", F.lit(""))).eqNullSafe("")
                      .alias("emotion_missing"),
                      py_strip(F.coalesce("exaggeration_spans", F.lit(""))).eqNullSafe("").alias("exaggeration_missing"))


@query("span_policy_exclude", """
SELECT doc_id AS row_key FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 6 <> 0
""")
def q_span_policy_exclude(spark, sf_dir):
    return K.apply_span_policy(span_frame(spark, sf_dir), "exclude").select("row_key")


@query("span_policy_empty", """
SELECT doc_id AS row_key,
       CASE WHEN doc_id % 5 = 0 THEN '[]' WHEN doc_id % 7 = 0 THEN '[]' ELSE 'json' END AS emotion_spans,
       '[]' AS exaggeration_spans
FROM documents
""")
def q_span_policy_empty(spark, sf_dir):
    f = K.apply_span_policy(span_frame(spark, sf_dir), "empty")
    return f.select("row_key", F.when(F.col("emotion_spans") == "[]", "[]").otherwise("json").alias("emotion_spans"),
                    "exaggeration_spans")


# ----------------------------------------------------------------------------- phase 4: tokens

TOKENS_SQL = f"""
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY word_idx, k) - 1 AS INTEGER) AS tok_pos,
         CAST(start + {PIECE} * k AS INTEGER) AS start, CAST(least("end", start + {PIECE} * (k + 1)) AS INTEGER) AS "end"
  FROM ({DOC_WORDS}) w, range(0, CAST(ceil(("end" - start) / {PIECE}) AS BIGINT)) r(k)
"""
NTOK_SQL = f"""
  SELECT d.doc_id, coalesce(t.n, 0) AS ntok FROM documents d
  LEFT JOIN (SELECT doc_id, count(*) AS n FROM ({TOKENS_SQL}) GROUP BY doc_id) t ON t.doc_id = d.doc_id
"""
NCHUNK_SQL = f"CASE WHEN ntok <= {W} THEN 1 ELSE CAST(ceil((ntok - {W}) / {STEP}) AS BIGINT) + 1 END"
CHUNK_TOK_SQL = f"""
  SELECT t.doc_id, c AS chunk_idx, t.tok_pos, t.start, t."end"
  FROM ({TOKENS_SQL}) t JOIN ({NTOK_SQL}) n ON n.doc_id = t.doc_id,
       range(CAST(greatest(0, ceil((t.tok_pos - {W} + 1) / {STEP})) AS BIGINT),
             CAST(least({NCHUNK_SQL} - 1, floor(t.tok_pos / {STEP})) AS BIGINT) + 1) r(c)
"""


def token_frame(spark, sf_dir, **kw):
    """Tokens of the documents in chunks (content tokens; see ``TK.token_rows``)."""
    return TK.token_rows(table(spark, sf_dir, "documents"), "doc_id", tokenizer=pieces(PIECE),
                         max_length=MAX_LENGTH, stride=STRIDE, **kw)


def word_token_frame(docs, **kw):
    """The same tokens beside their words, one row a document (see ``TK.word_tokens``)."""
    return TK.word_tokens(docs, "doc_id", tokenizer=pieces(PIECE), max_length=MAX_LENGTH, stride=STRIDE, **kw)


@query("tokenize", f"SELECT * FROM ({TOKENS_SQL})")
def q_tokenize(spark, sf_dir):
    t = TK.token_rows(table(spark, sf_dir, "documents"), "doc_id", tokenizer=pieces(PIECE))
    return t.select("doc_id", "tok_pos", "start", "end")


@query("chunk_tokens", f"""
WITH c AS ({CHUNK_TOK_SQL}), n AS ({NTOK_SQL}),
ch AS (SELECT doc_id, c AS chunk_idx FROM n, range(0, {NCHUNK_SQL}) r(c))
SELECT ch.doc_id, CAST(ch.chunk_idx AS INTEGER) AS chunk_idx, count(c.tok_pos) + 2 AS n_positions,
       CAST(min(c.tok_pos) AS INTEGER) AS first_token, CAST(max(c.tok_pos) AS INTEGER) AS last_token
FROM ch LEFT JOIN c ON c.doc_id = ch.doc_id AND c.chunk_idx = ch.chunk_idx
GROUP BY ch.doc_id, ch.chunk_idx
""")
def q_chunk_tokens(spark, sf_dir):
    ct = token_frame(spark, sf_dir, specials=True)
    return ct.groupBy("doc_id", "chunk_idx").agg(
        F.count(F.lit(1)).alias("n_positions"), F.min("tok_pos").alias("first_token"),
        F.max("tok_pos").alias("last_token"))


TOKSCORE_SQL = f"""
  SELECT c.doc_id, c.chunk_idx, c.tok_pos, c.start, c."end",
         least(1.0, greatest(0.0, coalesce(max(s.score), 0.0))) AS target
  FROM ({CHUNK_TOK_SQL}) c LEFT JOIN ({SPANS_SQL}) s
    ON s.doc_id = c.doc_id AND greatest(c.start, s.start) < least(c."end", s."end")
  GROUP BY c.doc_id, c.chunk_idx, c.tok_pos, c.start, c."end"
"""


def chunk_token_scores(spark, sf_dir, **kw):
    """Tokens in chunks with ``target``, the score of the spans over them."""
    return TK.token_rows(docs_with_spans(spark, sf_dir), "doc_id", tokenizer=pieces(PIECE), max_length=MAX_LENGTH,
                         stride=STRIDE, spans={"target": "spans"}, **kw)


@query("token_scores", f"""
SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (WHERE target >= 0.5) AS n_marked,
       round(sum(target), 6) AS target_sum
FROM ({TOKSCORE_SQL}) GROUP BY doc_id
""")
def q_token_scores(spark, sf_dir):
    s = chunk_token_scores(spark, sf_dir)
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.count_if(F.col("target") >= 0.5).alias("n_marked"),
                                   F.round(F.sum("target"), 6).alias("target_sum"))


@query("token_class_counts", f"""
SELECT count(*) FILTER (WHERE target >= 0.5) AS emotion_pos, count(*) FILTER (WHERE target < 0.5) AS emotion_neg
FROM ({TOKSCORE_SQL})
""")
def q_token_class_counts(spark, sf_dir):
    s = chunk_token_scores(spark, sf_dir).withColumnRenamed("target", "emotion")
    return TK.token_class_counts(s, ["emotion"])


@query("positive_weight", f"""
WITH c AS (SELECT count(*) FILTER (WHERE target >= 0.5) AS pos, count(*) FILTER (WHERE target < 0.5) AS neg
           FROM ({TOKSCORE_SQL}))
SELECT pos, neg, round(CASE WHEN pos <= 0 THEN 1.0 ELSE least(30.0, greatest(0.5, neg / pos)) END, 6) AS positive_weight
FROM c
""")
def q_positive_weight(spark, sf_dir):
    s = chunk_token_scores(spark, sf_dir).withColumnRenamed("target", "emotion")
    c = TK.token_class_counts(s, ["emotion"]).select(F.col("emotion_pos").alias("pos"), F.col("emotion_neg").alias("neg"))
    return c.select("pos", "neg", F.round(positive_weight(F.col("pos"), F.col("neg")), 6).alias("positive_weight"))


# 5-character windows over the text: tokens that start in gaps and cross words
WIN = 5
WINDOWS_SQL = f"""
  SELECT doc_id, CAST(k AS INTEGER) AS tok_idx, CAST({WIN} * k AS INTEGER) AS start,
         CAST(least(length(text), {WIN} * k + {WIN}) AS INTEGER) AS "end"
  FROM documents, range(0, CAST(ceil(length(text) / {WIN}) AS BIGINT)) r(k)
"""


ASSIGN_SQL = f"""
  SELECT t.doc_id, t.tok_idx, t.start, t."end",
    CASE WHEN greatest(w.start, t.start) < least(w."end", t."end") THEN w.word_idx
         WHEN greatest(nx.start, t.start) < least(nx."end", t."end") THEN nx.word_idx END AS word_idx
  FROM ({WINDOWS_SQL}) t
  ASOF LEFT JOIN ({DOC_WORDS}) w ON w.doc_id = t.doc_id AND t.start >= w.start
  LEFT JOIN ({DOC_WORDS}) nx ON nx.doc_id = t.doc_id AND nx.word_idx = coalesce(w.word_idx + 1, 0)
"""


@query("assign_words", f"""
SELECT doc_id, count(*) AS n_tokens, count(word_idx) AS n_assigned,
       CAST(coalesce(sum(word_idx), 0) AS BIGINT) AS word_idx_sum
FROM ({ASSIGN_SQL}) GROUP BY doc_id
""")
def q_assign_words(spark, sf_dir):
    a = TK.token_rows(table(spark, sf_dir, "documents"), "doc_id", tokenizer=windows(WIN), words=True)
    a = a.where(F.col("tok_pos").isNotNull())
    return a.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"), F.count("word_idx").alias("n_assigned"),
                                   F.coalesce(F.sum("word_idx"), F.lit(0)).cast("bigint").alias("word_idx_sum"))


PROB_SQL = "((doc_id * 13 + tok_pos * 7 + chunk_idx * 3) % 100) / 100"


def _prob(t=None):
    """Of a token in long form, or beside its word (``TK.word_tokens``)."""
    tok_pos, chunk_idx = (F.col(x) if t is None else t[x] for x in ("tok_pos", "chunk_idx"))
    return ((F.col("doc_id") * 13 + tok_pos * 7 + chunk_idx * 3) % 100) / 100


WORDSCORE_SQL = f"""
  SELECT w.doc_id, w.word_idx, w.start, w."end", w.word, coalesce(m.score, 0.0) AS score
  FROM ({DOC_WORDS}) w LEFT JOIN (
    SELECT a.doc_id, a.word_idx, max(a.prob) AS score FROM (
      SELECT t.doc_id, t.prob,
        CASE WHEN greatest(w.start, t.start) < least(w."end", t."end") THEN w.word_idx
             WHEN greatest(nx.start, t.start) < least(nx."end", t."end") THEN nx.word_idx END AS word_idx
      FROM (SELECT doc_id, start, "end", {PROB_SQL} AS prob FROM ({CHUNK_TOK_SQL})) t
      ASOF LEFT JOIN ({DOC_WORDS}) w ON w.doc_id = t.doc_id AND t.start >= w.start
      LEFT JOIN ({DOC_WORDS}) nx ON nx.doc_id = t.doc_id AND nx.word_idx = coalesce(w.word_idx + 1, 0)) a
    WHERE a.word_idx IS NOT NULL GROUP BY a.doc_id, a.word_idx) m
  ON m.doc_id = w.doc_id AND m.word_idx = w.word_idx
"""


def word_score_frame(spark, sf_dir):
    return TK.word_maxima(token_frame(spark, sf_dir, words=True).withColumn("prob", _prob()), "doc_id")


@query("word_scores", f"""
SELECT doc_id, count(*) AS n_words, round(sum(score), 6) AS score_sum,
       count(*) FILTER (WHERE score >= 0.5) AS n_high
FROM ({WORDSCORE_SQL}) GROUP BY doc_id
""")
def q_word_scores(spark, sf_dir):
    s = word_score_frame(spark, sf_dir)
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"), F.round(F.sum("score"), 6).alias("score_sum"),
                                   F.count_if(F.col("score") >= 0.5).alias("n_high"))


@query("word_index", f"""
SELECT d.doc_id, round(coalesce(x.idx, 0.0), 6) AS word_index FROM documents d LEFT JOIN (
  SELECT doc_id, avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END) AS idx FROM ({WORDSCORE_SQL}) GROUP BY doc_id) x
ON x.doc_id = d.doc_id
""")
def q_word_index(spark, sf_dir):
    s = word_score_frame(spark, sf_dir)
    out = TK.word_index(s, "doc_id", 0.5, table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.round("index", 6).alias("word_index"))


@query("top_evidence", f"""
SELECT doc_id, CAST(rk AS INTEGER) AS rank, word_idx, word, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word_idx) AS rk FROM ({WORDSCORE_SQL}))
WHERE rk <= 8
""")
def q_top_evidence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scores = TK.word_maxima(word_token_frame(docs), "doc_id", _prob, best=8, docs=docs)
    top = TK.with_words(TK.top_evidence_rows(scores, "doc_id", 8), docs, "doc_id")
    return top.select("doc_id", F.col("rank").cast("int").alias("rank"), "word_idx", "word",
                      F.round("score", 6).alias("score"))


@query("soft_ratio", f"""
SELECT d.doc_id, coalesce(x.r, 0.0) / 100 AS soft_ratio FROM documents d LEFT JOIN (
  SELECT doc_id, avg(CAST((doc_id * 13 + tok_pos * 7 + chunk_idx * 3) % 100 AS DOUBLE)) AS r
  FROM ({CHUNK_TOK_SQL}) WHERE "end" > start GROUP BY doc_id) x
ON x.doc_id = d.doc_id
""")
def q_soft_ratio(spark, sf_dir):
    # probabilities as whole percents: the mean is exact, then one division
    ct = token_frame(spark, sf_dir)
    pct = ((F.col("doc_id") * 13 + F.col("tok_pos") * 7 + F.col("chunk_idx") * 3) % 100).cast("double")
    out = TK.soft_ratio(ct.withColumn("prob", pct), table(spark, sf_dir, "documents"), "doc_id")
    return out.select("doc_id", (F.col("soft_ratio") / 100).alias("soft_ratio"))


@query("missing_report_sink", f"""
SELECT {SPLIT_TAG_SQL} AS split, CAST(doc_id AS VARCHAR) AS id, CAST(doc_id AS VARCHAR) AS row_key
FROM documents WHERE doc_id % 5 = 0 OR doc_id % 6 = 0
""")
def q_missing_report_sink(spark, sf_dir):
    """The missing-span report written as CSV (before a policy acts) and read back
    as strings."""
    from veracity.sources import articles as A
    f = span_frame(spark, sf_dir)
    parts = {s: f.where(F.col("split") == s).drop("split") for s in ("train", "validation")}
    path = A.scratch_path(spark, "missing-report")
    A.write_csv(K.missing_span_report(parts), path)
    back = A.read_articles_csv(spark, path, delimiter=",", encoding="utf-8", keep_blank=True)
    return back.select("split", "id", "row_key")
