"""Driver queries for words, phrases and spans (phases 1 and 3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.operators.phrases import phrase_hits
from veracity.operators.spans import marked_word_count
from veracity.operators.words import word_count, word_spans
from veracity.plans.registry import query, table
from veracity.plans.sqlparts import BENCH_HITS, DOC_WORDS, LABEL_CLASS


def label_class(labels):
    """labels → (doc_id, label_class): toxic → satire, else quality → real, else fake."""
    return labels.select(
        "doc_id",
        F.when(F.col("toxic") == 1, "satire").when(F.col("quality") == 1, "real")
        .otherwise("fake").alias("label_class"),
    )


def doc_word_ratios(spark, sf_dir):
    """Per document ``(doc_id, n_words, n_marked, ratio, has_hit)``, row-local.

    Word counts of all documents are native (``regexp_extract_all``); word offsets and
    the overlap sweep are only computed for the documents that have a hit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = phrase_hits(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    hit = F.size("hits") > 0
    d = d.withColumn("words", word_spans(F.when(hit, F.col("text"))))
    spans = F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), F.lit(1.0).alias("score")))
    per_doc = d.select("doc_id", word_count("text").cast("long").alias("n_words"),
                       F.when(hit, marked_word_count("words", spans)).otherwise(0).cast("long").alias("n_marked"),
                       F.when(hit, 1).alias("has_hit"))
    ratio = F.when(F.col("n_words") > 0, F.col("n_marked") / F.col("n_words")).otherwise(F.lit(0.0))
    return per_doc.withColumn("ratio", ratio)


def benchmark_word_ratio(spark, sf_dir):
    """Share of each document's words inside a benchmark passage, by label class."""
    classes = label_class(table(spark, sf_dir, "labels"))
    per_doc = doc_word_ratios(spark, sf_dir).join(classes, "doc_id", "left")
    return per_doc.groupBy(F.coalesce("label_class", F.lit("unlabelled")).alias("label_class")).agg(
        F.count("*").alias("n_docs"),
        F.count("has_hit").alias("n_docs_with_hits"),
        F.sum("n_words").alias("n_words"),
        F.sum("n_marked").alias("n_marked"),
        F.round(F.avg("ratio"), 6).alias("mean_ratio"),
    )


query("benchmark_word_ratio", f"""
WITH words AS ({DOC_WORDS}), hits AS ({BENCH_HITS}),
marked AS (
  SELECT w.doc_id, w.word_idx,
         EXISTS (SELECT 1 FROM hits h WHERE h.doc_id = w.doc_id
                 AND greatest(w.start, h.start) < least(w."end", h."end")) AS marked
  FROM words w
),
per_doc AS (
  SELECT d.doc_id,
         CAST(count(m.word_idx) AS BIGINT) AS n_words,
         CAST(count(m.word_idx) FILTER (WHERE m.marked) AS BIGINT) AS n_marked
  FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id
  GROUP BY d.doc_id
)
SELECT coalesce(c.label_class, 'unlabelled') AS label_class,
       CAST(count(*) AS BIGINT) AS n_docs,
       CAST(count(DISTINCT h.doc_id) AS BIGINT) AS n_docs_with_hits,
       CAST(sum(p.n_words) AS BIGINT) AS n_words,
       CAST(sum(p.n_marked) AS BIGINT) AS n_marked,
       round(avg(CASE WHEN p.n_words > 0 THEN p.n_marked / p.n_words ELSE 0.0 END), 6) AS mean_ratio
FROM per_doc p
LEFT JOIN (SELECT DISTINCT doc_id FROM hits) h ON h.doc_id = p.doc_id
LEFT JOIN (SELECT doc_id, {LABEL_CLASS} AS label_class FROM labels) c ON c.doc_id = p.doc_id
GROUP BY 1
""")(benchmark_word_ratio)
