"""Driver query for stream detection (M13): the documents table read as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.plans.q_scores import RULE, SQL_DECIDE, THRESHOLD, _reason_sql
from veracity.plans.registry import query, table
from veracity.schema import LABEL_DISPLAY, REASON_STAGE1
from veracity.session import table_path
from veracity.sources.articles import scratch_path
from veracity.streaming.detect import detect_stream, read_stream, run_available_now

DOC_SCORES_SQL = """
  SELECT doc_id AS row_key, ((doc_id * 7919) % 1000) / 1000 AS p,
         (n_chars % 997) / 997 AS emotion_index, ((doc_id * 104729) % 1000) / 1000 AS exaggeration_index,
         ((doc_id * 7907 + n_chars) % 1000) / 1000 AS irony_index
  FROM documents"""


@query("detect_stream", f"""
SELECT row_key,
  CASE WHEN p < CAST({THRESHOLD!r} AS DOUBLE) THEN '{LABEL_DISPLAY['real']}'
       WHEN {SQL_DECIDE} = 'satire' THEN '{LABEL_DISPLAY['satire']}' ELSE '{LABEL_DISPLAY['fake']}' END AS final_label,
  CASE WHEN p < CAST({THRESHOLD!r} AS DOUBLE) THEN '{REASON_STAGE1}' ELSE {_reason_sql()} END AS decision_reason
FROM ({DOC_SCORES_SQL})
""")
def q_detect_stream(spark, sf_dir):
    # the file source watches a folder: the table's file is matched by a glob in its folder
    path = table_path(sf_dir, "documents").replace("documents.parquet", "documents*.parquet")
    schema = table(spark, sf_dir, "documents").schema
    s = read_stream(spark, path, schema)
    doc = F.col("doc_id")
    s = s.select(doc.alias("row_key"), "text",
                 (((doc * 7919) % 1000) / 1000).alias("suspicious_probability"),
                 ((F.col("n_chars") % 997) / 997).alias("emotion_index"),
                 (((doc * 104729) % 1000) / 1000).alias("exaggeration_index"),
                 (((doc * 7907 + F.col("n_chars")) % 1000) / 1000).alias("irony_index"))
    out = scratch_path(spark, "detect-stream")
    run_available_now(detect_stream(s, THRESHOLD, RULE), f"{out}/data", f"{out}/checkpoint")
    res = spark.read.parquet(f"{out}/data")
    return res.select("row_key", "final_label", "decision_reason")
