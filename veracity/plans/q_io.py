"""Driver queries for sources and sinks (phase 11): round trips through files written
under the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from veracity.functions.text import display_label, normalize_label, py_strip, safe_float
from veracity.operators import clean as K
from veracity.operators.annotations import parse_spans
from veracity.plans.q_clean import LABELS_SQL, raw_articles, strip_sql
from veracity.plans.q_splits import PROGRESS_SQL, progress
from veracity.plans.q_tokens import THIRD_SQL
from veracity.plans.registry import query, table
from veracity.schema import LABEL_DISPLAY
from veracity.sources import articles as A
from veracity.sources import progress as PG

KOREAN_HEADERS = {"id": "넘버링", "text": "내용", "label": "라벨", "group_id": "group_id"}


@query("csv_roundtrip", f"""
SELECT d.doc_id, {LABELS_SQL} AS label_norm, length({strip_sql('d.text')}) AS text_len
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE length({strip_sql('d.text')}) > 0
""")
def q_csv_roundtrip(spark, sf_dir):
    raw = raw_articles(spark, sf_dir).drop("doc_id")
    raw = raw.select(*[F.col(c).alias(KOREAN_HEADERS[c]) for c in raw.columns])
    path = A.scratch_path(spark, "articles-csv")
    A.write_csv(raw, path, delimiter="|")
    back = A.read_articles_csv(spark, path, delimiter="|", encoding="auto")
    a = K.with_labels(K.clean_text(back))
    return a.select(F.col("id").cast("long").alias("doc_id"), "label_norm",
                    F.length("text").cast("bigint").alias("text_len"))


FILE_ORDER = "row_number() OVER (ORDER BY doc_id % 2, doc_id)"


@query("file_row_key", f"""
SELECT doc_id, {FILE_ORDER} - 1 AS row_key, printf('news-%07d', {FILE_ORDER}) AS id,
       length({strip_sql("coalesce(text, '')")}) AS n_chars
FROM documents
""")
def q_file_row_key(spark, sf_dir):
    """Articles without an id in files of two header orders, even documents before odd ones; row
    keys and ids are numbered in file order."""
    raw = raw_articles(spark, sf_dir)
    path = A.scratch_path(spark, "articles-order")
    for name, part, cols in (("a", 0, ["doc_id", "text", "label"]), ("b", 1, ["label", "doc_id", "text"])):
        rows = raw.where(F.col("doc_id") % 2 == part).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        A.write_csv(rows.select(*cols), f"{path}/{name}", delimiter="|")
    back = A.read_articles_csv(spark, [f"{path}/a", f"{path}/b"], delimiter="|", place=True)
    keyed = K.with_generated_ids(K.with_row_key(back, A.PLACE), A.PLACE)
    return keyed.select(F.col("doc_id").cast("long"), "row_key", "id",
                        F.length(py_strip(F.coalesce("text", F.lit("")))).cast("bigint").alias("n_chars"))


#: Articles of one envelope file.
ENVELOPE = 100


@query("json_envelope", f"""
SELECT d.doc_id, {LABELS_SQL} AS label_norm, length(d.text) AS n_chars,
       row_number() OVER (PARTITION BY d.doc_id // {ENVELOPE} ORDER BY d.doc_id) - 1 AS place
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def q_json_envelope(spark, sf_dir):
    """Files of up to 100 articles each, as a list, in an envelope of one of its keys beside other values, or
    with a byte-order mark; rows keep their place in the file."""
    raw = raw_articles(spark, sf_dir).withColumn("file", F.floor(F.col("doc_id") / ENVELOPE))
    item = F.struct("doc_id", F.col("id").alias("넘버링"), F.col("text").alias("내용"), F.col("label").alias("라벨"))
    files = raw.groupBy("file").agg(F.sort_array(F.collect_list(item)).alias("items"))
    kind, body = F.col("file") % 4, F.to_json("items")
    doc = (F.when(kind == 0, body).when(kind == 1, F.concat(F.lit('{"count": 1, "data": '), body, F.lit("}")))
           .when(kind == 2, F.concat(F.lit('\ufeff{"articles": '), body, F.lit("}\n"))).otherwise(F.concat(body, F.lit("\n\n"))))
    path = A.scratch_path(spark, "envelopes")
    files.select("file", doc.alias("value")).write.partitionBy("file").text(path)
    back = K.with_labels(A.read_articles_json(spark, path, place=True))
    return back.select(F.col("doc_id").cast("long"), "label_norm", F.length("text").cast("bigint").alias("n_chars"),
                       F.col("_row").alias("place"))


@query("json_roundtrip", f"""
SELECT d.doc_id, {LABELS_SQL} AS label_norm, count(t.start) AS n_spans
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN ({THIRD_SQL}) t ON t.doc_id = d.doc_id
GROUP BY d.doc_id, l.toxic, l.quality
""")
def q_json_roundtrip(spark, sf_dir):
    from veracity.operators.words import word_spans
    raw = raw_articles(spark, sf_dir)
    w3 = F.try_element_at(word_spans("text"), F.lit(3))["word"]
    nested = raw.select("id", "text", "label", F.when(w3.isNotNull(), F.array(F.struct(
        w3.alias("phrase"), ((F.col("doc_id") % 10) / 10).alias("score")))).otherwise(
        F.array().cast("array<struct<phrase:string,score:double>>")).alias("emotion_spans"))
    path = A.scratch_path(spark, "articles-json")
    nested.write.mode("overwrite").json(path)
    back = A.read_articles_json(spark, path, lines=True)
    a = parse_spans(K.with_labels(back), "emotion_spans", "text", "p")
    return a.select(F.col("id").cast("long").alias("doc_id"), "label_norm",
                    F.size("p.spans").cast("bigint").alias("n_spans"))


@query("progress_roundtrip", f"""
SELECT event_type AS stage, count(*) AS n_rows, sum(step) AS step_sum, round(avg(running_loss), 6) AS mean_loss
FROM ({PROGRESS_SQL}) GROUP BY event_type
""")
def q_progress_roundtrip(spark, sf_dir):
    p = progress(spark, sf_dir)
    rows = p.select(
        F.lit(None).cast("string").alias("timestamp"), F.col("event_type").alias("stage"),
        F.lit("training").alias("status"), (F.col("user_id") % 5).cast("int").alias("epoch"),
        F.lit(5).alias("total_epochs"), F.col("step").cast("int").alias("step"),
        F.col("total_steps").cast("int").alias("total_steps"), "percent", F.col("running_loss").alias("loss"),
        F.lit(None).cast("double").alias("learning_rate"), "elapsed_seconds", "eta_seconds",
        *[F.lit(0.0).alias(c) for c in ("gpu_allocated_gb", "gpu_reserved_gb", "gpu_peak_gb")],
        F.to_json(F.struct(F.col("event_id").alias("event_id"))).alias("metrics_json"),
        (F.col("event_id") % 2).alias("_part"))
    path = A.scratch_path(spark, "progress")
    PG.reset_progress(spark, path)
    for part in (0, 1):  # two appends
        PG.append_progress(rows.where(F.col("_part") == part), path)
    back = PG.read_progress(spark, path)
    return back.groupBy("stage").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("step").alias("step_sum"),
                                     F.round(F.avg("loss"), 6).alias("mean_loss"))


@query("encoding_detect", """
SELECT * FROM (VALUES ('utf8', 'utf-8', TRUE), ('bom', 'utf-8', TRUE), ('cp949', 'cp949', TRUE)) t(written, encoding, every_file)
""")
def q_encoding_detect(spark, sf_dir):
    """All articles written as UTF-8, UTF-8 with BOM and CP949 files; the expected
    encodings are the ones written, in every file."""
    # every line has a Korean label, so its bytes differ between the encodings
    label = F.coalesce(display_label(normalize_label("label")), F.lit(LABEL_DISPLAY["real"]))
    raw = raw_articles(spark, sf_dir).select(
        F.concat_ws("|", "id", F.regexp_replace("text", "[\r\n|]", " "), label).alias("value"))
    base = A.scratch_path(spark, "encodings")
    A._legacy_charsets(spark)
    raw.write.mode("overwrite").text(f"{base}/utf8")
    raw.select(F.concat(F.lit("\ufeff"), "value").alias("value")).write.mode("overwrite").text(f"{base}/bom")
    kor = raw.select(F.regexp_replace("value", "[^\\x{0000}-\\x{007F}\\x{AC00}-\\x{D7A3}]", "?").alias("value"))
    # the text writer knows UTF-8 only
    kor.write.mode("overwrite").option("encoding", "x-windows-949").option("sep", "\u0001").csv(f"{base}/cp949")
    det = A.detect_encoding(spark, [f"{base}/utf8", f"{base}/bom", f"{base}/cp949"])
    kind = F.regexp_extract("path", r"/(utf8|bom|cp949)/", 1)
    det = det.select(kind.alias("written"), "encoding")
    files = det.groupBy("written").agg(F.count(F.lit(1)).alias("files"))
    return det.groupBy("written", "encoding").agg(F.count(F.lit(1)).alias("n")).join(files, "written").select(
        "written", "encoding", (F.col("n") == F.col("files")).alias("every_file"))


@query("string_rescan", """
SELECT c_mktsegment, count(*) FILTER (WHERE c_acctbal < 0) AS negatives, count(*) AS n, 0 AS negatives_after,
       round(sum(greatest(c_acctbal, 0)), 2) AS sum_after FROM customer GROUP BY 1
""")
def q_string_rescan(spark, sf_dir):
    """Write as CSV, rescan all-string (blanks kept), audit the
    negative scores, write the repaired table as a new version and read that back."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.col("c_acctbal").cast("string"))
    path = A.scratch_path(spark, "customer-csv")
    A.write_csv(c, path)
    s = A.read_articles_csv(spark, path, delimiter=",", encoding="utf-8", keep_blank=True)
    s = s.withColumn("v", safe_float(F.when(F.col("c_acctbal") != "", F.col("c_acctbal"))))
    A.rewrite(s.withColumn("c_acctbal", K.negative_policy("v", "zero")).drop("v"), path)
    after = A.read_current(spark, path).groupBy(F.col("c_mktsegment").alias("_m")).agg(
        F.count_if(F.col("c_acctbal") < 0).cast("int").alias("negatives_after"), F.round(F.sum("c_acctbal"), 2).alias("sum_after"))
    found = s.groupBy("c_mktsegment").agg(F.count_if(F.col("v") < 0).alias("negatives"), F.count(F.lit(1)).alias("n"))
    return found.join(after, F.col("c_mktsegment") == F.col("_m")).drop("_m")
