"""Schemas and fixed values.

Everything under "FIXED VALUES" must stay exactly as written: results depend on it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original tool's values for identical results)
# ---------------------------------------------------------------------------

# Label aliases: key is lower(strip(value)).
LABEL_ALIASES = {
    "진짜": "real",
    "진짜뉴스": "real",
    "real": "real",
    "true": "real",
    "가짜": "fake",
    "가짜뉴스": "fake",
    "fake": "fake",
    "false": "fake",
    "풍자": "satire",
    "풍자뉴스": "satire",
    "satire": "satire",
    "satirical": "satire",
}

# Display names of the three classes.
LABEL_DISPLAY = {
    "real": "진짜뉴스",
    "fake": "가짜뉴스",
    "satire": "풍자뉴스",
}

# Header aliases (header is stripped first; unknown headers are kept).
COLUMN_ALIASES = {
    "넘버링": "id",
    "번호": "id",
    "내용": "text",
    "본문": "text",
    "라벨": "label",
    "총 attention 값": "total_attention",
    "총_attention_값": "total_attention",
    "단어/구문 attention 값": "token_attention",
    "단어_구문_attention_값": "token_attention",
    "감정자극 구문": "emotion_spans",
    "과장 구문": "exaggeration_spans",
    "아이러니 구문": "irony_spans",
    "아이러니 지수": "irony_score",
}

# Further header aliases of raw article files, whose titles go to the text.
INGEST_ALIASES = {
    "number": "id",
    "번호": "id",
    "넘버링": "id",
    "content": "text",
    "내용": "text",
    "본문": "text",
    "article": "text",
    "class": "label",
    "라벨": "label",
    "target": "label",
    "제목": "title",
}

REQUIRED_COLUMNS = ["id", "text", "label"]

OPTIONAL_COLUMNS = [
    "total_attention",
    "token_attention",
    "emotion_spans",
    "exaggeration_spans",
    "irony_spans",
    "emotion_score",
    "exaggeration_score",
    "irony_score",
    "group_id",
]

# Class order used by confusion matrices and reports.
CLASS_ORDER = ["real", "fake", "satire"]

# Envelope keys tried, in order, when a JSON file holds an object.
JSON_ENVELOPE_KEYS = ["data", "records", "items", "news", "articles"]

# Cell spellings that pandas' CSV reader treats as missing by default.
PANDAS_NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Encodings tried, in order, when the encoding is "auto".
ENCODING_ORDER = ["utf-8-sig", "utf-8", "cp949", "euc-kr"]

# Python's str.isspace() set (= Python's Unicode \s), written as a regex class.
# Java and RE2 \s are narrower, so the class is spelled out for both engines.
WS_CLASS_JAVA = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS_CLASS_DUCKDB = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}"
)

# Configuration defaults.
DEFAULT_DELIMITER = "|"
DEFAULT_MAX_LENGTH = 384
DEFAULT_STRIDE = 96
DEFAULT_INDEX_STRIDE = 0
DEFAULT_TEST_SIZE = 0.15
DEFAULT_VAL_SIZE = 0.15
DEFAULT_SEED = 42
DEFAULT_TARGET_RECALL = 0.95
DEFAULT_PATIENCE = 2
DEFAULT_EVIDENCE_K = 8
SPECIAL_TOKENS_PER_CHUNK = 2
RATIONALE_LOSS_WEIGHT = 0.20
TOTAL_ATTENTION_LOSS_WEIGHT = 0.10
INDEX_SCORE_LOSS_WEIGHT = 0.50
IRONY_RATIONALE_LOSS_WEIGHT = 0.20
EARLY_STOP_MIN_DELTA = 1e-6
MARK_THRESHOLD = 0.5

# Stage-2 rule search defaults.
RULE_EXAGGERATION_DEFAULTS = [0.03, 0.05, 0.08, 0.10, 0.15, 0.20]
RULE_IRONY_DEFAULTS = [0.35, 0.45, 0.55, 0.65, 0.75]
RULE_IRONY_HIGH_DEFAULTS = [0.65, 0.75, 0.85, 0.90]
RULE_MARGINS = [0.0, 0.05, 0.10, 0.15, 0.20]
EMOTION_HIGH_FLOOR = 0.05
DEFAULT_EMOTION_HIGH = 0.15

# Decision reasons (stage 2, then stage 1).
REASON_JOINT = "과장 지수와 아이러니 지수가 함께 높음"
REASON_DOMINANT = "아이러니 지수가 매우 높고 다른 지수보다 두드러짐"
REASON_EMOTION_ONLY = "감정자극 지수만 높아 풍자보다 가짜뉴스 규칙에 가까움"
REASON_OTHER = "풍자 조건을 충족하지 않아 가짜뉴스로 분류"
REASON_STAGE1 = "의심 뉴스 확률이 Stage 1 임계값보다 낮음"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

SPAN = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)
SPANS = T.ArrayType(SPAN)

WORD = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("word", T.StringType()),
    ]
)
WORDS = T.ArrayType(WORD)

EVIDENCE_ITEM = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)
EVIDENCE = T.ArrayType(EVIDENCE_ITEM)

RAW_ARTICLE_COLUMNS = REQUIRED_COLUMNS + OPTIONAL_COLUMNS

ARTICLE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("row_key", T.LongType(), False),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("label_norm", T.StringType()),
        T.StructField("total_attention", T.DoubleType()),
        T.StructField("token_attention", T.StringType()),
        T.StructField("emotion_spans", T.StringType()),
        T.StructField("exaggeration_spans", T.StringType()),
        T.StructField("irony_spans", T.StringType()),
        T.StructField("emotion_score", T.DoubleType()),
        T.StructField("exaggeration_score", T.DoubleType()),
        T.StructField("irony_score", T.DoubleType()),
        T.StructField("group_id", T.StringType()),
    ]
)

PROGRESS = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("epoch", T.IntegerType()),
        T.StructField("total_epochs", T.IntegerType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("total_steps", T.IntegerType()),
        T.StructField("percent", T.DoubleType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("elapsed_seconds", T.DoubleType()),
        T.StructField("eta_seconds", T.DoubleType()),
        T.StructField("gpu_allocated_gb", T.DoubleType()),
        T.StructField("gpu_reserved_gb", T.DoubleType()),
        T.StructField("gpu_peak_gb", T.DoubleType()),
        T.StructField("metrics_json", T.StringType()),
    ]
)
