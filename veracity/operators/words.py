"""Whitespace words with code-point offsets (A5).

Two forms give identical results:

* ``word_spans`` (default): one Arrow-batched pass returns the word array beside each
  row.  No shuffle: the words of a document are produced where the document already is,
  and everything per document stays row-local afterwards.
* ``word_rows_native``: built-ins only (``regexp_extract_all`` + ``split`` + a running
  sum window per document).  Needs one shuffle by key unless the input is already
  partitioned by it; useful where Python workers are not available.

Offsets are code points, like Python's ``len`` and Spark's ``length``.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.text import NON_WS_RUN, WS_CLASS_JAVA
from veracity.operators.offsets import Texts, slices


WORD = ["start", "end", "word"]


@F.arrow_udf(T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("word", T.StringType())])))
def _word_spans_udf(texts: pa.Array) -> pa.Array:
    """The ``\\S+`` runs of a whole batch at once."""
    out = []
    for lo, hi in slices(texts):
        part = texts.slice(lo, hi - lo)
        t = Texts(part)
        words, strings = t.words()
        flat = pa.StructArray.from_arrays(
            [pa.array(words.start, pa.int32()), pa.array(words.end, pa.int32()), strings.cast(pa.string())], WORD)
        rows = pa.ListArray.from_arrays(pa.array(words.first, pa.int32()), flat)
        if part.null_count:
            rows = pc.if_else(pc.is_valid(part), rows, pa.scalar(None, rows.type))
        out.append(rows)
    none = pa.array([], pa.list_(pa.struct(list(zip(WORD, (pa.int32(), pa.int32(), pa.string()), strict=True)))))
    return pa.concat_arrays([none, *out])


def word_spans(text) -> Column:
    """``array<struct<start int, end int, word string>>`` of the ``\\S+`` runs of ``text`` (NULL: NULL)."""
    return _word_spans_udf(F.col(text) if isinstance(text, str) else text)


def word_rows(df: DataFrame, key: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Long form ``(key, word_idx, start, end, word)``; ``text`` is not carried along."""
    keep = keep or []
    return df.select(key, *keep, F.posexplode(word_spans(text)).alias("word_idx", "w")).select(
        key,
        *keep,
        F.col("word_idx").cast("int").alias("word_idx"),
        F.col("w.start").alias("start"),
        F.col("w.end").alias("end"),
        F.col("w.word").alias("word"),
    )


def word_rows_native(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Built-ins only: words, the gaps between them and a running sum per document."""
    pieces = df.select(
        key,
        F.regexp_extract_all(F.col(text), F.lit(f"({NON_WS_RUN})"), 1).alias("words"),
        F.split(F.col(text), f"[^{WS_CLASS_JAVA}]+", -1).alias("gaps"),
    )
    exploded = pieces.select(
        key,
        F.posexplode("words").alias("word_idx", "word"),
        "gaps",
    ).select(
        key,
        F.col("word_idx").cast("int").alias("word_idx"),
        "word",
        F.length(F.col("word")).alias("wlen"),
        F.length(F.element_at("gaps", F.col("word_idx") + 1)).alias("glen"),
    )
    w = Window.partitionBy(key).orderBy("word_idx").rowsBetween(Window.unboundedPreceding, 0)
    return exploded.select(
        key,
        "word_idx",
        (F.sum(F.col("glen") + F.col("wlen")).over(w) - F.col("wlen")).cast("int").alias("start"),
        F.sum(F.col("glen") + F.col("wlen")).over(w).cast("int").alias("end"),
        "word",
    )


def word_count(text) -> Column:
    """Number of whitespace words, computed without materialising them."""
    c = F.col(text) if isinstance(text, str) else text
    return F.size(F.regexp_extract_all(c, F.lit(f"({NON_WS_RUN})"), 1))
