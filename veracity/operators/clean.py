"""Article conforming, cleaning and validation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.rules import stage2_target, suspicious_target
from veracity.functions.text import is_blank, normalize_label, py_strip, safe_float
from veracity.operators.prefix import dense_index
from veracity.schema import COLUMN_ALIASES, OPTIONAL_COLUMNS, REQUIRED_COLUMNS

NUMERIC_COLUMNS = ["total_attention", "emotion_score", "exaggeration_score", "irony_score"]
SPAN_COLUMNS = ["token_attention", "emotion_spans", "exaggeration_spans", "irony_spans"]
NEGATIVE_POLICIES = ("missing", "zero", "rescale_minus1_1", "error")
SPAN_POLICIES = ("exclude", "empty", "error")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------------- F1–F3


def conform_columns(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """strip header names and map aliases; unknown names kept.  Two source columns
    that land on one name are an error (the original would silently duplicate)."""
    aliases = COLUMN_ALIASES if aliases is None else aliases
    names = [aliases.get(c.strip(), c.strip()) for c in df.columns]
    dup = sorted({n for n in names if names.count(n) > 1})
    if dup:
        raise ValueError(f"columns collide after aliasing: {dup}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required: list[str] | None = None) -> None:
    """F2 / U4: raise listing the missing required columns."""
    missing = sorted(set(required or REQUIRED_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def add_optional_columns(df: DataFrame, optional: list[str] | None = None) -> DataFrame:
    """absent optional columns are added as NULL strings (typed later)."""
    for c in optional or OPTIONAL_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


# ----------------------------------------------------------------------------- F4–F8


def clean_text(df: DataFrame, text: str = "text") -> DataFrame:
    """NULL → '', Python ``strip()``, keep non-empty."""
    return df.withColumn(text, py_strip(F.coalesce(F.col(text).cast("string"), F.lit("")))).where(
        F.length(text) > 0)


def merge_title(df: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """``strip(strip(title) + "\\n" + strip(text))`` when both columns exist."""
    if title not in df.columns or text not in df.columns:
        return df
    t = py_strip(F.coalesce(F.col(title).cast("string"), F.lit("")))
    b = py_strip(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return df.withColumn(text, py_strip(F.concat(t, F.lit("\n"), b)))


def with_row_key(df: DataFrame, order: list[str], name: str = "row_key") -> DataFrame:
    """dense 0..n-1 in ``order`` (unique) order; distributed (no single-task window)."""
    return dense_index(df, order, name)


def with_generated_ids(df: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """``news-%07d`` numbered from 1 in ``order`` order, only when there is no id column."""
    if id_col in df.columns:
        return df
    out = dense_index(df, order, "_n")
    return out.withColumn(id_col, F.format_string("news-%07d", F.col("_n") + 1)).drop("_n")


def with_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """F8 + F19: ``label_norm`` (NULL for unknown labels, see ``validate``) and targets."""
    return df.withColumn("label_norm", normalize_label(label)).withColumn(
        "suspicious_target", suspicious_target("label_norm")).withColumn(
        "stage2_target", stage2_target("label_norm"))


# ----------------------------------------------------------------------------- F12–F14


def with_numeric_scores(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """numeric parse of the score columns (unparsable, NaN or with underscores → NULL)."""
    for c in cols or NUMERIC_COLUMNS:
        if c in df.columns:
            x = safe_float(F.col(c))
            plain = ~F.col(c).cast("string").contains("_") & ~F.isnan(x)
            df = df.withColumn(c, F.when(plain, x))
    return df


def negative_policy(c, policy: str = "missing") -> Column:
    """value after the negative-score policy (NULL stays NULL).

    ``missing`` → NULL, ``zero`` → 0, ``rescale_minus1_1`` → (x+1)/2, ``error`` → kept
    (``negative_policy_violations`` counts what must fail)."""
    x = _c(c)
    if policy not in NEGATIVE_POLICIES:
        raise ValueError(f"negative policy must be one of {sorted(NEGATIVE_POLICIES)}: {policy!r}")
    if policy == "rescale_minus1_1":
        return (x + 1.0) / 2.0
    if policy == "missing":
        return F.when(x < 0, F.lit(None).cast("double")).otherwise(x)
    if policy == "zero":
        return F.when(x < 0, F.lit(0.0)).otherwise(x)
    return x


def negative_policy_violations(c, policy: str = "missing") -> dict[str, Column]:
    """Rules that make F14 fail, as boolean columns (for ``validate``)."""
    x = _c(c)
    if policy == "rescale_minus1_1":
        return {"out_of_minus1_1": x.isNotNull() & ((x < -1.0) | (x > 1.0))}
    rules = {"above_one": x.isNotNull() & (x > 1.0)}
    if policy == "error":
        rules["negative"] = x.isNotNull() & (x < 0.0)
    return rules


# ----------------------------------------------------------------------------- Q1 / F13


def validate(df: DataFrame, rules: dict[str, Column], key: str, sample: int = 10) -> DataFrame:
    """Q1: ``(rule, bad_rows, sample)`` for every rule in one pass over the table; the
    sample is the ``sample`` smallest keys of the failing rows.

    Only failing rows leave the scan, once per rule they break; a task keeps a count and the smallest
    keys per rule, so what is shuffled does not depend on their number."""
    names = list(rules)
    broken = F.filter(F.array(*[F.when(cond, F.lit(i)) for i, cond in enumerate(rules.values())]), lambda i: i.isNotNull())
    failing = df.select(F.col(key).alias("k"), F.explode(broken).alias("r"))

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kept = [0] * len(names), [None] * len(names)
        for b in batches:
            of = b.column("r")
            for i in pc.unique(of).to_pylist():
                keys = b.column("k").filter(pc.equal(of, i))
                counts[i] += len(keys)
                keys = keys.drop_null() if kept[i] is None else pa.concat_arrays([kept[i], keys.drop_null()])
                kept[i] = keys.take(pc.sort_indices(keys)[:sample])
        rows = [i for i, n in enumerate(counts) if n]
        if rows:
            lists = [kept[i].to_pylist() for i in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), pa.array([counts[i] for i in rows], pa.int64()), pa.array(lists, pa.list_(kept[rows[0]].type))],
                ["r", "n", "ks"])

    schema = T.StructType([T.StructField("r", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("ks", T.ArrayType(failing.schema["k"].dataType))])
    found = failing.mapInArrow(smallest, schema).groupBy("r").agg(
        F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("ks"))), 1, sample).alias("ks"))
    every = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(n) for n in names])).alias("r", "rule"))
    return every.join(found, "r", "left").select(
        "rule", F.coalesce("n", F.lit(0)).cast("long").alias("bad_rows"),
        F.coalesce(F.array_join(F.col("ks").cast("array<string>"), ","), F.lit("")).alias("sample"))


def check_range(df: DataFrame, cols: list[str], key: str, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """per column, rows outside [lo, hi] and the first 10 keys."""
    rules = {c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & ((F.col(c) < lo) | (F.col(c) > hi))
             for c in cols}
    return validate(df, rules, key).withColumnRenamed("rule", "column")


def article_rules(df: DataFrame) -> dict[str, Column]:
    """Every raise of the loader as a rule over a conformed article table."""
    rules = {
        "blank_text": is_blank("text"),
        "unknown_label": F.col("label_norm").isNull(),
    }
    if {"emotion_spans", "exaggeration_spans"} <= set(df.columns):
        # stage-2 rows must be annotated when the index models are trained
        rules["stage2_without_spans"] = F.col("label_norm").isin("fake", "satire") & ~span_complete(df)
    for c in ["total_attention", "emotion_score", "exaggeration_score"]:
        if c in df.columns:
            rules[f"{c}_out_of_range"] = F.col(c).isNotNull() & ((F.col(c) < 0) | (F.col(c) > 1))
    return rules


# ----------------------------------------------------------------------------- F17, F18, Q2


def span_complete(df: DataFrame) -> Column:
    """both stage-2 span columns are present (``[]`` counts as present)."""
    return ~is_blank("emotion_spans") & ~is_blank("exaggeration_spans")


def apply_span_policy(df: DataFrame, policy: str = "exclude") -> DataFrame:
    """F18 on one split: ``exclude`` drops incomplete rows, ``empty`` fills ``[]``,
    ``error`` keeps the table (the caller fails if ``missing_span_report`` has rows)."""
    if policy not in SPAN_POLICIES:
        raise ValueError(f"span policy must be one of {list(SPAN_POLICIES)}: {policy!r}")
    if policy == "exclude":
        return df.where(span_complete(df))
    if policy == "empty":
        for c in ("emotion_spans", "exaggeration_spans"):
            df = df.withColumn(c, F.when(is_blank(c), F.lit("[]")).otherwise(F.col(c)))
    return df


def missing_span_report(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows lacking a stage-2 span column, tagged by split."""
    cols = ["id", "row_key", "label", "emotion_spans", "exaggeration_spans"]
    return reduce(DataFrame.unionByName, [
        df.where(~span_complete(df)).select(F.lit(name).alias("split"), *cols) for name, df in parts.items()])


# ----------------------------------------------------------------------------- G1–G4


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """G1: ``(value, n)`` by count descending."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def duplicate_keys(df: DataFrame, col: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def can_stratify(df: DataFrame, col: str = "label_norm") -> bool:
    """At least two classes and every class has at least two rows."""
    r = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("k"), F.min("n").alias("m")).first()
    return bool(r["k"] >= 2 and (r["m"] or 0) >= 2)
