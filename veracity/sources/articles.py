"""Article readers and writers.

* Encoding detection reads the files as text lines (splittable) and checks every line:
  a file is UTF-8 when every line is valid UTF-8, else CP949 when every line decodes
  without replacement, else an error.  ``utf-8-sig`` and ``utf-8`` decode to the same
  text (the line reader drops a leading byte-order mark), so both report ``utf-8``.
  CP949 / EUC-KR need ``spark.sql.legacy.javaCharsets`` (set here).
* Delimited files use the CSV source with ``multiLine`` (quoted line breaks) — such a
  file is not splittable, so scale comes from many files.  All columns are read as
  strings; pandas' default NA spellings become NULL.  Files are read in groups of one
  header line, each with its own, and the groups meet by column name.
* JSON: a document holding a list, an envelope object (first list-valued key of
  data / records / items / news / articles) or one object; newline-delimited JSON is
  read as is (the scalable form).
"""

from __future__ import annotations

import os
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.operators.clean import conform_columns
from veracity.schema import JSON_ENVELOPE_KEYS, PANDAS_NA_STRINGS
from veracity.session import ensure_checkpoint_dir

JAVA_CHARSET = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "cp949": "x-windows-949", "euc-kr": "EUC-KR"}


def _legacy_charsets(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    spark.conf.set("spark.sql.legacy.codingErrorAction", "true")


def detect_encoding(spark: SparkSession, paths) -> DataFrame:
    """``(path, encoding)`` per file; ``encoding`` NULL when no candidate decodes
    the file (the caller raises)."""
    _legacy_charsets(spark)
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), "value")
    per_line = lines.select(
        "path",
        F.is_valid_utf8("value").alias("utf8"),
        (~F.contains(F.decode(F.col("value").cast("binary"), "x-windows-949"), F.lit("\ufffd"))).alias("cp949"),
    )
    agg = per_line.groupBy("path").agg(
        F.min(F.col("utf8").cast("int")).alias("u"), F.min(F.col("cp949").cast("int")).alias("c"))
    enc = F.when(F.col("u") == 1, "utf-8").when(F.col("c") == 1, "cp949")
    return agg.select("path", enc.alias("encoding"))


def header_lines(spark: SparkSession, paths) -> DataFrame:
    """``(path, header)`` per file that has a line: its first line that is not empty, as hex
    digits; a line whose quotes stay open (a header of several lines) has its path added."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("i"), "value").where("at = 0 AND value != ''")
    first = lines.groupBy("path").agg(F.min_by("value", "i").alias("v"))
    digits = F.hex(F.col("v").cast("binary"))
    quotes = F.length("v") - F.length(F.replace("v", F.lit('"'), F.lit("")))
    return first.select("path", F.when(quotes % 2 == 1, F.concat_ws(" ", digits, "path")).otherwise(digits).alias("header"))


def _null_na(df: DataFrame) -> DataFrame:
    na = F.array(*[F.lit(s) for s in PANDAS_NA_STRINGS])
    return df.select(*[F.col(c) if c in PLACE else F.when(F.array_contains(na, F.col(f"`{c}`")), F.lit(None).cast("string"))
                       .otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


#: The place of a row in its files: path, start of the block in the file, order in the block.
PLACE = ["_file", "_block", "_row"]


def _placed(df: DataFrame) -> DataFrame:
    """Adds PLACE to a scan of files: sorted by it, rows are in file order."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_row"))


def _csv_reader(spark: SparkSession, delimiter: str, charset: str):
    return (spark.read.option("header", True).option("sep", delimiter).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("encoding", charset)
            .option("inferSchema", False).option("mode", "PERMISSIVE"))


def read_articles_csv(spark: SparkSession, path, delimiter: str = "|", encoding: str = "auto",
                      keep_blank: bool = False, place: bool = False) -> DataFrame:
    """Delimited article files as strings, headers conformed (F1).

    ``keep_blank`` is the all-string rescan: blanks stay '' and no NA spelling is
    nulled.  ``place`` adds the columns PLACE, the order of row keys and generated ids in file order."""
    _legacy_charsets(spark)
    paths = [path] if isinstance(path, str) else list(path)
    if encoding == "auto":
        det = detect_encoding(spark, paths).collect()  # one row per file
        bad = [r["path"] for r in det if r["encoding"] is None]
        if bad:
            raise ValueError(f"cannot decode with utf-8-sig, utf-8, cp949 or euc-kr: {bad[:10]}")
        groups: dict[str, list[str]] = {}
        for r in det:
            groups.setdefault(JAVA_CHARSET[r["encoding"]], []).append(r["path"])
    else:
        groups = {JAVA_CHARSET.get(encoding.lower(), encoding): paths}
    header = {r["path"]: r["header"] for r in header_lines(spark, paths).collect()}  # one row per file
    if len(set(header.values())) > 1:
        listed = groups if encoding == "auto" else {c: list(header) for c in groups}
        same: dict[tuple[str, str | None], list[str]] = {}
        for charset, ps in listed.items():
            for p in ps:
                same.setdefault((charset, header.get(p)), []).append(p)
    else:
        same = {(charset, None): ps for charset, ps in groups.items()}
    frames = []
    for (charset, _), ps in same.items():
        if encoding == "auto" or len(set(header.values())) > 1:
            ps = [unquote(p) for p in ps]  # _metadata.file_path is an escaped URI
        r = _csv_reader(spark, delimiter, charset)
        if keep_blank:
            r = r.option("emptyValue", "").option("nullValue", "\u0000__never__")
        rows = r.csv(ps)
        frames.append(conform_columns(_placed(rows) if place else rows))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return df if keep_blank else _null_na(df)


def read_articles_json(spark: SparkSession, path, encoding: str = "utf-8", lines: bool = False,
                       place: bool = False) -> DataFrame:
    """List / envelope / single-object JSON documents (``lines=True``: NDJSON).
    Nested span columns stay as JSON text (S9).  Files of white space hold no document.  ``place`` adds PLACE."""
    _legacy_charsets(spark)
    charset = JAVA_CHARSET.get(encoding.lower(), encoding)
    reader = spark.read.option("encoding", charset).option("primitivesAsString", True)
    if lines:
        rows = reader.json(path)
        return annotations_to_json(conform_columns(_placed(rows) if place else rows))
    # one row per file; the envelope is decided for each file on its own
    raw = spark.read.format("binaryFile").load(path).select(F.decode("content", charset).alias("t"), F.col("path").alias("_file"))
    t = F.btrim(F.regexp_replace("t", "^\ufeff", ""), F.lit(" \t\r\n"))
    v = raw.where(t != "").select(F.parse_json(t).alias("v"), "_file")
    kind = F.schema_of_variant("v")
    held = F.coalesce(*[F.try_variant_get("v", f"$.{k}", "array<variant>") for k in JSON_ENVELOPE_KEYS])
    records = (F.when(kind.startswith("ARRAY"), F.expr("try_variant_get(v, '$', 'array<variant>')"))
               .otherwise(F.coalesce(held, F.array("v"))))
    rows = v.select("_file", F.lit(0).cast("long").alias("_block"), F.posexplode(records).alias("_row", "r"))
    rows = rows.select(F.expr("cast(r AS map<string, variant>)").alias("m"), "_file", "_block", F.col("_row").cast("long"))
    keys = [r[0] for r in rows.select(F.explode(F.map_keys("m")).alias("k")).distinct().orderBy("k").collect()]
    cols = [F.try_element_at("m", F.lit(k)).cast("string").alias(k) for k in keys]
    return conform_columns(rows.select(*cols, *(PLACE if place else [])))


def annotations_to_json(df: DataFrame) -> DataFrame:
    """Array / struct / map / variant columns become JSON text (non-ASCII kept)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            out.append(F.to_json(c).alias(f.name))
        else:
            out.append(c if isinstance(f.dataType, T.StringType) or f.name in PLACE else c.cast("string").alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, delimiter: str = ",", mode: str = "overwrite") -> None:
    """Header row, doubled quotes; Spark writes no byte-order mark."""
    (df.write.mode(mode).option("header", True).option("sep", delimiter).option("quote", '"')
     .option("escape", '"').option("quoteAll", True).csv(path))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp)."""
    return os.path.join(ensure_checkpoint_dir(spark), "scratch", f"{name}-{uuid.uuid4().hex}")


def rewrite(df: DataFrame, path: str) -> str:
    """Write the repaired table as the new version of the table at ``path`` and return the version's folder.

    Spark cannot overwrite what it is reading, so versions lie beside the source.  The manifest entry that
    makes a version the current one is written after the version is complete: a reader sees the old
    or the new table whole, and a rewrite that fails changes nothing."""
    spark = df.sparkSession
    base = f"{path.rstrip('/')}.versions"
    last = _last_version(spark, base)
    number = 1 if last is None else last["number"] + 1
    target = f"{base}/v{number:08d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("error").parquet(target)
    spark.createDataFrame([(number, target)], VERSION).coalesce(1).write.mode("append").json(f"{base}/_manifest")
    return target


VERSION = "number long, path string"


def _last_version(spark: SparkSession, base: str):
    try:
        entries = spark.read.schema(VERSION).json(f"{base}/_manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return None
        raise
    return entries.orderBy(F.desc("number"), F.desc("path")).first()


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that ``rewrite`` wrote; an error if there is none."""
    last = _last_version(spark, f"{path.rstrip('/')}.versions")
    if last is None:
        raise FileNotFoundError(f"no version of {path}")
    return spark.read.parquet(last["path"])
