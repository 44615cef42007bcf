"""Literal phrase occurrences (A3) and the phrase-dictionary × text join.

``phrase_starts`` is a row-local expression for a phrase that sits beside its text
(annotation cells).  ``phrase_hits`` and ``find_phrases`` match a whole phrase table against a
whole document table without pairing every document with every phrase:

* A dictionary of at most ``DICTIONARY`` characters (checked) becomes one automaton of all
  phrases, sent to every task.  Each text is read once, whatever the number and the
  lengths of the phrases, and the occurrences stay beside it: one scan, no shuffle, no join.
* A larger dictionary is joined.  Each phrase gets an *anchor*: a run of the phrase that any
  occurrence must reproduce as a word of the text (interior word), as the end or the start of one
  (first or last word of the phrase), or as a part of one word or of one gap between words
  (phrase without or of nothing but white space).  Words and gaps are keyed the same way and
  equi-joined with the anchors, candidates are verified against the text.  Spark broadcasts the
  anchor side when its measured size is below ``spark.sql.autoBroadcastJoinThreshold``,
  otherwise it sort-merge joins and AQE splits skewed anchor keys.

Overlapping occurrences of the same phrase are resolved left to right, as ``re.finditer`` does.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.text import NON_WS_RUN, WS_CLASS_JAVA, regex_quote
from veracity.operators.words import word_rows
from veracity.session import ensure_checkpoint_dir

#: Characters of a dictionary that is sent to every task (an automaton takes some 50 bytes for each).
DICTIONARY = 2_000_000


def phrase_starts(text, phrase) -> Column:
    """Start offsets of the non-overlapping left-to-right occurrences of ``phrase``.

    ``split`` on the quoted phrase gives the pieces between occurrences; the k-th start
    is the length of the first k+1 pieces plus k phrase lengths.  Empty/NULL phrase →
    empty array.
    """
    text = F.col(text) if isinstance(text, str) else text
    phrase = F.col(phrase) if isinstance(phrase, str) else phrase
    pieces = F.split(text, regex_quote(phrase), -1)
    n = F.size(pieces) - 1
    plen = F.length(phrase)
    init = F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("starts"))
    folded = F.aggregate(
        F.slice(pieces, 1, F.greatest(n, F.lit(0))),
        init,
        lambda acc, p: F.struct(
            (acc["pos"] + F.length(p) + plen).alias("pos"),
            F.array_append(acc["starts"], acc["pos"] + F.length(p)).alias("starts"),
        ),
    )["starts"]
    empty = F.array().cast("array<int>")
    return F.when(phrase.isNull() | (plen == 0) | text.isNull() | (n <= 0), empty).otherwise(folded)


def _matcher(phrases: DataFrame, phrase_key: str, phrase: str):
    """UDF of all occurrences ``array<struct<item,start,end>>`` in a text by the automaton of a small dictionary."""
    rows = phrases.where(F.length(phrase) > 0).select(phrase_key, phrase).toArrow()
    items, strings = rows.column(0).combine_chunks(), rows.column(1).to_pylist()
    shared = phrases.sparkSession.sparkContext.broadcast((items, strings))
    built: list = []

    def automaton():
        if not built:
            own, by_text = ahocorasick.Automaton(), {}
            for i, p in enumerate(shared.value[1]):
                by_text.setdefault(p, []).append(i)
            for p, ids in by_text.items():
                own.add_word(p, (len(p), ids))
            if by_text:
                own.make_automaton()
            built.append(own)
        return built[0]

    kind = T.StructType([T.StructField("item", phrases.schema[phrase_key].dataType),
                         T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])

    @F.arrow_udf(T.ArrayType(kind))
    def occurrences(texts: pa.Array) -> pa.Array:
        own = automaton()
        found: list[tuple[int, int, int]] = []
        n = []
        for text in texts.to_pylist():
            before = len(found)
            if text and len(own):
                upto: dict[int, int] = {}  # end of the last occurrence of each phrase
                for last, (size, ids) in own.iter(text):
                    start = last + 1 - size
                    if start >= upto.get(ids[0], 0):
                        upto[ids[0]] = last + 1
                        found.extend((i, start, last + 1) for i in ids)
            n.append(len(found) - before)
        flat = np.array(found, np.int64).reshape(-1, 3)
        structs = pa.StructArray.from_arrays(
            [shared.value[0].take(pa.array(flat[:, 0])), pa.array(flat[:, 1], pa.int32()), pa.array(flat[:, 2], pa.int32())],
            ["item", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), structs)

    return occurrences


def phrase_hits(docs: DataFrame, phrases: DataFrame, doc_key: str = "doc_id", text: str = "text",
                phrase_key: str = "item_id", phrase: str = "text", out: str = "hits",
                dictionary: int = DICTIONARY) -> DataFrame:
    """``docs`` with ``out``: ``array<struct<item,start,end>>`` of all occurrences of every phrase.

    NULL and empty phrases match nothing, a NULL text has no occurrence; equal phrases with
    different keys match each; phrases of white space match like others.  ``dictionary`` is the
    number of characters up to which the automaton is used; beyond it ``doc_key`` must be unique.
    """
    size = phrases.agg(F.coalesce(F.sum(F.length(phrase) + 1), F.lit(0))).first()[0]
    if size <= dictionary:
        return docs.withColumn(out, _matcher(phrases, phrase_key, phrase)(F.col(text)))
    joined = _joined_phrases(docs, phrases, doc_key, text, phrase_key, phrase)
    lists = joined.groupBy(F.col(doc_key).alias("_key")).agg(F.array_sort(F.collect_list(
        F.struct(F.col(phrase_key).alias("item"), "start", "end"))).alias(out))
    empty = F.array().cast(lists.schema[out].dataType)
    return docs.join(lists, F.col(doc_key) == F.col("_key"), "left").withColumn(out, F.coalesce(out, empty)).drop("_key")


def find_phrases(docs: DataFrame, phrases: DataFrame, doc_key: str = "doc_id", text: str = "text",
                 phrase_key: str = "item_id", phrase: str = "text", dictionary: int = DICTIONARY) -> DataFrame:
    """Long form of ``phrase_hits``: ``(doc_key, phrase_key, start, end)``."""
    hits = phrase_hits(docs.select(doc_key, text), phrases, doc_key, text, phrase_key, phrase, "_hits", dictionary)
    return hits.select(doc_key, F.explode("_hits").alias("h")).select(
        doc_key, F.col("h.item").alias(phrase_key), "h.start", "h.end")


def _phrase_anchors(phrases: DataFrame, phrase_key: str, phrase: str) -> DataFrame:
    """One anchor per phrase: ``(phrase_key, phrase, plen, kind, klen, key, koff)``."""
    pw = word_rows(phrases.select(phrase_key, phrase).withColumnRenamed(phrase, "_p"), phrase_key, "_p",
                   keep=[])
    plen = phrases.select(phrase_key, F.col(phrase).alias("phrase"), F.length(phrase).alias("plen"))
    pw = pw.join(plen, phrase_key)
    interior = (F.col("start") > 0) & (F.col("end") < F.col("plen"))
    kind = (
        F.when(interior, F.lit("word"))
        .when((F.col("start") == 0) & (F.col("end") == F.col("plen")), F.lit("sub"))
        .when(F.col("start") == 0, F.lit("suffix"))
        .otherwise(F.lit("prefix"))
    )
    # preference: interior words first, then longer keys, then earlier position
    rank_kind = F.when(kind == "word", 0).otherwise(1)
    scored = pw.select(
        phrase_key, "phrase", "plen", kind.alias("kind"), F.length("word").alias("klen"),
        F.col("word").alias("key"), F.col("start").alias("koff"), rank_kind.alias("rk"),
    )
    blank = plen.where(F.regexp_replace("phrase", NON_WS_RUN, "") == F.col("phrase"))
    scored = scored.unionByName(blank.select(
        phrase_key, "phrase", "plen", F.lit("gap").alias("kind"), F.col("plen").alias("klen"), F.col("phrase").alias("key"),
        F.lit(0).alias("koff"), F.lit(0).alias("rk")))
    best = scored.groupBy(phrase_key).agg(
        F.min_by(F.struct("phrase", "plen", "kind", "klen", "key", "koff"),
                 F.struct("rk", -F.col("klen"), "koff")).alias("a")
    )
    return best.select(phrase_key, "a.*")


def _gaps(docs: DataFrame, doc_key: str, text: str) -> DataFrame:
    """The runs of white space as ``(doc_key, start, word)``."""
    words = F.regexp_extract_all(F.col(text), F.lit(f"({NON_WS_RUN})"), 1)
    gaps = F.split(F.col(text), f"[^{WS_CLASS_JAVA}]+", -1)
    each = docs.select(doc_key, F.posexplode(gaps).alias("i", "word"), F.transform(words, lambda w: F.length(w)).alias("_w"),
                       F.transform(gaps, lambda g: F.length(g)).alias("_g")).where(F.length("word") > 0)
    upto = lambda a: F.aggregate(F.slice(a, 1, F.col("i")), F.lit(0), lambda x, y: x + y)
    return each.select(doc_key, (upto("_w") + upto("_g")).cast("int").alias("start"), "word")


def _keyed(words: DataFrame, gaps: DataFrame, doc_key: str, shapes: list, with_base: bool) -> DataFrame | None:
    """Doc-side anchor keys ``(doc_key, kind, klen, key[, base])`` for the needed shapes.
    ``base`` (needs word offsets) is the document offset the phrase would start at plus
    the anchor's offset inside the phrase."""
    def base(c):
        return [c.alias("base")] if with_base else []
    keyed = []
    if any(k == "word" for k, _ in shapes):
        keyed.append(words.select(doc_key, F.lit("word").alias("kind"), F.length("word").alias("klen"),
                                  F.col("word").alias("key"), *base(F.col("start") if with_base else None)))
    for kind, klen in sorted({s for s in shapes if s[0] != "word"}):
        w = (gaps if kind == "gap" else words).where(F.length("word") >= klen)
        if kind == "prefix":
            keyed.append(w.select(doc_key, F.lit(kind).alias("kind"), F.lit(klen).alias("klen"),
                                  F.substring("word", 1, klen).alias("key"),
                                  *base(F.col("start") if with_base else None)))
        elif kind == "suffix":
            keyed.append(w.select(doc_key, F.lit(kind).alias("kind"), F.lit(klen).alias("klen"),
                                  F.substring("word", -klen, klen).alias("key"),
                                  *base((F.col("end") - klen) if with_base else None)))
        else:  # substring of one word or gap
            pos = F.explode(F.sequence(F.lit(0), F.length("word") - klen)).alias("i")
            cols = ["word", "start"] if with_base else ["word"]
            keyed.append(w.select(doc_key, *cols, pos).select(
                doc_key, F.lit(kind).alias("kind"), F.lit(klen).alias("klen"),
                F.substring("word", F.col("i") + 1, klen).alias("key"),
                *base((F.col("start") + F.col("i")) if with_base else None)))
    if not keyed:
        return None
    out = keyed[0]
    for k in keyed[1:]:
        out = out.unionByName(k)
    return out


def _joined_phrases(docs: DataFrame, phrases: DataFrame, doc_key: str, text: str, phrase_key: str, phrase: str) -> DataFrame:
    """``find_phrases`` by anchors, for dictionaries too large for every task."""
    anchors = _phrase_anchors(phrases.where(F.length(phrase) > 0), phrase_key, phrase).cache()
    shapes = [(r["kind"], r["klen"]) for r in anchors.select("kind", "klen").distinct().collect()]
    if not shapes:
        return docs.sparkSession.createDataFrame(
            [], T.StructType([docs.schema[doc_key], phrases.schema[phrase_key], T.StructField("start", T.IntegerType()),
                              T.StructField("end", T.IntegerType())]))
    # exact pre-filter: a document can only hold an occurrence if its distinct words
    # contain the anchor key (JVM regex, no offsets); offsets are computed for those only
    distinct_words = docs.select(doc_key, F.explode(F.array_distinct(
        F.regexp_extract_all(F.col(text), F.lit(f"({NON_WS_RUN})"), 1))).alias("word"))
    ensure_checkpoint_dir(docs.sparkSession)
    # the candidate ids feed two branches below: materialise them once (reliable checkpoint)
    gaps = _gaps(docs, doc_key, text)
    candidates = _keyed(distinct_words, gaps, doc_key, shapes, with_base=False).join(
        anchors.select("kind", "klen", "key").distinct(), ["kind", "klen", "key"], "left_semi").select(
        doc_key).distinct().checkpoint(eager=True)
    docs = docs.join(candidates, doc_key, "left_semi")
    words = word_rows(docs.select(doc_key, text), doc_key, text)

    doc_keys = _keyed(words, _gaps(docs, doc_key, text), doc_key, shapes, with_base=True)
    cand = doc_keys.join(anchors, ["kind", "klen", "key"]).select(
        doc_key, phrase_key, "phrase", "plen",
        (F.col("base") - F.col("koff")).cast("int").alias("start"),
    ).where(F.col("start") >= 0)

    verified = cand.join(docs.select(doc_key, text), doc_key).where(
        F.substring(F.col(text), F.col("start") + 1, F.col("plen")) == F.col("phrase")
    ).select(doc_key, phrase_key, "start", "plen")

    # left-to-right, non-overlapping (only self-overlapping phrases are affected)
    grouped = verified.groupBy(doc_key, phrase_key).agg(
        F.first("plen").alias("plen"), F.array_sort(F.collect_list("start")).alias("starts"))
    init = F.struct(F.lit(-1).alias("last_end"), F.array().cast("array<int>").alias("kept"))
    kept = F.aggregate(
        "starts", init,
        lambda acc, s: F.when(
            s >= acc["last_end"],
            F.struct((s + F.col("plen")).alias("last_end"),
                     F.array_append(acc["kept"], s).alias("kept")),
        ).otherwise(acc),
    )["kept"]
    return grouped.select(doc_key, phrase_key, F.explode(kept).alias("start"), "plen").select(
        doc_key, phrase_key, "start", (F.col("start") + F.col("plen")).cast("int").alias("end"))
