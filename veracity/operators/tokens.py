"""Tokens, chunks and word evidence.

* ``token_rows`` is one Arrow pass over the texts, without a shuffle: a tokenizer of
  ``offsets`` gives the token offsets; overlapping chunks with their special tokens, the word
  of every token, the score of the spans over it and the text of its neighbours follow by
  offset arithmetic on the flat arrays of a batch.
* A word's score (``word_maxima``) is then one aggregate by (document, word) with map-side
  combining; the words themselves do not travel, ``with_words`` reads the few that are
  asked for from the text again.  Where only the best words of a document are wanted, the words stay beside
  their text with their tokens (``word_tokens``) until the others are left out; only the best are shuffled.
* ``chunk_tokens`` makes the same chunks from given token arrays.  ``assign_words`` and
  ``word_scores`` serve token and word tables that come from elsewhere in long form: tokens and
  words of a document are sorted together by start offset (one shuffle by key).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.operators import offsets as O
from veracity.operators.words import word_rows
from veracity.schema import DEFAULT_EVIDENCE_K, SPECIAL_TOKENS_PER_CHUNK

TOKEN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
SPANS = "array<struct<start:int,end:int,score:double>>"
_PLACES = [T.StructField(x, T.IntegerType()) for x in ("chunk_idx", "pos", "tok_pos", "start", "end")]
WORD = T.StructType([*TOKEN.fields, T.StructField("tokens", T.ArrayType(T.StructType(_PLACES)))])
#: Neighbours of the first and last token of a chunk.
FIRST, LAST = "<s>", "</s>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------------- A7


def piece_tokens(words, piece: int = 4) -> Column:
    """``array<struct<start,end>>``: each word cut into pieces of ≤ ``piece`` characters."""
    def pieces(w):
        n = F.ceil((w["end"] - w["start"]) / F.lit(piece)).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(
            (w["start"] + k * piece).cast("int").alias("start"),
            F.least(w["end"], w["start"] + (k + 1) * piece).cast("int").alias("end")))
    return F.flatten(F.transform(_c(words), pieces))


def regex_tokens(pattern: str):
    """Plug-in tokenizer: Python regex matches with code-point offsets (Arrow UDF)."""
    rx = re.compile(pattern)

    @F.pandas_udf(T.ArrayType(TOKEN))
    def tok(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else [{"start": m.start(), "end": m.end()} for m in rx.finditer(t)]
                          for t in texts])
    return tok


# ----------------------------------------------------------------------------- A8


def n_chunks(n_tokens: Column, max_length: int, stride: int) -> Column:
    w = max_length - SPECIAL_TOKENS_PER_CHUNK
    step = w - stride
    return F.when(n_tokens <= w, F.lit(1)).otherwise(F.ceil((n_tokens - w) / F.lit(step)).cast("int") + 1)


def _window(max_length: int, stride: int) -> tuple[int, int]:
    """Content tokens of a chunk, and tokens from one chunk's start to the next."""
    w = max_length - SPECIAL_TOKENS_PER_CHUNK
    if not (0 <= stride < w):
        raise ValueError(f"stride must satisfy 0 <= stride < {w}")
    return w, w - stride


def _ints(values: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    return pa.array(values.astype(np.int32), pa.int32(), mask=missing)


def chunk_tokens(df: DataFrame, key: str, tokens: str, max_length: int, stride: int,
                 keep: list[str] | None = None) -> DataFrame:
    """A8 + A10: ``(key, chunk_idx, pos, tok_pos, start, end)`` with the special tokens
    (``pos`` 0 and last, zero-length offsets, ``tok_pos`` NULL) of every chunk, from the token
    arrays of each row (NULL: none)."""
    width, step = _window(max_length, stride)
    src = df.select(key, *(keep or []), _c(tokens).alias("_t"))
    rest = src.columns[:-1]
    names = [*rest, "chunk_idx", "pos", "tok_pos", "start", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ranges, _ = O.list_ranges(batch.column("_t"))
                c = O.chunk(ranges, width, step)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(x).take(pa.array(c.doc)) for x in rest), *_chunk_columns(c, ranges)], names)

    schema = T.StructType([*(src.schema[x] for x in rest), *(T.StructField(x, T.IntegerType()) for x in names[len(rest):])])
    return src.mapInArrow(run, schema)


def _chunk_columns(c: O.Chunks, tokens: O.Ranges) -> list[pa.Array]:
    special = c.token < 0
    at = np.where(special, 0, c.token)
    none = np.zeros(1, np.int64)
    index, start, end = (x if len(x) else none for x in (tokens.index(), tokens.start, tokens.end))
    return [_ints(c.chunk), _ints(c.pos), _ints(index[at], special), _ints(np.where(special, 0, start[at])),
            _ints(np.where(special, 0, end[at]))]


def token_rows(df: DataFrame, key: str, text: str = "text", tokenizer: O.Tokenizer | None = None,
               max_length: int | None = None, stride: int = 0, spans: dict[str, str] | None = None,
               words: bool = False, features: bool = False, specials: bool = False,
               keep: list[str] | None = None) -> DataFrame:
    """The tokens of every text in long form, in one pass and without a shuffle.

    ``(key, keep..., chunk_idx, pos, tok_pos, start, end)``: content tokens, once per chunk they are
    in (without ``max_length`` a text is one chunk).  A NULL text has no row.

    * ``spans``: output column → array column of ``struct<start,end,score>`` beside the text; the largest
      score of the spans over the token (A9, J4), 0.0 without any or for a NULL array.
    * ``words``: ``word_idx, word_start, word_end`` of the token's word (J5, NULL without); a word that
      no token belongs to gets a row of its own with NULL ``chunk_idx``, ``pos`` and ``tok_pos``.
    * ``features``: ``tok, left, right``, the token and its neighbours within the chunk (M2); the
      tokens of the tokenizer must not overlap.
    * ``specials``: the special tokens of every chunk too, as in ``chunk_tokens`` (A10); not together with the others.
    """
    if specials and (spans or words or features):
        raise ValueError("special tokens have no word, span or text")
    spans = spans or {}
    keep = keep or []
    tokenizer = tokenizer or O.pieces()
    window = None if max_length is None else _window(max_length, stride)
    src = df.select(key, *keep, F.col(text).cast("string").alias("_text"), *(F.col(c).cast(SPANS).alias(f"_s{i}") for i, c in enumerate(spans.values())))
    rest = [key, *keep]
    ints = ["chunk_idx", "pos", "tok_pos", "start", "end"] + (["word_idx", "word_start", "word_end"] if words else [])
    texts_out = ["tok", "left", "right"] if features else []
    names = [*rest, *ints, *spans, *texts_out]

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = O.Texts(batch.column("_text"))
        bounds, _ = t.words()
        tokens = tokenizer(batch.column("_text"), t, bounds)
        width, step = window or (max(1, int(np.diff(tokens.first).max(initial=0))),) * 2
        c = O.chunk(tokens, width, step, specials)
        if specials:
            return pa.RecordBatch.from_arrays(
                [*(batch.column(x).take(pa.array(c.doc)) for x in rest), *_chunk_columns(c, tokens)], names)
        at = c.token
        doc, alone = c.doc, np.zeros(len(at), bool)
        numbers = [c.chunk, c.pos, tokens.index()[at], tokens.start[at], tokens.end[at]]
        if words:
            own = O.assign(tokens, bounds)
            flat = np.where(own >= 0, bounds.first[tokens.documents()] + own, -1)
            untouched = np.ones(len(bounds.start), bool)
            untouched[flat[flat >= 0]] = False
            extra = np.flatnonzero(untouched)
            doc = np.concatenate([doc, bounds.documents()[extra]])
            word = np.concatenate([flat[at], extra])
            alone = np.arange(len(doc)) >= len(at)
            numbers = [np.concatenate([x, y]) for x, y in zip(
                numbers, [np.zeros(len(extra), int)] * 3 + [bounds.start[extra], bounds.end[extra]], strict=True)]
            no_word = word < 0
            word = np.maximum(word, 0)
        cols = [batch.column(x).take(pa.array(doc)) for x in rest]
        cols += [_ints(x, alone if i < 3 else None) for i, x in enumerate(numbers)]
        if words:
            none = np.zeros(1, np.int64)
            cols += [_ints(x[word] if len(x) else none[word], no_word) for x in (bounds.index(), bounds.start, bounds.end)]
        for i in range(len(spans)):
            own_spans, structs = O.list_ranges(batch.column(f"_s{i}"))
            scores = pc.fill_null(pc.struct_field(structs, "score"), 0.0).to_numpy(zero_copy_only=False).astype(float)
            values = O.span_maximum(tokens, own_spans, scores)[at]
            cols.append(pa.array(np.concatenate([values, np.zeros(len(doc) - len(at))])))
        if features:
            strings = t.cut(tokens)
            same = (c.doc[1:] == c.doc[:-1]) & (c.chunk[1:] == c.chunk[:-1])
            inner = np.concatenate([[False], same]) if len(at) else same
            left = strings.take(pa.array(np.where(inner, at - 1, 0), mask=~inner))
            inner = np.concatenate([same, [False]]) if len(at) else same
            right = strings.take(pa.array(np.where(inner, at + 1, 0), mask=~inner))
            missing = pa.nulls(len(doc) - len(at), pa.large_string())
            for col in (strings.take(pa.array(at)), left.fill_null(FIRST), right.fill_null(LAST)):
                cols.append(pa.concat_arrays([col, missing]).cast(pa.string()))
        return pa.RecordBatch.from_arrays(cols, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in O.slices(batch.column("_text")):
                yield rows(batch.slice(lo, hi - lo))

    schema = T.StructType([
        *(src.schema[x] for x in rest), *(T.StructField(x, T.IntegerType()) for x in ints),
        *(T.StructField(x, T.DoubleType()) for x in spans), *(T.StructField(x, T.StringType()) for x in texts_out)])
    return src.mapInArrow(run, schema)


def token_units(texts: pa.Array, tokenizer: O.Tokenizer, window: tuple[int, int]) -> tuple[list[pa.Array], list]:
    """The distinct tokens of a batch, each alone as ``tok``, as ``left`` and as ``right`` of ``token_rows(...,
    features=True)``, where ``FIRST`` closes the lefts and ``LAST`` the rights; and per document the tokens' numbers, the
    tokens of its chunks (4 x place, + 2 at the start of the chunk, + 1 at its end), the word of each, and the words'
    starts and ends.  A token that is the same in two chunks counts once, one without a word not at all."""
    t = O.Texts(texts)
    bounds, _ = t.words()
    tokens = tokenizer(texts, t, bounds)
    c = O.chunk(tokens, *window, False)
    own = O.assign(tokens, bounds)
    strings = t.cut(tokens).dictionary_encode()
    same = (c.doc[1:] == c.doc[:-1]) & (c.chunk[1:] == c.chunk[:-1])
    edge = np.zeros(len(c.token), np.int64)
    if len(edge):
        edge += 2 * np.append(True, ~same) + np.append(~same, True)
    seen = np.unique((4 * c.token + edge)[own[c.token] >= 0])
    at, edge = seen // 4, seen % 4
    rows = np.searchsorted(at, tokens.first)
    place = tokens.index()[at] * 4 + edge
    names, alone = strings.dictionary, pa.nulls
    n, text = len(strings.dictionary), pa.large_string()
    left, right = (pa.concat_arrays([names, pa.array([x], text)]) for x in (FIRST, LAST))
    columns = [pa.concat_arrays([names, alone(2 * n + 2, text)]), pa.concat_arrays([alone(n, text), left, alone(n + 1, text)]),
               pa.concat_arrays([alone(2 * n + 1, text), right])]
    return columns, [(strings.indices.to_numpy(zero_copy_only=False), tokens.first), (place, rows), (own[at], rows),
                     (bounds.start, bounds.first), (bounds.end, bounds.first)]


def unit_margins(weights: np.ndarray, code: np.ndarray, first: np.ndarray, place: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the weights of each token of ``token_units``, of its left and of its right."""
    n = (len(weights) - 2) // 3
    tok, left, right = weights[:n], weights[n:2 * n + 1], weights[2 * n + 1:]
    at = np.repeat(first[:-1], np.diff(rows)) + place // 4
    before = np.where(place & 2, n, code[np.maximum(at - 1, 0)])
    after = np.where(place & 1, n, code[np.minimum(at + 1, len(code) - 1)]) if len(code) else at
    return tok[code[at]] + left[before] + right[after]


def word_tokens(df: DataFrame, key: str, text: str = "text", tokenizer: O.Tokenizer | None = None,
                max_length: int | None = None, stride: int = 0, keep: list[str] | None = None) -> DataFrame:
    """The words of every text with their tokens (J5) beside each other, one row a text: ``(key, keep..., words)``,
    where a word has ``start``, ``end`` and the ``tokens`` that belong to it, once per chunk they are in (``chunk_idx, pos,
    tok_pos, start, end`` as in ``token_rows``).  A NULL text has no words."""
    keep = keep or []
    tokenizer = tokenizer or O.pieces()
    window = None if max_length is None else _window(max_length, stride)
    src = df.select(key, *keep, F.col(text).cast("string").alias("_text"))
    rest = [key, *keep]

    def lists(first: np.ndarray, columns: dict[str, np.ndarray | pa.Array]) -> pa.Array:
        flat = [x if isinstance(x, pa.Array) else _ints(x) for x in columns.values()]
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays(flat, list(columns)))

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = O.Texts(batch.column("_text"))
        bounds, _ = t.words()
        tokens = tokenizer(batch.column("_text"), t, bounds)
        c = O.chunk(tokens, *(window or (max(1, int(np.diff(tokens.first).max(initial=0))),) * 2), False)
        own = O.assign(tokens, bounds)
        word = np.where(own >= 0, bounds.first[tokens.documents()] + own, -1)[c.token]
        order = np.argsort(word, kind="stable")[np.count_nonzero(word < 0):]
        at = c.token[order]
        first = np.concatenate([[0], np.cumsum(np.bincount(word[order], minlength=len(bounds.start)))])
        inner = lists(first, {"chunk_idx": c.chunk[order], "pos": c.pos[order], "tok_pos": tokens.index()[at],
                              "start": tokens.start[at], "end": tokens.end[at]})
        words = lists(bounds.first, {"start": bounds.start, "end": bounds.end, "tokens": inner})
        return pa.RecordBatch.from_arrays([*(batch.column(x) for x in rest), words], [*rest, "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in O.slices(batch.column("_text")):
                yield rows(batch.slice(lo, hi - lo))

    return src.mapInArrow(run, T.StructType([*(src.schema[x] for x in rest), T.StructField("words", T.ArrayType(WORD))]))


def word_maxima(rows: DataFrame, key: str, prob: str | Callable[[Column], Column] = "prob", best: int | None = None,
                docs: DataFrame | None = None, text: str = "text") -> DataFrame:
    """A11 on ``token_rows(..., words=True)``: ``(key, word_idx, start, end, score)``, the maximum of ``prob``
    over the tokens of each word and all chunks; words without a token 0.0.

    With ``best``, on ``word_tokens`` with ``prob`` a function of a token: only words that may be among the ``best`` of
    their key in ``top_evidence_rows``, which are all there with their scores.  The others are left out beside their
    text, before the shuffle.  ``docs``, the ``(key, text)`` of ``rows``: where texts share a key, ``start`` and ``end`` are
    the largest of that word in all of them, as they are without ``best``."""
    if best is not None:
        rows = _best_words(rows, key, prob, best)
        p = F.col("prob")
    else:
        p = F.when(F.col("tok_pos").isNotNull(), F.coalesce(F.col(prob).cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))
    out = rows.where(F.col("word_idx").isNotNull()).groupBy(key, "word_idx").agg(
        F.max("word_start").alias("start"), F.max("word_end").alias("end"), F.max(p).alias("score"))
    return out if best is None or docs is None else _shared_places(out, docs, key, text)


def _best_words(rows: DataFrame, key: str, prob: Callable[[Column], Column], k: int) -> DataFrame:
    """The k best words of each text.  Where texts share a key, a word left out of one has k words before it there, whose
    scores in all of them are no lower; a word among the k best of all is so in the text with its highest score."""
    def scored(w: Column, i: Column) -> Column:
        p = F.array_max(F.transform(w["tokens"], lambda t: F.coalesce(prob(t).cast("double"), F.lit(0.0))))
        return F.struct(F.coalesce(p, F.lit(0.0)).alias("prob"), (-i).alias("back"), w["start"].alias("word_start"),
                        w["end"].alias("word_end"))
    top = F.slice(F.sort_array(F.transform("words", scored), asc=False), 1, k)
    return rows.select(key, F.inline(top)).select(key, (-F.col("back")).alias("word_idx"), "word_start", "word_end", "prob")


def _shared_places(scores: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``scores`` with the largest ``start`` and ``end`` of the word in the documents, for keys of several documents."""
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    several = docs.groupBy(F.col(key).alias("_key")).count().where(F.col("count") > 1)
    places = word_rows(texts.join(several, "_key", "left_semi"), "_key", "_text").groupBy(
        "_key", F.col("word_idx").alias("_word")).agg(F.max("start").alias("_start"), F.max("end").alias("_end"))
    same = (F.col(key) == F.col("_key")) & (F.col("word_idx") == F.col("_word"))
    return scores.join(places, same, "left").select(
        key, "word_idx", F.coalesce("_start", "start").alias("start"), F.coalesce("_end", "end").alias("end"), "score")


def with_words(rows: DataFrame, docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Add ``word``, the text from ``start`` to ``end``, by one join with the documents."""
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    word = F.substring(F.col("_text"), F.col("start") + 1, F.col("end") - F.col("start"))
    return rows.join(texts, F.col(key) == F.col("_key")).withColumn("word", word).drop("_key", "_text")


# ----------------------------------------------------------------------------- J5 / A11


_WSTRUCT = "struct<word_idx:int,start:int,end:int>"


def _sweep(tokens: DataFrame, words: DataFrame, key: str, word_cols: list[str]) -> DataFrame:
    """Tokens and words of a document in one position-ordered window (see ``_sweep_union``)."""
    tcols = [c for c in tokens.columns if c != key]
    tok_t = T.StructType([tokens.schema[c] for c in tcols])
    extra_t = T.StructType([words.schema[c] for c in word_cols])
    cur = F.struct("word_idx", "start", "end")
    w_rows = words.select(
        key, F.col("start").alias("_pos"), F.lit(0).alias("_kind"), cur.alias("_cur"),
        F.lit(None).cast(tok_t).alias("_tok"), F.struct(*word_cols).cast(extra_t).alias("_w"))
    t_rows = tokens.select(
        key, F.col("start").alias("_pos"), F.lit(1).alias("_kind"), F.lit(None).cast(_WSTRUCT).alias("_cur"),
        F.struct(*tcols).alias("_tok"), F.lit(None).cast(extra_t).alias("_w"))
    return _sweep_union(w_rows.unionByName(t_rows), key)


def _sweep_union(u: DataFrame, key: str) -> DataFrame:
    """``u``: ``(key, _pos, _kind, _cur, _tok, _w)`` rows of words (kind 0) and tokens
    (kind 1).  Word rows get the next word (a ``lead`` over the same partition, no extra
    shuffle); tokens before the first word see it as "next" (sentinel).  Every row gets
    ``_a``: the last word (and its successor) started at or before its position."""
    order = Window.partitionBy(key).orderBy("_pos", "_kind", "_cur.word_idx")
    words_only = Window.partitionBy(key).orderBy(F.col("_kind"), F.col("_cur.word_idx"))
    # successor of a word (words sort before tokens, so a lead over (kind, idx) stays in words)
    u = u.withColumn("_next", F.when(F.col("_kind") == 0, F.lead("_cur").over(words_only)))
    u = u.withColumn("_first", F.first(F.when(F.col("_kind") == 0, F.col("_cur")), ignorenulls=True).over(
        Window.partitionBy(key).orderBy("_kind", "_cur.word_idx").rowsBetween(Window.unboundedPreceding,
                                                                              Window.unboundedFollowing)))
    anchor = F.last(F.when(F.col("_kind") == 0, F.struct(F.col("_cur").alias("c"), F.col("_next").alias("n"))),
                    ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    u = u.withColumn("_a", anchor)
    # before the first word: the sentinel (no current word, next = first word)
    return u.withColumn("_a", F.coalesce("_a", F.struct(F.lit(None).cast(_WSTRUCT).alias("c"),
                                                         F.col("_first").alias("n"))))


def _assigned_idx() -> Column:
    ts, te = F.col("_tok.start"), F.col("_tok.end")

    def overlaps(w):
        return w.isNotNull() & (F.greatest(w["start"], ts) < F.least(w["end"], te))
    c, n = F.col("_a.c"), F.col("_a.n")
    return F.when(te <= ts, F.lit(None).cast("int")).when(overlaps(c), c["word_idx"]).when(overlaps(n), n["word_idx"])


def assign_words(tokens: DataFrame, words: DataFrame, key: str) -> DataFrame:
    """Add ``word_idx`` to every token row (NULL when no word overlaps or the token
    is zero-length).  The word is the one with the greatest start ≤ token start, else
    the next word; it must overlap the token.

    ``words`` is long ``(key, word_idx, start, end)``; tokens need ``start``, ``end``.
    Words and tokens of a document meet in one sorted window (one shuffle by ``key``)."""
    tcols = [c for c in tokens.columns if c != key]
    sw = _sweep(tokens, words.select(key, "word_idx", "start", "end"), key, [])
    return sw.where(F.col("_kind") == 1).select(key, *[F.col(f"_tok.{x}").alias(x) for x in tcols],
                                               _assigned_idx().alias("word_idx"))


def word_scores(tokens: DataFrame, words: DataFrame, key: str, prob: str = "prob") -> DataFrame:
    """Per word, the max probability of the tokens assigned to it over all chunks;
    untouched words 0.0.  ``words`` long ``(key, word_idx, start, end, word...)``.

    One sweep: word rows (score 0.0, carrying their columns) and assigned token rows are
    grouped by (key, word_idx) inside the sweep's partitioning — the words are read once,
    with no further shuffle or join."""
    wcols = [c for c in words.columns if c not in (key, "word_idx", "start", "end")]
    toks = tokens.where(F.col("end") > F.col("start")).select(key, "start", "end", prob)
    return _scores_from_sweep(_sweep(toks, words, key, wcols), key, prob, wcols)


def _scores_from_sweep(sw: DataFrame, key: str, prob: str, wcols: list[str]) -> DataFrame:
    is_word = F.col("_kind") == 0
    idx = F.when(is_word, F.col("_cur.word_idx")).otherwise(_assigned_idx())
    p = F.when(is_word, F.lit(0.0)).otherwise(F.col(f"_tok.{prob}"))
    rows = sw.select(key, idx.alias("word_idx"), p.alias("_p"),
                     F.when(is_word, F.col("_cur.start")).alias("start"), F.when(is_word, F.col("_cur.end")).alias("end"),
                     *[F.col(f"_w.{c}").alias(c) for c in wcols]).where(F.col("word_idx").isNotNull())
    agg = rows.groupBy(key, "word_idx").agg(F.max("_p").alias("score"), F.max("start").alias("start"),
                                            F.max("end").alias("end"), *[F.max(c).alias(c) for c in wcols])
    return agg.select(key, "word_idx", "start", "end", *wcols, "score")


def word_index(word_scores_df: DataFrame, key: str, threshold: float, docs: DataFrame | None = None) -> DataFrame:
    """Share of words with ``score >= threshold``; documents without words → 0.0."""
    per = word_scores_df.groupBy(key).agg(F.avg((F.col("score") >= F.lit(threshold)).cast("double")).alias("index"))
    if docs is None:
        return per
    return docs.select(key).join(per, key, "left").select(key, F.coalesce("index", F.lit(0.0)).alias("index"))


def top_evidence_rows(word_scores_df: DataFrame, key: str, k: int = DEFAULT_EVIDENCE_K) -> DataFrame:
    """A13 long form: the k best words per document by score, ties in text order,
    with their ``rank`` (1-based)."""
    w = Window.partitionBy(key).orderBy(F.desc("score"), F.asc("word_idx"))
    return word_scores_df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_evidence(word_scores_df: DataFrame, key: str, k: int = DEFAULT_EVIDENCE_K) -> DataFrame:
    """``(key, evidence)`` — array of ``{word, start, end, score}`` in rank order."""
    return _ranked(top_evidence_rows(word_scores_df, key, k), key)


def evidence(scores: DataFrame, docs: DataFrame, key: str, text: str = "text", k: int = DEFAULT_EVIDENCE_K) -> DataFrame:
    """A13 for scores without their words (``word_maxima``), which come from the documents."""
    return _ranked(with_words(top_evidence_rows(scores, key, k), docs, key, text), key)


def _ranked(top: DataFrame, key: str) -> DataFrame:
    return top.groupBy(key).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "word", "start", "end", "score"))),
        lambda s: F.struct(s["word"].alias("word"), s["start"].alias("start"), s["end"].alias("end"),
                           s["score"].alias("score"))).alias("evidence"))


def soft_ratio(chunk_tokens_df: DataFrame, docs: DataFrame, key: str, prob: str = "prob") -> DataFrame:
    """Mean token probability over content tokens; 0 when a document has none."""
    m = chunk_tokens_df.where(F.col("end") > F.col("start")).groupBy(key).agg(F.avg(prob).alias("_r"))
    return docs.select(key).join(m, key, "left").select(key, F.coalesce("_r", F.lit(0.0)).alias("soft_ratio"))


def token_class_counts(chunk_tokens_df: DataFrame, targets: list[str]) -> DataFrame:
    """Per target, positive (≥ 0.5) and negative content tokens (rows of annotated
    documents; a token in two chunks counts twice)."""
    content = chunk_tokens_df.where(F.col("end") > F.col("start"))
    aggs = []
    for t in targets:
        aggs += [F.count_if(F.col(t) >= 0.5).alias(f"{t}_pos"), F.count_if(F.col(t) < 0.5).alias(f"{t}_neg")]
    return content.agg(*aggs)
