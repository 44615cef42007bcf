"""Cross-tokenizer alignment (12): the token intervals of two vocabularies coalesced into groups.

A token is an interval of bytes.  The tokens of both vocabularies are sorted by start, a
running maximum of the ends is kept, and a group breaks where a start reaches it: there both
vocabularies end a token.  Two tokens are linked where they end together.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.session import ensure_checkpoint_dir

#: Bytes of text that a task aligns at a time; a longer text is taken alone.
SLICE = 4 << 20
SPACE = 0x20


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Vocabularies:
    """A byte-level vocabulary (``a``, a ``tokenizers`` file) and one of pieces (``b``, a ``sentencepiece`` file).

    ``fast``: encode ``a`` with ``tiktoken``, which takes the ids of the file's own vocabulary as
    ranks, if the file lists its merges in the order of their ids (else it is not used).
    """

    def __init__(self, a_path: str, b_path: str, fast: bool = True):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.fast = fast
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            self.spec = json.load(f)
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in plain]
        alphabet = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}
        self.a_bytes = {i: bytes(alphabet[c] for c in t) for t, i in self.spec["model"]["vocab"].items()
                        if all(c in alphabet for c in t)}
        self.pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = {
            i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.pieces) if not (self.b.is_control(i) or self.b.is_unknown(i))}
        self.b_size = len(self.pieces)

    @cached_property
    def cuts(self) -> bool:
        """Whether both vocabularies start anew at a space after another character.

        True if no piece of ``b`` holds a space after anything but spaces, so that no merge
        crosses it, and ``a`` splits by the byte-level pattern without changing the text.
        """
        return self.byte_level and not any(re.search("[^▁]▁", p) for p in self.pieces)

    @cached_property
    def byte_level(self) -> bool:
        """Whether ``a`` splits a text by the byte-level pattern, without changing it."""
        pre = self.spec.get("pre_tokenizer") or {}
        return bool(pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                    and not self.spec.get("normalizer"))

    @cached_property
    def ranked(self):
        """``a`` as a ``tiktoken`` encoding, or None."""
        model = self.spec["model"]
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        in_order = [vocab.get("".join(m)) for m in pairs] == list(range(256, 256 + len(pairs)))
        ranks = {x: i for i, x in self.a_bytes.items() if i < 256 + len(pairs)}
        if not (self.fast and self.byte_level and model.get("type") == "BPE" and in_order and len(ranks) == 256 + len(pairs)):
            return None
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def possible_links(self) -> int:
        """How many id pairs can end together at all: the bytes of one are the end of the other's.

        It depends on the vocabularies alone and bounds the table of counts.
        """
        by_a, by_b = defaultdict(list), defaultdict(list)
        for i, x in self.a_bytes.items():
            by_a[x].append(i)
        for i, x in self.b_bytes.items():
            by_b[x].append(i)
        found = {(i, j) for i, x in self.a_bytes.items() for k in range(len(x)) for j in by_b.get(x[k:], ())}
        found |= {(i, j) for j, x in self.b_bytes.items() for k in range(len(x)) for i in by_a.get(x[k:], ())}
        return len(found)

    def encode(self, units: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of ``a`` and ``b``; every unit starts with a space, which ``b`` adds by itself."""
        texts = [u.decode() for u in units]
        if self.ranked:
            a = [self.ranked.encode_ordinary(t) for t in texts]
        else:
            a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return a, self.b.encode([t[1:] for t in texts], num_threads=1)


def unit_starts(data: np.ndarray, docs: np.ndarray, cuts: bool) -> np.ndarray:
    """Starts of the units of ``data``, in which each document begins with a space at ``docs``.

    A unit ends at a single space after a character that is certainly no white space or
    control character; units are encoded alone, so each distinct one only once.
    """
    if not cuts:
        return docs
    starts = np.zeros(len(data), bool)
    starts[docs] = True
    at = np.flatnonzero((data[:-1] == SPACE) & ~starts[:-1])
    at = at[data[at + 1] != SPACE]  # also leaves out the last byte of a document: the next begins with a space
    p1, p2, p3 = data[at - 1], data[at - 2], data[at - 3]
    wide = (p2 == 0xC2) | (p3 == 0xE1) | ((p3 == 0xE2) & ((p2 == 0x80) | (p2 == 0x81))) | ((p3 == 0xE3) & (p2 == 0x80))
    fine = (p1 > SPACE) & (p1 != 0x7F) & ((p1 < 0x80) | ~wide)
    starts[at[fine]] = True
    return np.flatnonzero(starts)


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Group of every A and every B interval, and the number of groups.

    All intervals are sorted by start; a group breaks where a start reaches the running
    maximum of the ends, so overlapping ones share a group.
    """
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    side = np.repeat([0, 1], [len(a_start), len(b_start)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.concatenate([[False], start[order][1:] >= reach[:-1]])
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(breaks)
    return group[:len(a_start)], group[len(a_start):], int(breaks.sum()) + 1


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n


def _spans(ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte intervals of tokens that follow each other within their unit."""
    size = sizes[ids]
    upto = np.cumsum(size)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    before = np.concatenate([[0], upto])
    shift = np.repeat(base - before[first], n)
    return upto - size + shift, upto + shift


def _joined(parts: pa.Array, edges: np.ndarray, sep: str) -> pa.Array:
    """The strings from each edge to the next, joined."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), parts), pa.scalar(sep, pa.large_string()))


def _ragged(values: np.ndarray, n: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The lists number ``pick``, one after another, of lists of ``n`` values each."""
    take = n[pick]
    ends = np.cumsum(take)
    begin = np.concatenate([[0], np.cumsum(n)])[pick]
    return values[np.arange(int(take.sum())) - np.repeat(ends - take, take) + np.repeat(begin, take)]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.v = Vocabularies(a_path, b_path)
        self.n_codes = (max(self.v.a_bytes) + 2) * self.v.b_size
        # bytes by id; ids without any spell nothing
        self.a_table, self.b_table = (pa.array([t.get(i, b"") for i in range(max(t) + 2)], pa.large_binary())
                                      for t in (self.v.a_bytes, self.v.b_bytes))
        self.a_sizes, self.b_sizes = (pc.binary_length(t).to_numpy() for t in (self.a_table, self.b_table))

    def units(self, units: list[bytes]) -> dict:
        """Alignment of each unit: counts, link codes, spelled groups, and whether its bytes come back."""
        a_list, b_list = self.v.encode(units)
        good = self.spells(units, a_list, self.a_table) & self.spells(units, b_list, self.b_table)
        if not good.all():
            a_list, b_list = ([x if g else [] for x, g in zip(ids, good.tolist(), strict=True)] for ids in (a_list, b_list))
        a, n_a = _flat(a_list)
        b, n_b = _flat(b_list)
        size = np.fromiter(map(len, units), np.int64, len(units))
        base = np.cumsum(size) - size
        a_start, a_end = _spans(a, n_a, self.a_sizes, base)
        b_start, b_end = _spans(b, n_b, self.b_sizes, base)
        a_group, b_group, n_groups = coalesce(a_start, a_end, b_start, b_end)
        # ends rise in each vocabulary: the ends of A that are ends of B too
        j = np.minimum(np.searchsorted(b_end, a_end), max(len(b_end) - 1, 0))
        i = np.flatnonzero(b_end[j] == a_end) if len(b_end) else j
        j = j[i]
        unit_a = np.repeat(np.arange(len(units)), n_a)
        # the groups of a unit follow each other, and none is of two units
        a_first, b_first = (np.searchsorted(g, np.arange(n_groups + 1)) for g in (a_group, b_group))
        spelled = pc.binary_join_element_wise(*(
            _joined(pa.array(ids).cast(pa.large_string()), first, ",") for ids, first in ((a, a_first), (b, b_first))),
            pa.scalar("|", pa.large_string()))
        per_unit = np.bincount(unit_a[a_first[:-1]], minlength=len(units))
        text = _joined(spelled, np.concatenate([[0], np.cumsum(per_unit)]), ";")
        return {"good": good, "n_a": n_a, "n_b": n_b, "n_groups": per_unit, "text": text,
                "links": a[i] * self.v.b_size + b[j], "n_links": np.bincount(unit_a[i], minlength=len(units))}

    @staticmethod
    def spells(units: list[bytes], ids: list[list[int]], table: pa.Array) -> np.ndarray:
        """Which units the joined bytes of their tokens spell."""
        flat, n = _flat(ids)
        tokens = table.take(pa.array(np.minimum(flat, len(table) - 1)))
        upto = np.concatenate([[0], np.cumsum(pc.binary_length(tokens).to_numpy())])
        edges = upto[np.concatenate([[0], np.cumsum(n)])]
        size = np.fromiter(map(len, units), np.int64, len(units))
        spelled = tokens.buffers()[2].to_pybytes() if len(tokens) else b""
        same = np.diff(edges) == size
        if same.all() and spelled == b"".join(units):
            return same
        at = edges.tolist()
        return np.array([spelled[i:j] == u for u, i, j in zip(units, at, at[1:], strict=False)], bool)

    def texts(self, texts: list[str]) -> dict:
        """Alignment of texts, none of them empty: one entry per text."""
        raw = [b" " + t.encode() for t in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = b"".join(raw)
        docs = np.cumsum(size) - size
        starts = unit_starts(np.frombuffer(data, np.uint8), docs, self.v.cuts)
        edges = np.append(starts, len(data)).astype(np.int32)
        every = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        coded = every.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        u = self.units(coded.dictionary.to_pylist())
        first = np.searchsorted(starts, docs)
        owner = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(starts))))
        whole = np.logical_and.reduceat(u["good"][code], first)
        out = {k: np.where(whole, np.add.reduceat(u[k][code], first), 0) for k in ("n_a", "n_b", "n_groups", "n_links")}
        keep = whole[owner]
        links = _ragged(u["links"], u["n_links"], code[keep])
        of = np.repeat(owner[keep], u["n_links"][code[keep]])
        keys = np.sort(of * self.n_codes + links)
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
        out["codes"], out["times"] = keys[at] % self.n_codes, np.diff(np.append(at, len(keys)))
        out["list"] = np.searchsorted(keys[at], np.arange(len(texts) + 1) * self.n_codes)
        edges = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(texts)))])
        out["groups"] = _joined(u["text"].take(pa.array(code[keep])), edges, ";")
        return out


def slices(texts: list[str | None], limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` characters of text, or of one row."""
    at = used = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and used + n > limit:
            yield at, i
            at, used = i, 0
        used += n
    if len(texts) > at:
        yield at, len(texts)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, with_groups: bool = False) -> DataFrame:
    """Align both tokenizations of every whole text: one row per row of ``docs``.

    ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256``, the distinct links of the text
    (``codes``: A id times the size of B plus B id, ``times``: occurrences) and, if asked for,
    ``groups``, the ids as ``a1,a2|b1;a3|b2,b3``.  A text that is null, empty or whose tokens
    do not spell space + text in either vocabulary has no tokens: zeros, empty lists, ''.
    Repeated rows are aligned each; other columns are not read; an empty table gives an
    empty result.
    """
    paths = [p or d for p, d in zip((a_path, b_path), default_vocabularies(), strict=True)]
    kind = docs.schema["doc_id"].dataType
    count = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    fields = [T.StructField("doc_id", kind), *count, T.StructField("groups_sha256", T.StringType()),
              T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))]
    if with_groups:
        fields.append(T.StructField("groups", T.StringType()))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(*paths)
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                some = [i for i in range(lo, hi) if texts[i]]
                got = aligner.texts([texts[i] for i in some]) if some else None
                at = np.full(hi - lo, -1)
                at[np.array(some, np.int64) - lo] = np.arange(len(some))
                has = at >= 0

                def spread(values: np.ndarray, at=at, has=has) -> np.ndarray:
                    out = np.zeros(len(at), np.int64)
                    out[has] = values
                    return out

                zero = np.empty(0, np.int64)
                cols = [batch.column(0).slice(lo, hi - lo)]
                cols += [pa.array(spread(got[c] if got else zero)) for c in ("n_a", "n_b", "n_groups", "n_links")]
                groups = got["groups"].take(pa.array(np.maximum(at, 0))) if got else pa.nulls(hi - lo, pa.large_string())
                groups = pc.if_else(pa.array(has), groups, pa.scalar("", pa.large_string()))
                cols.append(pa.array([hashlib.sha256(g.as_buffer()).hexdigest() if len(g.as_buffer()) else "" for g in groups], pa.string()))
                n = spread(np.diff(got["list"]) if got else zero)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                cols.append(pa.ListArray.from_arrays(offsets, pa.array(got["codes"] if got else zero, pa.int64())))
                cols.append(pa.ListArray.from_arrays(offsets, pa.array(got["times"] if got else zero, pa.int32())))
                if with_groups:
                    cols.append(groups.cast(pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, T.StructType(fields))


def link_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """``code, count, best``: how many links of all documents hold each id pair linked.

    ``best``: no pair of the same B id is more frequent.  A task sums its pairs before they
    are shuffled; their number is bounded by ``Vocabularies.possible_links``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in batches:
            codes = pc.list_flatten(batch.column(0)).to_numpy(zero_copy_only=False)
            times = pc.list_flatten(batch.column(1)).to_numpy(zero_copy_only=False)
            codes, times = np.concatenate([total[0], codes]), np.concatenate([total[1], times])
            keys, where = np.unique(codes, return_inverse=True)
            total = keys, np.bincount(where, weights=times, minlength=len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in total], ["code", "n"])

    parts = aligned.select("codes", "times").mapInArrow(run, "code long, n long")
    counts = parts.groupBy("code").agg(F.sum("n").alias("count"))
    of_b = Window.partitionBy(F.pmod("code", F.lit(b_size)))
    return counts.select("code", "count", (F.col("count") == F.max("count").over(of_b)).alias("best"))


def score(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Every document with how common its links are in the whole corpus.

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.  The alignment is
    written once to the shared checkpoint folder; the counts, at most as many as id pairs can
    end together (324,297 with the default vocabularies, whatever the corpus), go to every task.
    """
    spark = docs.sparkSession
    paths = [p or d for p, d in zip((a_path, b_path), default_vocabularies(), strict=True)]
    vocabularies = Vocabularies(*paths)
    path = f"{ensure_checkpoint_dir(spark)}/alignment-{uuid.uuid4().hex}"
    align(docs, *paths).write.parquet(path)
    aligned = spark.read.parquet(path)
    counts = link_counts(aligned, vocabularies.b_size).toArrow()
    if counts.num_rows > vocabularies.possible_links():
        raise RuntimeError("more linked id pairs than the vocabularies allow")
    order = np.argsort(counts["code"].to_numpy())
    shared = spark.sparkContext.broadcast(tuple(counts[c].to_numpy()[order] for c in ("code", "count", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            lists = batch.column("codes")
            own = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            codes = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
            times = pc.list_flatten(batch.column("times")).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(keys, codes)
            edges = np.concatenate([[0], np.cumsum(own)])
            out = []
            for value in (times * best[at], times * n[at]):
                upto = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
                out.append(pa.array(upto[edges[1:]] - upto[edges[:-1]], pa.int64()))
            cols = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays([*cols, *out, batch.column("groups_sha256")], names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    schema = T.StructType([aligned.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in names[1:-1]),
                           T.StructField("groups_sha256", T.StringType())])
    return aligned.mapInArrow(run, schema)
