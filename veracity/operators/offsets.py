"""Offset arithmetic on the flat arrays of an Arrow batch.

A batch of documents is a few flat numpy arrays: ``first`` (where each document's entries
begin, one more entry than documents) and one array per property.  Offsets are code
points within the document.  Nothing here loops over words or tokens.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Python's white space (``str.isspace``), whose complement is a word character.
SPACES = [c for c in range(0x3001) if chr(c).isspace()]
_ASCII = np.zeros(256, bool)
_ASCII[[c for c in SPACES if c < 0x80]] = True
_WIDE = [chr(c).encode() for c in SPACES if c >= 0x80]
_LEADS = np.zeros(256, bool)
_LEADS[[x[0] for x in _WIDE]] = True
#: Bytes of text that a pass handles at a time; a longer text is taken alone.  Its arrays of tokens, in and
#: out of chunks, take about 200 times as much.
SLICE = 1 << 20


@dataclass
class Ranges:
    """Half-open code-point ranges of a batch: the ranges ``first[i]`` to ``first[i + 1]`` are document i's."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def documents(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def index(self) -> np.ndarray:
        """Position of each range within its document."""
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], np.diff(self.first))


class Texts:
    """A batch of texts (null: empty) as UTF-8 bytes, with code-point positions."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        body = texts.buffers()[2]
        raw = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
        self.data = raw[offsets[0]:offsets[-1]]
        self.first = offsets - offsets[0]
        #: code points before each byte
        self.points = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        self.base = self.points[self.first]
        self.lengths = np.diff(self.base)

    def spaces(self) -> np.ndarray:
        """Which bytes belong to white space."""
        out = _ASCII[self.data]
        wide = np.flatnonzero(_LEADS[self.data])
        for space in _WIDE:
            at = wide[wide + len(space) <= len(self.data)]
            for k, byte in enumerate(space):
                at = at[self.data[at + k] == byte]
            for k in range(len(space)):
                out[at + k] = True
        return out

    def words(self) -> tuple[Ranges, pa.Array]:
        """The words and their strings."""
        inside = ~self.spaces()
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.first] = True
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        first = np.searchsorted(starts, self.first)
        base = np.repeat(self.base[:-1], np.diff(first))
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        strings = pa.Array.from_buffers(pa.large_string(), len(starts), [
            None, pa.py_buffer(offsets), pa.py_buffer(self.data[inside].tobytes())])
        return Ranges(first, self.points[starts] - base, self.points[ends] - base), strings

    def cut(self, ranges: Ranges) -> pa.Array:
        """The strings of ranges that do not overlap and are in order."""
        base = np.repeat(self.base[:-1], np.diff(ranges.first))
        # byte of each code point; the end of the batch closes the last
        heads = np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))
        lo, hi = heads[ranges.start + base], heads[ranges.end + base]
        keep = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(keep, lo, 1)
        np.add.at(keep, hi, -1)
        offsets = np.concatenate([[0], np.cumsum(hi - lo)])
        body = self.data[np.cumsum(keep[:-1]) > 0]
        return pa.Array.from_buffers(pa.large_string(), len(lo), [None, pa.py_buffer(offsets), pa.py_buffer(body.tobytes())])


# ----------------------------------------------------------------------------- tokenizers

#: A tokenizer makes the token ranges of a batch from its texts and their words.
Tokenizer = Callable[[pa.Array, Texts, Ranges], Ranges]


def pieces(size: int = 4) -> Tokenizer:
    """Every word cut into pieces of at most ``size`` characters."""
    def run(texts: pa.Array, t: Texts, words: Ranges) -> Ranges:
        n = -(-(words.end - words.start) // size)
        before = np.concatenate([[0], np.cumsum(n)])
        word = np.repeat(np.arange(len(n)), n)
        start = words.start[word] + size * (np.arange(len(word)) - before[word])
        return Ranges(before[words.first], start, np.minimum(words.end[word], start + size))
    return run


def windows(size: int) -> Tokenizer:
    """The whole text in windows of ``size`` characters, white space included."""
    def run(texts: pa.Array, t: Texts, words: Ranges) -> Ranges:
        n = -(-t.lengths // size)
        first = np.concatenate([[0], np.cumsum(n)])
        start = size * (np.arange(first[-1]) - np.repeat(first[:-1], n))
        return Ranges(first, start, np.minimum(start + size, np.repeat(t.lengths, n)))
    return run


def matches(pattern: str) -> Tokenizer:
    """Matches of a Python regular expression."""
    rx = re.compile(pattern)

    def run(texts: pa.Array, t: Texts, words: Ranges) -> Ranges:
        spans = [[m.span() for m in rx.finditer(x or "")] for x in texts.to_pylist()]
        first = np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int64)
        flat = np.array([x for s in spans for x in s], np.int64).reshape(-1, 2)
        return Ranges(first, flat[:, 0], flat[:, 1])
    return run


# ----------------------------------------------------------------------------- alignment


def assign(tokens: Ranges, words: Ranges) -> np.ndarray:
    """Index within the document of each token's word, or -1.

    Both sides are in order of their start, so one merge pairs each token with the last word that
    starts at or before it; if that one does not overlap the token, with the next.
    """
    doc = tokens.documents()
    # documents far apart on one axis: a single merge for the batch
    at = np.searchsorted((words.documents() << 32) + words.start, (doc << 32) + tokens.start, side="right") - 1
    lo, hi = words.first[doc], words.first[doc + 1]
    out = np.full(len(tokens.start), -1)
    if not len(words.start):
        return out
    for candidate in (np.maximum(at, lo - 1) + 1, at):  # the word itself wins over the next
        inside = (candidate >= lo) & (candidate < hi)
        w = np.where(inside, candidate, 0)
        over = inside & (np.maximum(words.start[w], tokens.start) < np.minimum(words.end[w], tokens.end))
        out = np.where(over, candidate - lo, out)
    return out


def span_maximum(tokens: Ranges, spans: Ranges, scores: np.ndarray) -> np.ndarray:
    """The largest score of the spans that overlap each token, within 0 and 1; 0 without any.

    A sweep over the spans' sorted end points keeps the open spans in a heap and gives the
    maximum of each segment between two end points; a token covers a run of segments, whose
    maximum comes from a table of maxima over runs of 1, 2, 4, ... segments.  Time grows with
    spans and tokens, not with their product.
    """
    out = np.zeros(len(tokens.start))
    real = spans.end > spans.start
    doc = spans.documents()[real]
    lo, hi = ((doc << 32) + x[real] for x in (spans.start, spans.end))
    if not len(lo):
        return out
    points = np.unique(np.concatenate([lo, hi]))
    best = np.full(len(points), -np.inf)
    order = np.argsort(lo, kind="stable")
    starts, ends, values = lo[order].tolist(), hi[order].tolist(), scores[real][order].tolist()
    heap: list[tuple[float, int]] = []
    k = 0
    for i, p in enumerate(points.tolist()):
        while k < len(starts) and starts[k] <= p:
            heappush(heap, (-values[k], ends[k]))
            k += 1
        while heap and heap[0][1] <= p:
            heappop(heap)
        if heap:
            best[i] = -heap[0][0]
    # segment i runs from point i to the next
    t_doc = tokens.documents() << 32
    a = np.maximum(np.searchsorted(points, t_doc + tokens.start, side="right") - 1, 0)
    b = np.searchsorted(points, t_doc + tokens.end, side="left")
    some = (b > a) & (tokens.end > tokens.start)
    n = np.where(some, b - a, 1)
    level = np.floor(np.log2(n)).astype(int)
    table = [best]
    for k in range(int(level.max(initial=0))):
        half = 1 << k
        table.append(np.maximum(table[-1], np.concatenate([table[-1][half:], np.full(half, -np.inf)])[:len(best)]))
    for k, maxima in enumerate(table):
        at = some & (level == k)
        i, j = a[at], b[at] - (1 << k)
        # a gap between two documents is a segment that no span covers
        out[at] = np.clip(np.maximum(maxima[i], maxima[j]), 0.0, 1.0)
    return out


@dataclass
class Chunks:
    """Windows over tokens (A8) with two special tokens each (A10), as flat rows.

    ``token`` is the index of the row's token in the batch, -1 for a special one.
    """

    doc: np.ndarray
    chunk: np.ndarray
    pos: np.ndarray
    token: np.ndarray


def chunk(tokens: Ranges, width: int, step: int, specials: bool = True) -> Chunks:
    n = np.diff(tokens.first)
    per_doc = np.where(n <= width, 1, -(-(n - width) // step) + 1)
    doc = np.repeat(np.arange(len(n)), per_doc)
    index = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    content = np.clip(n[doc] - index * step, 0, width)
    size = content + 2
    row = np.repeat(np.arange(len(doc)), size)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    inner = (pos > 0) & (pos <= content[row])
    if not specials:
        row, pos = row[inner], pos[inner]
        inner = np.ones(len(row), bool)
    token = np.where(inner, tokens.first[doc[row]] + index[row] * step + pos - 1, -1)
    return Chunks(doc[row], index[row], pos, token)


# ----------------------------------------------------------------------------- batches


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = used = 0
    for i, n in enumerate(sizes.tolist()):
        if i > at and used + n > limit:
            yield at, i
            at, used = i, 0
        used += n
    if len(sizes) > at:
        yield at, len(sizes)


def list_ranges(spans: pa.Array) -> tuple[Ranges, pa.StructArray]:
    """Ranges of an array column of structs with ``start`` and ``end`` (null: none), and the flat structs."""
    n = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(spans)
    start, end = (pc.struct_field(flat, f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "end"))
    return Ranges(np.concatenate([[0], np.cumsum(n)]).astype(np.int64), start, end), flat
