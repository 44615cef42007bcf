"""Best-fit packing (6): large pieces matched in pairs, small ones best-fit into the gaps."""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.common import checkpoint

CAPACITY = 1024
END = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Encoder of a batch of texts: all ids, and the number of ids of each text.

    The ids are those of ``tokenizers.Tokenizer.from_file(path).encode(text,
    add_special_tokens=False)``.  If the same vocabulary lies beside the file as ranks
    (``.tiktoken``), that faster library gives the same ids.  The pattern that splits a
    text before the merges always starts anew at a space between two non-space
    characters, so a text is cut there and each distinct word of a batch is encoded
    once; texts with other white space around a space are encoded whole.
    """
    import os

    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if os.path.exists(ranks):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                special_tokens={"<|endoftext|>": len(table)})

        def one(text: str) -> list[int]:
            return enc.encode(text, allowed_special="all")
    else:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)

        def one(text: str) -> list[int]:
            return tok.encode(text, add_special_tokens=False).ids

    def flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [one(t) for t in texts]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        out = np.empty(n.sum(), np.uint32)
        at = 0
        for x in ids:
            out[at:at + len(x)] = x
            at += len(x)
        return out, n

    def batch(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        # a space beside other white space (or at an end): encode the text whole
        odd = pc.or_(pc.match_substring_regex(texts, r"(?:^|[\pZ\x{0}-\x{20}\x{7f}-\x{a0}]) |"
                                                     r" (?:$|[\pZ\x{0}-\x{20}\x{7f}-\x{a0}])"),
                     pc.equal(texts, ""))
        odd = odd.to_numpy(zero_copy_only=False)
        whole = texts.filter(pa.array(odd))
        parts = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        words = parts.values.dictionary_encode()
        codes = words.indices.to_numpy().astype(np.int64)
        heads = parts.offsets.to_numpy()[:-1].astype(np.int64) if len(parts) else np.empty(0, np.int64)
        size = len(words.dictionary)
        is_head = np.zeros(len(codes), bool)
        is_head[heads] = True
        # the first word of a text has no space before it: those forms are encoded too
        head_codes, head_of = np.unique(codes[is_head], return_inverse=True)
        spelled = words.dictionary.to_pylist()
        ids, n = flat([" " + w for w in spelled] + [spelled[c] for c in head_codes] + whole.to_pylist())
        begin = np.concatenate([[0], np.cumsum(n)])
        codes[is_head] = size + head_of
        w_of = np.repeat(np.arange(len(parts)), np.diff(parts.offsets.to_numpy())) if len(parts) else codes
        # order of the output: texts as they came, each with its words
        row = np.flatnonzero(~odd)
        pieces = np.concatenate([codes, size + len(head_codes) + np.arange(len(whole))])
        owner = np.concatenate([row[w_of], np.flatnonzero(odd)])
        order = np.argsort(owner, kind="stable")
        pieces, owner = pieces[order], owner[order]
        lens = n[pieces]
        total = int(lens.sum())
        ends = np.cumsum(lens)
        src = np.arange(total) - np.repeat(ends - lens, lens) + np.repeat(begin[pieces], lens)
        return ids[src], np.bincount(owner, weights=lens, minlength=len(texts)).astype(np.int64)

    return batch


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids; the first may be shorter."""
    first = n % capacity or min(n, capacity)
    edges = [0, *range(first, n + 1, capacity)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """Tokenise every document and cut the ones above ``capacity``.

    One row per piece: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``).  A null
    text is empty and has the end id alone.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for big in batches:
            for at in range(0, big.num_rows, 2000):
                b = big.slice(at, 2000)
                texts = pc.fill_null(b.column(1), "").cast(pa.string())
                ids, n = encode(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts)
                rows: list[tuple] = []
                seq: list[np.ndarray] = []
                begin = 0
                for doc, k in zip(b.column(0).to_pylist(), n.tolist(), strict=True):
                    own = np.append(ids[begin:begin + k], END).astype("<u4")
                    begin += k
                    for i, (s, length) in enumerate(cut(k + 1, capacity)):
                        rows.append((doc, i, s, length, zlib.crc32(own[s:s + length].tobytes())))
                        if with_ids:
                            seq.append(own[s:s + length].astype(np.int32))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(seq, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: ``(length, lo, hi, first, copies, offset)``.

    The pieces of a length ranked ``lo`` to ``hi - 1`` go to the sequences from ``first``
    on, ``copies`` to each, from ``offset`` on.  Pieces above a third of the capacity are
    matched first, at most two to a sequence: the longest with the longest that still
    fits.  Then the smaller ones, longest first, go to the smallest gap that holds them,
    or open a sequence.  Equal pieces and equal gaps move together, so the work depends
    on the capacity alone, not on the number of pieces.
    """
    left = {k: v for k, v in counts.items() if v}
    used = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    opened = 0

    def put(length: int, first: int, n: int, copies: int, offset: int) -> None:
        if n and copies:
            rows.append((length, used[length], used[length] + n * copies, first, copies, offset))
            used[length] += n * copies
            left[length] -= n * copies

    def free(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    def fill(length: int, gap: int, first: int, n: int) -> None:
        """Fill ``n`` sequences with that gap as far as pieces of the length go."""
        k = gap // length
        full = min(n, left[length] // k)
        rest = min(left[length] - full * k, k) if full < n else 0
        put(length, first, full, k, capacity - gap)
        free(gap - k * length, first, full)
        if rest:
            put(length, first + full, 1, rest, capacity - gap)
            free(gap - rest * length, first + full, 1)
        free(gap, first + full + bool(rest), n - full - bool(rest))

    large = sorted(k for k in left if 3 * k > capacity)
    for a in reversed(large):
        for b in reversed([x for x in large if x <= min(a, capacity - a)]):
            n = left[a] // 2 if a == b else min(left[a], left[b])
            put(a, opened, n, 1, 0)
            put(b, opened, n, 1, a)
            free(capacity - a - b, opened, n)
            opened += n
        n = left[a]
        put(a, opened, n, 1, 0)
        free(capacity - a, opened, n)
        opened += n
    for s in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[s]:
            at = bisect_left(sizes, s)
            if at == len(sizes):
                n = -(-left[s] // (capacity // s))
                fill(s, capacity, opened, n)
                opened += n
                continue
            gap = sizes.pop(at)
            same = gaps.pop(gap)
            for i, (first, n) in enumerate(same):
                if not left[s]:
                    for x in same[i:]:
                        free(gap, *x)
                    break
                fill(s, gap, first, n)
    return rows


def pack(items: DataFrame, capacity: int = CAPACITY, rows_per_window: int = 100_000) -> DataFrame:
    """Give every piece its ``sequence_id`` and ``offset``.

    The driver sees the count of each length only (at most ``capacity`` numbers) and
    sends back the plan (bounded by the capacity, so it is broadcast).  A piece finds its place
    by its rank among the pieces of its length; ranks come from counts per (length,
    bucket), so a length that a third of all pieces have is spread over many windows.
    Pieces and ranks are checkpointed, so that a lost executor cannot change them.  An
    empty table gives an empty result; repeated rows are separate pieces.
    """
    spark = items.sparkSession
    p = checkpoint(items)
    counts = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(
        plan(counts, capacity),
        "length long, lo long, hi long, first long, copies long, offset0 long")
    buckets = 1 + sum(counts.values()) // rows_per_window
    p = p.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    sums = p.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    p = p.join(sums, ["length", "bucket"]).withColumn("r", F.col("base") + F.row_number().over(inside) - 1)
    got = p.join(F.broadcast(places), "length").where("r >= lo AND r < hi")
    nth = F.col("r") - F.col("lo")
    return got.withColumns({
        "sequence_id": F.col("first") + F.expr("(r - lo) div copies"),
        "offset": F.col("offset0") + (nth % F.col("copies")) * F.col("length"),
    }).drop("bucket", "base", "r", "lo", "hi", "first", "copies", "offset0")
