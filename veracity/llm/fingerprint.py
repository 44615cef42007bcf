"""Document fingerprints (8): winnowing of rolling k-gram hashes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.common import let

#: Units of a text: runs of up to three characters from the start of each word on, or one
#: character of a script that has no spaces between words.
UNIT = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]|[^ \t-\r]{1,3}"
K = 4
WINDOW = 4
LAST = 0x7FFFFFFF
MAX_BLOCKS = 1 << 16


def winnow(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Selected grams of a text, in order, as longs: 31 bits of hash above 31 of ``LAST - position``.

    A gram is ``k`` units in a row (all units, if there are fewer); every ``window`` grams in
    a row (all grams, if fewer) select their smallest hash, of equal ones the rightmost:
    the later position has the smaller low bits.  So two texts that share ``window + k - 1``
    units from a word start on share a selected hash.  The minima come by doubling: of 2, 4,
    ... grams.  No unit: an empty array.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")

    def grams(u):
        def gram(x, i):
            h = F.xxhash64(x, *[F.get(u, i + j) for j in range(1, k)])
            return h.bitwiseAND(F.lit(LAST << 32)).bitwiseOR((F.lit(LAST) - i).cast("long"))
        return F.slice(F.transform(u, gram), 1, F.greatest(F.size(u) - (k - 1), F.least(F.size(u), F.lit(1))))

    def smaller(step):
        return lambda v: F.transform(v, lambda x, i: F.least(x, F.get(v, i + step)))

    def minima(h):
        m, step = h, 1
        while step < window:
            m = let(m, smaller(step))
            step *= 2
        return F.slice(m, 1, F.greatest(F.size(h) - (window - 1), F.least(F.size(h), F.lit(1))))

    return F.array_distinct(let(let(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), grams), minima))


def hashes(selected: Column) -> Column:
    """The distinct hashes of selected grams, without positions."""
    return F.array_distinct(F.transform(selected, lambda v: F.shiftright(v, 32).cast("int")))


def printed(selected: Column) -> Column:
    """``hash:position`` of each selected gram, in order."""
    return F.array_join(F.transform(selected, lambda v: F.concat(
        F.hex(F.shiftright(v, 32)), F.lit(":"), (F.lit(LAST) - v.bitwiseAND(F.lit(0xFFFFFFFF))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; two empty ones are alike, an empty and another not."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def in_blocks(docs: DataFrame, rows_per_block: int = 2000) -> DataFrame:
    """``doc_id, text`` with the ``block`` of each row, and a ``guest`` copy of the row after each block.

    Blocks are ranges of ``doc_id`` from approximate quantiles (at most MAX_BLOCKS numbers
    on the driver); the place of a row comes from a binary search in them.  The first id of a
    block is also a guest of the block before (of the first block: of the last).
    """
    ids = docs.select("doc_id")
    n = ids.count()
    blocks = 1 << max(0, math.ceil(math.log2(max(1, min(MAX_BLOCKS, n / rows_per_block)))))
    cuts = ids.approxQuantile("doc_id", [i / blocks for i in range(1, blocks)], 0.25 / blocks) if n and blocks > 1 else []
    bounds = F.array(*[F.lit(int(c)) for c in cuts]).cast("array<bigint>")
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    d = docs.select("doc_id", "text", F.lit(0).alias("block"))
    step = blocks // 2
    while step and cuts:  # the number of bounds at or below the id
        d = d.withColumn("block", F.when(key >= F.get(bounds, F.col("block") + step - 1), F.col("block") + step)
                         .otherwise(F.col("block")))
        step //= 2
    first = {r["block"]: r["id"] for r in d.groupBy("block").agg(F.min(key).alias("id")).collect()}
    order = sorted(first)
    before = dict(zip(order, [order[-1], *order[:-1]], strict=True)) if order else {}
    firsts = F.array(*[F.lit(first.get(b)) for b in range(blocks)]).cast("array<bigint>")
    befores = F.array(*[F.lit(before.get(b)) for b in range(blocks)]).cast("array<int>")
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(befores, F.col("block")).alias("block"), F.lit(True).alias("guest"))
    places = F.when(key == F.get(firsts, F.col("block")), F.array(own, guest)).otherwise(F.array(own))
    return d.withColumn("at", F.explode(places)).select("doc_id", "text", "at.block", "at.guest")


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likeness.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  The next document is the next row by ``doc_id`` (a null id first; rows
    with the same id by the hash of their text), after the last the first; of a single
    one itself.  Texts move once, to their block; within a block a window of one
    following row gives the next text and hashes.  A null text is empty and has an empty
    fingerprint.  An empty table gives an empty result; other columns are dropped.
    """
    d = in_blocks(docs).repartition("block").withColumn("text", F.coalesce("text", F.lit("")))
    d = d.withColumn("sel", winnow(F.col("text"), k, window)).withColumn("hs", hashes(F.col("sel")))
    d = d.withColumn("th", F.xxhash64("text"))
    after = Window.partitionBy("block").orderBy("guest", F.col("doc_id").asc_nulls_first(), "th")
    d = d.withColumns({"next_text": F.lead("text").over(after), "next_hs": F.lead("hs").over(after)}).where("NOT guest")
    n = F.length("text")
    half = F.expr("n_chars div 2").cast("int")
    d = d.withColumn("n_chars", n.cast("long"))
    d = d.withColumn("edited", F.concat(F.left(F.col("text"), (F.col("n_chars") - half).cast("int")),
                                        F.left(F.col("next_text"), half)))
    d = d.withColumn("esel", winnow(F.col("edited"), k, window))
    return d.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("sel")).alias("fingerprint"), printed(F.col("esel")).alias("edited_fingerprint"),
        likeness(F.col("hs"), hashes(F.col("esel"))).alias("near_edited"),
        likeness(F.col("hs"), F.col("next_hs")).alias("near_next"))
