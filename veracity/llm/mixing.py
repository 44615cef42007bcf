"""Mixing sources to target weights (5): a golden-ratio schedule over shuffled blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.common import checkpoint, word_count

#: Points of the schedule are integers below this; STEP / SPAN is 1 / golden ratio.
SPAN = 1 << 31
STEP = 1327217885
#: Cells of the point range, for an equi-join of points to source intervals.
CELLS = 4096


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Per source: rank, ``source_size``, ``weight`` and ``target``.

    Sources by code point, null last, take the weights in turn and share all words.
    ``target = min(cap * source_size, weight * level)``, where ``level`` makes the targets
    add up to all words: that is where resharing the excess of capped sources ends.
    Sorted by ``source_size / weight``, the capped sources come first, so running sums
    give the level.  The windows hold one row per source.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    w_all = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("rank", F.row_number().over(w_all))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(x) for x in weights]),
                                            F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1))
    by = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    s = s.withColumns({
        "_before": F.coalesce(F.sum("source_size").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_rest": F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing)),
        "_all": F.sum("source_size").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    level = (F.col("_all") - cap * F.col("_before")) / F.col("_rest")
    free = cap * F.col("source_size") > F.col("weight") * level
    s = s.withColumn("_level", F.first(F.when(free, level), ignorenulls=True).over(
        by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least((cap * F.col("source_size")).cast("double"), F.col("weight") * F.coalesce("_level", F.lit(0.0)))
    return s.select("source", "rank", "source_size", "weight", target.alias("target"))


def blocks(tgt: DataFrame, block_words: int = 1024, min_blocks: int = 256) -> DataFrame:
    """``targets`` with the block length, number of blocks and interval of points per source.

    Blocks of a source are equally long (the last may be shorter): ``block_words``, or
    less for a small source, so that it has at least ``min_blocks`` blocks and the
    schedule meets its target closely.  The interval of a source is its share of slots.
    """
    length = F.greatest(F.lit(1), F.least(F.lit(block_words), F.expr(f"source_size div {min_blocks}"))).cast("long")
    b = tgt.where("source_size > 0").withColumn("block_len", length)
    b = b.withColumn("n_blocks", F.expr("(source_size + block_len - 1) div block_len"))
    b = b.withColumn("_slots", F.col("target") * F.col("n_blocks") / F.col("source_size"))
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    b = b.withColumns({"_upto": F.sum("_slots").over(upto), "_total": F.sum("_slots").over(every)})
    hi = F.when(F.col("rank") == F.max("rank").over(every), F.lit(SPAN)).otherwise(
        F.floor(F.col("_upto") / F.col("_total") * SPAN)).cast("long")
    b = b.withColumn("hi", hi)
    return b.withColumns({
        "lo": F.coalesce(F.lag("hi").over(Window.orderBy("rank")), F.lit(0).cast("long")),
        "n_slots": F.ceil("_total").cast("long"),
    }).drop("_slots", "_upto", "_total")


def schedule(spec: DataFrame, cap: int = 3) -> DataFrame:
    """One row per slot: ``slot, rank, n, block, epoch``.

    Slot ``k`` has the point ``frac(k / golden ratio)`` and goes to the source whose
    interval holds it; the ``n``-th slot of a source takes its block ``n mod n_blocks``.  Points meet intervals by an
    equi-join on a cell of the point range; ``n`` comes from counts per run of 65,536
    slots, so no window holds more than that or one row per run.  A slot beyond ``cap``
    epochs stays empty.
    """
    spark = spec.sparkSession
    n_slots = spec.agg(F.max("n_slots")).first()[0] or 0
    width = SPAN // CELLS
    cells = spec.where("hi > lo").withColumn(
        "cell", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))))
    slots = spark.range(n_slots).select(
        F.col("id").alias("slot"), F.shiftright("id", 16).alias("run"),
        F.pmod(F.pmod("id", F.lit(SPAN)) * F.lit(STEP), F.lit(SPAN)).alias("point"))
    slots = slots.withColumn("cell", F.expr(f"point div {width}"))
    put = slots.join(cells.select("cell", "lo", "hi", "rank", "n_blocks"), "cell").where("point >= lo AND point < hi")
    put = put.select("slot", "run", "rank", "n_blocks")
    counts = put.groupBy("rank", "run").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("rank").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("rank", "run", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("rank", "run").orderBy("slot")
    n = F.col("base") + F.row_number().over(inside) - 1
    put = put.join(counts, ["rank", "run"]).withColumn("n", n)
    return put.where(F.col("n") < cap * F.col("n_blocks")).select(
        "slot", "rank", "n", F.expr("n % n_blocks").alias("block"), F.expr("n div n_blocks").alias("epoch"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, block_words: int = 1024,
        min_blocks: int = 256, seed: int = 42) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken``.

    The documents of a source, shuffled by md5 of seed and id, lie end to end on a line
    of words that is cut into blocks; ``taken`` adds up how often the schedule takes the
    blocks a document lies in, times the words of it inside them.  Positions come from
    sums per (source, 16-bit prefix of the md5), so a hot source is spread over 65,536
    windows; texts are read once and never shuffled.  A null source is a source of its
    own, last; texts without words take nothing; repeated rows are separate documents;
    an empty table gives an empty result; the same input always gives the same mix.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    d = checkpoint(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key")))
    tgt = checkpoint(targets(d, weights, cap))
    spec = checkpoint(blocks(tgt, block_words, min_blocks))
    times = schedule(spec, cap).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))

    d = d.join(tgt.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    d = d.withColumn("bucket", F.substring("key", 1, 4))
    sums = d.groupBy("rank", "bucket").agg(F.sum("size").alias("c"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    d = d.join(sums, ["rank", "bucket"]).withColumn("start", F.col("base") + F.sum("size").over(inside) - F.col("size"))

    out = ["doc_id", "source", "size", "source_size", "target"]
    pieces = d.where("size > 0").join(spec.select("rank", "block_len"), "rank")
    pieces = pieces.withColumn("block", F.explode(F.sequence(
        F.expr("start div block_len"), F.expr("(start + size - 1) div block_len"))))
    overlap = (F.least(F.expr("start + size"), F.expr("(block + 1) * block_len"))
               - F.greatest(F.col("start"), F.expr("block * block_len")))
    pieces = pieces.join(times, ["rank", "block"], "left").withColumn(
        "w", overlap * F.coalesce("times", F.lit(0)))
    taken = pieces.groupBy(*out, "rank", "start").agg(F.sum("w").alias("taken")).select(*out, "taken")
    return taken.unionByName(d.where("size = 0").select(*out, F.lit(0).cast("long").alias("taken")))
