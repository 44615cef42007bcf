"""Distributed running totals and dense row numbers.

A global running sum is never computed with an unpartitioned window (one task).
Instead:

1. range-partition on the order key and sort inside partitions,
2. cut the lineage with ``checkpoint()`` (reliable, in ``spark.checkpoint.dir``) so the
   partition boundaries seen by the next two steps are the same ones,
3. total each partition (one small row per partition, collected),
4. run the sum inside each partition (Arrow batches, sequential) starting from the
   exclusive prefix of the partition totals.

The order key must be unique (group rows by it first); ties would be ordered
arbitrarily.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.session import ensure_checkpoint_dir


def _ordered(order: list[str], descending: bool):
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def _partitioned(df: DataFrame, order: list[str], descending: bool, n_parts: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _ordered(order, descending)
    # the partition id is stored as data: a task's own partition index is not the range
    # partition any more once the result sits under a union
    return (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
            .withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True))


def running_totals(
    df: DataFrame,
    order: list[str],
    sums: list[str],
    descending: bool = False,
    prefix: str = "cum_",
    n_parts: int | None = None,
) -> DataFrame:
    """Add ``<prefix><c>`` = inclusive running sum of ``c`` in ``order`` order."""
    part = _partitioned(df, order, descending, n_parts)
    totals = part.groupBy(F.col("__pid").alias("_pid")).agg(
        *[F.sum(c).alias(c) for c in sums]).collect()
    offsets: dict[int, list] = {}
    run = [0] * len(sums)
    for r in sorted(totals, key=lambda r: r["_pid"]):
        offsets[r["_pid"]] = list(run)
        run = [a + (r[c] or 0) for a, c in zip(run, sums)]
    integral = {c: isinstance(df.schema[c].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
                for c in sums}
    fields = list(df.schema.fields) + [T.StructField("__pid", T.IntegerType())] + [
        T.StructField(prefix + c, T.LongType() if integral[c] else T.DoubleType()) for c in sums
    ]
    schema = T.StructType(fields)
    zero = [0] * len(sums)

    def scan(batches):
        acc = None
        for pdf in batches:
            if not len(pdf):
                continue
            if acc is None:
                acc = list(offsets.get(int(pdf["__pid"].iloc[0]), zero))
            for j, c in enumerate(sums):
                col = pdf[c].fillna(0)
                col = col.astype("int64") if integral[c] else col.astype("float64")
                cs = col.cumsum() + acc[j]
                pdf[prefix + c] = cs
                if len(cs):
                    acc[j] = cs.iloc[-1]
            yield pdf

    return part.mapInPandas(scan, schema).drop("__pid")


def dense_index(df: DataFrame, order: list[str], name: str = "row_key",
                n_parts: int | None = None) -> DataFrame:
    """Add ``name`` = 0..n-1 in ``order`` order (F7), without a single-task window.

    A row's place in its sorted, checkpointed partition is the count of rows before it, which is what the
    low 33 bits of Spark's increasing id are; rows never leave the JVM.  Partition sizes are one row each."""
    part = _partitioned(df, order, False, n_parts)
    sizes = {r["__pid"]: r["count"] for r in part.groupBy("__pid").count().collect()}
    starts, at = [], 0
    for pid in sorted(sizes):
        starts.append((pid, at))
        at += sizes[pid]
    first = df.sparkSession.createDataFrame(starts, "__pid int, __start long")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    out = part.withColumn("__place", place).join(F.broadcast(first), "__pid")
    return out.withColumn(name, F.col("__start") + F.col("__place")).drop("__pid", "__place", "__start")


def run_totals(df: DataFrame, run: list[str], order: list[str], sums: list[str] = (), mins: list[str] = (),
               n_parts: int | None = None) -> DataFrame:
    """Positions and running sums within runs (groups of rows) of any length, W1.

    Adds ``_pos`` (1-based, in ``order``), ``_rows`` (rows of the run), ``_cum_<c>`` (inclusive
    running sum of ``c``; NULLs count as nothing) and ``_min_<c>`` (least value of the run).  Rows are
    range-partitioned on run and order, so a long run lies in many partitions and its windows are one per
    partition and run.  Only a run at a partition's border continues in the next, so what
    is carried over, and broadcast, is at most two rows per partition.  Rows that tie in ``order`` stay
    together, in any order."""
    if not run:
        raise ValueError("run needs a column")
    part = _partitioned(df, [*run, *order], False, n_parts)
    here = Window.partitionBy("__pid", *run)
    upto = here.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = part.withColumns({
        "_pos": F.row_number().over(here.orderBy(*order)).cast("long"), "_rows": F.count(F.lit(1)).over(here),
        **{f"_cum_{c}": F.coalesce(F.sum(c).over(upto), F.lit(0)) for c in sums},
        **{f"_min_{c}": F.min(c).over(here) for c in mins}})
    blocks = part.groupBy("__pid", *run).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"_cum_{c}") for c in sums],
        *[F.min(c).alias(f"_min_{c}") for c in mins])
    whole = Window.partitionBy(*run)
    before = whole.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    border = blocks.withColumn("_blocks", F.count(F.lit(1)).over(whole)).select(
        "__pid", *run, "_blocks", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_pos"),
        F.sum("_rows").over(whole).alias("_rows"),
        *[F.coalesce(F.sum(f"_cum_{c}").over(before), F.lit(0)).alias(f"_cum_{c}") for c in sums],
        *[F.min(f"_min_{c}").over(whole).alias(f"_min_{c}") for c in mins]).where("_blocks > 1")
    a, b = rows.alias("a"), F.broadcast(border).alias("b")
    on = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in ("__pid", *run)]
    add = ["_pos", *[f"_cum_{c}" for c in sums]]
    instead = ["_rows", *[f"_min_{c}" for c in mins]]
    return a.join(b, on, "left").select(
        *[F.col(f"a.`{c}`") for c in df.columns],
        *[(F.col(f"a.`{c}`") + F.coalesce(F.col(f"b.`{c}`"), F.lit(0))).alias(c) for c in add],
        *[F.coalesce(F.col(f"b.`{c}`"), F.col(f"a.`{c}`")).alias(c) for c in instead])


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row of ``df``.

    An equi join on a constant key with the one-row side broadcast: its size is one row
    by construction."""
    return df.withColumn("_one_key", F.lit(1)).join(
        F.broadcast(one_row.withColumn("_one_key", F.lit(1))), "_one_key").drop("_one_key")
