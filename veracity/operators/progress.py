"""Training-progress log operators.

A progress log is an append-only table with one row per logged step.  Running means and
ETA come from positions and running sums within runs (``prefix.run_totals``), so one long run is spread
over all tasks.  Early stopping depends on the order of the rows: blocks of a run become small
transition tables, which are composed in order, so no task ever holds a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.operators.prefix import run_totals
from veracity.schema import DEFAULT_PATIENCE, EARLY_STOP_MIN_DELTA

#: Rows, or blocks, of a run that are folded into one.
BLOCK = 1024


def running_progress(df: DataFrame, run: list[str], order: str, loss: str, ts: str | None = None) -> DataFrame:
    """W1 + W2: ``step`` (1-based), ``total_steps``, ``running_loss`` (cumulative mean),
    ``percent`` = 100·step/total, ``elapsed_seconds`` since the run's first row and
    ``eta_seconds`` = elapsed / max(1, step) · max(0, total − step)."""
    x = df.withColumns({"_loss": F.col(loss).cast("double"), "_known": F.col(loss).isNotNull().cast("long")})
    if ts is not None:
        x = x.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    x = run_totals(x, run, [order], ["_loss", "_known"], ["_t"] if ts is not None else [])
    step, total = F.col("_pos"), F.col("_rows")
    new = {"step": step, "total_steps": total,
           "running_loss": F.when(F.col("_cum__known") > 0, F.col("_cum__loss") / F.col("_cum__known")),
           "percent": F.when(total > 0, 100.0 * step / total)}
    if ts is not None:
        elapsed = (F.col("_t") - F.col("_min__t")) / 1e6
        new |= {"elapsed_seconds": elapsed,
                "eta_seconds": elapsed / F.greatest(F.lit(1), step) * F.greatest(F.lit(0), total - step)}
    return x.select(*[F.col(f"`{c}`") for c in df.columns if c not in new], *[v.alias(c) for c, v in new.items()])


def thin_log(df: DataFrame, every: int, step: str = "step", total: str = "total_steps") -> DataFrame:
    """Keep step 1, the last step and every ``every``-th step."""
    n = max(1, int(every))
    return df.where((F.col(step) == 1) | (F.col(step) == F.col(total)) | (F.col(step) % n == 0))


def early_stop(df: DataFrame, run: list[str], epoch: str, metric: str, mode: str = "max",
               patience: int = DEFAULT_PATIENCE, min_delta: float = EARLY_STOP_MIN_DELTA, block: int = BLOCK) -> DataFrame:
    """Per run, the best epoch (improvement must beat the best by ``min_delta``) and
    the epoch at which ``patience`` non-improving epochs stop training (else the last).

    One row per run: ``best_epoch, best_value, stop_epoch, epochs_run``.  A NULL metric never improves, but
    while there is no best value every epoch does.

    Where a run stands after a block depends on what it brings in (best value, epochs waited) only through the
    block's first improvement.  That is a record, larger than all before it in the block, and lies in the
    first ``patience`` rows, or else the run stops there.  So a block's table has at most
    ``patience`` entries: each such record with the state at the block's end if it is the first
    improvement.  Tables of ``block`` blocks at a time are composed until a run is one block."""
    near = max(1, int(patience))
    block = max(int(block), near, 2)
    sign = 1.0 if mode == "max" else -1.0
    rows = df.select(*run, F.col(epoch).cast("long").alias("_e"), (F.col(metric) * sign).cast("double").alias("_m"))
    rows = run_totals(rows, run, ["_e", "_m"])

    def state(best: Column, best_e: Column, wait: Column, stop_e: Column, n: Column) -> Column:
        return F.struct(best.alias("best"), best_e.alias("best_e"), wait.cast("long").alias("wait"),
                        stop_e.cast("long").alias("stop_e"), n.cast("long").alias("n"))

    def follow(acc: Column, x: Column) -> Column:
        """The state after one more row."""
        better = acc["best"].isNull() | F.coalesce(x["m"] > acc["best"] + F.lit(min_delta), F.lit(False))
        wait = F.when(better, F.lit(0)).otherwise(acc["wait"] + 1)
        return F.when(acc["stop_e"].isNotNull(), acc).otherwise(state(
            F.when(better, x["m"]).otherwise(acc["best"]), F.when(better, x["e"]).otherwise(acc["best_e"]), wait,
            F.when(wait >= patience, x["e"]), acc["n"] + 1))

    def entry(x: Column, i: Column) -> Column:
        """The state at the block's end if row ``i`` (from 0) is its first improvement."""
        start = state(x["m"], x["e"], F.lit(0), F.when(F.lit(patience <= 0), x["e"]), i + 1)
        rest = F.slice("_s", i + 2, F.size("_s"))
        return F.struct(x["m"].alias("m"), (i + 1).alias("at"), F.aggregate(rest, start, follow).alias("end"))

    def is_record(x: Column, i: Column) -> Column:
        top = F.array_max(F.transform(F.slice("_s", F.lit(1), i), lambda y: y["m"]))
        return (i == 0) | (x["m"].isNotNull() & (top.isNull() | (x["m"] > top)))

    seq = rows.groupBy(*run, F.floor((F.col("_pos") - 1) / block).alias("_b"), "_rows").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_pos").alias("p"), F.col("_e").alias("e"), F.col("_m").alias("m")))).alias("_s"))
    head = F.slice("_s", 1, near)
    found = F.filter(F.transform(head, lambda x, i: F.when(is_record(x, i), entry(x, i))), lambda x: x.isNotNull())
    tables = seq.select(*run, "_b", "_rows", F.struct(
        F.size("_s").cast("long").alias("len"), F.transform(head, lambda x: x["e"]).alias("epochs"),
        F.element_at("_s", -1)["e"].alias("last"), found.alias("found")).alias("t"))

    def through(acc: Column, t: Column) -> Column:
        """The state after one more block."""
        room = F.lit(patience) - acc["wait"]
        hit = F.get(F.filter(t["found"], lambda f: (acc["best"].isNull() & (f["at"] == 1)) | F.coalesce(
            (f["m"] > acc["best"] + F.lit(min_delta)) & (f["at"] <= room), F.lit(False))), F.lit(0))
        end, full = hit["end"], t["len"] >= room
        without = state(acc["best"], acc["best_e"], acc["wait"] + t["len"], F.when(
            full, F.get(t["epochs"], (room - 1).cast("int"))), acc["n"] + F.when(full, room).otherwise(t["len"]))
        onward = state(end["best"], end["best_e"], end["wait"], end["stop_e"], acc["n"] + end["n"])
        return F.when(acc["stop_e"].isNotNull(), acc).when(hit.isNotNull(), onward).otherwise(without)

    longest = rows.agg(F.max("_rows")).first()[0] or 0
    blocks = -(-longest // block)
    while blocks > 1:
        tables = tables.groupBy(*run, F.floor(F.col("_b") / block).alias("_b"), "_rows").agg(
            F.array_sort(F.collect_list(F.struct("_b", "t"))).alias("_s"))
        rest = F.slice("_s", F.lit(2), F.size("_s"))
        first = F.get("_s", F.lit(0))["t"]
        # a block behind which others follow is full, so its records are all that the joint block has near its start
        found = F.transform(first["found"], lambda f: F.struct(
            f["m"].alias("m"), f["at"].alias("at"),
            F.aggregate(rest, f["end"], lambda acc, x: through(acc, x["t"])).alias("end")))
        tables = tables.select(*run, "_b", "_rows", F.struct(
            F.aggregate("_s", F.lit(0).cast("long"), lambda n, x: n + x["t"]["len"]).alias("len"), first["epochs"].alias("epochs"),
            F.element_at("_s", -1)["t"]["last"].alias("last"), found.alias("found")).alias("t"))
        blocks = -(-blocks // block)
    end = F.get("t.found", F.lit(0))["end"]
    return tables.select(*run, end["best_e"].alias("best_epoch"), (end["best"] * sign).alias("best_value"),
                         F.coalesce(end["stop_e"], F.col("t.last")).alias("stop_epoch"), end["n"].cast("int").alias("epochs_run"))
