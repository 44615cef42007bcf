"""Calibration, thresholds and rule search.

The reference evaluates every candidate against every row.  Here rows are first
collapsed into a histogram whose size does not depend on the row count (distinct
scores, or grid buckets), candidate metrics come from suffix sums over that
histogram, and the winner is one ``max_by``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracity.functions.text import sigmoid
from veracity.operators.metrics import bce_with_logits, f1_from_counts, safe_ratio
from veracity.operators.prefix import attach, running_totals
from veracity.schema import (
    DEFAULT_EMOTION_HIGH,
    EMOTION_HIGH_FLOOR,
    RULE_EXAGGERATION_DEFAULTS,
    RULE_IRONY_DEFAULTS,
    RULE_IRONY_HIGH_DEFAULTS,
    RULE_MARGINS,
)


def linspace(start: float, stop: float, num: int) -> list[float]:
    """numpy.linspace values: ``start + k*step`` with the last forced to ``stop``."""
    if num == 1:
        return [float(start)]
    step = (stop - start) / (num - 1)
    out = [k * step + start for k in range(num)]
    out[-1] = float(stop)
    return out


SUSPICION_GRID = linspace(0.02, 0.98, 193)
TOKEN_GRID = linspace(0.05, 0.95, 91)
DECILES = linspace(0.10, 0.90, 9)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------------------------- quantiles


def approximate_quantiles(df: DataFrame, col, qs: list[float], accuracy: int = 10_000) -> DataFrame:
    """G17, opt-in: ``(q, value)`` from one mergeable sketch, in one aggregate and without ranking all values.

    The value is an element whose rank is off by at most 1 / ``accuracy`` of the finite values (and
    not interpolated); NULL for every q when there is none."""
    v = _c(col).cast("double")
    finite = F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)
    sketch = df.agg(F.percentile_approx(finite, [float(q) for q in qs], accuracy).alias("v"))
    pairs = F.transform(F.array(*[F.lit(float(q)) for q in qs]), lambda q, i: F.struct(q.alias("q"), F.get("v", i).alias("value")))
    return sketch.select(F.explode(pairs).alias("p")).select("p.q", "p.value")


def quantile_values(df: DataFrame, col, qs: list[float]) -> list[float | None]:
    """Exact linear-interpolation quantiles (numpy's ``linear`` method) of the
    finite values of ``col``; ``None`` for every q when there is no value.

    Distributed: values are grouped and ranked with running totals; only the ≤ 2·len(qs)
    order statistics that are needed reach the driver."""
    v = _c(col).cast("double")
    vals = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")
                                        & (F.abs("v") != F.lit(float("inf"))))
    hist = vals.groupBy("v").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = running_totals(hist, ["v"], ["cnt"])
    n = ranked.agg(F.sum("cnt")).first()[0] or 0
    if n == 0:
        return [None for _ in qs]
    needed = set()
    for q in qs:
        h = (n - 1) * q
        needed.update({int(math.floor(h)), min(int(math.floor(h)) + 1, n - 1)})
    lo_col = F.col("cum_cnt") - F.col("cnt")
    hit = F.lit(False)
    for idx in needed:
        hit = hit | ((lo_col <= idx) & (F.col("cum_cnt") > idx))
    rows = ranked.where(hit).select("v", lo_col.alias("a"), F.col("cum_cnt").alias("b")).collect()

    def at(idx):
        for r in rows:
            if r["a"] <= idx < r["b"]:
                return r["v"]
        raise AssertionError(idx)

    out = []
    for q in qs:
        h = (n - 1) * q
        i = int(math.floor(h))
        lo, hi = at(i), at(min(i + 1, n - 1))
        t = h - i
        diff = hi - lo
        out.append(hi - diff * (1 - t) if t >= 0.5 else lo + diff * t)
    return out


def quantiles(df: DataFrame, col, qs: list[float], name: str = "value") -> DataFrame:
    """``(q, value)`` rows for ``quantile_values``."""
    vals = quantile_values(df, col, qs)
    return df.sparkSession.createDataFrame([(float(q), v) for q, v in zip(qs, vals)], f"q double, {name} double")


# ----------------------------------------------------------------------------- C3


def choose_suspicion_threshold(df: DataFrame, y, p, target_recall: float = 0.95) -> DataFrame:
    """candidates = 193-point grid ∪ observed scores; prediction ``p >= t``.

    Among candidates with recall ≥ target (all if none) the maximum of
    (f1, precision, threshold).  One row: threshold, recall, precision, f1,
    target_recall_satisfied (1.0 / 0.0)."""
    y, p = _c(y), _c(p)
    spark = df.sparkSession
    scored = df.where(p.isNotNull()).groupBy(p.cast("double").alias("t")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg"))
    grid = spark.range(1).select(F.explode(F.array(*[F.lit(g) for g in SUSPICION_GRID])).alias("t"),
                                 F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"))
    cand = scored.unionByName(grid).groupBy("t").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    cum = running_totals(cand, ["t"], ["pos", "neg"], descending=True)
    total = df.agg(F.count_if(y == 1).alias("P"))
    m = attach(cum, total)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    m = m.select(
        F.col("t").alias("threshold"),
        safe_ratio(tp, F.col("P")).alias("recall"),
        safe_ratio(tp, tp + fp).alias("precision"),
        f1_from_counts(tp, fp, F.col("P") - tp).alias("f1"),
    )
    eligible = F.col("recall") >= F.lit(float(target_recall))
    best = m.agg(
        F.max_by(F.struct("threshold", "recall", "precision", "f1"),
                 F.struct(eligible.cast("int"), "f1", "precision", "threshold")).alias("b"),
        F.max(eligible.cast("double")).alias("target_recall_satisfied"),
    )
    return best.select("b.*", "target_recall_satisfied")


# ----------------------------------------------------------------------------- C4


def grid_bucket(p: Column, grid: list[float]) -> Column:
    """Number of grid values ``<= p`` (so ``p >= grid[k]`` ⟺ bucket > k).

    O(1) per row for an evenly spaced ascending grid: an arithmetic estimate, then one
    correction step each way against the exact grid values."""
    n = len(grid)
    arr = F.array(*[F.lit(float(g)) for g in grid])
    if n == 1:
        return F.when(p >= arr[0], 1).otherwise(0)
    start, step = grid[0], (grid[-1] - grid[0]) / (n - 1)
    est = F.least(F.lit(n), F.greatest(F.lit(0), (F.floor((p - start) / step) + 1).cast("int")))
    # grid[est] (0-based) must be > p and grid[est-1] <= p
    up = F.when((est < n) & (F.element_at(arr, F.least(est + 1, F.lit(n))) <= p), est + 1).otherwise(est)
    down = F.when((up > 0) & (F.element_at(arr, F.greatest(up, F.lit(1))) > p), up - 1).otherwise(up)
    return F.when(p.isNull(), F.lit(0)).otherwise(down)


def choose_token_threshold(df: DataFrame, target, p) -> DataFrame:
    """C4: 91-point grid, truth = target ≥ 0.5; max (f1, recall); ties → lowest threshold.

    Empty input → threshold 0.5, f1 NULL."""
    t, p = _c(target), _c(p)
    spark = df.sparkSession
    cells = df.select((t >= 0.5).cast("int").alias("y"), grid_bucket(p, TOKEN_GRID).alias("b")).groupBy(
        "b").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    k = spark.range(1).select(F.posexplode(F.array(*[F.lit(g) for g in TOKEN_GRID])).alias("k", "threshold"))
    # tp(k) = positives with bucket > k: suffix sums over the (≤ 92-row) bucket table
    dense = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(len(TOKEN_GRID)))).alias("b")).join(
        cells, "b", "left").select("b", F.coalesce("pos", F.lit(0)).alias("pos"),
                                   F.coalesce("neg", F.lit(0)).alias("neg"))
    w = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    suffix = dense.select((F.col("b") - 1).alias("k"), F.sum("pos").over(w).alias("tp"),
                          F.sum("neg").over(w).alias("fp"))
    j = k.join(suffix, "k")
    tot = cells.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("P"), F.coalesce(F.sum("neg"), F.lit(0)).alias("N"))
    m = attach(j, tot).select(
        "k", "threshold", "P", "N",
        f1_from_counts(F.col("tp"), F.col("fp"), F.col("P") - F.col("tp")).alias("f1"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("P")).alias("recall"),
    )
    best = m.agg(F.max_by(F.struct("threshold", "f1", "precision", "recall"),
                          F.struct("f1", "recall", -F.col("k"))).alias("b"),
                 F.max(F.col("P") + F.col("N")).alias("n"))
    return best.select(
        F.when(F.col("n") > 0, F.col("b.threshold")).otherwise(F.lit(0.5)).alias("threshold"),
        F.when(F.col("n") > 0, F.col("b.f1")).alias("f1"),
        F.when(F.col("n") > 0, F.col("b.precision")).alias("precision"),
        F.when(F.col("n") > 0, F.col("b.recall")).alias("recall"),
    )


# ----------------------------------------------------------------------------- C5 / C7


def candidate_threshold_values(df: DataFrame, col, defaults: list[float]) -> list[float]:
    """Defaults ∪ deciles of the finite values, clipped to [0,1], distinct, sorted."""
    qs = [q for q in quantile_values(df, col, DECILES) if q is not None]
    return sorted({min(1.0, max(0.0, float(v))) for v in [*defaults, *qs]})


def candidate_thresholds(df: DataFrame, col, defaults: list[float]) -> DataFrame:
    """``(k, threshold)`` rows of ``candidate_threshold_values``."""
    vals = candidate_threshold_values(df, col, defaults)
    return df.sparkSession.createDataFrame(list(enumerate(vals)), "k int, threshold double")


def emotion_high_value(df: DataFrame, e) -> float:
    """max(0.05, q75(e)); 0.15 when there is no value."""
    q = quantile_values(df, e, [0.75])[0]
    return DEFAULT_EMOTION_HIGH if q is None else max(EMOTION_HIGH_FLOOR, q)


# ----------------------------------------------------------------------------- C6


def _lit_array(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def tune_stage2_rule(df: DataFrame, e="emotion_index", x="exaggeration_index", i="irony_index",
                     y="stage2_label") -> DataFrame:
    """Grid search of the stage-2 rule without evaluating rules row by row.

    Candidate lists are small (defaults ∪ deciles, ≤ 15 values each).  Rows collapse
    to cells ``(bx, bi, bh, bm, y)``: how many exaggeration / irony / high candidates
    each value reaches and how many margins the dominance test passes (monotone in the
    margin).  A 4-D suffix sum over the dense cell cube gives, for every rule, the rows
    predicted satire by inclusion–exclusion of the joint and dominant conditions; rules
    join the cube on equal keys.  Winner: max (macro_f1, satire_recall, accuracy),
    ties → first in loop order.  One row: the rule, its metrics and the emotion-high
    threshold.
    """
    spark = df.sparkSession
    base = df.select(_c(e).alias("e"), _c(x).alias("x"), _c(i).alias("i"),
                     _c(y).cast("int").alias("y")).persist()
    xs = candidate_threshold_values(base, "x", RULE_EXAGGERATION_DEFAULTS)
    is_ = candidate_threshold_values(base, "i", RULE_IRONY_DEFAULTS)
    hs = candidate_threshold_values(base, "i", RULE_IRONY_HIGH_DEFAULTS)
    emotion_high = emotion_high_value(base, "e")
    margins = _lit_array(RULE_MARGINS)

    def reach(v: str, cands: list[float]) -> Column:
        return F.size(F.filter(_lit_array(cands), lambda g: F.col(v) >= g))

    cells = base.select(
        reach("x", xs).alias("bx"), reach("i", is_).alias("bi"), reach("i", hs).alias("bh"),
        F.size(F.filter(margins, lambda m: (F.col("i") >= F.col("e") + m)
                        & (F.col("i") >= F.col("x") + m))).alias("bm"),
        "y",
    ).groupBy("bx", "bi", "bh", "bm", "y").agg(F.count(F.lit(1)).alias("n"))

    def seq(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n)))

    cube = (spark.range(1).select(seq(len(xs)).alias("bx"))
            .select("*", seq(len(is_)).alias("bi"))
            .select("*", seq(len(hs)).alias("bh"))
            .select("*", seq(len(RULE_MARGINS)).alias("bm"))
            .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("y")))
    dense = cube.join(cells, ["bx", "bi", "bh", "bm", "y"], "left").select(
        "bx", "bi", "bh", "bm", "y", F.coalesce("n", F.lit(0)).cast("long").alias("s"))
    dims = ["bx", "bi", "bh", "bm"]
    for d in dims:  # suffix sums along each dimension of the bounded cube
        others = [o for o in dims if o != d] + ["y"]
        w = Window.partitionBy(*others).orderBy(F.col(d).desc()).rowsBetween(Window.unboundedPreceding, 0)
        dense = dense.withColumn("s", F.sum("s").over(w))
    suffix = dense.groupBy(*dims).agg(F.sum(F.when(F.col("y") == 1, F.col("s"))).alias("s1"),
                                      F.sum(F.when(F.col("y") == 0, F.col("s"))).alias("s0"))

    rules = (spark.range(1)
             .select(F.posexplode(_lit_array(xs)).alias("kx", "exaggeration_threshold"))
             .select("*", F.posexplode(_lit_array(is_)).alias("ki", "irony_threshold"))
             .select("*", F.posexplode(_lit_array(hs)).alias("kh", "irony_high_threshold"))
             .where(F.col("irony_high_threshold") >= F.col("irony_threshold"))
             .select("*", F.posexplode(margins).alias("km", "irony_dominance_margin")))

    zero = F.lit(0)
    r = rules
    for tag, keys in (("A", (F.col("kx") + 1, F.col("ki") + 1, zero, zero)),
                      ("B", (zero, zero, F.col("kh") + 1, F.col("km") + 1)),
                      ("C", (F.col("kx") + 1, F.col("ki") + 1, F.col("kh") + 1, F.col("km") + 1)),
                      ("T", (zero, zero, zero, zero))):
        s = suffix.select(*[F.col(d).alias(f"{tag}{d}") for d in dims],
                          F.col("s1").alias(f"{tag}1"), F.col("s0").alias(f"{tag}0"))
        cond = None
        for d, k in zip(dims, keys):
            c = F.col(f"{tag}{d}") == k
            cond = c if cond is None else cond & c
        r = r.join(s, cond, "inner")
    tp = F.col("A1") + F.col("B1") - F.col("C1")
    fp = F.col("A0") + F.col("B0") - F.col("C0")
    P, N = F.col("T1"), F.col("T0")
    fn, tn = P - tp, N - fp
    f1_1 = f1_from_counts(tp, fp, fn)
    f1_0 = f1_from_counts(tn, fn, fp)
    present1 = (P > 0) | (tp + fp > 0)
    present0 = (N > 0) | (tn + fn > 0)
    n_present = present1.cast("int") + present0.cast("int")
    macro = F.when(n_present > 0, (F.when(present1, f1_1).otherwise(0.0) + F.when(present0, f1_0).otherwise(0.0))
                   / n_present).otherwise(F.lit(0.0))
    order = F.col("kx") * 1000000 + F.col("ki") * 10000 + F.col("kh") * 100 + F.col("km")
    scored = r.select(
        "exaggeration_threshold", "irony_threshold", "irony_high_threshold", "irony_dominance_margin",
        macro.alias("macro_f1"), safe_ratio(tp, P).alias("satire_recall"),
        safe_ratio(tp + tn, P + N).alias("accuracy"),
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"), order.alias("ord"))
    best = scored.agg(F.max_by(F.struct(*[c for c in scored.columns if c != "ord"]),
                               F.struct("macro_f1", "satire_recall", "accuracy", -F.col("ord"))).alias("b"))
    return best.select("b.*", F.lit(float(emotion_high)).alias("emotion_high_threshold"))


# ----------------------------------------------------------------------------- C1 / C2


def apply_temperature(z, temperature: float | Column) -> Column:
    """σ(z / T)."""
    return sigmoid(z, temperature)


def fit_temperature(df: DataFrame, z, y, lo: float = 0.05, hi: float = 20.0, rounds: int = 8,
                    per_round: int = 33) -> DataFrame:
    """T in [lo, hi] minimising mean BCE(z/T, y).

    The loss is convex in 1/T, so a bracket on log T narrows by evaluating
    ``per_round`` candidates in one aggregate per round over the cached (z, y) pairs.
    Returns ``(temperature, loss)``."""
    zy = df.select(_c(z).cast("double").alias("z"), _c(y).cast("double").alias("y")).where(
        F.col("z").isNotNull() & F.col("y").isNotNull()).persist()
    a, b = math.log(lo), math.log(hi)
    best_t, best_loss = 1.0, float("nan")
    for _ in range(rounds):
        ts = [math.exp(a + (b - a) * k / (per_round - 1)) for k in range(per_round)]
        row = zy.agg(*[F.avg(bce_with_logits(F.col("z") / F.lit(t), F.col("y"))).alias(f"l{k}")
                       for k, t in enumerate(ts)]).first()
        losses = [row[f"l{k}"] for k in range(per_round)]
        if losses[0] is None:
            break
        k = min(range(per_round), key=lambda j: losses[j])
        best_t, best_loss = ts[k], losses[k]
        a, b = math.log(ts[max(0, k - 1)]), math.log(ts[min(per_round - 1, k + 1)])
    zy.unpersist()
    return df.sparkSession.createDataFrame([(float(best_t), best_loss)], "temperature double, loss double")
