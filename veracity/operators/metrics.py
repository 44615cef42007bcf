"""Classification, ranking and regression metrics as aggregates.

Every metric is one aggregation over the scored table (map-side partial aggregation,
one small shuffle).  Ranking metrics group by score first and then use the distributed
running totals of ``prefix.running_totals``; nothing is collected per row.
Zero denominators give 0 (``zero_division=0``); metrics that are undefined (one class
for AUC/AP, empty input for MAE) give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.functions.text import softplus
from veracity.operators.prefix import running_totals


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def f1_from_counts(tp: Column, fp: Column, fn: Column) -> Column:
    return safe_ratio(2 * tp, 2 * tp + fp + fn)


# ----------------------------------------------------------------------------- counts


def binary_counts(df: DataFrame, y, pred) -> DataFrame:
    """One row ``(tp, fp, fn, tn, n)`` for 0/1 truth and prediction."""
    y, pred = _c(y), _c(pred)
    return df.agg(
        F.count_if((y == 1) & (pred == 1)).alias("tp"),
        F.count_if((y != 1) & (pred == 1)).alias("fp"),
        F.count_if((y == 1) & (pred != 1)).alias("fn"),
        F.count_if((y != 1) & (pred != 1)).alias("tn"),
        F.count(F.lit(1)).alias("n"),
    )


def binary_prf(df: DataFrame, y, pred) -> DataFrame:
    """G9 + G10: accuracy, precision, recall, f1 of class 1."""
    c = binary_counts(df, y, pred)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return c.select(
        "tp", "fp", "fn", "tn",
        safe_ratio(tp + tn, F.col("n")).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        f1_from_counts(tp, fp, fn).alias("f1"),
    )


def confusion(df: DataFrame, truth, pred, labels: list) -> DataFrame:
    """``(truth, pred, n)`` for every label pair in ``labels`` (zeros kept).

    Rows whose truth or prediction is outside ``labels`` are not counted."""
    counts = df.groupBy(_c(truth).alias("truth"), _c(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    lit_labels = F.array(*[F.lit(v) for v in labels])
    grid = df.sparkSession.range(1).select(F.explode(lit_labels).alias("truth")).select(
        "truth", F.explode(lit_labels).alias("pred"))
    return grid.join(counts, ["truth", "pred"], "left").select(
        "truth", "pred", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def _label_counts(df: DataFrame, truth, pred, labels: list) -> DataFrame:
    """One aggregation pass: per label tp / predicted / support, plus n."""
    t, p = _c(truth), _c(pred)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, v in enumerate(labels):
        lv = F.lit(v)
        aggs += [F.count_if((t == lv) & (p == lv)).alias(f"tp{i}"), F.count_if(p == lv).alias(f"pr{i}"),
                 F.count_if(t == lv).alias(f"su{i}")]
    return df.agg(*aggs)


def _label_struct(i: int, name) -> Column:
    tp, pr, su = F.col(f"tp{i}"), F.col(f"pr{i}"), F.col(f"su{i}")
    return F.struct(F.lit(name).alias("label"), tp.alias("tp"), pr.alias("predicted"), su.alias("support"),
                    safe_ratio(tp, pr).alias("precision"), safe_ratio(tp, su).alias("recall"),
                    safe_ratio(2 * tp, pr + su).alias("f1"))


def per_label(df: DataFrame, truth, pred, labels: list) -> DataFrame:
    """Per label: tp, predicted, support, precision, recall, f1 (one pass over ``df``)."""
    c = _label_counts(df, truth, pred, labels)
    return c.select(F.explode(F.array(*[_label_struct(i, v) for i, v in enumerate(labels)])).alias("s")).select("s.*")


def macro_f1(df: DataFrame, truth, pred, labels: list) -> DataFrame:
    """Mean F1 over the labels present in truth or prediction."""
    c = _label_counts(df, truth, pred, labels)
    f1s = [_label_struct(i, v)["f1"] for i, v in enumerate(labels)]
    present = [(F.col(f"su{i}") + F.col(f"pr{i}") > 0).cast("int") for i in range(len(labels))]
    num = sum((F.when(pr == 1, f).otherwise(0.0) for f, pr in zip(f1s, present)), F.lit(0.0))
    den = sum(present, F.lit(0))
    return c.select(F.when(den > 0, num / den).alias("macro_f1"))


def classification_report(df: DataFrame, truth, pred, labels: list, names: list[str] | None = None) -> DataFrame:
    """``(label, precision, recall, f1, support)`` per label, then ``accuracy``,
    ``macro avg`` and ``weighted avg`` over the given labels — one pass over ``df``."""
    names = names or [str(v) for v in labels]
    c = _label_counts(df, truth, pred, labels)
    k = len(labels)
    per = [_label_struct(i, n) for i, n in enumerate(names)]
    n = F.col("n")
    tp_sum = sum((F.col(f"tp{i}") for i in range(k)), F.lit(0))

    def avg(field):
        return sum((s[field] for s in per), F.lit(0.0)) / k

    def weighted(field):
        return safe_ratio(sum((s[field] * s["support"] for s in per), F.lit(0.0)), n)

    def row(label, p, r, f):
        return F.struct(F.lit(label).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        n.cast("double").alias("support"))

    rows = [F.struct(s["label"].alias("label"), s["precision"].alias("precision"), s["recall"].alias("recall"),
                     s["f1"].alias("f1"), s["support"].cast("double").alias("support")) for s in per]
    rows += [row("accuracy", F.lit(None), F.lit(None), safe_ratio(tp_sum, n)),
             row("macro avg", avg("precision"), avg("recall"), avg("f1")),
             row("weighted avg", weighted("precision"), weighted("recall"), weighted("f1"))]
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# ----------------------------------------------------------------------------- ranking


def score_histogram(df: DataFrame, y, score) -> DataFrame:
    """``(score, pos, neg)`` per distinct score (rows with NULL score/label dropped)."""
    y, score = _c(y), _c(score)
    return df.where(score.isNotNull() & y.isNotNull()).groupBy(score.alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg"))


def roc_auc(df: DataFrame, y, score) -> DataFrame:
    """G13 (Mann–Whitney, ties count ½); NULL when one class is absent."""
    h = running_totals(score_histogram(df, y, score), ["score"], ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    agg = h.agg(
        F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                             F.col("u") / (F.col("P") * F.col("N"))).alias("roc_auc"))


def average_precision(df: DataFrame, y, score) -> DataFrame:
    """Σ (R_n − R_{n−1}) · P_n over distinct scores, descending; NULL without positives."""
    h = running_totals(score_histogram(df, y, score), ["score"], ["pos", "neg"], descending=True)
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    agg = h.agg(F.sum(F.col("pos") * prec).alias("s"), F.sum("pos").alias("P"))
    return agg.select(F.when(F.col("P") > 0, F.col("s") / F.col("P")).alias("average_precision"))


# ----------------------------------------------------------------------------- regression / loss


def mae_rmse(df: DataFrame, truth, pred) -> DataFrame:
    """G15, G16 over rows where both are non-null; NULL when none."""
    t, p = _c(truth), _c(pred)
    ok = t.isNotNull() & p.isNotNull()
    return df.agg(
        F.avg(F.when(ok, F.abs(t - p))).alias("mae"),
        F.sqrt(F.avg(F.when(ok, (t - p) * (t - p)))).alias("rmse"),
        F.count_if(ok).alias("n"),
    )


def bce_with_logits(z, y, pos_weight=1.0) -> Column:
    """L1 per row: −[w·y·log σ(z) + (1−y)·log(1−σ(z))], stable."""
    z, y = _c(z), _c(y)
    w = pos_weight if isinstance(pos_weight, Column) else F.lit(float(pos_weight))
    return w * y * softplus(-z) + (F.lit(1.0) - y) * softplus(z)


def class_weight(df: DataFrame, target, lo: float = 0.25, hi: float = 20.0) -> DataFrame:
    """clip(neg / max(1, pos), lo, hi)."""
    t = _c(target)
    c = df.agg(F.count_if(t == 1).alias("pos"), F.count_if(t != 1).alias("neg"))
    return c.select("pos", "neg", F.least(F.lit(hi), F.greatest(
        F.lit(lo), F.col("neg") / F.greatest(F.lit(1), F.col("pos")))).alias("class_weight"))


def positive_weight(pos: Column, neg: Column) -> Column:
    """1.0 when there is no positive, else clip(neg / pos, 0.5, 30)."""
    return F.when(pos <= 0, F.lit(1.0)).otherwise(
        F.least(F.lit(30.0), F.greatest(F.lit(0.5), neg / pos)))
