"""Mergeable pooling, one-pass validation and the quantile sketch against brute force."""

import math
import random

from pyspark.sql import functions as F

from veracity.operators import clean as K
from veracity.operators import pooling as PL
from veracity.operators import tuning as C


def test_softmax_pool(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        g = rng.choice(["a", "b", "c", None])
        vec = None if i % 50 == 0 else [rng.uniform(-1, 1) for _ in range(3 - (i % 9 == 0))]
        score = None if i % 40 == 1 else rng.choice([rng.uniform(-5, 5), 700.0 if g == "b" else -900.0])
        rows.append((g, rng.randint(0, 2), score, vec, None if i % 30 == 2 else (g != "c" and rng.random() < 0.5)))
    df = spark.createDataFrame(rows, "g string, h int, s double, v array<float>, m boolean").repartition(5)
    for mask in ("m", None):
        got = {(r["g"], r["h"], r["dim"]): r["value"] for r in PL.softmax_pool(df, ["g", "h"], "s", "v", mask).collect()}
        want = {}
        for key in {r[:2] for r in rows}:
            own = [r for r in rows if r[:2] == key and r[2] is not None]
            use = [r for r in own if mask is None or r[4]] or own
            top = max(r[2] for r in use)
            z = sum(math.exp(r[2] - top) for r in use)
            for d in range(max(len(r[3] or []) for r in use)):
                want[(*key, d)] = sum(math.exp(r[2] - top) / z * (r[3][d] if r[3] and d < len(r[3]) else 0.0) for r in use)
        assert set(want) <= set(got) and all(abs(got[k] - want.get(k, 0.0)) < 1e-6 for k in got)
    assert PL.softmax_pool(df.where("false"), ["g"], "s", "v").count() == 0


def test_softmax_weights(spark):
    rows = [("a", 1.0, True), ("a", 3.0, False), ("a", 2.0, True), ("b", 1.0, False), ("b", 1.0, None)]
    df = spark.createDataFrame(rows, "g string, s double, m boolean")
    got = sorted((r["g"], r["s"], round(r["weight"], 6)) for r in PL.softmax_weights(df, ["g"], "s", "m").collect())
    e = math.exp(1)
    assert got == [("a", 1.0, round(1 / (1 + e), 6)), ("a", 2.0, round(e / (1 + e), 6)), ("a", 3.0, 0.0), ("b", 1.0, 0.5), ("b", 1.0, 0.5)]


def test_validate_reads_the_table_once(spark):
    df = spark.range(0, 5000, 1, 7).withColumn("x", F.when(F.col("id") % 3 == 0, F.col("id")))
    rules = {"third": F.col("x").isNotNull(), "none": F.col("id") < 0, "unknown": F.col("x") > 4990, "few": F.col("id").isin(9, 4000)}
    out = K.validate(df, rules, "id", 4)
    got = {r["rule"]: (r["bad_rows"], r["sample"]) for r in out.collect()}
    assert got == {"third": (1667, "0,3,6,9"), "none": (0, ""), "unknown": (3, "4992,4995,4998"), "few": (2, "9,4000")}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 5000") == 1


def test_quantile_sketch(spark):
    n = 20_000
    df = spark.range(n).select(F.when(F.col("id") % 100 == 7, float("nan")).otherwise((F.col("id") * 7919) % n).cast("double").alias("v"))
    values = sorted(float((i * 7919) % n) for i in range(n) if i % 100 != 7)
    for r in C.approximate_quantiles(df, "v", [0.0, 0.1, 0.5, 0.99, 1.0], 1000).collect():
        assert abs((values.index(r["value"]) + 1) / len(values) - r["q"]) <= 0.001 + 1 / len(values)
    assert [r["value"] for r in C.approximate_quantiles(df.where("false"), "v", [0.5]).collect()] == [None]
