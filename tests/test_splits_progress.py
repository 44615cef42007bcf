from pyspark.sql import functions as F

from veracity.operators import progress as P
from veracity.operators import splits as S
from veracity.operators.prefix import dense_index


def test_group_split_invariants(spark):
    rows = [(k, f"g{k % 13}" if k % 5 else None, ["real", "fake", "satire"][k % 3]) for k in range(300)]
    df = spark.createDataFrame(rows, "row_key long, group_id string, label_norm string")
    a = S.group_split(df, "group_id", "row_key").collect()
    b = S.group_split(df, "group_id", "row_key").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))  # deterministic
    assert len(a) == 300  # complete
    by_group = {}
    for r in a:
        g = r["group_id"] or f"__single_{r['row_key']}"
        by_group.setdefault(g, set()).add(r["split"])
    assert all(len(s) == 1 for s in by_group.values())  # group-pure


def test_stratified_sizes(spark):
    rows = [(k, ["real", "fake", "satire"][k % 3]) for k in range(200)]
    df = spark.createDataFrame(rows, "row_key long, label_norm string")
    out = S.stratified_split(df, "label_norm", "row_key")
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts["test"] == 30  # ceil(0.15 * 200)
    assert sum(counts.values()) == 200


def test_dense_index_under_union(spark):
    a = dense_index(spark.range(50).withColumn("o", F.col("id") * 7 % 50), ["o"], "rk")
    b = dense_index(spark.range(30).withColumn("o", F.col("id")), ["o"], "rk")
    u = a.select("rk").unionByName(b.select("rk"))
    assert sorted(r[0] for r in u.collect()) == sorted(list(range(50)) + list(range(30)))


def test_early_stop(spark):
    rows = [("r", 1, 0.50), ("r", 2, 0.5000005), ("r", 3, 0.4), ("r", 4, 0.41), ("r", 5, 0.40), ("r", 6, 0.9),
            ("s", 1, 0.1), ("s", 2, 0.2)]
    df = spark.createDataFrame(rows, "run string, epoch int, ap double")
    got = {r["run"]: (r["best_epoch"], r["stop_epoch"]) for r in P.early_stop(df, ["run"], "epoch", "ap", "max", 2).collect()}
    # r: epoch 2 does not beat 0.5 by 1e-6, epoch 3 neither → patience 2 reached at epoch 3
    assert got["r"] == (1, 3)
    assert got["s"] == (2, 2)


def test_dense_index_of_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("o"), F.repeat(F.lit("x"), 50).alias("wide")).repartition(9)
    for parts in (1, 3, 64):
        k = dense_index(df, ["o"], "rk", parts)
        assert k.columns == ["o", "wide", "rk"] and k.where("rk != o").count() == 0 and k.count() == 5000
        assert k.coalesce(1).where("rk % 2 = 0").agg(F.count_distinct("rk")).first()[0] == 2500
    assert dense_index(df.limit(0), ["o"]).count() == 0


def fold_epochs(rows, patience, delta):
    """Row by row, what early stopping does: ``(best_epoch, best_value, stop_epoch, epochs_run)``."""
    best = best_e = None
    wait = n = 0
    for e, m in rows:
        n += 1
        if best is None or (m is not None and m > best + delta):
            best, best_e, wait = m, e, 0
        else:
            wait += 1
        if wait >= patience:
            break
    return best_e, best, e, n


def test_early_stop_in_blocks_is_the_fold(spark):
    """Runs of many blocks and several levels of them, against the fold over the rows."""
    import random
    rng = random.Random(5)
    runs = {}
    for i in range(60):
        n = rng.choice((1, 2, 3, 5, 8, 30, 150))
        drift = rng.choice((0.0, 0.05, 0.3))
        runs[f"r{i}"] = [(e, None if rng.random() < 0.1 else round(e * drift + rng.choice((0.0, 0.1, 0.2, rng.random())), 3))
                         for e in range(1, n + 1)]
    runs[None] = [(1, None), (2, None), (3, 0.5), (4, 0.4)]
    runs["up"] = [(e, float(e)) for e in range(1, 400)]
    rows = [(r, e, m) for r, x in runs.items() for e, m in x]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run string, epoch int, ap double").repartition(7)
    for patience, block in ((1, 1), (2, 3), (4, 4), (3, 1000), (0, 2)):
        got = {r["run"]: tuple(r)[1:] for r in P.early_stop(df, ["run"], "epoch", "ap", "max", patience, 0.05, block).collect()}
        assert got == {r: fold_epochs(x, patience, 0.05) for r, x in runs.items()}, (patience, block)
    low = df.withColumn("ap", -F.col("ap"))
    got = {r["run"]: tuple(r)[1:] for r in P.early_stop(low, ["run"], "epoch", "ap", "min", 3, 0.05, 4).collect()}
    assert {r: (a, None if b is None else -b, c, d) for r, (a, b, c, d) in got.items()} == {
        r: fold_epochs(x, 3, 0.05) for r, x in runs.items()}
    assert P.early_stop(df.limit(0), ["run"], "epoch", "ap").count() == 0


def test_running_progress_of_a_run_over_many_partitions(spark):
    """One run holds most rows, so it lies in many partitions; others end and begin inside them."""
    rows = [("long", i, None if i % 7 == 3 else float(i % 11)) for i in range(3000)]
    rows += [(f"s{r}", i, float(r + i)) for r in range(40) for i in range(r % 5 + 1)] + [(None, i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "run string, i int, loss double").repartition(5).withColumn(
        "ts", F.timestamp_seconds(F.col("i") * 2 + 10))
    got = {(r["run"], r["i"]): r for r in P.running_progress(df, ["run"], "i", "loss", "ts").collect()}
    assert len(got) == len(rows)
    size = {}
    for r, _, _ in rows:
        size[r] = size.get(r, 0) + 1
    known = {}
    for r, i, loss in rows:
        known.setdefault(r, [])
        if loss is not None:
            known[r].append(loss)
        x, mean = got[r, i], sum(known[r]) / len(known[r]) if known[r] else None
        assert (x["step"], x["total_steps"]) == (i + 1, size[r])
        assert (x["running_loss"] is None) == (mean is None) and abs((x["running_loss"] or 0) - (mean or 0)) < 1e-9
        assert x["elapsed_seconds"] == 2.0 * i and abs(x["eta_seconds"] - 2.0 * i / (i + 1) * (size[r] - i - 1)) < 1e-9
    assert P.running_progress(df.limit(0), ["run"], "i", "loss").count() == 0


def test_second_split_is_plain_if_the_rest_has_a_class_of_one_row(spark):
    from veracity.operators import splits as S
    rows = [(i, "a") for i in range(20)] + [(20, "b"), (21, "b")]
    out = S.stratified_split(spark.createDataFrame(rows, "k long, l string"), "l", "k", 0.5, 0.25).collect()
    sizes = {s: sum(r["split"] == s for r in out) for s in ("train", "validation", "test")}
    assert sizes == {"test": 11, "validation": 6, "train": 5} and len({r["k"] for r in out}) == 22


def test_irony_loss_without_a_scored_row(spark):
    import pytest

    from veracity.operators import losses as L
    docs = spark.createDataFrame([(1, 0.5, None), (2, 1.0, 0.25)], "k long, z double, y double")
    tokens = spark.createDataFrame([(1, 0, 0, 1, 1.0, 0.5)], "k long, chunk_idx int, start int, end int, t double, s double")
    assert L.irony_loss(docs, tokens, "k", "z", "y", "t", "s").first()["n"] == 1
    with pytest.raises(Exception, match="no row with y"):
        L.irony_loss(docs.where("y IS NULL"), tokens, "k", "z", "y", "t", "s").collect()
