import numpy as np

from veracity.operators import tuning as C


def _f1(tp, fp, fn):
    return 2 * tp / (2 * tp + fp + fn) if (2 * tp + fp + fn) else 0.0


def test_quantiles_match_numpy(spark):
    vals = [0.3, 0.1, 0.1, 0.7, 0.25, 0.9, 0.5, 0.5, 0.5, 0.05, 0.33]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = C.quantile_values(df, "v", C.DECILES + [0.75])
    want = np.quantile(np.array(vals), C.DECILES + [0.75])
    assert np.allclose(got, want, rtol=0, atol=1e-15)


def test_suspicion_threshold_brute_force(spark):
    rng = np.random.default_rng(1)
    p = np.round(rng.random(60), 2)
    y = (rng.random(60) < p).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    got = C.choose_suspicion_threshold(df, "y", "p", 0.9).first()
    rows = []
    for t in sorted(set(C.SUSPICION_GRID) | set(p.tolist())):
        pr = p >= t
        tp, fp, fn = int((pr & (y == 1)).sum()), int((pr & (y == 0)).sum()), int((~pr & (y == 1)).sum())
        rows.append((t, tp / max(1, tp + fn), tp / (tp + fp) if tp + fp else 0.0, _f1(tp, fp, fn)))
    elig = [r for r in rows if r[1] >= 0.9] or rows
    best = max(elig, key=lambda r: (r[3], r[2], r[0]))
    assert abs(got["threshold"] - best[0]) < 1e-12 and abs(got["f1"] - best[3]) < 1e-12


def test_token_threshold_ties_lowest(spark):
    df = spark.createDataFrame([(1.0, 0.99), (0.0, 0.01)], "t double, p double")
    got = C.choose_token_threshold(df, "t", "p").first()
    assert abs(got["threshold"] - 0.05) < 1e-12 and got["f1"] == 1.0
    empty = spark.createDataFrame([], "t double, p double")
    e = C.choose_token_threshold(empty, "t", "p").first()
    assert e["threshold"] == 0.5 and e["f1"] is None


def test_rule_search_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 80
    e, x, i = (np.round(rng.random(n), 2) for _ in range(3))
    y = ((x > 0.4) & (i > 0.5) | (rng.random(n) < 0.1)).astype(int)
    df = spark.createDataFrame([(float(a), float(b), float(c), int(d)) for a, b, c, d in zip(e, x, i, y)],
                               "emotion_index double, exaggeration_index double, irony_index double, stage2_label int")
    got = C.tune_stage2_rule(df).first()
    xs = C.candidate_threshold_values(df, "exaggeration_index", C.RULE_EXAGGERATION_DEFAULTS)
    is_ = C.candidate_threshold_values(df, "irony_index", C.RULE_IRONY_DEFAULTS)
    hs = C.candidate_threshold_values(df, "irony_index", C.RULE_IRONY_HIGH_DEFAULTS)
    best, key0 = None, (-1.0, -1.0, -1.0)
    for xt in xs:
        for it in is_:
            for ht in hs:
                if ht < it:
                    continue
                for m in C.RULE_MARGINS:
                    pred = ((x >= xt) & (i >= it)) | ((i >= ht) & (i >= e + m) & (i >= x + m))
                    tp, fp = int((pred & (y == 1)).sum()), int((pred & (y == 0)).sum())
                    fn, tn = int((~pred & (y == 1)).sum()), int((~pred & (y == 0)).sum())
                    f1s = [f for f, present in ((_f1(tp, fp, fn), tp + fn + fp > 0), (_f1(tn, fn, fp), tn + fp + fn > 0))
                           if present]
                    key = (sum(f1s) / len(f1s), tp / (tp + fn) if tp + fn else 0.0, (tp + tn) / n)
                    if key > key0:
                        best, key0 = (xt, it, ht, m), key
    assert (got["exaggeration_threshold"], got["irony_threshold"], got["irony_high_threshold"],
            got["irony_dominance_margin"]) == best
    assert abs(got["macro_f1"] - key0[0]) < 1e-12
