import itertools

import numpy as np

from veracity.operators import metrics as M


def test_report_and_confusion(spark):
    rows = [("real", "real"), ("real", "fake"), ("fake", "fake"), ("fake", "fake"), ("satire", "fake")]
    df = spark.createDataFrame(rows, "t string, p string")
    cm = {(r["truth"], r["pred"]): r["n"] for r in M.confusion(df, "t", "p", ["real", "fake", "satire"]).collect()}
    assert len(cm) == 9 and cm[("satire", "satire")] == 0 and cm[("real", "fake")] == 1
    rep = {r["label"]: r for r in M.classification_report(df, "t", "p", ["real", "fake", "satire"]).collect()}
    assert rep["fake"]["precision"] == 0.5 and rep["fake"]["recall"] == 1.0
    assert rep["satire"]["f1"] == 0.0 and rep["accuracy"]["f1"] == 0.6
    assert abs(rep["macro avg"]["recall"] - (0.5 + 1.0 + 0.0) / 3) < 1e-12
    # macro-F1 of G11 averages over labels present in truth or prediction (all three here)
    mf = M.macro_f1(df, "t", "p", ["real", "fake", "satire"]).first()[0]
    assert abs(mf - (2 / 3 + 2 / 3 + 0.0) / 3) < 1e-12


def test_auc_and_ap_brute_force(spark):
    rng = np.random.default_rng(3)
    s = np.round(rng.random(40), 1)  # many ties
    y = (rng.random(40) < 0.4).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    auc = M.roc_auc(df, "y", "s").first()[0]
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg)])
    assert abs(auc - want) < 1e-12
    ap = M.average_precision(df, "y", "s").first()[0]
    want_ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        pred = s >= t
        tp = int((pred & (y == 1)).sum())
        r, p = tp / int(y.sum()), tp / int(pred.sum())
        want_ap += (r - prev_r) * p
        prev_r = r
    assert abs(ap - want_ap) < 1e-12
