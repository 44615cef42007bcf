import math

from pyspark.sql import functions as F

from veracity.functions.text import clip01, format_duration, normalize_label, py_strip, safe_float


def test_strip_and_labels(spark):
    rows = [("　 Real \n",), ("가짜뉴스",), (" SATIRICAL ",), ("unknown",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [(r[0], r[1]) for r in df.select(py_strip("s"), normalize_label("s")).collect()]
    assert got == [("Real", "real"), ("가짜뉴스", "fake"), ("SATIRICAL", "satire"), ("unknown", None), (None, None)]


def test_safe_float_matches_python_float(spark):
    cells = ["1.5", " 2 ", "1_0", "1e3", "nan", "-inf", "1d", "1f", "abc", "", "0x10", ".5", "5.", "+3"]
    df = spark.createDataFrame([(c,) for c in cells], "s string")
    got = [r[0] for r in df.select(safe_float("s", -99.0)).collect()]
    for c, g in zip(cells, got):
        try:
            want = float(c) if c.strip() else -99.0
        except ValueError:
            want = -99.0
        if isinstance(want, float) and math.isnan(want):
            assert math.isnan(g)
        else:
            assert g == want, c


def test_clip_and_duration(spark):
    df = spark.createDataFrame([(float("nan"),), (-1.0,), (2.0,), (0.25,)], "x double")
    assert [r[0] for r in df.select(clip01("x")).collect()] == [0.0, 0.0, 1.0, 0.25]
    d = spark.createDataFrame([(2.5,), (3.5,), (3661.4,), (-1.0,), (None,), (float("inf"),)], "x double")
    got = [r[0] for r in d.select(format_duration(F.col("x"))).collect()]
    assert got == ["00:00:02", "00:00:04", "01:01:01", "--:--:--", "--:--:--", "--:--:--"]
