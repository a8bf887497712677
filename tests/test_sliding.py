"""Long frames in one pass beside Spark's own frames."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.keys import P
from tidemark.operators import sliding


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    data = []
    for e in range(3):
        for d in range(90):
            x = None if rng.random() < 0.15 else rng.gauss(50, 3)
            data.append((d, e, "A", x, None if rng.random() < 0.1 else rng.gauss(0, 1), float(rng.randint(0, 4)), 7.5 if e == 2 else x))
    data += [(1, 9, "B", None, None, None, None), (1, 8, "B", 1.0, 2.0, 3.0, 4.0)]
    return spark.createDataFrame(data, "date int, entity int, grp string, x double, y double, ties double, flat double").repartition(4)


FRAMES = [(9, 0), (9, 1), (20, 11), (0, 0), (500, 3)]


@pytest.mark.parametrize(("first", "last"), FRAMES)
def test_frames_equal_those_of_spark(rows, first, last):
    w = P.back(first, last)
    out = sliding.order_statistics(rows, {f"{k}_{c}": (k, c, first, last) for k in ("median", "max", "min") for c in ("x", "ties")})
    out = sliding.frame_sums(out, {"s": ("x", first, last), "n": (F.col("x").isNotNull().cast("int"), first, last)})
    want = {"median": lambda c: F.percentile(c, F.lit(0.5)), "max": F.max, "min": F.min}
    out = out.withColumns({f"want_{k}_{c}": want[k](c).over(w) for k in want for c in ("x", "ties")} | {"want_s": F.sum("x").over(w), "want_n": F.count("x").over(w)})
    for r in out.collect():
        assert r.n == r.want_n and (r.want_s is None or abs(r.s - r.want_s) < 1e-9)
        for k in want:
            for c in ("x", "ties"):
                a, b = r[f"{k}_{c}"], r[f"want_{k}_{c}"]
                assert a == b or abs(a - b) < 1e-12, (k, c)


@pytest.mark.parametrize("n", [5, 30])
def test_regression_equals_that_of_spark(rows, n):
    w = P.back(n, 1)
    some = rows.filter("x is not null and y is not null or date % 7 = 0")
    for x in ("x", "flat"):
        out = sliding.regression(some, "y", x, n)
        out = out.withColumns({"want_n": F.regr_count("y", x).over(w), "want_s": F.regr_slope("y", x).over(w), "want_i": F.regr_intercept("y", x).over(w)})
        full = 0
        for r in out.collect():
            assert r.n_pairs == r.want_n
            if r.n_pairs < n or r.want_s is None:
                assert r.slope is None and r.intercept is None
            else:
                full += 1
                assert abs(r.slope - r.want_s) < 1e-9 and abs(r.intercept - r.want_i) < 1e-7
        assert full


def test_deviation_of_few_values(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 2.0, 4.0), (3, 6.0, 14.0), (4, 4.0, 4.0)], "n int, s double, q double")
    got = [r[0] for r in df.select(sliding.deviation(F.col("n"), F.col("s"), F.col("q"))).collect()]
    assert got == [None, None, 1.0, 0.0]
