"""Exact quantiles, buckets and correlations from counts of values, beside numpy and a window; none holds a group in a task."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import cross as C
from tidemark.operators import describe as E
from tidemark.operators import model as M


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(5)
    rows = [(g, float(rng.randint(0, 40)) if rng.random() < 0.5 else rng.gauss(0, 30), float(rng.randint(-9, 9))) for g, n in (("a", 900), ("b", 333), (None, 120), ("one", 1)) for _ in range(n)]
    rows += [("a", None, 1.0), ("none", None, 2.0), ("none", None, None)]
    return rows, spark.createDataFrame(rows, "g string, x double, y double").repartition(5)


def plan_text(df):
    return df._jdf.queryExecution().toString()


def test_distribution_of_each_group(pairs):
    rows, df = pairs
    got = {r.g: r for r in A.distribution_stats(df, "x", ["g"]).collect()}
    assert set(got) == {"a", "b", None, "one", "none"}
    assert got["none"].n == 0 and got["none"].n_distinct == 0 and got["none"].mean is None and got["none"].p50 is None
    assert got["one"].std is None and got["one"].p01 == got["one"].p99 == got["one"].min
    for g in ("a", "b", None):
        v = np.array([x for k, x, _ in rows if k == g and x is not None])
        r = got[g]
        assert (r.n, r.n_distinct, r.min, r.max) == (len(v), len(set(v)), v.min(), v.max())
        assert np.allclose([r.mean, r.std], [v.mean(), v.std(ddof=1)]) and np.allclose([r[f"p{round(q * 100):02d}"] for q in A.QUANTILES], np.quantile(v, A.QUANTILES))
    every = A.distribution_stats(df, "x").first()
    assert every.n == sum(x is not None for _, x, _ in rows) and math.isclose(every.p50, np.median([x for _, x, _ in rows if x is not None]))
    assert A.distribution_stats(df.limit(0), "x").first().n == 0


def test_distribution_holds_no_group_in_an_aggregate(pairs):
    assert "percentile(" not in plan_text(A.distribution_stats(pairs[1], "x", ["g"])).lower()


def test_bounds_of_training_rows(pairs):
    rows, df = pairs
    r = M.fit_winsor(df, ["x", "y"], 0.02, 0.9).first()
    for c, i in (("x", 1), ("y", 2)):
        assert np.allclose([r[f"{c}_lo"], r[f"{c}_hi"]], np.quantile([k[i] for k in rows if k[i] is not None], [0.02, 0.9]))
    assert M.fit_winsor(df.limit(0), ["x"]).collect()[0].asDict() == {"x_lo": None, "x_hi": None}


def test_bounds_hold_no_column_in_an_aggregate(pairs):
    assert "percentile(" not in plan_text(M.fit_winsor(pairs[1], ["x", "y"])).lower()


def test_association_equals_windows_over_rows(pairs):
    _, df = pairs
    out = E.association_study(df, "x", "y", by=["g"], k=4, min_n=2)
    rows = df.filter("x is not null and y is not null")
    for c in "xy":
        rows = C.winsorize(rows, c, 0.01, 0.99, ["g"], c)
    buckets = rows.withColumn("bucket", F.ntile(4).over(W.partitionBy("g").orderBy("x", "y"))).groupBy("g", "bucket").agg(F.count("*").alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"))
    want = {(r.g, r.bucket): (r.n, r.mx, r.my) for r in buckets.collect()}
    got = {(r.g, r.bucket): (r.n, r.mean_x, r.mean_y) for r in out["buckets"].collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and np.allclose(got[k], want[k]) for k in want)
    corr = {r.g: (r.n, r.corr) for r in A.correlation(rows, "x", "y", by=["g"], min_n=2).collect()}
    seen = {r.g: (r.n, r.corr) for r in out["correlation"].collect()}
    assert seen.keys() == corr.keys() and all(seen[k][0] == corr[k][0] and math.isclose(seen[k][1], corr[k][1]) for k in corr)
    assert {r.g: r.n for r in out["regression"].collect()} == {r.g: r.n for r in A.simple_regression(rows, "x", "y", ["g"]).collect()}


@pytest.mark.parametrize("name", ["buckets", "correlation"])
def test_association_holds_no_group_in_a_window(pairs, name):
    plan = plan_text(E.association_study(pairs[1], "x", "y", by=["g"])[name]).lower()
    assert "percentile(" not in plan and "ntile(" not in plan


def test_constant_side_has_no_correlation(spark):
    df = spark.createDataFrame([(0.1, float(i), 3) for i in range(7)], "x double, y double, n long")
    r = A.weighted_corr(df, "x", "y", "n").first()
    assert r.n == 21 and r.corr is None
