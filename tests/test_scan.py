"""Samples, denominators and verdicts of a scan on small hand-made tables."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import scan as N

START = dt.date(2020, 1, 1)


def days(n):
    return [START + dt.timedelta(days=i) for i in range(n)]


def panel(spark, gaps=(), events=()):
    data = [(d, e, "A", 100.0 + (e + 1) * i, (e, i) in events) for e in (0, 1) for i, d in enumerate(days(12)) if (e, i) not in gaps]
    return spark.createDataFrame(data, "date date, entity int, grp string, close double, event boolean")


def labels(spark, **k):
    out = N.scan_labels(panel(spark, **k), (1, 3), ((0, 1), (1, 3)), holdout="2020-01-10", formation=4)
    return {(r.entity, (r.date - START).days): r for r in out.collect()}


def test_bucket_has_only_its_own_events_against_it(spark):
    got = labels(spark, events={(0, 3)})
    at = {i: got[0, i] for i in range(4)}
    assert at[2].cum_1 is None and at[2].cum_3 is None and at[2].bkt_0_1 is None and at[2].bkt_1_3 is not None
    assert at[1].cum_1 is not None and at[1].cum_3 is None and at[1].bkt_1_3 is None
    assert at[3].cum_3 is not None  # an event on the day itself lies before the span
    assert abs(got[0, 4].bkt_1_3 - (107 / 105 - 1)) < 1e-12
    assert abs(got[0, 4].cum_1_excess - (1 / 104 - (1 / 104 + 2 / 108) / 2)) < 1e-12


def test_label_ends_before_the_holdout_and_survivors_have_the_whole_span(spark):
    got = labels(spark, gaps={(1, i) for i in range(7, 12)})
    assert got[0, 5].cum_3_ok and not got[0, 6].cum_3_ok and got[0, 6].cum_3_end == dt.date(2020, 1, 10)
    assert got[0, 4].common_formation and got[0, 4].common_survivor and not got[0, 5].common_formation
    assert got[1, 4].common_formation and not got[1, 4].common_survivor and got[1, 2].common_survivor
    assert got[0, 11].cum_1_end is None and not got[0, 11].cum_1_ok


def test_funnel_adds_up_and_null_fails(spark):
    df = spark.createDataFrame([(1, True), (2, None), (3, False), (None, True)], "a int, b boolean")
    got = {r.first_failed: r.rows for r in N.exclusion_funnel(df, [("a", F.col("a") < 3), ("b", F.col("b"))]).collect()}
    assert got == {"kept": 1, "b": 1, "a": 2}
    assert N.exclusion_funnel(df.limit(0), [("a", F.col("a") < 3)]).count() == 0


def test_coverage_counts_finite_features_and_valid_labels(spark):
    df = spark.createDataFrame([(START, 1.0, True, True), (START, float("nan"), True, True), (START, None, None, True), (START, 2.0, False, None)], "date date, x double, ok boolean, inside boolean")
    (r,) = N.coverage_stats(df, [("c", "x", "ok")], F.col("inside")).collect()
    assert (r.n_formation, r.feature_coverage, r.label_coverage, r.sample_end) == (3, 1 / 3, 2 / 3, START)
    (e,) = N.coverage_stats(df, [("c", "x", "ok")], F.lit(False)).collect()
    assert e.n_formation == 0 and e.feature_coverage is None


def test_every_combination_equals_its_own_filtered_scan(spark):
    rng = random.Random(4)
    data = [(d, e, "AB"[e % 2], float(rng.randint(0, 5)) if rng.random() < 0.9 else None, rng.gauss(0, 1), rng.random() < 0.8, rng.random()) for d in days(6) for e in range(24)]
    df = spark.createDataFrame(data, "date date, entity int, grp string, x double, y double, ok boolean, size double").repartition(3)
    samples = {"all": F.lit(True), "big": F.col("size") > 0.5, "none": F.lit(None).cast("boolean"), "A": F.col("grp") == "A"}
    got = {(r.sample, r.date): (r.n, r.ic) for r in N.scan_combinations(df, [("c", "x", "y", "ok")], samples, min_names=4).collect()}
    keep = {"all": lambda r: True, "big": lambda r: r[6] > 0.5, "A": lambda r: r[2] == "A"}
    want = {}
    for name, k in keep.items():
        for d in days(6):
            each = []
            for g in "AB":
                rows = [r for r in data if r[0] == d and r[2] == g and r[3] is not None and r[5] and k(r)]
                if len(rows) >= 4:
                    a, b = ([sum(v < w for v in vs) + (sum(v == w for v in vs) + 1) / 2 for w in vs] for vs in ([r[3] for r in rows], [r[4] for r in rows]))
                    if np.std(a) > 0:
                        each.append((np.corrcoef(a, b)[0, 1], len(rows)))
            if each:
                want[name, d] = (sum(n for _, n in each), sum(c * n for c, n in each) / sum(n for _, n in each))
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12 for k in want)
    status = {(r.cell, r.sample): (r.status, r.reason) for r in N.scan_status(N.scan_combinations(df, [("c", "x", "y", "ok")], samples, min_names=4), ["c"], list(samples), min_dates=6).collect()}
    assert status["c", "none"] == ("not_evaluated", "no_formation_rows") and status["c", "all"] == ("evaluated", None)
    with pytest.raises(ValueError, match="62"):
        N.scan_combinations(df, [], {str(i): F.lit(True) for i in range(63)})


def test_screen_asks_only_gates_that_apply(spark):
    cells = spark.createDataFrame(
        [(1, "ready", True, False, None, False, None), (2, "ready", True, True, None, False, None), (3, "ready", True, False, False, True, None), (4, "ready", None, False, True, True, True), (5, "other", False, True, False, True, False)],
        "cell int, role string, found boolean, isolated boolean, direction boolean, needs boolean, delay boolean",
    )
    out = {r.cell: (r.screen_pass, r.failed_gates) for r in N.screen_pass(cells, always=["found"], optional=["direction"], required={"delay": "needs"}).collect()}
    assert out == {1: (True, []), 2: (False, ["isolated_clear"]), 3: (False, ["direction", "delay"]), 4: (False, ["found"]), 5: (False, [])}


def test_quantile_report_counts_both_edges_and_skips_small_dates(spark):
    from tidemark.operators.model import quantile_report

    rows = [(START, float(i), float(i) - 6) for i in range(1, 11)] + [(days(2)[1], 1.0, 100.0)] * 4 + [(START, None, 9.0), (START, 1.0, None)]
    (r,) = quantile_report(spark.createDataFrame(rows, "date date, s double, y double"), "s", "y").collect()
    # Places 0.8, 0.9 and 1.0 are the top fifth, 0.1 and 0.2 the bottom one.
    assert (r.dates, r.top_decile, r.top_minus_bottom, r.hit_ratio_top) == (1, 3.5, 3.0 - -4.5, 1.0)
