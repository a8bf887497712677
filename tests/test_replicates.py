"""Replicates as arrays beside their naive forms, which copy every row for every replicate."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import infer as H
from tidemark.operators import replicates as K

PANEL = "date date, entity long, grp string, d_idx int, x double, y double, z double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for d in range(1, 41):
        for e in range(14):
            if rng.random() < 0.9:
                x, y = float(rng.randint(0, 6)), rng.gauss(0, 1)
                out.append((f"2020-{1 + d // 28:02d}-{1 + d % 28:02d}", e, "AB"[e % 2], d, x if rng.random() < 0.9 else None, y if rng.random() < 0.9 else None, 1.0))
    return out


def panel(spark, rows):
    return spark.createDataFrame(rows, PANEL.replace("date date", "date string")).withColumn("date", F.to_date("date")).repartition(5)


def ranks(v):
    return [sum(b < a for b in v) + (sum(b == a for b in v) + 1) / 2 for a in v]


def corr(a, b):
    a, b = np.array(ranks(a)), np.array(ranks(b))
    a, b = a - a.mean(), b - b.mean()
    n = np.sqrt((a * a).sum() * (b * b).sum())
    return (a * b).sum() / n if n > 0 else None


def daily(by_group, min_names):
    ics = [(corr(a, b), len(a)) for a, b in by_group if len(a) >= min_names]
    ics = [(c, n) for c, n in ics if c is not None]
    return (sum(c * n for c, n in ics) / sum(n for _, n in ics), sum(n for _, n in ics)) if ics else None


def draw8(seed, rep, date, entity):
    return int(hashlib.sha256(f"{seed}|{rep // 8}|{date}|{entity}".encode()).hexdigest()[8 * (rep % 8) :][:8], 16)


@pytest.mark.parametrize("held", [4_000_000, 40])
def test_permutations_equal_one_sort_for_each_replicate(spark, rows, monkeypatch, held):
    monkeypatch.setattr(K, "HELD", held)
    n = 21
    cells = [("c", "x", "y"), ("const", "x", "z"), ("d", "y", "x")]
    out = K.permutation_null(panel(spark, rows), cells, n, seed="s", min_names=4)
    got = {(r.cell, str(r.date)): (r.n, r.ics) for r in out.collect()}
    want = {}
    for cell, x, y in cells:
        of = defaultdict(list)
        for r in rows:
            v = dict(x=r[4], y=r[5], z=r[6])
            if v[x] is not None and v[y] is not None:
                of[r[0], r[2]].append((r[1], v[x], v[y]))
        for date in sorted({d for d, _ in of}):
            each = []
            for rep in range(n):
                groups = []
                for g in "AB":
                    mine = sorted(of[date, g])
                    turn = sorted(mine, key=lambda r: (draw8("s", rep, date, r[0]), r[0]))
                    groups.append(([t[1] for t in turn], [r[2] for r in mine]))
                each.append(daily(groups, 4))
            if each[0]:
                want[cell, date] = (each[0][1], [c for c, _ in each])
    assert got.keys() == want.keys() and not any(c == "const" for c, _ in got)
    for k, (names, ics) in want.items():
        assert got[k][0] == names and np.allclose(got[k][1], ics, atol=1e-12)
    few = K.permutation_null(panel(spark, rows), cells, 3, seed="s", min_names=4).filter("cell = 'c'").first()
    assert np.allclose(few.ics, got["c", str(few.date)][1][:3])


def test_one_sort_serves_all_cells():
    draws = np.array([[5, 2**32 - 1, 5, 0, 2**32 - 1], [1, 1, 1, 1, 1]])
    assert K.draw_orders(draws).tolist() == [[3, 0, 2, 1, 4], [0, 1, 2, 3, 4]]
    rng = np.random.default_rng(1)
    draws = rng.integers(0, 9, (6, 40))
    there = rng.random(40) < 0.7
    order = K.draw_orders(draws)
    part = order[there[order]].reshape(6, -1)
    assert (np.flatnonzero(there)[np.argsort(draws[:, there], 1, kind="stable")] == part).all()


def test_hac_of_arrays_equals_hac_of_rows(spark):
    rng = random.Random(3)
    series = [(c, i, [rng.gauss(0.1, 1) if c != "flat" else 1.0 for _ in range(9)]) for c in ("a", "b", "flat") for i in range(1, 60) if rng.random() < 0.8] + [("one", 5, [0.5] * 9)]
    df = spark.createDataFrame(series, "cell string, d_idx int, ics array<double>")
    got = {(r.cell, r.rep): r.nw_t for r in K.replicate_newey_west(df, 4, chunk=4).collect()}
    flat = df.select("cell", "d_idx", F.posexplode("ics").alias("rep", "ic"))
    want = {(r.cell, r.rep): r.nw_t for r in H.newey_west(flat, 4, by=["cell", "rep"]).collect()}
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (want[k] is None) and (got[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)


@pytest.mark.parametrize("block", [7, 125])
def test_placebo_equals_a_join_for_each_replicate(spark, rows, block):
    n, total = 12, 40
    shifts = K.shift_distances(n, seed="p", min_shift=5, total=total)
    assert all(5 <= s < 35 for s in shifts)
    df = panel(spark, rows)
    features = df.filter("x is not null").select("d_idx", "entity", "grp", "x")
    labels = df.filter("y is not null").select("d_idx", "date", "entity", "grp", F.lit("c").alias("cell"), "y")
    out = K.placebo_null(features, labels, n, seed="p", min_shift=5, total=total, min_names=3, block=block)
    got = {(r.rep, str(r.date)): (r.ic, r.n) for r in out.collect()}
    xs = {(r[3], r[1], r[2]): r[4] for r in rows if r[4] is not None}
    want = {}
    for rep, s in enumerate(shifts):
        of = defaultdict(list)
        for date, e, g, i, _, y, _ in rows:
            x = xs.get(((i - 1 - s) % total + 1, e, g))
            if y is not None and x is not None:
                of[date, g].append((x, y))
        for date in {d for d, _ in of}:
            if found := daily([tuple(zip(*of[date, g], strict=True)) for g in "AB" if of[date, g]], 3):
                want[rep, date] = found
    assert got.keys() == want.keys()
    assert all(got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-12 for k in want)


def test_placebo_packs_cross_sections_and_gives_the_panel_as_it_stands(spark, rows, monkeypatch):
    df = panel(spark, rows)
    features = df.select("d_idx", "entity", "grp", "x")
    labels = df.select("d_idx", "date", "entity", "grp", F.lit("c").alias("cell"), "y")
    make = lambda: K.placebo_null(features, labels, 6, seed="p", min_shift=5, total=40, min_names=3, block=9, observed=5)
    out = make()
    got = {(r.rep, str(r.date)): (r.ic, r.n) for r in out.collect()}
    want = {str(r.date): (r.ic, r.n) for r in H.daily_ic(H.long_cells(df, [("c", "x", "y")])).collect()}
    assert {d for r, d in got if r < 0} == want.keys()
    assert all(got[-1, d][1] == n and abs(got[-1, d][0] - c) < 1e-12 for d, (c, n) in want.items())
    monkeypatch.setattr(K, "HELD", 8 * 11)  # parts of few sections
    monkeypatch.setattr(K, "BROADCAST", 3)
    few = {(r.rep, str(r.date)): (r.ic, r.n) for r in make().collect()}
    assert few.keys() == got.keys() and all(abs(few[k][0] - got[k][0]) < 1e-12 for k in got)
    one = K.placebo_null(features, labels, 3, seed="p", min_shift=60, total=40, min_names=3)  # a distance beyond the calendar goes round it
    assert one.select("rep").distinct().count() == 3


EVENTS = "cohort int, g int, entity long, cycle int, x double, y double"


@pytest.mark.parametrize("held", [4_000_000, 200])
def test_bootstrap_equals_copies_of_events(spark, monkeypatch, held):
    monkeypatch.setattr(K, "HELD", held)
    rng = random.Random(9)
    rows = [(c, rng.randint(0, 1), rng.randint(0, 12), c // 2, float(rng.randint(0, 5)), rng.gauss(0, 1) if rng.random() < 0.95 else None) for c in range(6) for _ in range(rng.randint(5, 40))]
    events = spark.createDataFrame(rows, EVENTS).repartition(4)
    n = 7
    got = {r.rep: r for r in K.cluster_bootstrap_ic(events, "x", "y", cluster=["entity"], cohort="cohort", group="g", n=n, seed="b", min_group=4, min_cohort=10).collect()}
    assert set(got) == set(range(n))
    ids = sorted({r[2] for r in rows if r[5] is not None})
    for rep in range(n):
        drawn = Counter(ids[int(hashlib.md5(f"b|{rep}|{slot}".encode()).hexdigest()[:12], 16) % len(ids)] for slot in range(len(ids)))
        copies = [r for r in rows for _ in range(drawn[r[2]])]
        naive = H.event_cohort_scan(spark.createDataFrame(copies, EVENTS), "x", "y", cohort="cohort", group="g", min_group=4, min_cohort=10).collect() if copies else []
        ics = [r.ic for r in naive if r.ic is not None]
        assert got[rep].cohorts == len(ics) and got[rep].events == sum(r.n for r in naive)
        assert (got[rep].mean_ic is None and not ics) or abs(got[rep].mean_ic - np.mean(ics)) < 1e-9
    both = K.cluster_bootstrap_ic(events, "x", "y", cluster=["cycle", "g"], cohort="cohort", group="g", n=3, seed="b", min_group=4, min_cohort=10)
    assert both.count() == 3
    assert K.cluster_bootstrap_ic(events.limit(0), "x", "y", cluster=["entity"], cohort="cohort", group="g", n=2, seed="b").filter("mean_ic is null").count() == 2


def test_bootstrap_in_blocks_of_draws_shuffles_events_without_them(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(c, rng.randint(0, 1), rng.randint(0, 9), c, rng.gauss(0, 1), rng.gauss(0, 1)) for c in range(5) for _ in range(30)]
    events = spark.createDataFrame(rows, EVENTS).repartition(3)
    make = lambda: K.cluster_bootstrap_ic(events, "x", "y", cluster=["entity"], cohort="cohort", group="g", n=9, seed="b", min_group=4, min_cohort=10)
    out = make()
    whole = {r.rep: r for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    after_draws = plan[plan.index("FlatMapGroupsInArrow") : plan.index("BroadcastHashJoin")]
    assert "Exchange" not in after_draws
    monkeypatch.setattr(K, "SENT", 2 * 30 * 2)  # four replicates at a time
    few = {r.rep: r for r in make().collect()}
    assert few.keys() == whole.keys() == set(range(9))
    assert all(abs(few[k].mean_ic - whole[k].mean_ic) < 1e-12 and few[k].events == whole[k].events for k in few)


def test_verdict_needs_every_clustering(spark):
    v = [("a", x) for x in (0.1, 0.2, 0.3, 0.4)] + [("b", x) for x in (-0.1, 0.2, 0.3, None)]
    out = {r.c: r for r in K.bootstrap_verdict(spark.createDataFrame(v, "c string, mean_ic double"), by="c").collect()}
    assert out["a"].p == 0.0 and out["a"].confirms and not out["a"].all_confirm
    assert out["b"].valid == 3 and abs(out["b"].p - 2 / 3) < 1e-12 and not out["b"].confirms
    assert not any(r.confirms for r in K.bootstrap_verdict(spark.createDataFrame(v, "c string, mean_ic double"), by="c", expected_sign=-1).collect())


def test_sign_test_of_every_count(spark):
    from math import comb

    rows = [(k, n) for n in (0, 1, 7, 900) for k in {0, 1, n // 2, n} if k <= n]
    got = spark.createDataFrame(rows, "k long, n long").select("k", "n", H.sign_test_p("k", "n").alias("p")).collect()
    assert all(abs(r.p - sum(comb(r.n, i) for i in range(r.k, r.n + 1)) / 2**r.n) < 1e-9 for r in got)
