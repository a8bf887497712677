"""Edge cases of the panel operators on tiny frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import aggregates as A
from tidemark.operators import cross as C
from tidemark.operators import infer as H
from tidemark.operators import joins as J
from tidemark.operators import model as M
from tidemark.operators import pit
from tidemark.operators import quality as Q
from tidemark.operators import sessions as S
from tidemark.operators import windows as R
from tidemark.plans import all_queries
from tidemark.plans.fixtures import Fixtures
from tidemark.sources import lake, parsers


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def bars(spark, rows):
    return spark.createDataFrame([(day(d), e, "A", o, o, o, c, v) for d, e, o, c, v in rows], "date date, entity long, grp string, open double, high double, low double, close double, volume long")


def test_division_by_zero_is_null(spark):
    r = spark.range(1).select(X.sdiv(F.lit(1), F.lit(0)).alias("a"), X.safe_ln(F.lit(-1.0)).alias("b")).first()
    assert r.a is None and r.b is None


def test_constant_cross_section_has_no_correlation(spark):
    df = spark.createDataFrame([(1, 2.0, float(i)) for i in range(6)], "g int, x double, y double")
    assert A.correlation(df, "x", "y", by=["g"]).first().corr is None
    assert M.rank_ic(df, "x", "y", by=["g"]).first().ic is None


def test_ranks_skip_null_and_share_ties(spark):
    df = spark.createDataFrame([(1, None), (1, 3.0), (1, 1.0), (1, 3.0)], "g int, x double")
    got = df.select("x", C.average_rank("x", ["g"]).alias("r"), C.percent_rank("x", ["g"]).alias("p")).orderBy("x").collect()
    assert [(r.x, r.r, r.p) for r in got] == [(None, None, None), (1.0, 1.0, 0.0), (3.0, 2.5, 0.5), (3.0, 2.5, 0.5)]


def test_clip_keeps_null(spark):
    assert spark.range(1).select(X.clip(F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0)).alias("x")).first().x is None


def test_halted_sessions_are_not_numbered(spark):
    v = S.valid_session_panel(bars(spark, [(0, 1, 1.0, 1.0, 5), (1, 1, 0.0, 1.0, 0), (2, 1, 2.0, 2.0, 5)])).orderBy("date").collect()
    assert [r.v_idx for r in v] == [1, 2] and v[1].lag_close == 1.0 and v[1].simple == 1.0


def test_fact_of_the_same_day_is_visible_and_late_old_period_does_not_win(spark):
    panel = spark.createDataFrame([(day(d), 1, "A") for d in (0, 5, 9, 12)], "date date, entity long, grp string")
    facts = spark.createDataFrame([(1, day(-30), day(5), 10.0), (1, day(-90), day(9), 7.0), (1, day(0), day(12), 11.0)], "entity long, period_end date, available_from date, value double")
    out = pit.pit_latest_eligible(panel, facts, by=["entity"], order=["period_end", "value"], values=["value"]).orderBy("date").collect()
    assert [r.value for r in out] == [None, 10.0, 10.0, 11.0]
    latest = pit.asof_backward(panel, facts, by=["entity"], left_date="date", right_date="available_from", values=["value"]).orderBy("date").collect()
    assert [r.value for r in latest] == [None, 10.0, 7.0, 11.0]


def test_same_day_facts_collapse_to_the_latest_period(spark):
    facts = spark.createDataFrame([(1, day(-30), day(5), 10.0), (1, day(-3), day(5), 12.0)], "entity long, period_end date, available_from date, value double")
    out = pit.intervals(facts, by=["entity"], order=["period_end"], values=["value"]).collect()
    assert [(r.value, r.valid_to) for r in out] == [(12.0, None)]


def test_missing_quarter_gives_null_lag(spark):
    df = spark.createDataFrame([(1, 4, 1.0), (1, 6, 2.0), (1, 8, 3.0)], "entity long, seq int, v double")
    got = df.select("seq", J.exact_period_lag("v", "seq", 4, ["entity"]).alias("l")).orderBy("seq").collect()
    assert [r.l for r in got] == [None, None, 1.0]
    assert [r.l for r in df.select("seq", J.exact_period_lag("v", "seq", 1, ["entity"]).alias("l")).collect()] == [None] * 3


def test_next_session_is_strictly_after(spark):
    days = spark.createDataFrame([(day(0),), (day(3),)], "date date")
    asked = spark.createDataFrame([(day(0),), (day(1),), (day(3),), (None,)], "date date")
    got = {r.date: r.session for r in S.next_session(asked, days).collect()}
    assert got == {day(0): day(3), day(1): day(3), day(3): None}
    assert {r.date: r.session for r in S.next_session(asked, days, on_or_after=True).collect()}[day(0)] == day(0)


def test_drawdown(spark):
    rows = [(i, 1, 1.0, c, 1) for i, c in enumerate([100.0, 110.0, 99.0, 120.0])]
    v = S.valid_session_panel(bars(spark, rows)).select("date", R.forward_max_drawdown("simple", 3).alias("m")).orderBy("date").collect()
    assert v[0].m == pytest.approx(99 / 110 - 1) and v[1].m is None


def test_global_rank_equals_window(spark):
    df = spark.range(500).select((F.col("id") * 37 % 101).cast("double").alias("x"))
    a = sorted((r.x, r["rank"]) for r in C.global_rank(df, "x").collect())
    xs = sorted(r.x for r in df.collect())
    assert a == [(x, xs.index(x) + 1) for x in xs]


def test_benjamini_hochberg_counts_missing_as_one(spark):
    df = spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", None)], "cell string, p double")
    got = {r.cell: r.q for r in H.benjamini_hochberg(df).collect()}
    assert got["a"] == pytest.approx(0.03) and got["b"] == pytest.approx(0.06) and got["c"] == 1.0


def test_p_values(spark):
    df = spark.createDataFrame([(1.96, 8, 10), (None, 0, 0)], "t double, h int, n int")
    a, b = df.select(H.normal_p("t").alias("p"), H.sign_test_p("h", "n").alias("s")).collect()
    assert a.p == pytest.approx(math.erfc(1.96 / math.sqrt(2))) and a.s == pytest.approx(56 / 1024) and b.s == 1.0


def test_permutation_keeps_each_cross_section(spark):
    long = spark.createDataFrame([("c", day(d), e, "A", float(e), 0.0) for d in range(3) for e in range(20)], "cell string, date date, entity long, grp string, x double, y double")
    out = H.permute_cross_section(long, 2, seed="s")
    again = H.permute_cross_section(long, 2, seed="s")
    assert out.groupBy("rep", "date").agg(F.sum("x").alias("s"), F.countDistinct("x").alias("n")).distinct().select("s", "n").distinct().collect() == [(190.0, 20)]
    assert sorted(out.collect()) == sorted(again.collect())
    assert out.filter("x <> entity").count() > 60


def test_canary_is_one(spark):
    df = spark.createDataFrame([(day(0), e, "A", float(e * e)) for e in range(8)], "date date, entity long, grp string, y double")
    assert H.lookahead_canary(df, "y").first().mean_ic == pytest.approx(1.0)


def test_fanout_is_seen(spark):
    base = bars(spark, [(0, 1, 1.0, 1.0, 1)])
    twice = base.unionByName(base)
    assert not J.assert_no_fanout(base, twice).first().ok


def test_upsert_and_retention(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int")
    u = spark.createDataFrame([(2, "c", 1), (3, None, 1)], "k int, v string, t int")
    assert sorted((r.k, r.v) for r in lake.upsert(t, u, ["k"], [F.col("t")]).collect()) == [(1, "a"), (2, "c"), (3, None)]
    kept = lake.merge_with_retention(t, spark.createDataFrame([(1, None, 5)], "k int, v string, t int"), ["k"], new_if_known=["v"]).filter("k = 1").first()
    assert (kept.v, kept.t) == ("a", 5)


def test_mart_is_reused_or_refused(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "m")
    lake.materialize(df, path, {"v": 1})
    assert lake.materialize(df, path, {"v": 1}).count() == 3
    with pytest.raises(ValueError):
        lake.materialize(df, path, {"v": 2})
    assert lake.materialize(df, path, {"v": 2}, force=True).count() == 3


def test_fingerprint_ignores_order(spark):
    a = spark.range(100)
    assert lake.table_fingerprint(a).collect() == lake.table_fingerprint(a.orderBy(F.desc("id")).repartition(3)).collect()


def test_parsers(spark):
    df = spark.createDataFrame([('{"list": [{"a": "1,234", "d": "20200131"}, {"a": "-", "d": "x"}]}',), ("broken",)], "p string")
    assert parsers.parse_payload_rows(df, "p", {"a": "number", "d": "date"}).collect() == [(1234.0, dt.date(2020, 1, 31)), (None, None)]
    periods = spark.createDataFrame([("2020Q1", "Q"), ("202013", "M"), ("2020", "A")], "t string, c string")
    assert [r[0] for r in periods.select(parsers.parse_period("t", "c")).collect()] == [dt.date(2020, 3, 31), None, dt.date(2020, 12, 31)]
    with pytest.raises(ValueError):
        parsers.clip_window_with_drift_check(spark.createDataFrame([(day(0), None)], "date date, f double"), ["f"], "date", "2020-01-01", "2020-02-01", [])


def test_empty_series_is_stale(spark):
    facts = spark.createDataFrame([("a", day(0))], "code string, date date")
    limits = spark.createDataFrame([("a", 5), ("b", 5)], "code string, max_lag int")
    got = {r.code: r.stale for r in Q.freshness_gate(facts, limits, code="code", date="date", today=F.lit(day(3))).collect()}
    assert got == {"a": False, "b": True}


def test_walk_forward_trains_all_folds_and_scores_the_holdout_once(spark):
    rows = all_queries()["m13_train_walk_forward"](spark, "/root/testdata/sf0.01").collect()
    valid, held = [r for r in rows if r.role == "valid"], [r for r in rows if r.role == "holdout"]
    assert sorted((r.params, r.fold) for r in valid) == [(p, k) for p in range(3) for k in range(4)]
    means = {p: [r.mean_ic for r in valid if r.params == p and r.mean_ic is not None] for p in range(3)}
    best = max((p for p in means if means[p]), key=lambda p: sum(means[p]) / len(means[p]))
    assert [(r.params, r.fold, r.best) for r in held] == [(best, None, True)] and held[0].cross_sections > 0
    assert {r.params for r in valid if r.best} == {best}


def test_holdout_lies_behind_an_embargo(spark):
    df = spark.createDataFrame([(day(i),) for i in range(20)], "date date")
    got = {r.date: r.role for r in M.tag_holdout(df, embargo=3, holdout=5).collect()}
    assert got == {day(i): "train" for i in range(12)} | {day(i): "holdout" for i in range(15, 20)}


def test_permutation_reports_all_cells_with_q_values(spark):
    rows = all_queries()["h10_permute_cross_section"](spark, "/root/testdata/sf0.001").collect()
    assert {r.cell for r in rows} == {f"{x}:{h}" for x in ("rev", "lnv") for h in (1, 5, 10)}
    for p, q in (("normal_p", "q"), ("p", "empirical_q")):
        ranked = sorted(rows, key=lambda r: (r[p], r.cell))
        want = [min([1.0, *(ranked[j][p] * 6 / (j + 1) for j in range(i, 6))]) for i in range(6)]
        assert [r[q] for r in ranked] == pytest.approx(want, abs=1e-5)  # the query rounds p and q to six digits
    assert {r.replicates for r in rows} == {4} and all(r.discoveries == sum(x.q <= 0.1 for x in rows) for r in rows)
    assert len({r.count_p for r in rows}) == 1 and 0.2 <= rows[0].count_p <= 1


def test_missing_sessions_and_registry_take_the_whole_tables(spark):
    sf = "/root/testdata/sf0.01"
    queries = all_queries()
    bars = Fixtures(spark, sf).bars
    first = bars.groupBy("entity", "grp").agg(F.min("date").alias("first"))
    want = first.join(bars.select("grp", "date").distinct(), "grp").filter("date >= first").count() - bars.select("entity", "grp", "date").distinct().count()
    got = queries["q19_missing_sessions_all"](spark, sf)
    assert got.count() == want and got.filter("entity >= 10").count() > 0
    registered = queries["h22_assemble_results_all"](spark, sf).filter("result <> 'error_unregistered'").count()
    assert registered == spark.read.parquet(f"{sf}/customer.parquet").filter("c_custkey % 4 <> 0").count() > 1000
