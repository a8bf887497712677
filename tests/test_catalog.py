"""Catalog features and checks, payout positions, days of knowledge and the portable fingerprint on small tables."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.features import catalog as C
from tidemark.features import events as V
from tidemark.features import facts as D
from tidemark.operators import pit
from tidemark.sources import lake

Day = dt.date


def history(spark, rows):
    return spark.createDataFrame(rows, "date date, series string, obs_date date, available_from date, value double")


T = Day(2021, 3, 1)
ROWS = [(T, "a", Day(2020, 2, 3), Day(2020, 2, 4), 5.0), (T, "a", Day(2020, 2, 20), Day(2020, 2, 21), 8.0), (T, "a", Day(2021, 1, 5), Day(2021, 1, 6), 20.0), (T, "a", Day(2021, 2, 5), Day(2021, 2, 9), 10.0), (T, "b", Day(2021, 1, 5), Day(2021, 2, 20), 0.0), (Day(2021, 1, 10), "b", Day(2021, 1, 5), Day(2021, 1, 9), 4.0)]


def made(df):
    return {(r.date, r.feature): (r.value, r.available_from) for r in df.collect()}


def test_single_and_joint_features_in_one_table(spark):
    catalog = [C.Feature("lv", "level", ("a",)), C.Feature("ret", "ret_1d", ("a",)), C.Feature("far", "ret_9d", ("a",)), C.Feature("yy", "yoy", ("a",)), C.Feature("mm", "mom", ("a",)), C.Feature("sp", "spread", ("a", "b")), C.Feature("ra", "ratio", ("a", "b")), C.Feature("twice", "spread", ("a", "a")), C.Feature("back", "spread", ("b", "a")), C.Feature("off", "level", ("a",), active=False)]
    got = made(C.build_features(history(spark, ROWS), catalog))
    known, late = Day(2021, 2, 9), Day(2021, 2, 20)
    assert got == {
        (T, "lv"): (10.0, known), (T, "ret"): (-0.5, known), (T, "far"): (None, known), (T, "yy"): (0.25, known), (T, "mm"): (-0.5, known),
        (T, "sp"): (10.0, late), (T, "ra"): (None, late), (T, "twice"): (0.0, known), (T, "back"): (-10.0, late),
        # The first series is known on this date and the second isn't.
        (Day(2021, 1, 10), "back"): (None, Day(2021, 1, 9)),
    }


def test_codes_choose_and_catalogs_can_be_extended_or_wrong(spark):
    own = C.Transforms(dict(C.DEFAULT.single), dict(C.DEFAULT.joint))
    own.register("double")(lambda v, n, by: F.col(v) * 2)
    own.register("middle", joint=True)(lambda a, b: (a + b) / 2)
    rows = history(spark, ROWS)
    catalog = [C.Feature("x", "double", ("a",)), C.Feature("y", "middle", ("a", "b")), C.Feature("z", "level", ("a",))]
    assert made(C.build_features(rows, catalog, codes=["x", "y"], transforms=own)) == {(T, "x"): (20.0, Day(2021, 2, 9)), (T, "y"): (5.0, Day(2021, 2, 20))}
    assert C.build_features(rows, []).collect() == []
    assert C.build_features(rows.filter("value > 1e9"), catalog, transforms=own).collect() == []
    for bad in ([C.Feature("x", "triple", ("a",))], [C.Feature("x", "level", ("a", "b"))], [C.Feature("x", "spread", ("a",))], [catalog[2], catalog[2]]):
        with pytest.raises(ValueError):
            C.build_features(rows, bad)
    with pytest.raises(ValueError):
        own.register("level")(lambda v, n, by: F.col(v))


def test_all_features_cost_one_shuffle_and_one_for_joint_ones(spark):
    plan = lambda c: C.build_features(history(spark, ROWS), c)._jdf.queryExecution().executedPlan().toString()
    singles = [C.Feature(f"r{n}", f"ret_{n}d", ("a",)) for n in range(1, 20)] + [C.Feature("y", "yoy", ("b",))]
    assert plan(singles).count("Exchange hashpartitioning") == 1
    assert plan([*singles, C.Feature("s", "spread", ("a", "b")), C.Feature("r", "ratio", ("a", "b"))]).count("Exchange hashpartitioning") <= 3


def test_checks_count_bad_rows_and_unknown_ones_pass(spark):
    t = spark.createDataFrame([(1,), (-1,), (None,), (5,)], "x int")
    checks = [C.Check("t", "negative", F.col("x") < 0), C.Check("t", "few", F.col("x") < 0, max_share=0.25), C.Check("e", "any", F.col("x") > 0)]
    frames = {"t": t, "e": t.limit(0)}
    got = sorted(tuple(r) for r in C.run_checks(frames, checks).collect())
    assert got == [("e", "any", 0, 0, None, True), ("t", "few", 4, 1, 0.25, True), ("t", "negative", 4, 1, 0.25, False)]
    assert C.run_checks(frames, checks, domains=["e"]).count() == 1
    for args in ((frames, checks, ["u"]), ({"e": t}, checks, None), (frames, [checks[0]] * 2, None)):
        with pytest.raises(ValueError):
            C.run_checks(args[0], args[1], domains=args[2])


DIV = "entity int, year int, item string, stock string, disclosed date, receipt string, value double, text string"


def payout(spark, dividends, shares=(), buybacks=(), **options):
    sessions = spark.createDataFrame([(Day(2021, 4, d),) for d in (1, 2, 5, 6, 9)], "date date")
    held = spark.createDataFrame(list(shares), "entity int, year int, issued long, treasury long")
    back = spark.createDataFrame(list(buybacks), "entity int, year int, basis string, ttm double, available_from date")
    out = V.payout_positions(spark.createDataFrame(dividends, DIV), held, back, sessions, **options)
    return {(r.entity, r.year): r for r in out.collect()}


def row(entity=1, year=2020, item="total", stock="common", disclosed=Day(2021, 4, 2), receipt="r", value=None, text=None):
    return (entity, year, item, stock, disclosed, receipt, value, text)


def test_common_share_then_first_disclosure_wins(spark):
    got = payout(spark, [row(stock="preferred", value=9.0, disclosed=Day(2021, 4, 1)), row(stock="unsplit", value=8.0, disclosed=Day(2021, 4, 1)), row(value=7.0, disclosed=None), row(value=5.0, receipt="s"), row(value=6.0, receipt="r"), row(value=4.0, disclosed=Day(2021, 4, 5), receipt="a"), row(entity=2, stock="preferred", value=1.0), row(entity=3, stock=None, value=2.0, disclosed=None)])
    assert {k: (r.dividends, r.dividend_source, r.dividend_available_from) for k, r in got.items()} == {(1, 2020): (6.0, "direct_total", Day(2021, 4, 5)), (3, 2020): (2.0, "direct_total", None)}


def test_totals_in_the_wrong_unit_fall_back_to_dps(spark):
    shares = [(e, 2020, 120, 20) for e in (1, 2, 3, 4, 5)]
    got = payout(spark, [
        row(value=51.0), row(item="dps", value=1.0),
        row(2, value=49.0), row(2, item="dps", value=1.0),
        row(3, value=-1.0), row(3, item="dps", value=2.0),
        row(4, text=" - "), row(4, item="dps", value=2.0),
        row(5, item="dps", text="-", disclosed=Day(2021, 4, 6)),
        row(6, item="dps", value=3.0),
    ], shares, unit=200.0)
    assert {k[0]: (r.dividends, r.dividend_source, r.dividend_available_from) for k, r in got.items()} == {
        1: (100.0, "dps_proxy", Day(2021, 4, 5)), 2: (9800.0, "direct_total", Day(2021, 4, 5)), 3: (200.0, "dps_proxy", Day(2021, 4, 5)),
        4: (0.0, "direct_total", Day(2021, 4, 5)), 5: (0.0, "dps_proxy", Day(2021, 4, 9)), 6: (None, "dps_proxy", Day(2021, 4, 5)),
    }


def test_buyback_takes_value_and_day_from_one_basis_and_the_later_day_counts(spark):
    buybacks = [(1, 2020, "C", 3.0, Day(2021, 4, 20)), (1, 2020, "S", 9.0, Day(2021, 4, 1)), (2, 2020, "C", None, Day(2021, 4, 20)), (2, 2020, "S", 9.0, Day(2021, 4, 1)), (3, 2020, "C", -1.0, Day(2021, 4, 1)), (3, 2020, "S", 5.0, Day(2021, 4, 1)), (9, 2020, "C", 5.0, Day(2021, 4, 1))]
    got = payout(spark, [row(e, value=10.0) for e in (1, 2, 3)], buybacks=buybacks)
    assert {k[0]: (r.buyback, r.payout, r.payout_available_from) for k, r in got.items()} == {1: (3.0, 13.0, Day(2021, 4, 20)), 2: (9.0, 19.0, Day(2021, 4, 5)), 3: (None, 10.0, Day(2021, 4, 5))}


def test_of_years_known_from_one_session_the_latest_stays(spark):
    got = payout(spark, [row(year=2018, value=1.0), row(year=2019, value=2.0), row(year=2020, value=3.0, disclosed=Day(2021, 4, 5)), row(year=2017, value=0.5, disclosed=Day(2021, 4, 9))])
    assert {k[1]: r.payout_available_from for k, r in got.items()} == {2019: Day(2021, 4, 5), 2020: Day(2021, 4, 6), 2017: None}
    assert payout(spark, []) == {}


def test_day_of_knowledge_follows_the_value_and_skips_nulls(spark):
    panel = spark.createDataFrame([(Day(2021, 1, d), 1, "A") for d in (1, 5, 9)] + [(None, 2, "A")], "date date, entity int, grp string")
    facts = spark.createDataFrame([(1, "x", Day(2021, 1, 3), 1.0), (1, "x", Day(2021, 1, 7), None), (1, "y", Day(2021, 1, 9), 2.0)], "entity int, code string, available_from date, value double")
    out = pit.pit_interval_join(panel, facts, by=["entity"], code="code", codes=["x", "y"], since=["x"])
    got = sorted((r.date, r.x, r.x_from, r.y) for r in out.collect() if r.date)
    assert got == [(Day(2021, 1, 1), None, None, None), (Day(2021, 1, 5), 1.0, Day(2021, 1, 3), None), (Day(2021, 1, 9), 1.0, Day(2021, 1, 3), 2.0)]


def test_scan_ages_use_the_chosen_basis_and_groups_have_their_own_scores(spark):
    panel = spark.createDataFrame([(Day(2021, 6, d), e, "A", 100.0, g) for d in (1, 2) for e, g in ((1, "p"), (2, "p"), (3, "q"), (4, "q"))], "date date, entity int, grp string, market_cap double, industry string")
    end = Day(2021, 3, 31)
    facts = [(e, b, c, end, False, Day(2021, 5, n), 10.0 * e) for e in range(1, 5) for b, n in (("C", 11), ("S", 21)) if b == "S" or e != 2 for c in ("net_income", "total_equity", "revenue", "total_assets")]
    facts += [(1, "C", "total_equity", end, True, Day(2021, 6, 2), 50.0)]
    facts = spark.createDataFrame(facts, "entity int, basis string, code string, period_end date, is_revision boolean, available_from date, value double")
    out = {(r.entity, r.date.day): r for r in D.fin_scan_features(panel, facts, ok=F.lit(True), by=["date", "grp", "industry"]).collect()}
    assert (out[1, 1].basis, out[1, 1].value_available_from, out[1, 1].value_age_days) == ("C", Day(2021, 5, 11), 21)
    assert (out[2, 1].basis, out[2, 1].value_available_from, out[2, 1].value_age_days) == ("S", Day(2021, 5, 21), 11)
    assert (out[1, 2].value_available_from, out[1, 2].value_age_days) == (Day(2021, 6, 2), 0)
    assert out[1, 1].profitability_available_from is None and out[1, 1].profitability_age_days is None
    assert out[1, 1].accruals_available_from == Day(2021, 5, 11) and out[1, 1].value_parts == 2
    # Two rows of a group: z-scores of +-1/sqrt(2); entities 2 and 3 would not be so in one cross-section of four.
    assert [round(out[e, 1].value_score, 6) for e in (1, 2, 3, 4)] == [-0.707107, 0.707107, -0.707107, 0.707107]
    assert out[3, 1].value_score_lag1 is None and out[3, 2].value_score_lag1 == out[3, 1].value_score


def test_portable_fingerprint_is_the_sum_of_md5_heads(spark):
    rows = [("a|b", 1, None), ("é", None, Day(2021, 1, 2)), ("", 2, None), ("", 2, None)]
    t = spark.createDataFrame(rows, "z string, a int, m date")
    text = lambda v: "N" if v is None else f"{len(str(v))}:{v}"
    want = sum(int(hashlib.md5((text(a) + text(m) + text(z)).encode()).hexdigest()[:15], 16) for z, a, m in rows)
    assert tuple(lake.table_fingerprint(t.repartition(3), portable=True).first()) == (4, str(want))
    assert tuple(lake.table_fingerprint(t.limit(0), portable=True).first()) == (0, None)
    with pytest.raises(ValueError):
        lake.table_fingerprint(t.withColumn("d", F.lit(1.5)), portable=True)
