"""Vintages, quarters, issuance and event studies on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.features import events as V

D = dt.date


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_period_end_takes_the_latest_tagged_one_that_had_ended(spark):
    filings = spark.createDataFrame([(1, D(2020, 5, 15), D(2020, 3, 31)), (2, D(2020, 5, 15), D(2020, 3, 31)), (3, None, D(2020, 3, 31)), (4, D(2020, 5, 15), D(2020, 3, 31))], "receipt int, disclosed date, calendar_end date")
    tagged = spark.createDataFrame([(1, D(2019, 3, 31)), (1, D(2020, 3, 30)), (1, D(2020, 12, 31)), (3, D(2021, 1, 1)), (3, D(2020, 1, 1)), (4, D(2020, 12, 31)), (9, D(2020, 1, 1))], "receipt int, period_end date")
    settled = spark.createDataFrame([(1, D(2020, 3, 31)), (2, D(2020, 3, 29)), (2, D(2020, 3, 28)), (1, None)], "receipt int, settle date")
    got = rows(V.filing_period_ends(filings, tagged, settled, keys=["receipt"]), "receipt", "period_end", "period_end_source", "period_end_conflict")
    assert got == [(1, D(2020, 3, 30), "tagged", True), (2, D(2020, 3, 28), "settled", False), (3, D(2021, 1, 1), "tagged", False), (4, D(2020, 3, 31), "calendar", False)]


def test_pairs_prefer_the_asked_duration_and_break_ties_by_context(spark):
    st = spark.createDataFrame([(1, "short", 10.0), (1, "longest", 30.0), (2, "longest", 5.0)], "receipt int, prefer string, value double")
    tg = spark.createDataFrame([(1, 90, "b", 11.0), (1, 90, "a", 10.0), (1, 180, "c", 30.5), (1, None, "z", 10.0)], "receipt int, duration int, context string, value double")
    got = rows(V.receipt_pairs(st, tg, keys=["receipt"], tolerance=0.5), "receipt", "prefer", "paired_value", "paired_context", "mismatch")
    assert got == [(1, "longest", 30.5, "c", False), (1, "short", 10.0, "z", False), (2, "longest", None, None, None)]


FACTS = "entity int, metric string, kind string, year int, q int, is_revision boolean, available_from date, receipt int, value double, cumulative double"


def fact(kind, year, q, value, cumulative=None, revision=False, day=None, receipt=1):
    return (1, kind, kind, year, q, revision, day or D(year, q * 3, 28), receipt, value, cumulative)


def quarters(spark, facts):
    return {(r.kind, r.seq): r for r in V.reconciled_quarters(spark.createDataFrame(facts, FACTS)).collect()}


def test_direct_quarters_must_agree_with_the_reported_sum(spark):
    out = quarters(spark, [fact("direct", 2020, 1, 10.0), fact("direct", 2020, 2, 20.0, 30.0), fact("direct", 2020, 3, 5.0, 36.0), fact("direct", 2020, 4, 50.0)])
    got = {s - 8080: (r.standalone, r.conflict, r.derived) for (_, s), r in out.items()}
    assert got == {1: (10.0, None, None), 2: (20.0, False, 30.0), 3: (None, True, 35.0), 4: (15.0, None, None)}
    assert all(r.ttm is None for r in out.values())


def test_direct_quarters_need_no_earlier_one_but_the_fourth_does(spark):
    out = quarters(spark, [fact("direct", 2020, 2, 20.0, 30.0), fact("direct", 2020, 4, 50.0)])
    assert {s - 8080: (r.standalone, r.conflict) for (_, s), r in out.items()} == {2: (20.0, None)}


def test_first_original_wins_and_ttm_is_known_with_its_last_quarter(spark):
    facts = [fact("cumulative", y, q, 100.0 * y + 10 * q, day=D(y, q * 3, 28)) for y in (2020, 2021) for q in range(1, 5)]
    facts += [fact("cumulative", 2021, 1, 1.0, revision=True, day=D(2020, 1, 1)), fact("cumulative", 2021, 1, 2.0, day=D(2021, 6, 1)), fact("weighted", 2021, 1, 8.0), fact("weighted", 2021, 2, 9.0), fact("instant", 2021, 3, None), fact("instant", 2021, 2, 4.0)]
    out = quarters(spark, facts)
    assert out["cumulative", 2021 * 4 + 1].standalone == 202110.0 and out["cumulative", 2021 * 4 + 1].known_from == D(2021, 3, 28)
    q3 = out["cumulative", 2021 * 4 + 3]
    assert (q3.standalone, q3.lag4, q3.ttm, q3.ttm_known_from) == (10.0, 10.0, 202110.0 + 30.0, D(2021, 9, 28))
    assert out["cumulative", 2020 * 4 + 3].ttm is None
    assert out["weighted", 2021 * 4 + 2].standalone == 10.0
    assert out["instant", 2021 * 4 + 3].standalone is None and out["instant", 2021 * 4 + 2].standalone == 4.0


def issuance(spark, policy, positions, events):
    p = spark.createDataFrame(positions, "entity int, year int, settle date, shares long, available_from date")
    e = spark.createDataFrame(events, "entity int, vintage int, receipt int, known_from date, date date, class string, quantity long")
    return {(r.entity, r.year): r for r in V.issuance_by_vintage(p, e, policy=policy).collect()}


def test_issuance_reads_what_was_known_or_what_is_newest(spark):
    positions = [(1, y, D(y, 12, 31), s, D(y + 1, 3, 31)) for y, s in ((2019, 100), (2020, 110), (2021, 105))] + [(2, 2020, D(2020, 12, 31), 7, D(2021, 3, 31)), (2, 2021, D(2021, 12, 31), 7, None)]
    events = [
        (1, 2020, 1, D(2021, 3, 31), D(2020, 12, 31), "economic_increase", 10),  # on the settlement day: inside
        (1, 2020, 1, D(2021, 3, 31), D(2019, 12, 31), "economic_increase", 5),  # on the day before the span
        (1, 2021, 2, D(2022, 4, 1), D(2020, 12, 31), "economic_increase", 11),
        (1, 2021, 2, D(2022, 4, 1), D(2021, 6, 1), "economic_decrease", 5),
        (1, 2021, 2, D(2022, 4, 1), None, "economic_decrease", 500),
    ]
    strict, latest = (issuance(spark, p, positions, events) for p in ("strict_pit", "latest"))
    assert strict[1, 2020].net_issuance == 0.1 and strict[1, 2020].vintage == 2020
    assert not strict[1, 2021].identity_ok and strict[1, 2021].vintage == 2020 and strict[1, 2021].net_issuance is None
    assert not latest[1, 2020].identity_ok and latest[1, 2020].vintage == 2021
    assert abs(latest[1, 2021].net_issuance + 5 / 110) < 1e-12
    assert strict[1, 2019].identity_ok is None and latest[1, 2019].net_issuance is None
    assert strict[2, 2021].vintage is None and strict[2, 2021].identity_ok and strict[2, 2021].net_issuance == 0.0


def test_unclassified_events_void_the_position(spark):
    positions = [(1, 2019, D(2019, 12, 31), 100, D(2020, 3, 31)), (1, 2020, D(2020, 12, 31), 110, D(2021, 3, 31))]
    events = [(1, 2020, 1, D(2021, 3, 31), D(2020, 5, 1), "mechanical_increase", 10), (1, 2020, 1, D(2021, 3, 31), D(2020, 5, 1), "unclassified", 3)]
    r = issuance(spark, "strict_pit", positions, events)[1, 2020]
    assert r.identity_ok and r.unclassified == 3 and r.net_issuance is None
    with pytest.raises(ValueError, match="policy"):
        issuance(spark, "other", positions, events)


def test_surprise_needs_the_whole_history(spark):
    q = [(1, 2018 + i // 4, i % 4 + 1, i, float(i * i % 7 + i), float(i)) for i in range(12)]
    quarters_ = spark.createDataFrame(q, "entity int, year int, q int, seq int, standalone double, lag4 double")
    shares = spark.createDataFrame([(*r[:3], 2.0, 2.0 if r[3] != 3 else 0.0) for r in q], "entity int, year int, q int, shares double, shares_lag4 double")
    out = {r.seq: r for r in V.earnings_surprise(quarters_, shares).collect()}
    assert 3 not in out and len(out) == 11  # no shares a year before
    assert out[8].history == 7 and out[8].sue is None and out[9].history == 8 and out[9].sue is not None


def study(spark, masked=(), revised=None, n=70, event_day=2):
    days = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    sessions = spark.createDataFrame([(d, e, "A", i + 1, 100.0 + i * (e + 1), e == 0 and i in masked) for e in (0, 1) for i, d in enumerate(days)], "date date, entity int, grp string, v_idx int, close double, masked boolean")
    events = spark.createDataFrame([(0, 2020, 1, days[event_day], 5.0), (0, 2020, 2, D(2030, 1, 1), 6.0)], "entity int, year int, q int, available_from date, sue double")
    known = [] if revised is None else [(0, 2020, 1, days[revised]), (0, 2020, 1, days[0]), (0, 2020, 2, days[event_day + 1])]
    revisions = spark.createDataFrame(known, "entity int, year int, q int, available_from date")
    return V.event_study(events, sessions, revisions).collect()


def test_event_study_measures_from_the_session_of_the_event(spark):
    (r,) = study(spark)
    assert abs(r.raw_0_3 - 3 / 102) < 1e-12 and abs(r.excess_0_3 - (3 / 102 - (3 / 102 + 6 / 104) / 2)) < 1e-12
    assert abs(r.raw_40_60 - (162 / 142 - 1)) < 1e-12 and r.primary and not r.revised


@pytest.mark.parametrize(("day", "hit"), [(2, []), (3, ["0_3"]), (5, ["0_3"]), (6, ["3_5"]), (62, ["40_60"]), (63, [])])
def test_contamination_counts_sessions_after_the_start_up_to_the_end(spark, day, hit):
    (r,) = study(spark, masked=(day,))
    assert [f"{a}_{b}" for a, b in V.EVENT_BUCKETS if r[f"hit_{a}_{b}"]] == hit and r.primary == (not hit)


def test_missing_prices_and_revisions_keep_events_out_of_the_primary_sample(spark):
    (r,) = study(spark, masked=(64,), n=66, event_day=30)
    assert r.raw_20_40 is None and r.hit_20_40 and not r.hit_40_60 and not r.primary
    (late,), (soon,) = study(spark, revised=63), study(spark, revised=62)
    assert late.primary and not late.revised and soon.revised and not soon.primary
