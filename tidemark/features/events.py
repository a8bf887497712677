"""Facts with two times: which vintage was known when, what a filing's periods are, and what prices did around an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import sdiv
from tidemark.keys import P, PanelKeys
from tidemark.operators import pit
from tidemark.operators.sessions import with_next_session

#: Sessions after an event between which returns are measured.
EVENT_BUCKETS = ((0, 3), (3, 5), (5, 10), (10, 20), (20, 40), (40, 60))


def filing_period_ends(filings: DataFrame, tagged: DataFrame, settled: DataFrame, *, keys: Sequence[str], disclosed: str = "disclosed", fallback: str = "calendar_end") -> DataFrame:
    """Each filing's own period end, where that comes from, and whether its two sources disagree.

    filings: keys, disclosed, fallback; tagged: keys, period_end; settled: keys, settle. First choice is the latest tagged
    period that had ended when the filing was disclosed (all of them without a date), then the earliest settlement date,
    then the calendar's. One shuffle: the three inputs are put together by key.
    """
    rows = filings.select(*keys, F.col(disclosed).alias("_d"), F.col(fallback).alias("_c"), F.lit(1).alias("_f"))
    rows = rows.unionByName(tagged.select(*keys, F.col("period_end").alias("_t")), allowMissingColumns=True)
    rows = rows.unionByName(settled.select(*keys, F.col("settle").alias("_s")), allowMissingColumns=True)
    out = rows.groupBy(*keys).agg(F.max("_f").alias("_f"), F.max("_d").alias("_d"), F.max("_c").alias("_c"), F.collect_set("_t").alias("_t"), F.min("_s").alias("_s")).filter("_f = 1")
    own = F.array_max(F.filter("_t", lambda t: F.col("_d").isNull() | (t <= F.col("_d"))))
    out = out.withColumn("_o", own)
    return out.select(
        *keys,
        F.coalesce("_o", "_s", "_c").alias("period_end"),
        F.when(F.col("_o").isNotNull(), "tagged").when(F.col("_s").isNotNull(), "settled").otherwise("calendar").alias("period_end_source"),
        F.coalesce(F.col("_o") != F.col("_s"), F.lit(False)).alias("period_end_conflict"),
    )


def receipt_pairs(statements: DataFrame, tagged: DataFrame, *, keys: Sequence[str], prefer: str = "prefer", value: str = "value", tolerance: float = 0.0) -> DataFrame:
    """Statement values beside the tagged value of the same keys (receipt, concept, basis and period end among them).

    An interim filing tags both the quarter and the year to date; `prefer` says for each row whether the shortest or the longest
    duration is its counterpart. Ties go by context. tagged: keys, duration, context, value.
    """
    days, item = F.coalesce("duration", F.lit(0)), F.struct("context", value)
    best = tagged.groupBy(*keys).agg(F.min(F.struct(days.alias("o"), item.alias("i"))).alias("_short"), F.min(F.struct((-days).alias("o"), item.alias("i"))).alias("_long"))
    pick = F.when(F.col(prefer) == "longest", F.col("_long.i")).otherwise(F.col("_short.i"))
    out = statements.join(best, list(keys), "left").withColumn("_p", pick)
    out = out.withColumns({"paired_value": F.col("_p")[value], "paired_context": F.col("_p.context")})
    return out.withColumn("mismatch", F.abs(F.col(value) - F.col("paired_value")) > tolerance).drop("_short", "_long", "_p")


def filing_lineage(filings: DataFrame, *, keys: Sequence[str], receipt: str = "receipt", disclosed: str = "disclosed", matched: str = "matched", correction: str = "correction") -> DataFrame:
    """Original, revision or unknown, which only a matched receipt tells, and the receipt that counts of several on one day."""
    status = F.when(~F.coalesce(F.col(matched), F.lit(False)) | F.col(disclosed).isNull(), "unknown").when(F.col(correction), "revision").otherwise("original")
    return filings.withColumns({"lineage": status, "effective_receipt": F.max(receipt).over(W.partitionBy(*keys, disclosed))})


def reconciled_quarters(vintages: DataFrame, *, by: Sequence[str] = ("entity", "metric"), kind: str = "kind", order: Sequence[str] = ("is_revision", "available_from", "receipt"), tolerance: float = 0.0) -> DataFrame:
    """Vintages of all kinds of metrics to standalone quarters.

    One vintage of each (by, year, q) wins: the first by `order` (originals before revisions, then by availability). kind:
    direct (a quarter is filed as it is, the fourth is the year less the others; where the filing also reports the sum so
    far, `cumulative`, and that differs from the sum of the quarters by more than the tolerance, the quarter is NULL and
    `conflict` true), cumulative (differences), weighted (n * value - (n - 1) * the one before) or instant (as filed). A
    quarter is known when its last input is. Also lag4 (the exact quarter a year before) and, of direct and cumulative
    kinds, TTM with the day on which its four quarters are known.
    """
    carried = ("value", "available_from", "cumulative")
    win = vintages.groupBy(*by, kind, "year", "q").agg(F.min(F.struct(F.struct(*(F.coalesce(F.col(c), F.lit(False)) if c == "is_revision" else F.col(c) for c in order)).alias("o"), F.struct(*carried).alias("i"))).alias("_w"))
    wide = win.groupBy(*by, kind, "year").agg(*(F.max(F.when(F.col("q") == q, F.col("_w.i"))).alias(f"_{q}") for q in range(1, 5)))
    v, a, c = ({q: F.col(f"_{q}.{x}") for q in range(1, 5)} for x in carried)
    direct, cumulative, weighted, instant = (F.col(kind) == k for k in ("direct", "cumulative", "weighted", "instant"))

    def quarter(q: int) -> Column:
        before = v[1] if q == 2 else v[1] + v[2] if q == 3 else v[1] + v[2] + v[3]
        later = lambda x, *y: F.when(x.isNotNull(), F.greatest(x, *y))
        if q == 1:
            value, seen, there = v[1], a[1], v[1].isNotNull()
        else:
            value = F.when(cumulative, v[q] - v[q - 1]).when(weighted, q * v[q] - (q - 1) * v[q - 1]).when(direct, v[4] - before if q == 4 else v[q]).otherwise(v[q])
            seen = F.when(instant | direct & F.lit(q < 4), a[q]).when(direct, later(a[q], a[1], a[2], a[3])).otherwise(later(a[q], a[q - 1]))
            there = v[q].isNotNull() & (F.when(direct, F.lit(True) if q < 4 else before.isNotNull()).otherwise(v[q - 1].isNotNull()) | instant)
        derived = before + v[q] if q in (2, 3) else F.lit(None).cast("double")
        conflict = F.when(direct & c[q].isNotNull(), F.abs(derived - c[q]) > tolerance) if q in (2, 3) else F.lit(None).cast("boolean")
        there = F.when(instant, F.col(f"_{q}").isNotNull()).otherwise(there)
        return F.when(there, F.struct(F.lit(q).alias("q"), F.when(F.coalesce(conflict, F.lit(False)), None).otherwise(value).alias("standalone"), seen.alias("known_from"), conflict.alias("conflict"), F.when(direct, derived).alias("derived")))

    rows = wide.select(*by, kind, "year", F.explode(F.array_compact(F.array(*map(quarter, range(1, 5))))).alias("s")).select(*by, kind, "year", "s.*")
    rows = rows.withColumn("seq", F.col("year") * 4 + F.col("q"))
    w = W.partitionBy(*by, kind).orderBy("seq")
    full = (F.count("standalone").over(w.rangeBetween(-3, 0)) == 4) & F.col(kind).isin("direct", "cumulative")
    return rows.withColumns({
        "lag4": F.max("standalone").over(w.rangeBetween(-4, -4)),
        "ttm": F.when(full, F.sum("standalone").over(w.rangeBetween(-3, 0))),
        "ttm_known_from": F.when(full, F.max("known_from").over(w.rangeBetween(-3, 0))),
    })


#: Classes of share events and the sign with which they enter the identity.
CLASSES = {"economic_increase": 1, "mechanical_increase": 1, "economic_decrease": -1, "mechanical_decrease": -1, "unclassified": 0}


def issuance_by_vintage(positions: DataFrame, events: DataFrame, *, policy: str, by: str = "entity", tolerance: float = 0.0) -> DataFrame:
    """Net issuance of each year position from the vintage of the event table that the policy picks.

    positions: by, year, settle, shares, available_from; events: by, vintage, receipt, known_from, date, class, quantity, each
    vintage a whole list of events. `latest` reads the newest vintage (by vintage, then receipt) for all positions,
    `strict_pit` for each position the newest known on its own available_from (by known_from, receipt, vintage). A position
    without a vintage has no events, so its identity fails unless nothing changed.

    Both times are as-of lookups in one sorted stream each: by knowledge for the vintage, by event time on running sums for the
    events in (prior settle, settle]. Nothing is joined on a range.
    """
    if policy not in ("latest", "strict_pit"):
        raise ValueError(f"unknown policy {policy!r}")
    prior = W.partitionBy(by).orderBy("year").rangeBetween(-1, -1)
    rows = positions.withColumns({"prior_shares": F.max("shares").over(prior), "prior_settle": F.max("settle").over(prior)})
    each = events.groupBy(by, "vintage", "receipt").agg(F.max("known_from").alias("known_from"))
    if policy == "latest":
        newest = each.groupBy(by).agg(F.max(F.struct("vintage", "receipt", "known_from")).alias("_v"))
        rows = rows.join(newest, by, "left").withColumns({"vintage": F.col("_v.vintage"), "receipt": F.col("_v.receipt"), "vintage_known_from": F.col("_v.known_from")}).drop("_v")
    else:
        day = each.filter("known_from is not null").groupBy(by, "known_from").agg(F.max(F.struct("receipt", "vintage")).alias("_v"))
        day = day.select(by, F.col("known_from").alias("vintage_known_from"), "_v.vintage", "_v.receipt")
        rows = pit.fill_forward(rows, day, by=[by], date="available_from", known="vintage_known_from", values=["vintage", "receipt", "vintage_known_from"], struct=True)
    on = [by, "vintage", "receipt"]
    daily = events.filter("date is not null").groupBy(*on, "date").agg(*(F.sum(F.when(F.col("class") == k, F.col("quantity")).otherwise(0)).alias(k) for k in CLASSES))
    upto = W.partitionBy(*on).orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    running = daily.select(*on, F.col("date").alias("_from"), *(F.sum(k).over(upto).alias(k) for k in CLASSES))
    for end, mark in (("prior_settle", "_lo"), ("settle", "_hi")):
        rows = pit.fill_forward(rows, running, by=on, date=end, known="_from", values=list(CLASSES), struct=True)
        rows = rows.withColumns({f"{mark}_{k}": F.coalesce(k, F.lit(0)) for k in CLASSES}).drop(*CLASSES)
    inside = F.col("prior_settle").isNotNull()
    rows = rows.withColumns({k: F.when(inside, F.col(f"_hi_{k}") - F.col(f"_lo_{k}")).otherwise(F.lit(0)) for k in CLASSES})
    net = sum((s * F.col(k) for k, s in CLASSES.items() if s), F.lit(0))
    rows = rows.withColumn("identity_ok", F.abs(F.col("prior_shares") + net - F.col("shares")) <= tolerance)
    usable = (F.col("unclassified") == 0) & F.col("identity_ok") & (F.col("prior_shares") > 0)
    rows = rows.withColumn("net_issuance", F.when(usable, sdiv(F.col("economic_increase") - F.col("economic_decrease"), "prior_shares")))
    return rows.drop(*(f"{m}_{k}" for m in ("_lo", "_hi") for k in CLASSES))


def earnings_surprise(quarters: DataFrame, shares: DataFrame, *, by: Sequence[str] = ("entity",), prior: int = 8) -> DataFrame:
    """Per-share value and that of a year before, their change, and the change over the std of the `prior` changes before.

    quarters: by, year, q, seq, standalone, lag4; shares: by, year, q, shares, shares_lag4. A change is missing without all
    four numbers and such rows are left out, so they don't count as history; sue needs the full history and a spread.
    """
    rows = quarters.join(shares.select(*by, "year", "q", "shares", "shares_lag4"), [*by, "year", "q"])
    rows = rows.withColumns({"eps": sdiv("standalone", "shares"), "eps_before": sdiv("lag4", "shares_lag4")}).withColumn("change", F.col("eps") - F.col("eps_before")).filter("change is not null")
    before = W.partitionBy(*by).orderBy("seq").rowsBetween(-prior, -1)
    rows = rows.withColumns({"history": F.count("change").over(before), "_sd": F.stddev_samp("change").over(before)})
    return rows.withColumn("sue", F.when((F.col("history") >= prior) & (F.col("_sd") > 0), sdiv("change", "_sd"))).drop("_sd")


def event_study(events: DataFrame, sessions: DataFrame, revisions: DataFrame, *, event_keys: Sequence[str] = ("entity", "year", "q"), buckets: Sequence[tuple[int, int]] = EVENT_BUCKETS, within: int = 60, masked: str = "masked", keys: PanelKeys = P) -> DataFrame:
    """Events that became known on a session of their entity, with what followed.

    events: event_keys, available_from and any columns; sessions: the valid-session panel with v_idx, close and a flag of
    contaminating days; revisions: event_keys, available_from. Adds date, group, and for each bucket (a, b]: raw return between
    the sessions a and b after the event, excess over the mean of all names of that date and group, and whether a flagged
    session lies inside (a difference of running counts). Also whether a revision comes within so many sessions, and `primary`:
    all buckets there, none contaminated, no such revision.

    Leads and counts are one window over the panel; a date's means are an aggregate, and only event rows join them.
    """
    path = keys.path()
    offsets = sorted({o for ab in buckets for o in ab})
    seen = F.sum(F.when(F.col(masked), 1).otherwise(0)).over(path.rowsBetween(W.unboundedPreceding, 0))
    rows = sessions.select(*keys.all, "v_idx", "close", masked).withColumn("_n", seen)
    last = F.last("_n").over(path.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    at = {o: (F.col("close"), F.col("_n")) if o == 0 else (F.lead("close", o).over(path), F.coalesce(F.lead("_n", o).over(path), last)) for o in offsets}
    out = {}
    for a, b in buckets:
        out[f"raw_{a}_{b}"] = sdiv(at[b][0], at[a][0]) - 1
        out[f"hit_{a}_{b}"] = at[b][1] > at[a][1]
    rows = rows.select(*keys.all, "v_idx", *(c.alias(k) for k, c in out.items()))
    raw = [f"raw_{a}_{b}" for a, b in buckets]
    bench = rows.groupBy(*keys.cross).agg(*(F.avg(c).alias(c.replace("raw", "bench")) for c in raw))
    formed = events.join(rows.withColumn("available_from", F.col(keys.date)), [keys.entity, "available_from"])
    known = revisions.select(*event_keys, F.col("available_from").alias(keys.date)).join(sessions.select(*keys.all, F.col("v_idx").alias("_r")), [keys.entity, keys.date])
    ahead = formed.select(*event_keys, keys.group, "v_idx").join(known.select(*event_keys, "_r"), list(event_keys)).filter(F.col("_r") > F.col("v_idx")).groupBy(*event_keys, keys.group, "v_idx").agg(F.min("_r").alias("_r"))
    joined = formed.join(bench, keys.cross).join(ahead, [*event_keys, keys.group, "v_idx"], "left")
    joined = joined.withColumn("revised", F.coalesce(F.col("_r") - F.col("v_idx") <= within, F.lit(False)))
    clean = ~F.col("revised")
    for a, b in buckets:
        joined = joined.withColumn(f"excess_{a}_{b}", F.col(f"raw_{a}_{b}") - F.col(f"bench_{a}_{b}"))
        clean = clean & F.col(f"raw_{a}_{b}").isNotNull() & ~F.col(f"hit_{a}_{b}")
    return joined.withColumn("primary", clean).drop("_r")


def payout_positions(dividends: DataFrame, shares: DataFrame, buybacks: DataFrame, calendar: DataFrame, *, by: str = "entity", max_times: float = 100.0, unit: float = 1.0, session: str = "date") -> DataFrame:
    """Each year's dividends and twelve-month buyback, with the session from which both are known.

    dividends: entity, year, item ('total' in `unit`s or 'dps'), stock ('common', 'unsplit'; other classes don't count),
    disclosed, receipt, value, text. An item's winner is a common share's row before an unsplit one, then the first
    disclosed, then the least receipt, then the greatest value. A total counts if it is >= 0 and at most max_times what
    the DPS implies; a total of '-' is zero; else DPS times the shares outside the treasury; a DPS of '-' is zero.
    shares: entity, year, issued, treasury. buybacks: entity, year, basis ('C', 'S'), ttm, available_from; consolidated
    before separate, value and day from the same basis; a negative acquisition is no quantity of this feature.
    A source is known on the first session after its disclosure, and the payout when the later of its known parts is. Of
    several years known from one session the latest stays; positions without any day stay as the latest year, too.
    Nulls: an unknown stock class counts as unsplit; rows without entity or year are left out.
    """
    keys = [by, "year"]
    rank = F.when(F.col("stock") == "common", 0).when(F.coalesce("stock", F.lit("unsplit")) == "unsplit", 1)
    # The least struct wins; a missing day comes last, a missing value after all others.
    order = F.struct(rank.alias("rank"), F.col("disclosed").isNull().alias("undated"), "disclosed", "receipt", F.col("value").isNull().alias("unvalued"), (-F.col("value")).alias("_v"), "text")
    won = dividends.filter(rank.isNotNull() & F.col(by).isNotNull() & F.col("year").isNotNull()).groupBy(*keys).agg(*(F.min(F.when(F.col("item") == i, order)).alias(i) for i in ("total", "dps")))
    part = lambda i, c: -F.col(i)["_v"] if c == "value" else F.col(i)[c]
    held = shares.groupBy(*keys).agg(F.max("issued").alias("issued"), F.max("treasury").alias("treasury"))
    rows = won.join(held, keys, "left")
    implied = part("dps", "value") * (F.col("issued") - F.coalesce("treasury", F.lit(0)))
    direct = part("total", "value") * unit
    usable = F.coalesce((direct >= 0) & (implied.isNull() | (implied <= 0) | (direct <= max_times * implied)), F.lit(False))
    dash = lambda i: F.coalesce(F.trim(part(i, "text")) == "-", F.lit(False))
    cash = F.when(usable, direct).when(dash("total"), 0.0).when(implied.isNotNull(), implied).when(dash("dps"), 0.0)
    source = F.when(usable | dash("total"), "direct_total").when(part("dps", "value").isNotNull() | dash("dps"), "dps_proxy")
    rows = rows.select(*keys, cash.alias("dividends"), source.alias("dividend_source"), F.coalesce(part("total", "disclosed"), part("dps", "disclosed")).alias("_disclosed"))
    rows = with_next_session(rows, calendar, date="_disclosed", session=session, out="dividend_available_from").drop("_disclosed")

    whole = buybacks.filter("ttm is not null").groupBy(*keys).agg(*(F.max(F.when(F.col("basis") == b, F.struct("ttm", "available_from"))).alias(b) for b in "CS"))
    whole = whole.select(*keys, F.coalesce("C", "S").alias("_b")).filter("_b.ttm >= 0").select(*keys, F.col("_b.ttm").alias("buyback"), F.col("_b.available_from").alias("buyback_available_from"))
    rows = rows.join(whole, keys, "left").withColumns({
        "payout": F.when(F.col("dividends").isNotNull() | F.col("buyback").isNotNull(), F.coalesce("dividends", F.lit(0.0)) + F.coalesce("buyback", F.lit(0.0))),
        "payout_available_from": F.greatest("dividend_available_from", "buyback_available_from"),
    })
    latest = W.partitionBy(by, "payout_available_from")
    return rows.withColumn("_y", F.max("year").over(latest)).filter("year = _y").drop("_y")
