"""Facts: rule-driven normalisation, vintages, quarters, fundamentals, issuance, payout, surprises, groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import sdiv
from tidemark.keys import P, PanelKeys
from tidemark.operators import pit
from tidemark.operators.joins import exact_period_lag, wildcard_rule_join
from tidemark.operators.sessions import with_next_session


def stock_pit(panel: DataFrame, shares: DataFrame, *, close: str = "close", keys: PanelKeys = P) -> DataFrame:
    """Shares known at t (latest eligible period), market cap, age in days, invalid and missing flags.

    shares: entity, period_end, available_from, shares.
    """
    facts = shares.withColumn("_known", F.col("available_from"))
    rows = pit.pit_latest_eligible(panel, facts, by=[keys.entity], order=["period_end", "_known", "shares"], values=["period_end", "shares"], date=keys.date)
    ok = F.coalesce(F.col("shares") > 0, F.lit(False))
    return rows.withColumns({
        "market_cap": F.when(ok, F.col(close) * F.col("shares")),
        "age_days": F.datediff(keys.date, "period_end"),
        "invalid": F.col("shares").isNotNull() & ~ok,
        "missing": F.col("shares").isNull(),
    })


#: Metric codes of fin_pit_features.
FIN_CODES = ("total_assets", "total_equity", "total_liabilities", "net_income", "controlling_net_income", "operating_cash_flow", "cash", "revenue", "operating_income")


def fin_pit_features(panel: DataFrame, facts: DataFrame, *, keys: PanelKeys = P) -> DataFrame:
    """Metrics known at t, wide, and their ratios; debt to equity only where equity is positive, and the return on
    equity of the controlling share where that is known.

    facts: entity, code (of FIN_CODES), period_end, available_from, is_revision, value.
    """
    rows = pit.pit_interval_join(panel, facts, by=[keys.entity], code="code", codes=FIN_CODES, date=keys.date, order=["period_end", "is_revision"])
    return rows.withColumns({
        "is_negative_equity": F.coalesce(F.col("total_equity") <= 0, F.lit(False)),
        "has_fs": F.col("total_assets").isNotNull(),
        "roa": sdiv("net_income", "total_assets"),
        "debt_to_equity": F.when(F.col("total_equity") > 0, sdiv("total_liabilities", "total_equity")),
        "equity_ratio": sdiv("total_equity", "total_assets"),
        "cfo_to_assets": sdiv("operating_cash_flow", "total_assets"),
        "cash_ratio": sdiv("cash", "total_assets"),
        "roe": sdiv(F.coalesce("controlling_net_income", "net_income"), "total_equity"),
        "asset_turnover": sdiv("revenue", "total_assets"),
        "operating_margin": sdiv("operating_income", "revenue"),
    })


#: Metric codes of fin_scan_features; the last is the value of four quarters before.
SCAN_CODES = ("net_income", "controlling_net_income", "total_equity", "operating_cash_flow", "revenue", "cogs", "gross_profit", "operating_income", "total_assets", "total_assets_lag4q")
#: Parts of the value score: what is divided by the market cap.
VALUE_PARTS = {"book_to_market": "total_equity", "earnings_yield": "controlling_net_income", "cfo_yield": "operating_cash_flow", "sales_to_price": "revenue"}
#: What must be known for a group of features: its day of knowledge is the latest of these.
SCAN_KNOWN = {"value": ("total_equity", "net_income"), "profitability": ("gross_profit",), "asset_growth": ("total_assets",), "accruals": ("net_income", "operating_cash_flow", "total_assets")}
#: Features that also come as of the entity's row before.
SCAN_LAGGED = ("log_mcap", "value_score", "gross_profitability", "operating_profitability", "asset_growth", "accruals")


def fin_scan_features(panel: DataFrame, facts: DataFrame, *, ok: Column, cap: str = "market_cap", min_parts: int = 2, by: Sequence[str] | None = None, clip: tuple[float, float] = (0.01, 0.99), keys: PanelKeys = P) -> DataFrame:
    """Value, profitability, growth and accruals of one basis, and the value score.

    The basis (consolidated if net income has that on the day, else separate) is chosen once for an entity and day and
    holds for all metrics; facts carry a `basis` of 'C' or 'S' and are known from available_from. Yields need `ok` (a
    priced, tradable row); assets are the mean of now and four quarters before. The score is the mean of at least
    min_parts yields (their number: value_parts), each winsorized and z-scored in its cross-section. For an
    industry-neutral score put the group into the panel and into `by`; a row without a group has a cross-section with
    the others of that kind.

    <group>_available_from of SCAN_KNOWN is the day from which the group's inputs are known, <group>_age_days the days
    since; unknown inputs are left out of it. The SCAN_LAGGED features come as <name>_lag1 too.
    """
    w = W.partitionBy(*(by or keys.cross))
    codes = [f"{b}_{c}" for c in SCAN_CODES for b in "CS"]
    dated = sorted({c for cs in SCAN_KNOWN.values() for c in cs})
    since = [f"{b}_{c}" for c in dated for b in "CS"]
    rows = pit.pit_interval_join(panel, facts.withColumn("code", F.concat_ws("_", "basis", "code")), by=[keys.entity], code="code", codes=codes, date=keys.date, order=["period_end", "is_revision"], since=since)
    whole = F.col("C_net_income").isNotNull()
    chosen = [*SCAN_CODES, *(f"{c}_from" for c in dated)]
    rows = rows.withColumns({c: F.when(whole, F.col(f"C_{c}")).otherwise(F.col(f"S_{c}")) for c in chosen} | {"basis": F.when(whole, "C").when(F.col("S_net_income").isNotNull(), "S")})
    priced = F.coalesce(ok & (F.col(cap) > 0), F.lit(False))
    both = (F.col("total_assets") > 0) & (F.col("total_assets_lag4q") > 0)
    rows = rows.withColumns({"_assets": F.when(both, (F.col("total_assets") + F.col("total_assets_lag4q")) / 2), "_gross": F.coalesce("gross_profit", F.col("revenue") - F.col("cogs"))})
    per_asset = lambda x: F.when(F.col("_assets") > 0, x / F.col("_assets"))
    rows = rows.withColumns({
        "negative_equity": F.coalesce(F.col("total_equity") <= 0, F.lit(False)),
        # The names of the two sources.
        "gross_profit_source": F.when(F.col("gross_profit").isNotNull(), "direct").when(F.col("_gross").isNotNull(), "revenue_minus_cogs_fallback"),
        "log_mcap": F.when(priced, F.ln(cap)),
        **{k: F.when(priced & (F.col("total_equity") > 0 if x == "total_equity" else F.lit(True)), F.col(x) / F.col(cap)) for k, x in VALUE_PARTS.items()},
        "gross_profitability": per_asset(F.col("_gross")),
        "operating_profitability": per_asset(F.col("operating_income")),
        "asset_growth": F.when(F.col("total_assets_lag4q") > 0, F.col("total_assets") / F.col("total_assets_lag4q") - 1),
        "accruals": per_asset(F.col("net_income") - F.col("operating_cash_flow")),
    })
    parts = []
    for x in VALUE_PARTS:
        lo, hi = (F.percentile(x, F.lit(q)).over(w) for q in clip)
        rows = rows.withColumn(f"_{x}", F.when(F.col(x).isNotNull(), F.least(F.greatest(x, lo), hi)))
        rows = rows.withColumn(f"{x}_z", sdiv(F.col(f"_{x}") - F.avg(f"_{x}").over(w), F.stddev_samp(f"_{x}").over(w))).drop(f"_{x}")
        parts.append(F.col(f"{x}_z"))
    known = sum((p.isNotNull().cast("int") for p in parts[1:]), parts[0].isNotNull().cast("int"))
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    latest = lambda cs: F.greatest(*(f"{c}_from" for c in cs)) if len(cs) > 1 else F.col(f"{cs[0]}_from")
    rows = rows.withColumns({"value_parts": known, "value_score": F.when(known >= min_parts, total / known)} | {f"{g}_available_from": latest(cs) for g, cs in SCAN_KNOWN.items()})
    rows = rows.withColumns({f"{g}_age_days": F.datediff(keys.date, f"{g}_available_from") for g in SCAN_KNOWN} | {f"{c}_lag1": F.lag(c).over(keys.path()) for c in SCAN_LAGGED})
    return rows.drop(*codes, *(f"{c}_from" for c in (*since, *dated)), "_assets", "_gross")


def share_event_flags(facts: DataFrame, *, by: Sequence[str] = ("entity",), lag_days: int = 90) -> DataFrame:
    """Per fiscal year treasury ratio, has treasury, exact year-on-year change of issued shares, known lag_days later."""
    return facts.withColumns({
        "treasury_ratio": sdiv("treasury", "issued"),
        "has_treasury": F.coalesce(F.col("treasury") > 0, F.lit(False)),
        "issued_yoy": sdiv("issued", exact_period_lag("issued", "year", 1, by)) - 1,
        "available_from": F.date_add("period_end", lag_days),
    })


def net_issuance(positions: DataFrame, events: DataFrame, *, increase: Column, decrease: Column, mechanical: Column, by: str = "entity") -> DataFrame:
    """Economic issuance between consecutive year positions, where the accounting identity holds.

    positions: entity, year, settle, shares; events: entity, date, quantity. Events in (prior settle, settle] are summed
    by class; prior + economic + mechanical - decrease must equal the current shares, without unclassified events.
    """
    w = W.partitionBy(by).orderBy("year").rangeBetween(-1, -1)
    spans = positions.withColumns({"prior_shares": F.max("shares").over(w), "prior_settle": F.max("settle").over(w)})
    kind = F.when(increase, "inc").when(decrease, "dec").when(mechanical, "mech").otherwise("other")
    classed = events.withColumn("_k", kind).select(by, F.col("date").alias("_d"), "_k", "quantity")
    # Each event belongs to one span: carry the span's end back to it instead of a range join.
    ends = spans.select(by, F.col("settle").alias("_d"), F.col("year").alias("_y"), "prior_settle")
    stream = classed.unionByName(ends, allowMissingColumns=True)
    ahead = W.partitionBy(by).orderBy("_d", F.col("_y").isNotNull()).rowsBetween(0, W.unboundedFollowing)
    placed = stream.withColumn("_to", F.first(F.when(F.col("_y").isNotNull(), F.struct("_y", "prior_settle")), ignorenulls=True).over(ahead)).filter("_y is null and _d > _to.prior_settle")
    sums = placed.groupBy(by, F.col("_to._y").alias("year")).agg(*(F.sum(F.when(F.col("_k") == k, F.col("quantity")).otherwise(0)).alias(k) for k in ("inc", "dec", "mech", "other")))
    out = spans.join(sums, [by, "year"], "left").fillna(0, ["inc", "dec", "mech", "other"])
    identity = (F.col("prior_shares") + F.col("inc") + F.col("mech") - F.col("dec") == F.col("shares")) & (F.col("other") == 0) & (F.col("prior_shares") > 0)
    return out.withColumn("identity_ok", F.coalesce(identity, F.lit(False))).withColumn("net_issuance", F.when(F.col("identity_ok"), sdiv(F.col("inc") - F.col("dec"), "prior_shares")))


def payout(rows: DataFrame, *, max_times: float = 100.0) -> DataFrame:
    """Dividends: the direct total where it is >= 0 and at most max_times what DPS * shares implies, else that product;
    a missing total is unknown, a '-' in the text is zero; plus buybacks."""
    implied = F.col("dps") * F.col("shares")
    direct = F.coalesce(F.col("total"), F.when(F.trim("total_text") == "-", 0.0))
    usable = direct.isNotNull() & (direct >= 0) & (implied.isNull() | (implied <= 0) | (direct <= max_times * implied))
    rows = rows.withColumn("dividends", F.when(usable, direct).otherwise(implied))
    return rows.withColumn("payout", F.when(F.col("dividends").isNotNull() | F.col("buyback").isNotNull(), F.coalesce("dividends", F.lit(0.0)) + F.coalesce("buyback", F.lit(0.0))))


def event_scan_daily(panel: DataFrame, issuance: DataFrame, payouts: DataFrame, *, cap: str = "market_cap", max_yield: float = 10.0, keys: PanelKeys = P) -> DataFrame:
    """Issuance and payout known at t, payout yield up to max_yield, and _lag1 variants.

    issuance: entity, available_from, net_issuance; payouts: entity, available_from, payout.
    """
    rows = pit.asof_backward(panel, issuance, by=[keys.entity], left_date=keys.date, right_date="available_from", values=["net_issuance"])
    rows = pit.asof_backward(rows, payouts, by=[keys.entity], left_date=keys.date, right_date="available_from", values=["payout"])
    y = F.when(F.col(cap) > 0, sdiv("payout", cap))
    rows = rows.withColumn("payout_yield", F.when(y <= max_yield, y))
    return rows.withColumns({f"{c}_lag1": F.lag(c).over(keys.path()) for c in ("net_issuance", "payout_yield")})


def normalize_metrics(sources: Sequence[DataFrame], rules: DataFrame, *, exact: Sequence[str], wild: Sequence[str], keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Candidates of all sources by wildcard rules, then one winner for each key by a total order."""
    rows = sources[0]
    for s in sources[1:]:
        rows = rows.unionByName(s, allowMissingColumns=True)
    found = wildcard_rule_join(rows, rules, exact, wild)
    best = found.groupBy(*keys).agg(F.min(F.struct(*order, *(c for c in values if c not in order))).alias("_b"))
    return best.select(*keys, *(F.col("_b")[c].alias(c) for c in values))


def metric_vintages(rows: DataFrame, calendar: DataFrame, *, keys: Sequence[str], disclosed: str, receipt: str, value: str) -> DataFrame:
    """One row for each captured vintage: number and lineage (original, revision, unknown without a date), whether its
    value differs from the vintage before, first session after disclosure, and whether a later vintage exists."""
    w = W.partitionBy(*keys).orderBy(F.col(disclosed).asc_nulls_first(), receipt)
    one = rows.dropDuplicates([*keys, receipt])
    out = one.withColumn("vintage", F.row_number().over(w)).withColumn("_before", F.lag(value).over(w))
    lineage = F.when(F.col(disclosed).isNull(), "unknown").when(F.col("vintage") == 1, "original").otherwise("revision")
    out = out.withColumns({"lineage": lineage, "changed": (F.col("vintage") > 1) & ~F.col(value).eqNullSafe(F.col("_before")), "superseded": F.col("vintage") < F.count("*").over(W.partitionBy(*keys))}).drop("_before")
    return with_next_session(out, calendar, date=disclosed, out="available_from")


def quarterize(facts: DataFrame, *, kind: str, by: Sequence[str] = ("entity",), value: str = "value", known: str = "available_from") -> DataFrame:
    """Filed values of quarters 1-4 to standalone quarters, with lag of four quarters and TTM.

    kind: cumulative (differences of consecutive filings), direct (the fourth is annual - Q1 - Q2 - Q3), weighted
    (n * value - (n - 1) * the one before), instant (as filed). A missing input gives NULL; a quarter is known when its
    last input is. facts: one row for each (by, year, q).
    """
    wide = facts.groupBy(*by, "year").agg(
        *(F.max(F.when(F.col("q") == q, F.col(value))).alias(f"_v{q}") for q in range(1, 5)),
        *(F.max(F.when(F.col("q") == q, F.col(known))).alias(f"_a{q}") for q in range(1, 5)),
    )
    v, a = ({q: F.col(f"_{c}{q}") for q in range(1, 5)} for c in "va")
    if kind == "cumulative":
        parts = {q: v[q] - v[q - 1] if q > 1 else v[1] for q in v}
        seen = {q: F.greatest(a[q], a[q - 1]) if q > 1 else a[1] for q in a}
    elif kind == "direct":
        parts = {**{q: v[q] for q in (1, 2, 3)}, 4: v[4] - v[1] - v[2] - v[3]}
        seen = {**{q: a[q] for q in (1, 2, 3)}, 4: F.greatest(a[1], a[2], a[3], a[4])}
    elif kind == "weighted":
        parts = {q: q * v[q] - (q - 1) * v[q - 1] if q > 1 else v[1] for q in v}
        seen = {q: F.greatest(a[q], a[q - 1]) if q > 1 else a[1] for q in a}
    else:
        parts, seen = v, a
    rows = wide.select(*by, "year", F.explode(F.array(*(F.struct(F.lit(q).alias("q"), parts[q].alias("standalone"), F.when(parts[q].isNotNull(), seen[q]).alias("known_from")) for q in range(1, 5)))).alias("s")).select(*by, "year", "s.*")
    rows = rows.withColumn("seq", F.col("year") * 4 + F.col("q"))
    w = W.partitionBy(*by).orderBy("seq")
    four = w.rangeBetween(-3, 0)
    full = F.count("standalone").over(four) == 4
    return rows.withColumns({
        "lag4": F.max("standalone").over(w.rangeBetween(-4, -4)),
        "ttm": F.when(full, F.sum("standalone").over(four)),
        "ttm_known_from": F.when(full, F.max("known_from").over(four)),
    })


def surprise_events(quarters: DataFrame, *, by: Sequence[str] = ("entity",), value: str = "standalone", prior: int = 8) -> DataFrame:
    """Seasonal change divided by the std of the `prior` seasonal changes before; needs all of them."""
    w = W.partitionBy(*by).orderBy("seq")
    rows = quarters.withColumn("change", F.col(value) - F.max(value).over(w.rangeBetween(-4, -4))).filter("change is not null")
    before = W.partitionBy(*by).orderBy("seq").rowsBetween(-prior, -1)
    return rows.withColumn("sue", F.when(F.count("change").over(before) == prior, sdiv("change", F.stddev_samp("change").over(before))))


def industry_groups(entities: DataFrame, code: str, *, min_size: int, sections: Column) -> DataFrame:
    """Two-digit prefix; groups below min_size fold into their section, those below it into OTHER; unknown codes are
    held out (NULL)."""
    rows = entities.withColumn("_p", F.when(F.length(code) >= 2, F.substring(code, 1, 2))).withColumn("_s", F.when(F.col("_p").isNotNull(), sections))
    small = rows.groupBy("_p").agg(F.count("*").alias("_np"))
    rows = rows.join(small, "_p", "left").withColumn("_fold", F.col("_np") < min_size)
    left = rows.filter("_fold").groupBy("_s").agg(F.count("*").alias("_ns"))
    rows = rows.join(left, "_s", "left")
    group = F.when(F.col("_p").isNull(), None).when(~F.col("_fold"), F.col("_p")).when(F.col("_ns") >= min_size, F.concat(F.lit("S:"), "_s")).otherwise("OTHER")
    return rows.withColumn("industry_group", group).drop("_p", "_s", "_np", "_fold", "_ns")
