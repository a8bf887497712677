"""Universe, price quality and price features; all windows of an entity share one partitioning and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import complete, is_halted, safe_ln, sdiv
from tidemark.keys import P, PanelKeys
from tidemark.operators import sliding
from tidemark.operators import windows as R
from tidemark.operators.sessions import valid_session_panel


def universe_flags(bars: DataFrame, *, warmup: int = 40, window: int = 60, liquidity: float = 0.0, min_close: float = 0.0, horizons: tuple[int, ...] = (5, 20), keys: PanelKeys = P) -> DataFrame:
    """Per session not_halted, warmup_ok (>= warmup valid of the last `window` rows), liquidity_ok (mean turnover of
    those), close_ok, label_ok_h (h valid sessions follow) and in_universe (all but the labels)."""
    w, path = keys.back(window - 1), keys.path()
    valid = ~is_halted()
    rows = bars.withColumn("not_halted", valid).withColumn("_t", F.when(valid, F.col("close") * F.col("volume")))
    ahead = F.sum(F.col("not_halted").cast("int")).over(path.rowsBetween(1, W.unboundedFollowing))
    flags = {
        "warmup_ok": F.sum(F.col("not_halted").cast("int")).over(w) >= warmup,
        "liquidity_ok": F.coalesce(F.avg("_t").over(w) >= liquidity, F.lit(False)),
        "close_ok": F.col("close") >= min_close,
        **{f"label_ok_{h}": F.col("not_halted") & F.coalesce(ahead >= h, F.lit(False)) for h in horizons},
    }
    rows = rows.withColumns(flags).drop("_t")
    return rows.withColumn("in_universe", F.col("not_halted") & F.col("warmup_ok") & F.col("liquidity_ok") & F.col("close_ok"))


def price_quality(bars: DataFrame, *, limits: list[tuple[str | None, str | None, float | None]], slack: float = 1.10, share_change: float = 0.25, keys: PanelKeys = P) -> DataFrame:
    """On valid sessions jump suspect (|simple return| > limit * slack; NULL without a limit), share change confirmed
    (shares move by share_change or more while price * share ratio stays in [.8, 1.25]), event and its running count.

    limits: (start, end, limit) by date. An unknown jump counts as an event. bars needs a `shares` column.
    """
    limit = F.lit(None).cast("double")
    for start, end, value in limits:
        inside = (F.lit(True) if start is None else F.col(keys.date) >= F.to_date(F.lit(start))) & (F.lit(True) if end is None else F.col(keys.date) < F.to_date(F.lit(end)))
        limit = F.when(inside, F.lit(value).cast("double")).otherwise(limit)
    rows = valid_session_panel(bars, keys).withColumn("share_ratio", sdiv("shares", F.lag("shares").over(keys.path())))
    rows = rows.withColumn("jump", F.abs("simple") > limit * slack)
    moved = (F.abs(F.col("share_ratio") - 1) >= share_change) & ((F.col("simple") + 1) * F.col("share_ratio")).between(0.8, 1.25)
    rows = rows.withColumn("share_changed", F.coalesce(moved, F.lit(False)))
    rows = rows.withColumn("event", F.coalesce("jump", F.lit(True)) | F.col("share_changed"))
    return rows.withColumn("events", R.cumulative_events("event", keys))


def publication_lag(facts: DataFrame, calendar: DataFrame, *, code: str, date: str, subject: str, others: list[str]) -> DataFrame:
    """Sessions by which one metric's latest date trails the latest of others."""
    last = facts.agg(F.max(F.when(F.col(code) == subject, F.col(date))).alias("subject_date"), F.max(F.when(F.col(code).isin(others), F.col(date))).alias("other_date"))
    days = calendar.select(F.col(date).alias("_d")).distinct()
    between = days.crossJoin(F.broadcast(last)).filter((F.col("_d") > F.col("subject_date")) & (F.col("_d") <= F.col("other_date"))).agg(F.count("*").alias("lag_sessions"))
    return last.crossJoin(between)


def mcap_distortion(panel: DataFrame, filings: DataFrame, *, session: str = "session", shares: str = "shares", move: float = 0.05, days: int = 120, keys: PanelKeys = P) -> DataFrame:
    """Sessions from an ex-rights filing's first session until the share count has moved by more than `move`
    from what it was then, for `days` days at most.

    filings: entity and session. The last filing's session and shares are carried along the entity's sessions.
    """
    marks = filings.select(keys.entity, F.col(session).alias(keys.date)).distinct().withColumn("_mark", F.lit(True))
    rows = panel.join(marks, [keys.entity, keys.date], "left")
    w = keys.path().rowsBetween(W.unboundedPreceding, 0)
    start = F.last(F.when(F.col("_mark"), F.struct(F.col(keys.date).alias("d"), F.col(shares).alias("s"))), ignorenulls=True).over(w)
    rows = rows.withColumn("_start", start)
    moved = F.abs(sdiv(shares, F.col("_start.s")) - 1) > move
    # Once moved since that filing, the flag stays down until the next one.
    since = W.partitionBy(keys.entity, keys.group, F.col("_start.d")).orderBy(keys.date).rowsBetween(W.unboundedPreceding, 0)
    done = F.coalesce(F.max(F.coalesce(moved, F.lit(False)).cast("int")).over(since) == 1, F.lit(False))
    inside = F.col("_start").isNotNull() & (F.datediff(keys.date, F.col("_start.d")) <= days)
    return rows.withColumn("distorted", inside & ~done).drop("_mark", "_start")


def market_cap_log(panel: DataFrame, distorted: str = "distorted", cap: str = "market_cap") -> DataFrame:
    """Log of the market cap, NULL where it is distorted."""
    return panel.withColumn("ln_cap", F.when(~F.coalesce(F.col(distorted), F.lit(False)), safe_ln(cap)))


def _masked(value: Column, rows: tuple[int, int] | None, keys: PanelKeys) -> Column:
    """NULL if an event fell into the rows first..last before the current one (0: the current row), by the running count `_events`."""
    if rows is None:
        return value
    first, last = rows
    upto = F.lag("_events", last).over(keys.path()) if last else F.col("_events")
    before = F.lag("_events", first + 1).over(keys.path())
    return F.when(F.coalesce(upto, F.lit(0)) == F.coalesce(before, F.lit(0)), value)


def price_features(valid: DataFrame, *, mask: bool = True, keys: PanelKeys = P) -> DataFrame:
    """Price features of valid sessions, each NULL where an event falls into its window, and their _lag1 variants.

    valid: valid-session panel, with a boolean `event` if mask. Residuals come from a regression on the group's mean
    return over the 252 prior rows.
    """
    rows = valid.withColumn("mkt", F.avg("ret").over(W.partitionBy(*keys.cross)))
    rows = R.rolling_regression(rows, "ret", "mkt", 252, keys).drop("slope", "intercept", "n_pairs")
    if mask:
        rows = rows.withColumn("_events", R.cumulative_events("event", keys))
    rows = sliding.order_statistics(rows, {"_high": ("max", "close", 251, 0), "_turn": ("median", "turnover", 60, 1)}, keys)
    path = keys.path()
    lag = lambda n: F.lag("close", n).over(path)
    there, square = F.col("residual").isNotNull().cast("int"), F.col("residual") * F.col("residual")
    rows = sliding.frame_sums(rows, {"_n_mom": (there, 252, 21), "_s_mom": ("residual", 252, 21), "_n_long": (there, 125, 0), "_n_vol": (there, 59, 0), "_s_vol": ("residual", 59, 0), "_q_vol": (square, 59, 0)}, keys)
    quiet = ((F.col("ret") == 0) | (F.col("volume") == 0)).cast("double")
    features = {
        "reversal_5d": (complete("ret", -F.sum("ret").over(keys.back(4)), keys.back(4), 5), (4, 0)),
        "mom_6_1": (F.ln(sdiv(lag(21), lag(126))), (252, 21)),
        "mom_12_1": (F.ln(sdiv(lag(21), lag(252))), (252, 21)),
        "resid_mom_12_1": (F.when(F.col("_n_mom") == 232, F.col("_s_mom")), (252, 21)),
        "near_52w_high": (sdiv("close", "_high") - 1, (251, 0)),
        "max_ret_20d": (F.max("simple").over(keys.back(19)), (19, 0)),
        "idio_vol_60d": (F.when(F.col("_n_long") == 126, sliding.deviation(F.col("_n_vol"), F.col("_s_vol"), F.col("_q_vol"))), (59, 0)),
        "turnover_shock": (safe_ln(sdiv("turnover", "_turn")), (60, 1)),
        "zero_return_ratio": (F.avg(F.coalesce(quiet, F.lit(0.0))).over(keys.back(19)), (19, 0)),
        "amihud_20d": (F.avg(sdiv(F.abs("ret"), "turnover")).over(keys.back(19)), None),
    }
    rows = rows.withColumns({k: _masked(v, n if mask else None, keys) for k, (v, n) in features.items()})
    rows = rows.withColumns({f"{k}_lag1": F.lag(k).over(path) for k in features})
    return rows.select(*keys.all, *features, *(f"{k}_lag1" for k in features))


def plain_price_features(bars: DataFrame, valid: DataFrame, *, keys: PanelKeys = P) -> DataFrame:
    """Returns, momentum, volatility, range, turnover, distance from the yearly high and halts over all rows; halted
    rows have no return and no turnover of their own, and count in every frame."""
    own = valid.select(*keys.all, F.col("ret").alias("ret_1d"), "turnover")
    rows = bars.join(own, keys.all, "left").withColumn("halted", is_halted())
    month = keys.back(19)
    since = lambda n: F.ln(sdiv("close", F.lag("close", n).over(keys.path())))
    return rows.select(
        *keys.all, "ret_1d", since(5).alias("ret_5d"), since(20).alias("ret_20d"), since(60).alias("ret_60d"), (since(20) - since(60)).alias("mom_20_60"),
        F.stddev_samp("ret_1d").over(month).alias("vol_20d"), F.stddev_samp("ret_1d").over(keys.back(59)).alias("vol_60d"),
        sdiv(F.max("high").over(month) - F.min("low").over(month), "close").alias("high_low_range_20d"),
        "turnover", F.avg("turnover").over(month).alias("turnover_ma20"),
        (sdiv("close", F.avg("close").over(month)) - 1).alias("gap_vs_ma20"), (sdiv("close", F.max("close").over(keys.back(251))) - 1).alias("dist_52w_high"),
        "halted", F.avg(F.col("halted").cast("double")).over(month).alias("halt_ratio_20d"),
    )


def flow_features(
    wide: DataFrame,
    panel: DataFrame,
    *,
    nets: dict[str, str],
    holding: str,
    floats: str,
    short_volume: str,
    short_balance: str,
    allowed: Column,
    available: Column,
    volume: str = "volume",
    windows: tuple[int, ...] = (5, 20, 60),
    month: int = 20,
    keys: PanelKeys = P,
) -> DataFrame:
    """Flows pivoted wide on valid sessions, with _lag1 of every feature.

    For each net flow sums, z-score and shares of the volume over complete windows; the ratio of the holding to the
    float and its changes; where short selling is allowed, its share of the volume over a complete month and, where its
    balance is available too, its ratio to the float, the change of that and the days to cover it; the proxy, over rows that
    have both: percent rank of the holding's monthly change less that of the short ratio.
    """
    path, w = keys.path(), keys.back(month - 1)
    rows = panel.join(wide, [keys.date, keys.entity], "left").withColumns({"_allowed": allowed, "_available": available})
    rows = rows.withColumns({"_held": sdiv(holding, floats), "_short": sdiv(short_balance, floats)})
    change = lambda c, n: F.col(c) - F.lag(c, n).over(path)

    def share(x: str, n: int) -> Column:
        frame = keys.back(n - 1)
        full = (F.count(x).over(frame) == n) & (F.count(volume).over(frame) == n)
        return F.when(full, sdiv(F.sum(x).over(frame), F.sum(volume).over(frame)))

    out: dict[str, Column] = {}
    for name, net in nets.items():
        for n in windows:
            out[f"{name}_sum_{n}"] = F.sum(net).over(keys.back(n - 1))
            out[f"{name}_to_volume_{n}"] = share(net, n)
        out[f"{name}_z_{month}"] = R.rolling_zscore(net, month, keys)
    known = F.col("_allowed") & F.col("_available")
    out |= {"holding_ratio": F.col("_held"), **{f"holding_ratio_chg_{n}": change("_held", n) for n in windows}}
    out |= {
        f"short_turnover_{month}": F.when(F.col("_allowed"), share(short_volume, month)),
        "short_interest_ratio": F.when(known, F.col("_short")),
        f"short_interest_ratio_chg_{month}": F.when(known, change("_short", month)),
        "days_to_cover": F.when(known, sdiv(short_balance, F.avg(volume).over(w))),
        "_moved": F.when(known & F.lag("_available", month).over(path), change("_held", month)),
    }
    rows = rows.withColumns(out)
    pair = F.col("_moved").isNotNull() & F.col("short_interest_ratio").isNotNull()
    by = W.partitionBy(*keys.cross, pair)
    rows = rows.withColumn("proxy", F.when(pair, F.percent_rank().over(by.orderBy("_moved")) - F.percent_rank().over(by.orderBy("short_interest_ratio"))))
    names = [c for c in (*out, "proxy") if c != "_moved"]
    rows = rows.withColumns({f"{c}_lag1": F.lag(c).over(path) for c in names})
    return rows.select(*keys.all, *names, *(f"{c}_lag1" for c in names))


def filing_activity(universe: DataFrame, filings: DataFrame, calendar: DataFrame, *, classes: dict[str, Column], session: str = "session", keys: PanelKeys = P) -> DataFrame:
    """Counts of filings by class on their first session; sums over 60 and 120 sessions with zero days; burst =
    count / rolling median of the 250 rows before where that is positive; amendment ratio over 250 sessions."""
    counts = filings.groupBy(F.col(keys.entity), F.col(session).alias(keys.date)).agg(F.count("*").alias("n_all"), *(F.count_if(c).alias(f"n_{k}") for k, c in classes.items()))
    names = ["n_all", *(f"n_{k}" for k in classes)]
    rows = universe.select(*keys.all).join(counts, [keys.entity, keys.date], "left").fillna(0, names)
    rows = sliding.frame_sums(rows, {f"{c}_{n}": (c, n - 1, 0) for c in names for n in (60, 120)} | {f"_{c}_250": (c, 249, 0) for c in names} | {"_before": (F.lit(1), 250, 1)}, keys)
    rows = sliding.order_statistics(rows, {"_med": ("median", "n_all_60", 250, 1)}, keys)
    rows = rows.withColumn("burst", F.when((F.col("_before") == 250) & (F.col("_med") > 0), sdiv("n_all_60", "_med")))
    for k in classes:
        rows = rows.withColumn(f"{k}_ratio_250", sdiv(f"_n_{k}_250", "_n_all_250"))
    return rows.drop("_before", "_med", *(f"_{c}_250" for c in names))
