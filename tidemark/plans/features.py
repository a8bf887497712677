"""Queries of features, facts, macro series and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.features import facts as D
from tidemark.features import macro as M
from tidemark.features import price as PR
from tidemark.functions.exprs import complete, formation_filter, is_halted, rounded
from tidemark.keys import P
from tidemark.operators import labels as L
from tidemark.operators import pit
from tidemark.operators import sessions as S
from tidemark.operators.aggregates import dedup_prefer, pivot_codes
from tidemark.plans.core import KEY, PATH, valid
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.registry import query


def rounded_all(df: DataFrame, digits: int = 5) -> DataFrame:
    return df.select(*(rounded(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query(
    "d02_universe_flags",
    f"""WITH x AS (SELECT *, NOT (open = 0 AND high = 0 AND low = 0) AS ok FROM bars),
    y AS (SELECT *, CASE WHEN ok THEN 1 ELSE 0 END AS k, CASE WHEN ok THEN close * volume END AS t FROM x)
    SELECT date, entity, grp, ok AS not_halted, sum(k) OVER w >= 40 AS warmup_ok, coalesce(avg(t) OVER w >= 50000, false) AS liquidity_ok, close >= 900 AS close_ok,
           ok AND coalesce(sum(k) OVER ({PATH} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) >= 5, false) AS label_ok_5,
           ok AND sum(k) OVER w >= 40 AND coalesce(avg(t) OVER w >= 50000, false) AND close >= 900 AS in_universe
    FROM y WINDOW w AS ({PATH} ROWS 59 PRECEDING)""",
    "bars",
)
def _(f):
    out = PR.universe_flags(f.bars, liquidity=50000.0, min_close=900.0, horizons=(5,))
    return out.select(*KEY, "not_halted", "warmup_ok", "liquidity_ok", "close_ok", "label_ok_5", "in_universe")


def share_counts(f: Fixtures) -> DataFrame:
    """Share counts by quarter, from the cumulative facts."""
    return f.vintages.filter("not is_revision").select("entity", "period_end", "available_from", F.floor(F.col("value") / 1000).cast("long").alias("shares"))


SHARES = "SELECT entity, period_end, available_from, CAST(floor(value / 1000) AS BIGINT) AS shares FROM vintages WHERE NOT is_revision"


@query(
    "d03_stock_pit",
    f"""WITH s AS ({SHARES}), j AS (
      SELECT b.date, b.entity, b.grp, b.close, s.period_end, s.shares, row_number() OVER (PARTITION BY b.date, b.entity, b.grp ORDER BY s.period_end DESC NULLS LAST, s.available_from DESC, s.shares DESC) AS n
      FROM bars b LEFT JOIN s ON s.entity = b.entity AND s.available_from <= b.date)
    SELECT date, entity, grp, shares, round(CASE WHEN shares > 0 THEN close * shares END, 2) AS market_cap, CAST(datediff('day', period_end, date) AS INTEGER) AS age_days,
           shares IS NOT NULL AND NOT coalesce(shares > 0, false) AS invalid, shares IS NULL AS missing FROM j WHERE n = 1""",
    "bars vintages",
)
def _(f):
    return D.stock_pit(f.bars, share_counts(f)).select(*KEY, "shares", rounded("market_cap", 2).alias("market_cap"), "age_days", "invalid", "missing")


LIMITS = [(None, "1997-06-15", None), ("1997-06-15", "1999-06-15", 0.5), ("1999-06-15", None, 1.0)]


def quality(f: Fixtures) -> DataFrame:
    return PR.price_quality(f.bars.withColumn("shares", F.col("volume")), limits=LIMITS)


QUALITY = f"""q0 AS (SELECT *, volume / nullif(lag(volume) OVER ({PATH}), 0)::DOUBLE AS sr,
      CASE WHEN date >= DATE '1999-06-15' THEN 1.0 WHEN date >= DATE '1997-06-15' THEN 0.5 END AS lim FROM valid),
    q1 AS (SELECT *, abs(simple) > lim * 1.10 AS jump, coalesce(abs(sr - 1) >= 0.25 AND (simple + 1) * sr BETWEEN 0.8 AND 1.25, false) AS share_changed FROM q0),
    q2 AS (SELECT *, coalesce(jump, true) OR share_changed AS event FROM q1)"""


@query("d04_price_quality", f"WITH {QUALITY} SELECT date, entity, grp, jump, share_changed, event, CAST(sum(CASE WHEN event THEN 1 ELSE 0 END) OVER ({PATH}) AS BIGINT) AS events FROM q2", "valid")
def _(f):
    return quality(f).select(*KEY, "jump", "share_changed", "event", "events")


@query(
    "d05_publication_lag",
    """WITH l AS (SELECT max(CASE WHEN kind = '5-LOW' THEN receipt_date END) AS subject_date, max(CASE WHEN kind IN ('1-URGENT', '2-HIGH') THEN receipt_date END) AS other_date FROM filings WHERE NOT (kind = '5-LOW' AND receipt_date > DATE '2001-06-30'))
    SELECT *, (SELECT count(DISTINCT receipt_date) FROM filings WHERE receipt_date > subject_date AND receipt_date <= other_date) AS lag_sessions FROM l""",
    "filings",
)
def _(f):
    facts = f.filings.filter("not (kind = '5-LOW' and receipt_date > date '2001-06-30')")
    return PR.publication_lag(facts, f.filings, code="kind", date="receipt_date", subject="5-LOW", others=["1-URGENT", "2-HIGH"])


def distorted(f: Fixtures) -> DataFrame:
    marks = f.filings.filter("kind = '1-URGENT' and status = 'O'").select("entity", "receipt_date")
    marks = S.with_next_session(marks, f.bars.select("date"), date="receipt_date")
    return PR.mcap_distortion(D.stock_pit(f.bars, share_counts(f)), marks)


STOCK = f"""s AS ({SHARES}), stock AS (SELECT * FROM (
      SELECT b.date, b.entity, b.grp, s.shares, CASE WHEN s.shares > 0 THEN b.close * s.shares END AS market_cap, row_number() OVER (PARTITION BY b.date, b.entity, b.grp ORDER BY s.period_end DESC NULLS LAST, s.available_from DESC, s.shares DESC) AS n
      FROM bars b LEFT JOIN s ON s.entity = b.entity AND s.available_from <= b.date) WHERE n = 1)"""
DISTORTED = f"""{STOCK}, days AS (SELECT DISTINCT date FROM bars),
    marks AS (SELECT DISTINCT entity, (SELECT min(date) FROM days WHERE date > receipt_date) AS date FROM filings WHERE kind = '1-URGENT' AND status = 'O'),
    st AS (SELECT stock.*, last_value(CASE WHEN m.entity IS NOT NULL THEN {{'d': stock.date, 's': shares}} END IGNORE NULLS) OVER (PARTITION BY stock.entity, grp ORDER BY stock.date ROWS UNBOUNDED PRECEDING) AS st
      FROM stock LEFT JOIN marks m ON m.entity = stock.entity AND m.date = stock.date),
    dn AS (SELECT *, coalesce(max(CASE WHEN abs(shares / nullif(st.s, 0)::DOUBLE - 1) > 0.05 THEN 1 ELSE 0 END) OVER (PARTITION BY entity, grp, st.d ORDER BY date ROWS UNBOUNDED PRECEDING) = 1, false) AS done FROM st),
    dist AS (SELECT *, st IS NOT NULL AND coalesce(datediff('day', st.d, date) <= 120, false) AND NOT done AS distorted FROM dn)"""


@query("d06_mcap_distortion", f"WITH {DISTORTED} SELECT date, entity, grp, distorted FROM dist", "bars vintages filings")
def _(f):
    return distorted(f).select(*KEY, "distorted")


@query("d07_market_cap_log", f"WITH {DISTORTED} SELECT date, entity, grp, round(CASE WHEN NOT distorted AND market_cap > 0 THEN ln(market_cap) END, 6) AS ln_cap FROM dist", "bars vintages filings")
def _(f):
    return PR.market_cap_log(distorted(f)).select(*KEY, rounded("ln_cap").alias("ln_cap"))


#: Features of D08 with the digits that they are compared to.
PRICE_DIGITS = {"reversal_5d": 5, "mom_6_1": 4, "mom_12_1": 4, "resid_mom_12_1": 4, "near_52w_high": 5, "max_ret_20d": 5, "idio_vol_60d": 4, "turnover_shock": 4, "zero_return_ratio": 5, "amihud_20d": 4}


@query(
    "d08_price_features",
    f"""WITH {QUALITY}, m0 AS (SELECT *, CASE WHEN event THEN 1 ELSE 0 END AS ev, avg(ret) OVER (PARTITION BY date, grp) AS mkt FROM q2),
    m AS (SELECT *, CASE WHEN regr_count(ret, mkt) OVER w = 252 THEN ret - (regr_intercept(ret, mkt) OVER w + regr_slope(ret, mkt) OVER w * mkt) END AS residual FROM m0 WINDOW w AS ({PATH} ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)),
    x AS (SELECT date, entity, grp,
      round(CASE WHEN max(ev) OVER w5 = 0 AND count(ret) OVER w5 = 5 THEN -sum(ret) OVER w5 END, 5) + 0.0 AS reversal_5d,
      round(CASE WHEN coalesce(max(ev) OVER s21, 0) = 0 THEN ln(lag(close, 21) OVER p / lag(close, 126) OVER p) END, 4) + 0.0 AS mom_6_1,
      round(CASE WHEN coalesce(max(ev) OVER s21, 0) = 0 THEN ln(lag(close, 21) OVER p / lag(close, 252) OVER p) END, 4) + 0.0 AS mom_12_1,
      round(CASE WHEN coalesce(max(ev) OVER s21, 0) = 0 AND count(residual) OVER s21 = 232 THEN sum(residual) OVER s21 END, 4) + 0.0 AS resid_mom_12_1,
      round(CASE WHEN max(ev) OVER w252 = 0 THEN close / max(close) OVER w252 - 1 END, 5) + 0.0 AS near_52w_high,
      round(CASE WHEN max(ev) OVER w20 = 0 THEN max(simple) OVER w20 END, 5) + 0.0 AS max_ret_20d,
      round(CASE WHEN max(ev) OVER w60 = 0 AND count(residual) OVER ({PATH} ROWS 125 PRECEDING) = 126 THEN stddev_samp(residual) OVER w60 END, 4) + 0.0 AS idio_vol_60d,
      round(CASE WHEN coalesce(max(ev) OVER b60, 0) = 0 THEN ln(nullif(turnover, 0) / nullif(median(turnover) OVER b60, 0)) END, 4) + 0.0 AS turnover_shock,
      round(CASE WHEN max(ev) OVER w20 = 0 THEN avg(CASE WHEN ret = 0 OR volume = 0 THEN 1.0 ELSE 0.0 END) OVER w20 END, 5) + 0.0 AS zero_return_ratio,
      round(avg(abs(ret) / nullif(turnover, 0)) OVER w20 * 1e6, 4) + 0.0 AS amihud_20d
      FROM m WINDOW p AS ({PATH}), w5 AS ({PATH} ROWS 4 PRECEDING), w20 AS ({PATH} ROWS 19 PRECEDING), w60 AS ({PATH} ROWS 59 PRECEDING), w252 AS ({PATH} ROWS 251 PRECEDING),
        s21 AS ({PATH} ROWS BETWEEN 252 PRECEDING AND 21 PRECEDING), b60 AS ({PATH} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING))
    SELECT *, {", ".join(f"lag({c}) OVER ({PATH}) AS {c}_lag1" for c in PRICE_DIGITS)} FROM x""",
    "valid",
)
def _(f):
    out = PR.price_features(quality(f))
    scaled = lambda c: F.col(c) * 1e6 if c.startswith("amihud") else F.col(c)
    return out.select(*KEY, *(rounded(scaled(c + lag), d).alias(c + lag) for c, d in PRICE_DIGITS.items() for lag in ("", "_lag1")))


@query(
    "d08_plain_price_features",
    f"""SELECT date, entity, grp, round(ret, 5) + 0.0 AS ret_1d, round(ln(close / lag(close, 5) OVER p), 5) + 0.0 AS ret_5d, round(ln(close / lag(close, 20) OVER p), 5) + 0.0 AS ret_20d,
      round(ln(close / lag(close, 60) OVER p), 5) + 0.0 AS ret_60d, round(ln(close / lag(close, 20) OVER p) - ln(close / lag(close, 60) OVER p), 5) + 0.0 AS mom_20_60,
      round(stddev_samp(ret) OVER w20, 5) AS vol_20d, round(stddev_samp(ret) OVER ({PATH} ROWS 59 PRECEDING), 5) AS vol_60d,
      round((max(high) OVER w20 - min(low) OVER w20) / nullif(close, 0), 5) AS high_low_range_20d, round(turnover, 5) AS turnover, round(ln(avg(turnover) OVER w20), 5) AS ln_turnover_ma20,
      round(close / avg(close) OVER w20 - 1, 5) + 0.0 AS gap_vs_ma20, round(close / max(close) OVER ({PATH} ROWS 251 PRECEDING) - 1, 5) + 0.0 AS dist_52w_high,
      halted, round(avg(CASE WHEN halted THEN 1.0 ELSE 0.0 END) OVER w20, 5) AS halt_ratio_20d
    FROM (SELECT b.*, v.ret, v.turnover, b.open = 0 AND b.high = 0 AND b.low = 0 AS halted FROM bars b LEFT JOIN valid v ON v.date = b.date AND v.entity = b.entity AND v.grp = b.grp)
    WINDOW p AS ({PATH}), w20 AS ({PATH} ROWS 19 PRECEDING)""",
    "bars valid",
)
def _(f):
    out = PR.plain_price_features(f.bars, valid(f))
    return rounded_all(out.withColumn("ln_turnover_ma20", F.ln("turnover_ma20")).drop("turnover_ma20"))


@query(
    "f09_formation_filter",
    f"""WITH x AS (SELECT *, CASE WHEN count(ret) OVER w = 5 THEN -sum(ret) OVER w END AS rev, lead(close, 5) OVER p / close - 1 AS fwd, lead(close, 20) OVER p AS far, coalesce(abs(simple) > 0.9, true) AS event
      FROM valid WINDOW p AS ({PATH}), w AS ({PATH} ROWS 4 PRECEDING)),
    y AS (SELECT * FROM x WHERE date >= DATE '1995-06-01' AND volume >= 20 AND rev IS NOT NULL AND NOT event AND fwd IS NOT NULL)
    SELECT 'available' AS sample, date, entity, grp, round(rev, 5) + 0.0 AS feature_value, round(fwd, 5) + 0.0 AS fwd FROM y
    UNION ALL SELECT 'common_survivor', date, entity, grp, round(rev, 5) + 0.0, round(fwd, 5) + 0.0 FROM y WHERE far IS NOT NULL AND grp = 'A'""",
    "valid",
)
def _(f):
    w, path = P.back(4), P.path()
    rows = valid(f).withColumns({
        "rev": complete("ret", -F.sum("ret").over(w), w, 5), "fwd": F.lead("close", 5).over(path) / F.col("close") - 1,
        "lives": F.lead("close", 20).over(path).isNotNull(), "event": F.coalesce(F.abs("simple") > 0.9, F.lit(True)), "traded": F.col("volume") >= 20,
    }).withColumn("fwd_ok", F.col("fwd").isNotNull())
    cell = {"feature": "rev", "targets": ["fwd"], "label_ok": "fwd_ok", "universe": "traded", "start": "1995-06-01"}
    a = formation_filter(rows, **cell).withColumn("sample", F.lit("available"))
    b = formation_filter(rows, **cell, sample="common_survivor", common=["lives"], where="grp = 'A'").withColumn("sample", F.lit("common_survivor"))
    return rounded_all(a.unionByName(b).select("sample", *KEY, "feature_value", "fwd"))


@query(
    "d08_price_momentum",
    f"""WITH m AS (SELECT *, avg(ret) OVER (PARTITION BY date, grp) AS mkt FROM valid),
    r AS (SELECT *, CASE WHEN regr_count(ret, mkt) OVER w = 252 THEN ret - (regr_intercept(ret, mkt) OVER w + regr_slope(ret, mkt) OVER w * mkt) END AS residual FROM m WINDOW w AS ({PATH} ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING))
    SELECT date, entity, grp, round(ln(lag(close, 21) OVER ({PATH}) / lag(close, 252) OVER ({PATH})), 4) + 0.0 AS mom_12_1,
      round(close / max(close) OVER ({PATH} ROWS 251 PRECEDING) - 1, 5) + 0.0 AS near_52w_high,
      round(CASE WHEN count(residual) OVER ({PATH} ROWS 125 PRECEDING) = 126 THEN stddev_samp(residual) OVER ({PATH} ROWS 59 PRECEDING) END, 4) AS idio_vol_60d,
      round(ln(turnover / median(turnover) OVER ({PATH} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)), 4) + 0.0 AS turnover_shock FROM r""",
    "valid",
)
def _(f):
    out = PR.price_features(valid(f), mask=False)
    return out.select(*KEY, *(rounded(c, d).alias(c) for c, d in (("mom_12_1", 4), ("near_52w_high", 5), ("idio_vol_60d", 4), ("turnover_shock", 4))))


def user_panel(f: Fixtures) -> DataFrame:
    """A panel over the flows: a row for each date and entity with any flow, in two groups."""
    days = f.flows.select("date", "entity").distinct()
    return days.withColumns({"grp": F.when(F.pmod("entity", F.lit(2)) == 0, "A").otherwise("B"), "volume": 10 + F.pmod(F.col("entity") + F.day("date"), F.lit(50))})


FLOWS = {"click": "net", "signup": "inst", "view": "holding", "purchase": "short_volume", "error": "short_balance"}
WIDE = f"""wide AS (SELECT date, entity, {", ".join(f"max(CASE WHEN metric = '{m}' THEN value END) AS {c}" for m, c in FLOWS.items())}
      FROM (SELECT *, row_number() OVER (PARTITION BY date, entity, metric ORDER BY source, event_id DESC) AS n FROM flows) WHERE n = 1 GROUP BY 1, 2)"""


def flow_sql(net: str) -> str:
    both = f"count({net}) OVER w{{0}} = {{0}} AND count(volume) OVER w{{0}} = {{0}}"
    each = [f"sum({net}) OVER w{n} AS {net}_sum_{n}, CASE WHEN {both.format(n)} THEN sum({net}) OVER w{n} / nullif(sum(volume) OVER w{n}, 0) END AS {net}_to_volume_{n}" for n in (2, 5)]
    return ", ".join([*each, f"({net} - avg({net}) OVER w3) / nullif(stddev_samp({net}) OVER w3, 0) AS {net}_z_3"])


FLOW_NAMES = [
    *(f"{net}_{x}" for net in ("net", "inst") for x in ("sum_2", "to_volume_2", "sum_5", "to_volume_5", "z_3")),
    "holding_ratio", "holding_ratio_chg_2", "holding_ratio_chg_5", "short_turnover_3", "short_interest_ratio", "short_interest_ratio_chg_3", "days_to_cover", "proxy",
]


@query(
    "d09_flow_features",
    f"""WITH {WIDE}, p0 AS (SELECT DISTINCT date, entity, CASE WHEN entity % 2 = 0 THEN 'A' ELSE 'B' END AS grp, 10 + (entity + day(date)) % 50 AS volume, CAST(1009 + 90 * (entity % 7) AS DOUBLE) AS floats FROM flows),
    r AS (SELECT p0.*, net, inst, short_volume, short_balance, holding / floats AS held, short_balance / floats AS short, day(date) % 5 <> 0 AS allowed, (day(date) + entity) % 7 <> 0 AS available FROM p0 LEFT JOIN wide USING (date, entity)),
    x AS (SELECT date, entity, grp, {flow_sql("net")}, {flow_sql("inst")}, held AS holding_ratio, held - lag(held, 2) OVER p AS holding_ratio_chg_2, held - lag(held, 5) OVER p AS holding_ratio_chg_5,
      CASE WHEN allowed AND count(short_volume) OVER w3 = 3 AND count(volume) OVER w3 = 3 THEN sum(short_volume) OVER w3 / nullif(sum(volume) OVER w3, 0) END AS short_turnover_3,
      CASE WHEN allowed AND available THEN short END AS short_interest_ratio, CASE WHEN allowed AND available THEN short - lag(short, 3) OVER p END AS short_interest_ratio_chg_3,
      CASE WHEN allowed AND available THEN short_balance / nullif(avg(volume) OVER w3, 0) END AS days_to_cover,
      CASE WHEN allowed AND available AND lag(available, 3) OVER p THEN held - lag(held, 3) OVER p END AS moved
      FROM r WINDOW p AS ({PATH}), w2 AS ({PATH} ROWS 1 PRECEDING), w3 AS ({PATH} ROWS 2 PRECEDING), w5 AS ({PATH} ROWS 4 PRECEDING)),
    k AS (SELECT date, entity, grp, percent_rank() OVER (PARTITION BY date, grp ORDER BY moved) - percent_rank() OVER (PARTITION BY date, grp ORDER BY short_interest_ratio) AS proxy
      FROM x WHERE moved IS NOT NULL AND short_interest_ratio IS NOT NULL),
    y AS (SELECT x.*, k.proxy FROM x LEFT JOIN k USING (date, entity, grp))
    SELECT date, entity, grp, {", ".join(f"round({c}, 5) + 0.0 AS {c}, round(lag({c}) OVER ({PATH}), 5) + 0.0 AS {c}_lag1" for c in FLOW_NAMES)} FROM y""",
    "flows",
)
def _(f):
    one = dedup_prefer(f.flows, ["date", "entity", "metric"], "source", ["P", "S"], [F.desc("event_id")])
    wide = pivot_codes(one, ["date", "entity"], "metric", "value", list(FLOWS)).withColumnsRenamed(FLOWS)
    panel = user_panel(f).withColumn("floats", (1009 + 90 * F.pmod("entity", F.lit(7))).cast("double"))
    out = PR.flow_features(
        wide, panel, nets={"net": "net", "inst": "inst"}, holding="holding", floats="floats", short_volume="short_volume", short_balance="short_balance",
        allowed=F.day("date") % 5 != 0, available=(F.day("date") + F.col("entity")) % 7 != 0, windows=(2, 5), month=3,
    )
    return rounded_all(out)


@query(
    "d10_filing_activity",
    f"""WITH days AS (SELECT DISTINCT date FROM bars), s AS (SELECT entity, (SELECT min(date) FROM days WHERE date > receipt_date) AS date, kind FROM filings),
    c AS (SELECT entity, date, count(*) AS n_all, count(*) FILTER (kind = '4-NOT SPECIFIED') AS n_amend FROM s GROUP BY 1, 2),
    r AS (SELECT b.date, b.entity, b.grp, coalesce(n_all, 0) AS n_all, coalesce(n_amend, 0) AS n_amend FROM bars b LEFT JOIN c USING (entity, date)),
    x AS (SELECT *, CAST(sum(n_all) OVER ({PATH} ROWS 59 PRECEDING) AS BIGINT) AS n_all_60 FROM r)
    SELECT date, entity, grp, n_all, n_amend, n_all_60,
      round(CASE WHEN count(n_all_60) OVER w = 250 AND median(n_all_60) OVER w > 0 THEN n_all_60 / median(n_all_60) OVER w END, 5) AS burst,
      round(sum(n_amend) OVER ({PATH} ROWS 249 PRECEDING) / nullif(sum(n_all) OVER ({PATH} ROWS 249 PRECEDING), 0)::DOUBLE, 5) AS amend_ratio_250
    FROM x WINDOW w AS ({PATH} ROWS BETWEEN 250 PRECEDING AND 1 PRECEDING)""",
    "bars filings",
)
def _(f):
    marked = S.with_next_session(f.filings, f.bars.select("date"), date="receipt_date")
    out = PR.filing_activity(f.bars, marked, f.bars, classes={"amend": F.col("kind") == "4-NOT SPECIFIED"})
    return rounded_all(out.select(*KEY, "n_all", "n_amend", "n_all_60", "burst", "amend_ratio_250"))


def pit_sql(code: str, alias: str) -> str:
    """One metric's interval join, the naive form."""
    return f"""LEFT JOIN (SELECT entity, value, available_from, lead(available_from) OVER (PARTITION BY entity ORDER BY available_from) AS upto FROM (
      SELECT entity, available_from, max_by(value, (period_end, is_revision)) AS value FROM coded WHERE code = '{code}' GROUP BY 1, 2)) {alias}
      ON {alias}.entity = b.entity AND {alias}.available_from <= b.date AND ({alias}.upto IS NULL OR {alias}.upto > b.date)"""


@query(
    "d11_fin_pit_features",
    f"""WITH coded AS (SELECT *, {list(D.FIN_CODES)}[(4 * year + q) % {len(D.FIN_CODES)} + 1] AS code FROM vintages),
    w AS (SELECT b.date, b.entity, b.grp, {", ".join(f"t{i}.value AS {c}" for i, c in enumerate(D.FIN_CODES))} FROM bars b {" ".join(pit_sql(c, f"t{i}") for i, c in enumerate(D.FIN_CODES))})
    SELECT date, entity, grp, {", ".join(D.FIN_CODES)}, coalesce(total_equity <= 0, false) AS is_negative_equity, total_assets IS NOT NULL AS has_fs, round(net_income / nullif(total_assets, 0), 5) AS roa,
      round(CASE WHEN total_equity > 0 THEN total_liabilities / total_equity END, 5) AS debt_to_equity, round(total_equity / nullif(total_assets, 0), 5) AS equity_ratio,
      round(operating_cash_flow / nullif(total_assets, 0), 5) AS cfo_to_assets, round(cash / nullif(total_assets, 0), 5) AS cash_ratio,
      round(coalesce(controlling_net_income, net_income) / nullif(total_equity, 0), 5) AS roe, round(revenue / nullif(total_assets, 0), 5) AS asset_turnover, round(operating_income / nullif(revenue, 0), 5) AS operating_margin FROM w""",
    "bars vintages",
)
def _(f):
    code = F.element_at(F.array(*map(F.lit, D.FIN_CODES)), (F.pmod(4 * F.col("year") + F.col("q"), F.lit(len(D.FIN_CODES))) + 1).cast("int"))
    out = D.fin_pit_features(f.bars, f.vintages.withColumn("code", code))
    names = ["is_negative_equity", "has_fs", "roa", "debt_to_equity", "equity_ratio", "cfo_to_assets", "cash_ratio", "roe", "asset_turnover", "operating_margin"]
    return rounded_all(out.select(*KEY, *D.FIN_CODES, *names))


SCAN_NAMES = ["log_mcap", *D.VALUE_PARTS, "gross_profitability", "operating_profitability", "asset_growth", "accruals"]
SCAN_JOINS = " ".join(pit_sql(f"{b}_{c}", f"{b}{i}") for i, c in enumerate(D.SCAN_CODES) for b in "CS")


def scan_sql(by: str = "date, grp", *, extra: str = "", carry: str = "", join: str = "") -> str:
    """The steps up to z: yields, their z-scores in the cross-section `by`; `extra` columns of the join are carried along."""
    return f"""coded AS (SELECT entity, period_end, available_from, is_revision, value, CASE WHEN (entity + year) % 3 = 0 THEN 'S' ELSE 'C' END || '_' || {list(D.SCAN_CODES)}[(4 * year + q) % {len(D.SCAN_CODES)} + 1] AS code FROM vintages),
    r AS (SELECT b.date, b.entity, b.grp, b.close * b.volume AS cap, NOT (b.open = 0 AND b.high = 0 AND b.low = 0) AND b.close * b.volume > 0 AS ok, CASE WHEN C0.value IS NOT NULL THEN 'C' WHEN S0.value IS NOT NULL THEN 'S' END AS basis,
      {", ".join(f"CASE WHEN C0.value IS NOT NULL THEN C{i}.value ELSE S{i}.value END AS {c}" for i, c in enumerate(D.SCAN_CODES))} {extra} FROM bars b {SCAN_JOINS} {join}),
    a AS (SELECT *, CASE WHEN total_assets > 0 AND total_assets_lag4q > 0 THEN (total_assets + total_assets_lag4q) / 2 END AS assets, coalesce(gross_profit, revenue - cogs) AS gross FROM r),
    p AS (SELECT date, entity, grp, {carry} basis, coalesce(total_equity <= 0, false) AS negative_equity, CASE WHEN gross_profit IS NOT NULL THEN 'direct' WHEN gross IS NOT NULL THEN 'revenue_minus_cogs_fallback' END AS gross_profit_source,
      CASE WHEN ok THEN ln(cap) END AS log_mcap, CASE WHEN ok AND total_equity > 0 THEN total_equity / cap END AS book_to_market, CASE WHEN ok THEN controlling_net_income / cap END AS earnings_yield,
      CASE WHEN ok THEN operating_cash_flow / cap END AS cfo_yield, CASE WHEN ok THEN revenue / cap END AS sales_to_price, CASE WHEN assets > 0 THEN gross / assets END AS gross_profitability,
      CASE WHEN assets > 0 THEN operating_income / assets END AS operating_profitability, CASE WHEN total_assets_lag4q > 0 THEN total_assets / total_assets_lag4q - 1 END AS asset_growth,
      CASE WHEN assets > 0 THEN (net_income - operating_cash_flow) / assets END AS accruals FROM a),
    k AS (SELECT *, {", ".join(f"CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, quantile_cont({x}, 0.01) OVER w), quantile_cont({x}, 0.99) OVER w) END AS k{i}" for i, x in enumerate(D.VALUE_PARTS))} FROM p WINDOW w AS (PARTITION BY {by})),
    z AS (SELECT *, {", ".join(f"(k{i} - avg(k{i}) OVER w) / nullif(stddev_samp(k{i}) OVER w, 0) AS z{i}" for i in range(4))} FROM k WINDOW w AS (PARTITION BY {by}))"""


def scan_features(f: Fixtures, **options) -> DataFrame:
    basis = F.when(F.pmod(F.col("entity") + F.col("year"), F.lit(3)) == 0, "S").otherwise("C")
    code = F.element_at(F.array(*map(F.lit, D.SCAN_CODES)), (F.pmod(4 * F.col("year") + F.col("q"), F.lit(len(D.SCAN_CODES))) + 1).cast("int"))
    bars = options.pop("bars", f.bars).withColumn("market_cap", F.col("close") * F.col("volume"))
    return D.fin_scan_features(bars, f.vintages.withColumns({"basis": basis, "code": code}), ok=~is_halted(), **options)


@query(
    "d12_fin_scan_features",
    f"""WITH {scan_sql()}
    SELECT date, entity, grp, basis, negative_equity, gross_profit_source, {", ".join(f"round({c}, 5) + 0.0 AS {c}" for c in SCAN_NAMES)},
      round(CASE WHEN {" + ".join(f"(z{i} IS NOT NULL)::INT" for i in range(4))} >= 2 THEN list_avg([z0, z1, z2, z3]) END, 4) + 0.0 AS value_score FROM z""",
    "bars vintages",
)
def _(f):
    out = scan_features(f)
    return out.select(*KEY, "basis", "negative_equity", "gross_profit_source", *(rounded(c, 5).alias(c) for c in SCAN_NAMES), rounded("value_score", 4).alias("value_score"))


DATED = sorted({c for cs in D.SCAN_KNOWN.values() for c in cs})
DATED_SQL = ", " + ", ".join(f"CASE WHEN C0.value IS NOT NULL THEN C{i}.available_from ELSE S{i}.available_from END AS {c}_from" for c in DATED for i in [D.SCAN_CODES.index(c)])
SINCE_SQL = {g: f"greatest({', '.join(f'{c}_from' for c in cs)})" for g, cs in D.SCAN_KNOWN.items()}
PARTS_SQL = " + ".join(f"(z{i} IS NOT NULL)::INT" for i in range(4))


@query(
    "d12_fin_scan_availability",
    f"""WITH {scan_sql(extra=DATED_SQL, carry=", ".join(f"{c}_from" for c in DATED) + ",")}, s AS (SELECT *, {PARTS_SQL} AS value_parts, CASE WHEN {PARTS_SQL} >= 2 THEN list_avg([z0, z1, z2, z3]) END AS value_score FROM z)
    SELECT date, entity, grp, value_parts, {", ".join(f"{x} AS {g}_available_from, CAST(date - {x} AS INTEGER) AS {g}_age_days" for g, x in SINCE_SQL.items())},
      {", ".join(f"round(lag({c}) OVER ({PATH}), 4) + 0.0 AS {c}_lag1" for c in D.SCAN_LAGGED)} FROM s""",
    "bars vintages",
)
def _(f):
    out = scan_features(f)
    return out.select(*KEY, "value_parts", *(f"{g}_{x}" for g in D.SCAN_KNOWN for x in ("available_from", "age_days")), *(rounded(f"{c}_lag1", 4).alias(f"{c}_lag1") for c in D.SCAN_LAGGED))


INDUSTRY = """i0 AS (SELECT s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS p FROM supplier), i1 AS (SELECT *, left(p, 1) AS s, count(*) OVER (PARTITION BY p) AS np FROM i0),
    i2 AS (SELECT *, count(*) FILTER (np < 4) OVER (PARTITION BY s) AS ns FROM i1),
    ind AS (SELECT s_suppkey AS entity, CASE WHEN np >= 4 THEN p WHEN ns >= 4 THEN 'S:' || s ELSE 'OTHER' END AS industry_group FROM i2)"""


@query(
    "d12_fin_scan_industry_neutral",
    f"""WITH {INDUSTRY}, {scan_sql("date, grp, industry_group", extra=", ind.industry_group", carry="industry_group,", join="LEFT JOIN ind ON ind.entity = b.entity")}
    SELECT date, entity, grp, industry_group, {PARTS_SQL} AS value_parts, round(CASE WHEN {PARTS_SQL} >= 2 THEN list_avg([z0, z1, z2, z3]) END, 4) + 0.0 AS value_score FROM z""",
    "bars vintages",
)
def _(f):
    suppliers = f.table("supplier").select(F.col("s_suppkey").alias("entity"), F.concat(F.lpad(F.col("s_nationkey").cast("string"), 2, "0"), F.lit("x")).alias("code"))
    groups = D.industry_groups(suppliers, "code", min_size=4, sections=F.substring("code", 1, 1)).select("entity", "industry_group")
    out = scan_features(f, bars=f.bars.join(groups, "entity", "left"), by=[*P.cross, "industry_group"])
    return out.select(*KEY, "industry_group", "value_parts", rounded("value_score", 4).alias("value_score"))


def yearly(f: Fixtures) -> DataFrame:
    return f.vintages.filter("q = 4 and not is_revision").select("entity", "year", "period_end", F.floor("value").cast("long").alias("issued"), F.when(F.pmod("entity", F.lit(4)) == 0, 0).otherwise(F.floor(F.col("value") / 10)).cast("long").alias("treasury"))


@query(
    "d13_share_event_flags",
    """WITH y AS (SELECT entity, year, period_end, CAST(floor(value) AS BIGINT) AS issued, CAST(CASE WHEN entity % 4 = 0 THEN 0 ELSE floor(value / 10) END AS BIGINT) AS treasury FROM vintages WHERE q = 4 AND NOT is_revision)
    SELECT a.entity, a.year, round(a.treasury / nullif(a.issued, 0)::DOUBLE, 6) AS treasury_ratio, coalesce(a.treasury > 0, false) AS has_treasury, round(a.issued / nullif(b.issued, 0)::DOUBLE - 1, 6) AS issued_yoy, a.period_end + 90 AS available_from
    FROM y a LEFT JOIN y b ON a.entity = b.entity AND b.year = a.year - 1""",
    "vintages",
)
def _(f):
    out = D.share_event_flags(yearly(f))
    return out.select("entity", "year", rounded("treasury_ratio").alias("treasury_ratio"), "has_treasury", rounded("issued_yoy").alias("issued_yoy"), "available_from")


def issuance(f: Fixtures) -> DataFrame:
    """Positions that follow from the events for even entities, so that the identity holds there."""
    flows = f.filings.withColumn("year", F.year("receipt_date"))
    net = flows.groupBy("entity", "year").agg(F.sum(F.when(F.col("status") == "O", F.col("amount")).when(F.col("status") == "F", -F.col("amount")).otherwise(F.col("amount"))).alias("net"))
    shares = 10**9 + F.sum("net").over(W.partitionBy("entity").orderBy("year")) + F.when(F.pmod("entity", F.lit(2)) == 1, F.col("year")).otherwise(0)
    positions = net.select("entity", "year", F.make_date("year", F.lit(12), F.lit(31)).alias("settle"), shares.alias("shares"))
    events = f.filings.select("entity", F.col("receipt_date").alias("date"), "status", F.col("amount").alias("quantity"))
    return D.net_issuance(positions, events, increase=F.col("status") == "O", decrease=F.col("status") == "F", mechanical=F.col("status") == "P")


@query(
    "d14_net_issuance",
    """WITH n AS (SELECT entity, year(receipt_date) AS year, sum(CASE WHEN status = 'F' THEN -amount ELSE amount END) AS net, sum(CASE WHEN status = 'O' THEN amount ELSE 0 END) AS inc, sum(CASE WHEN status = 'F' THEN amount ELSE 0 END) AS dec FROM filings GROUP BY 1, 2),
    p AS (SELECT *, 1000000000 + sum(net) OVER (PARTITION BY entity ORDER BY year) + CASE WHEN entity % 2 = 1 THEN year ELSE 0 END AS shares FROM n)
    SELECT a.entity, CAST(a.year AS INTEGER) AS year, coalesce(b.shares + a.net = a.shares AND b.shares > 0, false) AS identity_ok,
      round(CASE WHEN b.shares + a.net = a.shares AND b.shares > 0 THEN (a.inc - a.dec) / b.shares::DOUBLE END, 6) + 0.0 AS net_issuance
    FROM p a LEFT JOIN p b ON a.entity = b.entity AND b.year = a.year - 1""",
    "filings",
)
def _(f):
    return issuance(f).select("entity", "year", "identity_ok", rounded("net_issuance").alias("net_issuance"))


def payouts(f: Fixtures) -> DataFrame:
    y = yearly(f)
    return D.payout(y.select("entity", "year", "period_end", F.when(F.pmod("entity", F.lit(3)) == 0, None).otherwise(F.col("issued").cast("double")).alias("total"), F.when(F.pmod("entity", F.lit(6)) == 0, "-").alias("total_text"), F.lit(0.5).alias("dps"), F.when(F.pmod("entity", F.lit(5)) == 0, F.lit(1)).otherwise(F.col("treasury")).alias("shares"), F.when(F.pmod("entity", F.lit(2)) == 0, F.lit(10.0)).alias("buyback")))


@query(
    "d15_payout",
    """WITH y AS (SELECT entity, year, CAST(floor(value) AS BIGINT) AS issued, CAST(CASE WHEN entity % 4 = 0 THEN 0 ELSE floor(value / 10) END AS BIGINT) AS treasury FROM vintages WHERE q = 4 AND NOT is_revision),
    d AS (SELECT entity, year, CASE WHEN entity % 6 = 0 THEN 0.0 WHEN entity % 3 = 0 THEN NULL ELSE issued::DOUBLE END AS direct, 0.5::DOUBLE * CASE WHEN entity % 5 = 0 THEN 1 ELSE treasury END AS implied, CASE WHEN entity % 2 = 0 THEN 10.0 END AS buyback FROM y),
    e AS (SELECT *, CASE WHEN direct IS NOT NULL AND direct >= 0 AND (implied <= 0 OR direct <= 100 * implied) THEN direct ELSE implied END AS dividends FROM d)
    SELECT entity, year, round(dividends, 4) AS dividends, round(dividends + coalesce(buyback, 0), 4) AS payout FROM e""",
    "vintages",
)
def _(f):
    return payouts(f).select("entity", "year", rounded("dividends", 4).alias("dividends"), rounded("payout", 4).alias("payout"))


@query(
    "d16_event_scan_daily",
    f"""WITH {STOCK}, n AS (SELECT entity, year(receipt_date) AS year, sum(CASE WHEN status = 'F' THEN -amount ELSE amount END) AS net, sum(CASE WHEN status = 'O' THEN amount ELSE 0 END) AS inc, sum(CASE WHEN status = 'F' THEN amount ELSE 0 END) AS dec FROM filings GROUP BY 1, 2),
    p AS (SELECT *, 1000000000 + sum(net) OVER (PARTITION BY entity ORDER BY year) + CASE WHEN entity % 2 = 1 THEN year ELSE 0 END AS shares FROM n),
    iss AS (SELECT a.entity, make_date(CAST(a.year AS INTEGER), 12, 31) + 90 AS known, CASE WHEN b.shares + a.net = a.shares AND b.shares > 0 THEN (a.inc - a.dec) / b.shares::DOUBLE END AS net_issuance FROM p a LEFT JOIN p b ON a.entity = b.entity AND b.year = a.year - 1),
    y AS (SELECT entity, period_end, CAST(floor(value) AS BIGINT) AS issued, CAST(CASE WHEN entity % 4 = 0 THEN 0 ELSE floor(value / 10) END AS BIGINT) AS treasury FROM vintages WHERE q = 4 AND NOT is_revision),
    d AS (SELECT entity, period_end, CASE WHEN entity % 6 = 0 THEN 0.0 WHEN entity % 3 = 0 THEN NULL ELSE issued::DOUBLE END AS direct, 0.5::DOUBLE * CASE WHEN entity % 5 = 0 THEN 1 ELSE treasury END AS implied, CASE WHEN entity % 2 = 0 THEN 10.0 END AS buyback FROM y),
    pay AS (SELECT entity, period_end + 90 AS known, CASE WHEN direct IS NOT NULL AND direct >= 0 AND (implied <= 0 OR direct <= 100 * implied) THEN direct ELSE implied END + coalesce(buyback, 0) AS payout FROM d),
    j AS (SELECT stock.*, iss.net_issuance FROM stock ASOF LEFT JOIN iss ON iss.entity = stock.entity AND stock.date >= iss.known), k AS (SELECT j.*, pay.payout FROM j ASOF LEFT JOIN pay ON pay.entity = j.entity AND j.date >= pay.known),
    r AS (SELECT date, entity, grp, net_issuance, CASE WHEN market_cap > 0 AND payout / market_cap <= 10 THEN payout / market_cap END AS payout_yield FROM k)
    SELECT date, entity, grp, round(net_issuance, 5) + 0.0 AS net_issuance, round(payout_yield, 9) AS payout_yield, round(lag(net_issuance) OVER w, 5) + 0.0 AS net_issuance_lag1, round(lag(payout_yield) OVER w, 9) AS payout_yield_lag1 FROM r WINDOW w AS ({PATH})""",
    "bars vintages filings",
)
def _(f):
    iss = issuance(f).select("entity", F.date_add("settle", 90).alias("available_from"), "net_issuance")
    pay = payouts(f).select("entity", F.date_add("period_end", 90).alias("available_from"), "payout")
    out = D.event_scan_daily(D.stock_pit(f.bars, share_counts(f)), iss, pay)
    return out.select(*KEY, *(rounded(c, 5).alias(c) for c in ("net_issuance", "net_issuance_lag1")), *(rounded(c, 9).alias(c) for c in ("payout_yield", "payout_yield_lag1")))


def macro_history(f: Fixtures) -> DataFrame:
    dates = f.macro.filter("day(obs_date) = 15 and month(obs_date) % 6 = 0").select(F.col("obs_date").alias("date"))
    return pit.asof_history(dates, f.macro, series="series", period="obs_date", known="available_from", value="value", rank=["vintage"])


HISTORY = """h AS (SELECT date, series, obs_date, available_from, value FROM (
      SELECT d.date, m.*, row_number() OVER (PARTITION BY d.date, series, obs_date ORDER BY available_from DESC, vintage DESC) AS n
      FROM (SELECT DISTINCT obs_date AS date FROM macro WHERE day(obs_date) = 15 AND month(obs_date) % 6 = 0) d JOIN macro m ON m.available_from <= d.date) WHERE n = 1)"""


@query(
    "d17_macro_transform",
    f"""WITH {HISTORY}, x AS (SELECT *, value / lag(value, 5) OVER w - 1 AS ret5, value - lag(value, 3) OVER w AS chg3, row_number() OVER (PARTITION BY date, series ORDER BY obs_date DESC) AS n,
      value / lag(value) OVER w - 1 AS r FROM h WINDOW w AS (PARTITION BY date, series ORDER BY obs_date)),
    y AS (SELECT *, CASE WHEN count(r) OVER w = 10 THEN stddev_samp(r) OVER w END AS vol10 FROM x WINDOW w AS (PARTITION BY date, series ORDER BY obs_date ROWS 9 PRECEDING))
    SELECT date, series, round(value, 4) AS level, round(ret5, 5) + 0.0 AS ret_5d, round(chg3, 3) + 0.0 AS change_3d, round(vol10, 5) AS vol_10d FROM y WHERE n = 1""",
    "macro",
)
def _(f):
    h = macro_history(f)
    out = M.macro_transform(h, "level").select("date", "series", rounded("value", 4).alias("level"))
    for t, d in (("ret_5d", 5), ("change_3d", 3), ("vol_10d", 5)):
        out = out.join(M.macro_transform(h, t).select("date", "series", rounded("value", d).alias(t)), ["date", "series"])
    return out


@query(
    "d18_macro_combine",
    f"""WITH {HISTORY}, l AS (SELECT date, series, value, available_from, row_number() OVER (PARTITION BY date, series ORDER BY obs_date DESC) AS n FROM h)
    SELECT a.date, round(a.value - b.value, 3) + 0.0 AS value, greatest(a.available_from, b.available_from) AS available_from FROM l a LEFT JOIN l b ON a.date = b.date AND b.series = '5-LOW' AND b.n = 1 WHERE a.series = '1-URGENT' AND a.n = 1""",
    "macro",
)
def _(f):
    level = M.macro_transform(macro_history(f), "level")
    return M.macro_combine(level.filter("series = '1-URGENT'"), level.filter("series = '5-LOW'"), "spread").withColumn("value", rounded("value", 3))


@query(
    "d19_macro_broadcast",
    f"""WITH {HISTORY}, l AS (SELECT date, series, value, row_number() OVER (PARTITION BY date, series ORDER BY obs_date DESC) AS n FROM h)
    SELECT date, max(CASE WHEN series = '1-URGENT' THEN value END) AS "1-URGENT", max(CASE WHEN series = '2-HIGH' THEN value END) AS "2-HIGH" FROM l WHERE n = 1 GROUP BY date""",
    "macro",
)
def _(f):
    level = M.macro_transform(macro_history(f), "level")
    return M.macro_broadcast(level, ["1-URGENT", "2-HIGH"], code="series")


@query(
    "d20_availability_policy",
    """WITH days AS (SELECT DISTINCT date FROM bars), x AS (SELECT receipt, CASE kind WHEN '1-URGENT' THEN receipt_date WHEN '2-HIGH' THEN receipt_date + 3 WHEN '3-MEDIUM' THEN receipt_date + 8 WHEN '5-LOW' THEN receipt_date + 10 ELSE receipt_date + 1 END AS d FROM filings)
    SELECT receipt, (SELECT min(date) FROM days WHERE date >= d) AS usable_from FROM x""",
    "bars filings",
)
def _(f):
    policy = F.when(F.col("kind") == "1-URGENT", "same_session").when(F.col("kind") == "2-HIGH", "release").when(F.col("kind") == "3-MEDIUM", "event").when(F.col("kind") == "5-LOW", "manual_lag").otherwise("next_session")
    rows = f.filings.withColumns({"policy": policy, "release": F.date_add("receipt_date", 3), "event": F.date_add("receipt_date", 7), "lag_days": F.lit(10)})
    return S.availability_session(rows, f.bars.select("date"), date="receipt_date").select("receipt", "usable_from")


@query(
    "d21_normalize_metrics",
    """WITH r(p_type, b, metric, priority) AS (VALUES ('ECONOMY', '', 'm1', 2), ('ECONOMY', 'Brand#17', 'm1', 1), ('STANDARD', '', 'm2', 1), ('PROMO', '', 'm2', 2)),
    c AS (SELECT p_size, metric, priority, p_partkey, p_retailprice FROM part JOIN r ON part.p_type = r.p_type AND (b = '' OR b = p_brand))
    SELECT p_size, metric, min_by(p_partkey, (priority, p_partkey)) AS p_partkey, min_by(p_retailprice, (priority, p_partkey)) AS p_retailprice FROM c GROUP BY 1, 2""",
)
def _(f):
    rules = f.spark.createDataFrame([("ECONOMY", "", "m1", 2), ("ECONOMY", "Brand#17", "m1", 1), ("STANDARD", "", "m2", 1), ("PROMO", "", "m2", 2)], "p_type string, p_brand_rule string, metric string, priority int")
    part = f.table("part")
    return D.normalize_metrics([part.filter("p_size < 25"), part.filter("p_size >= 25")], rules, exact=["p_type"], wild=["p_brand"], keys=["p_size", "metric"], order=["priority", "p_partkey"], values=["p_partkey", "p_retailprice"])


@query(
    "d22_metric_vintages",
    """WITH days AS (SELECT DISTINCT date FROM bars), x AS (SELECT *, row_number() OVER w AS vintage, lag(value) OVER w AS before, count(*) OVER (PARTITION BY entity, year, q) AS n FROM vintages WINDOW w AS (PARTITION BY entity, year, q ORDER BY available_from, is_revision))
    SELECT entity, year, q, CAST(vintage AS INTEGER) AS vintage, CASE WHEN vintage = 1 THEN 'original' ELSE 'revision' END AS lineage, vintage > 1 AND value IS DISTINCT FROM before AS changed, vintage < n AS superseded,
      (SELECT min(date) FROM days WHERE date > x.available_from) AS session FROM x""",
    "bars vintages",
)
def _(f):
    rows = f.vintages.withColumnRenamed("available_from", "disclosed")
    out = D.metric_vintages(rows, f.bars.select("date"), keys=["entity", "year", "q"], disclosed="disclosed", receipt="is_revision", value="value")
    return out.select("entity", "year", "q", "vintage", "lineage", "changed", "superseded", F.col("available_from").alias("session"))


@query(
    "d23_quarterize",
    """WITH f AS (SELECT entity, year, q, value, available_from FROM vintages WHERE NOT is_revision), g AS (SELECT DISTINCT entity, year, unnest([1, 2, 3, 4]) AS q FROM f),
    s AS (SELECT g.entity, g.year, g.q, CASE WHEN g.q = 1 THEN a.value ELSE a.value - b.value END AS standalone, greatest(a.available_from, b.available_from) AS k FROM g LEFT JOIN f a ON a.entity = g.entity AND a.year = g.year AND a.q = g.q LEFT JOIN f b ON b.entity = g.entity AND b.year = g.year AND b.q = g.q - 1),
    t AS (SELECT *, year * 4 + q AS seq FROM s)
    SELECT entity, year, CAST(q AS INTEGER) AS q, round(standalone, 2) AS standalone, round(max(standalone) OVER (PARTITION BY entity ORDER BY seq RANGE BETWEEN 4 PRECEDING AND 4 PRECEDING), 2) AS lag4,
      round(CASE WHEN count(standalone) OVER w = 4 THEN sum(standalone) OVER w END, 1) AS ttm, CASE WHEN count(standalone) OVER w = 4 THEN max(CASE WHEN standalone IS NOT NULL THEN k END) OVER w END AS ttm_known_from
    FROM t WINDOW w AS (PARTITION BY entity ORDER BY seq RANGE BETWEEN 3 PRECEDING AND CURRENT ROW)""",
    "vintages",
)
def _(f):
    out = D.quarterize(f.vintages.filter("not is_revision"), kind="cumulative")
    return out.select("entity", "year", "q", rounded("standalone", 2).alias("standalone"), rounded("lag4", 2).alias("lag4"), rounded("ttm", 1).alias("ttm"), "ttm_known_from")


@query(
    "d24_surprise_events",
    """WITH f AS (SELECT entity, year * 4 + q AS seq, value FROM vintages WHERE NOT is_revision),
    c AS (SELECT a.entity, a.seq, a.value - b.value AS change FROM f a JOIN f b ON a.entity = b.entity AND b.seq = a.seq - 4)
    SELECT entity, seq, round(change, 2) + 0.0 AS change, round(CASE WHEN count(change) OVER w = 8 THEN change / nullif(stddev_samp(change) OVER w, 0) END, 5) + 0.0 AS sue FROM c WINDOW w AS (PARTITION BY entity ORDER BY seq ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)""",
    "vintages",
)
def _(f):
    rows = f.vintages.filter("not is_revision").withColumn("seq", F.col("year") * 4 + F.col("q"))
    return D.surprise_events(rows, value="value").select("entity", "seq", rounded("change", 2).alias("change"), rounded("sue", 5).alias("sue"))


@query(
    "d25_industry_groups",
    """WITH x AS (SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 2, '0') AS p FROM part), y AS (SELECT *, left(p, 1) AS s, count(*) OVER (PARTITION BY p) AS np FROM x),
    z AS (SELECT *, count(*) FILTER (np < 42) OVER (PARTITION BY s) AS ns FROM y)
    SELECT p_partkey, CASE WHEN np >= 42 THEN p WHEN ns >= 42 THEN 'S:' || s ELSE 'OTHER' END AS industry_group FROM z""",
)
def _(f):
    rows = f.table("part").withColumn("code", F.concat(F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit("x")))
    return D.industry_groups(rows, "code", min_size=42, sections=F.substring("code", 1, 1)).select("p_partkey", "industry_group")


@query(
    "l01_forward_labels",
    f"""WITH a AS (SELECT date, entity, grp, lead(close, 5) OVER ({PATH}) / close - 1 AS fwd FROM valid), b AS (SELECT *, fwd - avg(fwd) OVER (PARTITION BY date, grp) AS ex FROM a),
    c AS (SELECT *, CASE WHEN ex IS NOT NULL THEN least(greatest(ex, quantile_cont(ex, 0.005) OVER w), quantile_cont(ex, 0.995) OVER w) END AS reg, CASE WHEN ex IS NOT NULL THEN percent_rank() OVER (PARTITION BY date, grp, ex IS NULL ORDER BY ex) END AS r FROM b WINDOW w AS (PARTITION BY date, grp))
    SELECT date, entity, grp, round(fwd, 5) + 0.0 AS fwd_5, round(ex, 5) + 0.0 AS excess_5, round(reg, 5) + 0.0 AS reg_5, round(r, 5) AS rank_5, CASE WHEN r IS NOT NULL THEN CASE WHEN r <= 0.2 THEN -1 WHEN r >= 0.8 THEN 1 ELSE 0 END END AS cls_5 FROM c""",
    "valid",
)
def _(f):
    return rounded_all(L.forward_labels(valid(f), [5]))


@query("l02_risk_labels", f"SELECT date, entity, grp, round(CASE WHEN count(ret) OVER w = 20 THEN stddev_samp(ret) OVER w END, 5) AS vol_20 FROM valid WINDOW w AS ({PATH} ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING)", "valid")
def _(f):
    return rounded_all(L.risk_labels(valid(f), 20).select(*KEY, "vol_20"))


@query(
    "l03_label_scan",
    f"""WITH {QUALITY}, e AS (SELECT *, sum(CASE WHEN event THEN 1 ELSE 0 END) OVER ({PATH}) AS ev FROM q2),
    c AS (SELECT date, entity, grp, CASE WHEN lead(ev, 1) OVER w = ev THEN lead(close, 1) OVER w / close - 1 END AS c1, CASE WHEN lead(ev, 3) OVER w = ev THEN lead(close, 3) OVER w / close - 1 END AS c3, lead(date, 3) OVER w AS label_end FROM e WINDOW w AS ({PATH})),
    b AS (SELECT *, (1 + c3) / nullif(1 + c1, 0) - 1 AS b13 FROM c)
    SELECT date, entity, grp, round(c1, 5) + 0.0 AS cum_1, round(c3, 5) + 0.0 AS cum_3, round(b13, 5) + 0.0 AS bkt_1_3, round(b13 - avg(b13) OVER (PARTITION BY date, grp), 5) + 0.0 AS bkt_1_3_excess,
      round(CASE WHEN c3 IS NOT NULL THEN percent_rank() OVER (PARTITION BY date, grp, c3 IS NULL ORDER BY c3) END, 5) AS cum_3_rank, label_end, coalesce(label_end < DATE '2001-01-01', false) AS pre_holdout FROM b""",
    "valid",
)
def _(f):
    out = L.label_scan(quality(f), [1, 3], holdout="2001-01-01")
    return rounded_all(out.select(*KEY, "cum_1", "cum_3", "bkt_1_3", "bkt_1_3_excess", "cum_3_rank", "label_end", "pre_holdout"))


@query(
    "l04_raw_account_pit",
    """WITH days AS (SELECT DISTINCT date FROM bars), k AS (SELECT entity, kind, receipt, amount, (SELECT min(date) FROM days WHERE date > receipt_date) AS s FROM filings),
    o AS (SELECT entity, s, max_by(amount, receipt) AS amount FROM k WHERE kind = '1-URGENT' GROUP BY 1, 2), i AS (SELECT *, lead(s) OVER (PARTITION BY entity ORDER BY s) AS upto FROM o)
    SELECT b.date, b.entity, b.grp, i.amount AS urgent FROM bars b LEFT JOIN i ON i.entity = b.entity AND i.s <= b.date AND (i.upto IS NULL OR i.upto > b.date)""",
    "bars filings",
)
def _(f):
    facts = f.filings.select("entity", F.col("kind").alias("account"), "receipt", "receipt_date", F.col("amount").alias("value"))
    out = L.raw_account_pit(f.bars, facts, f.bars.select("date"), accounts=["1-URGENT"], account="account", receipt_date="receipt_date", order=["receipt"])
    return out.select(*KEY, F.col("1-URGENT").alias("urgent"))
