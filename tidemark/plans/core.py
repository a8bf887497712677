"""Queries of scans, filters, joins, aggregations, windows, ranks and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.functions.exprs import rounded, sdiv
from tidemark.keys import P
from tidemark.operators import aggregates as A
from tidemark.operators import cross as C
from tidemark.operators import joins as J
from tidemark.operators import pit
from tidemark.operators import sessions as S
from tidemark.operators import sliding
from tidemark.operators import windows as R
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.registry import query

KEY = ["date", "entity", "grp"]


def valid(f: Fixtures) -> DataFrame:
    return S.valid_session_panel(f.bars)


# Filters and predicates


@query("f01_is_halted", "SELECT grp, count(*) FILTER (open = 0 AND high = 0 AND low = 0) AS halted, count(*) AS n FROM bars GROUP BY grp", "bars")
def _(f):
    return f.bars.groupBy("grp").agg(F.count_if(X.is_halted()).alias("halted"), F.count("*").alias("n"))


@query(
    "f02_receipt_date",
    """SELECT receipt, CASE WHEN regexp_matches(id, '^[0-9]{14}$') THEN TRY_CAST(strptime(left(id, 8), '%Y%m%d') AS DATE) END AS known
    FROM (SELECT receipt, CASE WHEN receipt % 3 = 0 THEN 'x' ELSE '' END || strftime(receipt_date, '%Y%m%d') || lpad(CAST(receipt % 1000000 AS VARCHAR), 6, '0') AS id FROM filings)""",
    "filings",
)
def _(f):
    bad = F.when(F.pmod("receipt", F.lit(3)) == 0, "x").otherwise("")
    rows = f.filings.withColumn("id", F.concat(bad, F.date_format("receipt_date", "yyyyMMdd"), F.lpad(F.pmod("receipt", F.lit(1000000)).cast("string"), 6, "0")))
    return rows.select("receipt", X.receipt_date("id").alias("known"))


@query("f03_classify", "SELECT CASE status WHEN 'O' THEN 'increase' WHEN 'F' THEN 'decrease' ELSE 'unclassified' END AS class, count(*) AS n FROM filings GROUP BY 1", "filings")
def _(f):
    return f.filings.groupBy(X.classify("status", {"O": "increase", "F": "decrease"}).alias("class")).agg(F.count("*").alias("n"))


@query("f04_flag_by_markers", "SELECT doc_id, coalesce(contains(text, 'the') OR contains(text, 'der'), false) AS flagged FROM documents")
def _(f):
    return f.table("documents").select("doc_id", X.flag_by_markers("text", ["the", "der"]).alias("flagged"))


@query("f05_strip_ws_contains_all", r"SELECT kind, count(*) FILTER (contains(regexp_replace(kind, '\s+', '', 'g'), 'NOTSPEC') AND contains(kind, '4')) AS n FROM filings GROUP BY kind", "filings")
def _(f):
    return f.filings.groupBy("kind").agg(F.count_if(X.contains_all_without_space("kind", ["NOTSPEC", "4"])).alias("n"))


@query("f06_regime_of", "SELECT CASE WHEN date < DATE '1997-06-15' THEN 'narrow' WHEN date < DATE '2000-01-01' THEN 'wide' ELSE 'open' END AS regime, count(*) AS n FROM bars GROUP BY 1", "bars")
def _(f):
    regime = X.regime_of("date", [(None, "1997-06-15", "narrow"), ("1997-06-15", "2000-01-01", "wide"), ("2000-01-01", None, "open")])
    return f.bars.groupBy(regime.alias("regime")).agg(F.count("*").alias("n"))


@query("f07_finite_rows", "SELECT date, entity, grp FROM valid WHERE ret IS NOT NULL AND isfinite(ret)", "valid")
def _(f):
    return X.finite_rows(valid(f), ["ret"]).select(*KEY)


@query("f08_select_features", "SELECT sum(volume) AS s_volume, round(sum(close), 1) AS s_close FROM bars", "bars")
def _(f):
    picked = X.select_features(f.bars, [*KEY, "open", "high", "low"])
    return f.bars.select(*picked).agg(F.sum("volume").alias("s_volume"), rounded(F.sum("close"), 1).alias("s_close"))


@query("f10_offset_subset", "SELECT b.date, b.entity, b.grp FROM bars b JOIN calendar c USING (grp, date) WHERE d_idx % 20 = 3", "bars calendar")
def _(f):
    return f.bars.join(S.trading_calendar(f.bars), ["grp", "date"]).filter(F.pmod("d_idx", F.lit(20)) == 3).select(*KEY)


@query("f11_sample_policy", "SELECT l_returnflag, count(*) AS total, true AS share_ok FROM lineitem GROUP BY 1")
def _(f):
    """The sampled share of each flag lies around a fifth, and a table below the threshold stays whole."""
    rows = f.table("lineitem").select("l_returnflag", F.lit(1).alias("n"))
    every, some = (d.groupBy("l_returnflag").agg(F.sum("n").alias(c)) for d, c in ((rows, "total"), (X.sample_policy(rows, 0.2, 1_000), "some")))
    whole = X.sample_policy(f.table("region"), 0.2, 1_000).agg((F.count("*") == 5).alias("whole"))
    share = F.col("some") / F.col("total")
    return every.join(some, "l_returnflag").crossJoin(F.broadcast(whole)).select("l_returnflag", "total", (F.col("whole") & share.between(0.15, 0.25)).alias("share_ok"))


@query("f12_hash_sample", "SELECT c_custkey FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 50")
def _(f):
    return f.table("customer").orderBy(F.md5(F.col("c_custkey").cast("string").cast("binary")), "c_custkey").limit(50).select("c_custkey")


# Joins


@query("j01_assemble_panel", "SELECT b.date, b.entity, b.grp, close, round(ret, 6) AS ret, round(fwd, 6) AS fwd FROM bars b LEFT JOIN (SELECT date, entity, grp, ret FROM valid) USING (date, entity, grp) LEFT JOIN labels5 USING (date, entity, grp)", "bars valid labels5")
def _(f):
    v = valid(f)
    labels = v.select(*KEY, (sdiv(R.forward_value("close", 5), "close") - 1).alias("fwd"))
    out = J.assemble_panel(f.bars, [v.select(*KEY, "ret"), labels])
    return out.select(*KEY, "close", rounded("ret").alias("ret"), rounded("fwd").alias("fwd"))


@query("j02_broadcast_by_date", "SELECT b.date, b.entity, b.grp, m.names FROM bars b LEFT JOIN (SELECT date, count(*) AS names FROM bars GROUP BY date) m USING (date)", "bars")
def _(f):
    return J.join_by_date(f.bars, f.bars.groupBy("date").agg(F.count("*").alias("names"))).select(*KEY, "names")


@query(
    "j03_pit_interval_join",
    """SELECT b.date, b.entity, b.grp, f1.value AS q1, f4.value AS q4 FROM bars b
    LEFT JOIN (SELECT entity, q, value, available_from, lead(available_from) OVER (PARTITION BY entity, q ORDER BY available_from) AS upto
               FROM (SELECT entity, q, available_from, max_by(value, (year, is_revision)) AS value FROM vintages GROUP BY 1, 2, 3)) f1
      ON f1.entity = b.entity AND f1.q = 1 AND f1.available_from <= b.date AND (f1.upto IS NULL OR f1.upto > b.date)
    LEFT JOIN (SELECT entity, q, value, available_from, lead(available_from) OVER (PARTITION BY entity, q ORDER BY available_from) AS upto
               FROM (SELECT entity, q, available_from, max_by(value, (year, is_revision)) AS value FROM vintages GROUP BY 1, 2, 3)) f4
      ON f4.entity = b.entity AND f4.q = 4 AND f4.available_from <= b.date AND (f4.upto IS NULL OR f4.upto > b.date)""",
    "bars vintages",
)
def _(f):
    facts = f.vintages.withColumn("code", F.concat(F.lit("q"), "q"))
    return pit.pit_interval_join(f.bars, facts, by=["entity"], code="code", codes=["q1", "q4"], order=["year", "is_revision"]).select(*KEY, "q1", "q4")


@query(
    "j04_pit_latest_eligible",
    """SELECT date, entity, grp, period_end, value FROM (
      SELECT b.date, b.entity, b.grp, v.period_end, v.value,
             row_number() OVER (PARTITION BY b.date, b.entity, b.grp ORDER BY v.period_end DESC NULLS LAST, v.available_from DESC, v.value DESC) AS n
      FROM bars b LEFT JOIN vintages v ON v.entity = b.entity AND v.available_from <= b.date) WHERE n = 1""",
    "bars vintages",
)
def _(f):
    facts = f.vintages.withColumn("disclosed", F.col("available_from"))
    return pit.pit_latest_eligible(f.bars, facts, by=["entity"], order=["period_end", "disclosed", "value"], values=["period_end", "value"]).select(*KEY, "period_end", "value")


@query(
    "j05_asof_backward",
    """SELECT b.date, b.entity, b.grp, x.receipt FROM bars b ASOF LEFT JOIN
      (SELECT entity, receipt_date, max(receipt) AS receipt FROM filings GROUP BY 1, 2) x ON b.entity = x.entity AND b.date >= x.receipt_date""",
    "bars filings",
)
def _(f):
    last = f.filings.groupBy("entity", "receipt_date").agg(F.max("receipt").alias("receipt"))
    return pit.asof_backward(f.bars, last, by=["entity"], left_date="date", right_date="receipt_date", values=["receipt"]).select(*KEY, "receipt")


@query("j06_next_session", "SELECT receipt, (SELECT min(date) FROM (SELECT DISTINCT date FROM bars) c WHERE c.date > receipt_date) AS session FROM filings", "bars filings")
def _(f):
    return S.with_next_session(f.filings, f.bars.select("date"), date="receipt_date").select("receipt", "session")


@query("j07_forward_value", "SELECT date, entity, grp, lead(close, 20) OVER (PARTITION BY entity, grp ORDER BY date) AS ahead FROM valid", "valid")
def _(f):
    return valid(f).select(*KEY, R.forward_value("close", 20).alias("ahead"))


@query(
    "j08_exact_period_lag",
    "SELECT a.entity, a.year * 4 + a.q AS seq, a.value, b.value AS lagged FROM vintages a LEFT JOIN vintages b ON a.entity = b.entity AND b.year * 4 + b.q = a.year * 4 + a.q - 4 AND NOT b.is_revision WHERE NOT a.is_revision",
    "vintages",
)
def _(f):
    rows = f.vintages.filter("not is_revision").withColumn("seq", F.col("year") * 4 + F.col("q"))
    return rows.select("entity", "seq", "value", J.exact_period_lag("value", "seq", 4, ["entity"]).alias("lagged"))


RULES = [("ECONOMY", "", "m1"), ("ECONOMY", "Brand#17", "m2"), ("STANDARD", "Brand#2", "m3"), ("PROMO", "", "m4")]


@query(
    "j09_wildcard_rule_join",
    """SELECT p_partkey, metric FROM part JOIN (VALUES ('ECONOMY', '', 'm1'), ('ECONOMY', 'Brand#17', 'm2'), ('STANDARD', 'Brand#2', 'm3'), ('PROMO', '', 'm4')) r(t, b, metric)
    ON p_type = t AND (b = '' OR p_brand = b)""",
)
def _(f):
    rules = f.spark.createDataFrame(RULES, "p_type string, p_brand_rule string, metric string")
    return J.wildcard_rule_join(f.table("part"), rules, ["p_type"], ["p_brand"]).select("p_partkey", "metric")


@query("j10_exists_in_range", "SELECT date, entity, grp, coalesce(max(CASE WHEN open = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY entity, grp ORDER BY date ROWS BETWEEN 6 FOLLOWING AND 20 FOLLOWING) = 1, false) AS event FROM bars", "bars")
def _(f):
    return f.bars.withColumn("flag", X.is_halted()).select(*KEY, R.exists_in_range("flag", 5, 20).alias("event"))


@query("j11_anti_join", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(f):
    return J.anti_join(f.table("customer").select("c_custkey"), f.table("orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query(
    "j12_asof_history",
    """SELECT date, series, obs_date, vintage, value FROM (
      SELECT d.date, m.*, row_number() OVER (PARTITION BY d.date, series, obs_date ORDER BY available_from DESC, vintage DESC) AS n
      FROM (SELECT DISTINCT obs_date AS date FROM macro WHERE day(obs_date) = 15 AND month(obs_date) % 6 = 0) d JOIN macro m ON m.available_from <= d.date) WHERE n = 1""",
    "macro",
)
def _(f):
    dates = f.macro.filter("day(obs_date) = 15 and month(obs_date) % 6 = 0").select(F.col("obs_date").alias("date"))
    return pit.asof_history(dates, f.macro, series="series", period="obs_date", known="available_from", value="value", rank=["vintage"]).select("date", "series", "obs_date", "vintage", "value")


@query("j13_grid_left_join", "SELECT r.n_nationkey, s.seg, coalesce(n, 0) AS n FROM nation r CROSS JOIN (SELECT DISTINCT c_mktsegment AS seg FROM customer) s LEFT JOIN (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2) ON c_nationkey = n_nationkey AND c_mktsegment = s.seg")
def _(f):
    c = f.table("customer").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("seg"))
    facts = c.groupBy("n_nationkey", "seg").agg(F.count("*").alias("n"))
    return J.grid_left_join(f.table("nation").select("n_nationkey"), c.select("seg").distinct(), facts, ["n_nationkey", "seg"]).fillna(0, ["n"])


def monthly(f: Fixtures) -> DataFrame:
    return R.month_end_row(f.bars).select("entity", "grp", F.trunc("date", "month").alias("month"), "close")


MONTHLY = "SELECT entity, grp, CAST(date_trunc('month', date) AS DATE) AS month, close FROM (SELECT *, row_number() OVER (PARTITION BY entity, grp, date_trunc('month', date) ORDER BY date DESC) AS n FROM bars) WHERE n = 1"


@query("j14_calendar_month_lag", f"WITH m AS ({MONTHLY}) SELECT a.entity, a.month, a.close, b.close AS lagged FROM m a LEFT JOIN m b ON a.entity = b.entity AND CAST(b.month + INTERVAL 3 MONTH AS DATE) = a.month", "bars")
def _(f):
    return J.calendar_month_lag(monthly(f), "close", 3, ["entity"]).select("entity", "month", "close", "lagged")


@query("j15_full_outer", "SELECT coalesce(a.n_nationkey, b.n_nationkey) AS n_nationkey, a.n AS customers, b.n AS suppliers FROM (SELECT c_nationkey AS n_nationkey, count(*) AS n FROM customer WHERE c_nationkey < 20 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS n_nationkey, count(*) AS n FROM supplier WHERE s_nationkey > 3 GROUP BY 1) b ON a.n_nationkey = b.n_nationkey")
def _(f):
    a = f.table("customer").filter("c_nationkey < 20").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    b = f.table("supplier").filter("s_nationkey > 3").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    return J.full_outer_coalesce(a, b, ["n_nationkey"])


@query("j16_assert_no_fanout", "SELECT count(*) AS base_rows, count(*) AS base_keys, count(*) AS joined_rows, count(*) AS joined_keys, true AS ok FROM bars", "bars")
def _(f):
    return J.assert_no_fanout(f.bars, J.assemble_panel(f.bars, [valid(f).select(*KEY, "ret")]))


@query(
    "j17_snapshot_overlap",
    "WITH x AS (SELECT source, date, entity, metric, round(sum(value), 4) AS v FROM flows GROUP BY ALL) SELECT count(*) AS overlap, count(*) FILTER (a.v IS DISTINCT FROM b.v) AS conflicts FROM x a JOIN x b USING (date, entity, metric) WHERE a.source = 'P' AND b.source = 'S'",
    "flows",
)
def _(f):
    x = f.flows.groupBy("source", "date", "entity", "metric").agg(F.round(F.sum("value"), 4).alias("v"))
    return J.snapshot_overlap(x.filter("source = 'P'"), x.filter("source = 'S'"), ["date", "entity", "metric"], "v")


@query(
    "j18_shifted_panel_join",
    """WITH t AS (SELECT grp, max(d_idx) AS total FROM calendar GROUP BY grp), x AS (SELECT b.*, d_idx, total FROM bars b JOIN calendar USING (grp, date) JOIN t USING (grp))
    SELECT l.date, l.entity, l.grp, l.close, r.volume AS moved FROM x l JOIN x r ON l.entity = r.entity AND l.grp = r.grp AND l.d_idx = (r.d_idx - 1 + 150) % r.total + 1""",
    "bars calendar",
)
def _(f):
    cal = S.trading_calendar(f.bars)
    panel = f.bars.join(cal, ["grp", "date"]).join(cal.groupBy("grp").agg(F.max("d_idx").alias("total")), "grp")
    features = panel.select(*KEY, "d_idx", "total", F.col("volume").alias("moved"))
    return J.shifted_panel_join(features, panel.select(*KEY, "d_idx", "close"), 150, F.col("total")).select(*KEY, "close", "moved")


# Aggregations


@query(
    "a01_dedup_prefer",
    "SELECT date, entity, metric, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY date, entity, metric ORDER BY source, event_id DESC) AS n FROM flows) WHERE n = 1",
    "flows",
)
def _(f):
    return A.dedup_prefer(f.flows, ["date", "entity", "metric"], "source", ["P", "S"], [F.desc("event_id")]).select("date", "entity", "metric", "event_id", "value")


@query("a02_pick_winner", "SELECT entity, receipt_date, min_by(kind, (kind, receipt)) AS kind, min_by(receipt, (kind, receipt)) AS receipt FROM filings GROUP BY 1, 2", "filings")
def _(f):
    return A.pick_winner(f.filings, ["entity", "receipt_date"], ["kind", "receipt"], ["kind", "receipt"])


@query("a03_pivot_codes", "SELECT date, entity, " + ", ".join(f"max(CASE WHEN metric = '{m}' THEN value END) AS {m}" for m in ("signup", "click", "error", "purchase", "view")) + " FROM flows GROUP BY date, entity", "flows")
def _(f):
    return A.pivot_codes(f.flows, ["date", "entity"], "metric", "value", ["signup", "click", "error", "purchase", "view"])


@query("a04_equal_weight_benchmark", "SELECT date, grp, round(avg(ret), 6) AS benchmark FROM valid GROUP BY date, grp", "valid")
def _(f):
    return A.equal_weight_benchmark(valid(f), "ret", ["date", "grp"]).withColumn("benchmark", rounded("benchmark"))


@query("a05_filtered_counts", "SELECT kind, count(*) AS n, count(*) FILTER (status = 'O') AS n_open, count(*) FILTER (amount > 200000) AS n_large, round(count(*) FILTER (status = 'O') / count(*)::DOUBLE, 6) AS open_ratio, round(count(*) FILTER (amount > 200000) / count(*)::DOUBLE, 6) AS large_ratio FROM filings GROUP BY kind", "filings")
def _(f):
    out = A.filtered_counts(f.filings, ["kind"], {"open": F.col("status") == "O", "large": F.col("amount") > 200000})
    return out.withColumns({c: rounded(c) for c in ("open_ratio", "large_ratio")})


@query(
    "a06_distribution_stats",
    "SELECT grp, count(close) AS n, count(DISTINCT close) AS n_distinct, round(avg(close), 4) AS mean, round(stddev_samp(close), 4) AS std, min(close) AS min, max(close) AS max, " + ", ".join(f"round(quantile_cont(close, {q}), 4) AS p{round(q * 100):02d}" for q in A.QUANTILES) + " FROM bars GROUP BY grp",
    "bars",
)
def _(f):
    out = A.distribution_stats(f.bars, "close", ["grp"])
    return out.withColumns({c: rounded(c, 4) for c in out.columns if c in ("mean", "std") or c.startswith("p")})


@query("a07_correlation_pearson", "SELECT year(date) AS year, grp, count(*) AS n, round(corr(close, volume), 6) AS corr FROM bars GROUP BY 1, 2 HAVING count(*) >= 100", "bars")
def _(f):
    rows = f.bars.withColumn("year", F.year("date").cast("long"))
    return A.correlation(rows, "close", "volume", by=["year", "grp"], min_n=100).withColumn("corr", rounded("corr"))


AVG_RANK = "rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0"


@query("a07_correlation_spearman", f"SELECT count(*) AS n, round(corr(a, b), 6) AS corr FROM (SELECT {AVG_RANK.format(x='close')} AS a, {AVG_RANK.format(x='volume')} AS b FROM bars)", "bars")
def _(f):
    return A.correlation(f.bars, "close", "volume", method="spearman").withColumn("corr", rounded("corr"))


@query("a08_simple_regression", "SELECT grp, regr_count(ret, l) AS n, round(regr_slope(ret, l), 6) AS slope, round(regr_intercept(ret, l), 6) AS intercept, round(regr_r2(ret, l), 6) AS r2 FROM (SELECT grp, ret, lag(ret) OVER (PARTITION BY entity, grp ORDER BY date) AS l FROM valid) GROUP BY grp", "valid")
def _(f):
    rows = valid(f).withColumn("l", R.lag_by_sessions("ret", 1))
    out = A.simple_regression(rows, "l", "ret", ["grp"])
    return out.withColumns({c: rounded(c) for c in ("slope", "intercept", "r2")})


@query("a09_presence_intersection", "SELECT open, urgent, count(*) AS entities FROM (SELECT entity, bool_or(status = 'O') AS open, bool_or(kind = '1-URGENT') AS urgent FROM filings GROUP BY entity) GROUP BY 1, 2", "filings")
def _(f):
    return A.presence_intersection(f.filings, "entity", {"open": F.col("status") == "O", "urgent": F.col("kind") == "1-URGENT"})


@query("a10_market_breadth", "SELECT date, grp, count(*) FILTER (simple > 0) AS advancers, count(*) FILTER (simple < 0) AS decliners, count(*) FILTER (simple = 0) AS unchanged, round(sum(turnover), 4) AS value, CAST(sum(volume) AS BIGINT) AS volume FROM valid GROUP BY date, grp", "valid")
def _(f):
    return A.market_breadth(valid(f), ["date", "grp"], "simple", "turnover", "volume").withColumn("value", rounded("value", 4))


@query("a11_coverage_by", "SELECT entity, metric, min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS sessions FROM flows GROUP BY 1, 2", "flows")
def _(f):
    return A.coverage_by(f.flows, ["entity", "metric"], "date")


@query("a12_top_codes_with_span", "SELECT p_brand, count(*) AS rows, count(DISTINCT l_suppkey) AS entities, min(CAST(year(l_shipdate) AS INTEGER)) AS first_year, max(CAST(year(l_shipdate) AS INTEGER)) AS last_year FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY rows DESC, p_brand LIMIT 10")
def _(f):
    rows = f.table("lineitem").join(f.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    return A.top_codes_with_span(rows, "p_brand", "l_suppkey", F.year("l_shipdate"), 10)


@query(
    "a13_gaps_and_islands",
    """WITH c AS (SELECT entity, receipt, receipt_date, CASE WHEN lag(status) OVER w IS NOT DISTINCT FROM status AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS c FROM filings WINDOW w AS (PARTITION BY entity ORDER BY receipt_date, receipt)),
    i AS (SELECT entity, sum(c) OVER (PARTITION BY entity ORDER BY receipt_date, receipt ROWS UNBOUNDED PRECEDING) AS i FROM c)
    SELECT entity, max(n) AS longest_run FROM (SELECT entity, i, count(*) AS n FROM i GROUP BY 1, 2) GROUP BY entity""",
    "filings",
)
def _(f):
    return A.longest_runs(f.filings, ["entity"], ["receipt_date", "receipt"], "status")


# Windows

PATH = "PARTITION BY entity, grp ORDER BY date"


@query("w01_session_index", "SELECT * FROM calendar", "calendar")
def _(f):
    return S.trading_calendar(f.bars)


@query("d01_trading_calendar", "SELECT * FROM calendar WHERE d_idx % 5 = 0", "calendar")
def _(f):
    return S.trading_calendar(f.bars).filter("d_idx % 5 = 0")


@query("w02_valid_session_panel", "SELECT date, entity, grp, CAST(v_idx AS INTEGER) AS v_idx, round(ret, 6) AS ret, round(simple, 6) AS simple, round(turnover, 2) AS turnover FROM valid", "valid")
def _(f):
    return valid(f).select(*KEY, "v_idx", rounded("ret").alias("ret"), rounded("simple").alias("simple"), rounded("turnover", 2).alias("turnover"))


@query("w03_rolling", f"SELECT date, entity, grp, round(sum(ret) OVER w, 6) AS s20, round(avg(turnover) OVER w, 6) AS m20, max(close) OVER w AS x20, min(close) OVER w AS n20 FROM valid WINDOW w AS ({PATH} ROWS 19 PRECEDING)", "valid")
def _(f):
    return valid(f).select(*KEY, rounded(R.rolling("sum", "ret", 20)).alias("s20"), rounded(R.rolling("avg", "turnover", 20), 6).alias("m20"), R.rolling("max", "close", 20).alias("x20"), R.rolling("min", "close", 20).alias("n20"))


@query("w04_rolling_complete", f"SELECT date, entity, grp, round(CASE WHEN count(ret) OVER w = 20 THEN stddev_samp(ret) OVER w END, 6) AS vol20 FROM valid WINDOW w AS ({PATH} ROWS 19 PRECEDING)", "valid")
def _(f):
    return valid(f).select(*KEY, rounded(R.rolling_complete("std", "ret", 20)).alias("vol20"))


@query("w05_rolling_prior", f"SELECT date, entity, grp, max(close) OVER ({PATH} ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING) AS high252, round(sum(ret) OVER ({PATH} ROWS BETWEEN 252 PRECEDING AND 21 PRECEDING), 6) AS mom FROM valid", "valid")
def _(f):
    rows = sliding.frame_sums(valid(f), {"mom": ("ret", 252, 21), "n": (F.col("ret").isNotNull().cast("int"), 252, 21)})
    rows = sliding.order_statistics(rows.select(*KEY, "close", F.when(F.col("n") > 0, F.col("mom")).alias("mom")), {"high252": ("max", "close", 252, 1)})
    return rows.select(*KEY, "high252", rounded("mom").alias("mom"))


@query(
    "w06_rolling_regression",
    f"""WITH m AS (SELECT *, avg(ret) OVER (PARTITION BY date, grp) AS mkt FROM valid),
    r AS (SELECT *, regr_slope(ret, mkt) OVER w AS s, regr_intercept(ret, mkt) OVER w AS i, regr_count(ret, mkt) OVER w AS n FROM m WINDOW w AS ({PATH} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING))
    SELECT date, entity, grp, CAST(n AS BIGINT) AS n_pairs, round(CASE WHEN n = 60 THEN s END, 5) AS slope, round(CASE WHEN n = 60 THEN ret - (i + s * mkt) END, 5) AS residual FROM r""",
    "valid",
)
def _(f):
    rows = valid(f).withColumn("mkt", F.avg("ret").over(W.partitionBy("date", "grp")))
    return R.rolling_regression(rows, "ret", "mkt", 60).select(*KEY, "n_pairs", rounded("slope", 5).alias("slope"), rounded("residual", 5).alias("residual"))


@query("w07_rolling_median", f"SELECT date, entity, grp, round(median(turnover) OVER ({PATH} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING), 3) AS med FROM valid", "valid")
def _(f):
    rows = sliding.order_statistics(valid(f).select(*KEY, "turnover"), {"med": ("median", "turnover", 60, 1)})
    return rows.select(*KEY, rounded("med", 3).alias("med"))


@query("w08_rolling_zscore", f"SELECT date, entity, grp, round((volume - avg(volume) OVER w) / nullif(stddev_samp(volume) OVER w, 0), 5) AS z FROM valid WINDOW w AS ({PATH} ROWS 19 PRECEDING)", "valid")
def _(f):
    return valid(f).select(*KEY, rounded(R.rolling_zscore("volume", 20), 5).alias("z"))


@query("w09_lag_by_sessions", f"SELECT date, entity, grp, lag(close, 5) OVER w AS lag5, round(close - lag(close, 20) OVER w, 4) AS diff20 FROM valid WINDOW w AS ({PATH})", "valid")
def _(f):
    return valid(f).select(*KEY, R.lag_by_sessions("close", 5).alias("lag5"), rounded(F.col("close") - R.lag_by_sessions("close", 20), 4).alias("diff20"))


@query("w10_forward_vol", f"SELECT date, entity, grp, round(CASE WHEN count(ret) OVER w = 20 THEN stddev_samp(ret) OVER w END, 6) AS vol FROM valid WINDOW w AS ({PATH} ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING)", "valid")
def _(f):
    return valid(f).select(*KEY, rounded(R.forward_vol("ret", 20)).alias("vol"))


@query(
    "w11_forward_max_drawdown",
    f"""WITH g AS (SELECT date, entity, grp, {", ".join(f"1 + lead(simple, {k}) OVER w AS g{k}" for k in range(1, 6))} FROM valid WINDOW w AS ({PATH})),
    l AS (SELECT date, entity, grp, {", ".join(" * ".join(f"g{j}" for j in range(1, k + 1)) + f" AS l{k}" for k in range(1, 6))} FROM g)
    SELECT date, entity, grp, CASE WHEN l5 IS NOT NULL THEN round(least(0.0, {", ".join(f"l{k} / greatest(1.0, " + ", ".join(f"l{j}" for j in range(1, k + 1)) + ") - 1" for k in range(1, 6))}), 6) + 0.0 END AS mdd FROM l""",
    "valid",
)
def _(f):
    return valid(f).select(*KEY, rounded(R.forward_max_drawdown("simple", 5)).alias("mdd"))


@query("w12_cross_section_rank", "SELECT date, entity, grp, round(CASE WHEN ret IS NOT NULL THEN percent_rank() OVER (PARTITION BY date, grp, ret IS NULL ORDER BY ret) END, 6) AS r FROM valid", "valid")
def _(f):
    return valid(f).select(*KEY, rounded(C.percent_rank("ret", P.cross)).alias("r"))


@query("w13_cross_section_winsorize", "SELECT date, entity, grp, round(CASE WHEN ret IS NOT NULL THEN least(greatest(ret, quantile_cont(ret, 0.05) OVER w), quantile_cont(ret, 0.95) OVER w) END, 6) AS clipped FROM valid WINDOW w AS (PARTITION BY date, grp)", "valid")
def _(f):
    return C.winsorize(valid(f), "ret", 0.05, 0.95, P.cross, "clipped").select(*KEY, rounded("clipped").alias("clipped"))


@query("w14_cross_section_zscore", "SELECT date, entity, grp, round((ret - avg(ret) OVER w) / nullif(stddev_samp(ret) OVER w, 0), 5) AS z FROM valid WINDOW w AS (PARTITION BY date, grp)", "valid")
def _(f):
    return valid(f).select(*KEY, rounded(C.zscore("ret", P.cross), 5).alias("z"))


@query("w15_average_rank", "SELECT date, entity, grp, rank() OVER (PARTITION BY date, grp ORDER BY volume) + (count(*) OVER (PARTITION BY date, grp, volume) - 1) / 2.0 AS r FROM valid", "valid")
def _(f):
    return valid(f).select(*KEY, C.average_rank("volume", P.cross).alias("r"))


@query(
    "w16_tertile_segments",
    """WITH p AS (SELECT *, rank() OVER (PARTITION BY date, grp ORDER BY turnover) + (count(*) OVER (PARTITION BY date, grp, turnover) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY date, grp) AS n FROM valid WHERE volume > 20),
    c AS (SELECT date, grp, count(*) AS names, max(CASE WHEN r / n <= 1 / 3 THEN turnover END) AS c1, max(CASE WHEN r / n <= 2 / 3 THEN turnover END) AS c2 FROM p GROUP BY 1, 2)
    SELECT v.date, v.entity, v.grp, CAST(CASE WHEN names >= 5 THEN CASE WHEN turnover <= c1 THEN 1 WHEN turnover <= c2 THEN 2 ELSE 3 END END AS INTEGER) AS segment FROM valid v LEFT JOIN c USING (date, grp)""",
    "valid",
)
def _(f):
    return C.tertile_segments(valid(f), "turnover", F.col("volume") > 20, min_names=5).select(*KEY, "segment")


@query("w17_ntile_buckets", "SELECT bucket, count(*) AS n, round(avg(close), 4) AS mean FROM (SELECT close, CAST(ntile(5) OVER (ORDER BY close, entity * 100000 + datediff('day', DATE '1990-01-01', date)) AS INTEGER) AS bucket FROM bars) GROUP BY bucket", "bars")
def _(f):
    rows = f.bars.withColumn("tie", F.col("entity") * 100000 + F.datediff("date", F.lit("1990-01-01").cast("date")))
    return C.ntile_buckets(rows, "close", 5, "tie").groupBy("bucket").agg(F.count("*").alias("n"), rounded(F.avg("close"), 4).alias("mean"))


@query("w18_intervals", "SELECT entity, available_from, lead(available_from) OVER (PARTITION BY entity ORDER BY available_from) AS valid_to, period_end, value FROM (SELECT entity, available_from, max_by(period_end, (period_end, is_revision)) AS period_end, max_by(value, (period_end, is_revision)) AS value FROM vintages GROUP BY 1, 2)", "vintages")
def _(f):
    return pit.intervals(f.vintages, by=["entity"], order=["period_end", "is_revision"], values=["period_end", "value"])


@query("w19_cumulative_events", f"SELECT date, entity, grp, CAST(sum(CASE WHEN open = 0 THEN 1 ELSE 0 END) OVER ({PATH}) AS BIGINT) AS events FROM bars", "bars")
def _(f):
    return f.bars.withColumn("flag", X.is_halted()).select(*KEY, R.cumulative_events("flag").alias("events"))


@query("w20_month_end_row", MONTHLY, "bars")
def _(f):
    return monthly(f)


@query("w21_step_change_scan", f"SELECT CAST(year(date) AS INTEGER) AS year, count(*) FILTER (r > 1.5) AS up, count(*) FILTER (r < 0.6667) AS down FROM (SELECT date, close / lag(close) OVER ({PATH}) AS r FROM bars) WHERE r > 1.5 OR r < 0.6667 GROUP BY 1", "bars")
def _(f):
    return R.step_changes(f.bars, "close", 0.6667, 1.5).groupBy(F.year("date").alias("year")).agg(F.count_if(F.col("ratio") > 1.5).alias("up"), F.count_if(F.col("ratio") < 0.6667).alias("down"))


# Top-k and set operations


@query("t01_topk_per_group", "SELECT date, entity, rank FROM (SELECT date, entity, CAST(row_number() OVER (PARTITION BY date ORDER BY turnover DESC, entity) AS INTEGER) AS rank FROM valid) WHERE rank <= 3", "valid")
def _(f):
    return C.topk(valid(f), "turnover", 3).select("date", "entity", "rank")


@query("t02_top_fraction", "SELECT date, entity, grp FROM (SELECT date, entity, grp, (rank() OVER (PARTITION BY date, grp ORDER BY turnover) + (count(*) OVER (PARTITION BY date, grp, turnover) - 1) / 2.0) / count(*) OVER (PARTITION BY date, grp) AS p FROM valid) WHERE p >= 0.8", "valid")
def _(f):
    return C.top_fraction(valid(f), "turnover", 0.8, P.cross).select(*KEY)


@query("t03_global_topn", "SELECT date, entity, close FROM bars ORDER BY close DESC, date, entity LIMIT 100", "bars")
def _(f):
    return C.global_topn(f.bars, [F.desc("close"), F.col("date"), F.col("entity")], 100).select("date", "entity", "close")


@query("t04_grid_dates", "SELECT date, CAST((n - 1) // 20 AS INTEGER) AS grid_idx FROM (SELECT date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT date FROM bars)) WHERE (n - 1) % 20 = 0", "bars")
def _(f):
    return S.grid_dates(f.bars, 20)


@query("t05_stable_order", "SELECT date, entity, grp, close FROM bars ORDER BY date, entity, grp", "bars")
def _(f):
    return C.stable_order(f.bars.select(*KEY, "close"))


@query("u01_union_all", "SELECT 'customer' AS side, c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2")
def _(f):
    a = f.table("customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n")).withColumn("side", F.lit("customer"))
    b = f.table("supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("n")).withColumn("side", F.lit("supplier"))
    return a.unionByName(b)


@query("u02_union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def _(f):
    return f.table("customer").select(F.col("c_nationkey").alias("nation")).union(f.table("supplier").select("s_nationkey")).distinct()


@query("u03_diagonal_concat", "SELECT c_custkey AS id, c_mktsegment AS segment, NULL AS balance FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier")
def _(f):
    a = f.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(f.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")), allowMissingColumns=True)


@query("u04_set_difference", "SELECT DISTINCT date FROM bars EXCEPT SELECT receipt_date FROM filings", "bars filings")
def _(f):
    return f.bars.select("date").distinct().join(f.filings.select(F.col("receipt_date").alias("date")), "date", "left_anti")
