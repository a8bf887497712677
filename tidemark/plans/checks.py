"""Queries of data quality, profiling, bookkeeping and descriptive analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.exprs import is_halted, rounded
from tidemark.operators import describe as E
from tidemark.operators import quality as Q
from tidemark.operators import windows as R
from tidemark.operators.joins import snapshot_overlap
from tidemark.plans.core import KEY, MONTHLY, PATH, monthly, valid
from tidemark.plans.features import rounded_all
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.registry import query


def macro_facts(f: Fixtures):
    return f.macro.select(F.col("series").alias("code"), F.col("obs_date").alias("date"), F.when(F.col("vintage") != "F", F.col("value")).alias("value"), "available_from").filter("vintage = 'O' or vintage = 'F' and day(obs_date) = 3").drop("vintage")


FACTS = "facts AS (SELECT series AS code, obs_date AS date, CASE WHEN vintage <> 'F' THEN value END AS value, available_from FROM macro WHERE vintage = 'O' OR vintage = 'F' AND day(obs_date) = 3)"
COVER = """cover AS (SELECT c.code, t.target, count(f.code) AS fact, count(f.value) AS non_null, count(*) FILTER (f.available_from > f.date) AS pit_violations
      FROM (SELECT DISTINCT code FROM facts) c, (SELECT count(DISTINCT date) AS target FROM bars) t LEFT JOIN (SELECT * FROM facts WHERE date IN (SELECT date FROM bars)) f ON f.code = c.code GROUP BY 1, 2)"""


@query("q01_coverage_report", f"WITH {FACTS}, {COVER} SELECT code, target, fact, non_null, pit_violations, fact - non_null AS nulls, target - fact AS missing, round(non_null / target::DOUBLE, 6) AS ratio FROM cover", "macro bars")
def _(f):
    facts = macro_facts(f)
    return Q.coverage_report(f.bars, facts.select("code"), facts).withColumn("ratio", rounded("ratio"))


@query(
    "q02_readiness_report",
    f"""WITH {FACTS}, {COVER}, d AS (SELECT date, count(*) OVER (ORDER BY date DESC) AS l FROM (SELECT DISTINCT date FROM bars)), o AS (SELECT code, min(date) AS first_date, count(DISTINCT date) AS h FROM facts WHERE value IS NOT NULL GROUP BY 1)
    SELECT code, first_date, round(h / l::DOUBLE, 6) AS own_ratio, CASE WHEN coalesce(h / l::DOUBLE >= 0.95, true) AND pit_violations = 0 THEN true ELSE false END AS ready FROM cover LEFT JOIN o USING (code) LEFT JOIN d ON d.date = first_date""",
    "macro bars",
)
def _(f):
    facts = macro_facts(f)
    cover = Q.coverage_report(f.bars, facts.select("code"), facts)
    return Q.readiness_report(cover, facts, f.bars).select("code", "first_date", rounded("own_ratio").alias("own_ratio"), "ready")


@query("q03_freshness_gate", "SELECT metric, max_lag, max(date) AS latest, CAST(datediff('day', max(date), DATE '2024-02-01') AS INTEGER) AS age_days, coalesce(datediff('day', max(date), DATE '2024-02-01') > max_lag, true) AS stale FROM (VALUES ('click', 1), ('view', 5), ('none', 3)) l(metric, max_lag) LEFT JOIN flows USING (metric) GROUP BY 1, 2", "flows")
def _(f):
    limits = f.spark.createDataFrame([("click", 1), ("view", 5), ("none", 3)], "metric string, max_lag int")
    return Q.freshness_gate(f.flows, limits, code="metric", date="date", today=F.to_date(F.lit("2024-02-01")))


@query("q04_receipt_pairing_quality", "SELECT year(receipt_date) AS year, kind, count(*) AS n, count(*) FILTER (status = 'O') AS verified, round(count(*) FILTER (status = 'O') / count(*)::DOUBLE, 6) AS verified_ratio FROM filings GROUP BY 1, 2", "filings")
def _(f):
    rows = f.filings.withColumn("year", F.year("receipt_date").cast("long"))
    return rounded_all(Q.ratios(rows, ["year", "kind"], {"verified": F.col("status") == "O"}), 6)


@query("q04_single_receipt_check", "SELECT entity, receipt_date, count(DISTINCT receipt) AS receipts FROM filings GROUP BY 1, 2 HAVING count(DISTINCT receipt) > 1", "filings")
def _(f):
    return Q.multi_receipt_keys(f.filings, ["entity", "receipt_date"], "receipt")


@query(
    "q05_vintage_quality",
    "WITH e AS (SELECT q, entity, year, count(*) AS n, max(CASE WHEN is_revision THEN 1 ELSE 0 END) AS r, min(year) AS p FROM vintages GROUP BY 1, 2, 3) SELECT q, count(*) AS facts, count(*) FILTER (n > 1) AS multi_vintage, CAST(sum(r) AS BIGINT) AS revised, count(*) FILTER (p > (SELECT min(year) FROM vintages v WHERE v.q = e.q)) AS fallback FROM e GROUP BY q",
    "vintages",
)
def _(f):
    return Q.vintage_quality(f.vintages, ["entity", "year"], ["q"], priority="year", revision="is_revision")


@query("q06_quarterly_quality", "SELECT year, count(*) AS n, count(*) FILTER (is_revision) AS revised, round(count(*) FILTER (is_revision) / count(*)::DOUBLE, 6) AS revised_ratio FROM vintages GROUP BY 1", "vintages")
def _(f):
    return rounded_all(Q.ratios(f.vintages, ["year"], {"revised": F.col("is_revision")}), 6)


@query(
    "q07_feature_coverage",
    "WITH d AS (SELECT grp, date, 'ret' AS feature, count(*) AS n, count(ret) AS have FROM valid GROUP BY 1, 2 UNION ALL SELECT grp, date, 'lag_close', count(*), count(lag_close) FROM valid GROUP BY 1, 2) SELECT grp, feature, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(have) AS BIGINT) AS non_null, round(sum(have) / sum(n)::DOUBLE, 6) AS ratio, round(min(have / n::DOUBLE), 6) AS min_daily, round(median(have / n::DOUBLE), 6) AS median_daily FROM d GROUP BY 1, 2",
    "valid",
)
def _(f):
    return rounded_all(Q.feature_coverage(valid(f), ["ret", "lag_close"], ["grp"]), 6)


@query("q08_vintage_window_diff", "SELECT entity, year, q, min_by(value, (available_from, value)) AS old, max_by(value, (available_from, value)) AS new, count(*) AS vintages, min_by(value, (available_from, value)) IS DISTINCT FROM max_by(value, (available_from, value)) AS changed FROM vintages GROUP BY 1, 2, 3", "vintages")
def _(f):
    return Q.vintage_window_diff(f.vintages, ["entity", "year", "q"])


@query("q09_identity_pass_rate", "SELECT kind, count(*) AS n, count(*) FILTER (amount % 7 <> 0) AS ok, round(count(*) FILTER (amount % 7 <> 0) / count(*)::DOUBLE, 6) AS ok_ratio FROM filings GROUP BY 1", "filings")
def _(f):
    return rounded_all(Q.ratios(f.filings, ["kind"], {"ok": F.pmod("amount", F.lit(7)) != 0}), 6)


@query("q10_filing_receipt_quality", "SELECT year(receipt_date) AS year, count(*) AS n, count(*) FILTER (kind = '4-NOT SPECIFIED') AS amend, count(*) FILTER (status = 'P') AS unclassified, round(count(*) FILTER (kind = '4-NOT SPECIFIED') / count(*)::DOUBLE, 6) AS amend_ratio, round(count(*) FILTER (status = 'P') / count(*)::DOUBLE, 6) AS unclassified_ratio FROM filings GROUP BY 1", "filings")
def _(f):
    rows = f.filings.withColumn("year", F.year("receipt_date").cast("long"))
    return rounded_all(Q.ratios(rows, ["year"], {"amend": F.col("kind") == "4-NOT SPECIFIED", "unclassified": F.col("status") == "P"}), 6)


@query("q11a_profile_counts", "SELECT count(*) AS rows, count(DISTINCT entity) AS entities, count(DISTINCT date) AS times, min(date) AS min_time, max(date) AS max_time FROM bars", "bars")
def _(f):
    return Q.profile_counts(f.bars, "entity", "date")


@query("q11b_profile_time", "SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS rows, count(DISTINCT entity) AS entities FROM bars GROUP BY 1", "bars")
def _(f):
    return Q.profile_time(f.bars, "entity", F.year("date"))


@query("q11c_profile_categories", "SELECT 'kind' AS \"column\", kind AS value, count(*) AS rows, count(DISTINCT entity) AS entities FROM filings GROUP BY 2 UNION ALL SELECT 'status', status, count(*), count(DISTINCT entity) FROM filings GROUP BY 2", "filings")
def _(f):
    return Q.profile_categories(f.filings, ["kind", "status"], "entity")


@query("q11d_profile_nulls", "SELECT 'doc_id' AS \"column\", 100.0 * count(*) FILTER (doc_id IS NULL) / count(*) AS null_pct, NULL AS blank_pct FROM documents UNION ALL " + " UNION ALL ".join(f"SELECT '{c}', 100.0 * count(*) FILTER ({c} IS NULL) / count(*), 100.0 * count(*) FILTER (trim({c}) = '') / count(*) FROM documents" for c in ("text", "lang", "source")) + " UNION ALL SELECT 'n_chars', 100.0 * count(*) FILTER (n_chars IS NULL) / count(*), NULL FROM documents")
def _(f):
    return Q.profile_nulls(f.table("documents"))


@query("q11e_profile_duplicates", "SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess_rows FROM (SELECT count(*) AS n FROM flows GROUP BY date, entity, metric HAVING count(*) > 1)", "flows")
def _(f):
    return Q.profile_duplicates(f.flows, ["date", "entity", "metric"])


@query("q11f_profile_per_entity", "SELECT min(n) AS min, max(n) AS max, round(avg(n), 6) AS avg, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.95), 6) AS p95 FROM (SELECT count(*) AS n FROM bars GROUP BY entity)", "bars")
def _(f):
    return rounded_all(Q.profile_per_entity(f.bars, "entity"), 6)


@query("q11g_profile_grid_coverage", "SELECT round(count(*) / (count(DISTINCT entity) * count(DISTINCT date))::DOUBLE, 6) AS grid_coverage FROM bars", "bars")
def _(f):
    return rounded_all(Q.profile_grid_coverage(f.bars, "entity", "date"), 6)


@query("q11h_profile_quantiles", "SELECT grp, min(volume) AS min, max(volume) AS max, round(avg(volume), 4) AS avg, " + ", ".join(f"round(quantile_cont(volume, {q}), 4) AS p{round(100 * q):02d}" for q in (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)) + ", round(100.0 * count(*) FILTER (volume = 0) / count(volume), 4) AS zero_pct, round(100.0 * count(*) FILTER (volume < 0) / count(volume), 4) AS negative_pct FROM bars GROUP BY grp", "bars")
def _(f):
    return rounded_all(Q.profile_quantiles(f.bars, "volume", ["grp"]), 4)


@query("q11i_profile_topn", "SELECT \"column\", value, rows, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY rows DESC, value) AS rank FROM (SELECT 'p_brand' AS \"column\", p_brand AS value, count(*) AS rows FROM part GROUP BY 2 UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), count(*) FROM part GROUP BY 2)) WHERE rank <= 20")
def _(f):
    return Q.profile_topn(f.table("part"), ["p_brand", "p_size"])


@query("q11j_profile_ingest_trend", "SELECT strftime(receipt_date, '%Y-%m') AS month, count(*) AS rows FROM filings GROUP BY 1", "filings")
def _(f):
    return Q.profile_ingest_trend(f.filings, "receipt_date")


@query("q11k_profile_units", "SELECT 'p_type' AS \"column\", p_type AS value, count(*) AS rows, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) AS INTEGER) AS rank FROM part GROUP BY p_type")
def _(f):
    return Q.profile_topn(f.table("part"), ["p_type"], 30)


@query("q11l_profile_fk", "SELECT count(*) AS child_keys, count(*) FILTER (k NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)) AS orphans FROM (SELECT DISTINCT o_custkey AS k FROM orders)")
def _(f):
    return Q.profile_fk(f.table("orders"), f.table("customer").filter("c_custkey % 10 <> 0"), "o_custkey", "c_custkey")


@query("q11m_profile_pit", "SELECT series, count(*) AS rows, count(*) FILTER (available_from > obs_date + 5) AS late, CAST(max(datediff('day', obs_date + 5, available_from)) FILTER (available_from > obs_date + 5) AS INTEGER) AS max_days FROM macro GROUP BY 1", "macro")
def _(f):
    return Q.profile_pit(f.macro.withColumn("due", F.date_add("obs_date", 5)), "available_from", "due", ["series"])


@query("q11n_profile_freshness", "SELECT kind, 10 AS max_lag, max(receipt_date) AS latest, CAST(datediff('day', max(receipt_date), DATE '2001-08-10') AS INTEGER) AS age_days, datediff('day', max(receipt_date), DATE '2001-08-10') > 10 AS stale FROM filings GROUP BY 1", "filings")
def _(f):
    limits = f.filings.select("kind").distinct().withColumn("max_lag", F.lit(10))
    return Q.freshness_gate(f.filings, limits, code="kind", date="receipt_date", today=F.to_date(F.lit("2001-08-10")))


@query("q11o_drilldown", "SELECT entity, CAST(year(date) AS INTEGER) AS year, count(*) AS rows, count(DISTINCT grp) AS entities FROM bars WHERE entity IN (SELECT DISTINCT entity FROM bars ORDER BY entity LIMIT 5) GROUP BY 1, 2", "bars")
def _(f):
    return Q.profile_time(Q.drilldown(f.bars, "entity", 5), "grp", F.year("date"), ["entity"])


LIVE = "NOT (open = 0 AND high = 0 AND low = 0)"


@query("q12a_ohlc_identity", f"SELECT grp, count(*) AS rows, count(*) FILTER ({LIVE} AND (high < low OR high < open OR low > open OR high < close OR low > close)) AS violations, count(*) FILTER ({LIVE} AND close > high) AS close_above_high FROM bars GROUP BY 1", "bars")
def _(f):
    return Q.ohlc_identity(f.bars, ["grp"])


@query("q12b_impossible_moves", f"SELECT CAST(year(date) AS INTEGER) AS year, count(*) FILTER (r > 1.5) AS up, count(*) FILTER (r < 0.6667) AS down FROM (SELECT date, close / lag(close) OVER ({PATH}) AS r FROM valid) WHERE r > 1.5 OR r < 0.6667 GROUP BY 1", "valid")
def _(f):
    return R.step_changes(valid(f), "close", 0.6667, 1.5).groupBy(F.year("date").alias("year")).agg(F.count_if(F.col("ratio") > 1.5).alias("up"), F.count_if(F.col("ratio") < 0.6667).alias("down"))


@query("q12c_survivorship_coverage", "SELECT as_of, count(*) AS listed, count(*) FILTER (entity IN (SELECT entity FROM filings WHERE kind = '1-URGENT' AND amount > 450000)) AS covered, round(100 * (1 - count(*) FILTER (entity IN (SELECT entity FROM filings WHERE kind = '1-URGENT' AND amount > 450000)) / count(*)::DOUBLE), 5) + 0.0 AS missing_pct FROM snapshots GROUP BY 1", "snapshots filings")
def _(f):
    return rounded_all(Q.survivorship_coverage(f.snapshots, f.filings.filter("kind = '1-URGENT' and amount > 450000"), as_of="as_of", entity="entity"))


@query("q12d_halted_ratio", "SELECT grp, round(100 * avg(CASE WHEN open = 0 AND high = 0 AND low = 0 THEN 1.0 ELSE 0 END), 5) AS halted_pct, round(100 * avg(CASE WHEN volume = 0 THEN 1.0 ELSE 0 END), 5) AS zero_volume_pct FROM bars GROUP BY 1", "bars")
def _(f):
    return rounded_all(Q.halted_ratio(f.bars, ["grp"]))


@query("q12e_listing_span", "SELECT CAST(min(d) AS INTEGER) AS min, CAST(max(d) AS INTEGER) AS max, round(avg(d), 5) AS avg, round(median(d), 5) AS p50 FROM (SELECT datediff('day', min(date), max(date)) AS d FROM bars GROUP BY entity)", "bars")
def _(f):
    return rounded_all(Q.listing_span(f.bars, "entity", "date"))


@query("q12g_join_coverage_by_year", "SELECT year, count(*) AS keys, count(*) FILTER (hit) AS matched, round(100.0 * count(*) FILTER (hit) / count(*), 5) AS matched_pct FROM (SELECT DISTINCT CAST(year(receipt_date) AS INTEGER) AS year, entity, receipt_date AS date, (entity, receipt_date) IN (SELECT (entity, date) FROM bars) AS hit FROM filings) GROUP BY 1", "filings bars")
def _(f):
    left = f.filings.select("entity", F.col("receipt_date").alias("date"), F.year("receipt_date").alias("year"))
    return rounded_all(Q.join_coverage(left, f.bars, ["entity", "date"], ["year"]))


@query("q12h_top_concepts", "SELECT p_brand, count(*) AS rows, round(100 * avg(CASE WHEN TRY_CAST(right(p_name, 1) || p_size AS DOUBLE) IS NOT NULL THEN 1.0 ELSE 0 END), 5) AS numeric_pct FROM part GROUP BY 1 ORDER BY rows DESC, p_brand LIMIT 10")
def _(f):
    rows = f.table("part").withColumn("t", F.concat(F.expr("right(p_name, 1)"), F.col("p_size").cast("string")))
    return rounded_all(Q.top_concepts(rows, "p_brand", "t", 10))


@query("q12i_orphan_documents", "SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0)")
def _(f):
    return f.table("labels").select("doc_id").distinct().join(f.table("documents").filter("doc_id % 3 <> 0"), "doc_id", "left_anti")


@query("q12j_statement_mix", "SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_tax > 0.05) AS nonstandard, round(count(*) FILTER (l_tax > 0.05) / count(*)::DOUBLE, 6) AS nonstandard_ratio FROM lineitem GROUP BY 1, 2")
def _(f):
    return rounded_all(Q.ratios(f.table("lineitem"), ["l_returnflag", "l_linestatus"], {"nonstandard": F.col("l_tax") > 0.05}), 6)


@query("q12k_impairment", "SELECT c_mktsegment, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS negative, round(count(*) FILTER (c_acctbal < 0) / count(*)::DOUBLE, 6) AS negative_ratio FROM customer GROUP BY 1")
def _(f):
    return rounded_all(Q.ratios(f.table("customer"), ["c_mktsegment"], {"negative": F.col("c_acctbal") < 0}), 6)


@query(
    "q12f_source_overlap",
    "WITH x AS (SELECT vintage, series, obs_date, round(max(value), 6) AS v FROM macro GROUP BY ALL) SELECT count(*) AS overlap, count(*) FILTER (a.v IS DISTINCT FROM b.v) AS conflicts FROM x a JOIN x b USING (series, obs_date) WHERE a.vintage = 'O' AND b.vintage = 'F'",
    "macro",
)
def _(f):
    x = f.macro.groupBy("vintage", "series", "obs_date").agg(rounded(F.max("value"), 6).alias("v"))
    return snapshot_overlap(x.filter("vintage = 'O'"), x.filter("vintage = 'F'"), ["series", "obs_date"], "v")


@query("q12m_lookahead_violations", f"WITH {FACTS} SELECT code, count(*) AS rows, count(*) FILTER (available_from > date) AS late, CAST(max(datediff('day', date, available_from)) FILTER (available_from > date) AS INTEGER) AS max_days FROM facts GROUP BY 1", "macro")
def _(f):
    return Q.profile_pit(macro_facts(f), "available_from", "date", ["code"])


@query("q12t_direction_balance", "SELECT sign(value)::INTEGER AS direction, count(*) AS facts, count(DISTINCT entity) AS entities, count(DISTINCT year(date)) AS years, CAST(min(year(date)) AS INTEGER) AS first_year, CAST(max(year(date)) AS INTEGER) AS last_year FROM flows GROUP BY 1", "flows")
def _(f):
    return Q.metric_coverage(f.flows.withColumn("direction", F.signum("value").cast("int")), "direction", "entity", F.year("date"))


@query("q12l_metric_coverage", "SELECT kind, count(*) AS facts, count(DISTINCT entity) AS entities, count(DISTINCT year(receipt_date)) AS years, CAST(min(year(receipt_date)) AS INTEGER) AS first_year, CAST(max(year(receipt_date)) AS INTEGER) AS last_year FROM filings GROUP BY 1", "filings")
def _(f):
    return Q.metric_coverage(f.filings, "kind", "entity", F.year("receipt_date"))


@query("q12n_stale_runs", "WITH c AS (SELECT entity, date, CASE WHEN lag(open = 0) OVER (PARTITION BY entity ORDER BY date) IS NOT DISTINCT FROM (open = 0) AND row_number() OVER (PARTITION BY entity ORDER BY date) > 1 THEN 0 ELSE 1 END AS c FROM bars), i AS (SELECT entity, sum(c) OVER (PARTITION BY entity ORDER BY date) AS i FROM c) SELECT entity, max(n) AS longest_run FROM (SELECT entity, i, count(*) AS n FROM i GROUP BY 1, 2) GROUP BY 1", "bars")
def _(f):
    from tidemark.operators.aggregates import longest_runs

    return longest_runs(f.bars.withColumn("flag", is_halted()), ["entity"], ["date"], "flag")


@query("q12o_calendar_gap", "WITH d AS (SELECT date, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT date FROM bars)) SELECT entity, CAST(max(i) - min(i) + 1 - count(*) AS BIGINT) AS gap FROM (SELECT DISTINCT entity, date FROM bars) JOIN d USING (date) GROUP BY 1", "bars")
def _(f):
    return Q.calendar_gap(f.bars, f.bars, "entity", "date").withColumn("gap", F.col("gap").cast("long"))


@query("q12p_catalog_orphans", "SELECT n_nationkey, n_name, count(s_suppkey) AS inputs, count(s_suppkey) = 0 AS orphan FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2")
def _(f):
    return Q.catalog_orphans(f.table("nation").select("n_nationkey", "n_name"), f.table("supplier").select(F.col("s_nationkey").alias("n_nationkey")), "n_nationkey")


@query("q12q_master_listing", "SELECT c_mktsegment, count(*) AS keys, count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) AS matched, round(100.0 * count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) / count(*), 5) AS matched_pct FROM customer GROUP BY 1")
def _(f):
    left = f.table("customer").select("c_custkey", "c_mktsegment")
    return rounded_all(Q.join_coverage(left, f.table("orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"], ["c_mktsegment"]))


def runs(f: Fixtures):
    """Run audit rows from events: type, status, start, end, JSON counters."""
    e = f.table("events")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "running").otherwise("success")
    end = F.when(status != "running", F.timestamp_add("SECOND", F.floor("value").cast("int"), "ts"))
    counts = F.concat(F.lit('{"tried": '), F.pmod("user_id", F.lit(4)).cast("string"), F.lit(', "written": '), F.pmod("event_id", F.lit(3)).cast("string"), F.lit("}"))
    return e.select("event_id", F.when(F.pmod("user_id", F.lit(2)) == 0, "sync").otherwise("backfill").alias("run_type"), status.alias("status"), F.col("ts").alias("started_at"), end.alias("ended_at"), counts.alias("counts"))


@query(
    "q12r_run_status_mix",
    """WITH r AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'sync' ELSE 'backfill' END AS run_type, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'success' END AS status, ts, value FROM events)
    SELECT run_type, status, count(*) AS runs, round(avg(CASE WHEN status <> 'running' THEN floor(value) END), 5) AS mean_seconds, count(*) FILTER (status = 'running' AND floor(epoch(TIMESTAMP '2024-01-20 00:00:00')) - floor(epoch(ts)) > 86400) AS stale_running FROM r GROUP BY 1, 2""",
)
def _(f):
    return rounded_all(Q.run_status_mix(runs(f), now=F.to_timestamp(F.lit("2024-01-20 00:00:00"))))


@query("q12s_zero_yield_runs", "SELECT event_id FROM events WHERE event_type NOT IN ('error', 'signup') AND user_id % 4 > 0 AND event_id % 3 = 0")
def _(f):
    return Q.zero_yield_runs(runs(f), ["tried"], ["written"]).select("event_id")


@query("q13_manifest_diff", "WITH a AS (SELECT CAST(l_suppkey AS VARCHAR) AS t, count(*) AS n FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' AND l_suppkey % 10 <> 3 GROUP BY 1), b AS (SELECT CAST(l_suppkey AS VARCHAR) AS t, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_suppkey % 10 <> 4 GROUP BY 1) SELECT coalesce(a.t, b.t) AS \"table\", a.n AS old_rows, b.n AS rows, CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'removed' WHEN abs((b.n - a.n) / a.n::DOUBLE) > 0.2 THEN 'row_drift' ELSE 'same' END AS kind FROM a FULL JOIN b ON a.t = b.t")
def _(f):
    li = f.table("lineitem")
    run = lambda cond: li.filter(cond).groupBy(F.col("l_suppkey").cast("string").alias("table")).agg(F.count("*").alias("rows"), F.lit("2000-01-01").alias("max_time"), F.array(F.lit("w")).alias("warnings"))
    return Q.manifest_diff(run("l_shipdate < timestamp '1999-01-01' and l_suppkey % 10 <> 3"), run("l_shipdate >= timestamp '1998-01-01' and l_suppkey % 10 <> 4")).select("table", "old_rows", "rows", "kind")


@query(
    "q14_validate_bars",
    f"""WITH d AS (SELECT * FROM bars WHERE date = DATE '1998-03-02'), i AS (SELECT entity, CASE WHEN close < 0 OR volume < 0 THEN 'negative' WHEN {LIVE} AND high < low THEN 'high_below_low' WHEN {LIVE} AND (close > high OR close < low) THEN 'close_outside' END AS issue FROM d)
    SELECT entity, issue FROM i WHERE issue IS NOT NULL UNION ALL SELECT entity, 'missing_bar' FROM (SELECT DISTINCT entity FROM snapshots WHERE as_of = DATE '1998-03-01') WHERE entity NOT IN (SELECT entity FROM d)""",
    "bars snapshots",
)
def _(f):
    return Q.validate_bars(f.bars, Q.universe_as_of(f.snapshots, "1998-03-02"), "1998-03-02")


@query("q15_snapshot_drift", "SELECT as_of, size, before, round(c, 6) AS change FROM (SELECT *, (size - before) / before::DOUBLE AS c FROM (SELECT as_of, count(*) AS size, lag(count(*)) OVER (ORDER BY as_of) AS before FROM snapshots GROUP BY 1)) WHERE abs(c) > 0.02", "snapshots")
def _(f):
    return Q.snapshot_drift(f.snapshots, 0.02).withColumn("change", rounded("change"))


@query("q16_universe_as_of", "SELECT as_of, entity, name FROM snapshots WHERE as_of = (SELECT max(as_of) FROM snapshots WHERE as_of <= DATE '1999-05-20')", "snapshots")
def _(f):
    return Q.universe_as_of(f.snapshots, "1999-05-20")


@query("q17_universe_diff", "SELECT coalesce(a.entity, b.entity) AS entity, CASE WHEN a.entity IS NULL THEN 'new' WHEN b.entity IS NULL THEN 'delisted' ELSE 'renamed' END AS change FROM (SELECT * FROM snapshots WHERE as_of = DATE '1998-12-01') a FULL JOIN (SELECT * FROM snapshots WHERE as_of = DATE '1999-01-01') b ON a.entity = b.entity WHERE a.name IS DISTINCT FROM b.name", "snapshots")
def _(f):
    return Q.universe_diff(f.snapshots.filter("as_of = date '1998-12-01'"), f.snapshots.filter("as_of = date '1999-01-01'"))


@query("q18_recover_delisted", "SELECT entity, min(as_of) AS first_seen, max(as_of) AS last_seen, max_by(name, as_of) AS name FROM snapshots WHERE entity % 4 <> 0 GROUP BY 1", "snapshots")
def _(f):
    return Q.recover_delisted(f.snapshots, f.table("supplier").filter("s_suppkey % 4 = 0").select(F.col("s_suppkey").alias("entity")))


@query("q19_missing_sessions", "SELECT e.entity, e.grp, c.date FROM (SELECT entity, grp, min(date) AS f FROM bars GROUP BY 1, 2) e JOIN calendar c ON c.grp = e.grp AND c.date >= e.f ANTI JOIN bars b ON b.entity = e.entity AND b.grp = e.grp AND b.date = c.date", "bars calendar")
def _(f):
    from tidemark.operators.sessions import missing_sessions

    return missing_sessions(f.bars, f.bars)


@query("q19_missing_sessions_all", "SELECT e.entity, e.grp, c.date FROM (SELECT entity, grp, min(date) AS f FROM bars GROUP BY 1, 2) e JOIN calendar c ON c.grp = e.grp AND c.date >= e.f ANTI JOIN bars b ON b.entity = e.entity AND b.grp = e.grp AND b.date = c.date", "bars calendar")
def _(f):
    from tidemark.operators.sessions import missing_sessions

    return missing_sessions(f.bars, f.bars)


@query("q20_business_days", "SELECT d AS date FROM (SELECT CAST(unnest(generate_series(DATE '1999-01-01', DATE '1999-12-31', INTERVAL 1 DAY)) AS DATE) AS d) WHERE dayofweek(d) BETWEEN 1 AND 5 AND d NOT IN (SELECT receipt_date FROM filings WHERE kind = '1-URGENT')", "filings")
def _(f):
    from tidemark.operators.sessions import business_days

    return business_days("1999-01-01", "1999-12-31", f.filings.filter("kind = '1-URGENT'").select(F.col("receipt_date").alias("date")).distinct())


@query("q20_month_end_sessions", "SELECT CAST(date_trunc('month', date) AS DATE) AS month, max(date) AS session FROM bars GROUP BY 1", "bars")
def _(f):
    from tidemark.operators.sessions import month_end_sessions

    return month_end_sessions(f.bars)


@query("q21_incremental_range", "SELECT min(l) AS lagging_date, arg_min(kind, (l, kind)) AS lagging_group, min(l) - 4 AS start FROM (SELECT kind, max(receipt_date) AS l FROM filings GROUP BY 1)", "filings")
def _(f):
    return Q.incremental_range(f.filings, "kind", "receipt_date", 5)


@query(
    "q22_outstanding_windows",
    """WITH d AS (SELECT date, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT date FROM flows WHERE date >= DATE '2024-01-10')), h AS (SELECT entity, metric, count(*) AS have, max(i) AS m FROM (SELECT DISTINCT entity, metric, date FROM flows) JOIN d USING (date) GROUP BY 1, 2)
    SELECT entity, metric, have, have < m AS hole, date AS needed_from FROM h LEFT JOIN d ON i = CASE WHEN have = m THEN m + 1 ELSE 1 END""",
    "flows",
)
def _(f):
    return Q.outstanding_windows(f.flows, f.flows, ["entity", "metric"], "date", "2024-01-10")


@query(
    "q23_slice_reconcile",
    """WITH l AS (SELECT c_custkey, c_custkey % 4 AS expected_rows, DATE '2000-01-01' + CAST(c_custkey % 40 AS INTEGER) AS checked_at FROM customer), a AS (SELECT o_custkey, count(*) % 5 AS rows FROM orders GROUP BY 1)
    SELECT c_custkey, CASE WHEN expected_rows = 0 AND datediff('day', checked_at, DATE '2000-02-01') > 14 THEN 'expired_no_data' WHEN expected_rows = 0 THEN 'no_data' WHEN coalesce(rows, 0) = expected_rows THEN 'complete' WHEN coalesce(rows, 0) > 0 THEN 'half_written' ELSE 'retry' END AS state FROM l LEFT JOIN a ON o_custkey = c_custkey""",
)
def _(f):
    ledger = f.table("customer").select("c_custkey", F.pmod("c_custkey", F.lit(4)).alias("expected_rows"), F.date_add(F.to_date(F.lit("2000-01-01")), F.pmod("c_custkey", F.lit(40)).cast("int")).alias("checked_at"))
    actual = f.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.pmod(F.count("*"), F.lit(5)).alias("rows"))
    return Q.slice_reconcile(ledger, actual, ["c_custkey"], now=F.to_date(F.lit("2000-02-01")), ttl_days=14).select("c_custkey", "state")


@query("q24_short_slices", "SELECT entity, grp, rows, round(m, 5) AS median FROM (SELECT *, median(rows) OVER (PARTITION BY grp) AS m FROM (SELECT entity, grp, count(*) AS rows FROM bars GROUP BY 1, 2)) WHERE rows < 0.97 * m", "bars")
def _(f):
    return rounded_all(Q.short_slices(f.bars, ["entity"], ["grp"], 0.97))


@query("q25_staleness", "SELECT 'bars' AS domain, max(date) AS latest, datediff('day', max(date), DATE '2001-11-10') > 3 AS stale FROM bars UNION ALL SELECT 'filings', max(receipt_date), datediff('day', max(receipt_date), DATE '2001-11-10') > 3 FROM filings", "bars filings")
def _(f):
    rows = f.bars.select(F.lit("bars").alias("domain"), "date").unionByName(f.filings.select(F.lit("filings").alias("domain"), F.col("receipt_date").alias("date")))
    limits = rows.select("domain").distinct().withColumn("max_lag", F.lit(3))
    return Q.freshness_gate(rows, limits, code="domain", date="date", today=F.to_date(F.lit("2001-11-10"))).select("domain", "latest", "stale")


@query(
    "q26_series_complete",
    """WITH d AS (SELECT date, row_number() OVER (ORDER BY date) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM flows)), o AS (SELECT metric, count(*) AS observed, min(i) AS a, max(i) AS b, max(n) AS expected FROM (SELECT DISTINCT metric, date FROM flows) JOIN d USING (date) GROUP BY 1)
    SELECT metric, observed, expected, CAST(floor(10000 * observed / expected::DOUBLE) AS BIGINT) AS bps, b - a + 1 = observed AND a <= 2 AND expected - b <= 1 AS complete FROM o""",
    "flows",
)
def _(f):
    return Q.series_complete(f.flows, f.flows, ["metric"], "date", 1)


@query("q27_cross_source_validation", "WITH x AS (SELECT source, date, entity, metric, round(sum(value), 4) AS v FROM flows GROUP BY ALL) SELECT a.date, count(*) AS both, count(*) FILTER (abs(a.v - b.v) > 0.5 * abs(a.v)) AS far, round(avg(abs(a.v - b.v)), 8) AS mean_abs FROM x a JOIN x b USING (date, entity, metric) WHERE a.source = 'P' AND b.source = 'S' GROUP BY 1", "flows")
def _(f):
    x = f.flows.groupBy("source", "date", "entity", "metric").agg(rounded(F.sum("value"), 4).alias("v"))
    both = x.filter("source = 'P'").join(x.filter("source = 'S'").select("date", "entity", "metric", F.col("v").alias("w")), ["date", "entity", "metric"])
    gap = F.abs(F.col("v") - F.col("w"))
    return both.groupBy("date").agg(F.count("*").alias("both"), F.count_if(gap > 0.5 * F.abs("v")).alias("far"), rounded(F.avg(gap), 8).alias("mean_abs"))


@query("q28_attribute_verification", "SELECT length(p_type) AS code_length, count(*) AS n, count(*) FILTER (p_size > 45) AS implausible, CAST(floor(p_size / 10) * 10 AS BIGINT) AS decade FROM part GROUP BY 1, 4")
def _(f):
    return f.table("part").groupBy(F.length("p_type").cast("long").alias("code_length"), (F.floor(F.col("p_size") / 10) * 10).alias("decade")).agg(F.count("*").alias("n"), F.count_if(F.col("p_size") > 45).alias("implausible"))


@query("q29_reports_available", "SELECT y AS year, q, due FROM (SELECT y, q, last_day(make_date(y, q * 3, 1)) + CASE WHEN q = 4 THEN 90 ELSE 45 END AS due FROM (SELECT unnest(range((SELECT CAST(min(year(l_shipdate)) AS INTEGER) FROM lineitem), 2001)) AS y), (SELECT unnest([1, 2, 3, 4]) AS q)) WHERE due <= DATE '2000-10-01'")
def _(f):
    first = f.table("lineitem").agg(F.min(F.year("l_shipdate"))).first()[0]
    return Q.reports_available(f.spark, first, "2000-10-01").select(F.col("year").cast("long").alias("year"), "q", "due")


@query("q30_backfill_first_seen", "WITH m AS (SELECT s_suppkey AS entity, CASE WHEN s_suppkey % 3 = 0 THEN DATE '1995-01-01' END AS first_seen, DATE '2001-01-01' AS last_seen FROM supplier) SELECT m.entity, coalesce(m.first_seen, (SELECT min(as_of) FROM snapshots s WHERE s.entity = m.entity), m.last_seen) AS first_seen, m.last_seen FROM m", "snapshots")
def _(f):
    d = lambda x: F.to_date(F.lit(x))
    master = f.table("supplier").select(F.col("s_suppkey").alias("entity"), F.when(F.pmod("s_suppkey", F.lit(3)) == 0, d("1995-01-01")).alias("first_seen"), d("2001-01-01").alias("last_seen"))
    return Q.backfill_first_seen(master, f.snapshots)


# Descriptive analyses

SAMPLE = f"ms AS ({MONTHLY})"


@query("e01_month_end_sample", f"WITH {SAMPLE} SELECT entity, grp, month, round(least(greatest(close, quantile_cont(close, 0.01) OVER w), quantile_cont(close, 0.99) OVER w), 4) AS close_w, round(percent_rank() OVER (PARTITION BY month, grp ORDER BY close), 6) AS pct_group, round(percent_rank() OVER (PARTITION BY month ORDER BY close), 6) AS pct_all, month = max(month) OVER (PARTITION BY entity, grp) AS latest FROM ms WINDOW w AS (PARTITION BY month)", "bars")
def _(f):
    out = E.month_end_sample(f.bars, "close")
    return out.select("entity", "grp", "month", rounded("close_w", 4).alias("close_w"), rounded("pct_group").alias("pct_group"), rounded("pct_all").alias("pct_all"), "latest")


@query("e02_distribution_by", "SELECT grp, count(ret) AS n, round(avg(ret), 5) + 0.0 AS mean, round(quantile_cont(ret, 0.5), 5) + 0.0 AS p50, round(1 - count(ret) / count(*)::DOUBLE, 6) AS missing_rate FROM valid GROUP BY 1", "valid")
def _(f):
    out = E.distribution_by(valid(f), "ret", ["grp"])
    return out.select("grp", "n", rounded("mean", 5).alias("mean"), rounded("p50", 5).alias("p50"), rounded("missing_rate").alias("missing_rate"))


@query("e03_annual_baseline", "WITH x AS (SELECT entity, year, max_by(CASE WHEN q = 4 THEN value END, CASE WHEN q = 4 THEN (available_from, value) END) AS num, max_by(CASE WHEN q = 1 THEN value END, CASE WHEN q = 1 THEN (available_from, value) END) AS den FROM vintages GROUP BY 1, 2) SELECT entity, year, num, den, round(num / nullif(den, 0), 5) AS ratio FROM x", "vintages")
def _(f):
    v = lambda q: F.when(F.col("q") == q, F.col("value"))
    out = E.annual_baseline(f.vintages, by=["entity"], year="year", num=v(4), den=v(1), order=["available_from", "value"])
    return out.withColumn("ratio", rounded("ratio", 5))


@query("e04_entity_profile", "SELECT entity, count(ret) AS n, round(avg(ret), 5) + 0.0 AS mean, round(quantile_cont(ret, 0.75) - quantile_cont(ret, 0.25), 5) AS iqr, round(avg(CASE WHEN ret < 0 THEN 1.0 WHEN ret IS NOT NULL THEN 0 END), 5) AS negative_share FROM valid GROUP BY 1", "valid")
def _(f):
    return rounded_all(E.entity_profile(valid(f), "ret", "entity", "date").select("entity", "n", "mean", "iqr", "negative_share"))


@query("e05_rank_persistence", f"WITH {SAMPLE}, p AS (SELECT entity, grp, month, percent_rank() OVER (PARTITION BY month ORDER BY close) AS p FROM ms) SELECT grp, h AS lag, count(*) AS n, round(corr(a.p, b.p), 6) AS corr FROM (SELECT unnest([1, 3, 12]) AS h) JOIN p a ON true JOIN (SELECT entity, month, p FROM p) b ON a.entity = b.entity AND b.month = CAST(a.month - to_months(CAST(h AS INTEGER)) AS DATE) GROUP BY 1, 2", "bars")
def _(f):
    from tidemark.operators.cross import percent_rank

    m = monthly(f).withColumn("p", percent_rank("close", ["month"]))
    return E.rank_persistence(m, "p", [1, 3, 12], by=["grp"]).withColumn("corr", rounded("corr"))


@query("e06_outliers", "SELECT date, entity, grp, round(ret, 5) + 0.0 AS ret FROM valid WHERE ret IS NOT NULL ORDER BY abs(ret) DESC, date, entity, grp LIMIT 100", "valid")
def _(f):
    return rounded_all(E.outliers(valid(f), "ret", KEY).select(*KEY, "ret"))


@query("e07_coverage_diagnosis", "SELECT CAST(year(date) AS INTEGER) AS year, grp, count(*) AS rows, count(DISTINCT entity) AS entities, round(avg(CASE WHEN ret > 0 THEN 1.0 WHEN ret IS NOT NULL THEN 0 END), 5) AS up_share, count(DISTINCT CASE WHEN ret > 0 THEN entity END) AS up_entities FROM valid GROUP BY 1, 2", "valid")
def _(f):
    rows = valid(f).withColumn("year", F.year("date"))
    return rounded_all(E.coverage_diagnosis(rows, {"up": F.col("ret") > 0}, ["year", "grp"], "entity"))


CLIPPED = "c AS (SELECT grp, least(greatest(close, quantile_cont(close, 0.01) OVER w), quantile_cont(close, 0.99) OVER w) AS x, least(greatest(volume::DOUBLE, quantile_cont(volume, 0.01) OVER w), quantile_cont(volume, 0.99) OVER w) AS y FROM bars WINDOW w AS (PARTITION BY grp))"


@query("e08_association_correlation", f"WITH {CLIPPED} SELECT grp, count(*) AS n, round(corr(x, y), 5) AS corr FROM c GROUP BY 1", "bars")
def _(f):
    return rounded_all(E.association_study(f.bars.withColumn("volume", F.col("volume").cast("double")), "close", "volume", by=["grp"])["correlation"])


@query("e08_association_buckets", f"WITH {CLIPPED} SELECT grp, CAST(b AS INTEGER) AS bucket, count(*) AS n, round(avg(x), 3) AS mean_x, round(avg(y), 5) AS mean_y FROM (SELECT *, ntile(5) OVER (PARTITION BY grp ORDER BY x, y) AS b FROM c) GROUP BY 1, 2", "bars")
def _(f):
    out = E.association_study(f.bars.withColumn("volume", F.col("volume").cast("double")), "close", "volume", by=["grp"])["buckets"]
    return out.withColumns({"mean_x": rounded("mean_x", 3), "mean_y": rounded("mean_y", 5)})


@query("e09_entity_history", f"SELECT date, entity, close, round(r, 5) + 0.0 AS ret_pct, s_name AS name FROM (SELECT *, 100 * (close / lag(close) OVER ({PATH}) - 1) AS r FROM bars WHERE entity = 7) JOIN supplier ON s_suppkey = entity ORDER BY date DESC LIMIT 10", "bars")
def _(f):
    names = f.table("supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"))
    return rounded_all(E.entity_history(f.bars, names, 7).select("date", "entity", "close", "ret_pct", "name"))
