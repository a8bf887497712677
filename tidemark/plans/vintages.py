"""Queries of vintages, quarters, issuance policies and event studies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.features import events as V
from tidemark.functions.exprs import rounded
from tidemark.plans.core import valid
from tidemark.plans.features import rounded_all
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.registry import query

# D22


def receipts(f: Fixtures) -> DataFrame:
    """Filings of vintages: every thirteenth has no date, every fifth entity no matched receipt."""
    receipt = F.col("entity") * 100_000 + F.col("year") * 10 + F.col("q") + F.when(F.col("is_revision"), 5).otherwise(0)
    return f.vintages.select("entity", "year", "q", receipt.alias("receipt"), "period_end", "is_revision", "value", F.when(receipt % 13 != 0, F.col("available_from")).alias("disclosed"))


RECEIPTS = """rc AS (SELECT *, CASE WHEN receipt % 13 <> 0 THEN available_from END AS disclosed FROM (SELECT *, entity * 100000 + year * 10 + q + CASE WHEN is_revision THEN 5 ELSE 0 END AS receipt FROM vintages))"""
TAGGED = """tg AS (SELECT entity, year, q, receipt, period_end, 'a' AS context, 90 AS duration, round(value) AS value FROM rc WHERE entity % 3 <> 1
    UNION ALL SELECT entity, year, q, receipt, period_end, 'b', 90 * q, round(value) + CASE WHEN entity % 6 = 0 THEN 1 ELSE 0 END FROM rc WHERE entity % 3 <> 1
    UNION ALL SELECT entity, year, q, receipt, period_end - 365, 'c', 90, round(value / 2) FROM rc WHERE entity % 3 <> 1
    UNION ALL SELECT entity, year, q, receipt, period_end + 400, 'd', 90, round(value / 2) FROM rc WHERE entity % 4 = 0)"""


def tagged(rows: DataFrame) -> DataFrame:
    v, ours = F.col("value"), F.col("entity") % 3 != 1
    def part(when, days, context, duration, value):
        return F.when(when, F.struct(F.date_add("period_end", days).alias("period_end"), F.lit(context).alias("context"), duration.cast("int").alias("duration"), value.alias("value")))
    parts = F.array_compact(F.array(
        part(ours, 0, "a", F.lit(90), F.floor(v + 0.5).cast("double")),
        part(ours, 0, "b", 90 * F.col("q"), F.floor(v + 0.5) + F.when(F.col("entity") % 6 == 0, 1.0).otherwise(0.0)),
        part(ours, -365, "c", F.lit(90), F.floor(v / 2 + 0.5).cast("double")),
        part(F.col("entity") % 4 == 0, 400, "d", F.lit(90), F.floor(v / 2 + 0.5).cast("double")),
    ))
    return rows.select("entity", "year", "q", "receipt", F.explode(parts).alias("t")).select("entity", "year", "q", "receipt", "t.*")


@query(
    "d22_filing_period_ends",
    f"""WITH {RECEIPTS}, {TAGGED}, t AS (SELECT receipt, max(tg.period_end) FILTER (rc.disclosed IS NULL OR tg.period_end <= rc.disclosed) AS t FROM tg JOIN rc USING (receipt) GROUP BY 1),
    s AS (SELECT receipt, period_end + CAST(entity % 2 AS INTEGER) AS s FROM rc WHERE entity % 5 < 3)
    SELECT receipt, coalesce(t, s, period_end) AS period_end, CASE WHEN t IS NOT NULL THEN 'tagged' WHEN s IS NOT NULL THEN 'settled' ELSE 'calendar' END AS period_end_source, coalesce(t <> s, false) AS period_end_conflict
    FROM rc LEFT JOIN t USING (receipt) LEFT JOIN s USING (receipt)""",
    "vintages",
)
def _(f):
    rows, keys = receipts(f), ["entity", "year", "q", "receipt"]
    settled = rows.filter("entity % 5 < 3").select(*keys, F.date_add("period_end", (F.col("entity") % 2).cast("int")).alias("settle"))
    out = V.filing_period_ends(rows.withColumnRenamed("period_end", "calendar_end"), tagged(rows), settled, keys=keys)
    return out.select("receipt", "period_end", "period_end_source", "period_end_conflict")


@query(
    "d22_receipt_pairs",
    f"""WITH {RECEIPTS}, {TAGGED}, n AS (SELECT *, row_number() OVER (PARTITION BY receipt, period_end ORDER BY duration, context) AS s, row_number() OVER (PARTITION BY receipt, period_end ORDER BY duration DESC, context) AS l FROM tg)
    SELECT rc.receipt, round(rc.value) AS value, n.value AS paired_value, n.context AS paired_context, abs(round(rc.value) - n.value) > 0 AS mismatch FROM rc LEFT JOIN n ON n.receipt = rc.receipt AND n.period_end = rc.period_end AND CASE WHEN rc.q % 2 = 0 THEN l ELSE s END = 1""",
    "vintages",
)
def _(f):
    rows = receipts(f)
    prefer = F.when(F.col("q") % 2 == 0, "longest").otherwise("shortest")
    out = V.receipt_pairs(rows.withColumn("value", F.floor(F.col("value") + 0.5).cast("double")).withColumn("prefer", prefer), tagged(rows), keys=["entity", "year", "q", "receipt", "period_end"])
    return out.select("receipt", "value", "paired_value", "paired_context", "mismatch")


@query(
    "d22_filing_lineage",
    f"""WITH {RECEIPTS} SELECT receipt, CASE WHEN entity % 5 = 0 OR disclosed IS NULL THEN 'unknown' WHEN is_revision THEN 'revision' ELSE 'original' END AS lineage, max(receipt) OVER (PARTITION BY entity, year, disclosed) AS effective_receipt FROM rc""",
    "vintages",
)
def _(f):
    rows = receipts(f).withColumn("matched", F.col("entity") % 5 != 0)
    return V.filing_lineage(rows, keys=["entity", "year"], correction="is_revision").select("receipt", "lineage", "effective_receipt")


# D23

KINDS = ("direct", "cumulative", "weighted", "instant")


def metric_facts(f: Fixtures) -> DataFrame:
    """One metric of each kind; the sum so far is reported for direct ones, wrong by one for every fifth entity."""
    v = F.floor(F.col("value") + 0.5).cast("double")
    so_far = F.sum(v).over(W.partitionBy("entity", "year", "is_revision").orderBy("q")) + F.when(F.col("entity") % 5 == 0, 1.0).otherwise(0.0)
    rows = f.vintages.select("entity", "year", "q", "is_revision", "available_from", F.col("is_revision").cast("int").alias("receipt"), v.alias("value"), so_far.alias("cumulative"))
    rows = rows.select("*", F.explode(F.array(*map(F.lit, KINDS))).alias("kind")).withColumn("metric", F.concat(F.lit("m_"), "kind"))
    gone = (F.col("entity") + F.col("year") + F.col("q")) % 17 == 0
    return rows.filter(~gone).withColumn("cumulative", F.when(F.col("kind") == "direct", F.col("cumulative")))


@query(
    "d23_reconciled_quarters",
    """WITH x AS (SELECT entity, year, q, is_revision, available_from, round(value) AS value, sum(round(value)) OVER (PARTITION BY entity, year, is_revision ORDER BY q) + CASE WHEN entity % 5 = 0 THEN 1 ELSE 0 END AS cum FROM vintages),
    w AS (SELECT * FROM x WHERE (entity + year + q) % 17 <> 0 QUALIFY row_number() OVER (PARTITION BY entity, year, q ORDER BY is_revision, available_from) = 1),
    y AS (SELECT entity, year, max(value) FILTER (q = 1) AS v1, max(value) FILTER (q = 2) AS v2, max(value) FILTER (q = 3) AS v3, max(value) FILTER (q = 4) AS v4, max(available_from) FILTER (q = 1) AS a1, max(available_from) FILTER (q = 2) AS a2,
      max(available_from) FILTER (q = 3) AS a3, max(available_from) FILTER (q = 4) AS a4, max(cum) FILTER (q = 2) AS c2, max(cum) FILTER (q = 3) AS c3 FROM w GROUP BY 1, 2),
    s AS (
      SELECT entity, year, 1 AS q, 'direct' AS kind, v1 AS standalone, a1 AS known_from, NULL::BOOLEAN AS conflict, NULL::DOUBLE AS derived FROM y WHERE v1 IS NOT NULL
      UNION ALL SELECT entity, year, 2, 'direct', CASE WHEN NOT coalesce(abs(v1 + v2 - c2) > 0, false) THEN v2 END, a2, abs(v1 + v2 - c2) > 0, v1 + v2 FROM y WHERE v2 IS NOT NULL
      UNION ALL SELECT entity, year, 3, 'direct', CASE WHEN NOT coalesce(abs(v1 + v2 + v3 - c3) > 0, false) THEN v3 END, a3, abs(v1 + v2 + v3 - c3) > 0, v1 + v2 + v3 FROM y WHERE v3 IS NOT NULL
      UNION ALL SELECT entity, year, 4, 'direct', v4 - v1 - v2 - v3, greatest(a1, a2, a3, a4), NULL, NULL FROM y WHERE v4 - v1 - v2 - v3 IS NOT NULL
      UNION ALL SELECT entity, year, 1, k, v1, a1, NULL, NULL FROM y, (VALUES ('cumulative'), ('weighted')) t(k) WHERE v1 IS NOT NULL
      UNION ALL SELECT entity, year, 2, 'cumulative', v2 - v1, greatest(a1, a2), NULL, NULL FROM y WHERE v2 - v1 IS NOT NULL
      UNION ALL SELECT entity, year, 3, 'cumulative', v3 - v2, greatest(a2, a3), NULL, NULL FROM y WHERE v3 - v2 IS NOT NULL
      UNION ALL SELECT entity, year, 4, 'cumulative', v4 - v3, greatest(a3, a4), NULL, NULL FROM y WHERE v4 - v3 IS NOT NULL
      UNION ALL SELECT entity, year, 2, 'weighted', 2 * v2 - v1, greatest(a1, a2), NULL, NULL FROM y WHERE v2 - v1 IS NOT NULL
      UNION ALL SELECT entity, year, 3, 'weighted', 3 * v3 - 2 * v2, greatest(a2, a3), NULL, NULL FROM y WHERE v3 - v2 IS NOT NULL
      UNION ALL SELECT entity, year, 4, 'weighted', 4 * v4 - 3 * v3, greatest(a3, a4), NULL, NULL FROM y WHERE v4 - v3 IS NOT NULL
      UNION ALL SELECT entity, year, q, 'instant', value, available_from, NULL, NULL FROM w),
    z AS (SELECT *, year * 4 + q AS seq FROM s)
    SELECT a.entity, a.kind, CAST(a.seq AS INTEGER) AS seq, a.standalone, a.known_from, a.conflict, a.derived, b.standalone AS lag4,
      CASE WHEN a.kind IN ('direct', 'cumulative') THEN a.standalone + p1.standalone + p2.standalone + p3.standalone END AS ttm,
      CASE WHEN a.kind IN ('direct', 'cumulative') AND a.standalone + p1.standalone + p2.standalone + p3.standalone IS NOT NULL THEN greatest(a.known_from, p1.known_from, p2.known_from, p3.known_from) END AS ttm_known_from
    FROM z a LEFT JOIN z b ON b.entity = a.entity AND b.kind = a.kind AND b.seq = a.seq - 4 LEFT JOIN z p1 ON p1.entity = a.entity AND p1.kind = a.kind AND p1.seq = a.seq - 1
      LEFT JOIN z p2 ON p2.entity = a.entity AND p2.kind = a.kind AND p2.seq = a.seq - 2 LEFT JOIN z p3 ON p3.entity = a.entity AND p3.kind = a.kind AND p3.seq = a.seq - 3""",
    "vintages",
)
def _(f):
    out = V.reconciled_quarters(metric_facts(f))
    return out.select("entity", "kind", "seq", "standalone", "known_from", "conflict", "derived", "lag4", "ttm", "ttm_known_from")


# D14


def event_vintages(f: Fixtures) -> tuple[DataFrame, DataFrame]:
    """Positions at year ends, and yearly republished lists of all events so far: later lists correct every eleventh event."""
    class_ = F.when(F.col("status") == "O", "economic_increase").when(F.col("status") == "F", "economic_decrease").when(F.col("receipt") % 97 == 0, "unclassified").otherwise("mechanical_increase")
    ev = f.filings.select("entity", "receipt", F.col("receipt_date").alias("date"), F.year("receipt_date").alias("year"), class_.alias("class"), "amount")
    years = ev.select("entity", F.col("year").alias("vintage")).distinct()
    quantity = F.col("amount") + F.when((F.col("vintage") > F.col("year")) & (F.col("receipt") % 11 == 0), 1).otherwise(0)
    known = F.date_add(F.make_date(F.col("vintage") + 1, F.lit(3), F.lit(31)), (F.col("entity") % 3 * 120).cast("int"))
    lists = years.join(ev, "entity").filter("year <= vintage").select("entity", "vintage", F.col("vintage").alias("list"), known.alias("known_from"), "date", "class", quantity.alias("quantity")).withColumnRenamed("list", "receipt")
    net = F.sum(F.when(F.col("class") == "economic_decrease", -F.col("amount")).otherwise(F.col("amount")))
    at = ev.groupBy("entity", "year").agg(net.alias("net"))
    shares = 10**9 + F.sum("net").over(W.partitionBy("entity").orderBy("year"))
    settle = F.make_date("year", F.lit(12), F.lit(31))
    return at.select("entity", "year", settle.alias("settle"), shares.alias("shares"), F.date_add(settle, 90).alias("available_from")), lists


EVENT_VINTAGES = """ev AS (SELECT entity, receipt, receipt_date AS date, CAST(year(receipt_date) AS INTEGER) AS year, amount, CASE WHEN status = 'O' THEN 1 WHEN status = 'F' THEN 2 WHEN receipt % 97 = 0 THEN 4 ELSE 3 END AS k FROM filings),
    ys AS (SELECT DISTINCT entity, year AS vintage FROM ev),
    ls AS (SELECT entity, vintage, make_date(vintage + 1, 3, 31) + CAST(entity % 3 * 120 AS INTEGER) AS known_from, date, k, amount + CASE WHEN vintage > year AND receipt % 11 = 0 THEN 1 ELSE 0 END AS quantity FROM ys JOIN ev USING (entity) WHERE year <= vintage),
    p0 AS (SELECT entity, year, make_date(year, 12, 31) AS settle, 1000000000 + sum(sum(CASE WHEN k = 2 THEN -amount ELSE amount END)) OVER (PARTITION BY entity ORDER BY year) AS shares FROM ev GROUP BY 1, 2),
    p AS (SELECT a.*, a.settle + 90 AS available_from, b.shares AS prior_shares, b.settle AS prior_settle FROM p0 a LEFT JOIN p0 b ON b.entity = a.entity AND b.year = a.year - 1)"""


def policy_sql(pick: str) -> str:
    return f"""WITH {EVENT_VINTAGES}, c AS (SELECT p.*, {pick} AS vintage FROM p),
    s AS (SELECT c.entity, c.year, c.vintage, any_value(shares) AS shares, any_value(prior_shares) AS prior_shares, coalesce(sum(quantity) FILTER (k = 1), 0) AS inc, coalesce(sum(quantity) FILTER (k = 2), 0) AS dec, coalesce(sum(quantity) FILTER (k = 3), 0) AS mech, coalesce(sum(quantity) FILTER (k = 4), 0) AS unc
      FROM c LEFT JOIN ls ON ls.entity = c.entity AND ls.vintage = c.vintage AND ls.date > c.prior_settle AND ls.date <= c.settle GROUP BY 1, 2, 3)
    SELECT entity, year, vintage, CAST(inc AS BIGINT) AS economic_increase, CAST(dec AS BIGINT) AS economic_decrease, prior_shares + inc + mech - dec = shares AS identity_ok,
      round(CASE WHEN unc = 0 AND prior_shares + inc + mech - dec = shares AND prior_shares > 0 THEN (inc - dec) / prior_shares::DOUBLE END, 6) + 0.0 AS net_issuance FROM s"""


def issuance_columns(f: Fixtures, policy: str) -> DataFrame:
    out = V.issuance_by_vintage(*event_vintages(f), policy=policy)
    return out.select("entity", "year", "vintage", F.col("economic_increase").cast("long").alias("economic_increase"), F.col("economic_decrease").cast("long").alias("economic_decrease"), "identity_ok", rounded("net_issuance").alias("net_issuance"))


@query("d14_issuance_latest", policy_sql("(SELECT max(vintage) FROM ys WHERE ys.entity = p.entity)"), "filings")
def _(f):
    return issuance_columns(f, "latest")


@query("d14_issuance_strict_pit", policy_sql("(SELECT max_by(vintage, known_from) FROM (SELECT DISTINCT entity, vintage, known_from FROM ls) v WHERE v.entity = p.entity AND v.known_from <= p.available_from)"), "filings")
def _(f):
    return issuance_columns(f, "strict_pit")


# D24


def bucket_columns(parts: tuple[str, ...]) -> list[str]:
    return [f"{p}_{a}_{b}" for a, b in V.EVENT_BUCKETS for p in parts]


OFFSETS = sorted({o for ab in V.EVENT_BUCKETS for o in ab} - {0})
CLOSE = {0: "px.close"} | {o: f"p{o}.close" for o in OFFSETS}


@query(
    "d24_event_study",
    f"""WITH o AS (SELECT entity, year, q, year * 4 + q AS seq, available_from, value, value / (1000 + entity % 7 + q) AS eps FROM vintages WHERE NOT is_revision),
    ch AS (SELECT a.*, b.eps AS eps_before, a.eps - b.eps AS change FROM o a JOIN o b ON b.entity = a.entity AND b.seq = a.seq - 4),
    h AS (SELECT *, count(change) OVER w AS history, stddev_samp(change) OVER w AS sd FROM ch WINDOW w AS (PARTITION BY entity ORDER BY seq ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
    px AS (SELECT date, entity, grp, v_idx, close, volume % 97 = 0 AS masked FROM valid),
    br AS (SELECT px.date, px.entity, px.grp, px.v_idx, {", ".join(f"{CLOSE[b]} / nullif({CLOSE[a]}, 0) - 1 AS raw_{a}_{b}" for a, b in V.EVENT_BUCKETS)}
      FROM px {" ".join(f"LEFT JOIN px p{o} ON p{o}.entity = px.entity AND p{o}.grp = px.grp AND p{o}.v_idx = px.v_idx + {o}" for o in OFFSETS)}),
    bs AS (SELECT *, {", ".join(f"avg(raw_{a}_{b}) OVER (PARTITION BY date, grp) AS bench_{a}_{b}" for a, b in V.EVENT_BUCKETS)} FROM br),
    fm AS (SELECT h.*, bs.* EXCLUDE (entity) FROM h JOIN bs ON bs.entity = h.entity AND bs.date = h.available_from),
    ct AS (SELECT fm.entity, fm.seq, {", ".join(f"coalesce(bool_or(m.v_idx > fm.v_idx + {a} AND m.v_idx <= fm.v_idx + {b}), false) AS hit_{a}_{b}" for a, b in V.EVENT_BUCKETS)}
      FROM fm LEFT JOIN px m ON m.entity = fm.entity AND m.grp = fm.grp AND m.masked GROUP BY 1, 2),
    rv AS (SELECT fm.entity, fm.seq, min(s.v_idx) - any_value(fm.v_idx) AS gap FROM fm JOIN vintages r ON r.is_revision AND r.entity = fm.entity AND r.year = fm.year AND r.q = fm.q JOIN px s ON s.entity = r.entity AND s.date = r.available_from AND s.v_idx > fm.v_idx GROUP BY 1, 2)
    SELECT entity, CAST(seq AS INTEGER) AS seq, available_from, round(change, 4) + 0.0 AS change, history, round(CASE WHEN history >= 8 AND sd > 0 THEN change / sd END, 4) + 0.0 AS sue,
      {", ".join(f"round(raw_{a}_{b}, 6) + 0.0 AS raw_{a}_{b}, round(raw_{a}_{b} - bench_{a}_{b}, 6) + 0.0 AS excess_{a}_{b}, hit_{a}_{b}" for a, b in V.EVENT_BUCKETS)}, coalesce(gap <= 60, false) AS revised,
      NOT coalesce(gap <= 60, false) AND {" AND ".join(f"raw_{a}_{b} IS NOT NULL AND NOT hit_{a}_{b}" for a, b in V.EVENT_BUCKETS)} AS primary
    FROM fm JOIN ct USING (entity, seq) LEFT JOIN rv USING (entity, seq)""".replace(" AS primary\n", ' AS "primary"\n'),
    "valid vintages",
)
def _(f):
    originals = f.vintages.filter("not is_revision").withColumn("seq", F.col("year") * 4 + F.col("q"))
    w = W.partitionBy("entity").orderBy("seq").rangeBetween(-4, -4)
    quarters = originals.select("entity", "year", "q", "seq", "available_from", F.col("value").alias("standalone"), F.max("value").over(w).alias("lag4"))
    per = (1000 + F.col("entity") % 7 + F.col("q")).cast("double")
    surprises = V.earnings_surprise(quarters, originals.select("entity", "year", "q", per.alias("shares"), per.alias("shares_lag4")))
    out = V.event_study(surprises, valid(f).withColumn("masked", F.col("volume") % 97 == 0), f.vintages.filter("is_revision").select("entity", "year", "q", "available_from"))
    out = out.withColumns({"change": rounded("change", 4), "sue": rounded("sue", 4)})
    return out.select("entity", "seq", "available_from", "change", "history", "sue", *(rounded(c, 6).alias(c) if c[0] != "h" else F.col(c) for c in bucket_columns(("raw", "excess", "hit"))), "revised", "primary")


# D15

SPLIT = """dv AS (SELECT entity, year, 'total' AS item, CASE WHEN entity % 4 = 0 THEN 'common' WHEN entity % 4 = 1 THEN 'unsplit' WHEN entity % 4 = 3 THEN CASE WHEN is_revision THEN 'common' ELSE 'preferred' END END AS stock,
      CASE WHEN entity % 7 <> 0 THEN available_from END AS disclosed, year * 10 + CASE WHEN is_revision THEN 1 ELSE 0 END AS receipt,
      CASE WHEN entity % 3 <> 0 THEN round(value) * CASE WHEN entity % 11 = 0 THEN 1000000 ELSE 1 END END AS value, CASE WHEN entity % 6 = 0 THEN '-' END AS text FROM vintages WHERE q = 4
    UNION ALL SELECT entity, year, 'dps', 'common', available_from, year * 10 + CASE WHEN is_revision THEN 1 ELSE 0 END, CASE WHEN entity % 9 <> 0 THEN 0.5 END, CASE WHEN entity % 9 = 0 THEN '-' END FROM vintages WHERE q = 4 AND entity % 10 <> 1),
    sh AS (SELECT entity, year, CAST(floor(value) AS BIGINT) AS issued, CASE WHEN entity % 4 <> 0 THEN CAST(floor(value / 10) AS BIGINT) END AS treasury FROM vintages WHERE q = 4 AND NOT is_revision AND entity % 8 <> 5),
    bb AS (SELECT entity, year, 'S' AS basis, round(value / 100) * CASE WHEN entity % 5 = 0 THEN -1 ELSE 1 END AS ttm, available_from FROM vintages WHERE q = 4 AND NOT is_revision AND entity % 3 <> 1
      UNION ALL SELECT entity, year, 'C', round(value / 50), available_from + 400 FROM vintages WHERE q = 4 AND NOT is_revision AND entity % 2 = 0)"""


def dividend_rows(f: Fixtures) -> DataFrame:
    e = F.col("entity")
    kind = F.when(e % 4 == 0, "common").when(e % 4 == 1, "unsplit").when(e % 4 == 3, F.when(F.col("is_revision"), "common").otherwise("preferred"))
    rows = f.vintages.filter("q = 4").withColumn("receipt", F.col("year") * 10 + F.col("is_revision").cast("int"))
    total = F.when(e % 3 != 0, F.floor(F.col("value") + 0.5) * F.when(e % 11 == 0, 1_000_000.0).otherwise(1.0))
    direct = rows.select("entity", "year", F.lit("total").alias("item"), kind.alias("stock"), F.when(e % 7 != 0, F.col("available_from")).alias("disclosed"), "receipt", total.alias("value"), F.when(e % 6 == 0, "-").alias("text"))
    dps = rows.filter("entity % 10 <> 1").select("entity", "year", F.lit("dps").alias("item"), F.lit("common").alias("stock"), F.col("available_from").alias("disclosed"), "receipt", F.when(e % 9 != 0, 0.5).alias("value"), F.when(e % 9 == 0, "-").alias("text"))
    return direct.unionByName(dps)


@query(
    "d15_payout_positions",
    f"""WITH {SPLIT}, days AS (SELECT DISTINCT date FROM bars),
    wn AS (SELECT *, row_number() OVER (PARTITION BY entity, year, item ORDER BY CASE WHEN stock = 'common' THEN 0 ELSE 1 END, disclosed NULLS LAST, receipt, value DESC NULLS LAST) AS n FROM dv WHERE stock IS DISTINCT FROM 'preferred'),
    wd AS (SELECT entity, year, max(value) FILTER (item = 'total') AS total, max(text) FILTER (item = 'total') AS tt, max(disclosed) FILTER (item = 'total') AS td, max(value) FILTER (item = 'dps') AS dps, max(text) FILTER (item = 'dps') AS dt, max(disclosed) FILTER (item = 'dps') AS dd FROM wn WHERE n = 1 GROUP BY 1, 2),
    im AS (SELECT wd.*, dps * (issued - coalesce(treasury, 0)) AS implied FROM wd LEFT JOIN sh USING (entity, year)),
    us AS (SELECT *, coalesce(total >= 0 AND (implied IS NULL OR implied <= 0 OR total <= 100 * implied), false) AS usable FROM im),
    dd AS (SELECT entity, year, CASE WHEN usable THEN total WHEN tt = '-' THEN 0 WHEN implied IS NOT NULL THEN implied WHEN dt = '-' THEN 0 END AS dividends,
      CASE WHEN usable OR tt = '-' THEN 'direct_total' WHEN dps IS NOT NULL OR dt = '-' THEN 'dps_proxy' END AS dividend_source, (SELECT min(date) FROM days WHERE date > coalesce(us.td, us.dd)) AS dividend_available_from FROM us),
    bw AS (SELECT entity, year, CASE WHEN c IS NOT NULL THEN c ELSE s END AS buyback, CASE WHEN c IS NOT NULL THEN ca ELSE sa END AS buyback_available_from FROM (
      SELECT entity, year, max(ttm) FILTER (basis = 'C') AS c, max(ttm) FILTER (basis = 'S') AS s, max(available_from) FILTER (basis = 'C') AS ca, max(available_from) FILTER (basis = 'S') AS sa FROM bb GROUP BY 1, 2) WHERE coalesce(c, s) >= 0),
    po AS (SELECT dd.*, buyback, buyback_available_from, CASE WHEN dividends IS NOT NULL OR buyback IS NOT NULL THEN coalesce(dividends, 0) + coalesce(buyback, 0) END AS payout, greatest(dividend_available_from, buyback_available_from) AS payout_available_from FROM dd LEFT JOIN bw USING (entity, year))
    SELECT entity, year, round(dividends, 2) AS dividends, dividend_source, dividend_available_from, buyback, buyback_available_from, round(payout, 2) AS payout, payout_available_from
    FROM po QUALIFY row_number() OVER (PARTITION BY entity, payout_available_from ORDER BY year DESC) = 1""",
    "vintages bars",
)
def _(f):
    first, e = f.vintages.filter("q = 4 and not is_revision"), F.col("entity")
    shares = first.filter("entity % 8 <> 5").select("entity", "year", F.floor("value").cast("long").alias("issued"), F.when(e % 4 != 0, F.floor(F.col("value") / 10).cast("long")).alias("treasury"))
    separate = first.filter("entity % 3 <> 1").select("entity", "year", F.lit("S").alias("basis"), (F.floor(F.col("value") / 100 + 0.5) * F.when(e % 5 == 0, -1.0).otherwise(1.0)).alias("ttm"), "available_from")
    whole = first.filter("entity % 2 = 0").select("entity", "year", F.lit("C").alias("basis"), F.floor(F.col("value") / 50 + 0.5).cast("double").alias("ttm"), F.date_add("available_from", 400).alias("available_from"))
    out = V.payout_positions(dividend_rows(f), shares, separate.unionByName(whole), f.bars.select("date"))
    return out.select("entity", "year", rounded("dividends", 2).alias("dividends"), "dividend_source", "dividend_available_from", "buyback", "buyback_available_from", rounded("payout", 2).alias("payout"), "payout_available_from")
