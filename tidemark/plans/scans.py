"""Queries of scan samples, denominators and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import rounded
from tidemark.operators import scan as N
from tidemark.operators import windows as R
from tidemark.plans.core import KEY, PATH, valid
from tidemark.plans.features import rounded_all
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.models import ranks_sql
from tidemark.plans.registry import query

HORIZONS, BUCKETS, HOLDOUT, FORMATION = (5, 20, 60), ((0, 5), (5, 20), (20, 60)), "1998-06-01", 120
SPANS = {f"cum_{h}": (0, h) for h in HORIZONS} | {f"bkt_{a}_{b}": (a, b) for a, b in BUCKETS}


def labelled(f: Fixtures) -> DataFrame:
    rows = valid(f).withColumns({"event": F.col("volume") % 97 == 0, "rev": -R.rolling_complete("sum", "ret", 5), "lnv": F.ln(F.col("volume").cast("double"))})
    return N.scan_labels(rows, HORIZONS, BUCKETS, holdout=HOLDOUT, formation=FORMATION)


def lead_sql(c: str, h: int) -> str:
    return f"lead({c}, {h}) OVER p" if h else c


LABELS = f"""l0 AS (SELECT *, sum(CASE WHEN volume % 97 = 0 THEN 1 ELSE 0 END) OVER ({PATH}) AS n, CASE WHEN count(ret) OVER w = 5 THEN -sum(ret) OVER w END AS rev, ln(volume::DOUBLE) AS lnv FROM valid WINDOW w AS ({PATH} ROWS 4 PRECEDING)),
    l1 AS (SELECT *, {", ".join(f"CASE WHEN {lead_sql('n', b)} = {lead_sql('n', a)} THEN {lead_sql('close', b)} / {lead_sql('close', a)} - 1 END AS {c}, {lead_sql('date', b)} AS {c}_end" for c, (a, b) in SPANS.items())}, lead(date, {FORMATION}) OVER p AS fend FROM l0 WINDOW p AS ({PATH})),
    dd AS (SELECT date, coalesce(lead(date, {FORMATION}) OVER (ORDER BY date) < DATE '{HOLDOUT}', false) AS common_formation FROM (SELECT DISTINCT date FROM valid)),
    lb AS (SELECT l1.*, common_formation, common_formation AND coalesce(fend < DATE '{HOLDOUT}', false) AS common_survivor, {", ".join(f"{c} - avg({c}) OVER (PARTITION BY date, grp) AS {c}_excess, coalesce({c}_end < DATE '{HOLDOUT}' AND {c} IS NOT NULL, false) AS {c}_ok" for c in SPANS)} FROM l1 JOIN dd USING (date))"""


@query("l03_scan_labels", f"WITH {LABELS} SELECT date, entity, grp, {', '.join(f'round({c}_excess, 6) + 0.0 AS {c}_excess, {c}_end, {c}_ok' for c in SPANS)}, common_formation, common_survivor FROM lb", "valid")
def _(f):
    return rounded_all(labelled(f).select(*KEY, *(f"{c}_{x}" for c in SPANS for x in ("excess", "end", "ok")), "common_formation", "common_survivor"), 6)


CELLS = [(f"{x}:{c}", x, f"{c}_excess", f"{c}_ok") for x in ("rev", "lnv") for c in ("cum_5", "bkt_5_20")]


def scan_samples() -> dict[str, Column]:
    """Two universes, each with all available labels and with common survivors, and two segments."""
    liquid = F.col("turnover") > 30000
    return {"all:available": F.lit(True), "all:survivor": F.col("common_survivor"), "liquid:available": liquid, "liquid:survivor": liquid & F.col("common_survivor"), "grp:A": F.col("grp") == "A", "late": F.col("date") >= F.to_date(F.lit("1996-01-01"))}


SAMPLE_SQL = {"all:available": "true", "all:survivor": "common_survivor", "liquid:available": "turnover > 30000", "liquid:survivor": "turnover > 30000 AND common_survivor", "grp:A": "grp = 'A'", "late": "date >= DATE '1996-01-01'"}
LONG = " UNION ALL ".join(f"SELECT '{c}' AS cell, '{s}' AS sample, date, grp, {x} AS x, {y} AS y FROM lb WHERE {ok} AND ({w})" for c, x, y, ok in CELLS for s, w in SAMPLE_SQL.items())
COMBINED = f"""{LABELS}, lg AS ({LONG}), ic AS ({ranks_sql('lg', 'x', 'y', 'cell, sample, date, grp')}), day AS (SELECT cell, sample, date, sum(ic * n) / sum(n) AS ic, CAST(sum(n) AS BIGINT) AS n FROM ic WHERE ic IS NOT NULL GROUP BY 1, 2, 3)"""


def combined(f: Fixtures) -> DataFrame:
    return N.scan_combinations(labelled(f), CELLS, scan_samples())


@query("h03_scan_combinations", f"WITH {COMBINED} SELECT cell, sample, date, n, round(ic, 8) + 0.0 AS ic FROM day", "valid")
def _(f):
    return rounded_all(combined(f).select("cell", "sample", "date", "n", "ic"), 8)


@query(
    "h03_scan_status",
    f"""WITH {COMBINED}, every AS (SELECT unnest({[c for c, *_ in CELLS]}) AS cell, s.sample FROM (SELECT unnest({list(SAMPLE_SQL)}) AS sample) s),
    st AS (SELECT cell, sample, count(*) AS dates, avg(ic) AS mean, stddev_samp(ic) AS std FROM day GROUP BY 1, 2)
    SELECT cell, sample, coalesce(dates, 0) AS dates, round(mean, 6) + 0.0 AS mean, round(mean / nullif(std, 0), 5) + 0.0 AS icir, CASE WHEN coalesce(dates, 0) = 0 THEN 'no_formation_rows' WHEN dates < 1000 THEN 'too_few_dates' END AS reason,
      CASE WHEN coalesce(dates, 0) >= 1000 THEN 'evaluated' ELSE 'not_evaluated' END AS status FROM every LEFT JOIN st USING (cell, sample)""",
    "valid",
)
def _(f):
    out = N.scan_status(combined(f), [c for c, *_ in CELLS], list(SAMPLE_SQL), min_dates=1000)
    return out.select("cell", "sample", "dates", rounded("mean", 6).alias("mean"), rounded("icir", 5).alias("icir"), "reason", "status")


@query(
    "h20_coverage_stats",
    f"""WITH {LABELS}, fr AS (SELECT * FROM lb WHERE common_formation AND turnover > 30000)
    {" UNION ALL ".join(f"SELECT '{c}' AS cell, count(*) AS n_formation, round(count({x}) / count(*)::DOUBLE, 8) AS feature_coverage, round(count(*) FILTER ({ok}) / count(*)::DOUBLE, 8) AS label_coverage, min(date) AS sample_start, max(date) AS sample_end FROM fr" for c, x, _, ok in CELLS)}""",
    "valid",
)
def _(f):
    return rounded_all(N.coverage_stats(labelled(f), [(c, x, ok) for c, x, _, ok in CELLS], F.col("common_formation") & (F.col("turnover") > 30000)), 8)


@query(
    "h20_exclusion_funnel",
    f"""WITH {LABELS} SELECT grp, CASE WHEN NOT turnover > 30000 THEN 'liquid' WHEN rev IS NULL THEN 'feature' WHEN volume % 97 = 0 THEN 'event' WHEN NOT bkt_5_20_ok THEN 'label' WHEN NOT common_survivor THEN 'survivor' ELSE 'kept' END AS first_failed, count(*) AS rows FROM lb GROUP BY 1, 2""",
    "valid",
)
def _(f):
    conditions = [("liquid", F.col("turnover") > 30000), ("feature", F.col("rev").isNotNull()), ("event", ~F.col("event")), ("label", F.col("bkt_5_20_ok")), ("survivor", F.col("common_survivor"))]
    return N.exclusion_funnel(labelled(f), conditions, by=["grp"])


@query(
    "h17_screen_pass",
    """WITH g AS (SELECT p_partkey AS cell, CASE WHEN p_size % 7 = 0 THEN 'reference' ELSE 'ready' END AS role, p_size % 2 = 0 AS found, p_size % 3 > 0 AS period, p_size % 11 = 0 AS isolated, CASE WHEN p_size % 4 > 0 THEN p_size % 5 > 0 END AS direction, p_size < 25 AS needs_delay, p_size % 10 < 8 AS delay FROM part),
    f AS (SELECT cell, role, CASE WHEN found THEN 0 ELSE 1 END + CASE WHEN period THEN 0 ELSE 1 END + CASE WHEN isolated THEN 1 ELSE 0 END + CASE WHEN NOT direction THEN 1 ELSE 0 END + CASE WHEN needs_delay AND NOT delay THEN 1 ELSE 0 END AS n FROM g)
    SELECT cell, CASE WHEN role = 'ready' THEN n ELSE 0 END AS n_failed, role = 'ready' AND n = 0 AS screen_pass FROM f""",
)
def _(f):
    s = F.col("p_size")
    cells = f.table("part").select(F.col("p_partkey").alias("cell"), F.when(s % 7 == 0, "reference").otherwise("ready").alias("role"), (s % 2 == 0).alias("found"), (s % 3 > 0).alias("period"), (s % 11 == 0).alias("isolated"), F.when(s % 4 > 0, s % 5 > 0).alias("direction"), (s < 25).alias("needs_delay"), (s % 10 < 8).alias("delay"))
    out = N.screen_pass(cells, always=["found", "period"], optional=["direction"], required={"delay": "needs_delay"})
    return out.select("cell", F.size("failed_gates").alias("n_failed"), "screen_pass")
