"""Queries of preprocessing, evaluation and inference."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import rounded, sdiv
from tidemark.lineage import checkpoint
from tidemark.operators import cross as C
from tidemark.operators import infer as H
from tidemark.operators import model as M
from tidemark.operators import replicates as K
from tidemark.operators import sessions as S
from tidemark.operators import walkforward as WF
from tidemark.operators import windows as R
from tidemark.plans.core import KEY, PATH, valid
from tidemark.plans.features import rounded_all
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.registry import query


def scored(f: Fixtures) -> DataFrame:
    """Reversal score against the 5-session excess return, and two more features."""
    v = valid(f)
    v = v.withColumns({"rev": -R.rolling_complete("sum", "ret", 5), "fwd": sdiv(R.forward_value("close", 5), "close") - 1, "lnv": F.ln(F.col("volume").cast("double"))})
    return v.withColumn("excess", F.col("fwd") - F.avg("fwd").over(W.partitionBy("date", "grp")))


SCORED = """s0 AS (SELECT *, CASE WHEN count(ret) OVER w = 5 THEN -sum(ret) OVER w END AS rev, lead(close, 5) OVER (PARTITION BY entity, grp ORDER BY date) / close - 1 AS fwd, ln(volume::DOUBLE) AS lnv
      FROM valid WINDOW w AS (PARTITION BY entity, grp ORDER BY date ROWS 4 PRECEDING)),
    s AS (SELECT *, fwd - avg(fwd) OVER (PARTITION BY date, grp) AS excess FROM s0)"""


def ranks_sql(source: str, x: str, y: str, by: str) -> str:
    """Average ranks of pairs and their correlation per cross-section."""
    return f"""SELECT {by}, count(*) AS n, CASE WHEN count(*) >= 5 AND stddev_samp(a) > 0 AND stddev_samp(b) > 0 THEN covar_samp(a, b) / (stddev_samp(a) * stddev_samp(b)) END AS ic FROM (
      SELECT {by}, rank() OVER (PARTITION BY {by} ORDER BY {x}) + (count(*) OVER (PARTITION BY {by}, {x}) - 1) / 2.0 AS a,
             rank() OVER (PARTITION BY {by} ORDER BY {y}) + (count(*) OVER (PARTITION BY {by}, {y}) - 1) / 2.0 AS b
      FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) GROUP BY {by}"""


IC = f"ic AS ({ranks_sql('s', 'rev', 'excess', 'date, grp')})"
DAILY = "daily AS (SELECT date, sum(ic * n) / sum(n) AS ic, CAST(sum(n) AS BIGINT) AS n FROM ic WHERE ic IS NOT NULL GROUP BY date)"


def group_ic(f: Fixtures) -> DataFrame:
    return M.rank_ic(scored(f), "rev", "excess", by=["date", "grp"])


@query("m01_isna_flags", f"WITH {SCORED} SELECT date, entity, grp, CAST(rev IS NULL AS INTEGER) AS rev_isna FROM s", "valid")
def _(f):
    return M.add_isna_flags(scored(f), ["rev"]).select(*KEY, "rev_isna")


@query("m02_impute", f"WITH {SCORED} SELECT date, entity, grp, round(coalesce(rev, median(rev) OVER (PARTITION BY date, grp), 0), 5) + 0.0 AS rev, round(coalesce(ret, 0), 5) + 0.0 AS ret FROM s", "valid")
def _(f):
    return rounded_all(M.impute(scored(f), zero=["ret"], median=["rev"]).select(*KEY, "rev", "ret"))


@query("m03_winsor", f"WITH {SCORED}, b AS (SELECT quantile_cont(rev, 0.01) AS lo, quantile_cont(rev, 0.99) AS hi FROM s WHERE date < DATE '2000-01-01') SELECT date, entity, grp, round(CASE WHEN rev IS NOT NULL THEN least(greatest(rev, lo), hi) END, 5) + 0.0 AS rev FROM s, b", "valid")
def _(f):
    rows = scored(f).select(*KEY, "rev").persist(StorageLevel.DISK_ONLY)  # bounds and rows come from one pass over the bars
    return rounded_all(M.apply_winsor(rows, M.fit_winsor(rows.filter("date < date '2000-01-01'"), ["rev"]), ["rev"]).select(*KEY, "rev"))


@query("m04_transform_scale", f"WITH {SCORED}, l AS (SELECT *, sign(rev) * ln(1 + abs(rev)) AS x FROM s) SELECT date, entity, grp, round(CASE WHEN x IS NOT NULL THEN coalesce((x - avg(x) OVER w) / nullif(stddev_samp(x) OVER w, 0), 0) END, 4) + 0.0 AS rev FROM l WINDOW w AS (PARTITION BY date)", "valid")
def _(f):
    return rounded_all(M.transform_scale(scored(f), ["rev"]).select(*KEY, "rev"), 4)


@query("m05_assert_finite", f"WITH {SCORED} SELECT count(*) FILTER (ret IS NULL) AS ret, count(*) FILTER (close IS NULL) AS close, count(*) FILTER (ret IS NULL) = 0 AS ok FROM s", "valid")
def _(f):
    return M.assert_finite(scored(f), ["ret", "close"])


FOLDS = """d AS (SELECT date, row_number() OVER (ORDER BY date) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM bars)), k AS (SELECT unnest([0, 1, 2, 3]) AS fold),
    p AS (SELECT fold, 500 + fold * floor((n - 200 - 500) / 4) AS v0, CASE WHEN fold = 3 THEN n - 200 ELSE 500 + (fold + 1) * floor((n - 200 - 500) / 4) END AS v1 FROM k, (SELECT DISTINCT n FROM d)),
    folds AS (SELECT fold, t.date AS train_end, a.date AS valid_start, b.date AS valid_end FROM p JOIN d t ON t.i = v0 - 20 JOIN d a ON a.i = v0 + 1 JOIN d b ON b.i = v1)"""


def folds(f: Fixtures) -> DataFrame:
    return M.walk_forward_folds(f.bars, n_folds=4, embargo=20, holdout=200, min_train=500)


@query("m06_walk_forward_folds", f"WITH {FOLDS} SELECT * FROM folds", "bars")
def _(f):
    return folds(f)


@query("m06_tag_folds", f"WITH {FOLDS} SELECT fold, CASE WHEN date <= train_end THEN 'train' ELSE 'valid' END AS role, count(*) AS n FROM bars JOIN folds ON date <= train_end OR date BETWEEN valid_start AND valid_end GROUP BY 1, 2", "bars")
def _(f):
    return M.tag_folds(f.bars, folds(f)).groupBy("fold", "role").agg(F.count("*").alias("n"))


@query("m07_rank_ic", f"WITH {SCORED}, {IC} SELECT date, grp, n, round(ic, 9) + 0.0 AS ic FROM ic", "valid")
def _(f):
    return rounded_all(group_ic(f), 9)


@query("m08_weighted_daily", f"WITH {SCORED}, {IC}, {DAILY} SELECT date, n, round(ic, 9) + 0.0 AS ic FROM daily", "valid")
def _(f):
    return rounded_all(M.weighted_daily(group_ic(f), "ic"), 9)


@query(
    "m09_quantile_spread",
    f"""WITH {SCORED}, p AS (SELECT date, grp, excess, (rank() OVER (PARTITION BY date, grp ORDER BY rev) + (count(*) OVER (PARTITION BY date, grp, rev) - 1) / 2.0) / count(*) OVER (PARTITION BY date, grp) AS p FROM s WHERE rev IS NOT NULL AND excess IS NOT NULL)
    SELECT date, grp, count(*) AS n, round(CASE WHEN count(*) >= 5 THEN avg(CASE WHEN p > 0.8 THEN excess END) - avg(CASE WHEN p <= 0.2 THEN excess END) END, 5) + 0.0 AS spread FROM p GROUP BY 1, 2""",
    "valid",
)
def _(f):
    return rounded_all(M.quantile_spread(scored(f), "rev", "excess", by=["date", "grp"]).select("date", "grp", "n", "spread"))


@query("m10_ic_report", f"WITH {SCORED}, {IC}, {DAILY} SELECT count(*) AS dates, round(avg(ic), 5) AS mean, round(stddev_samp(ic), 5) AS std, round(avg(ic) / stddev_samp(ic), 4) AS icir, round(avg(ic) * sqrt(count(*)) / stddev_samp(ic), 3) AS t, round(avg(CASE WHEN round(ic, 9) > 0 THEN 1.0 ELSE 0 END), 5) AS hit_ratio FROM daily", "valid")
def _(f):
    out = M.ic_report(rounded_all(M.weighted_daily(group_ic(f), "ic"), 9))
    return out.select("dates", *(rounded(c, d).alias(c) for c, d in (("mean", 5), ("std", 5), ("icir", 4), ("t", 3), ("hit_ratio", 5))))


@query(
    "m10_quantile_report",
    f"""WITH {SCORED}, p AS (SELECT date, excess AS y, (rank() OVER (PARTITION BY date ORDER BY rev) + (count(*) OVER (PARTITION BY date, rev) - 1) / 2.0) / count(*) OVER (PARTITION BY date) AS p FROM s WHERE rev IS NOT NULL AND excess IS NOT NULL),
    d AS (SELECT date, avg(y) FILTER (p >= 0.9) AS d, avg(y) FILTER (p >= 0.8) AS t, avg(y) FILTER (p <= 0.2) AS b, avg(CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END) FILTER (p >= 0.8) AS h FROM p GROUP BY date HAVING count(*) >= 5)
    SELECT count(*) AS dates, round(avg(d), 6) + 0.0 AS top_decile, round(avg(t) - avg(b), 6) + 0.0 AS top_minus_bottom, round(avg(h), 6) AS hit_ratio_top FROM d""",
    "valid",
)
def _(f):
    return rounded_all(M.quantile_report(scored(f), "rev", "excess"), 6)


TOP = "g AS (SELECT date, CAST((row_number() OVER (ORDER BY date) - 1) // 20 AS INTEGER) AS grid_idx, (row_number() OVER (ORDER BY date) - 1) % 20 AS m FROM (SELECT DISTINCT date FROM valid)), h AS (SELECT grid_idx, date, entity FROM (SELECT grid_idx, v.date, entity, row_number() OVER (PARTITION BY v.date ORDER BY turnover DESC, entity) AS r FROM valid v JOIN g ON g.date = v.date AND m = 0) WHERE r <= 5)"
TURNOVER = "t AS (SELECT a.grid_idx, 1 - count(b.entity) / greatest(max(a.n), max(a.pn))::DOUBLE AS turnover FROM (SELECT h.*, s.n, p.n AS pn FROM h JOIN (SELECT grid_idx, count(*) AS n FROM h GROUP BY 1) s USING (grid_idx) JOIN (SELECT grid_idx + 1 AS grid_idx, count(*) AS n FROM h GROUP BY 1) p USING (grid_idx)) a LEFT JOIN h b ON b.grid_idx = a.grid_idx - 1 AND b.entity = a.entity GROUP BY a.grid_idx)"


@query("m11_turnover", f"WITH {TOP}, {TURNOVER} SELECT grid_idx, round(turnover, 5) + 0.0 AS turnover FROM t", "valid")
def _(f):
    v = valid(f)
    held = C.topk(v.join(S.grid_dates(v, 20), "date"), "turnover", 5)
    return rounded_all(M.turnover(held.select("grid_idx", "entity"), "grid_idx"))


@query(
    "m12_economic_report",
    f"""WITH {SCORED}, {TOP}, {TURNOVER}, e AS (SELECT g.grid_idx, g.date, avg(fwd) AS a, count(*) AS n FROM s JOIN g ON g.date = s.date AND m = 0 GROUP BY 1, 2), o AS (SELECT h.grid_idx, avg(fwd) AS b, count(*) AS n_held FROM h JOIN s ON s.date = h.date AND s.entity = h.entity GROUP BY 1)
    SELECT e.grid_idx, e.n AS n_scored, n_held, round(b - a, 5) + 0.0 AS gross, round(b - a - 0.003 * coalesce(turnover, 1.0), 5) + 0.0 AS net FROM e JOIN o USING (grid_idx) LEFT JOIN t USING (grid_idx)""",
    "valid",
)
def _(f):
    out = M.economic_report(scored(f), "turnover", "fwd", h=20, cost_bps=30.0, k=5)
    return rounded_all(out.select("grid_idx", "n_scored", "n_held", "gross", "net"))


def held_out(f: Fixtures) -> DataFrame:
    return WF.holdout_fold(f.bars, embargo=20, holdout=200)


@query("m13_train_walk_forward")
def _(f):
    grid = [{"kind": "linear", "regParam": 0.1, "elasticNetParam": 0.0}, {"kind": "linear", "regParam": 0.1, "elasticNetParam": 0.5}, {"kind": "boosted", "maxIter": 3, "maxDepth": 3}]
    return WF.train_walk_forward(scored(f), folds(f), ["rev", "lnv"], "excess", grid=grid, holdout=held_out(f))


RIDGES = (0.001, 0.1, 10.0)
# Two features have a closed form: slopes on data divided by their spread solve a system of two equations.
RIDGE = f"""fa AS (SELECT * FROM folds UNION ALL SELECT -1, t.date, a.date, b.date FROM d t JOIN d a ON t.i = t.n - 220 AND a.i = a.n - 199 JOIN d b ON b.i = b.n),
    rg AS (SELECT unnest({list(range(len(RIDGES)))}) AS params, unnest({list(RIDGES)}) AS lam)"""
SLOPES = "((1 + lam / sy) * r1 - r12 * r2) / ((1 + lam / sy) ** 2 - r12 ** 2) * sy / s1 AS b1, ((1 + lam / sy) * r2 - r12 * r1) / ((1 + lam / sy) ** 2 - r12 ** 2) * sy / s2 AS b2"
MOMENTS = "corr(x1, y) AS r1, corr(x2, y) AS r2, corr(x1, x2) AS r12, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2, stddev_pop(y) AS sy"


@query(
    "m13_ridge_walk_forward",
    f"""WITH {SCORED}, {FOLDS}, {RIDGE}, xy AS (SELECT date, grp, coalesce(rev, 0) AS x1, coalesce(lnv, 0) AS x2, excess AS y FROM s WHERE excess IS NOT NULL),
    mo AS (SELECT fold, {MOMENTS} FROM xy JOIN fa ON date <= train_end GROUP BY fold), co AS (SELECT fold, params, {SLOPES} FROM mo, rg),
    sc AS (SELECT fa.fold, params, date, grp, b1 * x1 + b2 * x2 AS score, y FROM xy JOIN fa ON date BETWEEN valid_start AND valid_end JOIN co ON co.fold = fa.fold),
    i AS ({ranks_sql("sc", "score", "y", "fold, params, date, grp")}), m AS (SELECT fold, params, avg(ic) AS mean_ic, count(ic) AS cross_sections FROM i GROUP BY 1, 2),
    b AS (SELECT params AS best FROM m WHERE fold >= 0 GROUP BY 1 ORDER BY round(avg(mean_ic), 9) DESC, 1 LIMIT 1)
    SELECT CASE WHEN fold < 0 THEN 'holdout' ELSE 'valid' END AS role, CAST(params AS INTEGER) AS params, CAST(nullif(fold, -1) AS INTEGER) AS fold, round(mean_ic, 6) + 0.0 AS mean_ic, cross_sections, params = best AS best FROM m, b WHERE fold >= 0 OR params = best""",
    "valid",
)
def _(f):
    grid = [{"kind": "linear", "regParam": r} for r in RIDGES]
    out = WF.train_walk_forward(scored(f), folds(f), ["rev", "lnv"], "excess", grid=grid, holdout=held_out(f))
    return out.withColumn("mean_ic", rounded("mean_ic", 6))


@query("m14_realized_summary", f"WITH {SCORED}, k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY turnover DESC, entity) AS r FROM s) WHERE r <= 3) SELECT date, count(DISTINCT entity) AS names, count(fwd) AS known, round(avg(fwd), 5) + 0.0 AS mean, round(avg(CASE WHEN fwd > 0 THEN 1.0 WHEN fwd IS NOT NULL THEN 0 END), 5) AS hit_ratio FROM k GROUP BY date", "valid")
def _(f):
    return rounded_all(M.realized_summary(C.topk(scored(f), "turnover", 3), "fwd", ["date"]))


@query(
    "m15_enrich_topk",
    """WITH k AS (SELECT * FROM (SELECT date, entity, grp, row_number() OVER (PARTITION BY date ORDER BY turnover DESC, entity) AS r FROM valid) WHERE r <= 3),
    v AS (SELECT entity, available_from, max_by(value, (period_end, is_revision)) AS value FROM vintages GROUP BY 1, 2)
    SELECT k.date, k.entity, s_name AS name, v.value FROM k LEFT JOIN supplier ON s_suppkey = k.entity ASOF LEFT JOIN v ON v.entity = k.entity AND k.date >= v.available_from""",
    "valid vintages",
)
def _(f):
    names = f.table("supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"))
    facts = f.vintages.groupBy("entity", "available_from").agg(F.max_by("value", F.struct("period_end", "is_revision")).alias("value"))
    return M.enrich_topk(C.topk(valid(f), "turnover", 3), names, facts, values=["value"]).select("date", "entity", "name", "value")


@query("m16_ablation_table", f"WITH {SCORED}, a AS ({ranks_sql('s', 'rev', 'excess', 'date, grp')}), b AS ({ranks_sql('s', 'lnv', 'excess', 'date, grp')}), x AS (SELECT 'rev' AS variant, avg(ic) AS value FROM a UNION ALL SELECT 'lnv', avg(ic) FROM b) SELECT variant, round(value, 5) + 0.0 AS value, round(value - max(CASE WHEN variant = 'rev' THEN value END) OVER (), 5) + 0.0 AS delta FROM x", "valid")
def _(f):
    rows = scored(f)
    reports = {c: M.rank_ic(rows, c, "excess", by=["date", "grp"]).agg(F.avg("ic").alias("mean")) for c in ("rev", "lnv")}
    return rounded_all(M.ablation_table(reports, "rev", "mean"))


# Horizon scan

HORIZONS = (1, 5, 10)


def scan_rows(f: Fixtures) -> DataFrame:
    v = scored(f)
    w = W.partitionBy("date", "grp")
    v = v.withColumns({f"f{h}": sdiv(R.forward_value("close", h), "close") - 1 for h in HORIZONS})
    return v.withColumns({f"e{h}": F.col(f"f{h}") - F.avg(f"f{h}").over(w) for h in HORIZONS})


def scan_panel(f: Fixtures) -> DataFrame:
    return scan_rows(f).join(S.trading_calendar(f.bars), ["grp", "date"])


CELLS = [(f"{x}:{h}", x, f"e{h}") for x in ("rev", "lnv") for h in HORIZONS]


def scan_daily(f: Fixtures) -> DataFrame:
    """Daily ICs of all cells with a market-wide session ordinal."""
    daily = H.daily_ic(H.long_cells(scan_panel(f), CELLS))
    days = f.bars.select("date").distinct().withColumn("d_idx", F.row_number().over(W.orderBy("date")))
    return daily.join(days, "date")


FWD = ", ".join(f"lead(close, {h}) OVER p / close - 1 AS f{h}" for h in HORIZONS)
EXC = ", ".join(f"f{h} - avg(f{h}) OVER (PARTITION BY date, grp) AS e{h}" for h in HORIZONS)
LONG = " UNION ALL ".join(f"SELECT '{c}' AS cell, date, entity, grp, {x} AS x, {y} AS y FROM sp" for c, x, y in CELLS)
GATE_ROWS = " UNION ALL ".join(f"SELECT date, entity, grp, coalesce(rev, 0) AS x1, coalesce(lnv, 0) AS x2, {h} AS horizon, e{h} AS y, f{h} AS z FROM sp" for h in (5, 10))


@query(
    "m16_candidate_gate",
    f"""WITH {SCORED}, {FOLDS}, sf AS (SELECT *, {FWD} FROM s WINDOW p AS (PARTITION BY entity, grp ORDER BY date)), sp AS (SELECT *, {EXC} FROM sf), {RIDGE}, lg AS ({GATE_ROWS}),
    mo AS (SELECT fold, horizon, {MOMENTS} FROM lg JOIN folds ON date <= train_end WHERE y IS NOT NULL GROUP BY 1, 2),
    co AS (SELECT 'both' AS variant, fold, horizon, params, {SLOPES} FROM mo, rg UNION ALL SELECT 'rev', fold, horizon, params, r1 / (1 + lam / sy) * sy / s1, 0.0 FROM mo, rg),
    sc AS (SELECT variant, horizon, params, folds.fold, date, entity, grp, b1 * x1 + b2 * x2 AS score, y, z FROM lg JOIN folds ON date BETWEEN valid_start AND valid_end JOIN co USING (fold, horizon)),
    i AS ({ranks_sql("sc", "score", "y", "variant, horizon, params, fold, date, grp")}), fm AS (SELECT variant, horizon, params, fold, avg(ic) AS ic FROM i GROUP BY ALL HAVING count(ic) > 0),
    pm AS (SELECT variant, horizon, params, avg(ic) AS mean_ic FROM fm GROUP BY ALL), b AS (SELECT * FROM pm QUALIFY row_number() OVER (PARTITION BY variant, horizon ORDER BY round(mean_ic, 9) DESC, params) = 1),
    bf AS (SELECT fm.* FROM fm JOIN b USING (variant, horizon, params)),
    fc AS (SELECT a.variant, a.horizon, count(*) FILTER (a.ic > 0) AS positive_folds, count(*) FILTER (a.ic > u.ic) AS better_folds FROM bf a LEFT JOIN bf u ON u.variant = 'rev' AND u.horizon = a.horizon AND u.fold = a.fold GROUP BY 1, 2),
    g AS (SELECT horizon, date, CAST(n / horizon AS INTEGER) AS g FROM (SELECT horizon, date, row_number() OVER (PARTITION BY horizon ORDER BY date) - 1 AS n FROM (SELECT DISTINCT horizon, date FROM sc)) WHERE n % horizon = 0),
    ch AS (SELECT sc.*, g FROM sc JOIN b USING (variant, horizon, params) JOIN g USING (horizon, date)),
    tk AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY variant, horizon, date ORDER BY score DESC, entity) <= 5),
    al AS (SELECT variant, horizon, g, avg(z) AS a FROM ch GROUP BY ALL), ow AS (SELECT variant, horizon, g, avg(z) AS o, count(*) AS n FROM tk GROUP BY ALL),
    ov AS (SELECT t.variant, t.horizon, t.g, count(*) AS kept FROM tk t JOIN tk u ON u.variant = t.variant AND u.horizon = t.horizon AND u.g = t.g - 1 AND u.entity = t.entity GROUP BY ALL),
    ec AS (SELECT variant, horizon, o - a AS gross, CASE WHEN pr.n IS NOT NULL THEN 1 - coalesce(kept, 0) / greatest(ow.n, pr.n)::DOUBLE END AS turnover FROM al JOIN ow USING (variant, horizon, g) LEFT JOIN (SELECT variant, horizon, g + 1 AS g, n FROM ow) pr USING (variant, horizon, g) LEFT JOIN ov USING (variant, horizon, g)),
    em AS (SELECT variant, horizon, avg(gross) AS gross, avg(turnover) AS turnover, avg(gross - 0.003 * coalesce(turnover, 1.0)) AS net FROM ec GROUP BY 1, 2),
    r AS (SELECT variant, horizon, params, mean_ic, positive_folds, better_folds, gross, turnover, net, mean_ic - max(CASE WHEN variant = 'rev' THEN mean_ic END) OVER w AS delta_ic, net - max(CASE WHEN variant = 'rev' THEN net END) OVER w AS delta_net FROM b JOIN fc USING (variant, horizon) JOIN em USING (variant, horizon) WINDOW w AS (PARTITION BY horizon))
    SELECT variant, horizon, CAST(params AS INTEGER) AS params, positive_folds, better_folds, round(mean_ic, 6) + 0.0 AS mean_ic, round(gross, 5) + 0.0 AS gross, round(turnover, 5) + 0.0 AS turnover, round(net, 5) + 0.0 AS net, round(delta_ic, 6) + 0.0 AS delta_ic, round(delta_net, 5) + 0.0 AS delta_net,
      CASE WHEN variant <> 'rev' THEN delta_ic > 0 AND delta_net > 0 END AS passes FROM r""",
    "valid",
)
def _(f):
    out = WF.candidate_gate(scan_panel(f), folds(f), {"rev": ["rev"], "both": ["rev", "lnv"]}, {h: (f"e{h}", f"f{h}") for h in (5, 10)}, base="rev", grid=[{"regParam": r} for r in RIDGES], cost_bps=30.0, k=5)
    return out.select("variant", "horizon", "params", "positive_folds", "better_folds", "passes", *(rounded(c, 6).alias(c) for c in ("mean_ic", "delta_ic")), *(rounded(c, 5).alias(c) for c in ("gross", "turnover", "net", "delta_net")))


SCAN = f"""{SCORED}, sf AS (SELECT *, {FWD} FROM s WINDOW p AS (PARTITION BY entity, grp ORDER BY date)), sp AS (SELECT *, {EXC} FROM sf), lng AS ({LONG}),
    cic AS ({ranks_sql('lng', 'x', 'y', 'cell, date, grp')}), days AS (SELECT date, row_number() OVER (ORDER BY date) AS d_idx FROM (SELECT DISTINCT date FROM bars)),
    cd AS (SELECT cell, date, d_idx, ic, n FROM (SELECT cell, date, sum(ic * n) / sum(n) AS ic, CAST(sum(n) AS BIGINT) AS n FROM cic WHERE ic IS NOT NULL GROUP BY 1, 2) JOIN days USING (date)),
    nwm AS (SELECT cell, count(*) AS dates, avg(ic) AS mean FROM cd GROUP BY cell), dv AS (SELECT cell, d_idx, ic - mean AS d FROM cd JOIN nwm USING (cell)),
    nw AS (SELECT cell, dates, mean, sqrt(g0 + 2 * coalesce(g, 0)) / dates AS se FROM nwm JOIN (SELECT cell, sum(d * d) AS g0 FROM dv GROUP BY 1) USING (cell)
      LEFT JOIN (SELECT a.cell, sum((1 - (b.d_idx - a.d_idx) / 5.0) * a.d * b.d) AS g FROM dv a JOIN dv b ON a.cell = b.cell AND b.d_idx > a.d_idx AND b.d_idx <= a.d_idx + 4 GROUP BY 1) USING (cell))"""


def nw_sql(name: str, daily: str, by: str) -> str:
    """CTEs that end in `name`: dates, mean and HAC t of daily ICs, with four lags, for each of the columns `by`."""
    on = " AND ".join(f"a.{c} = b.{c}" for c in by.split(", "))
    mine = ", ".join(f"a.{c}" for c in by.split(", "))
    return f"""{name}_m AS (SELECT {by}, count(*) AS dates, avg(ic) AS mean FROM {daily} GROUP BY {by}), {name}_d AS (SELECT {by}, d_idx, ic - mean AS d FROM {daily} JOIN {name}_m USING ({by})),
    {name}_v AS (SELECT {by}, g0 + 2 * coalesce(g, 0) AS v FROM (SELECT {by}, sum(d * d) AS g0 FROM {name}_d GROUP BY {by})
      LEFT JOIN (SELECT {mine}, sum((1 - (b.d_idx - a.d_idx) / 5.0) * a.d * b.d) AS g FROM {name}_d a JOIN {name}_d b ON {on} AND b.d_idx > a.d_idx AND b.d_idx <= a.d_idx + 4 GROUP BY {mine}) USING ({by})),
    {name} AS (SELECT {by}, dates, mean, CASE WHEN v > 0 THEN mean * dates / sqrt(v) END AS t FROM {name}_m JOIN {name}_v USING ({by}))"""


def normal_sql(t: str) -> str:
    """Two-sided normal p-value by Simpson's rule over ten deviations beyond t."""
    return f"list_sum(list_transform(range(0, 2001), lambda i: (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)::DOUBLE * exp(-0.5 * (abs({t}) + i * 0.005::DOUBLE) * (abs({t}) + i * 0.005::DOUBLE)))) * 0.01 / 3 / sqrt(2 * pi())"


def draw_sql(seed: str, *cols: str) -> str:
    """The same number as functions.exprs.draw."""
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(cols)})), 1, 12) AS BIGINT)"


def draw8_sql(seed: str, rep: str, *cols: str) -> str:
    """The same number as operators.replicates.digest_draws."""
    return f"CAST('0x' || substr(sha256(concat_ws('|', '{seed}', {rep} // 8, {', '.join(cols)})), 8 * ({rep} % 8) + 1, 8) AS BIGINT)"


def bh_sql(name: str, source: str, p: str, by: str = "") -> str:
    """CTE with monotone q-values over p for each `by`; a missing p counts as 1."""
    part = f"PARTITION BY {by}" if by else ""
    return f"""{name} AS (SELECT *, least(1.0, min(pp * m / upto) OVER ({part} ORDER BY pp DESC)) AS q FROM (
      SELECT *, count(*) OVER ({part}) AS m, count(*) OVER ({part} ORDER BY pp) AS upto FROM (SELECT *, coalesce({p}, 1.0) AS pp FROM {source})))"""


@query(
    "h01_hypothesis_registry",
    """WITH c AS (SELECT 'n' || c_nationkey AS family, c_mktsegment AS feature, CAST(1 + c_custkey % 7 AS INTEGER) AS horizon, c_nationkey * 10 + c_custkey % 4 AS asset FROM customer),
    lacking AS (SELECT DISTINCT family FROM c WHERE asset NOT IN (SELECT s_nationkey * 10 + s_suppkey % 4 FROM supplier))
    SELECT DISTINCT family || ':' || feature || ':' || horizon AS cell, family, feature, horizon, CASE WHEN family IN (SELECT family FROM lacking) THEN 'missing_dependency' ELSE 'ready' END AS status FROM c""",
)
def _(f):
    c = f.table("customer").select(F.concat(F.lit("n"), "c_nationkey").alias("family"), F.col("c_mktsegment").alias("feature"), (1 + F.col("c_custkey") % 7).cast("int").alias("horizon"), (F.col("c_nationkey") * 10 + F.col("c_custkey") % 4).cast("long").alias("asset"))
    families = c.groupBy("family", "feature").agg(F.sort_array(F.collect_set("horizon")).alias("horizons"), F.collect_set("asset").alias("needs"))
    available = f.table("supplier").select((F.col("s_nationkey") * 10 + F.col("s_suppkey") % 4).cast("long").alias("asset")).distinct()
    return H.hypothesis_registry(families, available)


@query("h02_analysis_panel", f"WITH {SCAN} SELECT date, entity, grp, c.d_idx, round(rev, 5) + 0.0 AS rev, round(e5, 5) + 0.0 AS e5 FROM sp JOIN calendar c USING (grp, date)", "valid bars calendar")
def _(f):
    return rounded_all(scan_panel(f).select(*KEY, "d_idx", "rev", "e5"))


@query("h03_scan_cells", f"WITH {SCAN} SELECT cell, date, n, round(ic, 9) + 0.0 AS ic FROM cd", "valid bars")
def _(f):
    return rounded_all(scan_daily(f).select("cell", "date", "n", "ic"), 9)


def tests(f: Fixtures) -> DataFrame:
    return H.newey_west(scan_daily(f), 4)


@query("h04_newey_west", f"WITH {SCAN} SELECT cell, dates, round(mean, 5) + 0.0 AS mean, round(mean / se, 3) + 0.0 AS nw_t FROM nw", "valid bars")
def _(f):
    return tests(f).select("cell", "dates", rounded("mean", 5).alias("mean"), rounded("nw_t", 3).alias("nw_t"))


@query(
    "h05_p_values",
    f"""WITH {SCAN}, {nw_sql('o', 'cd', 'cell')}, h AS (SELECT cell, count(*) FILTER (ic > 0) AS hits, count(*) AS n FROM cd GROUP BY cell)
    SELECT cell, round({normal_sql('t')}, 6) AS p, round(list_sum(list_transform(range(hits, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2)))), 6) AS sign_p FROM o JOIN h USING (cell)""",
    "valid bars",
)
def _(f):
    hits = scan_daily(f).groupBy("cell").agg(F.count_if(F.col("ic") > 0).alias("hits"), F.count("*").alias("n"))
    return tests(f).join(hits, "cell").select("cell", rounded(H.normal_p("nw_t"), 6).alias("p"), rounded(H.sign_test_p("hits", "n"), 6).alias("sign_p"))


@query(
    "h06_benjamini_hochberg",
    "WITH p AS (SELECT c_custkey AS cell, ((c_custkey * 7919) % 1000) / 1000.0::DOUBLE AS p FROM customer), r AS (SELECT *, row_number() OVER (ORDER BY p, cell) AS r, count(*) OVER () AS m FROM p) SELECT cell, round(least(1.0, min(p * m / r) OVER (ORDER BY r DESC)), 6) AS q FROM r",
)
def _(f):
    p = f.table("customer").select(F.col("c_custkey").alias("cell"), (F.pmod(F.col("c_custkey") * 7919, F.lit(1000)) / 1000.0).alias("p"))
    return H.benjamini_hochberg(p).select("cell", rounded("q").alias("q"))


def parts(f: Fixtures) -> DataFrame:
    return tests(f).withColumns({"feature": F.split("cell", ":")[0], "horizon": F.split("cell", ":")[1].cast("int")})


@query("h07_isolated_spike", f"WITH {SCAN}, p AS (SELECT *, split_part(cell, ':', 1) AS feature, CAST(split_part(cell, ':', 2) AS INTEGER) AS horizon FROM nw) SELECT cell, mean > 0 AND NOT (coalesce(lag(mean) OVER w > 0, false) OR coalesce(lead(mean) OVER w > 0, false)) AS isolated FROM p WINDOW w AS (PARTITION BY feature ORDER BY horizon)", "valid bars")
def _(f):
    return H.isolated_spike(parts(f), by=["feature"], order="horizon").select("cell", "isolated")


@query("h08_gates", f"WITH {SCAN}, o AS (SELECT cell, avg(ic) AS o FROM cd WHERE d_idx % 2 = 0 GROUP BY 1) SELECT cell, coalesce(sign(mean) = sign(o), false) AS same_sign, coalesce(sign(mean) = sign(o) AND abs(o) / nullif(abs(mean), 0) >= 0.5, false) AS gate_ok FROM nw LEFT JOIN o USING (cell)", "valid bars")
def _(f):
    other = scan_daily(f).filter("d_idx % 2 = 0").groupBy("cell").agg(F.avg("ic").alias("mean"))
    return H.gate(tests(f), other, on=["cell"]).select("cell", "same_sign", "gate_ok")


@query("h08_period_majority", f"WITH {SCAN}, y AS (SELECT cell, year(date) AS y, avg(ic) AS m FROM cd GROUP BY 1, 2) SELECT cell, count(*) AS periods, count(*) FILTER (sign(m) = sign(mean)) AS agreeing, count(*) FILTER (sign(m) = sign(mean)) * 2 > count(*) AS majority FROM y JOIN nw USING (cell) GROUP BY 1", "valid bars")
def _(f):
    return H.period_majority(scan_daily(f), F.year("date"))


@query("h09_nonoverlap_offsets", f"WITH {SCAN}, o AS (SELECT cell, d_idx % 5 AS x, avg(ic) AS m, count(*) AS n FROM cd GROUP BY 1, 2) SELECT cell, round(min(m), 5) + 0.0 AS min_mean, round(median(m), 5) + 0.0 AS median_mean, round(max(m), 5) + 0.0 AS max_mean, 1.0::DOUBLE AS valid_ratio FROM o GROUP BY 1", "valid bars")
def _(f):
    return rounded_all(H.offset_summary(H.nonoverlap_offsets(scan_daily(f), 5)))


PERMUTED = f"""rp AS (SELECT rep, cell, date, grp, entity, x, y FROM lng, (SELECT unnest([0, 1, 2, 3]) AS rep) WHERE x IS NOT NULL AND y IS NOT NULL),
    nb AS (SELECT *, row_number() OVER (PARTITION BY rep, cell, date, grp ORDER BY entity) AS k, row_number() OVER (PARTITION BY rep, cell, date, grp ORDER BY {draw8_sql('h10', 'rep', 'date', 'entity')}, entity) AS turn FROM rp),
    perm AS (SELECT rep, cell, date, grp, a.y, b.x FROM nb a JOIN (SELECT rep, cell, date, grp, turn AS k, x FROM nb) b USING (rep, cell, date, grp, k)),
    pic AS ({ranks_sql('perm', 'x', 'y', 'rep, cell, date, grp')}),
    pd AS (SELECT rep, cell, d_idx, ic FROM (SELECT rep, cell, date, sum(ic * n) / sum(n) AS ic FROM pic WHERE ic IS NOT NULL GROUP BY ALL) JOIN days USING (date))"""


def market_days(f: Fixtures) -> DataFrame:
    return f.bars.select("date").distinct().withColumn("d_idx", F.row_number().over(W.orderBy("date")))


def permutations(f: Fixtures, n: int) -> DataFrame:
    null = K.replicate_newey_west(K.permutation_null(scan_panel(f), CELLS, n, seed="h10").join(market_days(f), "date"), 4)
    return rounded_all(H.permutation_report(tests(f), null).select("cell", "replicates", "extreme", "p", "empirical_q", "normal_p", "q", "discoveries", "count_p"), 6)


@query(
    "h10_permute_cross_section",
    f"""WITH {SCAN}, {PERMUTED}, {nw_sql('o', 'cd', 'cell')}, {nw_sql('z', 'pd', 'rep, cell')},
    op AS (SELECT cell, t, {normal_sql('t')} AS normal_p FROM o), {bh_sql('seen', 'op', 'normal_p')}, zp AS (SELECT rep, cell, {normal_sql('t')} AS normal_p FROM z), {bh_sql('scans', 'zp', 'normal_p', 'rep')},
    found AS (SELECT count(*) FILTER (q <= 0.1) AS discoveries FROM seen), reps AS (SELECT rep, count(*) FILTER (q <= 0.1) AS k FROM scans GROUP BY rep),
    chance AS (SELECT discoveries, (count(*) FILTER (k >= discoveries) + 1) / (count(k) + 1)::DOUBLE AS count_p FROM found, reps GROUP BY discoveries),
    emp AS (SELECT cell, count(z.t) AS replicates, count(*) FILTER (abs(z.t) >= abs(o.t) - 1e-9) AS extreme, (count(*) FILTER (abs(z.t) >= abs(o.t) - 1e-9) + 1) / (count(z.t) + 1)::DOUBLE AS p FROM o LEFT JOIN z USING (cell) GROUP BY cell), {bh_sql('eq', 'emp', 'p')}
    SELECT cell, replicates, extreme, round(eq.p, 6) AS p, round(eq.q, 6) AS empirical_q, round(normal_p, 6) AS normal_p, round(seen.q, 6) AS q, discoveries, round(count_p, 6) AS count_p FROM eq JOIN seen USING (cell), chance""",
    "valid bars",
)
def _(f):
    return permutations(f, 4)


@query("h10_permutation_999")
def _(f):
    """As many replicates as the scan's reports take; SQL would sort every row of every replicate."""
    return permutations(f, 999)


@query("h10_permutation_conserves", f"WITH {SCAN} SELECT r AS rep, round(sum(x), 3) + 0.0 AS total, count(*) AS n FROM lng, (SELECT unnest([0, 1, 2]) AS r) WHERE cell = 'lnv:5' AND x IS NOT NULL AND y IS NOT NULL GROUP BY r", "valid bars")
def _(f):
    long = H.long_cells(scan_panel(f), [("lnv:5", "lnv", "e5")])
    return H.permute_cross_section(long, 3, seed="h10").groupBy("rep").agg(rounded(F.sum("x"), 3).alias("total"), F.count("*").alias("n"))


def placebo(f: Fixtures, n: int) -> DataFrame:
    days = checkpoint(market_days(f))
    total = days.count()
    panel = scan_rows(f).select(*KEY, "rev", "e5").join(F.broadcast(days), "date").persist(StorageLevel.DISK_ONLY)  # features and labels come from one pass over the bars
    features = panel.select("d_idx", "entity", "grp", F.col("rev").alias("x"))
    labels = panel.select("d_idx", *KEY, F.lit("rev:5").alias("cell"), F.col("e5").alias("y"))
    daily = checkpoint(K.placebo_null(features, labels, n, seed="h11", min_shift=120, total=total, min_names=2, observed=5))
    t = checkpoint(H.newey_west(daily.join(F.broadcast(days), "date"), 4, by=["rep", "cell"]).select("rep", "cell", F.col("nw_t").alias("t")))
    return rounded_all(H.empirical_p(t.filter("rep < 0").select("cell", "t"), t.filter("rep >= 0").select("cell", "t")), 6)


@query(
    "h11_temporal_placebo",
    f"""WITH {SCAN}, nd AS (SELECT count(*) AS total FROM days), sx AS (SELECT sp.*, d_idx, total FROM sp JOIN days USING (date), nd),
    sh AS (SELECT rep, 120 + {draw_sql('h11', 'rep')} % greatest(1, total - 240) AS shift FROM (SELECT unnest([0, 1, 2, 3]) AS rep), nd),
    mv AS (SELECT rep, (d_idx - 1 + shift) % total + 1 AS d_idx, entity, grp, rev AS x FROM sx, sh WHERE rev IS NOT NULL),
    pl AS (SELECT rep, 'rev:5' AS cell, s.date, s.grp, mv.x, s.e5 AS y FROM sx s JOIN mv ON mv.d_idx = s.d_idx AND mv.entity = s.entity AND mv.grp = s.grp WHERE s.e5 IS NOT NULL),
    pic AS ({ranks_sql('pl', 'x', 'y', 'rep, cell, date, grp').replace('>= 5', '>= 2')}),
    pd AS (SELECT rep, cell, d_idx, ic FROM (SELECT rep, cell, date, sum(ic * n) / sum(n) AS ic FROM pic WHERE ic IS NOT NULL GROUP BY ALL) JOIN days USING (date)),
    {nw_sql('o', 'cd', 'cell')}, {nw_sql('z', 'pd', 'rep, cell')}
    SELECT cell, count(z.t) AS replicates, count(*) FILTER (abs(z.t) >= abs(o.t) - 1e-9) AS extreme, round((count(*) FILTER (abs(z.t) >= abs(o.t) - 1e-9) + 1) / (count(z.t) + 1)::DOUBLE, 6) AS p FROM o LEFT JOIN z USING (cell) WHERE cell = 'rev:5' GROUP BY cell""",
    "valid bars",
)
def _(f):
    return placebo(f, 4)


@query("h11_temporal_placebo_999")
def _(f):
    """As many replicates as the reports take, with the verdict at 0.10; SQL would join every row of every replicate."""
    return placebo(f, 999).withColumn("temporal_null_pass", F.col("p") < 0.10)


@query("h12_lookahead_canary", f"WITH {SCORED}, ic AS (SELECT date, grp, count(*) AS n, count(DISTINCT excess) AS v FROM s WHERE excess IS NOT NULL GROUP BY 1, 2) SELECT 1.0::DOUBLE AS mean_ic, count(*) FILTER (n >= 5 AND v > 1) AS cross_sections FROM ic", "valid")
def _(f):
    return H.lookahead_canary(scored(f), "excess").withColumn("mean_ic", rounded("mean_ic"))


COHORT = "ev AS (SELECT receipt, amount, entity % 2 AS g, CAST(date_trunc('month', receipt_date) AS DATE) AS cohort, CAST(right(CAST(receipt * 7919 AS VARCHAR), 4) AS INTEGER) AS y FROM filings)"
COHORT_IC = """ci AS (SELECT cohort, count(*) AS n, corr(a, b) AS ic FROM (SELECT cohort, (rank() OVER (PARTITION BY cohort, g ORDER BY amount) + (count(*) OVER (PARTITION BY cohort, g, amount) - 1) / 2.0) / n AS a,
      (rank() OVER (PARTITION BY cohort, g ORDER BY y) + (count(*) OVER (PARTITION BY cohort, g, y) - 1) / 2.0) / n AS b FROM (SELECT *, count(*) OVER (PARTITION BY cohort, g) AS n FROM ev) WHERE n >= 10) GROUP BY cohort HAVING count(*) >= 30)"""


def cohorts(f: Fixtures) -> DataFrame:
    return f.filings.select("receipt", "amount", "entity", F.pmod("entity", F.lit(2)).alias("g"), F.trunc("receipt_date", "month").alias("cohort"), F.expr("cast(right(cast(receipt * 7919 as string), 4) as int)").alias("y"))


@query("h13_event_cohort_scan", f"WITH {COHORT}, {COHORT_IC} SELECT cohort, n, round(ic, 5) + 0.0 AS ic FROM ci", "filings")
def _(f):
    return rounded_all(H.event_cohort_scan(cohorts(f), "amount", "y", cohort="cohort", group="g"))


@query(
    "h13_cohort_inference",
    f"""WITH {COHORT}, {COHORT_IC}, days AS (SELECT date, row_number() OVER (ORDER BY date) AS d_idx FROM (SELECT DISTINCT date FROM bars)),
    x AS (SELECT cohort, ic, (SELECT min(d_idx) FROM days WHERE date >= cohort) AS d_idx FROM ci WHERE ic IS NOT NULL), k AS (SELECT * FROM x WHERE d_idx IS NOT NULL), m AS (SELECT count(*) AS dates, avg(ic) AS mean, count(DISTINCT date_trunc('quarter', cohort)) AS windows FROM k),
    d AS (SELECT d_idx, ic - mean AS d FROM k, m), v AS (SELECT (SELECT sum(d * d) FROM d) + 2 * coalesce((SELECT sum((1 - (b.d_idx - a.d_idx) / 61.0) * a.d * b.d) FROM d a JOIN d b ON b.d_idx > a.d_idx AND b.d_idx <= a.d_idx + 60), 0) AS v)
    SELECT dates AS cohorts, round(mean, 5) + 0.0 AS mean, round(CASE WHEN v > 0 THEN mean * dates / sqrt(v) END, 3) + 0.0 AS nw_t, windows FROM m, v""",
    "filings bars",
)
def _(f):
    ics = H.event_cohort_scan(cohorts(f), "amount", "y", cohort="cohort", group="g")
    out = H.cohort_inference(ics, f.bars.select("date").distinct(), 60, window=F.trunc("cohort", "quarter"))
    return out.select(F.col("dates").alias("cohorts"), rounded("mean", 5).alias("mean"), rounded("nw_t", 3).alias("nw_t"), "windows")


@query(
    "h14_cluster_bootstrap",
    f"""WITH ids AS (SELECT entity, row_number() OVER (ORDER BY entity) - 1 AS no FROM (SELECT DISTINCT entity FROM filings)), nt AS (SELECT count(*) AS total FROM ids),
    drawn AS (SELECT rep, {draw_sql('h14', 'rep', 'no')} % total AS no FROM ids, nt, (SELECT unnest([0, 1, 2, 3, 4]) AS rep)),
    ev AS (SELECT rep || '/' || CAST(date_trunc('month', receipt_date) AS DATE) AS cohort, amount, entity % 2 AS g, CAST(right(CAST(receipt * 7919 AS VARCHAR), 4) AS INTEGER) AS y FROM drawn JOIN ids USING (no) JOIN filings USING (entity)), {COHORT_IC}
    SELECT CAST(split_part(cohort, '/', 1) AS INTEGER) AS rep, round(avg(ic), 6) AS mean_ic, CAST(sum(n) AS BIGINT) AS events FROM ci GROUP BY 1""",
    "filings",
)
def _(f):
    return bootstrap(f, ["entity"], 5).filter("cohorts > 0").select("rep", rounded("mean_ic", 6).alias("mean_ic"), "events")


def bootstrap(f: Fixtures, cluster: list[str], n: int) -> DataFrame:
    events = cohorts(f).withColumn("cycle", F.add_months("cohort", -F.pmod(F.month("cohort") - 1, F.lit(3)).cast("int")))
    return K.cluster_bootstrap_ic(events, "amount", "y", cluster=cluster, cohort="cohort", group="g", n=n, seed="h14")


def bootstrap_sql(name: str, key: str, n: int) -> str:
    """CTEs that end in {name}: mean IC of each replicate of the events with clusters of `key` drawn n times."""
    return f"""{name}_e AS (SELECT *, {key} AS key FROM ev JOIN (SELECT receipt, entity, receipt_date FROM filings) USING (receipt)),
    {name}_i AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS no FROM (SELECT DISTINCT key FROM {name}_e)), {name}_t AS (SELECT count(*) AS total FROM {name}_i),
    {name}_k AS (SELECT rep, no, count(*) AS k FROM (SELECT rep, {draw_sql('h14', 'rep', 'no')} % total AS no FROM {name}_i, {name}_t, (SELECT unnest(range({n})) AS rep)) GROUP BY ALL),
    {name}_w AS (SELECT rep, cohort, g, amount, y, k, sum(k) OVER (PARTITION BY rep, cohort, g) AS m FROM {name}_k JOIN {name}_i USING (no) JOIN {name}_e USING (key)),
    {name}_r AS (SELECT rep, cohort, k, ((sum(k) OVER (PARTITION BY rep, cohort, g ORDER BY amount)) - ((sum(k) OVER (PARTITION BY rep, cohort, g, amount)) - 1) / 2.0) / m AS a,
      ((sum(k) OVER (PARTITION BY rep, cohort, g ORDER BY y)) - ((sum(k) OVER (PARTITION BY rep, cohort, g, y)) - 1) / 2.0) / m AS b FROM {name}_w WHERE m >= 10),
    {name}_c AS (SELECT rep, cohort, sum(k) AS n, sum(k * a) AS sa, sum(k * b) AS sb, sum(k * a * a) AS saa, sum(k * b * b) AS sbb, sum(k * a * b) AS sab FROM {name}_r GROUP BY ALL HAVING sum(k) >= 30),
    {name} AS (SELECT rep, avg((sab - sa * sb / n) / sqrt((saa - sa * sa / n) * (sbb - sb * sb / n))) AS v FROM {name}_c GROUP BY rep)"""


BOOTS = 999


@query(
    "h14_cluster_confirmation",
    f"""WITH {COHORT}, {bootstrap_sql('issuer', 'entity', BOOTS)}, {bootstrap_sql('cycle', "CAST(date_trunc('quarter', receipt_date) AS DATE)", BOOTS)},
    e AS (SELECT clusters, count(v) AS valid, avg(v) AS boot_mean, least(1.0, 2 * least(avg((v <= 0)::INT), avg((v >= 0)::INT))) AS p FROM (SELECT 'issuer' AS clusters, v FROM issuer UNION ALL SELECT 'cycle', v FROM cycle) GROUP BY 1),
    c AS (SELECT *, boot_mean > 0 AND p < 0.1 AS confirms FROM e)
    SELECT clusters, valid, round(boot_mean, 6) + 0.0 AS boot_mean, round(p, 6) AS p, confirms, bool_and(confirms) OVER () AS all_confirm FROM c""",
    "filings",
)
def _(f):
    both = bootstrap(f, ["entity"], BOOTS).withColumn("clusters", F.lit("issuer")).unionByName(bootstrap(f, ["cycle"], BOOTS).withColumn("clusters", F.lit("cycle")))
    return rounded_all(K.bootstrap_verdict(both, by="clusters"), 6)


@query("h15_feature_rank_correlation", f"WITH {SCORED}, ic AS ({ranks_sql('s', 'rev', 'lnv', 'date, grp')}) SELECT 'rev|lnv' AS cell, count(ic) AS dates, round(avg(ic), 5) + 0.0 AS mean, round(stddev_samp(ic), 5) AS std, round(min(ic), 5) AS min, round(max(ic), 5) AS max FROM ic", "valid")
def _(f):
    return rounded_all(H.feature_rank_correlation(scored(f), [("rev", "lnv")]))


@query("h16_event_ordinal_nonoverlap", f"WITH {COHORT}, {COHORT_IC}, o AS (SELECT *, (row_number() OVER (ORDER BY cohort) - 1) % 3 AS part FROM ci) SELECT CAST(part AS INTEGER) AS part, count(*) AS cohorts, round(avg(ic), 5) + 0.0 AS mean FROM o GROUP BY 1", "filings")
def _(f):
    return rounded_all(H.event_ordinal_nonoverlap(H.event_cohort_scan(cohorts(f), "amount", "y", cohort="cohort", group="g"), "cohort"))


@query(
    "h17_decay_summary",
    f"""WITH {SCAN}, p AS (SELECT *, split_part(cell, ':', 1) AS feature, CAST(split_part(cell, ':', 2) AS INTEGER) AS horizon FROM nw), k AS (SELECT feature, arg_max(horizon, (abs(mean), -horizon)) AS ph, arg_max(mean, (abs(mean), -horizon)) AS pv, max(horizon) AS last FROM p GROUP BY 1),
    fl AS (SELECT *, coalesce(sign(mean) <> sign(lag(mean) OVER (PARTITION BY feature ORDER BY horizon)), false) AS flip FROM p)
    SELECT feature, ph AS peak_horizon, round(pv, 5) + 0.0 AS peak_value, min(CASE WHEN sign(mean) = sign(pv) THEN horizon END) AS onset, min(CASE WHEN horizon > ph AND abs(mean) <= abs(pv) / 2 THEN horizon END) AS half_life, count(*) FILTER (flip) AS flips,
      CASE WHEN count(*) FILTER (flip) > 0 THEN 'reversing' WHEN ph = last THEN 'building' WHEN min(CASE WHEN horizon > ph AND abs(mean) <= abs(pv) / 2 THEN horizon END) IS NOT NULL THEN 'decaying' ELSE 'steady' END AS pattern
    FROM fl JOIN k USING (feature) GROUP BY feature, ph, pv, last""",
    "valid bars",
)
def _(f):
    return rounded_all(H.decay_summary(parts(f), by=["feature"]))


GRADED = "g AS (SELECT cell, family, q, CASE WHEN q IS NULL THEN 'NE' WHEN q > 0.1 THEN 'R' WHEN nf = 0 THEN 'A' WHEN nf = 1 THEN 'B' WHEN nf = 2 THEN 'C' ELSE 'D' END AS grade, nf FROM (SELECT p_partkey AS cell, p_type AS family, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size / 100.0::DOUBLE END AS q, CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 END + CASE WHEN p_size % 3 = 0 THEN 0 ELSE 1 END AS nf FROM part))"


def graded(f: Fixtures) -> DataFrame:
    cells = f.table("part").select(F.col("p_partkey").alias("cell"), F.col("p_type").alias("family"), F.when(F.col("p_size") % 5 != 0, F.col("p_size") / 100.0).alias("q"), (F.col("p_size") % 2 == 0).alias("even"), (F.col("p_size") % 3 == 0).alias("third"))
    return H.evidence_grade(cells, ["even", "third"])


@query("h17_evidence_grade", f"WITH {GRADED} SELECT cell, grade, nf AS n_failed FROM g")
def _(f):
    return graded(f).select("cell", "grade", F.size("failed_gates").alias("n_failed"))


@query("h18_family_cards", f"WITH {GRADED}, o AS (SELECT *, list_position(['A', 'B', 'C', 'D', 'R', 'NE'], grade) AS o FROM g) SELECT family, count(*) AS cells, count(*) FILTER (grade <> 'NE') AS evaluated, arg_min(grade, (o, cell)) AS best_grade, arg_min(cell, (o, cell)) AS best_cell, count(*) FILTER (grade IN ('A', 'B')) AS passed, CASE WHEN arg_min(grade, (o, cell)) IN ('A', 'B') THEN 'confirm' WHEN arg_min(grade, (o, cell)) = 'NE' THEN 'collect' ELSE 'drop' END AS next_step FROM o GROUP BY family")
def _(f):
    return H.family_cards(graded(f))


@query("h19_source_quality_verdict", "WITH e AS (SELECT kind, status, count(*) FILTER (amount > 20000) / count(*)::DOUBLE AS ratio FROM filings GROUP BY 1, 2) SELECT kind, arg_min(status, (ratio, status)) AS worst_metric, round(min(ratio), 6) AS worst_ratio, CASE WHEN min(ratio) >= 0.95 THEN 'ok' WHEN min(ratio) >= 0.8 THEN 'warn' ELSE 'bad' END AS verdict FROM e GROUP BY kind", "filings")
def _(f):
    rows = f.filings.groupBy("kind", "status", "entity").agg(F.count_if(F.col("amount") > 20000).alias("good"), F.count("*").alias("total"))
    return H.source_quality_verdict(rows, family="kind", metric="status", good="good", total="total").withColumn("worst_ratio", rounded("worst_ratio"))


@query("h20_segment_scan", f"WITH {SCORED}, seg AS (SELECT * FROM s WHERE turnover > 60000 AND date >= DATE '1998-01-01'), ic AS ({ranks_sql('seg', 'rev', 'excess', 'date, grp')}), {DAILY} SELECT count(*) AS dates, round(avg(ic), 5) + 0.0 AS mean FROM daily", "valid")
def _(f):
    part = scored(f).filter("turnover > 60000 and date >= date '1998-01-01'")
    daily = H.daily_ic(H.long_cells(part, [("rev:5", "rev", "excess")]))
    return daily.agg(F.count("*").alias("dates"), rounded(F.avg("ic"), 5).alias("mean"))


@query("h20_eligible_end", "SELECT grp, date AS eligible_end FROM (SELECT grp, date, row_number() OVER (PARTITION BY grp ORDER BY date DESC) AS n FROM (SELECT DISTINCT grp, date FROM bars)) WHERE n = 21", "bars")
def _(f):
    return H.eligible_end(f.bars, 20)


@query("h20_lag1_check", "SELECT count(*) AS rows, 0 AS violations FROM valid", "valid")
def _(f):
    v = valid(f).withColumn("close_lag1", R.lag_by_sessions("close", 1))
    return H.lag1_check(v, "close", "close_lag1")


@query("h21_vintage_decision", "WITH d AS (SELECT o.entity, avg(CASE WHEN r.value <> o.value THEN 1.0 ELSE 0 END) AS rate, count(r.value) / count(*)::DOUBLE AS coverage FROM vintages o LEFT JOIN vintages r ON r.entity = o.entity AND r.year = o.year AND r.q = o.q AND r.is_revision WHERE NOT o.is_revision GROUP BY 1) SELECT entity, round(rate, 5) AS rate, CASE WHEN rate <= 0.9 THEN 'latest' WHEN coverage >= 0.95 THEN 'strict_pit' ELSE 'exclude' END AS decision FROM d", "vintages")
def _(f):
    r = f.vintages.filter("is_revision").select("entity", "year", "q", F.col("value").alias("new"))
    o = f.vintages.filter("not is_revision").join(r, ["entity", "year", "q"], "left")
    d = o.groupBy("entity").agg(F.avg(F.when(F.col("new") != F.col("value"), 1.0).otherwise(0.0)).alias("rate"), (F.count("new") / F.count("*")).alias("coverage"))
    return H.vintage_decision(d, rate="rate", coverage="coverage", max_rate=0.9, min_coverage=0.95).select("entity", rounded("rate", 5).alias("rate"), "decision")


@query("h22_assemble_results", "SELECT coalesce(r.cell, s.cell) AS cell, CASE WHEN r.cell IS NULL THEN 'error_unregistered' WHEN s.cell IS NULL THEN 'not_evaluated' ELSE 'scanned' END AS result FROM (SELECT c_custkey AS cell FROM customer WHERE c_custkey % 4 <> 0) r FULL JOIN (SELECT DISTINCT o_custkey AS cell FROM orders WHERE o_custkey % 3 = 0) s ON r.cell = s.cell")
def _(f):
    registry = f.table("customer").filter("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("cell"))
    scanned = f.table("orders").filter("o_custkey % 3 = 0").select(F.col("o_custkey").alias("cell")).distinct()
    return H.assemble_results(registry, scanned).select("cell", "result")


@query("h22_assemble_results_all", "SELECT coalesce(r.cell, s.cell) AS cell, CASE WHEN r.cell IS NULL THEN 'error_unregistered' WHEN s.cell IS NULL THEN 'not_evaluated' ELSE 'scanned' END AS result FROM (SELECT c_custkey AS cell FROM customer WHERE c_custkey % 4 <> 0) r FULL JOIN (SELECT DISTINCT o_custkey AS cell FROM orders WHERE o_custkey % 3 = 0) s ON r.cell = s.cell")
def _(f):
    registry = f.table("customer").filter("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("cell"))
    scanned = f.table("orders").filter("o_custkey % 3 = 0").select(F.col("o_custkey").alias("cell")).distinct()
    return H.assemble_results(registry, scanned).select("cell", "result")
