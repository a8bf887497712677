"""Pre-registered horizon scans and their inference: all cells of a scan run in one job."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import draw, sdiv
from tidemark.keys import P, PanelKeys
from tidemark.lineage import checkpoint
from tidemark.operators.aggregates import guarded_corr
from tidemark.operators.cross import average_rank, distinct_ranks
from tidemark.operators.model import rank_ic
from tidemark.operators.sessions import next_session


def hypothesis_registry(families: DataFrame, available: DataFrame) -> DataFrame:
    """Rows of (family, feature, horizons array, needs array) to one row for each horizon, with readiness.

    A hypothesis is ready if every asset that its family needs is available.
    """
    cells = families.withColumn("horizon", F.explode("horizons")).withColumn("cell", F.concat_ws(":", "family", "feature", "horizon"))
    needs = families.select("family", F.explode("needs").alias("asset")).distinct()
    lacking = needs.join(available, "asset", "left_anti").groupBy("family").agg(F.sort_array(F.collect_set("asset")).alias("missing"))
    out = cells.join(lacking, "family", "left").withColumn("status", F.when(F.col("missing").isNull(), "ready").otherwise("missing_dependency"))
    return out.select("cell", "family", "feature", "horizon", "status")


def long_cells(panel: DataFrame, cells: Sequence[tuple[str, str, str]], *, keys: PanelKeys = P, extra: Sequence[str] = ()) -> DataFrame:
    """The panel in long form: (cell, keys, x, y) for each (cell, feature, target), rows with both only."""
    pairs = F.array(*(F.struct(F.lit(c).alias("cell"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for c, x, y in cells))
    long = panel.select(*keys.all, *extra, F.explode(pairs).alias("p")).select(*keys.all, *extra, "p.*")
    return long.filter("x is not null and y is not null")


def daily_ic(long: DataFrame, *, by: Sequence[str] = ("cell",), min_names: int = 5, keys: PanelKeys = P) -> DataFrame:
    """Rank IC of each cell and date: by group, then weighted by names."""
    group = rank_ic(long, "x", "y", by=[*by, *keys.cross], min_names=min_names)
    known = group.filter("ic is not null")
    return known.groupBy(*by, keys.date).agg(sdiv(F.sum(F.col("ic") * F.col("n")), F.sum("n")).alias("ic"), F.sum("n").alias("n"))


def newey_west(daily: DataFrame, lag: int, *, by: Sequence[str] = ("cell",), idx: str = "d_idx", ic: str = "ic") -> DataFrame:
    """HAC t with Bartlett weights over real session gaps: by, dates, mean, nw_se, nw_t, pairs.

    Sessions of a group are distinct, so those at most `lag` apart are among the `lag` rows that follow: no join.
    """
    w = W.partitionBy(*by)
    rows = daily.filter(F.col(ic).isNotNull()).select(*by, F.col(idx).alias("_i"), (F.col(ic) - F.avg(ic).over(w)).alias("_d"), F.col(ic).alias("_ic"))
    base = rows.groupBy(*by).agg(F.count("*").alias("dates"), F.avg("_ic").alias("mean"), F.sum(F.col("_d") * F.col("_d")).alias("_g0"))
    ahead = w.orderBy("_i")
    cells = [F.struct((F.lead("_i", k).over(ahead) - F.col("_i")).alias("gap"), (F.col("_d") * F.lead("_d", k).over(ahead)).alias("dd")) for k in range(1, lag + 1)]
    pairs = rows.select(*by, F.array(*cells).alias("_c")).select(*by, F.explode("_c").alias("p")).filter(F.col("p.gap") <= lag)
    cov = pairs.groupBy(*by).agg(F.sum((1 - F.col("p.gap") / (lag + 1)) * F.col("p.dd")).alias("_g"), F.count("*").alias("pairs"))
    out = base.join(cov, list(by), "left").fillna(0, ["pairs"]) if by else base.crossJoin(cov)
    var = F.col("_g0") + 2 * F.coalesce("_g", F.lit(0.0))
    se = F.when(var > 0, F.sqrt(var) / F.col("dates"))
    return out.select(*by, "dates", "mean", se.alias("nw_se"), sdiv("mean", se).alias("nw_t"), "pairs")


@F.pandas_udf(T.DoubleType())
def normal_p(t: pd.Series) -> pd.Series:
    """Two-sided normal p-value."""
    return t.map(lambda x: math.erfc(abs(x) / math.sqrt(2)) if pd.notna(x) else np.nan).astype("float64").where(t.notna())


@F.pandas_udf(T.DoubleType())
def sign_test_p(hits: pd.Series, n: pd.Series) -> pd.Series:
    """Exact one-sided binomial P(X >= hits) at 1/2."""

    k, m = (v.fillna(0).to_numpy().astype(np.int64) for v in (hits, n))
    logs, out = np.r_[0.0, np.cumsum(np.log(np.arange(1, m.max(initial=0) + 1)))], np.ones(len(m))
    for size in np.unique(m):
        i, mine = np.arange(size + 1), m == size
        tail = np.cumsum(np.exp(logs[size] - logs[i] - logs[size - i] - size * math.log(2))[::-1])[::-1]
        out[mine] = np.minimum(1.0, tail[k[mine]])
    return pd.Series(out)


def benjamini_hochberg(df: DataFrame, p: str = "p", *, by: Sequence[str] = (), out: str = "q") -> DataFrame:
    """Monotone q-values; a missing p counts as 1. Equal p have the q of the last of them.

    Without `by` the distinct p are ranked by range (global_rank), and least values of later ranges are carried over by one
    row for each range, so that no task holds all hypotheses.
    """
    rows = df.withColumn("_p", F.coalesce(F.col(p), F.lit(1.0)))
    if by:
        part = W.partitionBy(*by)
        upto = F.count("*").over(part.orderBy("_p"))
        ranked = rows.withColumn("_v", F.col("_p") * F.count("*").over(part) / upto)
        worst = F.min("_v").over(part.orderBy(F.desc("_p")))
        return ranked.withColumn(out, F.least(worst, F.lit(1.0))).drop("_p", "_v")
    each, total = distinct_ranks(rows, "_p"), F.broadcast(rows.agg(F.count("*").alias("_m")))
    each = each.crossJoin(total).withColumn("_v", F.col("_p") * F.col("_m") / (F.col("rank") + F.col("_n") - 1))
    ranges = each.groupBy("_b").agg(F.min("_v").alias("_least"))
    later = ranges.select("_b", F.min("_least").over(W.orderBy(F.desc("_b")).rowsBetween(W.unboundedPreceding, -1)).alias("_later"))
    inside = F.min("_v").over(W.partitionBy("_b").orderBy(F.desc("_p")))
    q = each.withColumn("_in", inside).join(later, "_b").select("_p", F.least("_in", "_later", F.lit(1.0)).alias(out))
    return rows.join(q, "_p").drop("_p")


def isolated_spike(df: DataFrame, *, by: Sequence[str], order: str, value: str = "mean") -> DataFrame:
    """Positive value none of whose neighbours on the grid is positive."""
    w = W.partitionBy(*by).orderBy(order)
    near = F.coalesce(F.lag(value).over(w) > 0, F.lit(False)) | F.coalesce(F.lead(value).over(w) > 0, F.lit(False))
    return df.withColumn("isolated", F.coalesce(F.col(value) > 0, F.lit(False)) & ~near)


def gate(base: DataFrame, other: DataFrame, *, on: Sequence[str], value: str = "mean", min_retention: float = 0.5) -> DataFrame:
    """Sign agreement and retention of another sample's value against the base one."""
    o = other.select(*on, F.col(value).alias("_o"))
    out = base.join(o, list(on), "left")
    same = F.coalesce(F.signum(value) == F.signum("_o"), F.lit(False))
    kept = sdiv(F.abs("_o"), F.abs(value))
    return out.withColumns({"same_sign": same, "retention": kept, "gate_ok": same & F.coalesce(kept >= min_retention, F.lit(False))}).drop("_o")


def period_majority(daily: DataFrame, period: Column, *, by: Sequence[str] = ("cell",), ic: str = "ic") -> DataFrame:
    """Periods, those whose mean has the sign of the overall mean, and whether they are the majority."""
    every = daily.groupBy(*by).agg(F.avg(ic).alias("mean"))
    each = daily.groupBy(*by, period.alias("_period")).agg(F.avg(ic).alias("_m"))
    out = each.join(every, list(by)).groupBy(*by).agg(F.count("*").alias("periods"), F.count_if(F.signum("_m") == F.signum("mean")).alias("agreeing"))
    return out.withColumn("majority", F.col("agreeing") * 2 > F.col("periods"))


def nonoverlap_offsets(daily: DataFrame, stride: int, *, by: Sequence[str] = ("cell",), idx: str = "d_idx", ic: str = "ic") -> DataFrame:
    """For each offset of the stride the ICs that don't overlap: dates, mean, hits. No rescan: daily ICs are regrouped."""
    rows = daily.filter(F.col(ic).isNotNull()).withColumn("offset", F.pmod(idx, F.lit(stride)))
    return rows.groupBy(*by, "offset").agg(F.count("*").alias("dates"), F.avg(ic).alias("mean"), F.count_if(F.col(ic) > 0).alias("hits"))


def offset_summary(offsets: DataFrame, *, by: Sequence[str] = ("cell",), min_dates: int = 1) -> DataFrame:
    """Least, median and greatest offset mean, and the share of offsets with enough dates."""
    ok = F.when(F.col("dates") >= min_dates, F.col("mean"))
    return offsets.groupBy(*by).agg(F.min(ok).alias("min_mean"), F.percentile(ok, F.lit(0.5)).alias("median_mean"), F.max(ok).alias("max_mean"), F.avg((F.col("dates") >= min_dates).cast("double")).alias("valid_ratio"))


def _replicates(df: DataFrame, n: int, first: int = 0) -> DataFrame:
    return df.withColumn("rep", F.explode(F.sequence(F.lit(first), F.lit(first + n - 1))))


def permute_cross_section(long: DataFrame, n: int, *, seed: str, keys: PanelKeys = P, first: int = 0) -> DataFrame:
    """N replicates in which x is permuted within each cross-section, with one permutation for all cells of a key.

    Rows in key order take the x of the rows in the order of a hash of (seed, replicate, key); n stays small in one call
    to bound what is shuffled (batches of replicates are counted on from `first`).
    """
    rows = _replicates(long, n, first)
    part = W.partitionBy("rep", "cell", *keys.cross)
    shuffled = draw(seed, "rep", keys.date, keys.entity)
    taker = rows.withColumn("_k", F.row_number().over(part.orderBy(keys.entity))).drop("x")
    giver = rows.select("rep", "cell", *keys.cross, "x", F.row_number().over(part.orderBy(shuffled, keys.entity)).alias("_k"))
    return taker.join(giver, ["rep", "cell", *keys.cross, "_k"]).drop("_k")


def empirical_p(observed: DataFrame, null: DataFrame, *, by: Sequence[str] = ("cell",), stat: str = "t") -> DataFrame:
    """(1 + replicates at least as extreme) / (1 + replicates); equal statistics count, whatever rounding does to them."""
    n = null.select(*by, F.abs(stat).alias("_t"))
    out = observed.join(n, list(by), "left").groupBy(*by).agg(F.count("_t").alias("replicates"), F.count_if(F.col("_t") >= F.abs(F.col(stat)) - 1e-9).alias("extreme"))
    return out.withColumn("p", (F.col("extreme") + 1) / (F.col("replicates") + 1))


def permutation_report(observed: DataFrame, null: DataFrame, *, limit: float = 0.10, stat: str = "nw_t") -> DataFrame:
    """For each cell its empirical p, the q-values over all cells (of the normal p of the observed statistic, and of the
    empirical p), and the scan's discoveries (q at most `limit`) beside those of the replicates, each with its own BH step:
    count_p = (1 + replicates with at least as many discoveries) / (1 + replicates).

    observed: cell, stat; null: rep, cell, stat. Both are small beside the scans behind them, and are made once.
    """
    observed, null = checkpoint(observed.select("cell", stat)), checkpoint(null.select("rep", "cell", stat))
    seen = benjamini_hochberg(observed.select("cell", F.col(stat).alias("t"), normal_p(stat).alias("normal_p")), "normal_p")
    found = seen.agg(F.count_if(F.col("q") <= limit).alias("discoveries"))
    scans = benjamini_hochberg(null.select("rep", "cell", normal_p(stat).alias("normal_p")), "normal_p", by=["rep"])
    scans = scans.groupBy("rep").agg(F.count_if(F.col("q") <= limit).alias("_k"))
    counts = found.join(scans, F.lit(True), "left").groupBy("discoveries").agg(((F.count_if(F.col("_k") >= F.col("discoveries")) + 1) / (F.count("_k") + 1)).alias("count_p"))
    each = benjamini_hochberg(empirical_p(seen.select("cell", "t"), null.select("cell", F.col(stat).alias("t"))), out="empirical_q")
    return each.join(seen.select("cell", "normal_p", "q"), "cell").crossJoin(F.broadcast(counts))


def lookahead_canary(panel: DataFrame, label: str, *, keys: PanelKeys = P, min_names: int = 5) -> DataFrame:
    """The label against its own rank must have a mean IC of 1."""
    rows = panel.withColumn("_own", average_rank(label, keys.cross))
    return rank_ic(rows, "_own", label, by=keys.cross, min_names=min_names).agg(F.avg("ic").alias("mean_ic"), F.count("ic").alias("cross_sections"))


def event_cohort_scan(events: DataFrame, x: str, y: str, *, cohort: str, group: str, min_group: int = 10, min_cohort: int = 30) -> DataFrame:
    """Ranks inside (cohort, group) of at least min_group, pooled by cohort of at least min_cohort: Pearson of ranks."""
    rows = events.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("_n", F.count("*").over(W.partitionBy(cohort, group))).filter(F.col("_n") >= min_group)
    ranks = rows.select(cohort, group, (average_rank(x, [cohort, group]) / F.col("_n")).alias("_a"), (average_rank(y, [cohort, group]) / F.col("_n")).alias("_b"))
    return ranks.groupBy(cohort).agg(F.count("*").alias("n"), guarded_corr("_a", "_b").alias("ic")).filter(F.col("n") >= min_cohort)


def cohort_inference(cohorts: DataFrame, sessions: DataFrame, lag: int, *, cohort: str = "cohort", window: Column, ic: str = "ic", session: str = "date") -> DataFrame:
    """Cohorts, mean, HAC t of cohort ICs over the market's session ordinals, and the filing windows they come from.

    A cohort's ordinal is that of the first session on or after its date, so two cohorts are as far apart as the market's
    sessions between them; cohorts after the last session are left out. sessions: distinct dates, one row each.
    """
    numbered = sessions.select(F.col(session).alias("_s"), F.row_number().over(W.orderBy(session)).alias("d_idx"))
    at = next_session(cohorts.select(F.col(cohort).alias("date")), sessions.select(F.col(session).alias("date")), on_or_after=True)
    rows = cohorts.filter(F.col(ic).isNotNull()).join(at.select(F.col("date").alias(cohort), F.col("session").alias("_s")), cohort).join(numbered, "_s")
    windows = rows.agg(F.count_distinct(window).alias("windows"))
    return newey_west(rows, lag, by=(), ic=ic).crossJoin(F.broadcast(windows))


def feature_rank_correlation(panel: DataFrame, pairs: Sequence[tuple[str, str]], *, keys: PanelKeys = P, min_names: int = 5) -> DataFrame:
    """Daily Spearman of feature pairs: mean, std, least and greatest."""
    long = long_cells(panel, [(f"{a}|{b}", a, b) for a, b in pairs], keys=keys)
    daily = rank_ic(long, "x", "y", by=["cell", *keys.cross], min_names=min_names)
    return daily.filter("ic is not null").groupBy("cell").agg(F.count("*").alias("dates"), F.avg("ic").alias("mean"), F.stddev_samp("ic").alias("std"), F.min("ic").alias("min"), F.max("ic").alias("max"))


def event_ordinal_nonoverlap(cohorts: DataFrame, order: str, k: int = 3) -> DataFrame:
    """Every k-th cohort, for each remainder: dates and mean; one row a cohort goes in."""
    rows = cohorts.withColumn("part", F.pmod(F.row_number().over(W.orderBy(order)) - 1, F.lit(k)))
    return rows.groupBy("part").agg(F.count("*").alias("cohorts"), F.avg("ic").alias("mean"))


def decay_summary(cells: DataFrame, *, by: Sequence[str], horizon: str = "horizon", value: str = "mean") -> DataFrame:
    """Peak horizon and value, onset (first horizon with the peak's sign), half-life (first later horizon at or under
    half the peak), sign flips along the horizons, and the pattern they make."""
    w = W.partitionBy(*by).orderBy(horizon)
    peak = cells.groupBy(*by).agg(F.max_by(F.struct(F.col(horizon).alias("h"), F.col(value).alias("v")), F.struct(F.abs(value), -F.col(horizon))).alias("_p"))
    rows = cells.withColumn("_flip", F.coalesce(F.signum(value) != F.signum(F.lag(value).over(w)), F.lit(False))).join(peak, list(by))
    out = rows.groupBy(*by).agg(
        F.first("_p.h").alias("peak_horizon"), F.first("_p.v").alias("peak_value"),
        F.min(F.when(F.signum(value) == F.signum("_p.v"), F.col(horizon))).alias("onset"),
        F.min(F.when((F.col(horizon) > F.col("_p.h")) & (F.abs(value) <= F.abs("_p.v") / 2), F.col(horizon))).alias("half_life"),
        F.count_if("_flip").alias("flips"), F.max(horizon).alias("_last"),
    )
    pattern = F.when(F.col("flips") > 0, "reversing").when(F.col("peak_horizon") == F.col("_last"), "building").when(F.col("half_life").isNotNull(), "decaying").otherwise("steady")
    return out.withColumn("pattern", pattern).drop("_last")


def evidence_grade(cells: DataFrame, gates: Sequence[str], *, q: str = "q", limit: float = 0.10) -> DataFrame:
    """Gates that failed, and a grade: NE not evaluated, R rejected, A all gates, B one failed, C two, D more."""
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(F.col(g), F.lit(False)), F.lit(g)) for g in gates)))
    n = F.size("failed_gates")
    grade = F.when(F.col(q).isNull(), "NE").when(F.col(q) > limit, "R").when(n == 0, "A").when(n == 1, "B").when(n == 2, "C").otherwise("D")
    return cells.withColumn("failed_gates", failed).withColumn("grade", grade)


def family_cards(graded: DataFrame, family: str = "family") -> DataFrame:
    """One row for each family: cells, evaluated, best grade and its cell, screened share and next step."""
    order = F.element_at(F.create_map(*(F.lit(x) for kv in {"A": 1, "B": 2, "C": 3, "D": 4, "R": 5, "NE": 6}.items() for x in kv)), F.col("grade"))
    rows = graded.withColumn("_o", order)
    out = rows.groupBy(family).agg(F.count("*").alias("cells"), F.count_if(F.col("grade") != "NE").alias("evaluated"), F.min_by("grade", F.struct("_o", "cell")).alias("best_grade"), F.min_by("cell", F.struct("_o", "cell")).alias("best_cell"), F.count_if(F.col("grade").isin("A", "B")).alias("passed"))
    step = F.when(F.col("best_grade").isin("A", "B"), "confirm").when(F.col("best_grade") == "NE", "collect").otherwise("drop")
    return out.withColumn("next_step", step)


def source_quality_verdict(metrics: DataFrame, *, family: str, metric: str, good: str, total: str, ok: float = 0.95, warn: float = 0.8) -> DataFrame:
    """Row-weighted ratio of each metric, the worst metric of each family, and ok, warn, bad or unmeasured."""
    each = metrics.groupBy(family, metric).agg(sdiv(F.sum(good), F.sum(total)).alias("ratio"))
    out = each.groupBy(family).agg(F.min_by(metric, F.struct("ratio", metric)).alias("worst_metric"), F.min("ratio").alias("worst_ratio"))
    return out.withColumn("verdict", F.when(F.col("worst_ratio").isNull(), "unmeasured").when(F.col("worst_ratio") >= ok, "ok").when(F.col("worst_ratio") >= warn, "warn").otherwise("bad"))


def vintage_decision(diff: DataFrame, *, rate: str, coverage: str, max_rate: float, min_coverage: float) -> DataFrame:
    """Keep the newest vintage if few values changed, use strict vintages if coverage allows, else exclude."""
    out = F.when(F.col(rate) <= max_rate, "latest").when(F.col(coverage) >= min_coverage, "strict_pit").otherwise("exclude")
    return diff.withColumn("decision", out)


def assemble_results(registry: DataFrame, scanned: DataFrame, cell: str = "cell") -> DataFrame:
    """Every registered cell once: its scanned row, or not_evaluated; unknown and doubled cells are errors."""
    known = registry.withColumn("_reg", F.lit(True))
    counted = scanned.withColumn("_n", F.count("*").over(W.partitionBy(cell)))
    out = known.join(counted, cell, "full")
    status = F.when(F.col("_reg").isNull(), "error_unregistered").when(F.col("_n") > 1, "error_duplicate").when(F.col("_n").isNull(), "not_evaluated").otherwise("scanned")
    return out.withColumn("result", status).drop("_reg", "_n")


def eligible_end(panel: DataFrame, h: int, *, by: str = "grp", date: str = "date") -> DataFrame:
    """The last date of each group after which h sessions still follow."""
    days = panel.select(by, date).distinct()
    n = F.row_number().over(W.partitionBy(by).orderBy(F.desc(date)))
    return days.withColumn("_n", n).filter(F.col("_n") == h + 1).select(by, F.col(date).alias("eligible_end"))


def lag1_check(df: DataFrame, x: str, lagged: str, keys: PanelKeys = P) -> DataFrame:
    """Rows whose lagged column isn't the value of the row before."""
    want = F.lag(x).over(keys.path())
    return df.withColumn("_w", want).agg(F.count("*").alias("rows"), F.count_if(~F.col(lagged).eqNullSafe(F.col("_w"))).alias("violations"))
