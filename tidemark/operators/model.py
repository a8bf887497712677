"""Preprocessing, splits, ranking metrics and economics of scored panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import clip, is_finite, sdiv, signed_log
from tidemark.keys import P, PanelKeys
from tidemark.operators import cross as C
from tidemark.operators import pit
from tidemark.operators.aggregates import guarded_corr
from tidemark.operators.sessions import grid_dates


def add_isna_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M01."""
    return df.withColumns({f"{c}_isna": F.col(c).isNull().cast("int") for c in cols})


def impute(df: DataFrame, *, zero: Sequence[str] = (), median: Sequence[str] = (), keys: PanelKeys = P) -> DataFrame:
    """Zero, or the median of the cross-section; what remains is 0."""
    w = W.partitionBy(*keys.cross)
    fills = {c: F.coalesce(F.col(c), F.lit(0)) for c in zero} | {c: F.coalesce(F.col(c).cast("double"), F.percentile(c, F.lit(0.5)).over(w), F.lit(0.0)) for c in median}
    return df.withColumns(fills)


def fit_winsor(train: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """One row of exact bounds for each column, from the training slice only; no task holds a column."""
    return C.quantiles(train, cols, (lo, hi)).withColumnsRenamed({f"{c}_q{i}": f"{c}_{n}" for c in cols for i, n in enumerate(("lo", "hi"))})


def apply_winsor(df: DataFrame, bounds: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Clip to fitted bounds (a one-row frame); NULL stays NULL."""
    return df.crossJoin(F.broadcast(bounds)).withColumns({c: clip(c, f"{c}_lo", f"{c}_hi") for c in cols}).drop(*bounds.columns)


def transform_scale(df: DataFrame, cols: Sequence[str], *, keys: PanelKeys = P, tree: bool = False) -> DataFrame:
    """Signed log, then z-score of the date's rows; no spread gives 0; trees need neither."""
    if tree:
        return df
    df = df.withColumns({c: signed_log(c) for c in cols})
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.coalesce(C.zscore(c, [keys.date]), F.lit(0.0))) for c in cols})


def assert_finite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that aren't finite for each column, and whether all are."""
    counts = df.agg(*(F.count_if(~is_finite(c)).alias(c) for c in cols))
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    return counts.withColumn("ok", total == 0)


def walk_forward_folds(dates: DataFrame, *, n_folds: int, embargo: int, holdout: int, min_train: int, date: str = "date") -> DataFrame:
    """Expanding folds over distinct dates: fold, train_end, valid_start, valid_end; the last `holdout` sessions are
    none of them, and `embargo` sessions lie between training and validation."""
    days = dates.select(date).distinct().withColumn("_i", F.row_number().over(W.orderBy(date)))
    n = days.agg(F.count("*").alias("_n"))
    usable = F.col("_n") - holdout
    size = F.floor((usable - min_train) / n_folds)
    k = F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias("fold")
    folds = n.select("_n", k).select("fold", (F.lit(min_train) + F.col("fold") * size).alias("_v0"), F.when(F.col("fold") == n_folds - 1, usable).otherwise(min_train + (F.col("fold") + 1) * size).alias("_v1"))
    folds = folds.select("fold", (F.col("_v0") - embargo).alias("_t"), (F.col("_v0") + 1).alias("_a"), F.col("_v1").alias("_b"))
    at = lambda c, name: days.select(F.col("_i").alias(c), F.col(date).alias(name))
    return folds.join(at("_t", "train_end"), "_t").join(at("_a", "valid_start"), "_a").join(at("_b", "valid_end"), "_b").select("fold", "train_end", "valid_start", "valid_end")


def tag_folds(df: DataFrame, folds: DataFrame, date: str = "date") -> DataFrame:
    """Rows by fold and role; a handful of folds is joined by range."""
    out = df.join(F.broadcast(folds), (F.col(date) <= F.col("train_end")) | F.col(date).between(F.col("valid_start"), F.col("valid_end")))
    return out.withColumn("role", F.when(F.col(date) <= F.col("train_end"), "train").otherwise("valid")).drop("train_end", "valid_start", "valid_end")


def rank_ic(df: DataFrame, score: str, label: str, *, by: Sequence[str], min_names: int = 5) -> DataFrame:
    """Spearman correlation of each cross-section over rows with both; NULL for too few names or no spread."""
    pairs = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    ranked = pairs.select(*by, C.average_rank(score, by).alias("_a"), C.average_rank(label, by).alias("_b"))
    out = ranked.groupBy(*by).agg(F.count("*").alias("n"), guarded_corr("_a", "_b").alias("ic"))
    return out.withColumn("ic", F.when(F.col("n") >= min_names, F.col("ic")))


def weighted_daily(df: DataFrame, value: str, weight: str = "n", by: Sequence[str] = ("date",)) -> DataFrame:
    """Weighted mean over groups, of rows with a value."""
    known = df.filter(F.col(value).isNotNull())
    return known.groupBy(*by).agg(sdiv(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias(value), F.sum(weight).alias(weight))


def quantile_spread(df: DataFrame, score: str, label: str, *, by: Sequence[str], q: float = 0.2, min_names: int = 5) -> DataFrame:
    """Mean label of the top q minus that of the bottom q, by average rank / n."""
    pairs = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    p = pairs.withColumn("_p", C.average_rank(score, by) / F.count("*").over(W.partitionBy(*by)))
    out = p.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.when(F.col("_p") > 1 - q, F.col(label))).alias("top"), F.avg(F.when(F.col("_p") <= q, F.col(label))).alias("bottom"))
    return out.withColumn("spread", F.when(F.col("n") >= min_names, F.col("top") - F.col("bottom")))


def ic_report(daily: DataFrame, by: Sequence[str] = (), ic: str = "ic") -> DataFrame:
    """Dates, mean, std, ICIR, t and hit ratio of daily ICs."""
    out = daily.filter(F.col(ic).isNotNull()).groupBy(*by).agg(F.count("*").alias("dates"), F.avg(ic).alias("mean"), F.stddev_samp(ic).alias("std"), F.avg((F.col(ic) > 0).cast("double")).alias("hit_ratio"))
    return out.withColumns({"icir": sdiv("mean", "std"), "t": sdiv(F.col("mean") * F.sqrt("dates"), "std")})


def quantile_report(df: DataFrame, score: str, label: str, *, n: int = 5, date: str = "date") -> DataFrame:
    """Means over dates of the top decile's label, of the top n-th less the bottom n-th, and of the top n-th's share above
    zero. Dates with fewer than n names are left out; places are average ranks by names, and both edges count."""
    pairs = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    p = pairs.select(date, F.col(label).alias("_y"), (C.average_rank(score, [date]) / F.count("*").over(W.partitionBy(date))).alias("_p"))
    y, top = F.col("_y"), F.col("_p") >= 1 - 1 / n
    each = p.groupBy(date).agg(F.count("*").alias("_n"), F.avg(F.when(F.col("_p") >= 0.9, y)).alias("_d"), F.avg(F.when(top, y)).alias("_t"), F.avg(F.when(F.col("_p") <= 1 / n, y)).alias("_b"), F.avg(F.when(top, (y > 0).cast("double"))).alias("_h"))
    return each.filter(F.col("_n") >= n).agg(F.count("*").alias("dates"), F.avg("_d").alias("top_decile"), (F.avg("_t") - F.avg("_b")).alias("top_minus_bottom"), F.avg("_h").alias("hit_ratio_top"))


def turnover(members: DataFrame, order: str, entity: str = "entity") -> DataFrame:
    """1 - overlap / larger size of the memberships of consecutive grid dates."""
    sizes = members.groupBy(order).agg(F.count("*").alias("size"))
    past = members.select((F.col(order) + 1).alias(order), entity)
    both = members.join(past, [order, entity]).groupBy(order).agg(F.count("*").alias("overlap"))
    before = sizes.select((F.col(order) + 1).alias(order), F.col("size").alias("size_before"))
    out = sizes.join(before, order).join(both, order, "left").fillna(0, ["overlap"])
    return out.select(order, (1 - sdiv("overlap", F.greatest("size", "size_before"))).alias("turnover"))


def economic_report(df: DataFrame, score: str, label: str, *, h: int, cost_bps: float, q: float | None = 0.1, k: int | None = None, keys: PanelKeys = P) -> DataFrame:
    """On a grid of every h-th date: mean label of the held names (top fraction q or top k of the date) less that of
    all scored, turnover against the grid date before, and the spread net of cost * turnover."""
    rows = df.filter(F.col(score).isNotNull()).join(grid_dates(df, h, keys.date), keys.date)
    held = C.topk(rows, score, k, keys) if k else C.top_fraction(rows, score, 1 - q, [keys.date])
    every = rows.groupBy("grid_idx", keys.date).agg(F.avg(label).alias("all_label"), F.count("*").alias("n_scored"))
    own = held.groupBy("grid_idx").agg(F.avg(label).alias("held_label"), F.count("*").alias("n_held"))
    out = every.join(own, "grid_idx").join(turnover(held.select("grid_idx", keys.entity), "grid_idx", keys.entity), "grid_idx", "left")
    gross = F.col("held_label") - F.col("all_label")
    return out.withColumn("gross", gross).withColumn("net", gross - cost_bps / 1e4 * F.coalesce(F.col("turnover"), F.lit(1.0)))


def tag_holdout(df: DataFrame, *, embargo: int, holdout: int, date: str = "date", calendar: DataFrame | None = None) -> DataFrame:
    """Rows of the last `holdout` sessions (role holdout) and all rows up to `embargo` sessions before them (train), with
    fold NULL; calendar: the sessions that count, else those of df."""
    days = (df if calendar is None else calendar).select(date).distinct().withColumn("_n", F.row_number().over(W.orderBy(F.desc(date))))
    bounds = days.agg(F.min(F.when(F.col("_n") <= holdout, F.col(date))).alias("_h"), F.max(F.when(F.col("_n") > holdout + embargo, F.col(date))).alias("_t"))
    role = F.when(F.col(date) >= F.col("_h"), "holdout").when(F.col(date) <= F.col("_t"), "train")
    tagged = df.crossJoin(F.broadcast(bounds)).withColumns({"fold": F.lit(None).cast("int"), "role": role})
    return tagged.filter("role is not null").drop("_h", "_t")


def realized_summary(picked: DataFrame, label: str, by: Sequence[str] = (), entity: str = "entity") -> DataFrame:
    """Names, known labels, their mean and hit ratio."""
    return picked.groupBy(*by).agg(F.countDistinct(entity).alias("names"), F.count(label).alias("known"), F.avg(label).alias("mean"), F.avg((F.col(label) > 0).cast("double")).alias("hit_ratio"))


def enrich_topk(picked: DataFrame, names: DataFrame, facts: DataFrame, *, values: Sequence[str], keys: PanelKeys = P, known: str = "available_from") -> DataFrame:
    """Names and the fundamentals known on the date."""
    rows = picked.join(names, keys.entity, "left")
    return pit.asof_backward(rows, facts, by=[keys.entity], left_date=keys.date, right_date=known, values=values)


def ablation_table(reports: dict[str, DataFrame], base: str, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """One row for each variant with its metric and the difference from the base variant."""
    rows = None
    for name, df in reports.items():
        one = df.select(*by, F.lit(name).alias("variant"), F.col(metric).alias("value"))
        rows = one if rows is None else rows.unionByName(one)
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    return rows.withColumn("delta", F.col("value") - F.max(F.when(F.col("variant") == base, F.col("value"))).over(w))


