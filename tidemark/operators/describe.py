"""Descriptive analyses of a panel metric: samples, persistence, outliers, coverage, association."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.functions.exprs import sdiv
from tidemark.keys import P, PanelKeys
from tidemark.lineage import checkpoint
from tidemark.operators import cross as C
from tidemark.operators.aggregates import distribution_stats, guarded_corr, simple_regression, weighted_corr
from tidemark.operators.joins import calendar_month_lag
from tidemark.operators.windows import month_end_row


def month_end_sample(panel: DataFrame, x: str, *, clip: tuple[float, float] = (0.01, 0.99), keys: PanelKeys = P) -> DataFrame:
    """Month-end rows with winsorized value, percentile in the group and overall, change flag and latest flag."""
    rows = month_end_row(panel, keys).withColumn("month", F.trunc(keys.date, "month"))
    rows = C.winsorize(rows, x, *clip, ["month"], f"{x}_w")
    path = W.partitionBy(keys.entity, keys.group).orderBy("month")
    before = F.lag(x).over(path)
    return rows.withColumns({
        "pct_group": C.percent_rank(x, ["month", keys.group]),
        "pct_all": C.percent_rank(x, ["month"]),
        "changed": F.when(before.isNotNull(), ~F.col(x).eqNullSafe(before)),
        "latest": F.col("month") == F.max("month").over(W.partitionBy(keys.entity, keys.group)),
    })


def distribution_by(df: DataFrame, x: str, by: Sequence[str]) -> DataFrame:
    """Distribution statistics and missing rate of each group."""
    stats = distribution_stats(df, x, by)
    missing = df.groupBy(*by).agg((1 - sdiv(F.count(x), F.count("*"))).alias("missing_rate"))
    return stats.join(missing, list(by)) if by else stats.crossJoin(missing)


def annual_baseline(facts: DataFrame, *, by: Sequence[str], year: str, num: Column, den: Column, order: Sequence[str]) -> DataFrame:
    """Ratio of annual numerator and denominator only, each of its latest vintage."""
    rank = F.struct(*order)
    out = facts.groupBy(*by, year).agg(F.max_by(num, F.when(num.isNotNull(), rank)).alias("num"), F.max_by(den, F.when(den.isNotNull(), rank)).alias("den"))
    return out.withColumn("ratio", sdiv("num", "den"))


def entity_profile(df: DataFrame, x: str, entity: str, order: str) -> DataFrame:
    """Per entity rows, mean, interquartile range, negative share and number of changes."""
    rows = df.withColumn("_c", F.coalesce(F.col(x) != F.lag(x).over(W.partitionBy(entity).orderBy(order)), F.lit(False)))
    out = rows.groupBy(entity).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.percentile(x, F.lit(0.25)).alias("_q1"), F.percentile(x, F.lit(0.75)).alias("_q3"), F.avg((F.col(x) < 0).cast("double")).alias("negative_share"), F.count_if("_c").alias("changes"))
    return out.withColumn("iqr", F.col("_q3") - F.col("_q1")).drop("_q1", "_q3")


def rank_persistence(monthly: DataFrame, x: str, lags: Sequence[int], *, by: Sequence[str] = (), entity: str = "entity", month: str = "month") -> DataFrame:
    """Correlation of a percentile with that of the same entity h months before, for each h."""
    out = None
    for h in lags:
        pairs = calendar_month_lag(monthly, x, h, [entity], month)
        one = pairs.groupBy(*by).agg(F.count_if(F.col("lagged").isNotNull() & F.col(x).isNotNull()).alias("n"), guarded_corr(x, "lagged").alias("corr")).withColumn("lag", F.lit(h))
        out = one if out is None else out.unionByName(one)
    return out


def outliers(df: DataFrame, x: str, keys: Sequence[str], n: int = 100) -> DataFrame:
    """The n rows farthest from zero."""
    return df.filter(F.col(x).isNotNull()).orderBy(F.desc(F.abs(x)), *keys).limit(n)


def coverage_diagnosis(panel: DataFrame, flags: dict[str, Column], by: Sequence[str], entity: str) -> DataFrame:
    """Per group rows and entities, and for each flag the share of rows and the entities that ever have it."""
    out = panel.groupBy(*by).agg(F.count("*").alias("rows"), F.countDistinct(entity).alias("entities"), *(F.avg(c.cast("double")).alias(f"{k}_share") for k, c in flags.items()), *(F.countDistinct(F.when(c, F.col(entity))).alias(f"{k}_entities") for k, c in flags.items()))
    return out


def association_study(df: DataFrame, x: str, y: str, *, by: Sequence[str], k: int = 5, clip: tuple[float, float] = (0.01, 0.99), min_n: int = 100) -> dict[str, DataFrame]:
    """Of winsorized pairs: correlation by group, quantile buckets with bucket means, regression.

    Equal pairs are counted once and written, so rows are read once for bounds, correlation and buckets, and no task holds a group.
    """
    rows = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = checkpoint(rows.groupBy(*by, x, y).agg(F.count("*").alias("_n")))
    bounds = checkpoint(C.quantiles(pairs, [x, y], clip, by, "_n"))

    def clipped(some: DataFrame) -> DataFrame:
        some = C.null_safe_join(some, bounds, by)
        return some.withColumns({c: X.clip(c, f"{c}_q0", f"{c}_q1") for c in (x, y)}).drop(*(f"{c}_q{i}" for c in (x, y) for i in (0, 1)))

    return {
        "correlation": weighted_corr(clipped(pairs), x, y, "_n", by).filter(F.col("n") >= min_n),
        "buckets": C.bucket_totals(clipped(pairs), [x, y], k, by, "_n").withColumnsRenamed({f"mean_{x}": "mean_x", f"mean_{y}": "mean_y"}),
        "regression": simple_regression(clipped(rows), x, y, by),
    }


def entity_history(bars: DataFrame, names: DataFrame, entity: int, n: int = 10, keys: PanelKeys = P) -> DataFrame:
    """The last n bars of one entity with return percent and name; the filter reaches the scan."""
    own = bars.filter(F.col(keys.entity) == entity)
    rows = own.withColumn("ret_pct", 100 * (sdiv("close", F.lag("close").over(keys.path())) - 1))
    return rows.orderBy(F.desc(keys.date)).limit(n).join(names, keys.entity, "left")
