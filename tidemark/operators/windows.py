"""Time-series windows of an entity: rolling, prior and forward frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import complete, sdiv
from tidemark.keys import P, PanelKeys
from tidemark.operators import sliding

AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp, "median": lambda x: F.percentile(x, F.lit(0.5)), "count": F.count}


def rolling(agg: str, x: str, n: int, keys: PanelKeys = P) -> Column:
    """Over the last n rows with the current one."""
    return AGGREGATES[agg](F.col(x)).over(keys.back(n - 1))


def rolling_complete(agg: str, x: str, n: int, keys: PanelKeys = P) -> Column:
    """As rolling, where all n values are present."""
    w = keys.back(n - 1)
    return complete(x, AGGREGATES[agg](F.col(x)).over(w), w, n)


def rolling_prior(agg: str, x: str, first: int, last: int = 1, keys: PanelKeys = P) -> Column:
    """Over the rows first..last before the current one."""
    return AGGREGATES[agg](F.col(x)).over(keys.back(first, last))


def rolling_regression(df: DataFrame, y: str, x: str, n: int, keys: PanelKeys = P) -> DataFrame:
    """Slope, intercept and pairs of y on x over the n prior rows, and the current row's residual; NULL below n pairs."""
    return sliding.regression(df, y, x, n, keys)


def rolling_median(x: str, n: int, last: int = 0, keys: PanelKeys = P) -> Column:
    """Exact median over a ROWS frame."""
    return F.percentile(F.col(x), F.lit(0.5)).over(keys.back(n - 1 + (last > 0), last))


def rolling_zscore(x: str, n: int, keys: PanelKeys = P) -> Column:
    """(x - mean) / std over n rows; NULL for no spread."""
    w = keys.back(n - 1)
    return sdiv(F.col(x) - F.avg(x).over(w), F.stddev_samp(x).over(w))


def lag_by_sessions(x: str, n: int, keys: PanelKeys = P) -> Column:
    """The value n rows of the valid-session panel before."""
    return F.lag(x, n).over(keys.path())


def forward_value(x: str, h: int, keys: PanelKeys = P) -> Column:
    """The value exactly h valid sessions later; the session index is dense, so a lead is that self-join."""
    return F.lead(x, h).over(keys.path())


def forward_vol(ret: str, h: int, keys: PanelKeys = P) -> Column:
    """Std of the next h returns, all present."""
    w = keys.ahead(1, h)
    return complete(ret, F.stddev_samp(ret).over(w), w, h)


def forward_max_drawdown(simple: str, h: int, keys: PanelKeys = P) -> Column:
    """Least of (cumulative growth / its running maximum - 1) over the next h simple returns, all present."""
    w = keys.ahead(1, h)
    start = F.struct(F.lit(1.0).alias("level"), F.lit(1.0).alias("top"), F.lit(0.0).alias("worst"))

    def step(acc: Column, r: Column) -> Column:
        level = acc["level"] * (1 + r)
        top = F.greatest(acc["top"], level)
        return F.struct(level.alias("level"), top.alias("top"), F.least(acc["worst"], level / top - 1).alias("worst"))

    return complete(simple, F.aggregate(F.collect_list(simple).over(w), start, step, lambda a: a["worst"]), w, h)


def cumulative_events(flag: str, keys: PanelKeys = P) -> Column:
    """Running count of flagged rows; a difference of two values counts the events between."""
    return F.sum(F.when(F.col(flag), 1).otherwise(0)).over(keys.path().rowsBetween(Window.unboundedPreceding, 0))


def exists_in_range(flag: str, h1: int, h2: int, keys: PanelKeys = P) -> Column:
    """Whether a row h1+1..h2 ahead is flagged."""
    return F.coalesce(F.max(F.col(flag).cast("int")).over(keys.ahead(h1 + 1, h2)) == 1, F.lit(False))


def month_end_row(df: DataFrame, keys: PanelKeys = P) -> DataFrame:
    """The last row of each entity and month."""
    month = F.trunc(keys.date, "month")
    last = df.groupBy(keys.entity, keys.group, month.alias("_m")).agg(F.max(keys.date).alias(keys.date)).drop("_m")
    return df.join(last, keys.all, "left_semi")


def step_changes(df: DataFrame, x: str, lo: float, hi: float, keys: PanelKeys = P) -> DataFrame:
    """Rows whose ratio to the row before lies outside [lo, hi], with that ratio."""
    return df.withColumn("ratio", sdiv(F.col(x), F.lag(x).over(keys.path()))).filter((F.col("ratio") < lo) | (F.col("ratio") > hi))
