"""Macro series: transforms of the history known on each date, combinations, and broadcast to dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import sdiv
from tidemark.operators.aggregates import pivot_codes


def macro_transform(history: DataFrame, transform: str, *, series: str = "series", period: str = "obs_date", value: str = "value", date: str = "date", known: str = "available_from") -> DataFrame:
    """(date, series, value, period, known) from the history as known on each date (asof_history).

    level; ret_N, change_N and vol_N count N periods of that history; yoy and mom need the calendar month before exactly.
    """
    by = [date, series]
    newest = W.partitionBy(*by).orderBy(F.desc(period))
    n = int(transform.split("_")[1].rstrip("d")) if "_" in transform else 0
    rows = history.withColumn("_n", F.row_number().over(newest))
    path = W.partitionBy(*by).orderBy(period)
    v = F.col(value)
    if transform == "level":
        out: Column = v
    elif transform.startswith("ret_"):
        out = sdiv(v, F.lag(value, n).over(path)) - 1
    elif transform.startswith("change_"):
        out = v - F.lag(value, n).over(path)
    elif transform.startswith("vol_"):
        rows = rows.withColumn("_r", sdiv(v, F.lag(value).over(path)) - 1)
        w = path.rowsBetween(1 - n, 0)
        out = F.when(F.count("_r").over(w) == n, F.stddev_samp("_r").over(w))
    elif transform in ("yoy", "mom"):
        months = 12 if transform == "yoy" else 1
        rows = rows.withColumn("_m", F.year(period) * 12 + F.month(period))
        out = sdiv(v, F.max(value).over(W.partitionBy(*by).orderBy("_m").rangeBetween(-months, -months))) - 1
    else:
        raise ValueError(transform)
    return rows.withColumn("_out", out).filter("_n = 1").select(*by, F.col("_out").alias("value"), period, known)


def stale_gate(rows: DataFrame, calendar: DataFrame, max_sessions: int, *, date: str = "date", period: str = "obs_date", value: str = "value") -> DataFrame:
    """Value NULL where more than max_sessions sessions lie between period and date; provenance stays."""
    days = calendar.select(F.col(date).alias("_d")).distinct().withColumn("_i", F.row_number().over(W.orderBy("_d")))
    # Index of the last session on or before a day, for days of both kinds.
    wanted = rows.select(F.col(date).alias("_d")).union(rows.select(period)).distinct()
    index = wanted.join(days, "_d", "full").withColumn("_i", F.coalesce(F.last("_i", ignorenulls=True).over(W.orderBy("_d")), F.lit(0)))
    at = lambda c, name: index.select(F.col("_d").alias(c), F.col("_i").alias(name))
    out = rows.join(at(date, "_now"), date, "left").join(at(period, "_then"), period, "left")
    return out.withColumn("age_sessions", F.col("_now") - F.col("_then")).withColumn(value, F.when(F.col("age_sessions") <= max_sessions, F.col(value))).drop("_now", "_then")


def macro_combine(a: DataFrame, b: DataFrame, how: str, *, date: str = "date", known: str = "available_from") -> DataFrame:
    """Spread or ratio of two series on a date; NULL if either is missing; known when the later one is."""
    right = b.select(date, F.col("value").alias("_b"), F.col(known).alias("_k"))
    value = F.col("value") - F.col("_b") if how == "spread" else sdiv("value", "_b")
    return a.join(right, date, "left").select(date, value.alias("value"), F.greatest(known, "_k").alias(known))


def macro_broadcast(facts: DataFrame, codes: Sequence[str], *, code: str = "code", date: str = "date", known: str = "available_from", value: str = "value") -> DataFrame:
    """One row for each date with the codes as columns: of rows known by the date, the one known last."""
    best = facts.filter(F.col(known) <= F.col(date)).groupBy(date, code).agg(F.max(F.struct(known, value)).alias("_b"))
    return pivot_codes(best.select(date, code, F.col("_b")[value].alias(value)), [date], code, value, codes)
