"""Panel joins: assembly, sets of keys, rules, grids and look-ahead-free history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.keys import P, PanelKeys


def assemble_panel(base: DataFrame, groups: Sequence[DataFrame], keys: PanelKeys = P) -> DataFrame:
    """LEFT joins on the panel key; right keys must be unique. All sides share one partitioning by the key."""
    for g in groups:
        base = base.join(g, keys.all, "left")
    return base


def join_by_date(panel: DataFrame, market: DataFrame, date: str = "date") -> DataFrame:
    """Market-wide columns to every entity; a calendar-sized side that Spark broadcasts where it fits."""
    return panel.join(market, date, "left")


def assert_no_fanout(base: DataFrame, joined: DataFrame, keys: PanelKeys = P) -> DataFrame:
    """One row with row and distinct-key counts of both and whether they agree."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        by_key = df.groupBy(*keys.all).agg(F.count("*").alias("n"))
        return by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(f"{name}_rows"), F.count("*").alias(f"{name}_keys"))

    both = counts(base, "base").crossJoin(counts(joined, "joined"))
    return both.withColumn("ok", (F.col("base_rows") == F.col("joined_rows")) & (F.col("base_keys") == F.col("joined_keys")))


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that only the left side has."""
    return left.join(right, list(on), "left_anti")


def exact_period_lag(x: str, seq: str, n: int, by: Sequence[str]) -> Column:
    """The value at seq - n, NULL if that period is missing."""
    return F.max(x).over(W.partitionBy(*by).orderBy(seq).rangeBetween(-n, -n))


def wildcard_rule_join(rows: DataFrame, rules: DataFrame, exact: Sequence[str], wild: Sequence[str]) -> DataFrame:
    """Rules match on all exact columns, and on each wild column that isn't empty; a row may match many rules.

    A rule's wild columns are named with the suffix _rule. The exact columns keep it a hash join.
    """
    on = [rows[c] == rules[c] for c in exact] + [(rules[f"{c}_rule"] == "") | (rows[c] == rules[f"{c}_rule"]) for c in wild]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return rows.join(rules, cond).drop(*(rules[c] for c in exact))


def grid_left_join(codes: DataFrame, dates: DataFrame, facts: DataFrame, on: Sequence[str]) -> DataFrame:
    """The whole codes x dates grid with the facts that exist; both sides are small catalogs."""
    return codes.crossJoin(dates).join(facts, list(on), "left")


def calendar_month_lag(df: DataFrame, x: str, h: int, by: Sequence[str], month: str = "month", out: str = "lagged") -> DataFrame:
    """The value of the month h months before."""
    past = df.select(*by, F.add_months(month, h).alias(month), F.col(x).alias(out))
    return df.join(past, [*by, month], "left")


def full_outer_coalesce(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Two tables side by side."""
    return a.join(b, list(on), "full")


def snapshot_overlap(a: DataFrame, b: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Keys that both sources have, and how many of them differ in value."""
    right = b.select(*on, F.col(value).alias("_b"))
    return a.join(right, list(on)).agg(F.count("*").alias("overlap"), F.count_if(~F.col(value).eqNullSafe(F.col("_b"))).alias("conflicts"))


def shifted_panel_join(features: DataFrame, labels: DataFrame, shift: int, total: Column, keys: PanelKeys = P, idx: str = "d_idx") -> DataFrame:
    """Features at a circularly shifted session joined with labels."""
    moved = features.withColumn(idx, (F.pmod(F.col(idx) - 1 + shift, total) + 1).cast("int")).drop(keys.date)
    return labels.join(moved, [idx, keys.entity, keys.group])
