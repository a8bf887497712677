"""Look-ahead-free joins: facts become visible on the day from which they are known.

Naive interval joins are quadratic in an entity's facts. Here panel rows and fact changes are put in one stream for each
entity, facts first on equal days, and the last known values are carried forward: one shuffle, one sort, no residual
range condition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fill_forward(panel: DataFrame, facts: DataFrame, *, by: Sequence[str], date: str = "date", known: str = "available_from", values: Sequence[str], struct: bool = False) -> DataFrame:
    """Panel rows with, for each value column, the last non-NULL one known on their date (known <= date).

    struct: the values of the last fact row are taken together, NULLs included.
    """
    cols = list(values)
    left = panel.withColumns({"_known": F.col(date), "_kind": F.lit(1), "_row": F.struct(*panel.columns), "_fact": F.lit(None).cast(facts.select(F.struct(*cols)).schema[0].dataType)})
    right = facts.select(*by, F.col(known).alias("_known"), F.lit(0).alias("_kind"), F.struct(*cols).alias("_fact"))
    stream = left.select(*by, "_known", "_kind", "_fact", "_row").unionByName(right, allowMissingColumns=True)
    w = W.partitionBy(*by).orderBy("_known", "_kind").rowsBetween(W.unboundedPreceding, 0)
    if struct:
        filled = stream.withColumn("_last", F.last("_fact", ignorenulls=True).over(w))
        out = [F.col(f"_last.{c}").alias(c) for c in cols]
    else:
        filled = stream.withColumns({f"_v_{c}": F.last(F.col(f"_fact.{c}"), ignorenulls=True).over(w) for c in cols})
        out = [F.col(f"_v_{c}").alias(c) for c in cols]
    return filled.filter("_kind = 1").select("_row.*", *out)


def asof_backward(left: DataFrame, right: DataFrame, *, by: Sequence[str], left_date: str, right_date: str, values: Sequence[str]) -> DataFrame:
    """The latest right row on or before each left row."""
    return fill_forward(left, right, by=by, date=left_date, known=right_date, values=values, struct=True)


def pit_interval_join(panel: DataFrame, facts: DataFrame, *, by: Sequence[str], code: str, codes: Sequence[str], value: str = "value", date: str = "date", known: str = "available_from", order: Sequence[str] = (), since: Sequence[str] = ()) -> DataFrame:
    """Every metric code's value on [available_from, next available_from), one column for each code.

    Facts of one code known on the same day are first reduced to the greatest by `order` (W18's same-day collapse). For
    codes in `since` the day from which the value is known comes too, as <code>_from.
    """
    rank = F.struct(*order, value) if order else F.struct(value)
    wide = facts.filter(F.col(known).isNotNull()).groupBy(*by, known).agg(*(F.max(F.when(F.col(code) == c, rank)).alias(f"_{c}") for c in codes))
    days = [F.when(F.col(f"_{c}")[value].isNotNull(), F.col(known)).alias(f"{c}_from") for c in since]
    wide = wide.select(*by, known, *(F.col(f"_{c}")[value].alias(c) for c in codes), *days)
    return fill_forward(panel, wide, by=by, date=date, known=known, values=[*codes, *(f"{c}_from" for c in since)])


def pit_latest_eligible(panel: DataFrame, facts: DataFrame, *, by: Sequence[str], order: Sequence[str], values: Sequence[str], date: str = "date", known: str = "available_from") -> DataFrame:
    """Of all facts known by the date the one of the greatest (order); a late fact of an older period doesn't win."""
    one_a_day = facts.filter(F.col(known).isNotNull()).groupBy(*by, known).agg(F.max(F.struct(*order, *(c for c in values if c not in order))).alias("_best"))
    w = W.partitionBy(*by).orderBy(known).rowsBetween(W.unboundedPreceding, 0)
    best = one_a_day.withColumn("_best", F.max("_best").over(w)).select(*by, known, *(F.col("_best")[c].alias(c) for c in values))
    return fill_forward(panel, best, by=by, date=date, known=known, values=values, struct=True)


def intervals(facts: DataFrame, *, by: Sequence[str], known: str = "available_from", order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row for each entity and day of knowledge (greatest by order), with the next such day as valid_to."""
    day = facts.filter(F.col(known).isNotNull()).groupBy(*by, known).agg(F.max(F.struct(*order, *(c for c in values if c not in order))).alias("_b"))
    return day.select(*by, known, F.lead(known).over(W.partitionBy(*by).orderBy(known)).alias("valid_to"), *(F.col("_b")[c].alias(c) for c in values))


def asof_history(dates: DataFrame, obs: DataFrame, *, series: str, period: str, known: str, value: str, rank: Sequence[str], date: str = "date") -> DataFrame:
    """For every date and series the periods known by then, each in its latest vintage (by known, then rank).

    The result has a row for each (date, series, period): history as it looked on that date. Its size is inherent; the
    interval of each vintage is found first, and intervals and dates meet by month, in an equality join.
    """
    w = W.partitionBy(series, period).orderBy(known, *rank)
    one = obs.groupBy(series, period, known).agg(F.max(F.struct(*rank, value)).alias("_b")).select(series, period, known, *(F.col("_b")[c].alias(c) for c in (*rank, value)))
    spans = one.withColumn("_to", F.lead(known).over(w))
    days = dates.select(date).distinct().withColumn("_month", F.trunc(date, "month"))
    ends = F.broadcast(days.agg(F.min(date).alias("_lo"), F.max(date).alias("_hi")))
    first, last = F.trunc(F.greatest(known, "_lo"), "month"), F.trunc(F.least("_to", "_hi"), "month")
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    dealt = spans.crossJoin(ends).withColumn("_month", F.explode(months)).drop("_lo", "_hi")
    inside = (F.col(known) <= F.col(date)) & (F.col("_to").isNull() | (F.col("_to") > F.col(date)))
    return days.join(dealt, "_month").filter(inside).drop("_month", "_to")
