"""Session calendars, valid-session panels and next-session maps."""

from __future__ import annotations



from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import is_halted, sdiv
from tidemark.keys import P, PanelKeys


def trading_calendar(bars: DataFrame, keys: PanelKeys = P) -> DataFrame:
    """(group, date, d_idx), dense from 1 within a group; distinct dates first, so it numbers sessions, not rows."""
    days = bars.select(keys.group, keys.date).distinct()
    return days.withColumn("d_idx", F.row_number().over(W.partitionBy(keys.group).orderBy(keys.date)))


def valid_session_panel(bars: DataFrame, keys: PanelKeys = P) -> DataFrame:
    """Non-halted rows with v_idx, lag_close, ret (log), simple and turnover."""
    w = keys.path()
    rows = bars.filter(~is_halted()).select("*", F.row_number().over(w).alias("v_idx"), F.lag("close").over(w).alias("lag_close"))
    ratio = sdiv("close", "lag_close")
    return rows.select("*", F.ln(ratio).alias("ret"), (ratio - 1).alias("simple"), (F.col("close") * F.col("volume")).alias("turnover"))


def next_session(dates: DataFrame, calendar: DataFrame, *, date: str = "date", session: str = "date", on_or_after: bool = False, out: str = "session") -> DataFrame:
    """For each distinct date of `dates` the first session strictly after it (or on it too).

    Both sides are reduced to distinct dates, so the one ordered pass is over a calendar, not over rows.
    """
    wanted = dates.select(F.col(date).alias("_d")).filter("_d is not null").distinct().withColumn("_s", F.lit(None).cast("date"))
    days = calendar.select(F.col(session).alias("_d")).distinct().withColumn("_s", F.col("_d"))
    following = W.orderBy("_d").rowsBetween(0 if on_or_after else 1, W.unboundedFollowing)
    both = wanted.unionByName(days).groupBy("_d").agg(F.max("_s").alias("_s")).withColumn(out, F.first("_s", ignorenulls=True).over(following))
    return both.join(wanted.select("_d"), "_d", "left_semi").select(F.col("_d").alias(date), out)


def with_next_session(df: DataFrame, calendar: DataFrame, *, date: str, session: str = "date", on_or_after: bool = False, out: str = "session") -> DataFrame:
    """Rows with the session that follows their date; calendar-sized maps are broadcast by Spark where they fit."""
    return df.join(next_session(df, calendar, date=date, session=session, on_or_after=on_or_after, out=out), date, "left")


def business_days(start: str, end: str, holidays: DataFrame, holiday: str = "date") -> DataFrame:
    """Q20: weekdays from start to end that are no holidays."""
    days = holidays.sparkSession.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("date"))
    return days.filter(F.weekday("date") < 5).join(holidays.select(F.col(holiday).alias("date")), "date", "left_anti")


def month_end_sessions(calendar: DataFrame, date: str = "date") -> DataFrame:
    """Q20: the last session of each month."""
    return calendar.groupBy(F.trunc(date, "month").alias("month")).agg(F.max(date).alias("session"))


def availability_session(df: DataFrame, calendar: DataFrame, *, policy: str = "policy", date: str = "date", release: str = "release", event: str = "event", lag_days: str = "lag_days") -> DataFrame:
    """First usable session under each row's policy: next_session, same_session, release, event or manual_lag.

    next_session: strictly after the date; same_session and release: on or after; event: strictly after the event date;
    manual_lag: on or after the date plus lag_days.
    """
    at = F.when(F.col(policy) == "release", F.col(release)).when(F.col(policy) == "event", F.date_add(event, 1)).when(F.col(policy) == "manual_lag", F.date_add(date, F.col(lag_days))).when(F.col(policy) == "same_session", F.col(date)).otherwise(F.date_add(date, 1))
    rows = df.withColumn("_from", at)
    return with_next_session(rows, calendar, date="_from", on_or_after=True, out="usable_from").drop("_from")


def missing_sessions(stored: DataFrame, calendar: DataFrame, keys: PanelKeys = P) -> DataFrame:
    """Q19: (entity, group, date) sessions that an entity lacks, from its first stored date on."""
    first = stored.groupBy(keys.entity, keys.group).agg(F.min(keys.date).alias("_first"))
    expected = first.join(calendar.select(keys.group, keys.date).distinct(), keys.group).filter(F.col(keys.date) >= F.col("_first"))
    return expected.select(*keys.all).join(stored.select(*keys.all), keys.all, "left_anti")


def grid_dates(df: DataFrame, h: int, date: str = "date") -> DataFrame:
    """Every h-th distinct date, with its ordinal on that grid; a calendar-sized window."""
    n = F.row_number().over(W.orderBy(date)) - 1
    return df.select(date).distinct().withColumn("_n", n).filter(F.pmod("_n", F.lit(h)) == 0).select(date, (F.col("_n") / h).cast("int").alias("grid_idx"))


