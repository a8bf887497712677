"""Coverage, freshness, profiling, domain checks, validation and collection bookkeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import sdiv
from tidemark.keys import P, PanelKeys

# Coverage and freshness


def coverage_report(dates: DataFrame, codes: DataFrame, facts: DataFrame, *, code: str = "code", date: str = "date", value: str = "value", known: str = "available_from") -> DataFrame:
    """Q01: per code target, fact, non-NULL, NULL and missing cells of the date grid, ratio, and rows known after their date.

    The grid isn't made: cells are counted, so the work follows the facts.
    """
    grid = dates.select(date).distinct()
    inside = facts.join(grid, date, "left_semi").groupBy(code).agg(F.count("*").alias("fact"), F.count(value).alias("non_null"), F.count_if(F.col(known) > F.col(date)).alias("pit_violations"))
    out = codes.select(code).distinct().crossJoin(F.broadcast(grid.agg(F.count("*").alias("target")))).join(inside, code, "left").fillna(0, ["fact", "non_null", "pit_violations"])
    return out.withColumns({"nulls": F.col("fact") - F.col("non_null"), "missing": F.col("target") - F.col("fact"), "ratio": sdiv("non_null", "target")})


def readiness_report(coverage: DataFrame, facts: DataFrame, dates: DataFrame, *, code: str = "code", date: str = "date", value: str = "value", min_ratio: float = 0.95) -> DataFrame:
    """Q02: blockers of each code, judged from its own first date with a value on."""
    first = facts.filter(F.col(value).isNotNull()).groupBy(code).agg(F.min(date).alias("first_date"), F.countDistinct(date).alias("_have"))
    days = dates.select(date).distinct().withColumn("_left", F.count("*").over(W.orderBy(F.desc(date))))
    rows = coverage.join(first, code, "left").join(days.select(F.col(date).alias("first_date"), "_left"), "first_date", "left")
    own = sdiv("_have", "_left")
    blockers = F.array_compact(F.array(F.when(F.col("first_date").isNull(), F.lit("no_data")), F.when(own < min_ratio, F.lit("low_coverage")), F.when(F.col("pit_violations") > 0, F.lit("pit_violation"))))
    return rows.select(code, "first_date", own.alias("own_ratio"), blockers.alias("blockers"), (F.size(blockers) == 0).alias("ready"))


def freshness_gate(facts: DataFrame, limits: DataFrame, *, code: str, date: str, today: Column) -> DataFrame:
    """Q03, Q11n, Q25: latest observation of each code against its allowed lag in days; no rows: stale."""
    last = facts.groupBy(code).agg(F.max(date).alias("latest"))
    out = limits.join(last, code, "left").withColumn("age_days", F.datediff(today, "latest"))
    return out.withColumn("stale", F.coalesce(F.col("age_days") > F.col("max_lag"), F.lit(True)))


def ratios(df: DataFrame, by: Sequence[str], conditions: dict[str, Column]) -> DataFrame:
    """Q04, Q06, Q09, Q10, Q12j, Q12k: rows and the share of each condition in one pass."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in conditions.items())).withColumns({f"{k}_ratio": sdiv(k, "n") for k in conditions})


def multi_receipt_keys(df: DataFrame, keys: Sequence[str], receipt: str) -> DataFrame:
    """Q04: keys with more than one receipt."""
    return df.groupBy(*keys).agg(F.countDistinct(receipt).alias("receipts")).filter("receipts > 1")


def vintage_quality(df: DataFrame, keys: Sequence[str], by: Sequence[str], *, priority: str, revision: str) -> DataFrame:
    """Q05: per group facts, multi-vintage facts, facts with revisions, and winners that aren't of the best priority."""
    best = W.partitionBy(*by)
    each = df.withColumn("_best", F.min(priority).over(best)).groupBy(*dict.fromkeys([*by, *keys])).agg(F.count("*").alias("_n"), F.max(F.col(revision).cast("int")).alias("_r"), F.min(priority).alias("_p"), F.first("_best").alias("_b"))
    return each.groupBy(*by).agg(F.count("*").alias("facts"), F.count_if(F.col("_n") > 1).alias("multi_vintage"), F.sum("_r").alias("revised"), F.count_if(F.col("_p") > F.col("_b")).alias("fallback"))


def feature_coverage(panel: DataFrame, features: Sequence[str], by: Sequence[str], date: str = "date") -> DataFrame:
    """Q07: per feature and group: rows, non-NULL, ratio, and exact quartiles of the per-date ratio. One unpivot, two levels."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).isNotNull().alias("has")) for c in features))).alias("p")
    daily = panel.select(*by, date, pairs).groupBy(*by, date, "p.feature").agg(F.count("*").alias("n"), F.count_if("p.has").alias("have"))
    daily = daily.withColumn("r", sdiv("have", "n"))
    return daily.groupBy(*by, "feature").agg(F.sum("n").alias("rows"), F.sum("have").alias("non_null"), sdiv(F.sum("have"), F.sum("n")).alias("ratio"), F.min("r").alias("min_daily"), F.percentile("r", F.lit(0.5)).alias("median_daily"))


def vintage_window_diff(facts: DataFrame, keys: Sequence[str], *, value: str = "value", order: Sequence[str] = ("available_from",)) -> DataFrame:
    """Q08: oldest against newest vintage of each key, and whether the value changed."""
    rank = F.struct(*order, value)
    out = facts.groupBy(*keys).agg(F.min_by(value, rank).alias("old"), F.max_by(value, rank).alias("new"), F.count("*").alias("vintages"))
    return out.withColumn("changed", ~F.col("old").eqNullSafe(F.col("new")))


# Profiling


def profile_counts(df: DataFrame, entity: str, time: str) -> DataFrame:
    """Q11a."""
    return df.agg(F.count("*").alias("rows"), F.countDistinct(entity).alias("entities"), F.countDistinct(time).alias("times"), F.min(time).alias("min_time"), F.max(time).alias("max_time"))


def profile_time(df: DataFrame, entity: str, year: Column, by: Sequence[str] = ()) -> DataFrame:
    """Q11b."""
    return df.groupBy(*by, year.alias("year")).agg(F.count("*").alias("rows"), F.countDistinct(entity).alias("entities"))


def profile_categories(df: DataFrame, columns: Sequence[str], entity: str) -> DataFrame:
    """One unpivot, one grouping for all category columns."""
    long = df.select(entity, F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))).alias("p"))
    return long.groupBy("p.column", "p.value").agg(F.count("*").alias("rows"), F.countDistinct(entity).alias("entities"))


def profile_nulls(df: DataFrame) -> DataFrame:
    """Q11d: NULL and blank-text percentages of every column, from one wide aggregation."""
    text = {c for c, t in df.dtypes if t == "string"}
    wide = df.agg(F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)), *(F.count_if(F.trim(c) == "").alias(f"b_{i}") for i, c in enumerate(df.columns) if c in text))
    cells = [F.struct(F.lit(c).alias("column"), (100 * sdiv(f"n_{i}", "_n")).alias("null_pct"), (100 * sdiv(f"b_{i}", "_n") if c in text else F.lit(None).cast("double")).alias("blank_pct")) for i, c in enumerate(df.columns)]
    return wide.select(F.explode(F.array(*cells)).alias("p")).select("p.*")


def profile_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q11e."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return n.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess_rows"))


def profile_per_entity(df: DataFrame, entity: str) -> DataFrame:
    """Q11f."""
    n = df.groupBy(entity).agg(F.count("*").alias("n"))
    return n.agg(F.min("n").alias("min"), F.max("n").alias("max"), F.avg("n").alias("avg"), F.percentile("n", F.lit(0.5)).alias("p50"), F.percentile("n", F.lit(0.95)).alias("p95"))


def profile_grid_coverage(df: DataFrame, entity: str, time: str) -> DataFrame:
    """Q11g."""
    return df.agg(sdiv(F.count("*"), F.countDistinct(entity) * F.countDistinct(time)).alias("grid_coverage"))


def profile_quantiles(df: DataFrame, x: str, by: Sequence[str] = (), sample: float | None = None, seed: int = 7) -> DataFrame:
    """Q11h: sampled only on request."""
    df = df.sample(sample, seed=seed) if sample else df
    qs = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
    n = F.count(x)
    return df.groupBy(*by).agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("avg"), *(F.percentile(x, F.lit(q)).alias(f"p{round(100 * q):02d}") for q in qs), (100 * sdiv(F.count_if(F.col(x) == 0), n)).alias("zero_pct"), (100 * sdiv(F.count_if(F.col(x) < 0), n)).alias("negative_pct"))


def profile_topn(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """Q11i, Q11k: the n most frequent values of each column."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))).alias("p"))
    counts = long.groupBy("p.column", "p.value").agg(F.count("*").alias("rows"))
    return counts.withColumn("rank", F.row_number().over(W.partitionBy("column").orderBy(F.desc("rows"), "value"))).filter(F.col("rank") <= n)


def profile_ingest_trend(df: DataFrame, time: str) -> DataFrame:
    """Q11j."""
    return df.groupBy(F.date_format(time, "yyyy-MM").alias("month")).agg(F.count("*").alias("rows"))


def profile_fk(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Q11l: distinct child keys and those without a parent."""
    c = child.select(F.col(key).alias("_k")).filter("_k is not null").distinct()
    p = parent.select(F.col(parent_key).alias("_k")).distinct().withColumn("_p", F.lit(True))
    return c.join(p, "_k", "left").agg(F.count("*").alias("child_keys"), F.count_if(F.col("_p").isNull()).alias("orphans"))


def profile_pit(df: DataFrame, known: str, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Q11m, Q12m: rows known only after their date, and by how many days at most."""
    late = F.datediff(known, date)
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(late > 0).alias("late"), F.max(F.when(late > 0, late)).alias("max_days"))


def drilldown(df: DataFrame, dim: str, limit: int) -> DataFrame:
    """Q11o: rows of the first `limit` values of a dimension, so that a check grouped by it covers all of them at once."""
    values = df.select(dim).distinct().orderBy(dim).limit(limit)
    return df.join(F.broadcast(values), dim, "left_semi")


# Domain checks


def ohlc_identity(bars: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q12a."""
    live = ~((F.col("open") == 0) & (F.col("high") == 0) & (F.col("low") == 0))
    bad = live & ((F.col("high") < F.col("low")) | (F.col("high") < F.col("open")) | (F.col("low") > F.col("open")) | (F.col("high") < F.col("close")) | (F.col("low") > F.col("close")))
    return bars.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(bad).alias("violations"), F.count_if(live & (F.col("close") > F.col("high"))).alias("close_above_high"))


def survivorship_coverage(snapshots: DataFrame, data: DataFrame, *, as_of: str, entity: str) -> DataFrame:
    """Listed entities of each snapshot, and those with any data."""
    have = data.select(entity).distinct().withColumn("_h", F.lit(1))
    out = snapshots.join(have, entity, "left").groupBy(as_of).agg(F.count("*").alias("listed"), F.count("_h").alias("covered"))
    return out.withColumn("missing_pct", 100 * (1 - sdiv("covered", "listed")))


def halted_ratio(bars: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q12d."""
    halted = (F.col("open") == 0) & (F.col("high") == 0) & (F.col("low") == 0)
    return bars.groupBy(*by).agg((100 * F.avg(halted.cast("double"))).alias("halted_pct"), (100 * F.avg((F.col("volume") == 0).cast("double"))).alias("zero_volume_pct"))


def listing_span(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Q12e."""
    span = df.groupBy(entity).agg(F.datediff(F.max(date), F.min(date)).alias("d"))
    return span.agg(F.min("d").alias("min"), F.max("d").alias("max"), F.avg("d").alias("avg"), F.percentile("d", F.lit(0.5)).alias("p50"))


def join_coverage(left: DataFrame, right: DataFrame, on: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Q12g, Q12q: distinct keys and those with a partner row, by group."""
    a = left.select(*on, *by).distinct()
    b = right.select(*on).distinct().withColumn("_b", F.lit(1))
    out = a.join(b, list(on), "left").groupBy(*by).agg(F.count("*").alias("keys"), F.count("_b").alias("matched"))
    return out.withColumn("matched_pct", 100 * sdiv("matched", "keys"))


def top_concepts(df: DataFrame, code: str, text: str, n: int = 50) -> DataFrame:
    """Q12h: the most frequent codes, with the share of values that parse as numbers."""
    return df.groupBy(code).agg(F.count("*").alias("rows"), (100 * F.avg(F.col(text).try_cast("double").isNotNull().cast("double"))).alias("numeric_pct")).orderBy(F.desc("rows"), code).limit(n)


def metric_coverage(df: DataFrame, metric: str, entity: str, year: Column) -> DataFrame:
    """Q12l, Q12t."""
    return df.groupBy(metric).agg(F.count("*").alias("facts"), F.countDistinct(entity).alias("entities"), F.countDistinct(year).alias("years"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))


def calendar_gap(df: DataFrame, calendar: DataFrame, code: str, date: str) -> DataFrame:
    """Q12o: calendar days less feature days within each code's own range; days are numbered once, not joined by range."""
    days = calendar.select(date).distinct().withColumn("_i", F.row_number().over(W.orderBy(date)))
    on = df.select(code, date).distinct().join(days, date)
    return on.groupBy(code).agg((F.max("_i") - F.min("_i") + 1 - F.count("*")).alias("gap"))


def catalog_orphans(catalog: DataFrame, inputs: DataFrame, on: str) -> DataFrame:
    """Q12p: catalog rows with their number of inputs, and whether there are none."""
    n = inputs.groupBy(on).agg(F.count("*").alias("inputs"))
    return catalog.join(n, on, "left").fillna(0, ["inputs"]).withColumn("orphan", F.col("inputs") == 0)


def run_status_mix(runs: DataFrame, *, now: Column, max_hours: float = 24.0) -> DataFrame:
    """Q12r: per type and status: runs, mean seconds, and how many have been running for too long."""
    seconds = F.unix_timestamp("ended_at") - F.unix_timestamp("started_at")
    stale = (F.col("status") == "running") & (F.unix_timestamp(now) - F.unix_timestamp("started_at") > max_hours * 3600)
    return runs.groupBy("run_type", "status").agg(F.count("*").alias("runs"), F.avg(seconds).alias("mean_seconds"), F.count_if(stale).alias("stale_running"))


def zero_yield_runs(runs: DataFrame, attempted: Sequence[str], written: Sequence[str], counts: str = "counts") -> DataFrame:
    """Q12s: successful runs that attempted work and wrote nothing, from JSON counters."""
    total = lambda names: sum((F.coalesce(F.get_json_object(counts, f"$.{n}").try_cast("long"), F.lit(0)) for n in names), F.lit(0))
    return runs.filter((F.col("status") == "success") & (total(attempted) > 0) & (total(written) == 0))


# Validation, universes, bookkeeping


def manifest_diff(old: DataFrame, new: DataFrame, *, drift: float = 0.2) -> DataFrame:
    """Q13: tables of two profile runs (table, rows, max_time, warnings array): added, removed, drifted, stalled, new warnings."""
    a = old.select("table", F.col("rows").alias("old_rows"), F.col("max_time").alias("old_time"), F.col("warnings").alias("old_warnings"))
    out = a.join(new, "table", "full")
    change = sdiv(F.col("rows") - F.col("old_rows"), "old_rows")
    kind = F.when(F.col("old_rows").isNull(), "added").when(F.col("rows").isNull(), "removed").when(F.abs(change) > drift, "row_drift").when(F.col("max_time") < F.col("old_time"), "time_back").otherwise("same")
    fresh = F.array_except(F.coalesce("warnings", F.array().cast("array<string>")), F.coalesce("old_warnings", F.array().cast("array<string>")))
    return out.select("table", "old_rows", "rows", kind.alias("kind"), fresh.alias("new_warnings"))


def universe_as_of(snapshots: DataFrame, date: str, as_of: str = "as_of") -> DataFrame:
    """Q16: members of the latest snapshot on or before a date."""
    last = snapshots.filter(F.col(as_of) <= F.to_date(F.lit(date))).agg(F.max(as_of).alias("_last"))
    return snapshots.join(F.broadcast(last), F.col(as_of) == F.col("_last")).drop("_last")


def validate_bars(bars: DataFrame, universe: DataFrame, date: str, keys: PanelKeys = P) -> DataFrame:
    """Q14: of one date: bound and sign violations and universe members without a bar, one row for each finding."""
    day = bars.filter(F.col(keys.date) == F.to_date(F.lit(date)))
    live = ~((F.col("open") == 0) & (F.col("high") == 0) & (F.col("low") == 0))
    issue = F.when((F.col("close") < 0) | (F.col("volume") < 0), "negative").when(live & (F.col("high") < F.col("low")), "high_below_low").when(live & ((F.col("close") > F.col("high")) | (F.col("close") < F.col("low"))), "close_outside")
    found = day.select(keys.entity, issue.alias("issue")).filter("issue is not null")
    missing = universe.select(keys.entity).distinct().join(day.select(keys.entity), keys.entity, "left_anti").withColumn("issue", F.lit("missing_bar"))
    return found.unionByName(missing)


def snapshot_drift(snapshots: DataFrame, pct: float, as_of: str = "as_of") -> DataFrame:
    """Q15: snapshots whose size differs from the one before by more than pct."""
    n = snapshots.groupBy(as_of).agg(F.count("*").alias("size")).withColumn("before", F.lag("size").over(W.orderBy(as_of)))
    return n.withColumn("change", sdiv(F.col("size") - F.col("before"), "before")).filter(F.abs("change") > pct)


def universe_diff(old: DataFrame, new: DataFrame, entity: str = "entity", name: str = "name") -> DataFrame:
    """Q17: new, delisted and renamed entities between two snapshots."""
    a, b = old.select(entity, F.col(name).alias("_old")), new.select(entity, F.col(name).alias("_new"))
    kind = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "delisted").when(F.col("_old") != F.col("_new"), "renamed")
    return a.join(b, entity, "full").select(entity, kind.alias("change")).filter("change is not null")


def recover_delisted(snapshots: DataFrame, master: DataFrame, entity: str = "entity", as_of: str = "as_of", name: str = "name") -> DataFrame:
    """Q18: entities that only snapshots know, with first and last sighting and latest name."""
    seen = snapshots.groupBy(entity).agg(F.min(as_of).alias("first_seen"), F.max(as_of).alias("last_seen"), F.max_by(name, as_of).alias("name"))
    return seen.join(master.select(entity), entity, "left_anti")


def backfill_first_seen(master: DataFrame, snapshots: DataFrame, entity: str = "entity", as_of: str = "as_of") -> DataFrame:
    """Q30: a NULL first_seen from the earliest snapshot, else last_seen."""
    first = snapshots.groupBy(entity).agg(F.min(as_of).alias("_f"))
    return master.join(first, entity, "left").withColumn("first_seen", F.coalesce("first_seen", "_f", "last_seen")).drop("_f")


def incremental_range(df: DataFrame, group: str, date: str, lookback: int = 0) -> DataFrame:
    """Q21: the lagging group's latest date, and where the next pull starts."""
    last = df.groupBy(group).agg(F.max(date).alias("_l"))
    return last.agg(F.min("_l").alias("lagging_date"), F.min_by(group, F.struct("_l", group)).alias("lagging_group")).withColumn("start", F.date_sub("lagging_date", lookback - 1))


def outstanding_windows(df: DataFrame, calendar: DataFrame, by: Sequence[str], date: str, start: str) -> DataFrame:
    """Q22: first session each key still needs: after its last one, or the window's first if there is a hole behind that."""
    days = calendar.select(date).distinct().filter(F.col(date) >= F.to_date(F.lit(start))).withColumn("_i", F.row_number().over(W.orderBy(date)))
    have = df.select(*by, date).distinct().join(days, date).groupBy(*by).agg(F.count("*").alias("have"), F.max("_i").alias("_m"))
    need = have.withColumn("_n", F.when(F.col("have") == F.col("_m"), F.col("_m") + 1).otherwise(F.lit(1)))
    return need.join(days.select(F.col("_i").alias("_n"), F.col(date).alias("needed_from")), "_n", "left").select(*by, "have", (F.col("have") < F.col("_m")).alias("hole"), "needed_from")


def slice_reconcile(ledger: DataFrame, actual: DataFrame, on: Sequence[str], *, now: Column, ttl_days: int) -> DataFrame:
    """Q23: complete, no_data, expired_no_data, half_written or retry, by expected against actual rows.

    ledger: on, expected_rows, checked_at (date); actual: on, rows.
    """
    out = ledger.join(actual, list(on), "left").fillna(0, ["rows"])
    old = F.datediff(now, "checked_at") > ttl_days
    state = F.when((F.col("expected_rows") == 0) & old, "expired_no_data").when(F.col("expected_rows") == 0, "no_data").when(F.col("rows") == F.col("expected_rows"), "complete").when(F.col("rows") > 0, "half_written").otherwise("retry")
    return out.withColumn("state", state)


def short_slices(df: DataFrame, slice_: Sequence[str], group: Sequence[str], share: float = 0.9) -> DataFrame:
    """Q24: slices with fewer rows than a share of their group's median."""
    n = df.groupBy(*dict.fromkeys([*slice_, *group])).agg(F.count("*").alias("rows"))
    return n.withColumn("median", F.percentile("rows", F.lit(0.5)).over(W.partitionBy(*group))).filter(F.col("rows") < share * F.col("median"))


def series_complete(df: DataFrame, calendar: DataFrame, by: Sequence[str], date: str, edge: int = 0) -> DataFrame:
    """Q26: observed against expected days; up to `edge` missing sessions at the ends are tolerated; completeness in bps."""
    days = calendar.select(date).distinct().withColumn("_i", F.row_number().over(W.orderBy(date)))
    total = days.agg(F.count("*").alias("expected"))
    own = df.select(*by, date).distinct().join(days, date).groupBy(*by).agg(F.count("*").alias("observed"), F.min("_i").alias("_a"), F.max("_i").alias("_b"))
    out = own.crossJoin(F.broadcast(total))
    ok = (F.col("_b") - F.col("_a") + 1 == F.col("observed")) & (F.col("_a") <= edge + 1) & (F.col("expected") - F.col("_b") <= edge)
    return out.select(*by, "observed", "expected", F.floor(10000 * sdiv("observed", "expected")).alias("bps"), ok.alias("complete"))


def reports_available(spark, first_year: int, date: str) -> DataFrame:
    """Q29: (year, report) pairs whose statutory due date has passed: quarters 45 days after their end, annual 90."""
    grid = spark.range(1).select(F.explode(F.sequence(F.lit(first_year), F.year(F.to_date(F.lit(date))))).alias("year")).crossJoin(spark.range(1, 5).select(F.col("id").cast("int").alias("q")))
    due = F.date_add(F.last_day(F.make_date("year", F.col("q") * 3, F.lit(1))), F.when(F.col("q") == 4, 90).otherwise(45))
    return grid.withColumn("due", due).filter(F.col("due") <= F.to_date(F.lit(date)))
