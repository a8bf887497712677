"""Samples, denominators and verdicts of a scan: who could enter each cell, and all combinations of samples in one pass."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import is_finite, sdiv
from tidemark.keys import P, PanelKeys
from tidemark.operators.replicates import average_ranks


def scan_labels(valid: DataFrame, horizons: Sequence[int], buckets: Sequence[tuple[int, int]], *, holdout: str, formation: int = 120, event: str = "event", keys: PanelKeys = P) -> DataFrame:
    """Excess returns to each horizon and between the ends of each bucket, with end dates and flags.

    A return is NULL where an event lies between its two ends; a bucket (a, b] has only its own events against it. Excess is
    over the group's mean. ok: the label is there and ends before the holdout. common_formation: the market has `formation`
    sessions between the date and the holdout; common_survivor: the entity has them too. One window over the panel, one by
    cross-section; the market's calendar is a table of dates.
    """
    path = keys.path()
    rows = valid.withColumn("_n", F.sum(F.coalesce(F.col(event), F.lit(False)).cast("int")).over(path.rowsBetween(W.unboundedPreceding, 0)))
    at = {h: (F.lead("close", h).over(path), F.lead("_n", h).over(path), F.lead(keys.date, h).over(path)) for h in sorted({*horizons, *(h for ab in buckets for h in ab if h), formation})}
    at[0] = F.col("close"), F.col("_n"), F.col(keys.date)
    spans = {f"cum_{h}": (0, h) for h in horizons} | {f"bkt_{a}_{b}": (a, b) for a, b in buckets}
    rows = rows.withColumns({c: F.when(at[b][1] == at[a][1], sdiv(at[b][0], at[a][0]) - 1) for c, (a, b) in spans.items()} | {f"{c}_end": at[b][2] for c, (_, b) in spans.items()} | {"_end": at[formation][2]})
    cross, limit = W.partitionBy(*keys.cross), F.to_date(F.lit(holdout))
    rows = rows.withColumns({f"{c}_excess": F.col(c) - F.avg(c).over(cross) for c in spans} | {f"{c}_ok": F.coalesce((F.col(f"{c}_end") < limit) & F.col(c).isNotNull(), F.lit(False)) for c in spans})
    days = valid.select(keys.date).distinct().withColumn("common_formation", F.coalesce(F.lead(keys.date, formation).over(W.orderBy(keys.date)) < limit, F.lit(False)))
    rows = rows.join(days, keys.date).withColumn("common_survivor", F.col("common_formation") & F.coalesce(F.col("_end") < limit, F.lit(False)))
    return rows.drop("_n", "_end")


def exclusion_funnel(panel: DataFrame, conditions: Sequence[tuple[str, Column]], *, by: Sequence[str] = ()) -> DataFrame:
    """Rows by the first condition, in order, that they fail; `kept` for none. The counts add up to all rows."""
    first = F.coalesce(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in conditions), F.lit("kept"))
    return panel.groupBy(*by, first.alias("first_failed")).agg(F.count("*").alias("rows"))


def coverage_stats(panel: DataFrame, cells: Sequence[tuple[str, str, str]], formation: Column, *, date: str = "date") -> DataFrame:
    """For each (cell, feature, label flag) the rows in formation, the shares of them with a finite feature and with a valid
    label, and the first and last date. All cells are counted in one pass over the formation rows."""
    rows = panel.filter(F.coalesce(formation, F.lit(False)))
    counts = [F.count("*").alias("n_formation"), F.min(date).alias("sample_start"), F.max(date).alias("sample_end")]
    counts += [F.count_if(is_finite(x)).alias(f"f_{i}") for i, (_, x, _) in enumerate(cells)] + [F.count_if(F.coalesce(F.col(ok), F.lit(False))).alias(f"l_{i}") for i, (_, _, ok) in enumerate(cells)]
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("cell"), F.col(f"f_{i}").alias("f"), F.col(f"l_{i}").alias("l")) for i, (c, _, _) in enumerate(cells))))
    out = rows.agg(*counts).select("n_formation", "sample_start", "sample_end", each.alias("s"))
    return out.select("s.cell", "n_formation", sdiv("s.f", "n_formation").alias("feature_coverage"), sdiv("s.l", "n_formation").alias("label_coverage"), "sample_start", "sample_end")


def scan_combinations(panel: DataFrame, cells: Sequence[tuple[str, str, str, str]], samples: dict[str, Column], *, min_names: int = 5, keys: PanelKeys = P) -> DataFrame:
    """(cell, sample, date, n, ic) of every (cell, feature, target, label flag) in every sample, in one pass.

    A row's memberships are bits of one number, so rows are shuffled once, by date, whatever the number of samples (of universe,
    survivorship, segment). Ranks are made among the members of a sample with feature, target and label; groups of at least
    min_names are weighted by names. At most 62 samples. NaN counts as missing.
    """
    if len(samples) > 62:
        raise ValueError("at most 62 samples fit the bits of a number")
    names = list(samples)
    bit = lambda c, i: F.when(F.coalesce(c, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    member = sum((bit(c, i) for i, c in enumerate(samples.values())), F.lit(0).cast("long"))
    columns = sorted({c for _, x, y, _ in cells for c in (x, y)})
    flags = sorted({ok for *_, ok in cells})
    rows = panel.select(F.col(keys.date).cast("string").alias("date"), F.col(keys.group).cast("string").alias("grp"), member.alias("member"), *(F.col(c).cast("double").alias(c) for c in columns), *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in flags))
    schema = pa.schema([("cell", pa.string()), ("sample", pa.string()), ("date", pa.string()), ("n", pa.int64()), ("ic", pa.float64())])

    def one_date(table: pa.Table) -> pa.Table:
        date, groups = table.column("date")[0].as_py(), np.array(table.column("grp").to_pylist(), object).astype(str)
        values = {c: table.column(c).to_numpy().astype(np.float64) for c in columns}
        valid = {c: table.column(c).to_numpy() for c in flags}
        bits, out = table.column("member").to_numpy(), []
        for cell, x, y, ok in cells:
            there = ~(np.isnan(values[x]) | np.isnan(values[y])) & valid[ok]
            for i, name in enumerate(names):
                inside, weighted, total = there & (bits >> i & 1).astype(bool), 0.0, 0
                for g in np.unique(groups[inside]):
                    mine = inside & (groups == g)
                    if (n := int(mine.sum())) >= min_names:
                        a, b = (average_ranks(values[c][mine]) - (n + 1) / 2 for c in (x, y))
                        if (norm := ((a * a).sum() * (b * b).sum()) ** 0.5) > 0:
                            weighted, total = weighted + (a @ b) / norm * n, total + n
                if total:
                    out.append((cell, name, date, total, weighted / total))
        return pa.table(dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)), schema=schema) if out else schema.empty_table()

    found = rows.groupBy("date").applyInArrow(one_date, "cell string, sample string, date string, n long, ic double")
    return found.withColumn("date", F.to_date("date")).withColumnRenamed("date", keys.date)


def scan_status(daily: DataFrame, cells: Sequence[str], samples: Sequence[str], *, min_dates: int) -> DataFrame:
    """One row for every cell and sample: dates, mean, std and information ratio of its ICs, and evaluated or not, with a reason."""
    spark = daily.sparkSession
    every = spark.createDataFrame([(c, s) for c in cells for s in samples], "cell string, sample string")
    stats = daily.groupBy("cell", "sample").agg(F.count("*").alias("dates"), F.avg("ic").alias("mean"), F.stddev_samp("ic").alias("std"))
    out = every.join(stats, ["cell", "sample"], "left").fillna(0, ["dates"]).withColumn("icir", sdiv("mean", "std"))
    reason = F.when(F.col("dates") == 0, "no_formation_rows").when(F.col("dates") < min_dates, "too_few_dates")
    return out.withColumns({"reason": reason, "status": F.when(reason.isNull(), "evaluated").otherwise("not_evaluated")})


def screen_pass(cells: DataFrame, *, role: str = "role", always: Sequence[str] = (), spike: str = "isolated", optional: Sequence[str] = (), required: dict[str, str] | None = None) -> DataFrame:
    """Failed gates and whether a ready cell passes the screen.

    `always` must be true and `spike` false; `optional` gates count where they aren't NULL; `required` maps a gate to the flag
    that says whether it applies to the cell. Cells of any other role never pass and have no failed gates.
    """
    true = lambda c: F.coalesce(F.col(c), F.lit(False))
    gates = [*(F.when(~true(c), F.lit(c)) for c in always), F.when(true(spike), F.lit(f"{spike}_clear"))]
    gates += [F.when(F.col(c).isNotNull() & ~true(c), F.lit(c)) for c in optional]
    gates += [F.when(true(need) & ~true(c), F.lit(c)) for c, need in (required or {}).items()]
    ready = F.coalesce(F.col(role) == "ready", F.lit(False))
    out = cells.withColumn("failed_gates", F.when(ready, F.array_compact(F.array(*gates))).otherwise(F.array().cast("array<string>")))
    return out.withColumn("screen_pass", ready & (F.size("failed_gates") == 0))
