"""Cross-sections: ranks, clips and scores of one (date, group); exact global ranks without a one-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import clip, col, sdiv
from tidemark.keys import P, PanelKeys
from tidemark.lineage import checkpoint


def _ranked(x: str | Column, by: Sequence[str]):
    return W.partitionBy(*by, col(x).isNull()).orderBy(col(x))


def percent_rank(x: str | Column, by: Sequence[str]) -> Column:
    """Percent rank among the non-NULL values of a cross-section; NULL stays NULL."""
    return F.when(col(x).isNotNull(), F.percent_rank().over(_ranked(x, by)))


def average_rank(x: str | Column, by: Sequence[str]) -> Column:
    """Rank from 1 among non-NULL values, where ties share the mean rank."""
    ties = F.count("*").over(W.partitionBy(*by, col(x)))
    return F.when(col(x).isNotNull(), F.rank().over(_ranked(x, by)) + (ties - 1) / 2.0)


def winsorize(df: DataFrame, x: str, lo: float, hi: float, by: Sequence[str], out: str) -> DataFrame:
    """Clip to exact quantiles of the cross-section."""
    w = W.partitionBy(*by)
    return df.withColumn(out, clip(x, F.percentile(x, F.lit(lo)).over(w), F.percentile(x, F.lit(hi)).over(w)))


def zscore(x: str, by: Sequence[str]) -> Column:
    """(x - mean) / std of the cross-section; NULL for no spread."""
    w = W.partitionBy(*by)
    return sdiv(F.col(x) - F.avg(x).over(w), F.stddev_samp(x).over(w))


def tertile_segments(df: DataFrame, x: str, base: Column, *, min_names: int, keys: PanelKeys = P, out: str = "segment") -> DataFrame:
    """1, 2, 3 by cut points that come from the base population only but apply to all rows; NULL with too few names."""
    pop = df.filter(base & F.col(x).isNotNull()).withColumn("_r", average_rank(x, keys.cross)).withColumn("_n", F.count("*").over(W.partitionBy(*keys.cross)))
    cuts = pop.groupBy(*keys.cross).agg(
        F.count("*").alias("_names"),
        F.max(F.when(F.col("_r") / F.col("_n") <= 1 / 3, F.col(x))).alias("_c1"),
        F.max(F.when(F.col("_r") / F.col("_n") <= 2 / 3, F.col(x))).alias("_c2"),
    )
    cut = F.when((F.col("_names") >= min_names) & F.col(x).isNotNull(), F.when(F.col(x) <= F.col("_c1"), 1).when(F.col(x) <= F.col("_c2"), 2).otherwise(3))
    return df.join(cuts, keys.cross, "left").withColumn(out, cut).drop("_names", "_c1", "_c2")


def topk(df: DataFrame, score: str, k: int, keys: PanelKeys = P) -> DataFrame:
    """Per date the k rows of the highest score, with rank and percentile; ties go by entity."""
    w = W.partitionBy(keys.date).orderBy(F.col(score).desc(), keys.entity)
    pct = F.rank().over(W.partitionBy(keys.date).orderBy(score)) / F.count("*").over(W.partitionBy(keys.date))
    return df.filter(F.col(score).isNotNull()).withColumn("pct", pct).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_fraction(df: DataFrame, score: str, q: float, by: Sequence[str]) -> DataFrame:
    """Rows whose average rank / count is at least q."""
    n = F.count(score).over(W.partitionBy(*by))
    return df.withColumn("_p", average_rank(score, by) / n).filter(F.col("_p") >= q).drop("_p")


def global_topn(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of a total order (partial top-n in every task, then merged)."""
    return df.orderBy(*order).limit(n)


def stable_order(df: DataFrame, keys: PanelKeys = P) -> DataFrame:
    """Canonical order at a sink."""
    return df.orderBy(*keys.all)


def _offsets(ranged: DataFrame, rows: Column) -> DataFrame:
    """Rows of all earlier ranges: one row for each range."""
    before = F.sum("_t").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    return ranged.groupBy("_b").agg(rows.alias("_t")).select("_b", F.coalesce(before, F.lit(0)).alias("_off"))


def distinct_ranks(df: DataFrame, x: str) -> DataFrame:
    """Each distinct non-NULL value with its competition rank, its count _n and the range _b that it was dealt to.

    Values are counted first (map-side combined) and dealt by range; each range numbers its own distinct values, and
    range totals, one row for each partition, give the offsets. The ranged frame is checkpointed, so that its
    partitions keep their numbers.
    """
    counts = df.filter(F.col(x).isNotNull()).groupBy(x).agg(F.count("*").alias("_n"))
    ranged = checkpoint(counts.repartitionByRange(x).withColumn("_b", F.spark_partition_id()))
    inside = F.coalesce(F.sum("_n").over(W.partitionBy("_b").orderBy(x).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn("_in", inside).join(_offsets(ranged, F.sum("_n")), "_b").select(x, (F.col("_off") + F.col("_in") + 1).alias("rank"), "_n", "_b")


def global_rank(df: DataFrame, x: str, out: str = "rank") -> DataFrame:
    """Competition rank over all rows without a one-partition window, and the number of equal values as _ties."""
    ranks = distinct_ranks(df, x).select(F.col(x).alias("_value"), F.col("rank").alias(out), F.col("_n").alias("_ties"))
    return df.join(ranks, F.col(x) == F.col("_value"), "left").drop("_value")


def null_safe_join(df: DataFrame, other: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on `by` in which NULL meets NULL; without `by` a cross join."""
    if not by:
        return df.crossJoin(other)
    named = other.withColumnsRenamed({c: f"_o_{c}" for c in by})
    on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in by))
    return df.join(named, on, how).drop(*(f"_o_{c}" for c in by))


def dealt_counts(df: DataFrame, order: Sequence[str], by: Sequence[str], weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct tuples of `order` of each group with their count _n, dealt to ranges _b; and for each group and range the
    rows before it (_off), in it (_t) and in the group (_all). Tuples with a NULL have no place: their _k is 0, that of others _n.

    Rows are counted first (map-side combined), so a group spreads over as many ranges as its distinct tuples fill.
    """
    rows = F.count("*") if weight is None else F.sum(weight)
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in order))
    counts = df.groupBy(*by, *order).agg(rows.alias("_n"))
    dealt = checkpoint(counts.repartitionByRange(*by, *order).withColumn("_b", F.spark_partition_id()))
    dealt = dealt.withColumn("_k", F.when(known, F.col("_n")).otherwise(0))
    w = W.partitionBy(*by)
    before = F.sum("_t").over(w.orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    ranges = dealt.groupBy(*by, "_b").agg(F.sum("_k").alias("_t")).select("*", F.coalesce(before, F.lit(0)).alias("_off"), F.sum("_t").over(w).alias("_all"))
    return dealt, ranges


def placed_counts(dealt: DataFrame, ranges: DataFrame, order: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Tuples with the number of the group's rows before them, _from, and before the next, _to."""
    inside = F.coalesce(F.sum("_k").over(W.partitionBy(*by, "_b").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = null_safe_join(dealt, ranges, [*by, "_b"]).withColumn("_from", F.col("_off") + inside)
    return placed.withColumn("_to", F.col("_from") + F.col("_k"))


def _quantiles(dealt: DataFrame, ranges: DataFrame, x: str, qs: Sequence[float], by: Sequence[str]) -> DataFrame:
    at = [(F.col("_all") - 1) * F.lit(float(q)) for q in qs]
    ends = [(F.floor(p), F.ceil(p)) for p in at]
    holds = reduce(lambda a, b: a | b, ((e >= F.col("_off")) & (e < F.col("_off") + F.col("_t")) for pair in ends for e in pair))
    placed = placed_counts(dealt, ranges.filter(holds), [x], by)
    there = lambda e: F.max(F.when((e >= F.col("_from")) & (e < F.col("_to")), F.col(x).cast("double")))
    found = placed.groupBy(*by).agg(F.max("_all").alias("_all"), *(there(e).alias(f"_{k}{i}") for i, pair in enumerate(ends) for k, e in zip("lh", pair, strict=True)))
    between = lambda i: F.when(F.col(f"_l{i}") == F.col(f"_h{i}"), F.col(f"_l{i}")).otherwise((ends[i][1] - at[i]) * F.col(f"_l{i}") + (at[i] - ends[i][0]) * F.col(f"_h{i}"))
    return found.select(*by, *(between(i).alias(f"_q{i}") for i in range(len(qs))))


def quantiles(df: DataFrame, xs: Sequence[str], qs: Sequence[float], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Exact quantiles (linear between neighbours, as percentile has them) of each column as x_q0, x_q1 ... for each group.

    No task holds a group: distinct values are counted and dealt by range, ranges have offsets, and only the ranges with a
    wanted place are looked into. Groups without a value have no row; without `by` there is one row always. weight: a
    column of counts, if rows stand for several.
    """
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("c"), F.col(x).cast("double").alias("v")) for i, x in enumerate(xs))))
    long = df.select(*by, *([weight] if weight else []), each.alias("_e")).select(*by, *([weight] if weight else []), F.col("_e.c").alias("_c"), F.col("_e.v").alias("_v")).filter("_v is not null")
    found = _quantiles(*dealt_counts(long, ["_v"], [*by, "_c"], weight), "_v", qs, [*by, "_c"])
    return found.groupBy(*by).agg(*(F.max(F.when(F.col("_c") == i, F.col(f"_q{k}"))).alias(f"{x}_q{k}") for i, x in enumerate(xs) for k in range(len(qs))))


def distribution(df: DataFrame, x: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """n, n_distinct, mean, std, min, max of the non-NULL values and quantiles _q0, _q1 ... for each group, all from the counts
    of distinct values, which are made in one pass over the rows."""
    dealt, ranges = dealt_counts(df, [x], by)
    v, k = F.col(x).cast("double"), F.col("_k")
    base = dealt.groupBy(*by).agg(F.coalesce(F.sum("_k"), F.lit(0)).alias("n"), F.count(x).alias("n_distinct"), F.sum(v * k).alias("_s"), F.min(x).alias("min"), F.max(x).alias("max")).withColumn("mean", sdiv("_s", "n"))
    gaps = null_safe_join(dealt, base.select(*by, "mean"), by).groupBy(*by).agg(F.sum((v - F.col("mean")) ** 2 * k).alias("_ss"))
    out = null_safe_join(null_safe_join(base, gaps, by, "left"), _quantiles(dealt, ranges, x, qs, by), by, "left")
    return out.select(*by, "n", "n_distinct", "mean", F.sqrt(sdiv("_ss", F.col("n") - 1)).alias("std"), "min", "max", *(f"_q{i}" for i in range(len(qs))))


def bucket_totals(df: DataFrame, order: Sequence[str], k: int, by: Sequence[str], weight: str | None = None) -> DataFrame:
    """ntile over each group's rows in the order of the columns `order`, added up: by, bucket, n, and mean_c of each column c.

    Equal tuples are counted, not numbered: where a bucket ends among them, the count is split. No task holds a group.
    """
    dealt, ranges = dealt_counts(df, order, by, weight)
    placed = placed_counts(dealt, ranges, order, by).filter("_k > 0")
    size, rest = F.floor(F.col("_all") / k), F.pmod(F.col("_all"), F.lit(k))
    start = lambda i: (i - 1) * size + F.least(i - 1, rest)
    parts = placed.withColumn("bucket", F.explode(F.sequence(F.lit(1), F.lit(k))))
    i = F.col("bucket")
    parts = parts.withColumn("_m", F.least(F.col("_to"), start(i + 1)) - F.greatest(F.col("_from"), start(i))).filter("_m > 0")
    return parts.groupBy(*by, "bucket").agg(F.sum("_m").alias("n"), *((F.sum(F.col(c).cast("double") * F.col("_m")) / F.sum("_m")).alias(f"mean_{c}") for c in order))


def ntile_buckets(df: DataFrame, x: str, k: int, tie: str, out: str = "bucket") -> DataFrame:
    """Ntile over all rows, numbered within ranges of (value, key), so that rows of one value needn't meet in one task."""
    ranged = checkpoint(df.filter(F.col(x).isNotNull()).repartitionByRange(x, tie).withColumn("_b", F.spark_partition_id()))
    total = ranged.agg(F.count("*").alias("_total"))
    place = F.col("_off") + F.row_number().over(W.partitionBy("_b").orderBy(x, tie)) - 1
    placed = ranged.join(_offsets(ranged, F.count("*")), "_b").withColumn("_place", place).crossJoin(F.broadcast(total))
    size, rest = F.floor(F.col("_total") / k), F.pmod(F.col("_total"), F.lit(k))
    big = rest * (size + 1)
    bucket = F.when(F.col("_place") < big, F.floor(F.try_divide(F.col("_place"), size + 1))).otherwise(rest + F.floor(F.try_divide(F.col("_place") - big, size)))
    return placed.withColumn(out, (bucket + 1).cast("int")).drop("_b", "_off", "_place", "_total")
