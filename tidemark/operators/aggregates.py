"""Aggregations of panels and long facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import sdiv
from tidemark.operators.cross import average_rank, distribution, global_rank, null_safe_join


def dedup_prefer(df: DataFrame, keys: Sequence[str], source: str, priority: Sequence[str], then: Sequence[Column] = ()) -> DataFrame:
    """One row for each key by source priority, then by further order, then by source name: a total order."""
    place = F.coalesce(F.array_position(F.array(*map(F.lit, priority)), F.col(source)), F.lit(0))
    w = W.partitionBy(*keys).orderBy(F.when(place == 0, len(priority) + 1).otherwise(place), *then, source)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def pick_winner(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The values of the least row by a total order; combined map-side, without a sort."""
    return df.groupBy(*keys).agg(F.min(F.struct(*order, *(c for c in values if c not in order))).alias("_b")).select(*keys, *(F.col("_b")[c].alias(c) for c in values))


def pivot_codes(df: DataFrame, keys: Sequence[str], code: str, value: str, codes: Sequence[str]) -> DataFrame:
    """Long to wide for a given list of codes."""
    return df.groupBy(*keys).agg(*(F.max(F.when(F.col(code) == c, F.col(value))).alias(c) for c in codes))


def equal_weight_benchmark(df: DataFrame, x: str, by: Sequence[str], out: str = "benchmark") -> DataFrame:
    """Mean of each cross-section."""
    return df.groupBy(*by).agg(F.avg(x).alias(out))


def filtered_counts(df: DataFrame, by: Sequence[str], conditions: dict[str, Column]) -> DataFrame:
    """Rows, counts of each condition, and their ratios (NULL for no rows)."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(c).alias(f"n_{k}") for k, c in conditions.items()))
    return counts.withColumns({f"{k}_ratio": sdiv(f"n_{k}", "n") for k in conditions})


QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def distribution_stats(df: DataFrame, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, distinct, mean, std, min, max and exact quantiles; no task holds a group's values."""
    return distribution(df, x, QUANTILES, by).withColumnsRenamed({f"_q{i}": f"p{round(q * 100):02d}" for i, q in enumerate(QUANTILES)})


def guarded_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation of pairs as an aggregate; NULL for a constant side, where corr() raises."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_samp(a, b), F.nullif(F.stddev_samp(a) * F.stddev_samp(b), F.lit(0.0)))


def weighted_corr(df: DataFrame, x: str, y: str, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """A07 of rows that stand for `weight` pairs each: n and corr, NULL for a constant side. Sums are of deviations from the mean."""
    a, b, w = F.col(x).cast("double"), F.col(y).cast("double"), F.col(weight)
    flat = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    base = df.groupBy(*by).agg(F.sum(w).alias("_all"), (F.sum(a * w) / F.sum(w)).alias("_mx"), (F.sum(b * w) / F.sum(w)).alias("_my"), flat.alias("_flat"))
    da, db = a - F.col("_mx"), b - F.col("_my")
    sums = null_safe_join(df, base, by).groupBy(*by).agg(F.max("_all").alias("n"), F.bool_or("_flat").alias("_flat"), *(F.sum(p * w).alias(c) for c, p in (("_xx", da * da), ("_yy", db * db), ("_xy", da * db))))
    return sums.select(*by, "n", F.when(~F.col("_flat"), sdiv("_xy", F.sqrt("_xx") * F.sqrt("_yy"))).alias("corr"))


def correlation(df: DataFrame, x: str, y: str, *, by: Sequence[str] = (), method: str = "pearson", min_n: int = 1) -> DataFrame:
    """Correlation of each group with at least min_n pairs.

    Spearman ranks within a group by average rank; without groups the ranks are global and distributed.
    """
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    a, b = x, y
    if method == "spearman":
        if by:
            pairs = pairs.withColumns({"_x": average_rank(x, by), "_y": average_rank(y, by)})
        else:
            for c, r in ((x, "_x"), (y, "_y")):
                pairs = global_rank(pairs, c, "_r").withColumn(r, F.col("_r") + (F.col("_ties") - 1) / 2.0).drop("_r", "_ties")
        a, b = "_x", "_y"
    return pairs.groupBy(*by).agg(F.count("*").alias("n"), guarded_corr(a, b).alias("corr")).filter(F.col("n") >= min_n)


def simple_regression(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept, R2."""
    return df.groupBy(*by).agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def presence_intersection(df: DataFrame, entity: str, flags: dict[str, Column]) -> DataFrame:
    """Whether each entity ever has each flag, then entities for each combination."""
    seen = df.groupBy(entity).agg(*(F.bool_or(c).alias(k) for k, c in flags.items()))
    return seen.groupBy(*flags).agg(F.count("*").alias("entities"))


def market_breadth(panel: DataFrame, by: Sequence[str], change: str, value: str, volume: str) -> DataFrame:
    """A10: advancers, decliners, unchanged, total value and volume."""
    c = F.col(change)
    return panel.groupBy(*by).agg(F.count_if(c > 0).alias("advancers"), F.count_if(c < 0).alias("decliners"), F.count_if(c == 0).alias("unchanged"), F.sum(value).alias("value"), F.sum(volume).alias("volume"))


def coverage_by(df: DataFrame, by: Sequence[str], date: str) -> DataFrame:
    """First and latest date and number of distinct dates of each key."""
    return df.groupBy(*by).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.countDistinct(date).alias("sessions"))


def top_codes_with_span(df: DataFrame, code: str, entity: str, year: Column, n: int = 50) -> DataFrame:
    """The n most frequent codes with rows, entities and first and last year."""
    return df.groupBy(code).agg(F.count("*").alias("rows"), F.countDistinct(entity).alias("entities"), F.min(year).alias("first_year"), F.max(year).alias("last_year")).orderBy(F.desc("rows"), code).limit(n)


def longest_runs(df: DataFrame, code: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The longest run of unchanged values of each code (gaps and islands)."""
    w = W.partitionBy(*code).orderBy(*order)
    changed = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    islands = df.withColumn("_c", changed).withColumn("_i", F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return islands.groupBy(*code, "_i").agg(F.count("*").alias("_n")).groupBy(*code).agg(F.max("_n").alias("longest_run"))
