"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets, epochs.

Each row gets a hash-random key; rows of a source are ordered by (key, id). The order is cut into key ranges (buckets)
whose word totals are summed with map-side combination; running totals over a source's buckets find the one bucket in
which its budget ends, and only that bucket's rows are ordered. So a source with a third of all rows is never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words to mix, as a share of all words, and the most that a source gives, in times its own size.
SHARE, MAX_EPOCHS = 1.5, 2
#: Hex digits of the key that name a bucket: 16^3 key ranges for each source.
BUCKET_DIGITS = 3


def n_words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+`; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> also target: weighted shares of share * all words, none above max_epochs * its size.

    Excess is shared again by weight until none is above; that fixed point is min(level * weight, cap) with one level
    for all sources, found over the sources ordered by cap / weight. If the sources before one are at their caps and the
    rest share by weight, the level rises from source to source while it is above cap / weight and falls from the first
    source on where it isn't: that first one, the greatest of these levels, is the fixed point.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    caps = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", (F.lit(max_epochs) * F.col("source_size")).cast("double"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = caps.select(
        "*",
        (F.col("cap") / F.col("weight")).alias("ratio"),
        F.sum("source_size").over(everything).alias("all_words"),
        F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)).alias("open_weight"),
    ).withColumn("level", (F.lit(float(share)) * F.col("all_words") - F.col("capped")) / F.col("open_weight"))
    found = levels.withColumn("found", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    # Without such a level (share above max_epochs) every source gives all it may.
    return found.select("source", "source_size", F.least(F.coalesce(F.col("found") * F.col("weight"), F.col("cap")), "cap").alias("target"))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "mix",
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each row.

    taken: whole epochs give each row its size; in the last epoch rows are taken in random order until the source's
    budget floor(target) is spent, the row at the cut only as many words as remain. Rows without words take 0. Null is
    a source of its own; rows of equal id are ordered by size, so that repeated rows have a defined result too. An
    empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col).cast("string")).alias("size"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = checkpoint(rows.withColumn("key", key).withColumn("bucket", F.substring("key", 1, bucket_digits)))
    buckets = checkpoint(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights=weights, share=share, max_epochs=max_epochs)
    budget = F.floor("target").cast("long")
    epochs = F.coalesce(F.try_divide(budget, "source_size").cast("long"), F.lit(0).cast("long"))
    targets = targets.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    running = F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
    targets = targets.withColumnRenamed("source", "of")
    upto = buckets.withColumn("upto", running).join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    inside = (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest"))
    # One row for each source: the bucket in which its budget ends and what remains there; none: it ends on an edge.
    cuts = upto.groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("epochs").alias("epochs"),
        F.max(F.when(F.col("upto") <= F.col("rest"), F.col("bucket"))).alias("last_full"),
        F.max(F.when(inside, F.col("bucket"))).alias("cut"),
        F.max(F.when(inside, F.col("rest") - F.col("upto") + F.col("words"))).alias("remains"),
    ).withColumnRenamed("source", "of")
    placed = rows.join(cuts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    full = F.when(F.col("bucket") <= F.col("last_full"), F.col("size")).otherwise(0)
    outside = placed.filter("cut is null or bucket <> cut").withColumn("extra", full.cast("long"))
    before = F.sum("size").over(W.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
    ordered = placed.filter("bucket = cut").withColumn("before", before)
    ordered = ordered.withColumn("extra", F.greatest(F.lit(0).cast("long"), F.least("size", F.col("remains") - F.col("before")))).drop("before")
    taken = F.col("epochs") * F.col("size") + F.col("extra")
    return outside.unionByName(ordered).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
