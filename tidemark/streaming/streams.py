"""Structured Streaming forms of incremental collection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from tidemark.sources.lake import upsert


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream; the checkpoint remembers which have been read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


MANIFEST = "_bucket int, _version long, writer string, batch_id long, n_buckets int, seq long"


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def _latest(manifests: DataFrame | None) -> list:
    """Rows of the newest manifest, one for each bucket that holds rows."""
    last = manifests.agg(F.max("seq")).first()[0] if manifests is not None else None
    return [] if last is None else manifests.filter(F.col("seq") == last).collect()


def _open_buckets(spark: SparkSession, root: str, rows: Sequence) -> DataFrame | None:
    if not rows:
        return None
    paths = [f"{root}/data/_version={r._version}/_bucket={r._bucket}" for r in rows]
    return spark.read.option("basePath", f"{root}/data").parquet(*paths).drop("_version", "_bucket")


def read_buckets(spark: SparkSession, root: str) -> DataFrame | None:
    """ST1: the table that bucketed_upsert keeps below root, as its newest manifest has it; None before the first batch."""
    return _open_buckets(spark, root, _latest(_manifests(spark, root)))


def _swap(spark: SparkSession, root: str, rows: Sequence[tuple], seq: int) -> None:
    """A manifest is one file, so it is there as a whole or not at all."""
    spark.createDataFrame(rows, MANIFEST).drop("seq").coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/seq={seq}")


def bucketed_upsert(root: str, batch: DataFrame, batch_id: int, keys: Sequence[str], order: Sequence[str], *, n_buckets: int = 64, writer: str = "stream") -> list[int]:
    """ST1: upsert a batch into the table below root and rewrite only the buckets (by hash of the keys) that it touches.

    New versions of touched buckets are written beside the old ones; a manifest then names the version of each bucket,
    with the batch's writer and id. A batch that the writer has delivered before changes nothing; a failure before the
    manifest leaves the table as it was, and the batch is written anew when it comes again. The last row of a key by
    order wins, the batch's over the table's on ties; NULL keys are a key of their own; an empty batch writes nothing.
    One writer at a time; a stream with a new checkpoint numbers its batches anew and needs another writer name.
    Versions that no manifest needs stay until their folders are deleted. Only numbers of buckets come to the driver.
    Result: the buckets written.
    """
    spark, manifests = batch.sparkSession, _manifests(batch.sparkSession, root)
    held = _latest(manifests)
    if held and held[0].n_buckets != n_buckets:
        raise ValueError(f"{root} has {held[0].n_buckets} buckets, not {n_buckets}")
    if manifests is not None and not manifests.filter((F.col("writer") == writer) & (F.col("batch_id") >= batch_id)).isEmpty():
        return []
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int").alias("_bucket")
    touched = sorted(r._bucket for r in batch.select(bucket).distinct().collect())
    if not touched:
        return []
    old = _open_buckets(spark, root, [r for r in held if r._bucket in touched])
    merged = upsert(batch.limit(0) if old is None else old, batch, keys, [F.col(c) for c in order])
    seq = held[0].seq + 1 if held else 0
    merged.select("*", bucket).hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{root}/data/_version={seq}")
    versions = {r._bucket: r._version for r in held} | dict.fromkeys(touched, seq)
    _swap(spark, root, [(b, v, writer, batch_id, n_buckets, seq) for b, v in sorted(versions.items())], seq)
    return touched


def stream_upsert(stream: DataFrame, root: str, keys: Sequence[str], order: Sequence[str], checkpoint_dir: str, *, n_buckets: int = 64, writer: str = "stream"):
    """ST1: idempotent upsert of every micro-batch into the table below root, which read_buckets reads: what is written follows
    the batch, not the table (see bucketed_upsert)."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            bucketed_upsert(root, batch, batch_id, keys, order, n_buckets=n_buckets, writer=writer)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()


def stream_late_vintages(stream: DataFrame, keys: Sequence[str], *, event_time: str, delay: str) -> DataFrame:
    """ST2: each (keys) once within the watermark, so that deliveries repeated late aren't new vintages."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_numbered_vintages(stream: DataFrame, keys: Sequence[str], *, receipt: str, value: str, event_time: str, delay: str) -> DataFrame:
    """ST2: vintages of each key as batch D22 numbers them, each once it can't change any more: keys, receipt, value, event
    time, vintage (from 1 by event time, then receipt), lineage (original, revision), changed (its value differs from the
    vintage before), supersedes (the vintage that it replaces).

    A key's state is its last emitted vintage and those that wait for the watermark; a vintage leaves when the watermark is
    beyond its time. Out-of-order rows within the delay are put in order; receipts delivered again (with the same time)
    count once; rows behind the watermark are dropped, as are rows without a time. Of several deliveries of a receipt that
    wait, the first one by time and value counts. The value is kept as text between batches.
    """
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    rows = stream.filter(F.col(event_time).isNotNull()).withWatermark(event_time, delay)
    rows = rows.select(*keys, event_time, F.unix_micros(F.col(event_time).cast("timestamp")).alias("_us"), F.col(receipt).cast("string").alias("_receipt"), F.col(receipt).alias("_order"), F.col(value).cast("string").alias("_value"))
    order = kinds[receipt]
    out = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", _us long, _receipt string, _value string, vintage int, changed boolean"
    held = f"n int, last string, us array<long>, receipts array<string>, places array<{order}>, texts array<string>"

    def number(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, last, *lists = state.get if state.exists else (0, None, [], [], [], [])
        waiting = list(zip(*lists, strict=True))
        if not state.hasTimedOut:
            for f in frames:
                texts = [None if pd.isna(v) else v for v in f["_value"]]
                waiting += zip(f["_us"].tolist(), f["_receipt"].tolist(), f["_order"].tolist(), texts, strict=True)
        waiting.sort(key=lambda r: (r[0], r[2], r[3] is not None, r[3] or ""))
        once: dict[str, tuple] = {}
        for r in waiting:
            once.setdefault(r[1], r)
        now = state.getCurrentWatermarkMs()
        ready = [r for r in once.values() if r[0] < now * 1000]
        waiting = [r for r in once.values() if r[0] >= now * 1000]
        found = []
        for us, name, _, text in ready:
            n += 1
            found.append((*key, us, name, text, n, n > 1 and text != last))
            last = text
        state.update((n, last, *([r[i] for r in waiting] for i in range(4))))
        if waiting:
            state.setTimeoutTimestamp(max(waiting[0][0] // 1000, now))
        if found:
            yield pd.DataFrame(found, columns=[*keys, "_us", "_receipt", "_value", "vintage", "changed"])

    numbered = rows.groupBy(*keys).applyInPandasWithState(number, out, held, "append", "EventTimeTimeout")
    return numbered.select(*keys, F.col("_receipt").cast(order).alias(receipt), F.col("_value").cast(kinds[value]).alias(value), F.timestamp_micros("_us").alias(event_time), "vintage", F.when(F.col("vintage") == 1, "original").otherwise("revision").alias("lineage"), "changed", F.when(F.col("vintage") > 1, F.col("vintage") - 1).alias("supersedes"))


def stream_daily_counts(stream: DataFrame, by: Sequence[str], *, event_time: str, delay: str = "2 days", width: str = "1 day") -> DataFrame:
    """ST3: rows by class in tumbling windows of event time; late rows count until the watermark has passed."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), *by).agg(F.count("*").alias("n")).select(F.to_date("window.start").alias("date"), *by, "n")
