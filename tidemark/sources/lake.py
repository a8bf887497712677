"""Snapshots, marts, exports and upserts of Parquet tables. Paths may be any that Spark reads."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def scan_snapshot(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All Parquet files below root/table; path segments k=v don't override data columns."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/{table}")


def scan_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """As a partitioned table: path segments become columns, and filters on them prune files."""
    return spark.read.option("basePath", root).parquet(root)


def resolve_latest_complete(markers: DataFrame, required: Sequence[str]) -> DataFrame:
    """Newest snapshot (date, tables array) whose marker lists all required tables."""
    need = F.array(*map(F.lit, required))
    return markers.filter(F.size(F.array_except(need, "tables")) == 0).agg(F.max("date").alias("date"))


def read_markers(spark: SparkSession, pattern: str) -> DataFrame:
    """Completion markers, one JSON object a file: date, tables."""
    return spark.read.schema("date string, tables array<string>").option("multiLine", "true").json(pattern)


def mart_fingerprint(df: DataFrame, config: dict) -> str:
    """Hash of configuration and schema."""
    return hashlib.sha256(json.dumps([config, df.schema.jsonValue()], sort_keys=True).encode()).hexdigest()


def materialize(df: DataFrame, path: str, config: dict, *, force: bool = False, partition_by: Sequence[str] = ()) -> DataFrame:
    """Cached mart: an existing one is reused if its fingerprint matches, refused if not, rewritten when forced."""
    spark, meta, own = df.sparkSession, f"{path}.meta", mart_fingerprint(df, config)
    if not force:
        try:
            held = spark.read.text(meta).first()[0]
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        else:
            if held != own:
                raise ValueError(f"{path} was made with another configuration or schema; force a rebuild")
            return spark.read.parquet(path)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    spark.createDataFrame([(own,)], "value string").coalesce(1).write.mode("overwrite").text(meta)
    return spark.read.parquet(path)


def open_mart(spark: SparkSession, path: str, view: str | None = None, expected: str | None = None) -> DataFrame:
    """Read a mart back, refusing one of another fingerprint."""
    if expected is not None and spark.read.text(f"{path}.meta").first()[0] != expected:
        raise ValueError(f"{path} has another fingerprint")
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def export_partitioned(df: DataFrame, path: str, layout: str, *, column: str | None = None, span: int = 1_000_000, max_rows: int = 1_000_000, parent: DataFrame | None = None, on: str | None = None) -> DataFrame:
    """Layouts id_range, month, full, and parent_month (rows routed by their parent's date); a manifest of rows by file.

    A file never has more than max_rows rows.
    """
    if layout == "id_range":
        df, parts = df.withColumn("id_range", F.floor(F.col(column) / span)), ["id_range"]
    elif layout == "month":
        df, parts = df.withColumns({"year": F.year(column), "month": F.month(column)}), ["year", "month"]
    elif layout == "parent_month":
        p = parent.select(on, F.year(column).alias("year"), F.month(column).alias("month"))
        df, parts = df.join(p, on, "left"), ["year", "month"]
    else:
        parts = []
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_rows)
    (writer.partitionBy(*parts) if parts else writer).parquet(path)
    return manifest(df.sparkSession, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each file."""
    files = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return files.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"))


def validate_export(source: DataFrame, exported: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both, keys on one side only, and rows of shared keys that differ in any shared column."""
    cols = [c for c in source.columns if c in exported.columns and c not in keys]
    a = source.select(*keys, F.struct(*cols).alias("_a"))
    b = exported.select(*keys, F.struct(*cols).alias("_b"))
    both = a.join(b, list(keys), "full")
    return both.agg(F.count("_a").alias("source_rows"), F.count("_b").alias("exported_rows"), F.count_if(F.col("_b").isNull()).alias("lost"), F.count_if(F.col("_a").isNull()).alias("extra"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("_a").eqNullSafe(F.col("_b"))).alias("different"))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Insert or replace by natural key; of several rows the last by order wins, updates over target on ties."""
    both = target.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = W.partitionBy(*keys).orderBy(*(c.desc() for c in order), F.desc("_new"))
    return both.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_new")


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Conflicts keep the old row."""
    return target.unionByName(rows.dropDuplicates(list(keys)).join(target, list(keys), "left_anti"))


def incremental_pull(source: DataFrame, cursor: tuple | None, columns: Sequence[str]) -> DataFrame:
    """Rows whose cursor tuple is greater than the last one; a tuple loses no ties at a batch's edge."""
    if cursor is None:
        return source
    return source.filter(F.struct(*columns) > F.struct(*(F.lit(v).cast(dict(source.dtypes)[c]).alias(c) for c, v in zip(columns, cursor, strict=True))))


def next_cursor(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The greatest cursor tuple."""
    return rows.agg(F.max(F.struct(*columns)).alias("_c")).select("_c.*")


def prune_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the full source still has."""
    return target.join(source.select(*keys), list(keys), "left_semi")


def table_fingerprint(df: DataFrame, *, portable: bool = False) -> DataFrame:
    """Rows and a content hash that row order doesn't change; partial sums are exact decimals.

    portable: a hash that other engines can repeat: of each row the first 60 bits of the md5 of its columns in the order
    of their names, each as '<characters>:<text>', NULL as 'N'. Floating and nested columns print differently from engine
    to engine, so they are an error there: cast them to decimals or text first. An empty table has a NULL hash.
    """
    if portable:
        if odd := [c for c, t in df.dtypes if t in ("float", "double", "binary", "timestamp") or t.startswith(("array", "map", "struct"))]:
            raise ValueError(f"no portable text for {odd}")
        text = lambda c: F.col(c).cast("string")
        parts = [F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("N")) for c in sorted(df.columns)]
        row = F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 15), 16, 10)
    else:
        row = F.xxhash64(*(F.col(c) for c in sorted(df.columns)))
    return df.agg(F.count("*").alias("rows"), F.sum(row.cast("decimal(38,0)")).cast("string").alias("hash"))


def write_dataset(frames: dict[str, DataFrame], root: str) -> DataFrame:
    """Named frames as Parquet, and one lineage row for each: name, rows, schema."""
    rows = []
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        back = df.sparkSession.read.parquet(f"{root}/{name}")
        rows.append(back.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.lit(back.schema.simpleString()).alias("schema")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def write_parquet_csv(df: DataFrame, path: str) -> None:
    """One result in both formats."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.write.mode("overwrite").option("header", "true").csv(f"{path}/csv")


def merge_with_retention(target: DataFrame, updates: DataFrame, keys: Sequence[str], *, keep_old: Sequence[str] = (), new_if_known: Sequence[str] = ()) -> DataFrame:
    """Upsert in which keep_old columns keep the old value, new_if_known take a new one only if it isn't NULL, and
    the others take the new row's value."""
    others = [c for c in target.columns if c not in keys]
    a = target.select(*keys, F.struct(*others).alias("_a"))
    b = updates.select(*keys, F.struct(*others).alias("_b"))

    def pick(c: str) -> Column:
        old, new = F.col("_a")[c], F.col("_b")[c]
        if c in keep_old:
            return F.coalesce(old, new)
        if c in new_if_known:
            return F.coalesce(new, old)
        return F.when(F.col("_b").isNotNull(), new).otherwise(old)

    return a.join(b, list(keys), "full").select(*keys, *(pick(c).alias(c) for c in others))
