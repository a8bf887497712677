"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that `[^\x20\x09-\x0D]+` separates words at; bytes.split() and bytes.strip() use the same set.
SPACE = b" \t\n\x0b\x0c\r"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; a temporary one only in a local session without one."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*)?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="checkpoint-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder, so that a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


class Tables:
    """Tables that one run writes into a folder of its own in the shared folder, and takes away when it is done with them.

    Unlike a checkpoint they are compressed, and small files are read together.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.n = spark, 0
        self.folder = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
        self.places: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame, *, instead_of: tuple[DataFrame | None, ...] = ()) -> DataFrame:
        """df, written and read again; tables that it has superseded are deleted."""
        place, self.n = f"{self.folder}/{self.n}", self.n + 1
        df.write.parquet(place)
        out = self.spark.read.schema(df.schema).parquet(place)
        self.places[id(out)] = out, place
        for old in instead_of:
            self.drop(old)
        return out

    def drop(self, df: DataFrame | None) -> None:
        if held := self.places.pop(id(df), None):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(held[1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of a partition that small frames are packed into.
PART_BYTES = 8 << 20


def packed(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """df in no more partitions than so many rows need; a small frame then costs few tasks and no exchange."""
    return df.coalesce(max(1, -(-rows * row_bytes // PART_BYTES)))


def utf8_columns(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding it."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about max_bytes of text (or one row), which bounds what a task holds."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start, held = 0, 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        for i, n in enumerate(lengths):
            held += n
            if held >= max_bytes:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # the worker is used again, by tasks that may need less


def id_text(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Only the id (as a long) and the text, under fixed names: other columns can't clash. keep: columns to carry in a struct `kept`."""
    kept = [F.struct(*(F.col(c) for c in keep)).alias("kept")] if keep else []
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *kept)


def with_kept(ddl: str, docs: DataFrame, keep: tuple[str, ...]) -> T.StructType:
    """A schema, with the struct `kept` if columns are carried."""
    schema = T.StructType.fromDDL(ddl)
    return schema.add("kept", docs.select(*keep).schema) if keep else schema


def record_batch(columns: dict[str, pa.Array], source: pa.RecordBatch) -> pa.RecordBatch:
    """Columns by name, and `kept` of the batch that they were made from, if it has that."""
    if (at := source.schema.get_field_index("kept")) >= 0:
        columns = {**columns, "kept": source.column(at)}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def few_broadcast(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """A narrow table (ids, labels) marked for broadcast if a count finds it small; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer, vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
