"""Cutting lineage where a frame is read more than once."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; a temporary one only in a local session without one."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*)?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="checkpoint-")


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder that the session names in spark.checkpoint.dir; a temporary one only in a local session without one."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
