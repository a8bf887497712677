"""Corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, mixing to target weights.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; run() writes each stage's rows as
Parquet in the folder that the session names in spark.checkpoint.dir and reads them again for the next.
An empty table goes through all stages as an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id
from tidemark.llm.common import checkpoint, few_broadcast, load, shared_folder
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import near_duplicates

#: Columns of documents, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Those that go along with the text, which passes through each stage once.
BESIDE = tuple(c for c in COLUMNS if c != "text")
#: Least share of the likelihood of the predicted language.
MIN_LANGUAGE_SCORE = 0.3


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a determined language go on; the model learns from rows with a language.

    Null texts go, as do texts without a letter; rows without id or of equal id are judged one by one.
    """
    found = language_id.identify(docs, language_id.fit(docs), keep=BESIDE)
    return _documents(found.filter((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("kept.*", "text"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds are taken out of the texts; every document stays.

    Rows without id stay as they are; rows of one id are one document.
    """
    out = dedup_lines(docs, keep=("doc_id", "lang", "source"))
    return out.select("kept.doc_id", "text", "kept.lang", "kept.source", F.length("text").cast("long").alias("n_chars"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    Rows of one id stay or go together; rows without id, text or words stay.
    """
    gone = checkpoint(near_duplicates(docs, shingle=4, similarity=80).filter("not kept").select("doc_id").dropDuplicates())
    return _documents(docs.join(few_broadcast(gone), "doc_id", "left_anti"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark items cover too much go; the others stay as they are (nothing is cut from them).

    Null texts stay; rows without id or of equal id are judged one by one.
    """
    found = decontaminate(docs, load(spark, sf_dir, "benchmark"), keep=BESIDE).filter("not contaminated")
    return _documents(found.select("kept.*", F.col("clean_text").alias("text")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; null is a source of its own, null texts have no words."""
    return mix(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: SQL can't express the language model; run() is tested against brute force.
ORACLE_SQL = None
