"""Raw responses to typed rows."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import col


def number(text: str | Column) -> Column:
    """Digits with thousands commas; blanks and '-' are NULL."""
    bare = F.regexp_replace(F.trim(col(text)), ",", "")
    return F.when(bare.isin("", "-"), None).otherwise(bare).try_cast("double")


def any_date(text: str | Column) -> Column:
    """yyyyMMdd, yyyy-MM-dd or yyyy.MM.dd; anything else is NULL."""
    t = F.trim(col(text))
    return F.coalesce(*(F.when(t.rlike(p), F.try_to_date(t, f)) for p, f in ((r"^\d{8}$", "yyyyMMdd"), (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{4}\.\d{2}\.\d{2}$", "yyyy.MM.dd"))))


def parse_payload_rows(df: DataFrame, payload: str, fields: dict[str, str]) -> DataFrame:
    """Rows of the response's `list` array; fields: name -> text, number or date. Malformed JSON gives no rows."""
    schema = f"struct<list:array<struct<{','.join(f'`{n}`:string' for n in fields)}>>>"
    rows = df.withColumn("_r", F.explode(F.from_json(payload, schema)["list"]))
    kinds = {"text": lambda c: c, "number": number, "date": any_date}
    return rows.select(*(c for c in df.columns if c != payload), *(kinds[k](F.col("_r")[n]).alias(n) for n, k in fields.items()))


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row for each record and metric column with its text and number."""
    long = df.select(*ids, *(F.col(m).cast("string").alias(m) for m in metrics)).unpivot(list(ids), list(metrics), "metric", "value_text")
    return long.withColumn("value_numeric", number("value_text"))


def combine_sparse_feeds(base: DataFrame, others: dict[str, DataFrame], keys: Sequence[str], value: str = "value") -> DataFrame:
    """The base feed's keys; other feeds joined, missing ones 0; a column for each feed."""
    out = base.withColumnRenamed(value, "base")
    for name, df in others.items():
        summed = df.groupBy(*keys).agg(F.sum(value).alias(name))
        out = out.join(summed, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def clip_window_with_drift_check(df: DataFrame, fields: Sequence[str], date: str, start: str, end: str, ids: Sequence[str]) -> DataFrame:
    """Rows inside the window, unpivoted; fails when no row at all carries any expected field (the format drifted)."""
    seen = df.agg(*(F.count(f).alias(f) for f in fields)).first()
    if df.columns and not any(seen) and not df.isEmpty():
        raise ValueError("no row carries any of the expected fields")
    inside = df.filter(F.col(date).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return inside.select(*ids, date, *fields).unpivot([*ids, date], list(fields), "field", "value").filter("value is not null")


def parse_period(text: str | Column, cycle: str | Column) -> Column:
    """D yyyyMMdd, M yyyyMM, Q yyyyQn, A yyyy to the period's last day; malformed: NULL."""
    t, c = F.trim(col(text)), col(cycle)
    year = F.substring(t, 1, 4).try_cast("int")
    month = F.substring(t, 5, 2).try_cast("int")
    quarter = F.substring(t, 6, 1).try_cast("int")
    end = lambda m: F.last_day(F.make_date(year, m, F.lit(1)))
    return (
        F.when((c == "D") & t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd"))
        .when((c == "M") & t.rlike(r"^\d{4}(0[1-9]|1[0-2])$"), end(month))
        .when((c == "Q") & t.rlike(r"^\d{4}Q[1-4]$"), end(quarter * 3))
        .when((c == "A") & t.rlike(r"^\d{4}$"), end(F.lit(12)))
    )


FACT_SCHEMA = "file string, concept string, context string, unit string, period_start string, period_end string, instant string, dimensions string, value string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def facts_of_instance(name: str, data: bytes) -> Iterator[tuple]:
    """Facts of one XBRL instance: elements with a contextRef, with their context's period and dimensions."""
    root = ET.fromstring(data)
    contexts: dict[str, dict[str, str]] = {}
    for c in root:
        if _local(c.tag) == "context":
            found = {_local(x.tag): (x.text or "").strip() for x in c.iter() if _local(x.tag) in ("startDate", "endDate", "instant")}
            dims = sorted(f"{x.get('dimension')}={(x.text or '').strip()}" for x in c.iter() if _local(x.tag) == "explicitMember")
            contexts[c.get("id", "")] = found | {"dims": ";".join(dims)}
    for e in root:
        if (ref := e.get("contextRef")) is not None:
            c = contexts.get(ref, {})
            yield name, _local(e.tag), ref, e.get("unitRef"), c.get("startDate"), c.get("endDate"), c.get("instant"), c.get("dims"), (e.text or "").strip()


def extract_xbrl_facts(zips: DataFrame) -> DataFrame:
    """One row for each fact of the XML files in ZIP archives (path, content). Broken archives give no rows."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in FACT_SCHEMA.split(", ")]
        for pdf in batches:
            for content in pdf["content"]:
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        rows = [f for n in z.namelist() if n.endswith((".xbrl", ".xml")) for f in facts_of_instance(n, z.read(n))]
                except (zipfile.BadZipFile, ET.ParseError):
                    continue
                yield pd.DataFrame(rows, columns=names)

    return zips.select("content").mapInPandas(extract, FACT_SCHEMA)


def read_zips(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")
