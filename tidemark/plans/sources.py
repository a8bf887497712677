"""Queries of sources, sinks, parsers and streams; what they write goes to a folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.exprs import rounded
from tidemark.operators import windows as R
from tidemark.plans.core import valid
from tidemark.plans.fixtures import Fixtures
from tidemark.plans.registry import query
from tidemark.lineage import shared_folder
from tidemark.sources import lake as S
from tidemark.sources import parsers as PS
from tidemark.streaming import streams as ST


def scratch(f: Fixtures) -> str:
    """A new folder in the session's shared checkpoint folder."""
    return f"{shared_folder(f.spark)}/{uuid.uuid4().hex}"


@query("s01_scan_snapshot", "SELECT entity, count(*) AS n FROM bars GROUP BY 1", "bars")
def _(f):
    root = scratch(f)
    f.bars.withColumn("part", F.year("date")).write.partitionBy("part").parquet(f"{root}/bars")
    return S.scan_snapshot(f.spark, root, "bars").groupBy("entity").agg(F.count("*").alias("n"))


@query("s02_scan_partitioned", "SELECT CAST(year(date) AS INTEGER) AS part, count(*) AS n FROM bars WHERE year(date) = 1998 GROUP BY 1", "bars")
def _(f):
    root = scratch(f)
    f.bars.withColumn("part", F.year("date")).write.partitionBy("part").parquet(root)
    return S.scan_partitioned(f.spark, root).filter("part = 1998").groupBy("part").agg(F.count("*").alias("n"))


@query("s03_resolve_latest_complete", "SELECT strftime(max(m), '%Y-%m-%d') AS date FROM (SELECT date_trunc('month', l_shipdate) AS m FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linestatus) = 2 AND count(*) > 500)")
def _(f):
    month = F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd")
    rows = f.table("lineitem").groupBy(month.alias("date")).agg(F.collect_set("l_linestatus").alias("tables"), F.count("*").alias("n"))
    return S.resolve_latest_complete(rows.filter("n > 500"), ["O", "F"])


@query("s04_materialize", "SELECT grp, count(*) AS n FROM bars GROUP BY 1", "bars")
def _(f):
    path = f"{scratch(f)}/mart"
    S.materialize(f.bars, path, {"v": 1})
    return S.materialize(f.bars, path, {"v": 1}).groupBy("grp").agg(F.count("*").alias("n"))


@query("s05_open_mart", "SELECT count(*) AS n FROM bars", "bars")
def _(f):
    path = f"{scratch(f)}/mart"
    S.materialize(f.bars, path, {"v": 1})
    return S.open_mart(f.spark, path, expected=S.mart_fingerprint(f.bars, {"v": 1})).agg(F.count("*").alias("n"))


@query("s06_export_partitioned", "SELECT CAST(count(*) AS BIGINT) AS rows FROM orders")
def _(f):
    return S.export_partitioned(f.table("orders"), scratch(f), "month", column="o_orderdate", max_rows=500).agg(F.sum("rows").alias("rows"))


@query("s06_export_parent_month", "SELECT CAST(count(*) AS BIGINT) AS rows FROM lineitem")
def _(f):
    parent = f.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return S.export_partitioned(f.table("lineitem"), scratch(f), "parent_month", column="o_orderdate", parent=parent, on="l_orderkey").agg(F.sum("rows").alias("rows"))


@query("s07_validate_export", "SELECT count(*) AS source_rows, count(*) AS exported_rows, 0 AS lost, 0 AS extra, 0 AS different FROM orders")
def _(f):
    path = scratch(f)
    S.export_partitioned(f.table("orders"), path, "id_range", column="o_orderkey", span=5000)
    return S.validate_export(f.table("orders"), S.scan_snapshot(f.spark, path, ""), ["o_orderkey"])


@query("s08_upsert", "SELECT entity, kind, arg_max(amount, (receipt_date, receipt)) AS amount FROM filings GROUP BY 1, 2", "filings")
def _(f):
    rows = f.filings.select("entity", "kind", "receipt", "receipt_date", "amount")
    out = S.upsert(rows.filter("receipt_date < date '1999-01-01'"), rows.filter("receipt_date >= date '1998-01-01'"), ["entity", "kind"], [F.col("receipt_date"), F.col("receipt")])
    return out.select("entity", "kind", "amount")


@query("s09_insert_if_absent", "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_custkey % 2 = 1")
def _(f):
    c = f.table("customer").select("c_custkey", "c_nationkey")
    return S.insert_if_absent(c.filter("c_custkey % 2 = 0"), c.withColumn("c_nationkey", F.lit(-1)), ["c_custkey"])


@query("s10_incremental_pull", "SELECT o_orderkey FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '2000-01-01', 5000)")
def _(f):
    return S.incremental_pull(f.table("orders"), ("2000-01-01", 5000), ["o_orderdate", "o_orderkey"]).select("o_orderkey")


@query("s11_prune_missing", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def _(f):
    return S.prune_missing(f.table("customer"), f.table("orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey")


@query("s12_table_fingerprint")
def _(f):
    return S.table_fingerprint(f.table("orders"))


#: Columns of the portable fingerprint, in the order of their names, and how each is made text-safe.
PRINTED = {"l_discount": "decimal(18,2)", "l_extendedprice": "decimal(18,2)", "l_linenumber": "bigint", "l_orderkey": "bigint", "l_returnflag": "string", "l_shipdate": "date"}


@query(
    "s12_portable_fingerprint",
    f"""WITH t AS (SELECT {", ".join(f"CAST({c} AS {t.replace('string', 'varchar')})::VARCHAR AS {c}" for c, t in PRINTED.items())} FROM lineitem)
    SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(md5({" || ".join(f"coalesce(length({c}) || ':' || {c}, 'N')" for c in PRINTED)}), 1, 15) AS BIGINT)::HUGEINT) AS VARCHAR) AS hash FROM t""",
)
def _(f):
    return S.table_fingerprint(f.table("lineitem").select(*(F.col(c).cast(t).alias(c) for c, t in PRINTED.items())), portable=True)


@query("s13_write_dataset", "SELECT 'bars' AS name, count(*) AS rows FROM bars UNION ALL SELECT 'valid', count(*) FROM valid", "bars valid")
def _(f):
    return S.write_dataset({"bars": f.bars, "valid": valid(f)}, scratch(f)).select("name", "rows")


@query("s14_write_parquet_csv", "SELECT count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM bars", "bars")
def _(f):
    path = scratch(f)
    S.write_parquet_csv(f.bars, path)
    return f.spark.read.option("header", "true").schema(f.bars.schema).csv(f"{path}/csv").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query("s15_parse_payload_rows", "SELECT receipt, receipt_date AS d, CASE WHEN receipt % 5 = 0 THEN NULL ELSE amount::DOUBLE END AS v FROM filings", "filings")
def _(f):
    shapes = F.when(F.pmod("receipt", F.lit(3)) == 0, "yyyyMMdd")
    d = F.when(shapes.isNotNull(), F.date_format("receipt_date", "yyyyMMdd")).when(F.pmod("receipt", F.lit(3)) == 1, F.date_format("receipt_date", "yyyy-MM-dd")).otherwise(F.date_format("receipt_date", "yyyy.MM.dd"))
    v = F.when(F.pmod("receipt", F.lit(5)) == 0, F.lit("-")).otherwise(F.format_number("amount", 0))
    raw = f.filings.select("receipt", F.to_json(F.struct(F.array(F.struct(d.alias("d"), v.alias("v"))).alias("list"))).alias("payload"))
    return PS.parse_payload_rows(raw, "payload", {"d": "date", "v": "number"})


@query("s16_unpivot_metrics", "SELECT date, entity, 'close' AS metric, round(close, 4) AS value_numeric FROM bars UNION ALL SELECT date, entity, 'volume', volume::DOUBLE FROM bars", "bars")
def _(f):
    return PS.unpivot_metrics(f.bars, ["date", "entity"], ["close", "volume"]).select("date", "entity", "metric", rounded("value_numeric", 4).alias("value_numeric"))


def zipped(f: Fixtures):
    """Small XBRL archives made from suppliers: a (path, content) row for each."""
    import io
    import zipfile

    import pandas as pd

    def pack(batches):
        for pdf in batches:
            out = []
            for key, value in zip(pdf["s_suppkey"], pdf["s_acctbal"], strict=True):
                xml = f'<x:xbrl xmlns:x="http://www.xbrl.org/2003/instance" xmlns:a="urn:a"><x:context id="c1"><x:period><x:instant>2000-12-31</x:instant></x:period></x:context><a:Balance contextRef="c1" unitRef="u">{value}</a:Balance></x:xbrl>'
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w") as z:
                    z.writestr(f"{key}.xbrl", xml)
                out.append((str(key), buffer.getvalue()))
            yield pd.DataFrame(out, columns=["path", "content"])

    return f.table("supplier").select("s_suppkey", "s_acctbal").mapInPandas(pack, "path string, content binary")


@query("s17_extract_xbrl_facts", "SELECT s_suppkey || '.xbrl' AS file, 'Balance' AS concept, '2000-12-31' AS instant, s_acctbal AS value FROM supplier")
def _(f):
    return PS.extract_xbrl_facts(zipped(f)).select("file", "concept", "instant", F.col("value").cast("double").alias("value"))


@query("s18_combine_sparse_feeds", "WITH x AS (SELECT date, entity, metric, sum(value) AS v FROM flows GROUP BY 1, 2, 3) SELECT b.date, b.entity, round(b.v, 4) AS base, round(coalesce(c.v, 0), 4) AS click, round(coalesce(e.v, 0), 4) AS error FROM x b LEFT JOIN x c ON c.metric = 'click' AND c.date = b.date AND c.entity = b.entity LEFT JOIN x e ON e.metric = 'error' AND e.date = b.date AND e.entity = b.entity WHERE b.metric = 'view'", "flows")
def _(f):
    feed = lambda m: f.flows.filter(F.col("metric") == m).groupBy("date", "entity").agg(F.sum("value").alias("value"))
    out = PS.combine_sparse_feeds(feed("view"), {"click": feed("click"), "error": feed("error")}, ["date", "entity"])
    return out.withColumns({c: rounded(c, 4) for c in ("base", "click", "error")})


@query("s19_clip_window", "SELECT entity, date, 'high' AS field, high AS value FROM bars WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' UNION ALL SELECT entity, date, 'low', low FROM bars WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'", "bars")
def _(f):
    return PS.clip_window_with_drift_check(f.bars, ["high", "low"], "date", "1998-01-01", "1998-06-30", ["entity"])


@query(
    "s20_merge_with_retention",
    """SELECT c_custkey AS id, CASE WHEN t THEN c_nationkey ELSE 99 END AS first_seen, CASE WHEN u AND c_custkey % 2 = 0 THEN 'new' WHEN t THEN c_mktsegment END AS listed, CASE WHEN u THEN -1.0 ELSE c_acctbal END AS other
    FROM (SELECT *, c_custkey % 3 <> 0 AS t, c_custkey % 4 <> 1 AS u FROM customer) WHERE t OR u""",
)
def _(f):
    c = f.table("customer")
    target = c.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("first_seen"), F.col("c_mktsegment").alias("listed"), F.col("c_acctbal").alias("other"))
    updates = c.filter("c_custkey % 4 <> 1").select(F.col("c_custkey").alias("id"), F.lit(99).alias("first_seen"), F.when(F.pmod("c_custkey", F.lit(2)) == 0, "new").alias("listed"), F.lit(-1.0).alias("other"))
    return S.merge_with_retention(target, updates, ["id"], keep_old=["first_seen"], new_if_known=["listed"])


@query("s21_parse_period", "SELECT receipt, CASE receipt % 4 WHEN 0 THEN receipt_date WHEN 1 THEN last_day(receipt_date) WHEN 2 THEN last_day(make_date(year(receipt_date), quarter(receipt_date) * 3, 1)) ELSE make_date(year(receipt_date), 12, 31) END AS period_end FROM filings", "filings")
def _(f):
    k = F.pmod("receipt", F.lit(4))
    cycle = F.when(k == 0, "D").when(k == 1, "M").when(k == 2, "Q").otherwise("A")
    text = F.when(k == 0, F.date_format("receipt_date", "yyyyMMdd")).when(k == 1, F.date_format("receipt_date", "yyyyMM")).when(k == 2, F.concat(F.year("receipt_date"), F.lit("Q"), F.quarter("receipt_date"))).otherwise(F.year("receipt_date").cast("string"))
    rows = f.filings.select("receipt", cycle.alias("cycle"), text.alias("text"))
    return rows.select("receipt", PS.parse_period("text", "cycle").alias("period_end"))


def _stream(f: Fixtures):
    path = f"{f.sf_dir}/events.parquet"
    # A file source reads folders: the one file is linked by a glob of its own name.
    rows = f.spark.readStream.schema(f.table("events").schema).parquet(f"{path}*")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query("st1_stream_upsert", "SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2")
def _(f):
    folder = scratch(f)
    stream = _stream(f).select("user_id", "event_type", "event_id", "ts")
    ST.stream_upsert(stream, f"{folder}/table", ["user_id", "event_type"], ["ts", "event_id"], f"{folder}/checkpoint", n_buckets=8).awaitTermination()
    return ST.read_buckets(f.spark, f"{folder}/table").select("user_id", "event_type", "event_id")


def _to_table(f: Fixtures, stream, mode: str):
    """Run a stream over all that is there now, into Parquet."""
    folder = scratch(f)
    q = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return f.spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query("st2_stream_late_vintages", "SELECT DISTINCT event_id FROM events")
def _(f):
    stream = _stream(f)
    twice = stream.select("event_id", "ts", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    return _to_table(f, ST.stream_late_vintages(twice, ["event_id"], event_time="ts", delay="60 days"), "append").select("event_id")


@query(
    "st2_stream_numbered_vintages",
    """WITH v AS (SELECT user_id, event_type, event_id, ts, row_number() OVER w AS vintage, event_id % 3 AS value, lag(event_id % 3) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
    SELECT user_id, event_type, event_id, CAST(vintage AS INTEGER) AS vintage, CASE WHEN vintage = 1 THEN 'original' ELSE 'revision' END AS lineage, vintage > 1 AND value IS DISTINCT FROM before AS changed, CAST(CASE WHEN vintage > 1 THEN vintage - 1 END AS INTEGER) AS supersedes
    FROM v WHERE ts < (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAY FROM events)""",
)
def _(f):
    twice = _stream(f).select("user_id", "event_type", "event_id", "ts", (F.col("event_id") % 3).alias("value"), F.explode(F.array(F.lit(0), F.lit(1)))).drop("col")
    out = ST.stream_numbered_vintages(twice, ["user_id", "event_type"], receipt="event_id", value="value", event_time="ts", delay="2 days")
    return _to_table(f, out, "append").drop("ts", "value")


@query("st3_stream_daily_counts", "SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) - 2 FROM events) GROUP BY 1, 2")
def _(f):
    out = _to_table(f, ST.stream_daily_counts(_stream(f), ["event_type"], event_time="ts"), "append")
    last = f.table("events").agg(F.date_sub(F.to_date(F.max("ts")), 2).alias("last"))
    return out.crossJoin(F.broadcast(last)).filter("date < last").drop("last")


@query("x04_registry_of_checks", "SELECT 'sum' AS agg, count(*) AS n FROM valid UNION ALL SELECT 'max', count(*) FROM valid", "valid")
def _(f):
    v = valid(f)
    rows = [v.select(R.rolling(a, "ret", 5).alias("x")).agg(F.lit(a).alias("agg"), F.count("*").alias("n")) for a in ("sum", "max")]
    return rows[0].unionByName(rows[1])
