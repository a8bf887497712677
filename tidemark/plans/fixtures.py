"""The given tables mapped to panel inputs, as DataFrames and, identically, as SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.exprs import rounded


@dataclass(frozen=True)
class Fixtures:
    """Panel inputs over one folder of tables."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def bars(self) -> DataFrame:
        """Daily bars: date, entity, grp, open, high, low, close, volume; halted sessions have no open, high and low."""
        li = self.table("lineitem").select(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("entity"), "l_extendedprice", "l_quantity", "l_linenumber")
        group = self.table("supplier").select(F.col("s_suppkey").alias("entity"), F.when(F.pmod("s_nationkey", F.lit(2)) == 0, "A").otherwise("B").alias("grp"))
        day = li.groupBy("date", "entity").agg(
            rounded(F.sum("l_extendedprice") / F.sum("l_quantity"), 4).alias("close"),
            rounded(F.max(F.col("l_extendedprice") / F.col("l_quantity")), 4).alias("hi"),
            rounded(F.min(F.col("l_extendedprice") / F.col("l_quantity")), 4).alias("lo"),
            F.sum("l_quantity").cast("long").alias("volume"),
            F.sum("l_linenumber").alias("lines"),
        )
        halted = F.pmod(F.col("lines") + F.day("date"), F.lit(20)) == 0
        price = lambda c: F.when(halted, 0.0).otherwise(F.col(c))
        return day.join(group, "entity").select("date", "entity", "grp", price("lo").alias("open"), price("hi").alias("high"), price("lo").alias("low"), "close", "volume")

    @property
    def flows(self) -> DataFrame:
        """Metric flows of two overlapping sources: date, entity, metric, value, source (P preferred, S), event_id."""
        source = F.when(F.pmod("event_id", F.lit(2)) == 0, "P").otherwise("S").alias("source")
        return self.table("events").select(F.to_date("ts").alias("date"), F.col("user_id").alias("entity"), F.col("event_type").alias("metric"), "value", source, "event_id")

    @property
    def filings(self) -> DataFrame:
        """Receipts: receipt, entity, receipt_date, kind, status, amount."""
        n = self.table("supplier").count()
        return self.table("orders").select(
            F.col("o_orderkey").alias("receipt"), F.pmod("o_custkey", F.lit(n)).alias("entity"), F.to_date("o_orderdate").alias("receipt_date"),
            F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("status"), rounded("o_totalprice", 0).cast("long").alias("amount"),
        )

    @property
    def vintages(self) -> DataFrame:
        """Cumulative quarterly facts with revisions: entity, year, q, period_end, available_from, is_revision, value."""
        li = self.table("lineitem").select(F.col("l_suppkey").alias("entity"), F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("q"), "l_extendedprice", "l_returnflag")

        def ytd(rows: DataFrame, revision: bool) -> DataFrame:
            by = rows.groupBy("entity", "year", "q").agg(rounded(F.sum("l_extendedprice"), 2).alias("v"))
            value = rounded(F.sum("v").over(W.partitionBy("entity", "year").orderBy("q")), 2)
            return by.select("entity", "year", "q", value.alias("value"), F.lit(revision).alias("is_revision"))

        both = ytd(li, False).unionByName(ytd(li.filter("l_returnflag = 'R'"), True))
        end = F.last_day(F.make_date("year", F.col("q") * 3, F.lit(1)))
        lag = F.when(F.col("q") == 4, 90).otherwise(45) + F.when(F.col("is_revision"), 60).otherwise(0)
        return both.select("entity", "year", "q", end.alias("period_end"), F.date_add(end, lag).alias("available_from"), "is_revision", "value")

    @property
    def macro(self) -> DataFrame:
        """Bitemporal observations: series, obs_date, vintage, available_from, value."""
        o = self.table("orders").select(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("obs_date"), F.col("o_orderstatus").alias("vintage"), "o_totalprice")
        by = o.groupBy("series", "obs_date", "vintage").agg(rounded(F.sum("o_totalprice"), 2).alias("value"))
        return by.withColumn("available_from", F.date_add("obs_date", 1 + F.pmod(F.day("obs_date"), F.lit(3)) + F.when(F.col("vintage") == "P", 5).otherwise(0)))

    @property
    def snapshots(self) -> DataFrame:
        """Universe snapshots: as_of (month start), entity, name."""
        seen = self.table("lineitem").select(F.trunc("l_shipdate", "month").alias("as_of"), F.col("l_suppkey").alias("entity")).filter("entity % 7 <> month(as_of) % 7").distinct()
        # A name changes in odd years for every fifth entity, so that renames exist.
        return seen.withColumn("name", F.concat(F.lit("N"), F.col("entity"), F.when((F.col("entity") % 5 == 0) & (F.year("as_of") % 2 == 1), "x").otherwise("")))


#: name: (fixtures that it is made from, SQL)
FIXTURE_SQL: dict[str, tuple[str, str]] = {
    "bars": ("", """
SELECT date, d.entity, CASE WHEN s_nationkey % 2 = 0 THEN 'A' ELSE 'B' END AS grp,
       CASE WHEN (lines + day(date)) % 20 = 0 THEN 0.0::DOUBLE ELSE lo END AS open,
       CASE WHEN (lines + day(date)) % 20 = 0 THEN 0.0::DOUBLE ELSE hi END AS high,
       CASE WHEN (lines + day(date)) % 20 = 0 THEN 0.0::DOUBLE ELSE lo END AS low, close, volume
FROM (SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS entity, round(sum(l_extendedprice) / sum(l_quantity), 4) AS close,
             round(max(l_extendedprice / l_quantity), 4) AS hi, round(min(l_extendedprice / l_quantity), 4) AS lo,
             CAST(sum(l_quantity) AS BIGINT) AS volume, sum(l_linenumber) AS lines FROM lineitem GROUP BY 1, 2) d
JOIN supplier ON s_suppkey = d.entity"""),
    "flows": ("", """
SELECT CAST(ts AS DATE) AS date, user_id AS entity, event_type AS metric, value,
       CASE WHEN event_id % 2 = 0 THEN 'P' ELSE 'S' END AS source, event_id FROM events"""),
    "filings": ("", """
SELECT o_orderkey AS receipt, o_custkey % (SELECT count(*) FROM supplier) AS entity, CAST(o_orderdate AS DATE) AS receipt_date,
       o_orderpriority AS kind, o_orderstatus AS status, CAST(round(o_totalprice) AS BIGINT) AS amount FROM orders"""),
    "vintages": ("", """
SELECT entity, year, q, last_day(make_date(year, q * 3, 1)) AS period_end,
       last_day(make_date(year, q * 3, 1)) + CAST(CASE WHEN q = 4 THEN 90 ELSE 45 END + CASE WHEN is_revision THEN 60 ELSE 0 END AS INTEGER) AS available_from,
       is_revision, value
FROM (SELECT entity, year, q, round(sum(v) OVER (PARTITION BY entity, year, is_revision ORDER BY q), 2) AS value, is_revision
      FROM (SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS q,
                   round(sum(l_extendedprice), 2) AS v, false AS is_revision FROM lineitem GROUP BY 1, 2, 3
            UNION ALL
            SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER), CAST(quarter(l_shipdate) AS INTEGER), round(sum(l_extendedprice), 2), true
            FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3))"""),
    "macro": ("", """
SELECT *, obs_date + CAST(1 + day(obs_date) % 3 + CASE WHEN vintage = 'P' THEN 5 ELSE 0 END AS INTEGER) AS available_from
FROM (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS obs_date, o_orderstatus AS vintage, round(sum(o_totalprice), 2) AS value
      FROM orders GROUP BY 1, 2, 3)"""),
    "snapshots": ("", """
SELECT as_of, entity, 'N' || entity || CASE WHEN entity % 5 = 0 AND year(as_of) % 2 = 1 THEN 'x' ELSE '' END AS name
FROM (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS as_of, l_suppkey AS entity FROM lineitem)
WHERE entity % 7 <> month(as_of) % 7"""),
    # Valid sessions with returns: the SQL twin of valid_session_panel.
    "valid": ("bars", """
SELECT *, ln(close / lag_close) AS ret, close / lag_close - 1 AS simple, close * volume AS turnover
FROM (SELECT *, row_number() OVER w AS v_idx, lag(close) OVER w AS lag_close FROM bars
      WHERE NOT (open = 0 AND high = 0 AND low = 0) WINDOW w AS (PARTITION BY entity, grp ORDER BY date))"""),
    "calendar": ("bars", """
SELECT grp, date, CAST(row_number() OVER (PARTITION BY grp ORDER BY date) AS INTEGER) AS d_idx FROM (SELECT DISTINCT grp, date FROM bars)"""),
    "labels5": ("valid", """
SELECT date, entity, grp, fwd, fwd - avg(fwd) OVER (PARTITION BY date, grp) AS excess
FROM (SELECT date, entity, grp, lead(close, 5) OVER (PARTITION BY entity, grp ORDER BY date) / close - 1 AS fwd FROM valid)"""),
    "rev5": ("valid", """
SELECT date, entity, grp, CASE WHEN count(ret) OVER w = 5 THEN -sum(ret) OVER w END AS rev
FROM valid WINDOW w AS (PARTITION BY entity, grp ORDER BY date ROWS 4 PRECEDING)"""),
}
