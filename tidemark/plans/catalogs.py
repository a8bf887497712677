"""Queries of features and checks that a catalog names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.features import catalog as C
from tidemark.functions.exprs import is_halted, rounded
from tidemark.plans.core import valid
from tidemark.plans.features import HISTORY, macro_history
from tidemark.plans.registry import query

CATALOG = [
    C.Feature("urgent_level", "level", ("1-URGENT",)),
    C.Feature("urgent_week", "ret_5d", ("1-URGENT",)),
    C.Feature("low_week", "ret_5d", ("5-LOW",)),
    C.Feature("high_change", "change_3d", ("2-HIGH",)),
    C.Feature("low_year", "yoy", ("5-LOW",)),
    C.Feature("medium_month", "mom", ("3-MEDIUM",)),
    C.Feature("urgent_low", "spread", ("1-URGENT", "5-LOW")),
    C.Feature("high_low", "ratio", ("2-HIGH", "5-LOW")),
    C.Feature("retired", "level", ("4-NOT SPECIFIED",), active=False),
]


def feature_sql(f: C.Feature) -> str:
    """One catalog row as a query of its own, the naive form."""
    name, _, n = f.transform.partition("_")
    n = int(n.rstrip("d")) if n else 0
    if name in ("spread", "ratio"):
        value = "a.value - b.value" if name == "spread" else "a.value / nullif(b.value, 0)"
        return f"SELECT a.date, '{f.code}' AS feature, {value} AS value, greatest(a.available_from, b.available_from) AS available_from FROM l a LEFT JOIN l b ON a.date = b.date AND b.series = '{f.inputs[1]}' WHERE a.series = '{f.inputs[0]}'"
    if name in ("yoy", "mom"):
        return f"SELECT l.date, '{f.code}', l.value / nullif(m.v, 0) - 1, l.available_from FROM l LEFT JOIN m ON l.date = m.date AND l.series = m.series AND m.m = year(l.obs_date) * 12 + month(l.obs_date) - {12 if name == 'yoy' else 1} WHERE l.series = '{f.inputs[0]}'"
    before = f"lag(value, {n}) OVER (PARTITION BY date ORDER BY obs_date)"
    value = {"level": "value", "ret": f"value / nullif({before}, 0) - 1", "change": f"value - {before}"}[name]
    return f"SELECT date, '{f.code}', v, available_from FROM (SELECT date, obs_date, available_from, {value} AS v, max(obs_date) OVER (PARTITION BY date) AS o FROM h WHERE series = '{f.inputs[0]}') WHERE obs_date = o"


@query(
    "x04_feature_catalog",
    f"""WITH {HISTORY}, l AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY date, series ORDER BY obs_date DESC) = 1), m AS (SELECT date, series, year(obs_date) * 12 + month(obs_date) AS m, max_by(value, obs_date) AS v FROM h GROUP BY 1, 2, 3)
    SELECT date, feature, round(value, 4) + 0.0 AS value, available_from FROM ({" UNION ALL ".join(feature_sql(f) for f in sorted(CATALOG, key=lambda f: f.transform not in ("spread", "ratio")) if f.active)})""",
    "macro",
)
def _(f):
    return C.build_features(macro_history(f), CATALOG).withColumn("value", rounded("value", 4))


#: Domain, name, bad rows and their greatest share. A column needs a session, so each is made when its query runs.
CHECKS = [
    ("bars", "low_above_high", lambda: F.col("low") > F.col("high"), 0.0),
    ("bars", "no_price", lambda: F.col("close") <= 0, 0.0),
    ("bars", "halted", is_halted, 0.2),
    ("valid", "impossible_return", lambda: F.abs("simple") > 0.3, 0.05),
    ("vintages", "known_before_its_end", lambda: F.col("available_from") < F.col("period_end"), 0.0),
    ("vintages", "revised", lambda: F.col("is_revision"), 0.5),
    ("filings", "pending", lambda: F.col("status") == "P", 0.01),
]
#: The same rules as SQL.
CHECK_SQL = ("low > high", "close <= 0", "open = 0 AND high = 0 AND low = 0", "abs(simple) > 0.3", "available_from < period_end", "is_revision", "status = 'P'")


@query(
    "x04_check_catalog",
    " UNION ALL ".join(f"SELECT '{domain}' AS domain, '{name}' AS \"check\", count(*) AS rows, count(*) FILTER ({w}) AS bad, round(count(*) FILTER ({w}) / count(*), 8) AS share, count(*) FILTER ({w}) / count(*) <= {share} AS passed FROM {domain}" for (domain, name, _, share), w in zip(CHECKS, CHECK_SQL, strict=True)),
    "bars valid vintages filings",
)
def _(f):
    checks = [C.Check(domain, name, bad(), share) for domain, name, bad, share in CHECKS]
    return C.run_checks({"bars": f.bars, "valid": valid(f), "vintages": f.vintages, "filings": f.filings}, checks).withColumn("share", rounded("share", 8))
