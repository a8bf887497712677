"""Forward labels of valid sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.exprs import sdiv
from tidemark.keys import P, PanelKeys
from tidemark.operators import cross as C
from tidemark.operators import pit
from tidemark.operators import windows as R
from tidemark.operators.sessions import with_next_session


def forward_labels(valid: DataFrame, horizons: Sequence[int], *, clip: tuple[float, float] = (0.005, 0.995), tails: tuple[float, float] = (0.2, 0.8), keys: PanelKeys = P) -> DataFrame:
    """Per horizon h: fwd_h, excess_h over the group's mean, reg_h (clipped excess), rank_h, cls_h (-1, 0, 1)."""
    rows = valid.withColumns({f"fwd_{h}": sdiv(R.forward_value("close", h, keys), "close") - 1 for h in horizons})
    w = W.partitionBy(*keys.cross)
    rows = rows.withColumns({f"excess_{h}": F.col(f"fwd_{h}") - F.avg(f"fwd_{h}").over(w) for h in horizons})
    for h in horizons:
        rows = C.winsorize(rows, f"excess_{h}", *clip, keys.cross, f"reg_{h}").withColumn(f"rank_{h}", C.percent_rank(f"excess_{h}", keys.cross))
        r = F.col(f"rank_{h}")
        rows = rows.withColumn(f"cls_{h}", F.when(r.isNotNull(), F.when(r <= tails[0], -1).when(r >= tails[1], 1).otherwise(0)))
    return rows.select(*keys.all, *(f"{c}_{h}" for h in horizons for c in ("fwd", "excess", "reg", "rank", "cls")))


def risk_labels(valid: DataFrame, h: int, keys: PanelKeys = P) -> DataFrame:
    """Forward volatility and maximum drawdown."""
    return valid.select(*keys.all, R.forward_vol("ret", h, keys).alias(f"vol_{h}"), R.forward_max_drawdown("simple", h, keys).alias(f"mdd_{h}"))


def label_scan(valid: DataFrame, horizons: Sequence[int], *, event: str = "event", holdout: str | None = None, keys: PanelKeys = P) -> DataFrame:
    """Cumulative returns to each horizon and bucket returns between neighbouring ones ((1+g2)/(1+g1)-1), NULL where
    an event lies inside; excess and rank of each; end date of the last horizon, and whether it lies before the holdout."""
    path = keys.path()
    rows = valid.withColumn("_ev", F.sum(F.coalesce(F.col(event), F.lit(False)).cast("int")).over(path.rowsBetween(W.unboundedPreceding, 0)))
    cum = {}
    for h in horizons:
        clean = F.lead("_ev", h).over(path) == F.col("_ev")
        cum[f"cum_{h}"] = F.when(clean, sdiv(R.forward_value("close", h, keys), "close") - 1)
    rows = rows.withColumns(cum)
    buckets = {f"bkt_{a}_{b}": sdiv(1 + F.col(f"cum_{b}"), 1 + F.col(f"cum_{a}")) - 1 for a, b in zip(horizons, horizons[1:], strict=False)}
    rows = rows.withColumns(buckets)
    w, names = W.partitionBy(*keys.cross), [*cum, *buckets]
    rows = rows.withColumns({f"{c}_excess": F.col(c) - F.avg(c).over(w) for c in names}).withColumns({f"{c}_rank": C.percent_rank(c, keys.cross) for c in names})
    rows = rows.withColumn("label_end", F.lead(keys.date, max(horizons)).over(path))
    rows = rows.withColumn("pre_holdout", F.lit(True) if holdout is None else F.coalesce(F.col("label_end") < F.to_date(F.lit(holdout)), F.lit(False)))
    return rows.select(*keys.all, *names, *(f"{c}_{x}" for c in names for x in ("excess", "rank")), "label_end", "pre_holdout")


def raw_account_pit(panel: DataFrame, facts: DataFrame, calendar: DataFrame, *, accounts: Sequence[str], account: str, receipt_date: str, order: Sequence[str], keys: PanelKeys = P) -> DataFrame:
    """Raw accounts, usable from the first session after their receipt, on the panel."""
    known = with_next_session(facts, calendar, date=receipt_date, out="available_from")
    return pit.pit_interval_join(panel, known, by=[keys.entity], code=account, codes=accounts, date=keys.date, order=order)
