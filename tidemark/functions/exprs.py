"""Scalar building blocks; every division is guarded, as ANSI mode raises on zero."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sdiv(a: str | Column, b: str | Column) -> Column:
    """a / b as doubles; NULL for a zero or NULL denominator."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def safe_ln(x: str | Column) -> Column:
    return F.when(col(x) > 0, F.ln(col(x)))


def rounded(x: str | Column, digits: int = 6) -> Column:
    """Rounded half up in double arithmetic, without a negative zero; the argument is evaluated once."""
    scale = float(10**digits)
    return F.floor(col(x).cast("double") * scale + 0.5) / scale + F.lit(0.0)


def is_halted(open_: str = "open", high: str = "high", low: str = "low") -> Column:
    """a halted session has no open, high or low."""
    return (F.col(open_) == 0) & (F.col(high) == 0) & (F.col(low) == 0)


def receipt_date(receipt: str | Column) -> Column:
    """the date in front of a 14-digit receipt number; NULL for malformed ones."""
    c = col(receipt).cast("string")
    return F.when(c.rlike(r"^\d{14}$"), F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd"))


def classify(reason: str | Column, catalog: dict[str, str], other: str = "unclassified") -> Column:
    """exact-match class of a reason, with an explicit class for what the catalog lacks."""
    table = F.create_map(*(F.lit(x) for kv in catalog.items() for x in kv))
    return F.coalesce(F.try_element_at(table, col(reason)), F.lit(other))


def flag_by_markers(text: str | Column, markers: Sequence[str]) -> Column:
    """whether the text contains any marker; NULL text: false."""
    found = F.lit(False)
    for m in markers:
        found = found | F.coalesce(col(text).contains(m), F.lit(False))
    return found


def contains_all_without_space(text: str | Column, markers: Sequence[str]) -> Column:
    """whether the text without white space contains all markers."""
    bare, found = F.regexp_replace(col(text), r"\s+", ""), F.lit(True)
    for m in markers:
        found = found & bare.contains(m)
    return F.coalesce(found, F.lit(False))


def regime_of(date: str | Column, intervals: Sequence[tuple[str | None, str | None, str]]) -> Column:
    """label of the first interval [start, end) that holds the date; None: open end."""
    out = None
    for start, end, label in intervals:
        inside = (F.lit(True) if start is None else col(date) >= F.to_date(F.lit(start))) & (F.lit(True) if end is None else col(date) < F.to_date(F.lit(end)))
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def is_finite(x: str | Column) -> Column:
    return col(x).isNotNull() & ~F.isnan(col(x).cast("double")) & (F.abs(col(x).cast("double")) < F.lit(float("inf")))


def finite_rows(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """rows in which all columns are finite numbers."""
    for c in cols:
        df = df.filter(is_finite(c))
    return df


def formation_filter(
    panel: DataFrame, *, feature: str, targets: Sequence[str], label_ok: str, universe: str, start: str, event: str = "event", sample: str = "available", common: Sequence[str] = (), where: str | Column | None = None, keys: Sequence[str] = ("date", "entity", "grp")
) -> DataFrame:
    """rows that may enter a scan cell: from `start` on, in the universe, without event, feature finite, label valid.

    sample: `available` asks for this label only, `common_survivor` for all flags in `common` as well. where: a further
    condition (a group, a size segment, a period). Returns keys, feature_value and targets.
    """
    if sample not in ("available", "common_survivor"):
        raise ValueError(f"unknown sample {sample!r}")
    flags = [universe, label_ok, *(common if sample == "common_survivor" else ())]
    rows = finite_rows(panel.filter(F.col(keys[0]) >= F.to_date(F.lit(start))), [feature]).filter(~F.coalesce(F.col(event), F.lit(False)))
    for flag in flags:
        rows = rows.filter(flag)
    rows = rows if where is None else rows.filter(where)
    return rows.select(*keys, F.col(feature).alias("feature_value"), *targets)


def sample_policy(df: DataFrame, share: float, threshold: int, seed: int = 7) -> DataFrame:
    """all rows up to the threshold, beyond it a repeatable sample of about that share; the count stops at the threshold."""
    return df.sample(share, seed=seed) if df.limit(threshold + 1).count() > threshold else df


def select_features(df: DataFrame, drop: Iterable[str], prefixes: Sequence[str] = (), pinned: Sequence[str] | None = None) -> list[str]:
    """numeric and boolean columns without keys, labels and helpers; a pinned list overrides."""
    if pinned is not None:
        return [c for c in pinned if c in df.columns]
    gone = set(drop)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in gone and not f.name.startswith(tuple(prefixes) or ("\0",))]


def signed_log(x: str | Column) -> Column:
    return F.signum(col(x)) * F.log1p(F.abs(col(x)))


def clip(x: str | Column, lo: str | Column, hi: str | Column) -> Column:
    """Clipped value; NULL stays NULL, though greatest and least skip NULL."""
    return F.when(col(x).isNotNull(), F.least(F.greatest(col(x), col(lo)), col(hi)))


def complete(x: str | Column, value: Column, w: WindowSpec, n: int) -> Column:
    """The windowed value where the window holds n values of x; else NULL."""
    return F.when(F.count(col(x)).over(w) == n, value)


def draw(seed: str, *cols: str) -> Column:
    """A number below 2^48 from a digest of the seed and columns, the same in every run and engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *cols)), 1, 12), 16, 10).cast("long")
