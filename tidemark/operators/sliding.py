"""Long frames in one pass: Spark recomputes a sliding frame for every row, n * width steps; these take n or n log width.

Sums, counts and moments are differences of running totals (two lags of one unbounded frame, inside the JVM). Medians and
extremes keep a sorted window or a monotonic queue of each entity's path in a grouped Arrow pass.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import col, sdiv
from tidemark.keys import P, PanelKeys


def frame_sums(df: DataFrame, frames: dict[str, tuple[str | Column, int, int]], keys: PanelKeys = P) -> DataFrame:
    """Adds the sum of each (value, first, last) over the rows first..last before the current one (0: the current row).

    NULL counts as 0, and so does an empty frame; whoever tells them apart adds a count. Values of doubles should be centred:
    a difference of totals keeps the absolute error of the totals.
    """
    path = keys.path()
    upto = path.rowsBetween(W.unboundedPreceding, 0)
    totals = {f"_t_{k}": F.sum(F.coalesce(col(x), F.lit(0))).over(upto) for k, (x, _, _) in frames.items()}
    rows = df.withColumns(totals)
    at = lambda k, n: F.col(f"_t_{k}") if n == 0 else F.coalesce(F.lag(f"_t_{k}", n).over(path), F.lit(0))
    return rows.withColumns({k: at(k, last) - at(k, first + 1) for k, (_, first, last) in frames.items()}).drop(*totals)


def regression(df: DataFrame, y: str, x: str, n: int, keys: PanelKeys = P) -> DataFrame:
    """Slope, intercept and pairs of y on x over the n prior rows, and the current row's residual; NULL below n pairs or where
    x has no spread. Moments are taken around the entity's means, so totals stay small."""
    whole = W.partitionBy(keys.entity, keys.group)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    rows = df.withColumns({"_mx": F.avg(F.when(both, F.col(x))).over(whole), "_my": F.avg(F.when(both, F.col(y))).over(whole)})
    rows = rows.withColumns({"_u": F.when(both, F.col(x) - F.col("_mx")), "_v": F.when(both, F.col(y) - F.col("_my"))})
    rows = frame_sums(rows, {"n_pairs": (both.cast("long"), n, 1), "_su": ("_u", n, 1), "_sv": ("_v", n, 1), "_suu": (F.col("_u") * F.col("_u"), n, 1), "_suv": (F.col("_u") * F.col("_v"), n, 1)}, keys)
    spread = F.col("_suu") - F.col("_su") * F.col("_su") / n
    slope = F.when((F.col("n_pairs") == n) & (spread > 1e-12 * F.col("_suu")), sdiv(F.col("_suv") - F.col("_su") * F.col("_sv") / n, spread))
    rows = rows.withColumn("slope", slope)
    rows = rows.withColumn("intercept", F.col("_my") + F.col("_sv") / n - F.col("slope") * (F.col("_mx") + F.col("_su") / n))
    rows = rows.withColumn("residual", F.col(y) - (F.col("intercept") + F.col("slope") * F.col(x)))
    return rows.drop("_mx", "_my", "_u", "_v", "_su", "_sv", "_suu", "_suv")


def deviation(n: Column, s: Column, ss: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares of centred values; NULL below two."""
    return F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), sdiv(ss - sdiv(s * s, n), n - 1))))


def _medians(values: Sequence, first: int, last: int) -> list[float | None]:
    window: list = []
    out: list[float | None] = []
    for i in range(len(values)):
        if (j := i - last) >= 0 and values[j] is not None:
            insort(window, values[j])
        if (j := i - first - 1) >= 0 and values[j] is not None:
            del window[bisect_left(window, values[j])]
        n = len(window)
        out.append(None if n == 0 else float(window[n // 2]) if n % 2 else (window[n // 2 - 1] + window[n // 2]) / 2)
    return out


def _extremes(values: Sequence, first: int, last: int, sign: int) -> list[float | None]:
    queue: deque[int] = deque()
    out: list[float | None] = []
    for i in range(len(values)):
        if (j := i - last) >= 0 and values[j] is not None:
            while queue and sign * values[queue[-1]] <= sign * values[j]:
                queue.pop()
            queue.append(j)
        while queue and queue[0] < i - first:
            queue.popleft()
        out.append(float(values[queue[0]]) if queue else None)
    return out


KINDS = {"median": _medians, "max": lambda v, a, b: _extremes(v, a, b, 1), "min": lambda v, a, b: _extremes(v, a, b, -1)}


def order_statistics(df: DataFrame, frames: dict[str, tuple[str, str, int, int]], keys: PanelKeys = P) -> DataFrame:
    """Adds (kind, column, first, last) over the rows first..last before the current one, kind median, max or min, as doubles.

    NULLs are left out, and a frame without values gives NULL. One pass over each entity's path, which a task holds.
    """
    schema = T.StructType([*df.schema.fields, *(T.StructField(k, T.DoubleType()) for k in frames)])

    def one_path(table: pa.Table) -> pa.Table:
        table = table.sort_by(keys.date)
        for name, (kind, column, first, last) in frames.items():
            table = table.append_column(name, pa.array(KINDS[kind](table.column(column).to_pylist(), first, last), pa.float64()))
        return table

    return df.groupBy(keys.entity, keys.group).applyInArrow(one_path, schema)
