"""Transforms and checks that catalog rows name: registered once, applied in one pass over what they read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.functions.exprs import sdiv


@dataclass(frozen=True)
class Feature:
    """A catalog row: a code, a registered transform such as 'ret_5d', and the series that it reads in the order of its roles."""

    code: str
    transform: str
    inputs: tuple[str, ...]
    active: bool = True


@dataclass(frozen=True)
class Check:
    """A row-level rule: rows of a domain where `bad` is true fail; passed if their share is at most max_share."""

    domain: str
    name: str
    bad: Column
    max_share: float = 0.0


@dataclass
class Transforms:
    """What catalogs may name.

    single: prefix -> f(value, n, by): a column over one series' history, where `by` makes windows ordered by the period
    ('period') or by calendar month ('month') and n is the number in the code ('ret_5d': 5; without one 0).
    joint: name -> f(values of the inputs in order).
    """

    single: dict[str, Callable[[str, int, Mapping[str, WindowSpec]], Column]] = field(default_factory=dict)
    joint: dict[str, Callable[..., Column]] = field(default_factory=dict)

    def register(self, name: str, *, joint: bool = False) -> Callable:
        def put(f: Callable) -> Callable:
            book = self.joint if joint else self.single
            if name in self.single or name in self.joint:
                raise ValueError(f"transform {name} is registered already")
            book[name] = f
            return f

        return put

    def resolve(self, code: str) -> tuple[Callable, int]:
        """The single-series transform of a code, and its number."""
        name, _, n = code.partition("_")
        if name not in self.single:
            raise ValueError(f"unknown transform {code}; known: {sorted(self.single | self.joint)}")
        return self.single[name], int(n.rstrip("d")) if n else 0


DEFAULT = Transforms()


@DEFAULT.register("level")
def _level(v: str, n: int, by: Mapping[str, WindowSpec]) -> Column:
    return F.col(v)


@DEFAULT.register("ret")
def _ret(v: str, n: int, by: Mapping[str, WindowSpec]) -> Column:
    return sdiv(v, F.lag(v, n).over(by["period"])) - 1


@DEFAULT.register("change")
def _change(v: str, n: int, by: Mapping[str, WindowSpec]) -> Column:
    return F.col(v) - F.lag(v, n).over(by["period"])


@DEFAULT.register("yoy")
def _yoy(v: str, n: int, by: Mapping[str, WindowSpec]) -> Column:
    return sdiv(v, F.max_by(v, "_period").over(by["month"].rangeBetween(-12, -12))) - 1


@DEFAULT.register("mom")
def _mom(v: str, n: int, by: Mapping[str, WindowSpec]) -> Column:
    return sdiv(v, F.max_by(v, "_period").over(by["month"].rangeBetween(-1, -1))) - 1


@DEFAULT.register("spread", joint=True)
def _spread(a: Column, b: Column) -> Column:
    return a - b


@DEFAULT.register("ratio", joint=True)
def _ratio(a: Column, b: Column) -> Column:
    return sdiv(a, b)


def build_features(history: DataFrame, catalog: Sequence[Feature], *, codes: Sequence[str] | None = None, transforms: Transforms = DEFAULT, series: str = "series", period: str = "obs_date", value: str = "value", date: str = "date", known: str = "available_from") -> DataFrame:
    """(date, feature, value, available_from) of all active catalog rows, or those of `codes`.

    history: what each date knew of each series (asof_history). All transforms of single series are columns of one pass
    over it, one shuffle whatever the size of the catalog; those of several series join the newest values and need one
    aggregation more. A feature has a row on each date that knows its first series; a value is NULL where an input is
    missing, and is known when the last of its inputs is. yoy and mom read the last period of the earlier month.
    An unknown transform, a wrong number of inputs or a code used twice is an error. An empty catalog gives no rows.
    """
    rows = [f for f in catalog if f.active and (codes is None or f.code in codes)]
    if len({f.code for f in rows}) < len(rows):
        raise ValueError("a feature code is used twice")
    for f in rows:
        want = transforms.joint[f.transform].__code__.co_argcount if f.transform in transforms.joint else 1
        if len(f.inputs) != want:
            raise ValueError(f"{f.code}: {f.transform} takes {want} inputs")
    single = [f for f in rows if f.transform not in transforms.joint]
    joint = [f for f in rows if f.transform in transforms.joint]
    for f in single:
        transforms.resolve(f.transform)

    names = {t: f"_t{i}" for i, t in enumerate(sorted({f.transform for f in single} | {"level"}))}
    part = W.partitionBy(date, series)
    by = {"period": part.orderBy("_period"), "month": part.orderBy("_month")}
    past = history.select(F.col(date), F.col(series), F.col(known), F.col(value), F.col(period).alias("_period"), (F.year(period) * 12 + F.month(period)).alias("_month"))
    made = {c: f(value, n, by).cast("double") for t, c in names.items() for f, n in [transforms.resolve(t)]}
    newest = past.filter(F.col(series).isin(sorted({s for f in rows for s in f.inputs}))).withColumns(made | {"_last": F.max("_period").over(part)}).filter("_period = _last")

    # Which features a series feeds, as (code, transform or role): catalog-sized literals, exploded for the newest row only.
    def fed(features: Sequence[Feature], what: Callable[[Feature, int], list[Column]]) -> Column:
        entry = lambda f, i, s: F.when(F.col(series) == s, F.struct(F.lit(f.code).alias("feature"), *what(f, i)))
        return F.explode(F.array_compact(F.array(*(entry(f, i, s) for f in features for i, s in enumerate(f.inputs)))))

    out = history.sparkSession.createDataFrame([], newest.select(date, F.lit("").alias("feature"), F.lit(0.0).alias("value"), F.col(known).alias("available_from")).schema)
    if single:
        ones = newest.select(date, F.col(known).alias("available_from"), fed(single, lambda f, i: [F.col(names[f.transform]).alias("value")]).alias("_f"))
        out = out.unionByName(ones.select(date, "_f.feature", "_f.value", "available_from"))
    if joint:
        arity = max(len(f.inputs) for f in joint)
        parts = newest.select(date, F.col(known).alias("_k"), F.col(names["level"]).alias("_v"), fed(joint, lambda f, i: [F.lit(i).alias("role")]).alias("_f")).select(date, "_k", "_v", "_f.*")
        wide = parts.groupBy(date, "feature").agg(F.max("_k").alias("available_from"), F.max(F.col("role") == 0).alias("_first"), *(F.max(F.when(F.col("role") == i, F.col("_v"))).alias(f"_v{i}") for i in range(arity)))
        value_of = F.coalesce(*(F.when(F.col("feature") == f.code, transforms.joint[f.transform](*(F.col(f"_v{i}") for i in range(len(f.inputs))))) for f in joint))
        out = out.unionByName(wide.filter("_first").select(date, "feature", value_of.alias("value"), "available_from"))
    return out


def run_checks(frames: Mapping[str, DataFrame], checks: Sequence[Check], *, domains: Sequence[str] | None = None) -> DataFrame:
    """(domain, check, rows, bad, share, passed) of all checks of the chosen domains; one aggregation for each domain.

    A rule that is NULL for a row doesn't fail it. A domain without rows passes with a NULL share; a check of a domain
    that has no frame is an error, as is a name used twice in a domain.
    """
    wanted = [c for c in checks if domains is None or c.domain in domains]
    if not wanted:
        raise ValueError("no check is chosen")
    if missing := sorted({c.domain for c in wanted} - set(frames)):
        raise ValueError(f"no frame for {missing}")
    if len({(c.domain, c.name) for c in wanted}) < len(wanted):
        raise ValueError("a check is named twice in a domain")
    parts = []
    for domain in dict.fromkeys(c.domain for c in wanted):
        mine = [c for c in wanted if c.domain == domain]
        sums = frames[domain].agg(F.count("*").alias("_n"), *(F.count_if(c.bad).alias(f"_b{i}") for i, c in enumerate(mine)))
        entries = [F.struct(F.lit(c.name).alias("check"), F.col(f"_b{i}").alias("bad"), F.lit(c.max_share).alias("limit")) for i, c in enumerate(mine)]
        parts.append(sums.select("_n", F.explode(F.array(*entries)).alias("_c")).select(F.lit(domain).alias("domain"), "_c.check", F.col("_n").alias("rows"), "_c.bad", sdiv("_c.bad", "_n").alias("share"), "_c.limit"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.coalesce(F.col("share") <= F.col("limit"), F.lit(True))).drop("limit")
