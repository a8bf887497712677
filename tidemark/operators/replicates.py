"""Replicates of an inference as arrays: a panel is shuffled once, whatever the number of replicates.

Permutations: one task has a date's cross-sections; ranks are made once, a matrix of draws gives all permutations, and a
matrix product all rank ICs. Placebo: cross-sections are packed, blocks of them meet in pairs, and a pair serves every shift
that maps one to the other. Bootstrap: clusters have counts in place of copies, and ranks and moments take them as weights.

Draws are digests of (seed, replicate, key), so runs repeat exactly and SQL can repeat them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import draw
from tidemark.keys import P, PanelKeys
from tidemark.lineage import checkpoint
from tidemark.operators.cross import dealt_counts, distinct_ranks, null_safe_join, placed_counts

#: Numbers that one block of replicates holds in a task.
HELD = 4_000_000
#: Bytes of draws that are sent to every task at once; the events of a cohort have twice as many at most.
SENT = 32_000_000
#: Rows of ids that are sent to every task; more are joined by a shuffle.
BROADCAST = 2_000_000
#: Draws that one digest gives.
PER_DIGEST = 8


def average_ranks(v: np.ndarray) -> np.ndarray:
    """Ranks from 1; equal values share the mean rank."""
    _, at, count = np.unique(v, return_inverse=True, return_counts=True)
    return (np.cumsum(count) - (count - 1) / 2)[at]


def digest_draws(seed: str, first: int, n: int, keys: Sequence[str]) -> np.ndarray:
    """(n, keys): 32-bit draws of replicates first .. first + n - 1, eight from one sha256 of `seed|replicate div 8|key`."""
    blocks = range(first // PER_DIGEST, -(-(first + n) // PER_DIGEST))
    raw = b"".join(hashlib.sha256(f"{seed}|{b}|{k}".encode()).digest() for k in keys for b in blocks)
    every = np.frombuffer(raw, ">u4").reshape(len(keys), len(blocks) * PER_DIGEST)
    return every[:, first - blocks[0] * PER_DIGEST :][:, :n].T.astype(np.int64)


def draw_orders(draws: np.ndarray) -> np.ndarray:
    """For each row of 32-bit draws the columns in the order of their draws, then of their place: one sort of both as one number."""
    return (np.sort(draws << 31 | np.arange(draws.shape[1]), axis=1) & ((1 << 31) - 1)).astype(np.int32)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.float64)


def _by_group(table: pa.Table, group: str) -> Iterator[np.ndarray]:
    values = table.column(group).to_pylist()
    for g in sorted(set(values), key=repr):
        yield np.array([i for i, v in enumerate(values) if v == g])


def permutation_null(panel: DataFrame, cells: Sequence[tuple[str, str, str]], n: int, *, seed: str, min_names: int = 5, keys: PanelKeys = P) -> DataFrame:
    """(cell, date, n, ics): for each (cell, feature, target) the rank ICs of a date under n permutations of the feature.

    Within each (date, group) the rows with feature and target, in entity order, take the features in the order of the draws of
    (replicate, date, entity), the same for all cells; ICs of groups with at least min_names are weighted by names. NaN counts
    as missing. One shuffle, by date; a task holds a date's cross-sections and a bounded block of replicates.
    """
    columns = sorted({c for _, x, y in cells for c in (x, y)})
    rows = panel.select(F.col(keys.date).cast("string").alias("date"), F.col(keys.entity).alias("entity"), F.col(keys.group).alias("grp"), *(F.col(c).cast("double").alias(c) for c in columns))

    def one_date(table: pa.Table) -> pa.Table:
        table = table.sort_by([("grp", "ascending"), ("entity", "ascending")])
        date, entities = table.column("date")[0].as_py(), table.column("entity").to_pylist()
        values = {c: _numbers(table, c) for c in columns}
        total, names = {c: np.zeros(n) for c, _, _ in cells}, dict.fromkeys((c for c, _, _ in cells), 0)
        for at in _by_group(table, "grp"):
            prepared = []
            for cell, x, y in cells:
                there = ~(np.isnan(values[x][at]) | np.isnan(values[y][at]))
                if there.sum() >= min_names:
                    a, b = (average_ranks(values[c][at][there]) for c in (x, y))
                    a, b = a - a.mean(), b - b.mean()
                    if (norm := np.sqrt((a * a).sum() * (b * b).sum())) > 0:
                        prepared.append((cell, there, a, b / norm))
                        names[cell] += int(there.sum())
            size = max(PER_DIGEST, HELD // max(1, len(at)) // PER_DIGEST * PER_DIGEST)
            for first in range(0, n if prepared else 0, size):
                many = min(size, n - first)
                draws = digest_draws(seed, first, many, [f"{date}|{entities[i]}" for i in at])
                order = draw_orders(draws)
                orders: dict[bytes, np.ndarray] = {}  # one sort for all cells; cells with the same rows share their part of it
                for cell, there, a, b in prepared:
                    if (own := orders.get(there.tobytes())) is None:
                        orders[there.tobytes()] = own = order if there.all() else order[there[order]].reshape(many, -1)
                    full = np.zeros(len(at))
                    full[there] = a
                    total[cell][first : first + many] += (full[own] @ b) * there.sum()
        known = [c for c, _, _ in cells if names[c]]
        return pa.table({"cell": known, "date": [date] * len(known), "n": pa.array([names[c] for c in known], pa.int64()), "ics": pa.array([(total[c] / names[c]).tolist() for c in known], pa.list_(pa.float64()))}, schema=pa.schema([("cell", pa.string()), ("date", pa.string()), ("n", pa.int64()), ("ics", pa.list_(pa.float64()))]))

    out = rows.groupBy("date").applyInArrow(one_date, "cell string, date string, n long, ics array<double>")
    return out.withColumn("date", F.to_date("date")).withColumnRenamed("date", keys.date)


def replicate_newey_west(daily: DataFrame, lag: int, *, idx: str = "d_idx", chunk: int = 128) -> DataFrame:
    """(cell, rep, nw_t) of (cell, idx, ics): the HAC t of each replicate's series, as newey_west has it.

    Arrays are cut into chunks of replicates, so a task holds sessions * chunk numbers.
    """
    firsts = F.sequence(F.lit(0), F.size("ics") - 1, F.lit(chunk))
    cut = daily.select("cell", F.col(idx).cast("long").alias("i"), "ics", F.explode(firsts).alias("first")).select("cell", "first", "i", F.slice("ics", F.col("first") + 1, F.lit(chunk)).alias("ics"))

    def one_series(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        i = table.column("i").to_numpy()
        ics = np.array(table.column("ics").to_pylist())
        mean = ics.mean(0)
        d = ics - mean
        var = (d * d).sum(0)
        for k in range(1, min(lag, len(i) - 1) + 1):  # sessions are distinct: pairs within the lag are at most lag rows apart
            gap = i[k:] - i[:-k]
            var = var + 2 * ((1 - gap / (lag + 1)) * (gap <= lag)) @ (d[k:] * d[:-k])
        t = [m * len(i) / v**0.5 if v > 0 else None for m, v in zip(mean.tolist(), var.tolist(), strict=True)]
        first = table.column("first")[0].as_py()
        return pa.table({"cell": [table.column("cell")[0].as_py()] * len(t), "rep": pa.array(range(first, first + len(t)), pa.int32()), "nw_t": pa.array(t, pa.float64())})

    return cut.groupBy("cell", "first").applyInArrow(one_series, "cell string, rep int, nw_t double")


def shift_distances(n: int, *, seed: str, min_shift: int, total: int) -> list[int]:
    """The circular shift of each replicate, at least min_shift sessions to either side, from the draws of exprs.draw."""
    if total < 1:
        return [0] * n
    span = max(1, total - 2 * min_shift)
    return [min_shift + int(hashlib.md5(f"{seed}|{r}".encode()).hexdigest()[:12], 16) % span for r in range(n)]


def _narrow(v: np.ndarray) -> bytes:
    """Numbers from 0 as unsigned integers of the least width; the width is the bytes over the count."""
    top = int(v.max()) if len(v) else 0
    return v.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int32)


def _packed(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row for each cross-section `by`: its members (no) in order as gaps and the dense ranks from 0 of their values (v)."""
    kinds = {c: rows.schema[c].dataType for c in by}

    def one(table: pa.Table) -> pa.Table:
        no, v = table.column("no").to_numpy(), table.column("v").to_numpy()
        order = np.argsort(no, kind="stable")
        ranks = np.unique(v[order], return_inverse=True)[1]
        keys = {c: table.column(c).slice(0, 1) for c in by}
        return pa.table(keys | {"n": pa.array([len(no)], pa.int32()), "members": [_narrow(np.diff(no[order], prepend=0))], "ranks": [_narrow(ranks)]})

    return rows.groupBy(*by).applyInArrow(one, "".join(f"{c} {k.simpleString()}, " for c, k in kinds.items()) + "n int, members binary, ranks binary")


def _parts(sections: list) -> Iterator[list]:
    """Sections in parts that hold a bounded number of members, or one section."""
    part, held = [], 0
    for x in sections:
        if part and held + len(x[0]) > HELD // 8:
            yield part
            part, held = [], 0
        part.append(x)
        held += len(x[0])
    if part:
        yield part


def _shared_ics(rank_of: np.ndarray, members: list[np.ndarray], ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each section (members, their dense ranks) the number of members with a rank in rank_of (-1: none) and the rank IC
    among those, NaN without spread. Mean ranks come from counting, without a sort."""
    n, lengths = len(members), np.array([len(m) for m in members])
    label = rank_of[np.concatenate(members)]
    both = np.flatnonzero(label >= 0)
    at = np.repeat(np.arange(n), lengths)[both]
    names = np.bincount(at, minlength=n)
    before, middle = np.cumsum(names) - names, (names + 1) / 2

    def centred(code: np.ndarray) -> np.ndarray:
        count = np.bincount(code)
        return (np.cumsum(count) - (count - 1) / 2)[code] - (before + middle)[at]

    a = centred(np.concatenate(ranks)[both] + (np.cumsum(lengths) - lengths)[at])  # a section's dense ranks are below its length
    b = centred(label[both] + (int(rank_of.max(initial=0)) + 1) * at)
    aa, bb, ab = (np.bincount(at, p, n) for p in (a * a, b * b, a * b))
    with np.errstate(invalid="ignore", divide="ignore"):
        return names, np.where(aa * bb > 0, ab / np.sqrt(aa * bb), np.nan)


def placebo_null(features: DataFrame, labels: DataFrame, n: int, *, seed: str, min_shift: int, total: int, min_names: int = 5, block: int = 500, observed: int | None = None, keys: PanelKeys = P, idx: str = "d_idx") -> DataFrame:
    """(rep, cell, date, n, ic): daily rank ICs of labels with the features of a session that a circular shift puts there.

    features: idx, entity, group, x; labels: idx, date, entity, group, cell, y; one row for each entity of a session. NULL and
    NaN count as missing. observed: also give the ICs of the labels with their own session's features, of groups with at least
    so many names, as rep -1.

    A cross-section of a session and group is sorted once and packed into one row of members and ranks. Packed sessions go in
    blocks; a pair of a label block and a feature block of a group is one task, which serves all shifts that map the one to the
    other. So packed rows are copied once for each block of the calendar at most, a task holds two blocks of them, and ranks
    among the names that two sessions share come from counting.
    """
    shifts = shift_distances(n, seed=seed, min_shift=min_shift, total=total)
    spark, at = labels.sparkSession, np.arange(total)
    wanted: dict[int, list[tuple[int, int]]] = {}  # distance: (its number, least names)
    for s in sorted({s % total for s in shifts} if total else ()):
        wanted[s] = [(s, min_names)]
    if observed is not None and total:
        wanted.setdefault(0, []).append((-1, observed))
    pairs = sorted({(int(c) // total, int(c) % total) for s in wanted for c in np.unique(at // block * total + (at - s) % total // block)})
    partners = spark.createDataFrame(pairs, "lb int, fb int")
    reps = spark.createDataFrame([(r, s % total) for r, s in enumerate(shifts) if total] + ([(-1, -1)] if observed is not None else []), "rep int, shift int")
    group, there = F.col(keys.group).cast("string").alias("grp"), lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))

    members = features.filter(there("x")).select(group, F.col(keys.entity).alias("entity")).distinct()
    members = placed_counts(*dealt_counts(members, ["entity"], ["grp"]), ["entity"], ["grp"]).select("grp", "entity", F.col("_from").cast("int").alias("no"))
    members = checkpoint(members)
    known = F.broadcast(members) if members.count() <= BROADCAST else members
    f = features.filter(there("x")).select(F.col(idx).cast("int").alias("i"), group, F.col(keys.entity).alias("entity"), F.col("x").cast("double").alias("v"))
    y = labels.filter(there("y")).select(F.col(idx).cast("int").alias("i"), group, F.col(keys.entity).alias("entity"), F.col("y").cast("double").alias("v"), "cell", F.col(keys.date).alias("date"))
    number = lambda rows: null_safe_join(rows, known, ["grp", "entity"]).drop("entity")
    blocked = lambda rows, b: rows.withColumn(b, F.floor((F.col("i") - 1) / block).cast("int")).join(F.broadcast(partners), b)
    f = blocked(_packed(number(f), ["grp", "i"]), "fb")
    y = blocked(_packed(number(y), ["grp", "i", "cell", "date"]), "lb")
    kind = labels.schema[keys.date].dataType.simpleString()

    def sections(table: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
        cols = (table.column(c).to_pylist() for c in ("i", "n", "members", "ranks"))
        return [(i, np.cumsum(_wide(m, n), dtype=np.int32), _wide(r, n)) for i, n, m, r in zip(*cols, strict=True)]

    def one_pair(left: pa.Table, right: pa.Table) -> pa.Table:
        source = sections(right) if left.num_rows else []
        size, out = max((int(m[-1]) + 1 for _, m, _ in source), default=0), []
        for k, (i, own, ranks) in enumerate(sections(left) if source else []):
            rank_of = np.full(max(size, int(own[-1]) + 1), -1, np.int32)
            rank_of[own] = ranks
            met = [(m, r, wanted[d]) for j, m, r in source if (d := (i - j) % total) in wanted]
            for part in _parts(met):
                names, ics = _shared_ics(rank_of, [m for m, _, _ in part], [r for _, r, _ in part])
                out += [(k, s, m, c * m) for (_, _, to), m, c in zip(part, names.tolist(), ics.tolist(), strict=True) if c == c for s, least in to if m >= least]
        row, shift, names, weighted = zip(*out, strict=True) if out else ((),) * 4
        at = pa.array(row, pa.int64())
        return pa.table({"shift": pa.array(shift, pa.int32()), "cell": left.column("cell").take(at), "date": left.column("date").take(at), "n": pa.array(names, pa.int64()), "w": pa.array(weighted, pa.float64())})

    cell = labels.schema["cell"].dataType.simpleString()
    out = y.groupBy("grp", "lb", "fb").cogroup(f.groupBy("grp", "lb", "fb")).applyInArrow(one_pair, f"shift int, cell {cell}, date {kind}, n long, w double")
    out = out.groupBy("shift", "cell", "date").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).join(F.broadcast(reps), "shift")
    return out.select("rep", "cell", F.col("date").alias(keys.date), "n", (F.col("w") / F.col("n")).alias("ic"))


def _tasks(df: DataFrame) -> int:
    """Partitions for rows that are small beside the work on them, so that they aren't put together by their size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cluster_counts(events: DataFrame, cluster: Sequence[str], n: int, *, seed: str) -> DataFrame:
    """(cluster, reps, counts): how often each cluster is drawn in the replicates that draw it, with replacement.

    The table of draws has replicates * clusters rows, however many events there are. Slots name clusters by dense number.
    """
    key = F.to_json(F.struct(*cluster)) if len(cluster) > 1 else F.col(cluster[0])
    ids = distinct_ranks(events.select(key.alias("cluster")).distinct(), "cluster").select("cluster", (F.col("rank") - 1).cast("long").alias("no"))
    total = F.broadcast(ids.agg(F.count("*").alias("total")))
    dealt = ids.repartition(_tasks(events), "no")  # few rows, but each is drawn n times
    drawn = dealt.select(F.col("no").alias("slot"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("rep")).crossJoin(total)
    counts = drawn.select("rep", F.pmod(draw(seed, "rep", "slot"), F.col("total")).alias("no")).groupBy("no", "rep").agg(F.count("*").cast("int").alias("k"))
    each = counts.groupBy("no").agg(F.collect_list(F.struct("rep", "k")).alias("d"))
    return each.join(ids, "no").select("cluster", F.col("d.rep").alias("reps"), F.col("d.k").alias("counts"))


class _Places:
    """Weighted mean ranks of values whose order is found once."""

    def __init__(self, v: np.ndarray) -> None:
        self.at = np.unique(v, return_inverse=True)[1]
        self.order = np.argsort(self.at, kind="stable")
        self.last = np.flatnonzero(np.diff(self.at[self.order], append=-1))

    def ranks(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct value the weight of its events and their mean rank among all copies."""
        upto = np.cumsum(w[self.order])[self.last]
        mass = np.diff(upto, prepend=0)
        return mass, upto - (mass - 1) / 2


def _group_sums(counts: np.ndarray, x: _Places, y: _Places, min_group: int) -> np.ndarray:
    """For each replicate (a row of counts) the sums over drawn events of 1, a, b, aa, bb, ab, where a and b are ranks over their
    number; 0 with fewer than min_group. One replicate at a time, whose vectors stay in the processor's cache."""
    sums = np.zeros((6, len(counts)))
    for r, k in enumerate(counts):
        w = k.astype(np.float64)
        if (held := w.sum()) >= min_group and held > 0:
            (mx, rx), (my, ry) = x.ranks(w), y.ranks(w)
            middle = (held + 1) / 2  # the mean of mean ranks
            sums[:, r] = held, middle, middle, mx @ (rx * rx) / held**2, my @ (ry * ry) / held**2, (w * rx[x.at]) @ ry[y.at] / held**2
    return sums


def dense_counts(counts: DataFrame, n: int) -> DataFrame:
    """(cluster, drawn): the n counts of a cluster as 16-bit integers, of (cluster, reps, counts)."""

    def one_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reps, k = b.column("reps"), b.column("counts")
            w, most = np.zeros((len(b), n), "<u2"), pa.compute.max(k.flatten()).as_py() or 0
            if most >= 1 << 16:
                raise OverflowError(f"a cluster is drawn {most} times")
            w[np.repeat(np.arange(len(b)), np.diff(reps.offsets.to_numpy())), reps.flatten().to_numpy()] = k.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([b.column("cluster"), pa.array([r.tobytes() for r in w], pa.binary())], ["cluster", "drawn"])

    return counts.mapInArrow(one_batch, f"cluster {counts.schema['cluster'].dataType.simpleString()}, drawn binary")


def cluster_bootstrap_ic(events: DataFrame, x: str, y: str, *, cluster: Sequence[str], cohort: str, group: str, n: int, seed: str, min_group: int = 10, min_cohort: int = 30) -> DataFrame:
    """(rep, mean_ic, cohorts, events): in each replicate the mean over cohorts of the pooled rank IC, as event_cohort_scan
    has it on events whose clusters are drawn with replacement; no event is copied.

    Ranks are made inside (cohort, group) of at least min_group drawn events and pooled by cohort of at least min_cohort. Events
    with a missing value are left out. Events go by cohort; the draws, one row for each cluster, are sent to them in blocks of
    replicates of bounded size, so events are shuffled without draws, and a task holds a cohort and a bounded block. A
    replicate without a cohort has a null mean.
    """
    key = F.to_json(F.struct(*cluster)) if len(cluster) > 1 else F.col(cluster[0])
    rows = events.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    rows = rows.select(F.col(cohort).alias("cohort"), F.col(group).cast("string").alias("grp"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), key.alias("cluster"))
    drawn = checkpoint(dense_counts(cluster_counts(rows, ["cluster"], n, seed=seed), n))
    by_cohort = rows.repartition(_tasks(events), "cohort").sortWithinPartitions("cohort")  # the join below keeps partitions and order
    largest = rows.groupBy("cohort").count().agg(F.max("count")).first()[0] or 0
    width = max(1, min(n, SENT // 2 // max(1, drawn.count()), SENT // max(1, largest)))

    def one_block(first: int, many: int) -> DataFrame:
        def one_cohort(table: pa.Table) -> pa.Table:
            xs, ys = _numbers(table, "x"), _numbers(table, "y")
            chunks = [np.frombuffer(c.buffers()[2], "<u2", len(c) * many, c.offset * 2 * many).reshape(len(c), many) for c in table.column("drawn").chunks if len(c)]
            groups = [(at, _Places(xs[at]), _Places(ys[at])) for at in _by_group(table, "grp")]
            out_ic, out_n, out_rep = [], [], []
            size = max(1, HELD // max(1, len(xs)))
            for start in range(0, many, size):
                part = np.concatenate([c[:, start : start + size] for c in chunks])
                sums = sum(_group_sums(np.ascontiguousarray(part[at].T), px, py, min_group) for at, px, py in groups)
                m, sa, sb, saa, sbb, sab = sums
                with np.errstate(invalid="ignore", divide="ignore"):
                    va, vb = saa - sa * sa / m, sbb - sb * sb / m
                    ic = np.where((m >= min_cohort) & (va > 1e-12) & (vb > 1e-12), (sab - sa * sb / m) / np.sqrt(va * vb), np.nan)
                ok = np.flatnonzero(m >= min_cohort)
                out_rep += (ok + first + start).tolist()
                out_ic += [None if np.isnan(v) else v for v in ic[ok].tolist()]
                out_n += m[ok].astype(np.int64).tolist()
            pa.default_memory_pool().release_unused()
            return pa.table({"rep": pa.array(out_rep, pa.int32()), "ic": pa.array(out_ic, pa.float64()), "n": pa.array(out_n, pa.int64())})

        block = drawn.select("cluster", F.substring("drawn", 2 * first + 1, 2 * many).alias("drawn"))
        return by_cohort.join(F.broadcast(block), "cluster").groupBy("cohort").applyInArrow(one_cohort, "rep int, ic double, n long")

    each = None
    for first in range(0, n, width):
        part = one_block(first, min(width, n - first))
        part = checkpoint(part) if width < n else part  # one block of draws at a time
        each = part if each is None else each.unionByName(part)
    means = each.groupBy("rep").agg(F.avg("ic").alias("mean_ic"), F.count("ic").alias("cohorts"), F.sum("n").alias("events"))
    every = events.sparkSession.range(n).select(F.col("id").cast("int").alias("rep"))
    return every.join(means, "rep", "left").fillna(0, ["cohorts", "events"])


def bootstrap_verdict(replicates: DataFrame, *, by: str, expected_sign: int = 1, p_max: float = 0.10) -> DataFrame:
    """For each clustering its valid replicates, mean, two-sided p (twice the smaller share on one side of zero, at most 1)
    and whether it confirms (expected sign, p below p_max); `all_confirm` only if every clustering does."""
    v = F.col("mean_ic")
    low, high = (F.avg(F.when(v.isNotNull(), c.cast("double"))) for c in (v <= 0, v >= 0))
    each = replicates.groupBy(by).agg(F.count(v).alias("valid"), F.avg(v).alias("boot_mean"), F.least(F.lit(1.0), 2 * F.least(low, high)).alias("p"))
    each = each.withColumn("confirms", F.coalesce((F.col("boot_mean") * expected_sign > 0) & (F.col("p") < p_max), F.lit(False)))
    return each.crossJoin(F.broadcast(each.agg(F.min("confirms").alias("all_confirm"))))
