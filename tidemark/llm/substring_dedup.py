"""Exact removal of byte strings that occur elsewhere, by sorting a sample of the suffixes and inducing the rest.

Sorting every suffix externally carries some 40 bytes for each byte of text through each pass. Here only sampled
suffixes are sorted by Spark's disk-backed shuffle: each window of `length` bytes is owned by the one gram in it whose
hash is least (leftmost among equals), so equal windows are owned by equal grams at the same place, and about one
position in seventy is an owner. Owners are grouped by gram (the first common prefix), then by the whole text of the
windows that they own; what is common to whole groups is settled there. From the remaining owners the common part is
induced window by window. Matching is exact up to equal pairs of 64-bit hashes; both come from one
polynomial modulo 2^64, so they aren't independent on byte strings made against it (of the Thue-Morse kind).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, id_text, mix64, slices, utf8_columns

#: Bytes of a string that must not occur twice.
LENGTH = 200
#: Positions handled at once in a very long text.
CHUNK = 1 << 20
#: Owners of one gram whose texts meet in one task at most (each is under twice `length` bytes).
MAX_OWNERS = 1000
#: Ids that are broadcast at most; more of them are joined by shuffling.
BROADCAST_IDS = 1_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_LOW = np.uint64((1 << 24) - 1)


class WindowHashes:
    """Hashes of any substring of a text: a polynomial over random byte codes, from prefix sums modulo 2^64."""

    codes = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    powers = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls.powers) < n:
            size = 1 << (n - 1).bit_length()
            cls.powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, np.uint64))])
            cls.inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, pow(_BASE, -1, 1 << 64), np.uint64))])

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self._grow(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, stop: np.ndarray | slice, at: np.ndarray | slice) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.inverse[at]

    def all(self, size: int) -> np.ndarray:
        """The hash of every substring of this size."""
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.inverse[:n]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    blocks = np.concatenate([x, np.full(-len(x) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def owners(text: bytes, length: int) -> tuple[np.ndarray, ...]:
    """(gram hash, hash of all owned windows, first owned window, last owned window) of each owner in a text."""
    gram = max(1, length // 3)
    parts = []
    for at in range(0, max(len(text) - length + 1, 0), CHUNK):
        data = np.frombuffer(text, np.uint8, min(CHUNK + length - 1, len(text) - at), at)
        hashes = WindowHashes(data)
        grams = hashes.all(gram)
        owner = (_sliding_min(grams & ~_LOW | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & _LOW).astype(np.int64)
        lo = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        hi = np.r_[lo[1:], len(owner)] - 1
        own = owner[lo]
        shape = ((own - lo) * (1 << 20) + (hi - lo)).astype(np.uint64)
        parts.append((mix64(grams[own]), mix64(hashes.of(lo, hi + length, lo) ^ mix64(shape + np.uint64(1))), lo + at, hi + at))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _owners_of(docs: DataFrame, length: int) -> DataFrame:
    def found(batches):
        for batch in slices(batches, "text"):
            ids, parts = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8_columns(batch, "text"), strict=True):
                if text is not None and len(text) >= length:
                    parts.append(owners(text, length))
                    ids += [doc_id] * len(parts[-1][0])
            if parts:
                gram, whole, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(ids, pa.int64()), pa.array(lo.astype(np.int32)), pa.array((hi - lo).astype(np.int32))], names=["gram", "whole", "doc_id", "lo", "more"])

    return docs.mapInArrow(found, "gram long, whole long, doc_id long, lo int, more int")


def _contexts(docs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """(gram, doc_id, lo, alone, context): the text of all windows that the representative of a class owns."""
    by_doc = classes.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "lo", "more", "alone")).alias("owned"))
    ids = checkpoint(by_doc.select("doc_id"))
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    names = ["gram", "doc_id", "lo", "alone", "context"]

    def contexts(batches):
        for batch in slices(batches, "text"):
            rows = [(o["gram"], doc_id, o["lo"], o["alone"], text[o["lo"] : o["lo"] + o["more"] + length]) for doc_id, text, owned in zip(batch.column(0).to_pylist(), utf8_columns(batch, "text"), batch.column(2).to_pylist(), strict=True) for o in owned]
            for k in range(0, len(rows), 20_000):
                columns = list(zip(*rows[k : k + 20_000], strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return texts.select("doc_id", "text").join(by_doc, "doc_id").select("doc_id", "text", "owned").mapInArrow(contexts, "gram long, doc_id long, lo int, alone boolean, context binary")


def _windows_of(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of a batch's contexts: its row, its place in the context, and a hash of gram and window."""
    hashes = [WindowHashes(np.frombuffer(c, np.uint8)).all(length) for c in batch.column(4).to_pylist()]
    sizes = np.array([len(h) for h in hashes])
    row = np.repeat(np.arange(len(hashes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    gram = mix64(batch.column(0).to_numpy().view(np.uint64))
    return row, place, mix64(np.concatenate(hashes)) ^ gram[row]


def _common_in_groups(length: int):
    """Spans of windows that occur in two contexts of one gram, for rows in the order of gram; a group that a batch cuts
    waits for the next."""

    def spans_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, place, code = _windows_of(batch, length)
        _, first, count = np.unique(code, return_inverse=True, return_counts=True)
        alone = batch.column(3).to_numpy(zero_copy_only=False)
        again = np.flatnonzero((count[first] > 1) & alone[row])
        row, place = row[again], place[again]
        begins = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)]) if len(row) else np.zeros(0, np.int64)
        ends = np.r_[begins[1:], len(row)][: len(begins)] - 1
        lo = batch.column(2).to_numpy()[row[begins]]
        return pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(row[begins])), pa.array((lo + place[begins]).astype(np.int32)), pa.array((lo + place[ends] + length).astype(np.int32))], names=["doc_id", "start", "stop"])

    def common(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            if table.num_rows:
                gram = table.column(0).to_numpy()
                last = int(np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])[-1])
                if last:
                    yield spans_of(table.slice(0, last).combine_chunks().to_batches()[0])
                rest = table.slice(last).combine_chunks().to_batches()[0]
        if rest is not None:
            yield spans_of(rest)

    return common


def _window_rows(contexts: DataFrame, length: int) -> DataFrame:
    """(gram, window, doc_id, at, alone): each window of each context, by its hash."""

    def windows(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                row, place, code = _windows_of(part, length)
                take = pa.array(row)
                lo = part.column(2).to_numpy()[row]
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), pa.array(code.view(np.int64)), part.column(1).take(take), pa.array((lo + place).astype(np.int32)), part.column(3).take(take)], names=["gram", "window", "doc_id", "at", "alone"])

    return contexts.mapInArrow(windows, "gram long, window long, doc_id long, at int, alone boolean")


def repeated_spans(docs: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, stop): byte ranges, not merged, of strings of at least `length` bytes that occur elsewhere."""
    rows = _owners_of(docs, length)
    grams = rows.groupBy("gram").agg(F.count("*").alias("n"), F.min("whole").alias("least"), F.max("whole").alias("most"))
    grams = grams.filter("n > 1").select("gram", (F.col("least") < F.col("most")).alias("mixed"))
    shared = checkpoint(rows.join(grams, "gram"))
    stop = F.col("lo") + F.col("more") + length
    # All owners of the gram own the same text: every one of its windows occurs elsewhere.
    spans = shared.filter("not mixed").select("doc_id", F.col("lo").alias("start"), stop.alias("stop"))
    mixed = shared.filter("mixed")
    classes = checkpoint(mixed.groupBy("gram", "whole").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "lo", "more")).alias("one")))
    whole = mixed.join(classes.filter("n > 1").select("gram", "whole"), ["gram", "whole"])
    spans = spans.unionByName(whole.select("doc_id", F.col("lo").alias("start"), stop.alias("stop")))
    # Owners whose text is found once share some windows with others of the gram, or none. The texts of few owners meet
    # in one task; those of a gram with many owners are dealt window by window.
    per_gram = classes.groupBy("gram").agg(F.count("*").alias("owners"), F.min("n").alias("fewest")).filter("fewest = 1")
    sides = classes.join(per_gram, "gram").select("gram", "owners", "one.*", (F.col("n") == 1).alias("alone")).filter("doc_id is not null")
    few = _contexts(docs, sides.filter(F.col("owners") <= MAX_OWNERS).drop("owners"), length)
    found = few.repartition("gram").sortWithinPartitions("gram").mapInArrow(_common_in_groups(length), "doc_id long, start int, stop int")
    spans = spans.unionByName(found)
    many = checkpoint(sides.filter(F.col("owners") > MAX_OWNERS).drop("owners"))
    if many.isEmpty():
        return spans
    windows = _window_rows(_contexts(docs, many, length), length)
    again = windows.groupBy("gram", "window").agg(F.count("*").alias("n")).filter("n > 1").select("gram", "window")
    single = windows.filter("alone").join(again, ["gram", "window"])
    return spans.unionByName(single.select("doc_id", F.col("at").alias("start"), (F.col("at") + length).alias("stop")))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) for each row of docs.

    Every byte that a string of `length` bytes covers which also starts anywhere else goes, in all its places. Matches
    don't cross documents; null texts are empty; texts shorter than `length` stay. Rows of one id must hold one text and
    are copies of one another. Rows without id stay whole, but others are judged against them.
    """
    texts = id_text(docs, id_col, text_col)
    spans = repeated_spans(texts, length=length).filter("doc_id is not null").groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def cut(batches):
        for batch in slices(batches, "text"):
            raw, lists = utf8_columns(batch, "text"), batch.column(2)
            n_removed, n_spans, kept = [], [], []
            flat = lists.flatten()
            starts, stops = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for text, size, end in zip(raw, sizes.tolist(), ends.tolist(), strict=True):
                text = text or b""
                if not size:
                    n_removed.append(0), n_spans.append(0), kept.append(text)
                    continue
                edge = np.zeros(len(text) + 1, np.int32)
                np.add.at(edge, starts[end - size : end], 1)
                np.subtract.at(edge, stops[end - size : end], 1)
                covered = np.cumsum(edge[:-1]) > 0
                n_removed.append(int(covered.sum()))
                n_spans.append(int((np.diff(np.r_[0, covered.view(np.int8)]) == 1).sum()))
                kept.append(np.frombuffer(text, np.uint8)[~covered].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t or b"") for t in raw], pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = texts.join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
