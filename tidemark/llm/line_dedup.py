"""Incremental, reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

State (`LineIndex`) is three tables keyed by a 128-bit hash of the normalised line:

* refs: one row for each (key, document) that holds the line,
* counts: the exact number of referencing documents of each key and the smallest of them,
* filters: for each shard of the key space a cuckoo filter over the keys in counts.

An inserted batch is first reduced to one row for each key (map-side combined, so a line that a third of all documents
hold never meets in one task), then meets its shard's filter: a key that the filter doesn't know is new and goes
straight to counts; only the rest is joined with the exact table. Every key that turns out new is added to the filters,
and the key space is dealt to more shards as keys grow. Deleting documents removes their references, recounts
the keys they touched and takes keys without references out of the filters, so that deletions restore earlier lines.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Tables, id_text, record_batch, slices, utf8_columns, with_kept

KEY = ["key_hi", "key_lo"]
SLOTS = 4
#: Keys of one shard; the number of shards follows the number of keys, so that a shard fits a task at any corpus size.
KEYS_PER_SHARD = 200_000
#: How many times the keys at hand shards are dealt for.
ROOM = 3
#: Batches in which the one-shot form inserts documents: from the second on, filters decide which keys are new.
BATCHES = 2


class CuckooFilter:
    """Partial-key cuckoo filter with 16-bit fingerprints and four slots a bucket; it supports deletion.

    contains() answers which keys may be held. A filter that can't place a fingerprint is built again, larger, from the
    keys of the exact table, so that it never forgets one.
    """

    def __init__(self, n_keys: int) -> None:
        self.n_buckets = 1 << max(2, int(np.ceil(np.log2(max(1, n_keys) / (SLOTS * 0.8)))))
        self.table = np.zeros((self.n_buckets, SLOTS), np.uint16)

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        self = cls(1)
        self.table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        self.n_buckets = len(self.table)
        return self

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        fp = (hi.astype(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        fp[fp == 0] = 1
        a = (lo.astype(np.uint64) & np.uint64(self.n_buckets - 1)).astype(np.int64)
        return fp, a, self._other(a, fp)

    def _other(self, bucket: np.ndarray, fp: np.ndarray) -> np.ndarray:
        return bucket ^ ((fp.astype(np.int64) * 0x5BD1E995) & (self.n_buckets - 1))

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        fp, a, b = self._places(hi, lo)
        return ((self.table[a] == fp[:, None]) | (self.table[b] == fp[:, None])).any(axis=1)

    def _fill(self, fp: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Place fingerprints in free slots of their bucket, all at once; which ones found room."""
        order = np.argsort(bucket, kind="stable")
        sorted_bucket = bucket[order]
        first = np.r_[True, sorted_bucket[1:] != sorted_bucket[:-1]]
        start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        turn = np.arange(len(order)) - start
        free = self.table[sorted_bucket] == 0
        fits = turn < free.sum(axis=1)
        slot = (np.cumsum(free[fits], axis=1) == (turn[fits] + 1)[:, None]).argmax(axis=1)
        self.table[sorted_bucket[fits], slot] = fp[order[fits]]
        placed = np.zeros(len(fp), bool)
        placed[order[fits]] = True
        return placed

    def add(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """Insert distinct new keys; False if the filter is too full to hold them all."""
        if not len(hi):
            return True
        fp, a, b = self._places(hi, lo)
        left = np.flatnonzero(~self._fill(fp, a))
        if len(left):
            left = left[~self._fill(fp[left], b[left])]
        for i in left:  # the few that have to push others on
            f, bucket = int(fp[i]), int(b[i])
            for turn in range(500):
                row = self.table[bucket]
                if (free := np.flatnonzero(row == 0)).size:
                    row[free[0]] = f
                    break
                slot = (f + turn) % SLOTS
                f, row[slot] = int(row[slot]), f
                bucket = int(self._other(np.int64(bucket), np.uint16(f)))
            else:
                return False
        return True

    def remove(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Delete keys that were added."""
        for f, a, b in zip(*self._places(hi, lo), strict=True):
            for bucket in (a, b):
                if (at := np.flatnonzero(self.table[bucket] == f)).size:
                    self.table[bucket, at[0]] = 0
                    break


@dataclass(frozen=True)
class LineIndex:
    """refs(key_hi, key_lo, doc_id), counts(key_hi, key_lo, n_docs, first_doc), filters(shard, filter); None: empty."""

    refs: DataFrame | None = None
    counts: DataFrame | None = None
    filters: DataFrame | None = None
    n_shards: int = 0


def _written(df: DataFrame) -> DataFrame:
    """df as a table of its own in the shared folder; an index keeps its tables, as an earlier one may be gone back to."""
    return Tables(df.sparkSession).keep(df)


def line_key(line: bytes) -> bytes:
    """White space at both ends stripped, A-Z lower-cased; other characters stay."""
    return line.strip().lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def line_refs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(key_hi, key_lo, doc_id): each distinct long enough line key of each document. Rows without id or text have none."""

    def refs(batches):
        for batch in slices(batches, "text"):
            ids, digests = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8_columns(batch, "text"), strict=True):
                if text is not None and doc_id is not None:
                    keys = {k for k in map(line_key, text.split(b"\n")) if _long_enough(k, min_chars)}
                    digests += map(xxhash.xxh3_128_digest, keys)
                    ids += [doc_id] * len(keys)
            both = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids, pa.int64())], names=["key_hi", "key_lo", "doc_id"])

    return id_text(docs, id_col, text_col).mapInArrow(refs, "key_hi long, key_lo long, doc_id long").dropDuplicates()


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


def _shard(n_shards: int) -> F.Column:
    return F.pmod(F.shiftright("key_lo", 32), F.lit(n_shards)).cast("int")


SIFTED = "key_hi long, key_lo long, n_docs long, first_doc long, maybe boolean"
FILTERS = "shard int, filter binary"


def _filter_of(hi: np.ndarray, lo: np.ndarray) -> bytes:
    """A filter of all these keys with room for as many again; b'' (every key is `maybe`) if they collide at any size."""
    for more in range(1, 8):
        held = CuckooFilter(len(hi) << more)
        if held.add(hi, lo):
            return held.dump()
    return b""


def _build(keys: DataFrame, n_shards: int) -> DataFrame:
    """(shard, filter) over all keys."""

    def build(own: pd.DataFrame) -> pd.DataFrame:
        data = _filter_of(own["key_hi"].to_numpy(np.int64), own["key_lo"].to_numpy(np.int64))
        return pd.DataFrame({"shard": own["shard"].iloc[:1], "filter": [data]})

    return keys.select(*KEY, _shard(n_shards).alias("shard")).groupBy("shard").applyInPandas(build, FILTERS)


def _sift(keys: DataFrame, filters: DataFrame, n_shards: int) -> DataFrame:
    """One row for each key, with `maybe`: whether the index may hold it. A shard without a filter answers for all of its
    keys if it has a row with b'', and holds no key if it has no row."""

    def sift(new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        hi, lo = new["key_hi"].to_numpy(np.int64), new["key_lo"].to_numpy(np.int64)
        data = old["filter"].iloc[0] if len(old) else None
        maybe = np.full(len(new), data is not None) if not data else CuckooFilter.load(data).contains(hi, lo)
        return new.assign(maybe=maybe)[["key_hi", "key_lo", "n_docs", "first_doc", "maybe"]]

    return keys.withColumn("shard", _shard(n_shards)).groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(sift, SIFTED)


def _grow(filters: DataFrame, new: DataFrame, counts: DataFrame, n_shards: int) -> DataFrame:
    """The filters with new keys (none of them held) added; those that overflow are built again from counts."""

    def grow(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        shard = int((old if len(old) else keys)["shard"].iloc[0])
        hi, lo = keys["key_hi"].to_numpy(np.int64), keys["key_lo"].to_numpy(np.int64)
        data = old["filter"].iloc[0] if len(old) else _filter_of(hi, lo)
        if len(old) and data and len(keys):
            held = CuckooFilter.load(data)
            data = held.dump() if held.add(hi, lo) else b""
        return pd.DataFrame({"shard": [shard], "filter": [data]})

    dealt = new.select(*KEY, _shard(n_shards).alias("shard"))
    grown = _written(filters.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(grow, FILTERS))
    full = grown.filter(F.length("filter") == 0).select("shard")
    if full.isEmpty():
        return grown
    again = counts.withColumn("shard", _shard(n_shards)).join(full, "shard", "left_semi")
    return _written(grown.filter(F.length("filter") > 0).unionByName(_build(again, n_shards)))


def _shards_for(n_keys: int) -> int:
    """Shards with room for ROOM times the keys, so that they are seldom dealt anew."""
    return max(1, -(-ROOM * n_keys // KEYS_PER_SHARD))


def insert(index: LineIndex, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, fresh: bool = False) -> LineIndex:
    """The index after documents have been added; a document that it holds already changes nothing.

    fresh: the index is known to hold none of these documents, which needn't be looked up then.
    """
    refs = line_refs(docs, id_col=id_col, text_col=text_col, min_chars=min_chars)
    if index.refs is not None and not fresh:
        refs = refs.join(index.refs, [*KEY, "doc_id"], "left_anti")
    refs = _written(refs)
    if index.counts is None:  # nothing is held yet: all keys are new
        counts = _written(_count(refs))
        n_shards = _shards_for(counts.count())
        return LineIndex(refs, counts, _written(_build(counts, n_shards)), n_shards)
    n_shards, filters = index.n_shards, index.filters
    # The number of distinct keys sizes shards only, so an estimate of it will do.
    most = index.counts.count() + refs.agg(F.approx_count_distinct("key_lo")).first()[0]
    if most > n_shards * KEYS_PER_SHARD:  # before the batch is dealt, so that no task gets more than its share
        n_shards = _shards_for(most)
        filters = _written(_build(index.counts, n_shards))
    rows = _written(_sift(_count(refs), filters, n_shards))
    maybe, unknown = rows.filter("maybe").drop("maybe"), rows.filter("not maybe").drop("maybe")
    merged = index.counts.unionByName(maybe).groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.min("first_doc").alias("first_doc"))
    counts = _written(merged.unionByName(unknown))
    # A key that the filter took for a held one, but the exact table lacks, is new as well.
    new = unknown.select(*KEY).unionByName(maybe.join(index.counts, KEY, "left_anti").select(*KEY))
    filters = _grow(filters, new, counts, n_shards)
    return LineIndex(index.refs.unionByName(refs), counts, filters, n_shards)


def delete(index: LineIndex, doc_ids: DataFrame, *, id_col: str = "doc_id") -> LineIndex:
    """The index after documents have been taken out; lines that they alone held become unknown again."""
    gone = doc_ids.select(F.col(id_col).cast("long").alias("doc_id")).dropDuplicates()
    refs = _written(index.refs.join(gone, "doc_id", "left_anti").select(*KEY, "doc_id"))
    touched = _written(index.refs.join(gone, "doc_id", "left_semi").select(*KEY).dropDuplicates())
    again = _count(refs.join(touched, KEY, "left_semi"))
    counts = _written(index.counts.join(touched, KEY, "left_anti").unionByName(again))
    freed = touched.join(again, KEY, "left_anti").withColumn("shard", _shard(index.n_shards))

    def take_out(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        if len(old) and len(old["filter"].iloc[0]) and len(keys):
            held = CuckooFilter.load(old["filter"].iloc[0])
            held.remove(keys["key_hi"].to_numpy(np.int64), keys["key_lo"].to_numpy(np.int64))
            return pd.DataFrame({"shard": old["shard"], "filter": [held.dump()]})
        return old[["shard", "filter"]] if len(old) else pd.DataFrame({"shard": pd.Series(dtype="int32"), "filter": pd.Series(dtype=object)})

    filters = _written(index.filters.groupBy("shard").cogroup(freed.groupBy("shard")).applyInPandas(take_out, "shard int, filter binary"))
    return LineIndex(refs, counts, filters, index.n_shards)


def dropped_lines(index: LineIndex, refs: DataFrame | None = None) -> DataFrame:
    """(doc_id, keys): for each document the line keys that it loses, because a smaller doc_id holds them."""
    shared = index.counts.filter("n_docs > 1").select(*KEY, "first_doc")
    lost = (index.refs if refs is None else refs).join(shared, KEY).filter("doc_id > first_doc")
    return lost.groupBy("doc_id").agg(F.collect_list(F.struct(*KEY)).alias("keys"))


def apply_index(index: LineIndex, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents with the lines that they lose taken out: doc_id, text, n_lines, n_dropped; other lines stay, joined by newlines.

    Null and empty texts are one empty line and stay as they are (null as an empty text). Rows with a null id keep all
    lines and count as no document. Repeated rows of one id are one document: each keeps or loses the same lines.
    keep: columns of docs to carry along in a struct `kept`.
    """

    def rebuild(batches):
        for batch in slices(batches, "text"):
            keys = batch.column(batch.schema.get_field_index("keys")).to_pylist()
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(utf8_columns(batch, "text"), keys, strict=True):
                lines = (text or b"").split(b"\n")
                kept = lines
                if gone:
                    gone = {np.array([k["key_hi"], k["key_lo"]], ">i8").tobytes() for k in gone}
                    kept = [x for x in lines if not (_long_enough(k := line_key(x), min_chars) and xxhash.xxh3_128_digest(k) in gone)]
                texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield record_batch({"doc_id": batch.column(0), "text": pa.array(texts, pa.binary()).cast(pa.string()), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}, batch)

    rows = id_text(docs, id_col, text_col, keep)
    joined = rows.join(dropped_lines(index), "doc_id", "left").select(*rows.columns, "keys")
    return joined.mapInArrow(rebuild, with_kept("doc_id long, text string, n_lines long, n_dropped long", docs, keep))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """One-shot form: insert the documents into an empty index, in BATCHES dealt by id, and apply it to them."""
    names = {"id_col": id_col, "text_col": text_col, "min_chars": min_chars}
    turn, index = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(BATCHES)), LineIndex()
    for k in range(BATCHES):
        index = insert(index, docs.filter(turn == k), **names, fresh=True)
    return apply_index(index, docs, **names, keep=keep)
