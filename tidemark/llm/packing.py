"""Packing by concatenate and cut: documents become one stream of token ids that is cut into fixed windows.

Pass one tokenises each document once, ends it with an id, and writes ids with the number of ids before it in its
partition. Running totals over partitions (one row each) give every partition its place in the whole stream. Pass two
places each document by that sum alone and cuts it where windows end; nothing but the partition totals is shuffled.

`sequences` puts windows together: pieces that follow each other in a task make whole windows there, and only boundary
records, windows that a task holds in part, are shuffled.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Tables, few_broadcast, id_text, slices, utf8_columns
from tidemark.llm.token_counts import RankMerger

#: Pre-tokens whose ids a worker remembers, and the longest that it does.
CACHE_WORDS, CACHE_LENGTH = 400_000, 64
#: Rows of pieces in one Arrow batch.
BATCH_PIECES = 8_192


class RankEncoder(RankMerger):
    """The ids of texts, with the merges of a file as arrays."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        most = max(int(self.made.max(initial=0)), int(self.last.max()), *self.special_ids.values(), 0)
        self.kind = np.dtype("<u2" if most < 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each non-empty pre-token: in each round all words merge their lowest-rank pair at once."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        of = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = len(self.keys)
        while len(symbols):
            same = of[1:] == of[:-1]
            rank = np.r_[np.where(same, self._ranks(symbols[:-1], symbols[1:]), none), none]
            first = np.flatnonzero(np.r_[True, ~same])
            low = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(symbols)]))
            live = low < none
            done.append((of[~live], symbols[~live]))
            of, symbols, rank, low = of[live], symbols[live], rank[live], low[live]
            run = np.flatnonzero(rank == low)
            if not len(run):
                break
            # In a run of one symbol every second pair is merged, from the left.
            new = np.r_[True, (np.diff(run) > 1) | (rank[run[1:]] != rank[run[:-1]])]
            start = np.maximum.accumulate(np.where(new, np.arange(len(run)), 0))
            run = run[(np.arange(len(run)) - start) % 2 == 0]
            symbols[run] = self.made[rank[run]]
            keep = np.ones(len(symbols), bool)
            keep[run + 1] = False
            of, symbols = of[keep], symbols[keep]
        of, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(of, kind="stable")
        data, width = symbols[order].astype(self.kind).tobytes(), self.kind.itemsize
        at = np.r_[0, np.cumsum(np.bincount(of, minlength=len(words)))] * width
        return [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def encode_texts(self, texts: list[str], end: bytes) -> list[bytes]:
        """Ids of each text, then `end`."""
        split = []
        for text in texts:
            if self.special_split and any(s in text for s in self.special):
                words, at = [], 0
                for m in self.special_split.finditer(text):
                    words += [*self.pre_tokens(text[at : m.start()]), (m[0],)]
                    at = m.end()
                words += self.pre_tokens(text[at:])
            else:
                words = self.pre_tokens(text)
            split.append(words)
        known = self.known
        new = {w for words in split for w in words if w not in known}
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = {w for words in split for w in words}
        # A special string is a tuple, so that ordinary text never equals it.
        known.update({w: np.array([self.special_ids[w[0]]], self.kind).tobytes() for w in new if isinstance(w, tuple)})
        plain = [w for w in new if isinstance(w, str)]
        if plain:
            known.update(zip(plain, self.merge([w.encode("utf-8", "surrogatepass") for w in plain]), strict=True))
        out = [b"".join([*map(known.__getitem__, words), end]) for words in split]
        for w in plain:
            if len(w) > CACHE_LENGTH:
                del known[w]
        return out


_ENCODERS: dict[str, RankEncoder] = {}


def encoder(tokenizer: str) -> RankEncoder:
    """The encoder of a tokenizer file, built once in each worker."""
    path = tokenizer
    if not os.path.isabs(path):
        import public_tokenizers

        path = public_tokenizers.path(path)
    if path not in _ENCODERS:
        _ENCODERS[path] = RankEncoder(path)
    return _ENCODERS[path]


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, part, before, n, ids): ids of each document with the end id, and the ids before it in its partition."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        if end_id >= 1 << 8 * bpe.kind.itemsize:
            raise ValueError(f"end_id {end_id} is no id of {tokenizer}")
        end, width = np.array([end_id], bpe.kind).tobytes(), bpe.kind.itemsize
        for batch in slices(batches, "text"):
            ids = bpe.encode_texts([(t or b"").decode("utf-8", "replace") for t in utf8_columns(batch, "text")], end)
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // width
            upto = before + np.cumsum(n)
            before, start = int(upto[-1]) if len(n) else before, upto - n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(start), pa.array(n), pa.array(ids, pa.binary())],
                names=["doc_id", "part", "before", "n", "ids"],
            )

    return id_text(docs, id_col, text_col).mapInArrow(encoded, "doc_id long, part int, before long, n long, ids binary")


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, of 4 bytes each).

    The pieces of a document, by start, are its ids and the end id; the pieces of a sequence, by offset, fill it without
    a gap, and all sequences but the last have `length` ids. Null and empty texts are the end id alone; a null id stays
    null; repeated rows are packed one by one; an empty table gives an empty one.
    """
    tables = Tables(docs.sparkSession)
    table = tables.keep(tokenised(docs, tokenizer, end_id, id_col, text_col))
    # One row for each partition of pass one; the window holds no more than these.
    totals = table.groupBy("part").agg(F.sum("n").alias("total"))
    base = F.coalesce(F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = table.join(few_broadcast(totals.select("part", base.alias("base"))), "part")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
        kinds = [pa.int64()] * 7 + [pa.binary()] * keep_ids
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for doc, at, n, ids in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                wide = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(length - offset, n - start)
                    piece = wide[start : start + size].tobytes()
                    rows.append((doc, start, size, zlib.crc32(piece), n, sequence, offset, *([piece] if keep_ids else [])))
                    held += size * 4
                    start += size
                    if len(rows) >= BATCH_PIECES or keep_ids and held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * keep_ids
    return placed.select("doc_id", (F.col("base") + F.col("before")).alias("at"), "n", "ids").mapInArrow(cut, schema)


def sequences(pieces: DataFrame, length: int = 2048) -> DataFrame:
    """(sequence_id, n, ids): the windows of pack(..., keep_ids=True), ids of 4 bytes each; the last may be short."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, parts, size, out = -1, 0, [], 0, []

        def flush() -> None:
            if parts:
                out.append((key, first, size, b"".join(parts), size == length))

        def emit() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["sequence_id", "offset", "n", "ids", "whole"])

        for batch in batches:
            for sequence, offset, ids in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if (sequence, offset) != (key, first + size):
                    flush()
                    key, first, parts, size = sequence, offset, [], 0
                parts.append(ids)
                size += len(ids) // 4
            if len(out) >= 512:
                yield emit()
                out = []
        flush()
        if out:
            yield emit()

    table = Tables(pieces.sparkSession).keep(pieces.select("sequence_id", "offset", "ids").mapInArrow(joined, "sequence_id long, offset long, n long, ids binary, whole boolean"))
    edges = table.filter("not whole").groupBy("sequence_id").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    merged = edges.select("sequence_id", "n", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
    return table.filter("whole").select("sequence_id", "n", "ids").unionByName(merged)
