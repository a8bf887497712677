"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items are normalised to words and put into one automaton (in blocks of bounded size, a pass for each block, so that
what is sent to the executors has a bound). Each document's words are streamed through it, with the longest match at
each word known; words inside a match of a full window are hit, and spans of them are cut out of contaminated texts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, record_batch, slices, utf8_columns, with_kept

#: Window of item words whose occurrence counts as a hit; an item of fewer words is one window.
WINDOW = 13
#: A document is contaminated if at least this share of its words is hit, as (numerator, denominator).
COVERAGE = (1, 20)
#: Bytes of item texts in one automaton.
BLOCK_BYTES = 1 << 20

#: A-Z to a-z and every ASCII character that is no letter or digit to a space; bytes of other characters stay.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    """`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z."""
    return (text or b"").translate(WORD_TABLE).split()


class ItemAutomaton:
    """Generalised suffix automaton over words; states know the items that hold their window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, text in items:
            if words := [self.ids.setdefault(w, len(self.ids)) for w in words_of(text)]:
                coded.append((item, words))
                self._add(words)
        self.shortest = min((min(len(w), window) for _, w in coded), default=window)
        self.full: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, words in coded:
            state, held = 0, 0
            for word in words:
                state, held = self.step(state, held, word)
                if held >= window:
                    self.full.setdefault(state, set()).add(item)
            if len(words) < window:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                self.short.setdefault(state, []).append((len(words), item))
        #: States on whose chain of suffix links a short item ends, by growing length.
        self.ends = [False] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.ends[s] = s in self.short or self.ends[self.link[s]]

    def _add(self, words: list[int]) -> None:
        last = 0
        for c in words:
            last = self._extend(last, c)

    def _clone(self, p: int, c: int, q: int) -> int:
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        clone = len(self.next) - 1
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if (q := self.next[last].get(c)) is not None:  # an earlier item holds it
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        new, p = len(self.next) - 1, last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new

    def step(self, state: int, held: int, word: int) -> tuple[int, int]:
        """State and length of the longest match that ends at this word, cut to the window."""
        while state and word not in self.next[state]:
            state = self.link[state]
            held = self.length[state]
        if (to := self.next[state].get(word)) is None:
            return 0, 0
        state, held = to, held + 1
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state, min(held, self.window)

    def hits(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Which words lie in an occurring window (None: none), and the items of those windows."""
        if not self.ids:
            return None, set()
        get = self.ids.get
        coded = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.r_[False, coded >= 0, False]))
        starts, ends = known[::2], known[1::2]
        long = ends - starts >= self.shortest
        mask, items = None, set()
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            state = held = 0
            for i, word in enumerate(coded[a:b].tolist(), a):
                state, held = self.step(state, held, word)
                size = 0
                if held == self.window:
                    size = held
                    items |= self.full[state]
                s = state
                while s > 0 and self.ends[s]:
                    for m, item in self.short.get(s, ()):
                        if m <= held:
                            size = max(size, m)
                            items.add(item)
                    s = self.link[s]
                if size:
                    mask = np.zeros(len(words), bool) if mask is None else mask
                    mask[i + 1 - size : i + 1] = True
        return mask, items


def _spans(mask: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False])).tolist()
    return list(zip(edges[::2], edges[1::2], strict=True))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from the first to the last word of each span."""
    at = [m.span() for m in _WORD.finditer(text.translate(WORD_TABLE))]
    out, end = [], 0
    for a, b in spans:
        out.append(text[end : at[a][0]])
        end = at[b - 1][1]
    return b"".join([*out, text[end:]])


HITS = "doc_id long, text string, spans array<struct<a:int,b:int>>, items array<string>"


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[list[tuple[str, bytes]]]:
    """Items in blocks of bounded size, read one block at a time."""
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).filter("item is not null and text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        yield [(r.item, r.text.encode()) for r in rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    coverage: tuple[int, int] = COVERAGE,
    max_span: int | None = None,
    block_bytes: int = BLOCK_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, contaminated, clean_text for each row of docs; no shuffle.

    contaminated: n_hit > 0 and n_hit / n_words >= coverage. clean_text: the text without its hit spans if it is
    contaminated or a span is longer than max_span words; else the text. Null texts have no words; items without text,
    id or words have no windows; rows of one item id are one item; repeated documents are judged one by one.
    keep: columns of docs to carry along in a struct `kept`.
    """
    nothing = [F.lit(None).cast("array<struct<a:int,b:int>>").alias("spans"), F.lit(None).cast("array<string>").alias("items")]
    hits = id_text(docs, id_col, text_col, keep).select("doc_id", "text", *nothing, *["kept"][: len(keep)])
    sc = docs.sparkSession.sparkContext
    searches = [_search(sc.broadcast(block), window) for block in _blocks(items, item_col, item_text_col, block_bytes)]
    for search in searches[:-1]:
        hits = hits.mapInArrow(search, with_kept(HITS, docs, keep))
    num, den = coverage

    def judge(batches):
        # The last block is searched in the same pass, which spares a worker and a copy of the texts.
        for batch in slices(searches[-1](batches) if searches else batches, "text"):
            out = {"n_words": [], "n_hit": [], "clean": [], "bad": []}
            for text, spans in zip(utf8_columns(batch, "text"), batch.column(2).to_pylist(), strict=True):
                n, runs = len(words_of(text)), []
                for s in sorted((s["a"], s["b"]) for s in spans or ()):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append([*s])
                hit = sum(b - a for a, b in runs)
                bad = hit > 0 and den * hit >= num * n
                out["n_words"].append(n)
                out["n_hit"].append(hit)
                out["bad"].append(bad)
                out["clean"].append(cut_spans(text, runs) if runs and (bad or max_span is not None and max(b - a for a, b in runs) > max_span) else text)
            ids = [sorted(set(x or ())) for x in batch.column(3).to_pylist()]
            counts = {k: pa.array(out[k], pa.int64()) for k in ("n_words", "n_hit")}
            found = {"n_items": pa.array(map(len, ids), pa.int64()), "items": pa.array(ids, pa.list_(pa.string())), "contaminated": pa.array(out["bad"], pa.bool_())}
            yield record_batch({"doc_id": batch.column(0), **counts, **found, "clean_text": pa.array(out["clean"], pa.binary()).cast(pa.string())}, batch)

    return hits.mapInArrow(judge, with_kept("doc_id long, n_words long, n_hit long, n_items long, items array<string>, contaminated boolean, clean_text string", docs, keep))


def _search(block, window: int):
    def search(batches):
        automaton = ItemAutomaton(block.value, window)
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        for batch in slices(batches, "text"):
            all_spans, all_items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for k, text in enumerate(utf8_columns(batch, "text")):
                mask, items = automaton.hits(words_of(text))
                if mask is not None:
                    all_spans[k] = [*(all_spans[k] or ()), *({"a": a, "b": b} for a, b in _spans(mask))]
                    all_items[k] = [*(all_items[k] or ()), *items]
            yield record_batch({"doc_id": batch.column(0), "text": batch.column(1), "spans": pa.array(all_spans, kind), "items": pa.array(all_items, pa.list_(pa.string()))}, batch)

    return search
