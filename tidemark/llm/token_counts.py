"""Token counts by rank-synchronous array merging.

Pre-tokens are held as one ragged array of symbols. In each round every sequence finds the lowest rank among its
adjacent pairs, and all occurrences of that pair in all sequences are merged at once; a sequence without a ranked pair
is done and its surviving symbols are counted. Counts of pre-tokens are kept in a bounded cache of the worker.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import id_text, slices, utf8_columns

#: Pre-tokens that a worker remembers; beyond that it starts anew.
CACHE_WORDS = 400_000

_SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Fixed values of the tokenizer file: how it splits lower-cased text, for ASCII texts and for all others.
_ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACES}\p{{L}}\p{{N}}]+")
#: Fixed values of the tokenizer file: the normalizers and the splitting pattern that the two expressions stand for.
_FILE_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_FILE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _refuse_others(spec: dict, path: str) -> None:
    """Raise for a file whose normalizer, splitter or model isn't the one that pre_tokens() and count() follow."""
    normalizers = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = [x["pattern"].get("Regex") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split"]
    if normalizers != _FILE_NORMALIZERS or split != [_FILE_SPLIT] or not spec["model"].get("end_of_word_suffix"):
        raise ValueError(f"{path}: not a word-end BPE file with the normalizer and splitter that are known here")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class RankMerger:
    """The merges of a byte-level BPE file with word-end symbols, as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _refuse_others(spec, path)
        vocab, merges, end = spec["model"]["vocab"], spec["model"]["merges"], spec["model"]["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order
        self.special = sorted(t["content"] for t in spec["added_tokens"])
        self.special_split = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.counts: dict[str, int] = {}

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], len(self.keys))

    def count(self, words: list[bytes]) -> np.ndarray:
        """Surviving symbols of each non-empty pre-token."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        of = np.repeat(np.arange(len(words)), sizes)
        out, none = sizes.copy(), len(self.keys)
        while len(symbols) > 1:
            same = of[1:] == of[:-1]
            rank = np.where(same, self._ranks(symbols[:-1], symbols[1:]), none)
            first = np.flatnonzero(np.r_[True, ~same])  # where each sequence begins
            low = np.minimum.reduceat(np.r_[rank, none], first)
            seq = np.cumsum(np.r_[True, ~same]) - 1
            hit = (rank == low[seq[:-1]]) & (rank < none)
            # Of overlapping occurrences (a run of one symbol) every second one is taken, from the left.
            run = np.flatnonzero(hit)
            if not len(run):
                break
            new = np.r_[True, (np.diff(run) > 1) | (rank[run[1:]] != rank[run[:-1]])]
            start = np.maximum.accumulate(np.where(new, np.arange(len(run)), 0))
            run = run[(np.arange(len(run)) - start) % 2 == 0]
            symbols[run] = self.made[rank[run]]
            keep = np.ones(len(symbols), bool)
            keep[run + 1] = False
            live = (low < none)[seq]  # sequences that are done leave the arrays
            np.subtract.at(out, of[run], 1)
            keep &= live
            symbols, of = symbols[keep], of[keep]
        return out

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii():
            return _ASCII_SPLIT.findall(text.lower())
        # Lower-casing is by character: no final sigma.
        return _SPLIT.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def count_texts(self, texts: list[str]) -> list[int]:
        split, extra = [], []
        for text in texts:
            pieces = self.special_split.split(text) if self.special_split and any(s in text for s in self.special) else [text]
            extra.append(len(pieces) - 1)
            split.append([w for piece in pieces for w in self.pre_tokens(piece)])
        counts = self.counts
        if new := list({w for words in split for w in words if w not in counts}):
            if len(counts) + len(new) > CACHE_WORDS:
                counts.clear()
                new = list({w for words in split for w in words})
            counts.update(zip(new, self.count([w.encode("utf-8", "surrogatepass") for w in new]).tolist(), strict=True))
        return [n + sum(map(counts.__getitem__, words)) for n, words in zip(extra, split, strict=True)]


_MERGERS: dict[str, RankMerger] = {}


def merger(path: str) -> RankMerger:
    """The merger of a tokenizer file, built once in each worker."""
    if path not in _MERGERS:
        _MERGERS[path] = RankMerger(path)
    return _MERGERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row; no shuffle.

    tokenizer: the name of a file of the public_tokenizers package, or a path that all executors have. Null and empty
    texts have 0 tokens; a null id stays null; repeated rows are counted one by one.
    """

    def counted(batches):
        path = tokenizer
        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        bpe = merger(path)
        for batch in slices(batches, "text"):
            raw = utf8_columns(batch, "text")
            n = bpe.count_texts([(t or b"").decode("utf-8", "replace") for t in raw])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t or b"") for t in raw], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_text(docs, id_col, text_col).mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
