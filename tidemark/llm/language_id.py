"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language. An unseen word is scored by the longest known character
n-gram that ends at each of its characters, trying ever shorter ones. Frequencies are learned from a bounded sample of
labelled rows (`sample_docs` for each language, drawn by hash), so the model that executors receive is bounded too.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, record_batch, slices, utf8_columns, with_kept

#: Labelled rows of each language that the model is fitted on, at most about.
SAMPLE_DOCS = 1000
#: Longest character n-gram; words are enclosed by spaces.
MAX_GRAM = 4
#: Words and n-grams seen less often in the sample are not known.
MIN_COUNT = 2
#: Unseen words that a worker remembers, and their greatest length; longer ones are scored anew each time.
CACHE_WORDS = 50_000
CACHE_CHARS = 200
#: n-grams of a long word that are summed at once.
BLOCK_GRAMS = 1 << 16
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class LanguageModel:
    """langs; log frequencies by language of words and n-grams (a key of n-grams starts with a tab)."""

    langs: list[str]
    row_of: dict[str, int]
    logs: np.ndarray

    def __post_init__(self) -> None:
        self.unseen: dict[str, np.ndarray] = {}

    def backoff(self, word: str) -> np.ndarray:
        """Mean, over the characters, of the log frequencies of the longest known n-gram that ends there."""
        if (found := self.unseen.get(word)) is not None:
            return found
        padded, get, rows = f" {word} ", self.row_of.get, []
        for end in range(1, len(padded) + 1):
            for start in range(max(0, end - MAX_GRAM), end):
                if (row := get("\t" + padded[start:end])) is not None:
                    rows.append(row)
                    break
        if len(word) > CACHE_CHARS:
            blocks = (self.logs[rows[i : i + BLOCK_GRAMS]].sum(axis=0, dtype=np.float64) for i in range(0, len(rows), BLOCK_GRAMS))
            return sum(blocks, np.zeros(len(self.langs))) / max(1, len(rows))
        total = self.logs[rows].mean(axis=0) if rows else np.zeros(len(self.langs), np.float32)
        if len(self.unseen) >= CACHE_WORDS:
            self.unseen.clear()
        self.unseen[word] = total
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share of the likelihood for each word (geometric mean)."""
        words = words_of(text or "")
        if not self.langs or not any(c.isalpha() for w in words for c in w):
            return UNDETERMINED, 0.0
        get, rows, total = self.row_of.get, [], np.zeros(len(self.langs))
        for w in words:
            row = get(w)
            if row is None:
                total += self.backoff(w)
            else:
                rows.append(row)
        if rows:
            total += self.logs[rows].sum(axis=0)
        # Words of one text depend on one another: the evidence grows as the root of their number.
        total = (total - total.max()) / np.sqrt(len(words))
        p = np.exp(total)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best] / p.sum())


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Learn from rows with text and lang; the sample of each language is drawn by a hash of the id.

    Rows of equal id are drawn or left out together, rows without id too. Without such rows the model knows no language
    and finds every text undetermined.
    """
    rows = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("h")).filter("text is not null and lang is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    rate = sizes.select(F.col("lang").alias("of"), F.least(F.lit(1.0), F.lit(float(sample_docs)) / F.col("n")).alias("rate"))
    # One row for each language: that many are broadcast.
    sample = rows.join(F.broadcast(rate), F.col("lang") == F.col("of")).filter(F.pmod("h", F.lit(1 << 30)) < F.col("rate") * (1 << 30)).select("lang", "text")

    def counted(batches):
        for batch in slices(batches, "text", 16 << 20):
            words: dict[str, Counter[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), utf8_columns(batch, "text"), strict=True):
                words.setdefault(lang, Counter()).update(words_of(text.decode("utf-8", "replace")))
            counts: Counter[tuple[str, str]] = Counter()
            for lang, own in words.items():
                for word, k in own.items():
                    counts[lang, word] += k
                    for n in range(1, MAX_GRAM + 1):
                        for g in grams_of(word, n):
                            counts[lang, "\t" + g] += k
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in counts], pa.string()), pa.array([x[1] for x in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["lang", "gram", "n"])

    table = sample.mapInArrow(counted, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)
    found = table.toArrow()
    langs = sorted(set(found.column("lang").unique().to_pylist()))
    grams = sorted(set(found.column("gram").unique().to_pylist()))
    row_of = {g: i for i, g in enumerate(grams)}
    counts = np.zeros((len(grams), len(langs)), np.float64)
    counts[[row_of[g] for g in found.column("gram").to_pylist()], [langs.index(x) for x in found.column("lang").to_pylist()]] = found.column("n").to_numpy()
    # Words compete with words, and n-grams with n-grams of their length.
    kind = np.array([len(g) - 1 if g[0] == "\t" else 0 for g in grams], np.int64)
    logs = np.zeros_like(counts, np.float32)
    for k in range(MAX_GRAM + 1):
        at = kind == k
        if at.any():
            logs[at] = np.log((counts[at] + 0.5) / (counts[at].sum(axis=0) + 0.5 * at.sum()))
    return LanguageModel(langs, row_of, logs)


def identify(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score for each row, from its whole text; no shuffle. Null texts and texts without a letter: und, 0.

    Rows without id or of equal id are judged one by one; an empty table gives an empty one.

    keep: columns of docs to carry along in a struct `kept`, beside which the text is returned as a column of its own.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.row_of, model.logs))

    def predicted(batches):
        own = LanguageModel(*shared.value)
        for batch in slices(batches, "text"):
            out = [own.predict(None if t is None else t.decode("utf-8", "replace")) for t in utf8_columns(batch, "text")]
            columns = {"doc_id": batch.column(0), "lang_pred": pa.array([x[0] for x in out], pa.string()), "score": pa.array([x[1] for x in out], pa.float64())}
            yield record_batch(columns | ({"text": batch.column(1)} if keep else {}), batch)

    return id_text(docs, id_col, text_col, keep).mapInArrow(predicted, with_kept("doc_id long, lang_pred string, score double" + ", text string" * bool(keep), docs, keep))
