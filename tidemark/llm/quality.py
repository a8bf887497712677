"""Quality classifier: Naive Bayes support vectors.

Features are indicators of token n-grams and of n-grams of token shapes, hashed to a fixed number of columns. Class
log-count ratios of the indicators come from all training rows; each indicator is scaled by its ratio, and a linear
hinge-loss model over them is fitted by dual coordinate descent on a bounded sample of the training rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, mix64, slices, utf8_columns

#: Hashed columns.
N_COLUMNS = 1 << 18
#: Training rows of each class that the hinge-loss model is fitted on, at most about.
SAMPLE_DOCS = 3000
EPOCHS, COST, SMOOTH = 20, 0.1, 1.0
CACHE_WORDS = 300_000
#: Words count as more than repeated neighbours from this share on, in hundredths.
REPEAT_STEPS = (2, 5, 10, 20, 40)

_RUN = re.compile(r"(.)\1+")


def shape_of(token: str) -> str:
    """Letters as A or a, digits as 0, other characters as they are; runs as one."""
    kinds = "".join("0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in token)
    return _RUN.sub(r"\1", kinds)


class Indicators:
    """Sorted distinct columns of a text's n-grams: tokens and pairs, shapes up to triples, shares of repeated tokens."""

    def __init__(self) -> None:
        self.cache: dict[bytes, tuple[int, int]] = {}

    def _code(self, token: bytes) -> tuple[int, int]:
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        text = token.decode("utf-8", "replace")
        self.cache[token] = code = (xxhash.xxh3_64_intdigest(text.lower().encode()), xxhash.xxh3_64_intdigest(shape_of(text).encode(), 1))
        return code

    def __call__(self, text: bytes | None) -> np.ndarray:
        tokens = (text or b"").split()
        if not tokens:
            return np.zeros(1, np.int64)
        get = self.cache.get
        codes = np.array([get(t) or self._code(t) for t in tokens], np.uint64)
        word, shape = codes[:, 0], codes[:, 1]
        step = np.uint64(0x9E3779B97F4A7C15)
        parts = [word, word[:-1] * step + word[1:], shape, shape[:-1] * step + shape[1:], (shape[:-2] * step + shape[1:-1]) * step + shape[2:]]
        again = 100 * int((word[1:] == word[:-1]).sum()) / len(tokens)
        # Shares of shapes tell steady noise from a stray token.
        kinds, n = np.unique(shape, return_counts=True)
        level = np.floor(np.log2(n / len(tokens))).astype(np.int64).astype(np.uint64)
        parts += [np.arange(1, 1 + sum(again >= x for x in REPEAT_STEPS), dtype=np.uint64), kinds * step + level]
        hashed = mix64(np.concatenate([p + np.uint64(7919 * k) for k, p in enumerate(parts)]))
        return np.unique((hashed % np.uint64(N_COLUMNS - 1)).astype(np.int64) + 1)


@dataclass
class QualityModel:
    """score = sigmoid(slope * (weights over indicators, scaled by the root of their number) + offset)."""

    weights: np.ndarray
    slope: float
    offset: float

    def score(self, columns: np.ndarray) -> float:
        z = self.slope * self.weights[columns].sum() / np.sqrt(len(columns)) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def log_count_ratios(train: DataFrame) -> np.ndarray:
    """log((1 + n1) / |1 + n1|) - log((1 + n0) / |1 + n0|) for each column, over all rows of (text, label)."""

    def counted(batches):
        indicators, n = Indicators(), np.zeros((2, N_COLUMNS), np.int64)
        for batch in slices(batches, "text"):
            for text, label in zip(utf8_columns(batch, "text"), batch.column(1).to_pylist(), strict=True):
                n[label, indicators(text)] += 1
        label, column = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(column.astype(np.int32)), pa.array(n[label, column])], names=["label", "col", "n"])

    table = train.select("text", "label").mapInArrow(counted, "label int, col int, n long").groupBy("label", "col").agg(F.sum("n").alias("n")).toArrow()
    n = np.full((2, N_COLUMNS), SMOOTH)
    n[table.column("label").to_numpy(), table.column("col").to_numpy()] += table.column("n").to_numpy()
    p = n / n.sum(axis=1, keepdims=True)
    return np.log(p[1] / p[0])


def fit_hinge(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, *, cost: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Dual coordinate descent for the L2-regularised hinge loss over ratio-scaled, length-scaled indicators."""
    rng, w, alpha = np.random.default_rng(seed), np.zeros(len(ratios)), np.zeros(len(rows))
    values = [ratios[r] / np.sqrt(len(r)) for r in rows]
    square = np.array([max((v * v).sum(), 1e-12) for v in values])
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                alpha[i] = new
    return w * ratios


def fit_sigmoid(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a small ridge."""
    a, x = np.zeros(2), np.c_[z, np.ones(len(z))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-3 * a
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        a -= np.linalg.solve(h, g)
    return float(a[0]), float(a[1])


def fit(labelled: DataFrame, *, text_col: str = "text", label_col: str = "quality", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> QualityModel:
    """Learn from rows with a 0/1 label; null texts count as empty, rows without a label are left out.

    The sample is drawn by a hash of the id: rows of equal id, or without one, come together. Of one class alone the
    score is (nearly) that class, of no rows 0.5.
    """
    rows = labelled.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(label_col).cast("int").alias("label"), F.xxhash64(F.col(id_col).cast("string")).alias("h")).filter("label in (0, 1)")
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:  # one class or none: its share for all
        return QualityModel(np.zeros(N_COLUMNS), 0.0, 30.0 if 1 in sizes else -30.0 if sizes else 0.0)
    ratios = log_count_ratios(rows)
    drawn = rows.filter(F.pmod("h", F.lit(1 << 30)) < F.expr(f"case label when 1 then {min(1.0, sample_docs / sizes[1])} else {min(1.0, sample_docs / sizes[0])} end") * (1 << 30))

    def columns(batches):
        indicators = Indicators()
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([indicators(t).astype(np.int32) for t in utf8_columns(batch, "text")], pa.list_(pa.int32()))], names=["label", "h", "columns"])

    sample = sorted(drawn.mapInArrow(columns, "label int, h long, columns array<int>").toArrow().to_pylist(), key=lambda r: (r["h"], r["columns"]))
    x = [np.array(r["columns"], np.int64) for r in sample]
    y = np.array([r["label"] for r in sample])
    signed = np.where(y == 1, 1.0, -1.0)
    share = np.array([(y == 0).sum(), (y == 1).sum()])
    cost = COST * len(y) / (2 * np.maximum(share, 1)[y])
    margins, fold = np.zeros(len(x)), np.arange(len(x)) % 3
    for k in range(3):  # margins of rows that the fit hasn't seen, for the calibration
        own = [i for i in range(len(x)) if fold[i] != k]
        w = fit_hinge([x[i] for i in own], signed[own], ratios, cost=cost[own])
        for i in np.flatnonzero(fold == k):
            margins[i] = w[x[i]].sum() / np.sqrt(len(x[i]))
    total = np.array([sizes[0], sizes[1]])
    slope, offset = fit_sigmoid(margins, y, (total / np.maximum(share, 1))[y] * len(y) / total.sum())
    return QualityModel(fit_hinge(x, signed, ratios, cost=cost), slope, offset)


def score(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score for each row, from its whole text (null: empty); no shuffle.

    Rows without id or of equal id are scored one by one; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.slope, model.offset))

    def scored(batches):
        own, indicators = QualityModel(*shared.value), Indicators()
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.score(indicators(t)) for t in utf8_columns(batch, "text")], pa.float64())], names=["doc_id", "score"])

    return id_text(docs, id_col, text_col).mapInArrow(scored, "doc_id long, score double")
