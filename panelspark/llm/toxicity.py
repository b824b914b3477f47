"""Toxicity by cumulative-link ordinal regression over sparse text features.

Grades are 0 (clean), 1 (mild) and 2 (severe). The labels only say toxic or not; a toxic row is severe when the share of
its words that are toxic terms (words far more frequent in toxic than in clean rows of the sample) is at least the median
share of toxic rows. The model shares one weight vector w over two ordered thresholds: P(grade > k) = sigmoid(w.x - t_k).
The severity it reports is the expected grade; a document is rejected when P(grade > 0) reaches ``REJECT``.

Features are hashed lower-case words and word beginnings (inflected and compound terms share them) with value
log(1 + 100 * count / words), over the whole text.

Defined cases: null or empty text has no features and is never rejected; a model without toxic or without clean labelled
rows rejects nothing (severity 0); duplicate labels of a row count once, toxic if any says so; null labels and labels of
unknown rows are ignored; repeated rows get equal scores; of equally likely grades the lower one is reported; other columns pass through ``keep_clean`` unchanged.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import small_batches

#: Hashed feature space, bits.
FEATURE_BITS = 20
#: Labelled rows that a model is fitted on at most (those with the smallest hash of their id).
MAX_FIT_ROWS = 8000
#: A feature counts from so many rows of the sample on, and if its log-odds are sqrt(ln n) standard errors from zero: the more
#: rows (n) the sample has, the more noise features there are. Of three such rules it did best in cross-validation.
MIN_ROWS = 5
REJECT = 0.5
#: Lengths of the word beginnings.
PREFIXES = (4, 5, 6, 7)
CACHE_WORDS = 200_000

WORD = re.compile(r"[^\W\d_]+")
SCORES = "doc_id long, severity double, p_toxic double, grade int, rejected boolean"


def _keys(word: str) -> list[int]:
    """Hashed features of a word: itself and its beginnings."""
    mask = (1 << FEATURE_BITS) - 1
    return [zlib.crc32(word.encode()) & mask, *(zlib.crc32(f"{word[:k]}-".encode()) & mask for k in PREFIXES if len(word) > k)]


def _features(text: str | None) -> tuple[list[int], list[float]]:
    words = WORD.findall((text or "").lower())
    tf: Counter = Counter()
    for w, n in Counter(words).items():
        for k in _keys(w):
            tf[k] += n
    keys = sorted(tf)
    return keys, [float(np.log1p(100.0 * tf[k] / len(words))) for k in keys]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        both = [_features(t) for t in b["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["toxic"], pa.array([k for k, _ in both], pa.list_(pa.int32())), pa.array([v for _, v in both], pa.list_(pa.float32()))], names=["toxic", "keys", "values"])


@dataclass
class OrdinalModel:
    """Shared weights by hashed feature and ordered thresholds; empty weights never reject."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << FEATURE_BITS, np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.array([np.inf, np.inf]))

    def scorer(self):
        """Text to (expected severity, P(grade > 0), most likely grade)."""
        weights, thresholds, cache = self.weights, self.thresholds, {}

        def score(text: str | None) -> tuple[float, float, int]:
            words = WORD.findall((text or "").lower())
            if len(cache) > CACHE_WORDS:
                cache.clear()
            tf: Counter = Counter()
            for w, n in Counter(words).items():
                keys = cache.get(w)
                if keys is None:
                    keys = cache[w] = tuple(k for k in _keys(w) if weights[k])
                for k in keys:
                    tf[k] += n
            scale = 100.0 / max(len(words), 1)
            total = float(sum(weights[k] * np.log1p(scale * n) for k, n in sorted(tf.items())))
            above = 1.0 / (1.0 + np.exp(np.clip(thresholds - total, -40, 40)))
            if not np.isfinite(thresholds).all():
                above = np.zeros(len(thresholds))
            grade = int(np.argmax(-np.diff(np.r_[1.0, above, 0.0])))
            return float(above.sum()), float(above[0]), grade

        return score

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id, severity, p_toxic, grade, rejected for each row."""
        small_batches(docs.sparkSession)
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score = model.scorer()
            for b in batches:
                rows = [score(t) for t in b["text"].to_pylist()]
                severity, p, grade = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [])
                yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(severity, pa.float64()), pa.array(p, pa.float64()), pa.array(grade, pa.int32()), pa.array([x >= REJECT for x in p], pa.bool_())], names=["doc_id", "severity", "p_toxic", "grade", "rejected"])

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCORES)

    def keep_clean(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that are not rejected, with all their columns."""
        small_batches(docs.sparkSession)
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score = model.scorer()
            for b in batches:
                yield b.filter(pa.array([score(t)[1] < REJECT for t in b["text"].to_pylist()], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> OrdinalModel:
    """Fit on at most ``max_rows`` labelled rows of ``docs``; their ids are the only thing that is broadcast."""
    small_batches(docs.sparkSession)
    marked = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    t = rows.mapInArrow(_feature_rows, "toxic int, keys array<int>, values array<float>").toArrow()
    if not t.num_rows:
        return OrdinalModel()
    keys, values = t["keys"].combine_chunks(), t["values"].combine_chunks()
    row = np.repeat(np.arange(t.num_rows), np.asarray(keys.value_lengths()))
    return _fit(row, np.asarray(keys.flatten()), np.asarray(values.flatten(), np.float64), t["toxic"].to_numpy())


def _fit(row: np.ndarray, key: np.ndarray, value: np.ndarray, toxic: np.ndarray) -> OrdinalModel:
    n, n_toxic = len(toxic), int(toxic.sum())
    if n_toxic in (0, n):
        return OrdinalModel()
    space = 1 << FEATURE_BITS
    df = np.bincount(key, minlength=space)
    df_toxic = np.bincount(key[toxic[row] == 1], minlength=space)
    odds = np.log((df_toxic + 0.5) / (n_toxic + 1)) - np.log((df - df_toxic + 0.5) / (n - n_toxic + 1))
    error = np.sqrt(1 / (df_toxic + 0.5) + 1 / (df - df_toxic + 0.5))
    known = (df >= min(MIN_ROWS, n_toxic)) & (np.abs(odds) >= np.sqrt(np.log(n)) * error)
    use = known[key]
    row, key, value = row[use], key[use], value[use]
    # Severity of the toxic rows: the share of their words that are toxic terms.
    term = (odds > 2) & (df_toxic >= min(MIN_ROWS, n_toxic))
    share = np.bincount(row, np.where(term[key], np.expm1(value), 0.0), minlength=n)
    grade = np.where(toxic == 1, np.where(share >= np.median(share[toxic == 1]), 2, 1), 0)
    # Columns in use, then full-batch Adam on the ordinal likelihood with an L2 penalty.
    cols, at = np.unique(key, return_inverse=True)
    w, t = np.zeros(len(cols)), np.array([1.0, 2.0])
    state = [np.zeros(len(cols) + 2), np.zeros(len(cols) + 2)]
    above = (grade[:, None] > np.arange(2)).astype(float)
    for step in range(1, 201):
        z = np.bincount(row, value * w[at], minlength=n)
        p = 1 / (1 + np.exp(np.clip(t - z[:, None], -40, 40)))  # P(grade > k)
        # P(grade = g) and its derivatives in z and in the thresholds
        edge = np.c_[np.ones(n), p, np.zeros(n)]
        slope = np.c_[np.zeros(n), p * (1 - p), np.zeros(n)]
        prob = np.maximum(edge[np.arange(n), grade] - edge[np.arange(n), grade + 1], 1e-12)
        dz = -(slope[np.arange(n), grade] - slope[np.arange(n), grade + 1]) / prob / n
        dt = np.zeros((n, 4))
        dt[np.arange(n), grade] += slope[np.arange(n), grade] / prob / n
        dt[np.arange(n), grade + 1] -= slope[np.arange(n), grade + 1] / prob / n
        g = np.r_[np.bincount(at, value * dz[row], minlength=len(cols)) + 1e-4 * w, dt[:, 1:3].sum(0)]
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.99 * state[1] + 0.01 * g * g
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        w, t = w - move[:-2], t - move[-2:]
        t[1] = max(t[1], t[0] + 1e-3)  # the thresholds stay ordered
    weights = np.zeros(space, np.float32)
    weights[cols] = np.where(np.abs(w) < 1e-3, 0, w)
    return OrdinalModel(weights, t)
