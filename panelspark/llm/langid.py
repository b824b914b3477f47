"""Language identification by error-correcting output codes.

Each language has a codeword; each bit of it is predicted by a binary linear classifier over hashed character n-grams (of
one to four bytes) of the whole text. Decoding is loss-weighted: the language whose codeword has the smallest logistic loss
over all bits, each bit weighted by its accuracy on rows that it was not fitted on, is chosen; a small margin to the next
codeword marks the row as ambiguous. So that margins mean something, they come from classifiers of the same bits that also
learn mixtures of rows of two languages, in whose bits a share is right; and letters that no language of the sample uses
count as evidence for none.

Defined cases: null text, or text without a letter, is ``und`` with score 0; rows without a language train nothing; with
no training row all are ``und``; with one language all others are that one; repeated rows get equal answers; of equally near
codewords that of the first language by name is taken, and the row is ambiguous; a null id stays null; an empty table gives
no row; other columns are ignored; the prediction reads only the text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._common import small_batches

#: Hashed n-gram space.
SPACE_BITS = 14
#: Training rows of each language, about, at most (those whose id hashes lowest).
MAX_FIT_ROWS = 1000
#: Codeword bits where the exhaustive code would be longer.
MAX_CODE_BITS = 63
#: Below this difference of probability between the two nearest codewords a row is ambiguous.
AMBIGUOUS = 0.2
UNDETERMINED = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")
#: Multipliers of the n-gram hash, one for each byte of an n-gram.
PRIMES = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)


def ngrams(text: str | None) -> np.ndarray:
    """Hashed n-grams of the lower-case letters of ``text`` with single spaces between and around words; empty without a letter."""
    clean = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not any(map(str.isalpha, clean)):
        return np.zeros(0, np.uint32)
    b = np.frombuffer(f" {clean} ".encode(), np.uint8).astype(np.uint32)
    out = []
    h = np.zeros(len(b), np.uint32)
    for n in range(1, 5):
        if len(b) < n:
            break
        h = h[: len(b) - n + 1] + (b[n - 1 :] + np.uint32(1)) * PRIMES[n - 1]
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
        out.append(mixed >> np.uint32(32 - SPACE_BITS))
    return np.concatenate(out)


def letters(text: str | None) -> str:
    return NOT_LETTERS.sub("", (text or "").lower())


def codewords(k: int) -> np.ndarray:
    """k codewords of -1 and 1: the exhaustive code where it is short, else random bits (fixed seed) without repeated columns."""
    if k < 2:
        return np.zeros((k, 0), np.int8)
    if 2 ** (k - 1) - 1 <= MAX_CODE_BITS:
        cols = [[1, *(1 if c >> r & 1 else -1 for r in range(k - 1))] for c in range(2 ** (k - 1) - 1)]
        return np.array(cols, np.int8).T
    rng = np.random.default_rng(7)
    bits = max(MAX_CODE_BITS, int(10 * np.log2(k)))
    best = None
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.int8), (k, bits))
        gap = min(int((code[i] != code[j]).sum()) for i in range(k) for j in range(i)) if k < 200 else 0
        if best is None or gap > best[0]:
            best = gap, code
    return best[1]


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, values, own = [], [], []
        for t in b["text"].to_pylist():
            own.append("".join(sorted(set(letters(t)))))
            k, n = np.unique(ngrams(t), return_counts=True)
            keys.append(k.astype(np.int32))
            values.append((n / max(n.sum(), 1)).astype(np.float32))
        yield pa.RecordBatch.from_arrays([b["h"], b["lang"], pa.array(keys, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32())), pa.array(own, pa.string())], names=["h", "lang", "keys", "values", "letters"])


@dataclass
class LanguageModel:
    langs: list[str]
    code: np.ndarray  # language x bit
    weights: np.ndarray  # n-gram x bit
    bias: np.ndarray
    bit_weight: np.ndarray
    mixed_weights: np.ndarray  # of the classifiers that learned mixtures as well
    mixed_bias: np.ndarray
    alphabet: frozenset[str] = frozenset()

    def known_share(self, text: str | None) -> float:
        """Share of the letters of ``text`` that the sample's languages use."""
        own = letters(text)
        strange = set(own) - self.alphabet
        return 1.0 - sum(map(own.count, strange)) / len(own) if strange else 1.0

    def predictor(self):
        """Text to (language, score, ambiguous)."""
        langs, code, bit_weight = self.langs, self.code.astype(np.float64), self.bit_weight
        weights, bias = np.hstack([self.weights, self.mixed_weights]), np.r_[self.bias, self.mixed_bias]

        def predict(text: str | None) -> tuple[str, float, bool]:
            h = ngrams(text)
            if not len(h) or not langs:
                return UNDETERMINED, 0.0, True
            if len(langs) == 1:
                return langs[0], 1.0, False
            if len(h) < 1 << SPACE_BITS:
                f = weights[h].sum(axis=0, dtype=np.float64) / len(h) + bias
            else:
                f = np.bincount(h, minlength=1 << SPACE_BITS) @ weights / len(h) + bias
            f = f * self.known_share(text)
            first = int(np.argmin(np.logaddexp(0.0, -code * f[: len(bit_weight)]) @ bit_weight))
            loss = np.logaddexp(0.0, -code * f[len(bit_weight) :]) @ bit_weight
            p = np.exp(loss.min() - loss)
            p /= p.sum()
            return langs[first], float(p[first]), bool(p[first] - np.delete(p, first).max() < AMBIGUOUS)

        return predict

    def predict(self, docs: DataFrame) -> DataFrame:
        """doc_id, lang_pred, score, ambiguous for each row."""
        small_batches(docs.sparkSession)
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            predict = model.predictor()
            for b in batches:
                rows = [predict(t) for t in b["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.bool_())], names=["doc_id", "lang_pred", "score", "ambiguous"])

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def fit_languages(rows: DataFrame, max_rows: int = MAX_FIT_ROWS) -> LanguageModel:
    """Fit on ``rows`` (doc_id, text, lang), about ``max_rows`` of each language at most; every language of the rows is learned."""
    small_batches(rows.sparkSession)
    rows = rows.filter("lang is not null and text is not null").select(F.xxhash64("doc_id", "text").alias("h"), "text", "lang")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    place = F.pmod(F.col("h"), F.lit(1_000_000))
    pick = F.lit(False)
    for x in langs:
        pick = pick | ((F.col("lang") == x) & (place < int(1_000_000 * min(1.0, max_rows / counts[x])) + 1))
    t = rows.filter(pick).select("h", "lang", "text").mapInArrow(_count_rows, "h long, lang string, keys array<int>, values array<float>, letters string").toArrow().sort_by("h")
    code = codewords(len(langs))
    if len(langs) < 2 or not t.num_rows:
        return LanguageModel(langs, code, np.zeros((1 << SPACE_BITS, 0), np.float32), np.zeros(0), np.zeros(0), np.zeros((1 << SPACE_BITS, 0), np.float32), np.zeros(0))
    keys, values = t["keys"].combine_chunks(), t["values"].combine_chunks()
    ends = np.r_[0, np.cumsum(np.asarray(keys.value_lengths()))]
    col, val = np.asarray(keys.flatten()), np.asarray(values.flatten())
    where = {x: i for i, x in enumerate(langs)}
    y = np.array([where[x] for x in t["lang"].to_pylist()])
    used = Counter(c for own in t["letters"].to_pylist() for c in own)
    alphabet = frozenset(c for c, n in used.items() if n > max(1, t.num_rows // 1000))
    target = code[y].astype(np.float32)
    weights, bias = _fit_bits(ends, col, val, target, np.arange(len(y)))
    mixed = _fit_bits(ends, col, val, target, np.arange(len(y)), mixtures=True)
    # Errors of each bit on rows that it was not fitted on; rows are in the order of a hash.
    wrong, halves = np.zeros(code.shape[1]), np.array_split(np.arange(len(y)), 2)
    for fit, test in (halves, halves[::-1]) if len(y) > 1 else ():
        w, b = _fit_bits(ends, col, val, target, fit)
        wrong += sum(target[r] * ((w[col[ends[r] : ends[r + 1]]] * val[ends[r] : ends[r + 1], None]).sum(axis=0) + b) <= 0 for r in test.tolist())
    errors = (wrong + 0.5) / (len(y) + 1)
    bit_weight = np.maximum(np.log((1 - errors) / errors), 0.01)
    # Two codewords differ in ``apart`` bits that all tell the same: together they weigh as one.
    apart = np.mean([(code[i] != code[j]).sum() for i in range(len(code)) for j in range(i)])
    return LanguageModel(langs, code, weights, bias, bit_weight / bit_weight.sum() * code.shape[1] / apart, *mixed, alphabet)


#: Rows of a training batch, passes over the sample, and the first step.
BATCH, PASSES, STEP = 256, 12, 0.05
#: Batches that the classifiers of mixtures learn from at least.
LEAST_STEPS = 160


def _fit_bits(ends: np.ndarray, col: np.ndarray, val: np.ndarray, target: np.ndarray, chosen: np.ndarray, mixtures: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A logistic classifier for each bit, all as one matrix (Adam over batches, L2), fitted on the ``chosen`` rows: weights, bias.

    ``ends`` are the borders of the rows in ``col`` and ``val``; one batch at a time is a dense matrix, so memory is bounded.
    With ``mixtures``, mixtures of two of its rows come to each batch; a mixture's target is mixed alike.
    """
    space, bits = 1 << SPACE_BITS, target.shape[1]
    scale = 1 / np.sqrt(np.bincount(col, val.astype(np.float64) ** 2, minlength=space) / len(target) + 1e-8)  # rare n-grams count as much as frequent ones
    scale = np.minimum(scale, 1e3).astype(np.float32)

    def batch(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), space + 1), np.float32)
        for k, r in enumerate(rows.tolist()):
            own = col[ends[r] : ends[r + 1]]
            x[k, own] = val[ends[r] : ends[r + 1]] * scale[own]
        x[:, space] = 1  # bias
        return x

    w = np.zeros((space + 1, bits), np.float32)
    m1, m2, step, rng = np.zeros_like(w), np.zeros_like(w), 0, np.random.default_rng(11)
    passes = max(PASSES, -(-LEAST_STEPS * BATCH // max(len(chosen), 1))) if mixtures else PASSES
    for turn in range(passes):
        order = rng.permutation(chosen)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, y = batch(rows), target[rows]
            if mixtures:
                a, b = rng.permutation(len(rows)), rng.permutation(len(rows))
                two = (y[a] != y[b]).any(axis=1)
                a, b, share = a[two], b[two], rng.uniform(0.25, 0.75, (int(two.sum()), 1)).astype(np.float32)
                x, y = np.r_[x, share * x[a] + (1 - share) * x[b]], np.r_[y, share * y[a] + (1 - share) * y[b]]
            d = (1 / (1 + np.exp(-np.clip(x @ w, -40, 40))) - (y + 1) / 2) / len(x)
            g = x.T @ d
            g[:space] += 1e-4 * w[:space]
            step += 1
            m1 = 0.9 * m1 + 0.1 * g
            m2 = 0.99 * m2 + 0.01 * g * g
            w -= STEP * (1 - turn / passes) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return w[:space] * scale[:, None], w[space].astype(np.float64)
