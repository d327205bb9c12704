"""Quality classifier: ordinal cumulative-link regression over hashed text.

All grades share one weight per hashed feature; ordered thresholds separate them:
P(grade <= k) = sigmoid(threshold_k - w.x).  Features are shares of a document's
words: the word itself, the kinds of characters at its ends, and whether it
repeats the word before it or two before.  The model is fitted by Adam on the
whole sample of rated texts, whose size is bounded by ``max_rated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_caches, one_per_id, others, packed, small_batches
from .words import BASE, Words, mix, words_of

WORD_BITS, SHAPE_BITS = 15, 12
_SHAPES = 1 << WORD_BITS
_REPEATS = _SHAPES + (1 << SHAPE_BITS)
FEATURES = _REPEATS + 2

# Kinds of bytes: small letters (and all bytes beyond ASCII), capitals, digits; others stand for themselves.
_KIND = np.arange(256, dtype=np.uint64)
_KIND[97:123] = _KIND[128:] = 97
_KIND[65:91] = 65
_KIND[48:58] = 48


def features(words: Words) -> np.ndarray:
    """A row of feature numbers for each word; -1 for none."""
    h, doc = words.hash, words.doc
    out = np.full((len(h), 4), -1, np.int32)
    out[:, 0] = h >> np.uint64(64 - WORD_BITS)
    last = words.end - 1
    shape = _KIND[words.data[words.start]]
    for back in range(3):
        shape = shape * np.uint64(256) + _KIND[words.data[np.maximum(last - back, words.start)]]
    out[:, 1] = _SHAPES + (mix(shape * np.uint64(BASE)) >> np.uint64(64 - SHAPE_BITS)).astype(np.int32)
    for back in (1, 2):
        same = (h[back:] == h[:-back]) & (doc[back:] == doc[:-back])
        out[back:, 1 + back][same] = _REPEATS + back - 1
    return out


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """w.x of each text."""
        w = np.append(self.weights, 0.0)
        per_word = w[features(words)].sum(axis=1)
        return np.bincount(words.doc, per_word, words.n_docs) / np.maximum(words.count(), 1)

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. as columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -30, 30)))


def fit(rows: np.ndarray, index: np.ndarray, share: np.ndarray, grades: np.ndarray, n_grades: int, steps: int, l2: float) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty; thresholds stay ordered by exponentiated gaps."""
    n = len(grades)
    w = np.zeros(FEATURES)
    counts = np.bincount(grades, minlength=n_grades)
    below = np.clip(np.cumsum(counts)[:-1] / max(n, 1), 0.01, 0.99)
    start = np.log(below / (1 - below))
    raw = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.05))])
    moments = [np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(len(raw)), np.zeros(len(raw))]
    for step in range(1, steps + 1):
        gaps = np.exp(raw[1:])
        thresholds = raw[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(rows, share * w[index], n)
        padded = np.concatenate([[-np.inf], thresholds, [np.inf]])
        high = 1 / (1 + np.exp(-np.clip(padded[grades + 1] - eta, -30, 30)))
        low = 1 / (1 + np.exp(-np.clip(padded[grades] - eta, -30, 30)))
        p = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        d_eta = (d_high - d_low) / n  # of the negative log likelihood
        d_w = np.bincount(index, share * d_eta[rows], FEATURES) + l2 * w
        d_t = np.zeros(len(thresholds) + 2)
        np.add.at(d_t, grades + 1, -d_high / n)
        np.add.at(d_t, grades, d_low / n)
        d_t = d_t[1:-1]
        tail = np.cumsum(d_t[::-1])[::-1]
        d_raw = np.concatenate([tail[:1], tail[1:] * gaps])
        for value, grad, at, rate in ((w, d_w, 0, 0.3), (raw, d_raw, 2, 0.05)):
            m, v = moments[at], moments[at + 1]
            m += 0.1 * (grad - m)
            v += 0.02 * (grad * grad - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-8)
    thresholds = raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])
    return OrdinalModel(w, thresholds)


def rated_features(texts: DataFrame, text: str) -> DataFrame:
    """Grade, and the features of the text with their shares of its words."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            grades, index, share = batch.column("grade").to_pylist(), [], []
            for lo, hi, words in words_of(batch.column("text"), lower=True):
                per_word, bounds = features(words), words.bounds()
                for i in range(hi - lo):
                    used = per_word[bounds[i] : bounds[i + 1]]
                    found, n = np.unique(used[used >= 0], return_counts=True)
                    index.append(found.astype(np.int32))
                    share.append((n / max(len(used), 1)).astype(np.float32))
            yield pa.RecordBatch.from_pydict(
                {
                    "grade": pa.array(grades, pa.int32()),
                    "index": pa.array(index, pa.list_(pa.int32())),
                    "share": pa.array(share, pa.list_(pa.float32())),
                }
            )

    return texts.select(F.col("grade").cast("int").alias("grade"), F.col(text).alias("text")).mapInArrow(
        extract, "grade int, index array<int>, share array<float>"
    )


def train(
    docs: DataFrame, ratings: DataFrame, id_column: str = "doc_id", text: str = "text", max_rated: int = 6000, steps: int = 150, l2: float = 1e-5
) -> OrdinalModel | None:
    """Fits on at most ``max_rated`` ratings (id, grade 0, 1, ...), taken in the order of a hash of the id.

    A document rated more than once counts with its lowest grade; NULL ids and
    grades are left out.  Of rows with the same id one counts, that with the least
    hash of its text.  None if fewer than two grades are left.
    """
    small_batches(docs.sparkSession)
    rated = ratings.filter(F.col(id_column).isNotNull() & F.col("grade").isNotNull() & (F.col("grade") >= 0))
    rated = rated.groupBy(F.col(id_column).alias("rated_id")).agg(F.min("grade").alias("grade"))
    sample = rated.orderBy(F.xxhash64("rated_id"), "rated_id").limit(max_rated)
    # The sample is bounded by its limit, so it may be broadcast.
    texts = docs.select(F.col(id_column).alias("rated_id"), F.col(text).alias(text)).join(F.broadcast(sample), "rated_id")
    texts = one_per_id(texts, "rated_id", "grade", text)
    found = rated_features(texts, text).toArrow()
    grades = found.column("grade").to_numpy().astype(int)
    if len(np.unique(grades)) < 2:
        return None
    lengths = np.asarray([len(x) for x in found.column("index").to_pylist()])
    index = found.column("index").combine_chunks().flatten().to_numpy()
    share = found.column("share").combine_chunks().flatten().to_numpy().astype(float)
    return fit(np.repeat(np.arange(len(grades)), lengths), index, share, grades, int(grades.max()) + 1, steps, l2)


def grade_quality(
    docs: DataFrame, model: OrdinalModel | None, text: str = "text", at_least: int = 1, threshold: float = 0.5
) -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_prob``, P(grade >= ``at_least``), and ``kept``: tail_prob >= ``threshold``.

    The whole text counts.  A NULL text, or one without words, has grade 0 and
    tail_prob 0.  Without a model all grades are NULL and every row is kept.
    Repeated rows come back as often, with equal grades.  The added columns take the
    place of columns of their names, in any case.  An empty table gives an empty one.
    """
    added = {"expected_grade": "double", "tail_prob": "double", "kept": "boolean"}
    names = others(docs, *added)
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(*[F.col(f"`{c}`") for c in names], none.alias("expected_grade"), none.alias("tail_prob"), F.lit(True).alias("kept"))
    small_batches(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            n = batch.num_rows
            expected, tail = np.zeros(n), np.zeros(n)
            for lo, hi, words in words_of(batch.column("text")):
                p = model.at_least(model.scores(words)) * (words.count() > 0)[:, None]
                expected[lo:hi], tail[lo:hi] = p.sum(axis=1), p[:, at_least - 1]
            arrays = [batch.column("doc"), pa.array(expected), pa.array(tail), pa.array(tail >= threshold)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", *added])

    rows = docs.select(packed(names).alias("doc"), F.col(text).alias("text"))
    schema = rows.select("doc").schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return rows.mapInArrow(score, schema).select("doc.*", *added)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades of the labels: 0 low quality, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))
