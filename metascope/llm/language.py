"""Language identification by a bidirectional gated recurrent network over bytes.

Both directions are gated recurrent units over windows of bytes, with gates and
candidates that are linear between their limits.  Every position gets a
distribution over languages from the two states there; a document's distribution
is the mean over all of its positions.  Training is backpropagation through time,
in numpy, on windows drawn from a bounded number of texts per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import others, packed, small_batches
from .words import slices, text_bytes

WINDOW = 64
HIDDEN = 8
BLOCK = 1024  # windows computed together


@dataclass
class Direction:
    """Weights of one direction: a row of inputs for each byte, and the recurrent matrices."""

    inputs: np.ndarray  # (256, 3H): update, reset, candidate; biases included
    gates: np.ndarray  # (H, 2H)
    candidate: np.ndarray  # (H, H)

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.gates, self.candidate]

    def states(self, bytes_: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (T, B, H) after each step over bytes (T, B); ``keep`` collects what the way back needs."""
        steps, batch = bytes_.shape
        n = len(self.candidate)
        out = np.empty((steps, batch, n), np.float32)
        h = np.zeros((batch, n), np.float32)
        for t in range(steps):
            x = self.inputs[bytes_[t]]
            raw = h @ self.gates
            raw += x[:, : 2 * n]
            gate = np.clip(raw, 0, 1)
            reset = gate[:, n:] * h
            pre = reset @ self.candidate
            pre += x[:, 2 * n :]
            new = np.clip(pre, -1, 1)
            if keep is not None:
                keep.append((h, raw, gate, reset, pre, new))
            h = new + gate[:, :n] * (h - new)
            out[t] = h
        return out

    def back(self, bytes_: np.ndarray, keep: list, d_out: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights from those of the states."""
        n = len(self.candidate)
        d_inputs, d_gates, d_candidate = (np.zeros_like(a) for a in self.arrays())
        d_h = np.zeros(d_out.shape[1:], np.float32)
        for t in range(len(d_out) - 1, -1, -1):
            h, raw, gate, reset, pre, new = keep[t]
            d_h = d_h + d_out[t]
            d_pre = d_h * (1 - gate[:, :n]) * (np.abs(pre) < 1)
            d_reset = d_pre @ self.candidate.T
            d_raw = np.concatenate([d_h * (h - new), d_reset * h], axis=1) * ((raw > 0) & (raw < 1))
            d_candidate += reset.T @ d_pre
            d_gates += h.T @ d_raw
            np.add.at(d_inputs, bytes_[t], np.concatenate([d_raw, d_pre], axis=1))
            d_h = d_h * gate[:, :n] + d_reset * gate[:, n:] + d_raw @ self.gates.T
        return [d_inputs, d_gates, d_candidate]


@dataclass
class LanguageModel:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # (2H, K)
    bias: np.ndarray

    def positions(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities (T, B, K) at every position of windows (B, T)."""
        x = np.ascontiguousarray(windows.T)
        both = np.concatenate([self.forward.states(x), self.backward.states(x[::-1])[::-1]], axis=2)
        return _softmax(both @ self.out + self.bias)

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The mean of the positions' probabilities for each text; zeros for an empty one."""
        lengths = np.diff(offsets)
        n_windows = -(-lengths // WINDOW)
        first = np.concatenate([[0], np.cumsum(n_windows)])
        windows, real = np.zeros(first[-1] * WINDOW, np.uint8), np.zeros(first[-1] * WINDOW, bool)
        to = np.arange(len(data)) + np.repeat(first[:-1] * WINDOW - (offsets[:-1] - offsets[0]), lengths)
        windows[to], real[to] = data, True
        windows, real = windows.reshape(-1, WINDOW), real.reshape(-1, WINDOW)
        sums = np.zeros((len(windows), len(self.languages)))
        for lo in range(0, len(windows), BLOCK):
            p = self.positions(windows[lo : lo + BLOCK])
            sums[lo : lo + BLOCK] = np.einsum("tbk,tb->bk", p, np.ascontiguousarray(real[lo : lo + BLOCK].T).astype(np.float32))
        doc = np.repeat(np.arange(len(lengths)), n_windows)
        total = np.stack([np.bincount(doc, sums[:, k], len(lengths)) for k in range(len(self.languages))], axis=1)
        return total / np.maximum(lengths, 1)[:, None]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, languages: list[str], steps: int, seed: int = 7) -> LanguageModel:
    """Adam on the cross entropy of every position; windows (N, T) of which the first ``lengths`` bytes are text."""
    rng = np.random.default_rng(seed)
    h, k = HIDDEN, len(languages)

    def direction() -> Direction:
        inputs = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)
        inputs[:, : 2 * h] += 0.5
        return Direction(inputs, rng.normal(0, 0.1, (h, 2 * h)).astype(np.float32), rng.normal(0, 0.3, (h, h)).astype(np.float32))

    model = LanguageModel(languages, direction(), direction(), rng.normal(0, 0.3, (2 * h, k)).astype(np.float32), np.zeros(k, np.float32))
    weights = model.forward.arrays() + model.backward.arrays() + [model.out, model.bias]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    of = [np.flatnonzero(labels == i) for i in range(k)]
    for step in range(1, steps + 1):
        # Languages take turns, however many windows each has.
        batch = np.concatenate([rng.choice(one, max(1, 256 // k)) for one in of])
        x = np.ascontiguousarray(windows[batch].T)
        real = (np.arange(WINDOW)[:, None] < lengths[batch][None, :]).astype(np.float32)
        kept_f, kept_b = [], []
        ahead, behind = model.forward.states(x, kept_f), model.backward.states(x[::-1], kept_b)[::-1]
        both = np.concatenate([ahead, behind], axis=2)
        d = _softmax(both @ model.out + model.bias)
        d[:, np.arange(len(batch)), labels[batch]] -= 1
        d *= (real / max(real.sum(), 1))[:, :, None]
        d_both = d @ model.out.T
        grads = model.forward.back(x, kept_f, d_both[:, :, :h])
        grads += model.backward.back(x[::-1], kept_b, d_both[::-1, :, h:])
        grads += [np.einsum("tbh,tbk->hk", both, d), d.sum(axis=(0, 1))]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * (1 - 0.9 * step / steps)
        for w, g, m_, v_ in zip(weights, grads, m, v, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m_ += 0.1 * (g - m_)
            v_ += 0.01 * (g * g - v_)
            w -= rate * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.99**step)) + 1e-8)
    return model


def train(
    docs: DataFrame, use: Column, text: str = "text", lang: str = "lang", id_column: str = "doc_id",
    texts_per_language: int = 150, windows_per_text: int = 12, max_texts: int = 30_000, steps: int = 250,
) -> LanguageModel | None:
    """Fits on rows for which ``use`` is true and ``lang`` isn't NULL.

    Every language is learned.  Of each one ``texts_per_language`` texts at most, chosen
    by a hash of the id and the text, give ``windows_per_text`` windows each, from all
    over the text; with very many languages fewer texts, so that they are some
    ``max_texts`` together, but one of each at least.  None if there is no such row.
    """
    rows = docs.filter(use & F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = [(r[0], r[1]) for r in rows.groupBy(lang).count().collect()]
    if not counts:
        return None
    languages = sorted(name for name, _ in counts)
    texts_per_language = max(1, min(texts_per_language, max_texts // len(languages)))
    # A row per language.
    shares = docs.sparkSession.createDataFrame([(name, min(1.0, (1.5 * texts_per_language + 30) / n)) for name, n in counts], "lang string, share double")
    place = F.shiftrightunsigned(F.xxhash64(F.lit(11), F.col(id_column), F.col(text)), 12) / F.lit(float(1 << 52))
    # Windows of characters, each at a place of its own; most are shorter than the network's in bytes.
    span = WINDOW * 3 // 4
    places = F.transform(
        F.sequence(F.lit(1), F.lit(windows_per_text)),
        lambda i: F.substring(F.col("text"), (F.pmod(F.xxhash64(i, F.col("text")), F.greatest(F.lit(1), F.length("text") - span + 1)) + 1).cast("int"), F.lit(span)),
    )
    drawn = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), place.alias("place")).join(F.broadcast(shares), "lang").filter("place < share")
    drawn = drawn.select("lang", "place", places.alias("windows"))
    first = Window.partitionBy("lang").orderBy("place")
    drawn = drawn.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= texts_per_language).orderBy("lang", "place")
    windows, lengths, labels = [], [], []
    for row in drawn.select("lang", "windows").collect():
        for piece in row["windows"]:
            raw = piece.encode()[:WINDOW]
            windows.append(np.frombuffer(raw.ljust(WINDOW, b"\0"), np.uint8))
            lengths.append(len(raw))
            labels.append(languages.index(row["lang"]))
    if not windows:
        return None
    return fit(np.stack(windows), np.asarray(lengths), np.asarray(labels), languages, steps)


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the mean probability of that language over all positions of the text.

    A text that is NULL or has no letter is ``und`` with score 0, and so is every
    text without a model.  Of equally likely languages the first by name counts.
    Repeated rows come back as often, with equal results.  The added columns take the
    place of columns of their names, in any case.  An empty table gives an empty one.
    """
    names = others(docs, "lang_pred", "score")
    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    if model is None:
        return kept.select("*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    small_batches(docs.sparkSession)
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(packed(names).alias("doc"), F.col(text).alias("text"), lettered.alias("lettered"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = np.asarray([*model.languages, "und"], object)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for lo, hi in slices(offsets):
                p = model.documents(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
                best[lo:hi], score[lo:hi] = p.argmax(axis=1), p.max(axis=1)
            spoken = batch.column("lettered").to_numpy(zero_copy_only=False)
            best[~spoken], score[~spoken] = len(model.languages), 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(languages[best], pa.string()), pa.array(np.clip(score, 0, 1))], names=["doc", "lang_pred", "score"]
            )

    schema = rows.select("doc").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(predict, schema).select("doc.*", "lang_pred", "score")
