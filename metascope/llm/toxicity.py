"""Toxicity by a support vector machine over gapped subsequences, with Nyström landmarks.

The kernel compares words by their subsequences of three letters within a short
span; a gap costs a factor, so a letter put into an insult, or dots between its
letters, change little.  Words are folded first: marks are dropped, digits that
stand for letters are read as such, and letters standing alone are joined.

Labels are of documents; the words that decide are found as word beginnings far
more frequent in toxic texts than chance allows.  The machine is trained on words
of toxic and of clean texts in the space of the landmarks, with the clean words
that it takes for insults added in rounds.  As the kernel has explicit features,
the trained machine is one weight per subsequence.

Subsequences also run over neighbouring words: up to three that together have no
more than the longest number of letters are a window, read without its spaces.
So an insult split by spaces counts as if it were whole.  Windows of toxic texts
that clean ones hardly have are trained on as well, also if each of their words is
ordinary, and so are the clean windows most like insults.  A text is as toxic as
its worst word or window.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import one_per_id, others, packed, small_batches
from .words import slices, text_bytes

SPAN, DECAY, LONGEST = 5, 0.6, 12
GAPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b <= SPAN]
NEIGHBOURS = 3
FEATURES = 1 << 15
_DROP = 255

# Codes of bytes: 0 ends a word, 1 to 26 letters, 27 other digits, 28 to 30 bytes beyond ASCII.
_CODE = np.full(256, _DROP, np.uint8)
_CODE[[9, 10, 11, 12, 13, 32]] = 0
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 28 + (np.arange(128, 256) & 31) % 3
_CODE[48:58] = 27
for _digit, _letter in zip(b"013457", b"oieast", strict=True):  # digits read as letters
    _CODE[_digit] = _letter - 96


class Folded:
    """Words of texts as codes: a flat array in which a 0 stands before, between and after words."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.n_docs = n = len(ends)
        starts = np.concatenate([[0], ends[:-1]])
        doc = np.repeat(np.arange(n), ends - starts)
        codes, docs = np.zeros(len(data) + n, np.uint8), np.empty(len(data) + n, np.int64)
        codes[np.arange(len(data)) + doc] = _CODE[data]
        docs[:] = np.repeat(np.arange(n), ends - starts + 1)
        kept = codes != _DROP
        codes, docs = codes[kept], docs[kept]
        after_end = np.append(True, codes[:-1] == 0)[: len(codes)]
        kept = ~((codes == 0) & after_end)
        codes, docs = codes[kept], docs[kept]
        stops = np.flatnonzero(codes == 0)
        length = np.diff(np.append(-1, stops)) - 1
        # Three or more letters alone in a row are one word.
        alone = np.append(length == 1, False)
        alone[:-1] &= True
        own = docs[stops]
        joins = alone[:-2] & alone[1:-1] & (own[:-1] == own[1:]) if len(stops) > 1 else np.zeros(0, bool)
        if joins.any():
            edge = np.diff(np.concatenate([[0], joins.astype(np.int8), [0]]))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            long_ = last - first >= 2
            gone = np.zeros(len(joins) + 1, np.int64)
            gone[first[long_]] += 1
            gone[last[long_]] -= 1
            codes = np.delete(codes, stops[:-1][np.cumsum(gone)[:-1] > 0]) if long_.any() else codes
            docs = np.delete(docs, stops[:-1][np.cumsum(gone)[:-1] > 0]) if long_.any() else docs
        self.codes = np.append(np.uint8(0), codes)
        stops = np.flatnonzero(self.codes == 0)
        self.start, self.stop = stops[:-1], stops[1:]  # the ends before and after each word
        self.doc = docs[self.stop - 1] if len(self.stop) else np.zeros(0, np.int64)

    def windows(self, many: int) -> Folded:
        """So many neighbouring words of a text read as one, where that is not longer than the longest."""
        out = object.__new__(Folded)
        out.n_docs, n = self.n_docs, max(len(self.start) - many + 1, 0)
        first, last = np.arange(n), np.arange(n) + many - 1
        length = self.stop[last] - self.start[first] - many
        kept = (self.doc[first] == self.doc[last]) & (length >= 3) & (length <= LONGEST)
        first, last, length = first[kept], last[kept], length[kept]
        # All between the ends of a window but the ends between its words.
        spread = length + many
        begin = np.cumsum(spread) - spread
        at = np.arange(spread.sum()) + np.repeat(self.start[first] - begin, spread)
        codes = self.codes[at]
        codes[begin] = 0
        inner = np.ones(len(codes), bool)
        inner[begin] = False
        out.codes = np.append(codes[(codes != 0) | ~inner], np.uint8(0))
        out.start = np.cumsum(length + 1) - length - 1
        out.stop = out.start + length + 1
        out.doc = self.doc[first]
        return out

    def words(self) -> list[bytes]:
        raw = (self.codes + 96).astype(np.uint8).tobytes()
        return [raw[a + 1 : b] for a, b in zip(self.start.tolist(), self.stop.tolist(), strict=True)]


def norms() -> np.ndarray:
    """The length of a word's feature vector by its number of letters, up to the longest."""
    out = np.ones(LONGEST + 1)
    for n in range(1, LONGEST + 1):
        out[n] = max(1.0, math.sqrt(sum(max(0, n + 2 - a - b) * DECAY ** (2 * (a + b - 2)) for a, b in GAPS)))
    return out


_NORMS = norms()


def subsequences(codes: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """For each pair of gaps its weight, the feature at each place, and where it is within one word."""
    n = len(codes)
    wide = codes.astype(np.int32)
    ends = np.cumsum(codes == 0)
    for a, b in GAPS:
        m = n - a - b
        if m > 0:
            # No end lies strictly between the first letter and the last.
            within = ends[a + b - 1 : n - 1] == ends[:m]
            yield DECAY ** (a + b - 2), wide[:m] << 10 | wide[a : a + m] << 5 | wide[a + b :], within


def vector(word: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of a word of up to the longest number of letters, and their weights; of unit length."""
    codes = np.concatenate([[0], np.frombuffer(word, np.uint8) - 96, [0]]).astype(np.uint8)
    found, weights = [], []
    for weight, feature, within in subsequences(codes):
        found.append(feature[within])
        weights.append(np.full(int(within.sum()), weight))
    index = np.concatenate(found) if found else np.zeros(0, np.int32)
    return index, (np.concatenate(weights) if weights else np.zeros(0)) / _NORMS[min(len(word), LONGEST)]


@dataclass
class ToxicityModel:
    weights: np.ndarray  # of subsequences
    offset: float
    slope: float
    level: float

    def margins(self, folded: Folded) -> np.ndarray:
        """The margin of the worst word or window of each text; -3 for a text without words."""
        worst = self.of_words(folded)
        for many in range(2, NEIGHBOURS + 1):
            worst = np.maximum(worst, self.of_words(folded.windows(many)))
        return worst

    def of_words(self, folded: Folded) -> np.ndarray:
        """The margin of the worst word of each text, its neighbours aside."""
        worst = np.full(folded.n_docs, -3.0)
        if not len(folded.start):
            return worst
        value = np.zeros(len(folded.codes))
        for weight, feature, within in subsequences(folded.codes):
            value[: len(feature)] += np.where(within, self.weights[feature], 0.0) * weight
        total = np.append(0.0, np.cumsum(value))
        # Of a longer word every stretch of the longest length counts, so that nothing is diluted.
        length = folded.stop - folded.start - 1
        stretches = np.maximum(length - LONGEST, 0) + 1
        begin = np.repeat(folded.start, stretches) + np.arange(stretches.sum()) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        end = np.minimum(begin + LONGEST + 2, np.repeat(folded.stop, stretches))
        scores = (total[end] - total[begin]) / np.repeat(_NORMS[np.minimum(length, LONGEST)], stretches) + self.offset
        np.maximum.at(worst, np.repeat(folded.doc, stretches), scores)
        return np.maximum(worst, -3.0)

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.level, -30, 30)))


def telling_words(toxic: list[set[bytes]], clean: list[set[bytes]]) -> Counter:
    """Words of toxic texts with a beginning that clean texts hardly have, and how many texts have them."""

    def counted(texts: list[set[bytes]]) -> Counter:
        counts: Counter = Counter()
        for words in texts:
            counts.update({w[:n] for w in words for n in (3, 4, 5, 6) if len(w) >= n} | {w + b"$" for w in words})
        return counts

    t, c = counted(toxic), counted(clean)
    share = len(toxic) / (len(toxic) + len(clean))
    least = math.log(100 * (len(t) + 1))
    telling = set()
    for prefix, n in t.items():
        both = n + c[prefix]
        if n >= 4 and n >= 0.9 * both:
            odds = n * math.log(n / both / share) + (both - n) * math.log(max(both - n, 1e-9) / both / (1 - share))
            if odds > least:
                telling.add(prefix)
    found: Counter = Counter()
    for words in toxic:
        found.update(w for w in words if w + b"$" in telling or any(w[:n] in telling for n in (3, 4, 5, 6) if len(w) >= n))
    return found


def telling_windows(toxic: list[set[bytes]], clean: list[set[bytes]], told: Counter) -> Counter:
    """Windows of toxic texts that clean texts hardly have, without words that tell by themselves."""
    t = Counter(w for windows in toxic for w in windows)
    often = {w for w, n in t.items() if n >= 4}
    c = Counter(w for windows in clean for w in windows if w in often)
    share = len(toxic) / (len(toxic) + len(clean))
    least = math.log(100 * (len(t) + 1))
    found: Counter = Counter()
    for window in often:
        n, other = t[window], c[window]
        if n >= 0.9 * (n + other) and not any(w in window for w in told if len(w) >= 3):
            odds = n * math.log(n / (n + other) / share) + other * math.log(max(other, 1e-9) / (n + other) / (1 - share))
            if odds > least:
                found[window] = n
    return found


def _flat(words: list[bytes]) -> Folded:
    """Each word as a text of its own."""
    out = object.__new__(Folded)
    out.n_docs, out.doc = len(words), np.arange(len(words))
    out.codes = np.frombuffer(b"`".join([b"", *words, b""]), np.uint8) - 96
    stops = np.flatnonzero(out.codes == 0)
    out.start, out.stop = stops[:-1], stops[1:]
    return out


def _matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, index, weight = [], [], []
    for row, word in enumerate(words):
        i, w = vector(word)
        rows.append(np.full(len(i), row))
        index.append(i)
        weight.append(w)
    return np.concatenate(rows), np.concatenate(index), np.concatenate(weight)


def _damaged(words: list[bytes], rng: np.random.Generator) -> list[bytes]:
    """Each word with a letter put in somewhere inside."""
    out = []
    for word in words:
        at = int(rng.integers(1, max(2, len(word))))
        out.append(word[:at] + bytes([int(rng.integers(97, 123))]) + word[at:])
    return out


def fit(
    toxic: list[set[bytes]], clean: list[set[bytes]], landmarks: int, rounds: int, seed: int = 3,
    toxic_windows: list[set[bytes]] | None = None, clean_windows: list[set[bytes]] | None = None,
) -> ToxicityModel | None:
    toxic_windows, clean_windows = toxic_windows or [set()] * len(toxic), clean_windows or [set()] * len(clean)
    rng = np.random.default_rng(seed)
    toxic, clean = ([{w[:LONGEST] for w in words} for words in texts] for texts in (toxic, clean))
    told = telling_words(toxic, clean)
    told += telling_windows(toxic_windows, clean_windows, told)
    found = sorted((w for w in told if len(w) >= 3), key=lambda w: (-told[w], w))[:2000]
    seen = Counter(w for words in clean for w in words if len(w) >= 2 and w not in told)
    vocabulary = sorted(seen, key=lambda w: (-seen[w], w))
    if not found or not vocabulary:
        return None

    # Landmarks: the most frequent insults, others far from those already taken, and clean words.
    def dense(words: list[bytes]) -> np.ndarray:
        rows, index, weight = _matrix(words)
        out = np.zeros((len(words), FEATURES), np.float32)
        np.add.at(out, (rows, index), weight)
        return out

    pool = found[:1000]
    rows, index, weight = _matrix(pool)
    nearest, chosen = np.zeros(len(pool)), []
    while len(chosen) < min(landmarks // 2, len(pool)):
        best = int(np.argmin(nearest)) if len(chosen) >= landmarks // 6 else len(chosen)
        chosen.append(best)
        nearest = np.maximum(nearest, np.bincount(rows, weight * dense([pool[best]])[0][index], len(pool)))
    # The most frequent clean words, and as many of the others.
    rest = vocabulary[12_000:]
    every = vocabulary[:12_000] + [rest[i] for i in rng.permutation(len(rest))[:12_000]]
    others = [every[i] for i in rng.permutation(len(every))[: landmarks - len(chosen)]]
    damaged = found + _damaged(found, rng)
    common = np.sqrt([seen[w] for w in every])
    heard = np.asarray([told[w] for w in found], float)
    heard = np.concatenate([heard, 0.3 * heard]) / (1.3 * heard.sum())
    for last in (False, True):
        base = dense([pool[i] for i in chosen] + others)
        values, vectors = np.linalg.eigh(base @ base.T + 1e-3 * np.eye(len(base)))
        root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
        to_space = (base.T @ root).astype(np.float32)  # (FEATURES, landmarks)

        def mapped(words: list[bytes], to_space: np.ndarray = to_space) -> np.ndarray:
            out = []
            for lo in range(0, len(words), 500):
                out.append(dense(words[lo : lo + 500]) @ to_space)
            return np.concatenate(out)

        positive, everything = mapped(damaged), mapped(every)
        taken = np.zeros(len(every), bool)
        taken[rng.permutation(len(every))[:2000]] = True
        w, offset = np.zeros(len(base)), 0.0
        for _ in range(rounds if last else 1):
            hard = everything[taken]
            x = np.concatenate([positive, hard])
            y = np.concatenate([np.ones(len(positive)), -np.ones(len(hard))])
            # A clean word taken for an insult spoils every text that has it: those weigh more.
            cost = np.concatenate([heard, 5.0 * common[taken] / common[taken].sum()])
            w, offset = _hinge(x, y, cost, w, offset)
            margin = everything @ w + offset
            worst = np.argsort(-margin)[:4000]
            taken[worst[margin[worst] > -1.2]] = True
        # The second time the clean words most like insults are landmarks.
        others = [every[i] for i in worst[: landmarks - len(chosen)]]
    # Then the clean windows that it takes for insults.
    between = Counter(w for windows in clean_windows for w in windows if w not in told)
    joined = sorted(between)
    near: set[int] = set()
    for _ in range(rounds if joined else 0):
        margin = np.concatenate([ToxicityModel(to_space @ w, offset, 1.0, 0.0).of_words(_flat(joined[i : i + 100_000])) for i in range(0, len(joined), 100_000)])
        worst = np.argsort(-margin)[:2000]
        near.update(worst[margin[worst] > -1.2].tolist())
        if near:
            x = np.concatenate([positive, everything[taken], mapped([joined[i] for i in sorted(near)])])
            y = np.concatenate([np.ones(len(positive)), -np.ones(len(x) - len(positive))])
            weight = np.concatenate([common[taken], np.sqrt([between[joined[i]] for i in sorted(near)])])
            w, offset = _hinge(x, y, np.concatenate([heard, 5.0 * weight / weight.sum()]), w, offset)
    weights = to_space @ w

    # The margin's meaning: logistic regression on the sample's own texts.
    model = ToxicityModel(weights, float(offset), 1.0, 0.0)
    margins = []
    for texts, windows in ((toxic, toxic_windows), (clean, clean_windows)):
        for words, between_words in zip(texts, windows, strict=True):
            every_one = [*words, *between_words]
            margins.append(model.of_words(_flat(every_one)).max() if every_one else -3.0)
    margins_, y = np.asarray(margins), np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    model.slope, model.level = _logistic(margins_, y)
    return model


def _hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, w: np.ndarray, offset: float, steps: int = 300, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Averaged subgradient descent on the hinge loss."""
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    full, mean = np.append(w, offset), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        active = (y * (x @ full[:-1] + full[-1]) < 1) * cost * y
        grad = np.append(-x.T @ active + l2 * full[:-1], -active.sum())
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        full = full - 0.05 / math.sqrt(1 + step / 50) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        if step > steps * 2 // 3:
            mean += full / (steps - steps * 2 // 3)
    return mean[:-1], float(mean[-1])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level by Newton steps."""
    a, b = 1.0, 0.0
    cost = np.full(len(y), 1.0 / max(len(y), 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = cost * (p - y), cost * p * (1 - p) + 1e-9
        grad = np.array([(g * x).sum() + 1e-3 * a, g.sum()])
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
    return float(max(a, 0.1)), float(b)


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
    max_toxic: int = 800, max_clean: int = 2400, landmarks: int = 256, rounds: int = 4,
) -> ToxicityModel | None:
    """Fits on labels (id, toxic 0/1): at most so many of each kind, in the order of a hash of the id.

    A document labelled more than once is toxic if any label says so; NULLs are
    left out.  Of rows with the same id one counts, that with the least hash of its text.  None without both kinds, or if no words tell them apart.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(F.col(id_column).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(id_column).alias("labelled_id")).agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("labelled_id"), F.col("labelled_id")]
    sample = known.filter("toxic = 1").orderBy(*order).limit(max_toxic).union(known.filter("toxic = 0").orderBy(*order).limit(max_clean))
    # The sample is bounded by its limits, so it may be broadcast.
    texts = docs.select(F.col(id_column).alias("labelled_id"), F.col(text).alias("text")).join(F.broadcast(sample), "labelled_id")
    texts = one_per_id(texts, "labelled_id", "toxic", "text")

    def distinct(parts: list[Folded], n: int) -> list[bytes]:
        out: list[set[bytes]] = [set() for _ in range(n)]
        for part in parts:
            for doc, word in zip(part.doc.tolist(), part.words(), strict=True):
                out[doc].add(word)
        return [b" ".join(sorted(x)) for x in out]

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            found, between = [], []
            for lo, hi in slices(offsets):
                folded = Folded(data[offsets[lo] : offsets[hi]], offsets[lo + 1 : hi + 1] - offsets[lo])
                found += distinct([folded], hi - lo)
                between += distinct([folded.windows(many) for many in range(2, NEIGHBOURS + 1)], hi - lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic").cast(pa.int32()), pa.array(found, pa.binary()), pa.array(between, pa.binary())], names=["toxic", "words", "windows"]
            )

    rows = texts.mapInArrow(words, "toxic int, words binary, windows binary").toArrow()
    split: tuple[tuple[list, list], tuple[list, list]] = ([], []), ([], [])
    same: dict[bytes, bytes] = {}  # equal words of all texts are one object
    for toxic, *found in sorted(zip(*(rows.column(c).to_pylist() for c in ("toxic", "words", "windows")), strict=True)):
        for kind, every in zip(split[toxic], found, strict=True):
            kind.append({same.setdefault(w, w) for w in every.split()})
    (clean, clean_windows), (toxic_, toxic_windows) = split
    return fit(toxic_, clean, landmarks, rounds, toxic_windows=toxic_windows, clean_windows=clean_windows) if toxic_ and clean else None


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score``, the probability of toxicity, and ``predicted``, 1 from ``threshold`` on.

    The whole text counts.  NULL and empty texts, and texts without letters or
    digits, get the score of the lowest margin.  Without a model every score is 0.
    Repeated rows come back as often, with equal scores.  The added columns take the
    place of columns of their names, in any case.  An empty table gives an empty one.
    """
    names = others(docs, "score", "predicted")
    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    if model is None:
        return kept.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    small_batches(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            out = np.zeros(batch.num_rows)
            for lo, hi in slices(offsets):
                folded = Folded(data[offsets[lo] : offsets[hi]], offsets[lo + 1 : hi + 1] - offsets[lo])
                out[lo:hi] = model.probabilities(model.margins(folded))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out), pa.array((out >= threshold).astype(np.int32))], names=["doc", "score", "predicted"])

    rows = docs.select(packed(names).alias("doc"), F.col(text).alias("text"))
    schema = rows.select("doc").schema.add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(score, schema).select("doc.*", "score", "predicted")
