import math
from collections import Counter

import numpy as np
import pytest
from cases import docs, fold, lower, odd_rows, words
from pyspark.sql import functions as F

from metascope.llm import lm
from metascope.llm.common import fold as fold_column
from metascope.llm.elias_fano import EliasFano, PairTrie, quantised, restored


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (5, 5), (900, 1 << 64), (900, 1 << 40), (5000, 6000), (300, 1 << 20)])
def test_sequences(n, universe):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
    coded = EliasFano(values, universe)
    assert (coded.values() == values).all()
    wanted = np.concatenate([values, rng.integers(0, universe - 1, 300, dtype=np.uint64, endpoint=True)])
    at = {int(v): i for i, v in enumerate(values)}
    assert coded.find(wanted).tolist() == [at.get(int(x), -1) for x in wanted]


def test_trie():
    rng = np.random.default_rng(2)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 1 << 40, 200), rng.integers(0, 50, 200), strict=True)} | {(7, int(b)) for b in range(500)})
    counts = rng.integers(1, 100_000, len(pairs))
    trie = PairTrie(np.asarray([p[0] for p in pairs]), np.asarray([p[1] for p in pairs]), counts)
    codes = trie.codes_of(np.asarray([p[0] for p in pairs] + [8, 7]), np.asarray([p[1] for p in pairs] + [1, 1 << 30]))
    assert (codes[:-2] == quantised(counts)).all() and not codes[-2:].any()
    assert (np.abs(np.log10(restored(codes[:-2]) / counts)) < 0.022).all()


@pytest.mark.parametrize("part_bytes", [1 << 22, 4000])
def test_odd_rows(spark, part_bytes):
    rows = [(r[0], words(lower(r[1] or "")) + [None]) for r in odd_rows()]
    learned = [w for i, w in rows if i is not None and fold(i, 7) != 2]
    c = Counter(x for w in learned for x in w)
    pairs = Counter(p for w in learned for p in zip(["<s>", *w], w, strict=False))
    total, vocabulary = sum(c.values()), len(c)

    def score(w):
        out = 0.0
        for before, x in zip(["<s>", *w], w, strict=False):
            p = 0.98 * c[x] / total if c[x] else 0.02
            out += math.log10((pairs[before, x] + 8 * p) / ((len(learned) if before == "<s>" else c[before]) + 8))
        return out

    found = lm.score_texts(docs(spark), fold_column(F.col("doc_id"), 7) != 2, part_bytes=part_bytes).collect()
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in found)
    want = [(str(i), len(w), sum(c[x] > 0 for x in w), round(sum(math.log10((c[x] + 1) / (total + vocabulary + 1)) for x in w), 6)) for i, w in rows]
    assert got == sorted(want) and {r["train_tokens"] for r in found} == {total}
    scores = {(r["doc_id"], r["n_tokens"]): r["score"] for r in found}
    for i, w in rows:
        assert abs(scores[i, len(w)] - score(w)) < 0.02 * len(w)


@pytest.mark.parametrize("most", [1 << 20, 3])
def test_distinct_words(spark, most):
    rows = docs(spark).select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(fold_column(F.col("doc_id"), 7) != 2, F.lit(False)).alias("train"))
    every = [([*words(lower(r["text"])), None], r["train"]) for r in rows.collect()]
    known = {x for w, train in every if train for x in w}
    assert lm.distinct_words(rows, most) == (len(known), len({x for w, _ in every for x in w} - known))


def test_unseen_words_share_their_mass(spark):
    clean = ["the cat sat on the mat", "the dog sat on the rug", "a cat and a dog ran", "the rug and the mat"]
    unseen = [f"zq{i}" for i in range(60)]
    rows = [(str(i), t) for i, t in enumerate(clean)] + [("clean", "the cat sat on a rug"), ("junk", "zq0 zq1 zq2 zq3 zq4 zq5")] + [(w, w) for w in [*unseen, "ran"]]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    found = lm.score_texts(frame, F.col("doc_id").rlike("^[0-9]$"), unknown=None).collect()
    scores = {r["doc_id"]: r["score"] for r in found}
    assert scores["junk"] < scores["clean"] and scores["zq5"] < scores["ran"]
    # Every training word, the end and one unseen word, after a begin: together 1.
    tokens = [x for t in clean for x in [*t.split(), None]]
    n, counts = len(tokens), Counter(tokens)
    n_words = len(counts) + 1
    p = {w: (counts[w] + 1) / (n + n_words) for w in [*counts, *unseen]}
    assert math.isclose(sum(p[w] for w in [*counts, unseen[0]]), 1)
    pairs = Counter(q for t in clean for q in zip([0, *t.split()], [*t.split(), None], strict=True))
    context = {0: len(clean), **counts}
    for r in found:
        w = [*dict(rows)[r["doc_id"]].split(), None]
        want = sum(math.log10((pairs[b, x] + 8 * p[x]) / (context.get(b, 0) + 8)) for b, x in zip([0, *w], w, strict=False))
        assert abs(r["score"] - want) < 1e-6


def test_other_texts_change_no_score(spark):
    """What is held out teaches nothing: more of it leaves all other rows as they are."""
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat", "the dog sat on the rug", "a cat ran", "unseen words here"])]
    more = [(10 + i, f"held out {i} zq{i} the cat sat") for i in range(40)]

    def scores(part):
        frame = spark.createDataFrame(part, "doc_id long, text string")
        found = lm.score_texts(frame, F.col("doc_id") < 3, unknown=None).collect()
        return {r["doc_id"]: (r["score"], r["base_score"], r["n_known"]) for r in found if r["doc_id"] < 10}

    assert scores(rows) == scores(rows + more)


def test_no_training_rows_and_no_rows(spark):
    found = lm.score_texts(docs(spark), F.lit(False)).collect()
    assert {(r["n_known"], r["base_score"], r["train_tokens"]) for r in found} == {(0, 0.0, 0)}
    assert lm.score_texts(docs(spark, []), F.lit(True)).count() == 0
