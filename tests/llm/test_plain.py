"""Operators without SQL against plain versions, and columns whose names clash."""

import math
from collections import defaultdict

import numpy as np
import pytest
from cases import docs, lower, odd_rows, plain, prose, words
from pyspark.sql import functions as F

from metascope.llm import jaccard, language, line_dedup, mixing, quality, substrings, toxicity
from metascope.llm.words import BASE, Words, mix


def word_hash(word):
    data = np.frombuffer(word.encode(), np.uint8)
    return int(Words(data, np.asarray([len(data)]), False).hash[0])


def test_grades_of_each_word(spark):
    """Every text's grades by a loop over its words, with the model's weights."""
    rng = np.random.default_rng(8)
    model = quality.OrdinalModel(rng.normal(0, 3, quality.FEATURES), np.asarray([-0.5, 0.25]))

    def kind(byte):
        c = chr(byte)
        return 97 if "a" <= c <= "z" or byte >= 128 else 65 if "A" <= c <= "Z" else 48 if "0" <= c <= "9" else byte

    def score(text):
        total, before = 0.0, []
        for word in words(lower(text)):
            raw, h = word.encode(), word_hash(word)
            total += model.weights[h >> (64 - quality.WORD_BITS)]
            shape = kind(raw[0])
            for back in range(3):
                shape = (shape * 256 + kind(raw[max(len(raw) - 1 - back, 0)])) % 2**64
            mixed = int(mix(np.asarray([shape * BASE % 2**64], np.uint64))[0])
            total += model.weights[quality._SHAPES + (mixed >> (64 - quality.SHAPE_BITS))]
            for back in (1, 2):
                if len(before) >= back and before[-back] == word:
                    total += model.weights[quality._REPEATS + back - 1]
            before.append(word)
        return total / max(len(before), 1), len(before)

    found = quality.grade_quality(docs(spark), model, at_least=2, threshold=0.4).collect()
    assert len(found) == len(odd_rows())
    for r in found:
        mean, n = score(r["text"] or "")
        p = [1 / (1 + math.exp(t - mean)) if n else 0.0 for t in model.thresholds]
        assert r["expected_grade"] == pytest.approx(sum(p), abs=1e-6) and r["tail_prob"] == pytest.approx(p[1], abs=1e-6)
        assert r["kept"] == (r["tail_prob"] >= 0.4)


@pytest.mark.parametrize("budget,entropy,repeats,block", [(1.0, 0.9, 2.0, 60), (2.5, 0.99, 3.0, 25), (0.4, 0.5, 1.0, 1000)])
def test_mixing_by_hand(spark, budget, entropy, repeats, block):
    """Copies of every row by plain loops over sources, blocks and rows."""
    texts = [(i, prose(10 + i % 37, i), ("a", "b", None, "c")[0 if i % 3 else 1 + i % 2 if i % 5 else 3]) for i in range(120)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, source string")
    places = {r["doc_id"]: r["p"] for r in frame.select("doc_id", mixing._place("doc_id", "text", 17).alias("p")).collect()}
    tokens = defaultdict(int)
    for _, text, source in texts:
        tokens[source] += len(words(text))
    total = sum(tokens.values())

    def weights(a):
        p = {s: (t / total) ** a for s, t in tokens.items()}
        z = sum(p.values())
        return {s: v / z for s, v in p.items()}

    def even(a):
        return -sum(w * math.log(w) for w in weights(a).values()) >= entropy * math.log(len(tokens))

    def within(a):
        return max(w * budget * total / tokens[s] for s, w in weights(a).items()) <= repeats

    exponent = 1.0
    if not even(1.0):
        low, high = 0.0, 1.0
        for _ in range(24):
            middle = (low + high) / 2
            low, high = (middle, high) if even(middle) else (low, middle)
        exponent = low
    if not within(exponent) and within(1.0):
        low, high = 0.0, 1.0 - exponent
        for _ in range(24):
            middle = (low + high) / 2
            low, high = (middle, high) if within(1.0 - middle) else (low, middle)
        exponent = 1.0 - low
    elif not within(exponent):
        exponent = 1.0
    want = {}
    for source, weight in weights(exponent).items():
        target = min(weight * budget * total, repeats * tokens[source])
        rounds = math.floor(target / tokens[source] + 1e-9)
        left = max(0.0, target - rounds * tokens[source])
        n_blocks = max(1, math.ceil(tokens[source] / block))
        blocks = defaultdict(list)
        for i, text, s in texts:
            if s == source:
                blocks[math.floor(places[i] * n_blocks)].append((places[i], i, len(words(text))))
        extra = set()
        for number in sorted(blocks):
            size = sum(n for *_, n in blocks[number])
            if left <= 0:
                break
            if size <= left:
                extra |= {i for _, i, _ in blocks[number]}
                left -= size
                continue
            for _, i, n in sorted(blocks[number]):
                if n > left:
                    break
                extra.add(i)
                left -= n
            break
        for i, _, s in texts:
            if s == source and rounds + (i in extra):
                want[i] = (rounds + (i in extra), weight)
    found = defaultdict(list)
    for r in mixing.mix(frame, budget=budget, entropy=entropy, repeats=repeats, block_tokens=block).collect():
        found[r["doc_id"]].append((r["copy"], r["weight"]))
    assert {i: len(c) for i, c in found.items()} == {i: n for i, (n, _) in want.items()}
    for i, copies in found.items():
        assert sorted(c for c, _ in copies) == list(range(len(copies)))
        assert copies[0][1] == pytest.approx(want[i][1], rel=1e-5)


def test_names_that_clash(spark):
    """Names with dots, and names of the added columns in another case."""
    rows = [(i, prose(30, i % 3), "s", 1, 2, 3, 4, 5, 6, 7, 8, 9) for i in range(12)]
    schema = "doc_id long, text string, source string, `a.b` int, Score int, N_Lines int, Kept int, LANG_PRED int, Predicted int, Copy int, Expected_Grade int, Weight int"
    frame = spark.createDataFrame(rows, schema)
    rng = np.random.default_rng(2)
    make = lambda: language.Direction(rng.normal(0, 0.3, (256, 24)).astype("f4"), rng.normal(0, 0.1, (8, 16)).astype("f4"), rng.normal(0, 0.3, (8, 8)).astype("f4"))
    speaker = language.LanguageModel(["a", "b"], make(), make(), rng.normal(0, 1, (16, 2)).astype("f4"), np.zeros(2, "f4"))
    grader = quality.OrdinalModel(rng.normal(0, 1, quality.FEATURES), np.asarray([0.0, 1.0]))
    for added, df in (
        (("lang_pred", "score"), language.identify(frame, speaker)),
        (("lang_pred", "score"), language.identify(frame, None)),
        (("score", "predicted"), toxicity.score_toxicity(frame, None)),
        (("expected_grade", "tail_prob", "kept"), quality.grade_quality(frame, grader)),
        (("n_lines", "n_dropped"), line_dedup.dedup_lines(frame)),
        (("copy", "weight", "place"), mixing.mix(frame)),
        ((), jaccard.keep_one(frame)),
        (("n_words", "n_removed", "spans"), substrings.remove_repeats(frame)),
    ):
        lowered = [c.lower() for c in df.columns]
        assert len(set(lowered)) == len(lowered) and set(added) <= set(df.columns)
        assert set(lowered) == {c.lower() for c in frame.columns} | set(added)
        assert df.select(F.col("`a.b`")).distinct().count() == 1 and len(df.collect()) >= 3


def test_equal_texts_are_told_once(spark):
    frame = plain(spark, [prose(40, 1), prose(40, 1), prose(40, 2)])
    assert sorted(r["doc_id"] for r in jaccard.keep_one(frame).collect()) == [0, 2]
