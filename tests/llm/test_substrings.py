import random
from collections import Counter

import pytest
from cases import docs, odd_rows, plain, words

from metascope.llm.substrings import COVERS, cover_of, remove_repeats


def brute(rows, window):
    seen = {}
    for i, text in rows:
        w = words(text)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if i is not None:
                seen[key] = min(seen.get(key, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and seen[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "text").collect())


def test_covers():
    for p, cover in COVERS.items():
        assert {(a - b) % p for a in cover for b in cover} == set(range(p))
    for window in range(1, 200):
        period, _, width = cover_of(window)
        assert width >= 1 and period + width == window + 1
    assert cover_of(50)[0] == 31


@pytest.mark.parametrize("window", [1, 5, 12, 50])
def test_odd_rows(spark, window):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = remove_repeats(docs(spark), window=window)
    assert set(got.columns) == set(docs(spark).columns) | {"n_words", "n_removed", "spans"}
    assert found(got) == brute(rows, window)


@pytest.mark.parametrize("seed", range(3))
def test_shared_passages(spark, seed):
    """Passages at any two places, of lengths about the window's, over few words so that they repeat within texts too."""
    rng = random.Random(seed)
    common = [[rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.choice([49, 50, 51, 60, 81, 130]))] for _ in range(12)]
    texts = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts += [f"w{i}x{rng.randrange(50)}" for _ in range(rng.randrange(0, 40))]
            passage = rng.choice(common)
            cut = rng.randrange(0, 30) if rng.random() < 0.3 else 0
            parts += passage[cut:]
        texts.append("  ".join(parts) + "\n")
    texts += [texts[3], texts[3], "", None, " ".join(["ha"] * 300), " ".join(["ha"] * 120)]
    assert found(remove_repeats(plain(spark, texts))) == brute(list(enumerate(texts)), 50)


def test_spans_and_chains(spark):
    """A passage is judged on the input: the middle text has it from the first, the last from both."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(55))
    got = remove_repeats(plain(spark, [a, f"x {a} y {b}", f"{b} {a}", f"{b} z"])).collect()
    assert {r["doc_id"]: (r["text"], [(s["first"], s["end"]) for s in r["spans"]]) for r in got} == {
        0: (a, []), 1: (f"x y {b}", [(1, 61)]), 2: ("", [(0, 115)]), 3: ("z", [(0, 55)]),
    }


def test_names_and_empty_table(spark):
    text = " ".join(f"a{i}" for i in range(60))
    rows = spark.createDataFrame([(1, text, 1, 2, "s"), (2, text, 1, 2, "s")], "doc_id int, text string, N_Words int, `a.b` int, Spans string")
    got = remove_repeats(rows)
    assert got.columns == ["doc_id", "text", "a.b", "n_words", "n_removed", "spans"]
    assert {(r["doc_id"], r["n_removed"], r["a.b"]) for r in got.collect()} == {(1, 0, 2), (2, 60, 2)}
    assert remove_repeats(docs(spark, [])).count() == 0
