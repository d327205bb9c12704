import random
from collections import Counter

import numpy as np
from cases import docs, lower, odd_rows, plain, prose, words

from metascope.llm import jaccard
from metascope.llm.common import saved
from metascope.llm.components import connected_components


def sets_of(rows):
    out = []
    for _, text in rows:
        w = words(lower(text or ""))
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return Counter((r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def found(df):
    return Counter(tuple(r) for r in jaccard.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect())


def changed(text, n, rng):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
    return " ".join(w)


def test_odd_rows(spark):
    assert found(docs(spark)) == brute([(r[0], r[1]) for r in odd_rows()])


def test_small_sets_chains_and_near_misses(spark):
    """Sizes around the boundary, chains of copies, and similarities just at the limit."""
    rng = random.Random(5)
    texts = []
    for n in range(1, 26):
        base = " ".join(f"w{n}_{i}" for i in range(n))
        texts += [base, base + " more", base + " more and", changed(base, 1, rng)]
    for group in range(6):
        text = prose(200, group)
        for _ in range(12):
            text = changed(text, rng.randrange(5), rng)
            texts.append(text)
    texts += [prose(200, 99) + "\n" + prose(55, 7) for _ in range(2)]
    rows = list(enumerate(texts))
    assert found(plain(spark, texts)) == brute(rows)


def test_any_boundary_gives_the_same(spark, monkeypatch):
    rng = random.Random(6)
    texts = [changed(" ".join(f"v{g}_{i}" for i in range(6 + g)), rng.randrange(2), rng) for g in range(12) for _ in range(5)]
    want = brute(list(enumerate(texts)))
    for boundary in (0, 7, 14):
        monkeypatch.setattr(jaccard, "choose_boundary", lambda *a, b=boundary: b)
        assert found(plain(spark, texts)) == want


def test_one_of_each_component_stays(spark):
    kept = jaccard.keep_one(docs(spark))
    assert kept.columns == docs(spark).columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    want = brute([(r[0], r[1]) for r in odd_rows()])
    first = {c for (_, n, c) in want if n and c is not None}
    assert all(ids[i] == 1 for i in first) and ids[4] == ids[5] == ids[6] == 1 and not {1, 2, 3, 8} & set(ids)
    assert ids[None] == 2  # one of two equal texts, and the row without a text


def test_empty_table(spark):
    assert jaccard.near_duplicates(docs(spark, [])).count() == 0
    assert jaccard.keep_one(docs(spark, [])).count() == 0


def test_subset_sizes_reach_every_partner():
    plan = jaccard.Plan(5, 80)
    for n in range(1, 40):
        for m in range(plan.fewest(n), n * 100 // 80 + 1):
            if (o := plan.fewest(n, m)) <= min(n, m):
                assert o in plan.subset_sizes(n) and o in plan.subset_sizes(m)
                assert n - o + 1 <= plan.prefix(n)


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(50):
        pool = rng.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, 200)) for _ in range(2))
        differ = sum(bin(int(x)).count("1") for x in (jaccard.bitmap_of(a) ^ jaccard.bitmap_of(b)).view(np.uint64))
        assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - differ) // 2


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 201)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}


def test_a_group_of_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies of one text, two of which are links about every second time: pairs in proportion to the members."""
    rng = random.Random(8)
    base = " ".join(f"w{i}" for i in range(200))
    texts = [changed(base, rng.randrange(2, 4), rng) for _ in range(150)]
    compared, measured = [], jaccard._measured
    monkeypatch.setattr(jaccard, "_measured", lambda pairs, *a: compared.append(pairs.count()) or measured(pairs, *a))
    assert found(plain(spark, texts)) == brute(list(enumerate(texts)))
    assert sum(compared) < 8 * len(texts)


def test_large_sets_without_a_link_are_told_apart_by_sketches(spark):
    rng = random.Random(9)
    large = [" ".join(f"{g}x{rng.randrange(10**6)}" for _ in range(1900)) for g in range(3)]
    texts = [*large, changed(large[0], 20, rng), large[1] + " " + " ".join(f"more{i}" for i in range(190))]
    sets = saved(jaccard._sets(plain(spark, texts), "doc_id", "text", 5).filter("chunk is null"), "test-sets")
    node = {r["id"]: r["node"] for r in sets.collect()}
    pairs = [(0, 1), (0, 2), (1, 2), (2, 4), (0, 3), (1, 4)]
    left = jaccard._possible(spark.createDataFrame([(node[a], node[b]) for a, b in pairs], "a long, b long"), sets, 80)
    assert {(r["a"], r["b"]) for r in left.collect()} == {(node[0], node[3]), (node[1], node[4])}
