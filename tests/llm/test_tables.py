"""Mixing, quality rules, nearest neighbours, the queries and the pipeline."""

import math
from collections import Counter

import numpy as np
import pytest
from cases import docs, odd_rows, plain, prose, words
from conftest import TESTDATA
from pyspark.sql import functions as F

import corpus_pipeline
from metascope.llm import knn, mixing, packing, queries, rules

SF = f"{TESTDATA}/sf0.001"


def test_rules_count_as_defined(spark):
    found = rules.judge(docs(spark)).collect()
    want = Counter()
    for i, text, *_ in odd_rows():
        text = text or ""
        w = words(text)
        spans = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {k + j for k in range(len(w) - 7) if spans[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in text.split("\n") if words(x)]
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed] += 1
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in columns) for r in found) == want
    assert not any(r["kept"] for r in found if r["base_failed"])
    assert rules.judge(docs(spark, [])).count() == 0


def test_rules_estimate_by_hand(spark):
    """Expectation-maximisation against a plain version, and its verdicts on clean and broken texts."""
    texts = [prose(80, i) for i in range(40)] + [" ".join(w + "$$$" for w in prose(80, 90 + i).split()) for i in range(8)]
    judged = rules.judge(plain(spark, texts)).orderBy("doc_id").collect()
    assert [r["kept"] for r in judged] == [True] * 40 + [False] * 8
    names = list(rules.votes())
    counted = rules.measures(plain(spark, texts), "doc_id", "text")
    votes = np.asarray([tuple(r) for r in counted.orderBy("id").select(*[v.alias(n) for n, v in rules.votes().items()]).collect()])
    rates, prior = {n: (rules.ON_GOOD, rules.ON_BAD) for n in names}, rules.GOOD_SHARE

    def posterior():
        odds = np.full(len(votes), math.log(prior / (1 - prior)))
        for j, n in enumerate(names):
            for k, v in ((0, 1), (2, -1)):
                odds += np.where(votes[:, j] == v, math.log(rates[n][0][k] / rates[n][1][k]), 0)
        return 1 / (1 + np.exp(-odds))

    for _ in range(15):
        p = posterior()
        new = {}
        for j, n in enumerate(names):
            both = []
            for q, guess, share in ((p, rules.ON_GOOD, rules.GOOD_SHARE), (1 - p, rules.ON_BAD, 1 - rules.GOOD_SHARE)):
                extra = len(votes) * share
                both.append(tuple((q[votes[:, j] == v].sum() + extra * g) / (q.sum() + extra) for v, g in zip((1, 0, -1), guess, strict=True)))
            new[n] = tuple(both)
        prior, rates = (p.sum() + len(votes) * rules.GOOD_SHARE) / (2 * len(votes)), new
    assert np.allclose([r["posterior"] for r in judged], posterior(), atol=1e-9)


def test_mixing_meets_entropy_and_budget(spark):
    rows = [(i, prose(30, i), "big" if i % 10 else f"small{i % 30 // 10}") for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(table, entropy=0.9, repeats=8.0, block_tokens=500).cache()
    tokens = {r["source"]: (r["n"], r["w"]) for r in mixed.groupBy("source").agg(F.sum(mixing.word_count("text")).alias("n"), F.first("weight").alias("w")).collect()}
    assert math.isclose(-sum(w * math.log(w) for _, w in tokens.values()), 0.9 * math.log(4), rel_tol=1e-3)
    for n, weight in tokens.values():
        assert -35 <= n - weight * 600 * 30 <= 1
    # Copies are whole rounds: no document has two more than another of its source.
    times = mixed.groupBy("source", "doc_id").count().groupBy("source").agg(F.min("count").alias("a"), F.max("count").alias("b")).collect()
    assert all(r["b"] - r["a"] <= 1 for r in times)
    assert mixed.groupBy("doc_id", "copy").count().filter("count > 1").count() == 0
    limited = mixing.mix(table, entropy=1.0, repeats=2.0)
    assert limited.agg(F.max("copy")).first()[0] <= 1
    assert mixing.mix(table, entropy=0.0).count() == 600


def test_mixing_odd_rows(spark):
    mixed = mixing.mix(docs(spark), entropy=0.95, repeats=3.0)
    assert set(mixed.columns) == set(docs(spark).columns)  # the added columns replace those of their names
    assert 0 < mixed.count() < 4 * len(odd_rows()) and mixed.filter("source is null").count() > 0
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark).filter("doc_id in (4, 5, 6)")).count() == 3


def brute_neighbours(rows, every, k):
    out = {}
    for i, x in rows:
        if i % every == 0:
            scored = []
            for j, y in rows:
                if j != i:
                    total = 0.0
                    for a, b in zip(x, y, strict=True):
                        total += a * b
                    scored.append((-total, j))
            out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("cell_rows, block_rows, block_queries", [(100_000, 100_000, 2048), (60, 25, 3)])
def test_neighbours(spark, cell_rows, block_rows, block_queries):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16)) * 2
    rows = [(i, [float(v) for v in (centres[i % 12] + rng.normal(size=16) * 0.5).astype(np.float32)]) for i in range(600)]
    rows += [(600 + i, rows[0][1]) for i in range(90)]  # one vector many times
    bad = [(1001, None), (1002, [0.0] * 16), (1003, [math.nan] * 16), (1004, [1.0, None] * 8), (1005, [math.inf] * 16), (1006, [1.0]), (None, rows[0][1]), (1020, [])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], "vec_id long, embedding array<float>, cell string, n int")
    found = {}
    for r in knn.nearest(table, cell_rows=cell_rows, block_rows=block_rows, block_queries=block_queries).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute_neighbours(rows, 20, 20)
    assert found.keys() == want.keys() and all(len(v) == 20 for v in found.values())
    hits = sum(len({j for j, _ in found[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    exact = {(q, j): s for q in want for j, s in want[q]}
    assert all(exact.get((q, j), s) == s for q in found for j, s in found[q])
    assert found[0] == want[0]


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in knn.nearest(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 0.5)]
    assert knn.nearest(few.limit(0)).count() == 0


def test_equal_ids_are_rows_of_their_own(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (3, [0.5, 0.5])]
    found = knn.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=2).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    # Two rows find their equal and 3; the third finds 3 and one of the two.
    assert got == sorted([(20, 1, 20, 1.0), (20, 2, 3, 0.5)] * 2 + [(20, 1, 3, 0.5), (20, 2, 20, 0.0)])


def test_recall_on_the_given_table(spark):
    sf = f"{TESTDATA}/sf0.01"
    rows = [(r["vec_id"], list(map(float, r["embedding"]))) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_neighbours(rows, 20, 20)
    found = {}
    for r in queries.QUERIES["op5_nearest_neighbours"](spark, sf).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert found.keys() == want.keys()
    assert sum(len(found[q] & {j for j, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_chi_square():
    assert math.isclose(knn.chi_square_quantile(0.95, 8), 15.5073, rel_tol=1e-4)


def test_queries_have_their_columns(spark):
    want = {
        "op3_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        "op4_quality_classifier": ["doc_id", "expected_grade", "tail_prob", "kept"],
        "op8_source_mixing": ["doc_id", "source", "copy", "weight", "place"],
    }
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, SF).columns == columns


def test_oracle(spark):
    from compare import database, difference

    assert difference(queries.QUERIES["op3_line_dedup"](spark, SF), database(SF), queries.ORACLES["op3_line_dedup"]) is None


def test_pipeline(spark):
    """Every stage does its part to what the one before kept."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [documents]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], SF).cache())
        assert steps[-1].columns == documents.columns
    _, good, lines, single, mixed = steps
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = labels.join(good.select("doc_id", F.lit(True).alias("in")), "doc_id", "left")
    assert judged.filter("(quality = 1) <> coalesce(in, false)").count() <= 0.03 * judged.count()
    kept = Counter(x.strip().lower() for r in lines.select("text").distinct().collect() for x in set(r["text"].split("\n")))
    assert lines.count() == good.count() and max(n for x, n in kept.items() if x) < 10
    assert 0 < single.count() < lines.count() and single.select("doc_id").distinct().count() == single.count()
    assert mixed.join(single, "doc_id", "left_anti").count() == 0
    packed = packing.pack(mixed, queries.tokenizer_path()).agg(F.sum("length").alias("n"), F.count_distinct("sequence_id").alias("s")).first()
    assert packed["s"] <= math.ceil(packed["n"] / 2048) + 2


def test_stages_with_odd_rows(spark):
    """Every stage takes what the one before kept of rows with all that a table may hold, and an empty table."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for rows in (docs(spark).select(*columns), docs(spark, []).select(*columns)):
        n = rows.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = spark.createDataFrame(stage(spark, rows, SF).collect(), rows.schema)
            assert rows.columns == columns, name
            assert rows.count() <= 3 * n
        packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
        assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in rows.collect()}
