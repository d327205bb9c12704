"""Learned operators: cases of every kind of row, and accuracy on rows that they have not seen."""

import math

import numpy as np
import pytest
from cases import docs, odd_rows, plain
from conftest import TESTDATA
from pyspark.sql import functions as F

from metascope.llm import language, quality, toxicity
from metascope.llm.common import fold


@pytest.fixture(scope="module")
def tables(spark):
    return {name: spark.read.parquet(f"{TESTDATA}/sf0.01/{name}.parquet").cache() for name in ("documents", "labels")}


def test_quality_grades(spark, tables):
    documents, ratings = tables["documents"], quality.ratings_of(tables["labels"])
    seen = ratings.filter(fold(F.col("doc_id"), 2) == 0)
    model = quality.train(documents, seen)
    assert (np.diff(model.thresholds) > 0).all()
    graded = quality.grade_quality(documents, model).join(ratings.filter(fold(F.col("doc_id"), 2) == 1), "doc_id")
    right = graded.select(F.avg(((F.col("grade") >= 1) == F.col("kept")).cast("int"))).first()[0]
    assert right > 0.97


def test_quality_of_odd_rows(spark):
    ratings = spark.createDataFrame([(0, 1), (9, 1), (14, 0), (14, 2), (15, 0), (20, 1), (None, 1), (3, None)], "doc_id long, grade int")
    model = quality.train(docs(spark), ratings, steps=20)
    graded = quality.grade_quality(docs(spark), model)
    assert graded.count() == len(odd_rows()) and set(graded.columns) == set(docs(spark).columns) | {"expected_grade", "tail_prob"}
    empty = graded.filter("doc_id in (4, 5, 6)").collect()
    assert [(r["expected_grade"], r["tail_prob"], r["kept"]) for r in empty] == [(0.0, 0.0, False)] * 3
    assert quality.grade_quality(docs(spark, []), model).count() == 0
    assert quality.train(docs(spark, []), ratings) is None and quality.train(docs(spark), ratings.filter("grade = 1")) is None
    assert quality.grade_quality(docs(spark), None).filter("kept").count() == len(odd_rows())


def test_one_row_per_sampled_id(spark, monkeypatch):
    """Copies of a row neither weigh in the fit nor go to the driver."""
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, index, share, grades, *_: seen.append(sorted(grades)))
    monkeypatch.setattr(toxicity, "fit", lambda toxic, clean, *_, **__: seen.append((len(toxic), len(clean))))
    rows = spark.createDataFrame([(1, "one text")] * 30 + [(1, "other text"), (1, None), (2, "good text"), (3, None)], "doc_id long, text string")
    quality.train(rows, spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, grade int"))
    toxicity.train(rows, spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int"))
    assert seen == [[0, 1, 1], (1, 2)]


def test_quality_gradient():
    """Fitted on separable shares, the model orders all grades."""
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 400)
    model = quality.fit(np.arange(400), grades.astype(int), np.ones(400), grades, 4, 300, 1e-6)
    scores = model.weights[[0, 1, 2, 3]]
    assert (np.diff(scores) > 0).all() and (model.at_least(scores).sum(axis=1).round() == [0, 1, 2, 3]).all()


def test_languages_held_out(spark, tables):
    part = fold(F.col("doc_id"), 3)
    model = language.train(tables["documents"], part != 1, steps=150)
    found = language.identify(tables["documents"].filter(part == 1), model)
    assert found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    odd = language.identify(docs(spark), model)
    assert odd.count() == len(odd_rows()) and odd.filter("not score between 0 and 1").count() == 0
    assert sorted(r["doc_id"] or -1 for r in odd.filter("lang_pred = 'und'").collect()) == [-1, 4, 5, 6, 14]
    assert language.identify(docs(spark, []), model).count() == 0
    assert language.train(docs(spark, []), F.lit(True)) is None
    assert language.identify(docs(spark), None).filter("lang_pred = 'und' and score = 0").count() == len(odd_rows())


def test_every_language_is_learned(spark):
    rows = [(i, chr(97 + i % 26) * 30 + f" {i}", f"lang{i % 230}") for i in range(460)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), max_texts=100, steps=1)
    assert sorted(model.languages) == sorted({r[2] for r in rows})


def test_backpropagation_through_time():
    """Gradients of one direction against differences."""
    rng = np.random.default_rng(1)
    h = 3
    make = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float64)
    d = language.Direction(make(256, 3 * h) + 0.2, make(h, 2 * h), make(h, h))
    x, target = rng.integers(0, 4, (5, 2)), make(5, 2, h)

    def loss() -> float:
        return float((d.states(x).astype(float) * target).sum())

    keep = []
    d.states(x, keep)
    for weights, grad in zip(d.arrays(), d.back(x, keep, target), strict=True):
        for at in [(0, 0), (1, 2), (2, 1)]:
            old = weights[at]
            weights[at] = old + 1e-3
            up = loss()
            weights[at] = old - 1e-3
            down = loss()
            weights[at] = old
            assert abs((up - down) / 2e-3 - grad[at]) < 2e-2


def test_document_probabilities_are_means_of_positions():
    rng = np.random.default_rng(2)
    make = lambda: language.Direction(rng.normal(0, 0.3, (256, 24)).astype("f4"), rng.normal(0, 0.1, (8, 16)).astype("f4"), rng.normal(0, 0.3, (8, 8)).astype("f4"))
    model = language.LanguageModel(["a", "b"], make(), make(), rng.normal(0, 1, (16, 2)).astype("f4"), np.zeros(2, "f4"))
    texts = [b"x" * 5, b"", bytes(range(200)), b"y" * language.WINDOW]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    p = model.documents(np.frombuffer(b"".join(texts), np.uint8), offsets)
    for text, row in zip(texts, p, strict=True):
        pieces = [text[i : i + language.WINDOW] for i in range(0, len(text), language.WINDOW)]
        windows = np.stack([np.frombuffer(x.ljust(language.WINDOW, b"\0"), np.uint8) for x in pieces]) if pieces else None
        each = [model.positions(windows)[: len(x), i] for i, x in enumerate(pieces)]
        assert np.allclose(row, np.concatenate(each).mean(axis=0) if each else 0, atol=1e-5)


def test_toxicity_held_out(spark, tables):
    part = fold(F.col("doc_id"), 5)
    model = toxicity.train(tables["documents"], tables["labels"].filter(part != 0))
    text = "The idiot was here\nI.D.I.O.T and clown\ni d i o t\nthe was here with that"
    scored = toxicity.score_toxicity(plain(spark, [*text.split("\n"), "nothing of that kind was there"]), model)
    assert [r["predicted"] for r in scored.orderBy("doc_id").collect()] == [1, 1, 1, 0, 0]
    labelled = toxicity.score_toxicity(tables["documents"], model).join(tables["labels"], "doc_id").filter(part == 0)
    assert labelled.filter("predicted = 1 and toxic = 0").count() <= 0.03 * labelled.count()


def test_toxicity_of_odd_rows(spark):
    texts = [f"word{i} plain text here and thingummy number {i}" for i in range(60)] + [f"you blockhead{'s' * (i % 2)} number {i} again" for i in range(60)]
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(120)] + [(None, 1), (0, None)], "doc_id long, toxic int")
    model = toxicity.train(plain(spark, texts), labels, landmarks=24)
    odd = toxicity.score_toxicity(docs(spark), model)
    assert odd.count() == len(odd_rows()) and odd.filter("not score between 0 and 1").count() == 0
    assert {r["predicted"] for r in odd.filter("doc_id in (4, 5, 6)").collect()} == {0}
    assert [r["predicted"] for r in toxicity.score_toxicity(plain(spark, ["a blockhead", "a b-l-o-c-k-h-e-a-d"]), model).collect()] == [1, 1]
    assert toxicity.score_toxicity(docs(spark, []), model).count() == 0
    assert toxicity.train(docs(spark, []), labels) is None and toxicity.train(plain(spark, texts), labels.filter("toxic = 1")) is None
    assert toxicity.score_toxicity(docs(spark), None).filter("score = 0 and predicted = 0").count() == len(odd_rows())


def test_toxicity_across_spaces(spark):
    """Insults split by spaces, and insults of words that are each ordinary."""
    ordinary = ["please get home soon", "we lost the ticket", "they get lunch", "a lost umbrella", "nothing to report here", "get some rest"]
    texts = [f"{ordinary[i % 6]} and {ordinary[(i // 6) % 6]} as well" for i in range(60)]
    texts += [f"{ordinary[i % 6]} you {'blockhead' if i % 2 else 'get lost'} again" for i in range(60)]
    model = toxicity.train(plain(spark, texts), spark.createDataFrame([(i, int(i >= 60)) for i in range(120)], "doc_id long, toxic int"), landmarks=24)
    asked = ["he is a block head", "he is a blo ckhe ad", "now get lost at once", "we get home", "we lost it"]
    assert [r["predicted"] for r in toxicity.score_toxicity(plain(spark, asked), model).orderBy("doc_id").collect()] == [1, 1, 1, 0, 0]


def test_windows():
    texts = [b"the id iot x", b"a b", b"", b"mo ron 99", b"extraordinarily long"]
    folded = toxicity.Folded(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]))
    two, three = folded.windows(2), folded.windows(3)
    nines = bytes([96 + 27]) * 2
    assert two.words() == [b"theid", b"idiot", b"iotx", b"moron", b"ron" + nines] and two.doc.tolist() == [0, 0, 0, 3, 3]
    assert three.words() == [b"theidiot", b"idiotx", b"moron" + nines] and folded.windows(9).words() == []


def test_folded_words():
    def folded(text):
        raw = text.encode()
        return toxicity.Folded(np.frombuffer(raw, np.uint8), np.asarray([len(raw)])).words()

    assert folded("A b-c  1d10t!") == [b"a", b"bc", b"idiot"]
    assert folded("x y i d i o t z z") == [b"xyidiotzz"] and folded("a b") == [b"a", b"b"] and folded(" .. ") == []


def test_collapsed_weights_are_the_kernel():
    """One weight per subsequence gives what the landmarks' kernel values would."""
    words = [b"idiot", b"moron", b"the", b"clown"]
    rng = np.random.default_rng(3)
    alpha = rng.normal(size=len(words))
    dense = []
    for word in words:
        index, weight = toxicity.vector(word)
        dense.append(np.bincount(index, weight, toxicity.FEATURES))
    model = toxicity.ToxicityModel(np.stack(dense).T @ alpha, 0.0, 1.0, 0.0)
    for word in (b"idiots", b"clowns", b"a"):
        index, weight = toxicity.vector(word)
        kernel = [float((d[index] * weight).sum()) for d in dense]
        margin = model.margins(toxicity.Folded(np.frombuffer(word, np.uint8), np.asarray([len(word)])))[0]
        assert math.isclose(margin, float(np.dot(alpha, kernel)), rel_tol=1e-6, abs_tol=1e-9)
