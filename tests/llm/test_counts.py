"""Characters of a text are counted by patterns; looking each one up in a table is slow."""

from metascope.llm import rules


def test_characters_are_counted_by_patterns(spark):
    docs = spark.createDataFrame([(1, "A#b\x0b!&\u00c9 $|<>*%Z"), (2, None), (3, "")], "doc_id long, text string")
    found = rules.measures(docs, "doc_id", "text")
    assert "translate(" not in found._jdf.queryExecution().toString()
    rows = {r["id"]: (r["word_chars"], r["n_symbols"], r["n_upper"], r["n_shouts"]) for r in found.collect()}
    assert rows == {1: (13, 8, 2, 1), 2: (0, 0, 0, 0), 3: (0, 0, 0, 0)}


def test_spans_are_joined_step_by_step(spark):
    """A projection for each step: nested in one another, each step would be evaluated for every use of the next."""
    found = rules.measures(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), "doc_id", "text")
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert max(line.count("zip_with(") for line in lines if "repeat" not in line) == 1
