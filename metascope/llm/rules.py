"""Quality rules as weak supervision, with built-in Spark expressions only.

Each rule votes for good (1) or bad (-1) text or abstains (0); most only find faults.
How often each rule casts which vote on good and on bad documents, its accuracy, is
estimated by expectation-maximisation over all documents.  A prior guess, worth a
share of the documents, tells the two classes apart.  A document is kept if the
posterior probability that it is good, given the votes, reaches a threshold.  Documents with equal votes are one
row of the estimate, so a step reads at most 3**rules rows whatever the corpus,
and one row of sums passes the driver.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, UPPER, saved

SPAN = 8
SYMBOLS = "#*$%&|<>"
# The guess that the estimate starts from: chances of the votes 1, 0, -1 on good and on bad documents.
VOTES = (1, 0, -1)
ON_GOOD, ON_BAD, GOOD_SHARE = (0.5, 0.49, 0.01), (0.3, 0.4, 0.3), 0.7


def _removed(text: str, characters: str) -> Column:
    """How many characters of the text are among the given ones."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))).cast("long")


def measures(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Counts of every whole text; a NULL text has none of anything."""
    df = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = F.filter(F.split("text", f"[{ASCII_SPACE}]+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{ASCII_SPACE}]"))
    df = df.select(
        "id",
        F.transform(words, lambda w: F.xxhash64(w)).alias("h"),
        (F.length("text") - _removed("text", ASCII_SPACE)).cast("long").alias("word_chars"),
        _removed("text", SYMBOLS).alias("n_symbols"),
        _removed("text", UPPER).alias("n_upper"),
        _removed("text", "!").alias("n_shouts"),
        lines.alias("lines"),
    )
    df = df.select(
        "id",
        F.size("h").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(f"""[.?!:"'…][{ASCII_SPACE}]*$"""))).cast("long").alias("n_closed"),
        "n_upper",
        "n_shouts",
        F.col("h").alias("spans"),
    )
    # The word at a place and the next seven, as one number; pairs, then fours, then eights.
    # One projection each: an expression in an expression would be evaluated anew for each of its uses.
    for step in (1, 2, 4):
        df = df.withColumn("spans", _joined(F.col("spans"), step))
    return df.select("*", repeated_words("spans").alias("n_repeat_words")).drop("spans")


def _joined(values: Column, step: int) -> Column:
    """Each number with the one ``step`` places on."""
    many = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), many), F.slice(values, F.lit(step + 1), many), lambda a, b: F.xxhash64(a, b))


def repeated_words(spans: str) -> Column:
    """Words in spans found more than once, each word counted once."""
    # Only texts with a repeat are sorted: equal spans then stand side by side.
    placed = F.array_sort(F.transform(spans, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    again = F.array_sort(F.flatten(F.zip_with(
        F.slice(placed, F.lit(1), F.size(spans) - 1),
        F.slice(placed, F.lit(2), F.size(spans) - 1),
        lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )))
    covered = F.aggregate(
        again,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, i: F.struct((i + SPAN).alias("end"), (s["n"] + F.lit(SPAN) - F.greatest(F.lit(0), s["end"] - i)).alias("n")),
        lambda s: s["n"],
    )
    return F.when(F.size(F.array_distinct(spans)) == F.size(spans), F.lit(0)).otherwise(covered).cast("long")


def votes() -> dict[str, Column]:
    """The rules: 1 good, -1 bad, 0 no opinion.  All but the first are about shares, whatever the length."""

    def rule(value: Column, bad: Column, good: Column | None = None) -> Column:
        vote = F.when(value.isNull(), 0).when(bad, -1)
        return (vote.when(good, 1) if good is not None else vote).otherwise(0)

    def share(count: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(count) / F.col(of))

    length, symbols, repeats = share("word_chars", "n_words"), share("n_symbols", "n_words"), share("n_repeat_words", "n_words")
    dups, closed, upper, shouts = share("n_dup_lines", "n_lines"), share("n_closed", "n_lines"), share("n_upper", "word_chars"), share("n_shouts", "n_words")
    n = F.col("n_words")
    return {
        "length": rule(n, n < 20, n >= 50),
        "word_length": rule(length, (length < 2) | (length > 15)),
        "symbols": rule(symbols, symbols > 0.1),
        "repeats": rule(repeats, repeats > 0.3),
        "dup_lines": rule(dups, dups > 0.5),
        "closed": rule(closed, (closed < 0.1) & (F.col("n_lines") >= 3), closed >= 0.5),
        "upper": rule(upper, upper > 0.4),
        "shouts": rule(shouts, shouts > 0.2),
    }


Rates = dict[str, tuple[tuple[float, ...], tuple[float, ...]]]


def log_odds(rates: Rates, prior: float) -> Column:
    """Of good against bad, from votes: rates are the chances of each of ``VOTES`` on good and on bad documents.

    An abstention says nothing: faults exclude one another, so the silence of the other rules is no praise.
    """
    parts = [F.lit(math.log(prior / (1 - prior)))]
    for name, (good, bad) in rates.items():
        for_it, _, against = (F.lit(math.log(g / b)) for g, b in zip(good, bad, strict=True))
        parts.append(F.when(F.col(name) == 1, for_it).when(F.col(name) == -1, against).otherwise(F.lit(0.0)))
    return reduce(lambda a, b: a + b, parts)


def _posterior(odds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def estimate(patterns: DataFrame, names: list[str], steps: int, anchor: float) -> tuple[Rates, float]:
    """Rates and the share of good documents from vote patterns (names..., n), by expectation-maximisation.

    The first guess counts like ``anchor`` times all documents.
    """
    rates: Rates = dict.fromkeys(names, (ON_GOOD, ON_BAD))
    prior = GOOD_SHARE
    for _ in range(steps):
        scored = patterns.select(*names, "n", _posterior(log_odds(rates, prior)).alias("p"))
        classes = {"good": F.col("n") * F.col("p"), "bad": F.col("n") * (1 - F.col("p"))}
        sums = [F.sum(weight).alias(label) for label, weight in classes.items()]
        sums += [
            F.sum(F.when(F.col(name) == vote, weight).otherwise(0.0)).alias(f"{name}|{label}|{vote}")
            for name in names
            for label, weight in classes.items()
            for vote in VOTES
        ]
        row = scored.agg(*sums).first()
        if row["good"] is None:
            break
        total = row["good"] + row["bad"]
        extra = anchor * total
        prior = (row["good"] + extra * GOOD_SHARE) / (total + extra)
        for name in names:
            both = []
            for label, guess, share in (("good", ON_GOOD, GOOD_SHARE), ("bad", ON_BAD, 1 - GOOD_SHARE)):
                both.append(tuple((row[f"{name}|{label}|{v}"] + extra * share * g) / (row[label] + extra * share) for v, g in zip(VOTES, guess, strict=True)))
            rates[name] = (both[0], both[1])
    return rates, prior


def judge(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.5, steps: int = 15, anchor: float = 1.0,
    min_words: int = 20, most_repeats: int = 30,
) -> DataFrame:
    """A row per document: id, the counts, ``base_failed``, ``kept`` and ``posterior``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``most_repeats``
    per cent of them in repeated spans; such a document is not kept.  The estimate
    is over all documents, these included.  NULL and empty texts have no words, and
    so fail.  Each row counts as a document, also if rows repeat or ids are NULL.
    Other columns are not read.  An empty table gives an empty one.
    """
    rules = votes()
    counted = measures(docs, id_column, text)
    voted = saved(counted.select("*", *[rule.cast("int").alias(name) for name, rule in rules.items()]), "rule-votes")
    patterns = saved(voted.groupBy(*rules).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "rule-patterns")
    rates, prior = estimate(patterns, list(rules), steps, anchor)
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeats)
    posterior = _posterior(log_odds(rates, prior))
    return voted.select(
        F.col("id").alias(id_column), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (posterior >= threshold)).alias("kept"), posterior.alias("posterior"),
    )
