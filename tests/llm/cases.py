"""Small tables with all that a table may hold, and plain versions of the definitions."""

import random
import re
import zlib

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, doc string, h1 long, part int, batch int, score double, "
    "kept boolean, n_lines int, copy int, weight double, id long, n long, node long, drop string, ends string, place double, s string"
)
CLASHING = ("x", 7, 7, 7, 0.5, True, 7, 7, 0.5, 7, 7, 7, "x", "x", 0.5, "x")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed, lines=8):
    rng = random.Random(seed)
    words = ["".join(rng.choice(WORDS)[:3] for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + lines]).capitalize() + "." for i in range(0, n, lines))


def odd_rows():
    base = prose(120, 1)
    texts = [
        (0, base), (1, base), (2, base.upper()), (3, base.replace("Alp", "Bet", 1)), (4, None), (5, ""), (6, " \t\n "), (7, "one two three"),
        (8, "One TWO three"), (9, prose(60, 2)), (9, prose(60, 2)), (None, prose(70, 3)), (None, prose(70, 3)), (None, None), (10, prose(30000, 4)),
        (11, "a"), (12, "ünïcode wörds çan bé hére. " * 12), (13, "  two  spaces   and\ttabs \n\n x"), (14, "12 34 ### $$$"), (15, "é"),
    ]
    texts += [(20 + i, prose(40 + i, 50 + i) + "\nShared Line \n" + "same.") for i in range(14)]
    return [(i, t, ("en", "de", None)[k % 3], None if k % 7 == 0 else f"s{k % 3}", len(t or ""), *CLASHING) for k, (i, t) in enumerate(texts)]


def docs(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def plain(spark, texts):
    """(doc_id, text) of some texts, by their place."""
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
