from collections import Counter

from cases import docs, lower, odd_rows, plain

from metascope.llm.line_dedup import dedup_lines


def brute(rows, min_docs):
    def keys(text):
        return [lower(x.strip(" \t\n\x0b\x0c\r")) for x in (text or "").split("\n")]

    counts = Counter(k for _, text in rows for k in set(keys(text)) if k)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x, k in zip(lines, keys(text), strict=True) if counts[k] < min_docs or not k]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    for batches, fanout in ((4, 2), (1, 2), (5, 3)):
        found = dedup_lines(docs(spark), batches=batches, fanout=fanout)
        assert set(found.columns) == set(docs(spark).columns) | {"n_dropped"}
        assert Counter(tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_dropped").collect()) == brute(rows, 10)


def test_all_lines_dropped_and_first_line_empty(spark):
    texts = ["same\nsame"] * 10 + ["\n same \nx", "SAME", None, ""]
    found = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in dedup_lines(plain(spark, texts)).collect()}
    assert found[0] == ("", 2, 2) and found[10] == ("\nx", 3, 1) and found[11] == ("", 1, 1) and found[12] == found[13] == ("", 1, 0)


def test_empty_table(spark):
    assert dedup_lines(docs(spark, [])).count() == 0
