"""Removal of passages that documents with smaller ids have too, by difference-cover anchors.

A difference cover modulo p is a set D of residues whose differences give every
residue.  Anchors are hashes of ``width`` words at word positions whose residue is
in D.  Two equal windows at any two positions have, at one and the same offset
below p, both a position of the cover: with width = window - p + 1 that anchor lies
inside the windows.  So texts that share a window share an anchor, though only
|D| / p of all positions are hashed (6 of 31).

1. Anchors found in several different texts are told by a minimum and a maximum per
   hash, which Spark combines before it shuffles: no group is gathered.
2. Around these anchors, matches are extended to whole windows: every window that
   holds a shared anchor is hashed (128 bits), and the smallest id per window is
   joined back.  A window is removed where that id is smaller than the document's own.
3. Covered words are cut from the texts.

Texts that are equal as a whole are one text with the smallest of their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved
from .words import BASE, Words, _Powers, mix, text_bytes, words_of

# Perfect difference covers by modulus (of projective planes of order 1 to 7).
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}


def cover_of(window: int) -> tuple[int, tuple[int, ...], int]:
    """(period, residues, anchor width): the longest period that leaves anchors over a third of the window."""
    period = max(p for p in COVERS if p == 1 or 3 * p <= 2 * window)
    return period, COVERS[period], window - period + 1


def window_hashes(words: Words, width: int, seed: int) -> np.ndarray:
    """64 bits for the ``width`` words from each word on, as long as the slice has them."""
    n = len(words.hash)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = _Powers.of(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(words.hash ^ np.uint64(seed * BASE % (1 << 64))) * up[:n], out=sums[1:])
    starts = n - width + 1
    return mix((sums[width:] - sums[:starts]) * down[:starts])


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(place among all words, hash) of the anchors of a slice."""
    period, residues, width = cover_of(window)
    h = window_hashes(words, width, 1)
    bounds = words.bounds()
    at = np.arange(len(h)) - bounds[words.doc[: len(h)]]
    inside = np.arange(len(h)) + width <= bounds[words.doc[: len(h)] + 1]
    here = np.flatnonzero(inside & np.isin(at % period, residues))
    return here, h[here]


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def anchors(texts: DataFrame, window: int) -> DataFrame:
    """(h, t): the anchors of each text ``text`` known as ``t``, each once a text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.column(batch.schema.get_field_index("t")).to_numpy()
            for lo, _, words in words_of(batch.column(batch.schema.get_field_index("text")), lower=False):
                here, h = _anchors(words, window)
                doc = words.doc[here]
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays([_signed(h[first]), pa.array(t[lo + doc[first]])], ["h", "t"])

    return texts.select("t", "text").mapInArrow(find, "h long, t long")


def windows(texts: DataFrame, window: int) -> DataFrame:
    """(w1, w2, t1, t2, m, start) of all windows that hold one of the text's ``shared`` anchors."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        period, _, _ = cover_of(window)
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            ids = {name: column[name].to_numpy() for name in ("t1", "t2", "m")}
            shared = column["shared"]
            for lo, hi, words in words_of(column["text"], lower=False):
                here, h = _anchors(words, window)
                wanted = shared.slice(lo, hi - lo)
                known = wanted.flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(hi - lo), np.diff(wanted.offsets.to_numpy()))
                # An anchor counts in the texts that list it, told apart by a mixed pair of text and hash.
                pair = lambda doc, value: mix(value ^ mix(doc.astype(np.uint64) + np.uint64(1)))
                hit = here[np.isin(pair(words.doc[here], h), pair(owner, known))]
                bounds = words.bounds()
                first = bounds[words.doc[hit]]
                last = bounds[words.doc[hit] + 1] - window
                # Windows from period - 1 words before the anchor up to it, within the text.
                low, high = np.maximum(hit - period + 1, first), np.minimum(hit, last)
                some = low <= high
                mark = np.zeros(len(words.hash) + 2, np.int64)
                np.add.at(mark, low[some], 1)
                np.add.at(mark, high[some] + 1, -1)
                start = np.flatnonzero(np.cumsum(mark)[: len(words.hash)] > 0)
                doc = words.doc[start]
                w1, w2 = window_hashes(words, window, 2), window_hashes(words, window, 3)
                yield pa.RecordBatch.from_arrays(
                    [_signed(w1[start]), _signed(w2[start])]
                    + [pa.array(ids[name][lo + doc]) for name in ("t1", "t2", "m")]
                    + [pa.array((start - bounds[doc]).astype(np.int64))],
                    ["w1", "w2", "t1", "t2", "m", "start"],
                )

    return texts.select("t1", "t2", "m", "text", "shared").mapInArrow(extend, "w1 long, w2 long, t1 long, t2 long, m long, start long")


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(1), text).alias("t1"), F.xxhash64(F.lit(2), text).alias("t2")]


def repeated_windows(docs: DataFrame, id_column: str, text: str, window: int) -> DataFrame:
    """(t1, t2, m, starts): per text and its smallest id, the windows that also start in a document with a smaller id."""
    doc_id = F.col(f"`{id_column}`").cast("long")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(doc_id.alias("m"), body.alias("text"), *text_key(body)).filter("m is not null")
    # A text without as many words has no window; the least such text has a character and a blank for each.
    rows = rows.filter(F.length("text") >= 2 * window - 1)

    found = anchors(rows.select(F.col("t1").alias("t"), "text"), window)
    shared = found.groupBy("h").agg(F.min("t").alias("least"), F.max("t").alias("most")).filter("least < most").select("h")
    per_text = found.join(shared, "h", "left_semi").groupBy("t").agg(F.collect_set("h").alias("shared"))
    per_text = saved(per_text, "shared-anchors")

    smallest = rows.groupBy("t1", "t2").agg(F.min("m").alias("m"))
    wanted = smallest.join(per_text, F.col("t1") == F.col("t")).select("t1", "t2", "m", "shared")
    texts = rows.join(wanted, ["t1", "t2", "m"])
    extended = windows(texts, window)
    least = extended.groupBy("w1", "w2").agg(F.min("m").alias("least"), F.max("m").alias("most")).filter("least < most").select("w1", "w2", "least")
    hits = extended.join(least, ["w1", "w2"]).filter("m > least")
    return saved(hits.groupBy("t1", "t2").agg(F.sort_array(F.collect_set("start")).alias("starts")), "repeated-windows")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """``docs`` without the words of passages that a document with a smaller id has.

    A window is ``window`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one row.  Every
    word covered by a window whose word sequence also starts in a row with a smaller
    id is removed; windows are judged on the texts as given.  ``text`` holds the kept
    words joined by one space; ``n_words``, ``n_removed`` (long) and ``spans`` (array of
    the first and the end of the removed runs of words, counted from 0) are added, in
    place of columns of these names in any case.

    Ids are whole numbers.  A row with a NULL id keeps all its words and takes none
    from others.  Rows with equal ids don't count as smaller than one another, so
    repeated rows come back as often as they came, with equal results.  NULL or empty
    text has no words and gives an empty text.  Texts of any length are read whole.
    An empty table gives an empty table.
    """
    hits = repeated_windows(docs, id_column, text, window)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    doc_id = F.col(f"`{id_column}`").cast("long")
    new = ("n_words", "n_removed", "spans")
    others = [c for c in docs.columns if c != text and c.lower() not in new]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("doc"), doc_id.alias("id"), body.alias("text"), *text_key(body))
    smallest = rows.filter("id is not null").groupBy("t1", "t2").agg(F.min("id").alias("m"), F.max("id").alias("most"))
    smallest = smallest.join(hits, ["t1", "t2"], "left").filter("m < most or starts is not null").select("t1", "t2", "m", "starts")
    # A copy of a text with a smaller id loses all its windows.
    copy = F.coalesce(F.col("id") > F.col("m"), F.lit(False)).alias("copy")
    joined = rows.join(smallest, ["t1", "t2"], "left").select("doc", "text", "starts", copy, F.col("id").isNull().alias("no_id"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            copies, no_id, starts = column["copy"].to_numpy(False), column["no_id"].to_numpy(False), column["starts"]
            data, offsets = text_bytes(column["text"])
            kept, n_words, n_removed, spans = [], [], [], []
            for i in range(batch.num_rows):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                n = len(words)
                n_words.append(n)
                runs = []
                if copies[i] and n >= window:
                    runs = [(0, n)]
                elif not no_id[i] and starts[i].is_valid:
                    for s in starts[i].values.to_numpy():
                        if runs and s <= runs[-1][1]:
                            runs[-1] = (runs[-1][0], int(s) + window)
                        else:
                            runs.append((int(s), int(s) + window))
                left, rest = 0, []
                for a, b in runs:
                    rest += words[left:a]
                    left = b
                rest += words[left:]
                kept.append(b" ".join(rest).decode())
                n_removed.append(n - len(rest))
                spans.append([{"first": a, "end": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [
                    column["doc"],
                    pa.array(kept, pa.string()),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                ],
                ["doc", "kept", "n_words", "n_removed", "spans"],
            )

    schema = joined.select("doc").schema.add("kept", "string").add("n_words", "long").add("n_removed", "long")
    span = T.StructType().add("first", "long").add("end", "long")
    schema = schema.add("spans", T.ArrayType(span))
    done = joined.mapInArrow(cut, schema)
    columns = [F.col("kept").alias(c) if c == text else F.col(f"doc.`{c}`") for c in docs.columns if c == text or c in others]
    return done.select(*columns, *new)
