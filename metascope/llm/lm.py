"""Language-model scores of texts: word pairs in Elias-Fano tries, sharded by context.

Documents are dealt into parts by a hash.  A part sends its distinct words and word
pairs, with their counts in training documents, to shards; a shard adds up what
all parts sent, builds its levels, and answers every key of every part with a
count or a quantised one; the part, whose documents come from the same shuffle
as before, then adds up the logarithms of each document.  So nothing is held as a
whole anywhere, no key is sent more than once per part, and successors of one
context are spread over several shards.

The model is a bigram model with Dirichlet smoothing, over a unigram model:
p(w | v) = (c(v w) + strength * p(w)) / (c(v) + strength).
The unigram model adds one to the count of every training word and of one unseen
word, so a word never seen gets half of what a word seen once gets, and the known
words and that one together get 1.  For that the distinct words of training texts
are counted before; other texts change no score but their own.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, row_hash, saved, small_batches
from .elias_fano import EliasFano, PairTrie, restored
from .words import mix, words_of

END, BEGIN = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
SALTS = 16
PART_BYTES = 18 << 20
WORDS, PAIRS = 1, 2


@dataclass
class Part:
    """The tokens of a part: distinct words and pairs in a fixed order, and each token's place among them."""

    words: np.ndarray
    word_of: np.ndarray
    context: np.ndarray
    word: np.ndarray
    pair_of: np.ndarray
    doc: np.ndarray
    context_word: np.ndarray  # the context's place among the words, -1 for the begin


def tokens_of(texts: pa.ChunkedArray) -> Part:
    hashes, docs, done = [], [], 0
    for lo, hi, words in words_of(texts):
        n = hi - lo
        seq, doc = np.full(len(words.hash) + n, END), np.empty(len(words.hash) + n, np.int64)
        seq[np.arange(len(words.hash)) + words.doc] = words.hash
        bounds = words.bounds()
        doc[:] = np.repeat(np.arange(n), np.diff(bounds) + 1) + done
        hashes.append(seq)
        docs.append(doc)
        done += n
    seq, doc = np.concatenate(hashes), np.concatenate(docs).astype(np.int32)
    del hashes, docs
    words, word_of = np.unique(seq, return_inverse=True)
    del seq
    word_of = word_of.astype(np.int32)
    before = np.full(len(word_of), -1, np.int32)
    before[1:] = np.where(doc[1:] == doc[:-1], word_of[:-1], -1)
    # Places in sorted order stand for the words: one number per pair, sorted by context and word.
    pairs, pair_of = np.unique((before.astype(np.int64) + 1) << 32 | word_of, return_inverse=True)
    pair_of = pair_of.astype(np.int32)
    first = (pairs >> 32) - 1
    context = np.where(first < 0, BEGIN, words[first])
    return Part(words, word_of, context, words[pairs & 0xFFFFFFFF], pair_of, doc, before)


def shard_of_words(words: np.ndarray, shards: int) -> np.ndarray:
    return (mix(words) % np.uint64(shards)).astype(np.int64)


def shard_of_pairs(context: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    return (mix(context + word % np.uint64(SALTS)) % np.uint64(shards)).astype(np.int64)


def _packed_counts(counts: np.ndarray) -> list[np.ndarray]:
    big = np.flatnonzero(counts >= 255)
    return [np.minimum(counts, 255).astype(np.uint8), big.astype(np.uint32), counts[big].astype(np.uint64)]


def _unpacked_counts(small: np.ndarray, big: np.ndarray, values: np.ndarray) -> np.ndarray:
    counts = small.astype(np.int64)
    counts[big] = values
    return counts


def _forty_bits(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :5]).ravel()


def _from_forty(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, 3:] = raw.reshape(-1, 5)
    return wide.ravel().view(">u8").astype(np.uint64)


def joined(arrays: list[np.ndarray]) -> bytes:
    head = struct.pack(f"<{len(arrays)}q", *[a.nbytes for a in arrays])
    return head + b"".join(a.tobytes() for a in arrays)


def parted(blob: bytes, types: list) -> list[np.ndarray]:
    sizes = struct.unpack_from(f"<{len(types)}q", blob)
    at, out = 8 * len(types), []
    for size, kind in zip(sizes, types, strict=True):
        out.append(np.frombuffer(blob, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


_COUNTS = [np.uint8, np.uint32, np.uint64]


def word_blob(words: np.ndarray, counts: np.ndarray) -> bytes:
    return joined([words, *_packed_counts(counts)])


def pair_blob(context: np.ndarray, word: np.ndarray, counts: np.ndarray) -> bytes:
    """Each context once, with the number of its words."""
    heads = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(context) else np.zeros(0, np.int64)
    runs = np.diff(np.append(heads, len(context)))
    return joined([_forty_bits(context[heads]), runs.astype(np.uint32), _forty_bits(word), *_packed_counts(counts)])


def answer(kind: int, blobs: list[bytes]) -> tuple[list[bytes], int, int]:
    """What a shard says to each part, how many distinct words it knows, and how many tokens these are."""
    if kind == WORDS:
        split = [parted(blob, [np.uint64, *_COUNTS]) for blob in blobs]
        keys = np.concatenate([x[0] for x in split])
        counts = np.concatenate([_unpacked_counts(*x[1:]) for x in split])
        words, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, counts, len(words)).astype(np.int64)
        known = total > 0
        level, total = EliasFano(words[known], 1 << 64), total[known]
        replies = []
        for x in split:
            found = level.find(x[0])
            replies.append(joined(_packed_counts(np.where(found >= 0, total[found], 0) if len(total) else np.zeros(len(found), np.int64))))
        return replies, len(total), int(total.sum())
    split = [parted(blob, [np.uint8, np.uint32, np.uint8, *_COUNTS]) for blob in blobs]
    contexts = [np.repeat(_from_forty(x[0]), x[1]) for x in split]
    words = [_from_forty(x[2]) for x in split]
    counts = np.concatenate([_unpacked_counts(*x[3:]) for x in split])
    seen = np.flatnonzero(counts)
    context, word, counts = np.concatenate(contexts)[seen], np.concatenate(words)[seen], counts[seen]
    order = np.lexsort((word, context))
    context, word, counts = context[order], word[order], counts[order]
    heads = np.flatnonzero(np.append(True, (context[1:] != context[:-1]) | (word[1:] != word[:-1]))) if len(context) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts, heads) if len(heads) else counts
    trie = PairTrie(context[heads], word[heads], total)
    return [trie.codes_of(c, w).tobytes() for c, w in zip(contexts, words, strict=True)], 0, 0


def distinct_words(rows: DataFrame, most: int = 1 << 22) -> tuple[int, int]:
    """How many distinct words, the end among them, training texts have, and how many only other texts have."""

    small_batches(rows.sparkSession)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = [], []  # of other texts, of training texts
        n = 0

        def told() -> pa.RecordBatch:
            other, trained = (np.unique(np.concatenate([np.zeros(0, np.uint64), *x])) for x in held)
            found = np.concatenate([other, trained])
            flags = np.arange(len(found)) >= len(other)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(flags)], names=["word", "train"])

        for batch in batches:
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, found in words_of(batch.column("text")):
                counted = train[lo:hi]
                of_training = counted[found.doc]
                for kind in (False, True):
                    if (counted == kind).any():
                        held[kind].append(np.append(found.hash[of_training == kind], END))
                        n += len(held[kind][-1])
                if n > most:
                    yield told()
                    held, n = ([], []), 0
        yield told()

    each = rows.select("text", "train").mapInArrow(words, "word long, train boolean").groupBy("word").agg(F.max("train").alias("train"))
    n = each.agg(F.count_if("train").alias("known"), F.count_if(~F.col("train")).alias("unseen")).first()
    return n["known"], n["unseen"]


def score_texts(
    docs: DataFrame,
    train: Column,
    id_column: str = "doc_id",
    text: str = "text",
    strength: float = 8.0,
    unknown: float | None = 0.02,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """A row per document: id, ``in_training``, ``n_tokens``, ``n_known``, ``train_tokens``, ``vocabulary``, ``base_score`` and ``score``.

    The model learns from rows for which ``train`` is true; NULL is false.  Tokens
    are the words of the whole text, A-Z lower-cased, and an end; a NULL or empty
    text is an end alone.  ``base_score`` is the add-one unigram score, ``score`` the
    bigram model's log10 probability.  With ``unknown`` None the unigram model adds
    one to every training word and to an unseen one; a number is the probability of the one event
    "a word never seen", whichever word it is, so then ``score`` is not one of the
    text itself and rises with unseen words.  Each row is a document, also if rows
    repeat or ids are NULL.  Other columns are not read.  Without any training rows all
    words are unknown, and ``base_score`` is 0.  An empty table gives an empty one.
    """
    chosen = F.coalesce(train, F.lit(False))
    whole = F.coalesce(F.col(text), F.lit(""))
    size = docs.agg(
        F.sum(F.octet_length(whole)).alias("bytes"),
        F.sum(F.when(chosen, F.regexp_count(whole, F.lit(f"[^{ASCII_SPACE}]+")).cast("long") + 1)).alias("tokens"),
    ).first()
    parts = max(1, -(-(size["bytes"] or 0) // part_bytes))
    shards, tokens = parts, size["tokens"] or 0
    rows = docs.select(
        F.pmod(row_hash(id_column, text, seed=3), F.lit(parts)).cast("int").alias("part"), F.col(id_column).alias("id"), whole.alias("text"), chosen.alias("train")
    )
    dealt = rows.repartition("part")
    # Other texts must not tell the model anything: only training words are counted, and one more for all unseen.
    n_words = distinct_words(rows.filter("train"))[0] + 1 if unknown is None else 0

    def send(key: tuple, table: pa.Table) -> pa.Table:
        part = tokens_of(table.column("text"))
        counted = table.column("train").to_numpy().astype(bool)[part.doc]
        word_counts = np.bincount(part.word_of[counted], minlength=len(part.words))
        pair_counts = np.bincount(part.pair_of[counted], minlength=len(part.word))
        out: list[tuple] = []
        for kind, shard in ((WORDS, shard_of_words(part.words, shards)), (PAIRS, shard_of_pairs(part.context, part.word, shards))):
            order = np.argsort(shard, kind="stable")
            bounds = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(bounds)):
                at = order[bounds[s] : bounds[s + 1]]
                if kind == WORDS:
                    out.append((kind, int(s), word_blob(part.words[at], word_counts[at])))
                else:
                    out.append((kind, int(s), pair_blob(part.context[at], part.word[at], pair_counts[at])))
        kinds, numbers, blobs = zip(*out, strict=True)
        return pa.table(
            {
                "part": pa.array([key[0].as_py()] * len(out), pa.int32()),
                "kind": pa.array(kinds, pa.int32()),
                "shard": pa.array(numbers, pa.int32()),
                "blob": pa.array(blobs, pa.binary()),
            }
        )

    def reply(key: tuple, table: pa.Table) -> pa.Table:
        replies, vocabulary, _ = answer(key[0].as_py(), table.column("blob").to_pylist())
        n = table.num_rows
        # The number of words that a shard knows goes along with one reply.
        return pa.table(
            {
                "part": table.column("part"),
                "kind": table.column("kind"),
                "shard": table.column("shard"),
                "blob": pa.array(replies, pa.binary()),
                "known": pa.array([vocabulary] + [0] * (n - 1), pa.int64()),
            }
        )

    def score(key: tuple, texts: pa.Table, replies: pa.Table) -> pa.Table:
        part = tokens_of(texts.column("text"))
        said = {(k, s): b for k, s, b in zip(*(replies.column(c).to_pylist() for c in ("kind", "shard", "blob")), strict=True)}
        count, code = np.zeros(len(part.words), np.int64), np.zeros(len(part.word), np.uint8)
        for kind, shard in ((WORDS, shard_of_words(part.words, shards)), (PAIRS, shard_of_pairs(part.context, part.word, shards))):
            order = np.argsort(shard, kind="stable")
            bounds = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(bounds)):
                at, blob = order[bounds[s] : bounds[s + 1]], said[kind, int(s)]
                if kind == WORDS:
                    count[at] = _unpacked_counts(*parted(blob, _COUNTS))
                else:
                    code[at] = np.frombuffer(blob, np.uint8)
        n_docs = texts.num_rows
        own = count[part.word_of]
        # What is the same for all tokens of a word or a pair is computed once for each.
        if unknown is None:
            unigram = (count + 1) / (tokens + n_words)
        else:
            unigram = np.where(count > 0, count / max(tokens, 1) * (1 - unknown), unknown)
        begun = count[np.searchsorted(part.words, END)]  # as many texts begin as end
        p = restored(code)[part.pair_of]
        p += strength * unigram[part.word_of]
        p /= np.where(part.context_word < 0, begun, count[part.context_word]) + strength

        def per_doc(values: np.ndarray) -> np.ndarray:
            return np.bincount(part.doc, values, n_docs)

        docs_out = {
            "id": texts.column("id"),
            "in_training": texts.column("train"),
            "n_tokens": pa.array(np.bincount(part.doc, minlength=n_docs), pa.int64()),
            "n_known": pa.array(per_doc(own > 0).astype(np.int64), pa.int64()),
            "logs": pa.array(per_doc(np.log10(own + 1.0))),
            "score": pa.array(per_doc(np.log10(np.minimum(p, 1.0)))),
            "known": pa.nulls(n_docs, pa.int64()),
        }
        rows = pa.table(docs_out)
        extra = pa.table({name: pa.nulls(1, rows.schema.field(name).type) for name in rows.column_names[:-1]} | {"known": pa.array([sum(replies.column("known").to_pylist())], pa.int64())})
        return pa.concat_tables([rows, extra])

    kind = docs.schema[id_column].dataType.simpleString()
    sent = dealt.groupBy("part").applyInArrow(send, "part int, kind int, shard int, blob binary")
    replied = sent.groupBy("kind", "shard").applyInArrow(reply, "part int, kind int, shard int, blob binary, known long")
    scored = dealt.groupBy("part").cogroup(replied.groupBy("part")).applyInArrow(
        score, f"id {kind}, in_training boolean, n_tokens long, n_known long, logs double, score double, known long"
    )
    scored = saved(scored, "lm-scores")
    vocabulary = scored.agg(F.sum("known")).first()[0] or 0
    per_token = F.lit(math.log10(tokens + vocabulary + 1))
    return scored.filter(F.col("known").isNull()).select(
        F.col("id").alias(id_column), "in_training", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        F.lit(vocabulary).cast("long").alias("vocabulary"), (F.col("logs") - F.col("n_tokens") * per_token).alias("base_score"), "score",
    )
