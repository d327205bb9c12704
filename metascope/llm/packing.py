"""Best-fit packing of token sequences, planned over a histogram of lengths.

Texts are tokenised once; a table of pieces without their ids is written.  The
number of pieces of each length (at most ``capacity`` numbers) goes to the driver,
where best-fit decreasing runs over counts: as many pieces of a length as fit into
open sequences with the least sufficient room take it at one step.  The plan is a
table of slots: pieces of a length with ranks in a range go to consecutive
sequences at one offset.  Its size depends on ``capacity`` only.  Pieces find
their slots by their rank among pieces of their length.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import process_cache, saved, small_batches

# What a worker keeps at most: parts of texts between spaces, and words, each with its ids.
CACHED = 500_000
JOINED = 4096


def _kept_by_regex() -> tuple[re.Pattern, re.Pattern]:
    """The words of a byte-level tokenizer, for texts of common characters, and what finds any other character.

    Only characters whose class is the same in every version of Unicode are taken:
    those up to U+024F and general punctuation.
    """
    common = [*map(chr, range(0x250)), *map(chr, range(0x2010, 0x2028))]

    def of(kind: str) -> str:
        return "".join(re.escape(c) for c in common if unicodedata.category(c).startswith(kind))

    space = "\t\n\x0b\x0c\r \x85\xa0"
    letters, numbers = of("L"), of("N")
    # The contractions that byte-level tokenizers cut off.
    parts = ["'(?:s|t|re|ve|m|ll|d)", f" ?[{letters}]+", f" ?[{numbers}]+", f" ?[^{space}{letters}{numbers}]+", f"[{space}]+(?![^{space}])", f"[{space}]+"]
    return re.compile("|".join(parts)), re.compile("[^\x00-\u024f\u2010-\u2027]")


class TextEncoder:
    """Ids of whole texts by a byte-level tokenizer whose words begin with their space.

    Such a tokenizer never joins what is before a space to the space, if the space
    follows a character that isn't white space; so a text is the sum of its parts
    cut there, and most parts have been seen before.  A new part is cut into the
    tokenizer's words, and only new words are encoded.  Texts with rare characters,
    or that spell out one of the tokenizer's added tokens, are encoded whole.
    """

    def __init__(self, path: str, most: int = CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values() if token.content]
        # Ids are laid over the text by the bytes that they stand for, one per character of their names.
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.widths = np.zeros(max(names.values()) + 1, np.int64)
        self.widths[list(names.values())] = [len(name) for name in names]
        self.most = most
        self.words_in, self.rare = _kept_by_regex()
        self.parts: dict[str, bytes | bool] = {}
        self.words: dict[str, bytes] = {}
        self.passing: set[str] = set()

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in found]

    def _encode_words(self, words: list[str], between: str) -> list[bytes]:
        """Ids of words without white space, that follow a space, which is part of them, or a newline, which isn't.

        Many are encoded as one text, and its ids are cut where the words begin.
        """
        out: list[bytes] = []
        for i in range(0, len(words), JOINED):
            group = words[i : i + JOINED]
            ids = self._encode([between + between.join(group)])[0]
            ends = np.cumsum(self.widths[np.frombuffer(ids, "<u4")])
            wanted = np.cumsum([len(word.encode()) + 1 for word in group])
            at = np.searchsorted(ends, wanted) + 1
            first = np.concatenate([[0], at[:-1]])
            sound = at[-1] <= len(ends) and np.array_equal(ends[at - 1], wanted)
            if sound and between == "\n":
                sound = np.array_equal(ends[first], np.concatenate([[0], wanted[:-1]]) + 1)
                first = first + 1
            if sound:
                out += [ids[4 * lo : 4 * hi] for lo, hi in zip(first.tolist(), at.tolist(), strict=True)]
            else:
                out += self._encode([" " + word if between == " " else word for word in group])
        return out

    def _spelled(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of common characters, word by word."""
        split = [self.words_in.findall(text) for text in texts]
        new = list(set().union(*split) - self.words.keys())
        spaced = [w[1:] for w in new if w[0] == " " and not w[1:2].isspace() and len(w) > 1]
        bare = [w for w in new if not w[0].isspace()]
        self.words.update(zip([" " + w for w in spaced], self._encode_words(spaced, " "), strict=True))
        self.words.update(zip(bare, self._encode_words(bare, "\n"), strict=True))
        other = [w for w in new if w not in self.words]
        self.words.update(zip(other, self._encode(other), strict=True))
        known = self.words.__getitem__
        return [b"".join(map(known, words)) for words in split]

    def _learn(self, parts: set[str]) -> None:
        """Ids of parts that follow a space; False for those that have none of their own."""
        self.parts.update(dict.fromkeys(parts, False))
        # A part that is empty or ends in white space has a space after that, unless it is the last.
        plain = [p for p in parts if p and not p[-1].isspace() and (p.isascii() or not self.rare.search(p))]
        letters = [p for p in plain if p.isalpha()]
        mixed = [p for p in plain if not p.isalpha()]
        self.parts.update(zip(letters, self._encode_words(letters, " "), strict=True))
        self.parts.update(zip(mixed, self._spelled([" " + p for p in mixed]), strict=True))

    def _forget(self) -> None:
        """What was learned beyond the limit: frequent parts come early, so the first ones are the ones to keep."""
        for part in self.passing:
            self.parts.pop(part, None)
        self.passing = set()
        if len(self.words) > self.most:
            self.words = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split, missing, known = [], set(), self.parts.get
        for text in texts:
            first, *rest = text.split(" ")
            ids = list(map(known, rest))
            holes = [i for i, x in enumerate(ids) if x is None] if None in ids else ()
            missing.update([rest[i] for i in holes])
            split.append((first, rest, ids, holes))
        self._learn(missing)
        if len(self.parts) > self.most:
            self.passing = missing
        common = [i for i, (first, *_) in enumerate(split) if not self.rare.search(first)]
        begun: dict[int, bytes] = dict(zip(common, self._spelled([split[i][0] for i in common]), strict=True))
        out: list[bytes | None] = []
        for i, (first, rest, ids, holes) in enumerate(split):
            for hole in holes:
                ids[hole] = known(rest[hole])
            sound = i in begun and (not rest or (first and not first[-1].isspace())) and not any(t in texts[i] for t in self.added)
            try:
                out.append(begun[i] + b"".join(ids) if sound else None)
            except TypeError:  # a part without ids of its own
                out.append(None)
        whole = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]), strict=True):
            out[i] = ids
        self._forget()
        return out


def tokenised_pieces(docs: DataFrame, id_column: str, text: str, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, salt) of every piece, and its ids if asked for; the salt tells equal rows apart."""
    names = ["id", "piece", "start", "length", "ids_crc32", "salt"] + (["ids"] if with_ids else [])
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = process_cache("tokenizers")
        if tokenizer not in cache:
            cache[tokenizer] = TextEncoder(tokenizer)
        encoder = cache[tokenizer]
        done = 0
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            out: list[list] = [[], [], [], [], [], []]
            for row, ids in enumerate(encoder.encode(texts)):
                ids += end
                n = len(ids) // 4
                first = n % capacity or capacity
                bounds = [0, *range(first, n + 1, capacity)]
                for piece, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    part = ids[4 * lo : 4 * hi]
                    for column, value in zip(out, (row, piece, lo, hi - lo, zlib.crc32(part), part), strict=True):
                        column.append(value)
            arrays = [batch.column("id").take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32())]
            arrays += [pa.array(x, pa.int64()) for x in out[2:5]]
            arrays.append(pa.array(np.arange(done, done + len(out[0]))))
            done += len(out[0])
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in out[5]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, salt long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def plan_slots(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Best-fit decreasing over counts of lengths (``counts[n]`` pieces of n tokens).

    Rows (length, first rank, last rank + 1, first sequence, offset), by length and rank.
    """
    open_by_room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # runs (first sequence, how many)
    rooms = np.zeros(capacity + 1, np.int64)
    slots, sequences = [], 0
    for length in range(capacity, 0, -1):
        left, rank = int(counts[length]), 0
        while left:
            fitting = np.flatnonzero(rooms[length:])
            if len(fitting):
                room = length + int(fitting[0])
                first, many = open_by_room[room].pop()
                used = min(left, many)
                if used < many:
                    open_by_room[room].append((first + used, many - used))
                rooms[room] -= used
            else:
                # New sequences take as many pieces of this length each as they can hold.
                room, first = capacity, sequences
                used = max(1, left // (capacity // length))
                sequences += used
            slots.append((length, rank, rank + used, first, capacity - room))
            if room > length:
                open_by_room[room - length].append((first, used))
                rooms[room - length] += used
            rank += used
            left -= used
    return np.asarray(slots, np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    rank_rows: int = 100_000,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``.

    ``tokenizer`` is the path of a tokenizers file on every executor.  A text is
    its ids and then ``end_id``; NULL or empty texts are ``end_id`` alone, and an
    added token of the file that a text spells out is that token.  Longer
    texts are cut into pieces of ``capacity``, of which the first may be shorter.
    Each row of ``docs`` is packed, also if rows repeat or ids are NULL; columns
    other than the two named are not read.  ``with_ids`` adds the ids themselves.
    An empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    pieces = saved(tokenised_pieces(docs, id_column, text, tokenizer, end_id, capacity, with_ids), "pieces")

    # Ranks within a length: positions within a part of it, after the parts before.
    total = pieces.count()
    parts = max(1, -(-total // rank_rows))
    order = ["id", "piece", "start", "ids_crc32", "salt"]
    placed = pieces.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    by_part = saved(placed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    by_length = by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_length:
        counts[row["length"]] = row["n"]
    slots = plan_slots(counts, capacity)
    # One sorted column to search: ranks after their length.
    shift = 1 << 44
    begins = slots[:, 0] * shift + slots[:, 1]

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "part").orderBy(*order)
    ranked = placed.withColumn("within", F.row_number().over(within) - 1).join(starts, ["length", "part"])
    names = ["id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    ranked = ranked.select(*names, (F.col("before") + F.col("within")).cast("long").alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            # Slots are by falling length; their ranges of ranks by rising rank.
            slot = by_key[np.searchsorted(sorted_begins, length * shift + rank, side="right") - 1] if len(length) else np.zeros(0, int)
            sequence = slots[slot, 3] + rank - slots[slot, 1]
            columns = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(slots[slot, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    by_key = np.argsort(begins)
    sorted_begins = begins[by_key]
    schema = ranked.select(*names).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema).withColumnRenamed("id", id_column)
