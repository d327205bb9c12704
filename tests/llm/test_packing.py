from collections import Counter, defaultdict
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import docs, odd_rows, plain
from tokenizers import Tokenizer

from metascope.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_parts_give_the_ids_of_the_whole(tokenizer):
    rng = random.Random(1)
    texts = ["", " ", "a b", "a  b", "a   b", "a\n b", "a \nb", "a\n \nb", " a", "a ", "it's a dog's", "<|endoftext|> x", "x <|endoftext|>", "é ü　 ñ", "a <|endoftext|> b", "Ωμέγα test", "l’été “x” … y", "x\x85y z\xa0w", "ab\u2028cd ef", "a'll b'LL 's ' s", "12½ x²"]
    texts += ["".join(rng.choice(" \n\tab'sé1.!~’Ω") for _ in range(rng.randint(0, 16))) for _ in range(3000)]
    encoder = packing.TextEncoder(PATH, most=500)
    for lo in range(0, len(texts), 400):
        part = texts[lo : lo + 400]
        for text, ids in zip(part, encoder.encode(part), strict=True):
            assert list(np.frombuffer(ids, "<u4")) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def check(rows, found, tokenizer, capacity):
    want = Counter()
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, piece, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_odd_rows(spark, tokenizer):
    rows = [(r[0], r[1]) for r in odd_rows()]
    for capacity, rank_rows in ((2048, 100_000), (64, 7)):
        found = packing.pack(docs(spark), PATH, capacity=capacity, rank_rows=rank_rows).collect()
        check(rows, found, tokenizer, capacity)
    assert packing.pack(docs(spark, []), PATH).count() == 0


def test_ids_come_along(spark, tokenizer):
    [row] = packing.pack(plain(spark, ["one two"]), PATH, with_ids=True).collect()
    assert row["ids"] == [*tokenizer.encode("one two", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    capacity = 100
    lengths = np.sort(rng.integers(1, capacity + 1, 400))[::-1]
    rooms: list[int] = []
    for n in lengths:
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms[rooms.index(min(fitting))] -= int(n)
        else:
            rooms.append(capacity - int(n))
    slots = packing.plan_slots(np.bincount(lengths, minlength=capacity + 1), capacity)
    sequences = {int(f) + k for _, a, b, f, _ in slots for k in range(int(b - a))}
    assert len(sequences) <= len(rooms)
    used = Counter()
    for n, a, b, f, offset in slots:
        for k in range(int(b - a)):
            assert used[int(f) + k] == offset
            used[int(f) + k] += int(n)
    assert max(used.values()) <= capacity and sum(used.values()) == lengths.sum()
