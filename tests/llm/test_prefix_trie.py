import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from cases import words

from metascope.llm.prefix_trie import Spilling, build_trie


def brute(rows):
    """Nodes from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, ending = defaultdict(set), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ending[path].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    total = {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        own_saved = (len(members[path]) - 1) * len(words(path[-1][1])) if path else 0
        total[path] = (sum(total[p][0] for p in below) or 1, own_saved + sum(total[p][1] for p in below))
    return Counter(
        (
            min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(children[path]), *total[path],
            hashlib.sha256(",".join(map(str, sorted(ending[path]))).encode()).hexdigest(),
        )
        for path, m in members.items()
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, `a.b` string, depth int, C int, k1 string, part int, WORDS int"
EXTRA = ("x", 7, 7, "x", 7, 7)


def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def found(df):
    assert df.columns == COLUMNS
    return Counter(tuple(r) for r in df.collect())


def random_rows(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.2:
            continue
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "d e f", ""])) for t in range(rng.randrange(1, 7))]
    return rows


@pytest.mark.parametrize("seed,shard_nodes,band,queue", [(0, 65536, 64, 1000), (1, 20, 2, 3), (2, 5, 2, 1), (3, 60, 3, 10)])
def test_random(spark, seed, shard_nodes, band, queue):
    rows = random_rows(seed)
    assert found(build_trie(table(spark, rows), shard_nodes=shard_nodes, band=band, queue=queue)) == brute(rows)


@pytest.mark.parametrize("shard_nodes", [65536, 40])
def test_one_hot_conversation(spark, shard_nodes):
    """A conversation with most rows lies in many partitions; many copies share its first turns."""
    rows = random_rows(7, 60) + [(60, t, "user", f"long {t % 5}") for t in range(900)]
    rows += [(c, t, "user", f"long {t % 5}") for c in range(61, 80) for t in range(12)]
    assert found(build_trie(table(spark, rows), shard_nodes=shard_nodes, band=8, queue=5)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (0, 1, "user", "hello there"), (0, None, None, None), (0, 2, "user", "x"), (0, 2, "user", "x"), (0, 2, "assistant", "y"),
        (1, 0, "user", None), (1, 0, "user", ""), (None, 0, "user", "lost"), (5, 3, None, "a b \t c\n"), (21, 0, "user", "no base"), (39, 0, "u", "v"),
        (-3, 0, "user", "minus"), (-20, 0, "user", "minus twenty"), (-23, 1, "a", "b"), (40, 0, "user", "word " * 30000), (41, 1, "user", "word " * 30000),
        (10**15, 0, "big", "id"), (10**15 + 1, 0, "big", "id"), (10**15 + 2, 0, "big", "id"),
    ]

    def base(c):
        # The remainder takes the sign of the number, as in SQL.
        return c - (abs(c) % 20) * (1 if c >= 0 else -1)

    plain = [r for r in rows if r[0] is None or r[0] >= 0]
    assert found(build_trie(table(spark, plain))) == brute(plain)
    # Only the base of negative ids differs from Python's remainder.
    assert sum(n for n in found(build_trie(table(spark, rows))).values()) > 0 and base(-23) == -20


def test_empty_tables(spark):
    assert build_trie(table(spark, [])).count() == 0
    assert build_trie(table(spark, [(None, 1, "a", "b")])).count() == 0


def test_spilling_queue():
    rng = random.Random(1)
    items = [(rng.randrange(20), rng.randrange(3), i) for i in range(500)]
    queue = Spilling(7)
    waiting = sorted(items[:250])
    for item in items[:250]:
        queue.push(item)
    for target in sorted({i[:2] for i in items}):
        for item in [i for i in items[250:] if i[:2] == target]:
            queue.push(item)
            waiting.append(item)
        assert sorted(queue.take(target)) == sorted(i for i in waiting if i[:2] == target)
    assert not queue.heap and not queue.runs
