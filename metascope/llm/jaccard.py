"""Near-duplicate classes by Jaccard similarity of word shingles: a size-aware, heavy-light join.

Sets of at most ``boundary`` shingles are light: every subset of the size that a
partner must share becomes a key.  Larger sets are heavy: their rarest shingles
(as many as any partner must meet) are keys of inverted lists.  The boundary is
chosen by counting the keys and list entries of either way.  Equal sets are one
node from the start.

A list is not expanded into pairs.  First each member meets one pivot only, the
one that most of its lists share.  Then, in rounds, each list with several components
gets a member as new pivot by chance, and each node meets a few of its lists' pivots
in other components: a large group of copies of copies so becomes one component after
pairs in proportion to its members.  Rounds end when few pairs are links.  At last members of different
components of a list meet, unless their distances to a common pivot rule a link
out (Jaccard distance is a metric).  Every pair of nodes with a link either meets
or lies in one component already, so components are exact.  Before sets are compared,
parities of their shingles in as many slots as the sets are large rule most pairs out.

Rarity comes from counts of all shingles of all documents in a table of fixed
size; it only decides the order of shingles, never the result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, row_hash, saved, small_batches
from .components import connected_components
from .words import BASE, Words, mix, words_of

SKETCH_BITS, CHUNK = 20, 1 << 15
MEMBER_BITS = 23
SHORT_LIST = 128
ROUNDS, MEETINGS = 6, 3
LARGEST_BOUNDARY = 14
BITMAP_WORDS = 16


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (unsigned) of each text."""
    bounds, h = words.bounds(), words.hash
    if len(h) >= k:
        rolled = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            rolled = mix(rolled * np.uint64(BASE) + h[j : len(h) - k + 1 + j] + np.uint64(j + 1))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if hi - lo >= k:
            yield np.unique(rolled[lo : hi - k + 1])
        elif hi > lo:
            whole = np.asarray([hi - lo], np.uint64)
            for x in h[lo:hi]:
                whole = mix(whole * np.uint64(31) + x)
            yield whole
        else:
            yield np.zeros(0, np.uint64)


def node_of(shingles: np.ndarray) -> int:
    """64 bits of the set."""
    total = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.asarray([total]))[0].astype(np.int64))


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """The parity of the number of shingles in each slot that hashes give; as many slots as shingles, rounded up to a power of two."""
    size = max(BITMAP_WORDS, 1 << max(0, (len(shingles) - 1) // 64).bit_length())
    slots = np.bincount((mix(shingles) % np.uint64(64 * size)).astype(np.int64), minlength=64 * size)
    return np.packbits((slots & 1).astype(np.uint8), bitorder="little").view(np.int64)


def shortened(sketch: np.ndarray) -> np.ndarray:
    """The sketch that fewer slots would give, the same number for all sets."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, BITMAP_WORDS), axis=0)


def bitmap_of(shingles: np.ndarray) -> np.ndarray:
    """A sketch of the same length for every set."""
    return shortened(sketch_of(shingles))


@dataclass
class Plan:
    """What decides the keys of a set."""

    k: int
    percent: int
    boundary: int = 0
    levels: np.ndarray | None = None
    _subsets: dict = field(default_factory=dict)

    def fewest(self, a: int, b: int | None = None) -> int:
        """The overlap that sets of these sizes need; with one size, that any partner of it needs."""
        if b is None:
            return -(-self.percent * a // 100)
        return -(-self.percent * (a + b) // (100 + self.percent))

    def prefix(self, n: int) -> int:
        return n - self.fewest(n) + 1

    def subset_sizes(self, n: int) -> list[int]:
        partners = range(self.fewest(n), n * 100 // self.percent + 1)
        return sorted({o for m in partners if (o := self.fewest(n, m)) <= min(n, m)})

    def n_subsets(self, n: int) -> int:
        return sum(math.comb(n, o) for o in self.subset_sizes(n))

    def posts_prefix(self, n: int) -> bool:
        return n > self.boundary or n >= self.fewest(self.boundary + 1)

    def ordered(self, shingles: np.ndarray) -> np.ndarray:
        """Rarer shingles first; any fixed order is correct."""
        if self.levels is None:
            return shingles
        level = self.levels[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
        return shingles[np.lexsort((shingles, level))]

    def keys(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and positions of heavy keys in the order (-1: a subset)."""
        n, keys, at = len(shingles), [], []
        if n and self.posts_prefix(n):
            p = self.prefix(n)
            keys.append(self.ordered(shingles)[:p])
            at.append(np.arange(p))
        if n and n <= self.boundary:
            for o in self.subset_sizes(n):
                if (n, o) not in self._subsets:
                    self._subsets[n, o] = np.asarray(list(itertools.combinations(range(n), o)))
                sums = mix(shingles)[self._subsets[n, o]].sum(axis=1, dtype=np.uint64)
                keys.append(mix(mix(sums) + np.uint64(o)))
                at.append(np.full(len(sums), -1))
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(at)


def _sets(docs: DataFrame, id_column: str, text: str, k: int) -> DataFrame:
    """A row per document (id, r1, r2, n, node, bits, sketch); and, with a chunk, counts of shingles in chunks of a table.

    The sketch is NULL where it is no longer than the bitmap.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        seen: set[int] = set()
        for batch in batches:
            n, node, bits, sketches = [], [], [], []
            for _, _, words in words_of(batch.column("text")):
                for shingles in shingle_sets(words, k):
                    n.append(len(shingles))
                    sketch = sketch_of(shingles)
                    bits.append(shortened(sketch))
                    sketches.append(sketch if len(sketch) > BITMAP_WORDS else None)
                    node.append(node_of(shingles) if len(shingles) else None)
                    if len(shingles) and node[-1] not in seen:
                        seen.add(node[-1])
                        np.add.at(counts, (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("r1"), batch.column("r2"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(bits, longs), pa.array(sketches, longs), *none],
                names=names,
            )
        if seen:
            parts = counts.reshape(-1, CHUNK)
            m = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, batch.column("id").type), *[pa.nulls(m, pa.int64())] * 4, *[pa.nulls(m, longs)] * 2, pa.array(range(m), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())],
                names=names,
            )

    names, longs = ["id", "r1", "r2", "n", "node", "bits", "sketch", "chunk", "counts"], pa.list_(pa.int64())
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(
        F.col(id_column).alias("id"), F.col(text).alias("text"), row_hash(id_column, text, seed=1).alias("r1"), row_hash(id_column, text, seed=2).alias("r2")
    )
    return source.mapInArrow(scan, f"id {kind}, r1 long, r2 long, n long, node long, bits array<long>, sketch array<long>, chunk int, counts binary")


def _sketch(found: DataFrame) -> np.ndarray:
    """The counts of all tasks together: a table of fixed size."""

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.uint64)
        for blob in table.column("counts"):
            total += np.frombuffer(blob.as_py(), np.uint32)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    parts = found.filter(F.col("chunk").isNotNull()).select("chunk", "counts")
    # A first sum per group of tasks keeps each sum to some hundred tables.
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(64)))

    def add_salted(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.uint32)
        for blob in table.column("counts"):
            total += np.frombuffer(blob.as_py(), np.uint32)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    summed = salted.groupBy("chunk", "salt").applyInArrow(add_salted, "chunk int, counts binary")
    rows = summed.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect()
    whole = np.zeros((1 << SKETCH_BITS) // CHUNK * CHUNK, np.uint64).reshape(-1, CHUNK)
    for row in rows:
        whole[row["chunk"]] = np.frombuffer(bytes(row["counts"]), np.uint64)
    return whole.ravel()


def _levels(counts: np.ndarray) -> np.ndarray:
    """How far each count lies above what chance gives it: 0, or the doublings of the excess."""
    load = counts.mean()
    excess = counts - load - 6 * math.sqrt(load) - 6
    return np.where(excess > 0, np.log2(np.maximum(excess, 1)) + 1, 0).astype(np.uint8)


def choose_boundary(sizes: dict[int, int], counts: np.ndarray, plan: Plan) -> int:
    """The largest light size: of all choices the one with the fewest subsets and expected list entries."""
    total = float(counts.sum())
    load = counts.mean()
    length = 1 + float((counts * np.maximum(counts - load, 0)).sum()) / total if total else 1.0
    best = (math.inf, 0)
    for boundary in range(LARGEST_BOUNDARY + 1):
        trial = Plan(plan.k, plan.percent, boundary)
        cost = 0.0
        for n, many in sizes.items():
            if n <= boundary:
                cost += many * trial.n_subsets(n)
            if trial.posts_prefix(n):
                cost += many * trial.prefix(n) * length
        best = min(best, (cost, boundary))
    return best[1]


def _lists(docs: DataFrame, text: str, plan: Plan) -> DataFrame:
    """The lists of at least two nodes: (key, node, n, at, pivot, pivot_n, pivot_at)."""
    k = plan.k

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, words in words_of(batch.column("text")):
                out = [], [], [], []
                for shingles in shingle_sets(words, k):
                    if not len(shingles) or (node := node_of(shingles)) in seen:
                        continue
                    seen.add(node)
                    keys, at = plan.keys(shingles)
                    for column, values in zip(out, (keys, np.full(len(keys), node), np.full(len(keys), len(shingles)), at), strict=True):
                        column.append(values)
                if out[0]:
                    key, node, n, at = (np.concatenate(x) for x in out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(node), pa.array(n.astype(np.int32)), pa.array(at.astype(np.int32))],
                        names=["key", "node", "n", "at"],
                    )

    percent = plan.percent

    def viable(rows: list[tuple]) -> list[bool]:
        """Which rows (node, n, at) of a list have a partner whose size and place admit a link."""
        if len(rows) == 2:
            (_, n, at), (_, m, to) = rows
            least = min(n if at < 0 else n - at, m if to < 0 else m - to)
            return [least * 100 >= (n + m - least) * percent] * 2
        n, at = np.asarray([r[1] for r in rows]), np.asarray([r[2] for r in rows])
        rest = np.where(at < 0, n, n - at)
        least = np.minimum(rest[:, None], rest[None, :])
        fits = least * 100 >= (n[:, None] + n[None, :] - least) * percent
        np.fill_diagonal(fits, False)
        return fits.any(axis=1).tolist()

    def pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by key, n and node: drops lists of one node, and gives each row its pivot.

        A pivot serves the rows whose size admits a link with it; then the next row is one.
        Rows of short lists without a possible partner go; a list over ``SHORT_LIST`` rows is
        passed on as it comes, so that the state is small whatever a list's length.
        """
        key, held, long_ = None, [], False
        pivot: tuple = ()
        out: list[list] = [[] for _ in names]

        def give(rows: list[tuple]) -> None:
            nonlocal pivot
            for row in rows:
                if not pivot or pivot[1] * 100 < percent * row[1]:
                    pivot = row
                for column, value in zip(out, (key, *row, pivot[0], pivot[1], pivot[2]), strict=True):
                    column.append(value)

        def close() -> None:
            if not long_ and len(held) > 1:
                give([row for row, ok in zip(held, viable(held), strict=True) if ok])

        last = None
        for batch in batches:
            # Inside a batch a key that its neighbours don't share is a list of one node.
            keys = batch.column("key").to_numpy()
            shared = np.append(keys[1:] == keys[:-1], True)
            shared[1:] |= shared[:-1]
            shared[:1] = True
            batch = batch.filter(pa.array(shared))
            for k_, *row in zip(*(batch.column(c).to_numpy().tolist() for c in ("key", "node", "n", "at")), strict=True):
                if k_ != key:
                    close()
                    key, held, long_, pivot, last = k_, [], False, (), None
                if row[0] == last:
                    continue
                last = row[0]
                if long_:
                    give([tuple(row)])
                    continue
                held.append(tuple(row))
                if len(held) > SHORT_LIST:
                    give(held)
                    held, long_ = [], True
            if out[0]:
                yield pa.RecordBatch.from_pydict(dict(zip(names, (pa.array(x, t) for x, t in zip(out, types, strict=True)), strict=True)))
                out = [[] for _ in names]
        close()
        if out[0]:
            yield pa.RecordBatch.from_pydict(dict(zip(names, (pa.array(x, t) for x, t in zip(out, types, strict=True)), strict=True)))

    names = ["key", "node", "n", "at", "pivot", "pivot_n", "pivot_at"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
    posted = docs.select(F.col(text).alias("text")).mapInArrow(post, "key long, node long, n int, at int")
    dealt = posted.repartition("key").sortWithinPartitions("key", "n", "node")
    return dealt.mapInArrow(pair_up, "key long, node long, n int, at int, pivot long, pivot_n int, pivot_at int")


def _similar(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return overlap * 100 >= (a + b - overlap) * percent


def _differing(a: str, b: str) -> Column:
    """The number of bits in which two bitmaps differ."""
    words = [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(BITMAP_WORDS)]
    return sum(words[1:], words[0])


def _differing_sketches(a: Column, b: Column) -> Column:
    """The number of bits in which two sketches differ, of which one may be twice as long."""
    size = F.least(F.size(a), F.size(b))

    def folded(x: Column) -> Column:
        halves = F.zip_with(F.slice(x, F.lit(1), size), F.slice(x, size + 1, size), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > size, halves).otherwise(x)

    words = F.zip_with(folded(a), folded(b), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(words, F.lit(0), lambda total, x: total + x)


def _admitted(differing: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether bitmaps or sketches leave enough for a link.

    A shingle in one set only changes one parity, so the bits in which two
    bitmaps differ bound the overlap from above.
    """
    return _similar(F.floor((a + b - differing) / 2), a, b, percent)


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sizes and sketches don't rule out."""
    sketch = F.coalesce("sketch", "bits")
    one, two = (nodes.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), sketch.alias(f"{x}_sketch")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b")
    both = both.filter(_similar(F.least("a_n", "b_n"), F.col("a_n"), F.col("b_n"), percent))
    return both.filter(_admitted(_differing_sketches(F.col("a_sketch"), F.col("b_sketch")), F.col("a_n"), F.col("b_n"), percent)).select(*pairs.columns)


def _members(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, id_column: str, text: str, k: int) -> DataFrame:
    """(node, n, shingles) of the wanted nodes, each made anew from the text of one document."""
    chosen = saved(nodes.join(wanted, "node", "left_semi").select("r1", "r2").distinct(), "chosen-rows")
    # A bitmap of fixed size spares most other rows the join.
    slot = f"shiftrightunsigned(r1, {64 - MEMBER_BITS})"
    marks = chosen.groupBy(F.expr(f"cast({slot} div 64 as int)").alias("at")).agg(F.expr(f"bit_or(shiftleft(1L, cast({slot} % 64 as int)))").alias("bits"))
    marked = np.zeros(1 << (MEMBER_BITS - 6), np.uint64)
    for row in marks.collect():
        marked[row["at"]] = np.uint64(row["bits"] % (1 << 64))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("r1").to_numpy().view(np.uint64) >> np.uint64(64 - MEMBER_BITS)
            yield batch.filter(pa.array((marked[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [x for _, _, words in words_of(batch.column("text")) for x in shingle_sets(words, k)]
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array([node_of(x) for x in sets], pa.int64()),
                    "n": pa.array([len(x) for x in sets], pa.int32()),
                    "shingles": pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                }
            )

    source = docs.select(row_hash(id_column, text, seed=1).alias("r1"), row_hash(id_column, text, seed=2).alias("r2"), F.col(text).alias("text"))
    kept = source.mapInArrow(sift, source.schema).join(chosen, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"])
    return kept.select("text").mapInArrow(scan, "node long, n int, shingles array<long>")


def _measured(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their exact Jaccard similarity, and whether it makes a link."""
    one, two = (members.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("shingles").alias(f"{x}_set")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b")
    both = both.select("a", "b", "a_n", "b_n", F.size(F.array_intersect("a_set", "b_set")).alias("overlap"))
    union = F.col("a_n") + F.col("b_n") - F.col("overlap")
    linked = _similar(F.col("overlap"), F.col("a_n"), F.col("b_n"), percent)
    return both.select("a", "b", (F.col("overlap") / union).alias("similarity"), linked.alias("linked"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: the id, ``n_shingles`` and ``component_id``, the smallest id among its near duplicates.

    A set is the distinct ``k``-word shingles of the whole text, A-Z lower-cased;
    a text of fewer words is one shingle; a NULL text or one without words has
    none, and is linked with nothing.  Two documents are linked if their
    similarity is at least ``percent`` / 100.  Rows with equal sets are linked,
    also with equal or NULL ids; a component without any id has a NULL one.
    Columns of ``docs`` other than these two are not read.  Sets are told apart
    by 64 bits, and so are shingles.
    """
    placed = classified(docs, id_column, text, k, percent)
    least = placed.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("component_id"))
    whole = placed.join(least, "root", "left")
    own = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return whole.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component of near duplicates, that of the smallest id (NULLs last).

    Of equal rows one stays.  Texts without words are no one's duplicates: all stay.
    """
    placed = classified(docs, id_column, text, k, percent).filter(F.col("root").isNotNull())
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "r1", "r2")).alias("r"))
    first = first.select(F.col("r.r1").alias("r1"), F.col("r.r2").alias("r2"))
    told = [row_hash(id_column, text, seed=1).alias("r1"), row_hash(id_column, text, seed=2).alias("r2")]
    worded = F.coalesce(F.col(text).rlike(f"[^{ASCII_SPACE}]"), F.lit(False))
    rows = docs.filter(worded).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *told)
    chosen = rows.join(first, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"]).select("doc.*")
    return chosen.unionByName(docs.filter(~worded))


def _open(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The lists that still hold more than one component, with the component of each member as ``part``."""
    named = roots.select("node", F.col("root").alias("part"))
    labelled = lists.drop("part").join(named, "node", "left").withColumn("part", F.coalesce("part", "node"))
    mixed = labelled.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y").select("key")
    return labelled.join(mixed, "key", "left_semi").select(*lists.drop("part").columns, "part")


def _by_chance(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components: each list gets a pivot by chance, each node meets some of its lists' pivots."""
    drawn = F.min(F.struct(F.xxhash64("key", "node", F.lit(turn)).alias("chance"), "node", "n", "at", "part"))
    pivots = lists.groupBy("key").agg(drawn.alias("p"))
    both = lists.select("key", "node", "n", "at", "part").join(pivots, "key").filter("part <> p.part")
    rest = F.when(F.col("at") < 0, F.least("n", "p.n")).otherwise(F.least(F.col("n") - F.col("at"), F.col("p.n") - F.col("p.at")))
    both = both.filter(_similar(rest, F.col("n"), F.col("p.n"), percent))
    meetings = [F.min(F.struct(F.xxhash64("p.node", F.lit(turn), F.lit(i)), F.col("p.node").alias("a"))).alias(f"m{i}") for i in range(MEETINGS)]
    met = both.groupBy("node").agg(*meetings).select("node", F.explode(F.array_distinct(F.array(*[f"m{i}.a" for i in range(MEETINGS)]))).alias("a"))
    return met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def classified(docs: DataFrame, id_column: str, text: str, k: int, percent: int) -> DataFrame:
    """(id, r1, r2, n, root) for every document; the root is NULL for texts without words."""
    small_batches(docs.sparkSession)
    found = saved(_sets(docs, id_column, text, k), "shingle-sets")
    rows = found.filter(F.col("chunk").isNull())
    counts = _sketch(found)
    sizes = rows.filter((F.col("n") > 0) & (F.col("n") <= LARGEST_BOUNDARY * 2)).groupBy("n").agg(F.count(F.lit(1)).alias("many")).collect()
    plan = Plan(k, percent, levels=_levels(counts))
    plan.boundary = choose_boundary({r["n"]: r["many"] for r in sizes}, counts, plan)

    nodes = saved(rows.filter(F.col("node").isNotNull()).select("node", F.col("n").cast("int").alias("n"), "bits", "sketch", "r1", "r2").dropDuplicates(["node"]), "shingle-nodes")
    lists = saved(_lists(docs, text, plan), "shingle-lists")

    members: DataFrame | None = None
    tested: DataFrame | None = None

    def measured(pairs: DataFrame) -> DataFrame:
        """Saved similarities of the pairs that may be links; sets are made once for each node."""
        nonlocal members, tested
        tested = pairs if tested is None else tested.unionByName(pairs)
        pairs = saved(_possible(pairs, nodes, percent), "possible-pairs")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        if members is not None:
            wanted = wanted.join(members.select("node"), "node", "left_anti")
        made = saved(_members(docs, nodes, wanted, id_column, text, k), "shingle-members")
        members = made if members is None else members.unionByName(made)
        return saved(_measured(pairs, members, percent), "shingle-links")

    def untested(pairs: DataFrame) -> DataFrame:
        done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return pairs.join(done, ["a", "b"], "left_anti")

    # Each node and the pivot of most of its lists, of those that places admit.
    rest = F.when(F.col("at") < 0, F.col("n")).otherwise(F.least(F.col("pivot_n") - F.col("pivot_at"), F.col("n") - F.col("at")))
    near_pivot = (F.col("node") != F.col("pivot")) & _similar(rest, F.col("pivot_n"), F.col("n"), percent)
    met = lists.filter(near_pivot).groupBy(F.col("pivot").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    star = met.groupBy("b").agg(F.max(F.struct("times", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    known = measured(saved(star, "shingle-pairs"))

    # Rounds with pivots by chance, on the lists that still hold more than one component.
    left, more = lists.select("key", "node", "n", "at", "pivot"), True
    for turn in range(ROUNDS + 1):
        roots = saved(connected_components(known.filter("linked").select("a", "b")), "shingle-roots")
        left = saved(_open(left, roots), "open-lists")
        if not more or turn == ROUNDS:
            break
        pairs = saved(untested(_by_chance(left, turn, percent)), "shingle-pairs")
        met_again = measured(pairs)
        known = known.unionByName(met_again)
        more = met_again.filter("linked").count() * 10 > pairs.count()

    # At last all members of different components, with the distance of each to its list's first pivot.
    distances = known.select(F.col("a").alias("pivot"), F.col("b").alias("node"), (1 - F.col("similarity")).alias("away"))
    distances = distances.union(known.select("b", "a", 1 - F.col("similarity"))).distinct()
    open_lists = left.join(distances, ["pivot", "node"], "left")
    open_lists = open_lists.withColumn("away", F.when(F.col("pivot") == F.col("node"), F.lit(0.0)).otherwise(F.col("away")))
    open_lists = open_lists.join(nodes.select("node", "bits"), "node")
    open_lists = saved(open_lists.select("key", "node", "n", "at", "part", "pivot", "away", "bits"), "open-lists")
    a, b = open_lists.alias("a"), open_lists.alias("b")
    fits = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.node") < F.col("b.node"))
        & (F.col("a.part") != F.col("b.part"))
        & (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent)
    )
    # The first shared shingle leaves at most what follows it in both sets.
    rest = F.when(F.col("a.at") < 0, F.least("a.n", "b.n")).otherwise(F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at")))
    fits &= _similar(rest, F.col("a.n"), F.col("b.n"), percent)
    apart = (F.col("a.pivot") != F.col("b.pivot")) | F.col("a.away").isNull() | F.col("b.away").isNull()
    apart |= F.abs(F.col("a.away") - F.col("b.away")) <= 1 - percent / 100 + 1e-9
    fits &= _admitted(_differing("a.bits", "b.bits"), F.col("a.n"), F.col("b.n"), percent)
    across = a.join(b, fits & apart).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    last = measured(saved(untested(across), "shingle-pairs"))
    links = known.unionByName(last).filter("linked").select("a", "b")
    roots = connected_components(links)
    return rows.join(roots, "node", "left").select("id", "r1", "r2", "n", F.coalesce("root", "node").alias("root"))
