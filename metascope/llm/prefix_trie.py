"""Prefix trie of conversations, with subtree totals by time-forward processing.

Turns are put in order by range partitions, so that a conversation of any length is
many tasks' work: each task counts and combines its own stretch, and what earlier
stretches of the same conversation add is a small table (a row per conversation and
partition that it crosses).  A node is known by its depth and by the exclusive or of
128-bit hashes of (place, role, text) over its path.  Nodes come from an aggregate
that Spark combines before it shuffles.

Subtree totals go from the leaves to the root.  Nodes lie in reverse level order (an
external sort); each sends its totals to its parent through a priority queue that
spills, and takes what was sent to itself.  Shards are

- whole subtrees with at most ``shard_nodes`` turns below a heavier parent; their
  roots send on to the heavier nodes above;
- then the heavier nodes: in one shard if they are few, else in bands of levels.
  Each band's roots get their totals within their band first, those of all bands are
  summed over the tree of band roots (by the same steps), and then every band is
  passed once more with what its child bands have sent.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

HEADS = 3  # at most crc32 % 4 turns come from the block's first conversation
BLOCK = 20
CHUNK = 4096
KEY = ["depth", "k1", "k2"]


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).cast("long")


def _in_order(rows: DataFrame, key: str, order: list[str], purpose: str) -> DataFrame:
    """``rows`` in range partitions by ``key`` and ``order``, with ``part`` and the place ``at`` (from 1) among a key's rows there."""
    names = rows.columns
    ranged = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(key, *order, "tie").sortWithinPartitions(key, *order, "tie")
    # The number rises by one with each row of a partition, whose number is in the upper bits.
    numbered = ranged.select(*names, F.monotonically_increasing_id().alias("line"))
    written = saved(numbered.select(*names, "line", F.shiftright("line", 33).alias("part")), purpose)
    first = written.groupBy("part", key).agg(F.min("line").alias("first"))
    return written.join(first, ["part", key]).select(*names, "part", (F.col("line") - F.col("first") + 1).alias("at"))


def ordered_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, place, role and text as h1 and h2, words) of all turns; NULL ids are no conversation."""
    said = [F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")]
    rows = conversations.select(F.col(f"`{conv}`").cast("long").alias("c"), F.col(f"`{turn}`").alias("turn"), *said).filter("c is not null")
    hashes = [F.xxhash64(F.lit(k), "role", "text").alias(f"h{k}") for k in (1, 2)]
    rows = rows.select("c", "turn", "role", "text", *hashes, word_count(F.col("text")).alias("words"))
    placed = _in_order(rows, "c", ["turn", "role", "text"], "turns").select("c", "h1", "h2", "words", "part", "at")
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = placed.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n"))
    stretches = stretches.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("c", "part", "before")
    return placed.join(stretches, ["c", "part"]).select("c", (F.col("at") + F.col("before")).alias("place"), "h1", "h2", "words")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (c, h, base, given, length) and their rebuilt turns (c, depth, h1, h2, words, length)."""
    own = turns.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    convs = own.select("c", "own", (F.crc32(F.col("c").cast("string")) % 4).alias("h"), (F.col("c") - F.col("c") % BLOCK).alias("base"))
    bases = own.select(F.col("c").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(bases, "base", "left").withColumn("given", F.least("h", F.coalesce("base_own", F.lit(0))))
    length = F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = saved(convs.select("c", "h", "base", "given", length.alias("length")), "conversations")

    heads = turns.filter(F.col("place") <= HEADS).select(F.col("c").alias("base"), F.col("place").alias("depth"), "h1", "h2", "words")
    given = convs.filter("given > 0").join(heads, "base").filter("depth <= given").select("c", "depth", "h1", "h2", "words", "length")
    kept = turns.join(convs, "c").filter("place > h")
    kept = kept.select("c", (F.col("place") - F.col("h") + F.col("given")).alias("depth"), "h1", "h2", "words", "length")
    return convs, given.unionByName(kept)


def paths(rebuilt: DataFrame) -> DataFrame:
    """(c, depth, length, words, key k1 and k2 of the node, key p1 and p2 of its parent), one row per turn."""
    steps = rebuilt.select("c", "depth", "length", "words", *[F.xxhash64("depth", f"h{k}").alias(f"h{k}") for k in (1, 2)])
    ranged = steps.repartitionByRange("c", "depth").sortWithinPartitions("c", "depth").withColumn("part", F.spark_partition_id())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Running exclusive ors within the partition, restarted at each conversation."""
        last, carried = None, {"h1": np.int64(0), "h2": np.int64(0)}
        for batch in batches:
            if not batch.num_rows:
                continue
            c = batch.column(0).to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
            out = {}
            for name in ("h1", "h2"):
                h = batch.column(batch.schema.get_field_index(name)).to_numpy()
                run = np.bitwise_xor.accumulate(h)
                offset = np.zeros(len(begins), np.int64)
                offset[1:] = run[begins[1:] - 1]
                if c[0] == last:
                    offset[0] ^= carried[name]
                run ^= np.repeat(offset, np.diff(np.append(begins, len(c))))
                carried[name] = run[-1]
                out[name] = run
            last = c[-1]
            columns = [pa.array(out[name]) if name in out else batch.column(i) for i, name in enumerate(batch.schema.names)]
            before = [pa.array(out[n] ^ batch.column(batch.schema.get_field_index(n)).to_numpy()) for n in ("h1", "h2")]
            yield pa.RecordBatch.from_arrays(columns + before, names)

    names = ["c", "depth", "length", "words", "h1", "h2", "part", "q1", "q2"]
    local = saved(ranged.mapInArrow(add, "c long, depth long, length long, words long, h1 long, h2 long, part int, q1 long, q2 long"), "paths")
    ends = local.groupBy("c", "part").agg(*[F.max_by(f"h{k}", "depth").alias(f"h{k}") for k in (1, 2)])
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("c", "part", *[F.coalesce(F.bit_xor(f"h{k}").over(before), F.lit(0)).alias(f"o{k}") for k in (1, 2)])
    joined = local.join(ends, ["c", "part"])
    keys = [F.col(f"h{k}").bitwiseXOR(F.col(f"o{k}")).alias(f"k{k}") for k in (1, 2)]
    parents = [F.col(f"q{k}").bitwiseXOR(F.col(f"o{k}")).alias(f"p{k}") for k in (1, 2)]
    return saved(joined.select("c", "depth", "length", "words", *keys, *parents), "node-paths")


def trie_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """All nodes with members, own saved tokens, ``weight`` (turns in the subtree) and number of children."""
    one = [F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id")]
    below = F.sum(F.col("length") - F.col("depth") + 1).alias("weight")
    inner = turns.groupBy(*KEY).agg(F.max("p1").alias("p1"), F.max("p2").alias("p2"), *one, F.max("words").alias("words"), below)
    zero = F.lit(0).cast("long")
    root = convs.agg(*one, F.sum("length").alias("weight")).filter("n_convs > 0")
    root = root.select(*[zero.alias(k) for k in (*KEY, "p1", "p2", "words")], "n_convs", "conv_id", "weight")
    inner = saved(inner, "inner-nodes")
    children = inner.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = inner.unionByName(root).join(children, KEY, "left")
    own = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    n_children = F.coalesce("n_children", F.lit(0)).alias("n_children")
    leaf = F.col("n_children").isNull().cast("long").alias("leaves")
    return saved(nodes.select(*KEY, "p1", "p2", "conv_id", "n_convs", "weight", n_children, leaf, own), "nodes")


class Spilling:
    """A priority queue of tuples that keeps at most ``most`` in memory; the rest lies in sorted runs on the task's own disk."""

    def __init__(self, most: int):
        self.most = most
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (first tuple, number of the run, the run's others)
        self.spilled = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            file = tempfile.TemporaryFile()
            for one in sorted(self.heap):
                pickle.dump(one, file)
            file.seek(0)
            self.heap = []
            self.spilled += 1
            self._next(self.spilled, self._read(file))

    @staticmethod
    def _read(file) -> Iterator[tuple]:  # noqa: ANN001
        with file:
            while True:
                try:
                    yield pickle.load(file)
                except EOFError:
                    return

    def _next(self, number: int, run: Iterator[tuple]) -> None:
        first = next(run, None)
        if first is not None:
            heapq.heappush(self.runs, (first, number, run))

    def take(self, target: tuple) -> Iterator[tuple]:
        """All items that begin with ``target``, given that none is smaller."""
        n = len(target)
        while self.heap and self.heap[0][:n] == target:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:n] == target:
            first, number, run = heapq.heappop(self.runs)
            self._next(number, run)
            yield first


def forward(nodes: DataFrame, unit: int, most: int) -> DataFrame:
    """``nodes`` of whole shards with ``leaves`` and ``saved`` summed over the subtree within the shard.

    Rows come in reverse level order; ``top`` marks a shard's root, which sends nothing.
    A parent lies ``unit`` levels up.
    """

    def process(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = Spilling(most)
        for batch in batches:
            names = batch.schema.names
            column = {name: batch.column(i).to_pylist() for i, name in enumerate(names) if name in ("depth", "k1", "k2", "p1", "p2", "leaves", "saved", "top")}
            leaves, saved_ = column["leaves"], column["saved"]
            for i, (d, k1, k2) in enumerate(zip(column["depth"], column["k1"], column["k2"], strict=True)):
                for message in queue.take((-d, k1, k2)):
                    leaves[i] += message[3]
                    saved_[i] += message[4]
                if not column["top"][i]:
                    queue.push((unit - d, column["p1"][i], column["p2"][i], leaves[i], saved_[i]))
            new = {"leaves": pa.array(leaves, pa.int64()), "saved": pa.array(saved_, pa.int64())}
            yield pa.RecordBatch.from_arrays([new.get(name, batch.column(i)) for i, name in enumerate(names)], names)

    return nodes.sortWithinPartitions(F.desc("depth"), "k1", "k2").mapInArrow(process, nodes.schema)


def _sent(rows: DataFrame, up: int) -> DataFrame:
    """What the rows send to their parents, ``up`` levels above: (depth, k1, k2, more_leaves, more_saved)."""
    target = [(F.col("depth") - up).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    return rows.groupBy(*target).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))


def _received(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    joined = nodes.join(messages, KEY, "left")
    more = {name: (F.col(name) + F.coalesce(f"more_{name}", F.lit(0))).alias(name) for name in ("leaves", "saved")}
    return joined.select(*[more.get(c, F.col(c)) for c in nodes.columns])


def _ancestors(nodes: DataFrame, turns: DataFrame, depth: Column, name: str) -> DataFrame:
    """``nodes`` with ``name``1 and ``name``2, the key of the node's path at ``depth``; the root's is zero."""
    at = turns.select(F.col("c").alias("conv_id"), F.col("depth").alias("at"), F.col("k1").alias(f"{name}1"), F.col("k2").alias(f"{name}2"))
    joined = nodes.withColumn("at", depth).join(at, ["conv_id", "at"], "left").drop("at")
    return joined.fillna(0, [f"{name}1", f"{name}2"]).select(*nodes.columns, f"{name}1", f"{name}2")


def subtree_totals(nodes: DataFrame, turns: DataFrame, unit: int, band: int, shard_nodes: int, most: int) -> DataFrame:
    """(depth, k1, k2, leaves, saved) summed over subtrees, for a tree whose parents lie ``unit`` levels up."""
    columns = [*KEY, "p1", "p2", "conv_id", "leaves", "saved"]
    nodes = nodes.select(*columns)
    if nodes.count() <= shard_nodes:
        whole = nodes.withColumn("top", F.col("depth") == 0).repartition(1)
        return saved(forward(whole, unit, most).select(*KEY, "leaves", "saved"), "tree-totals")
    wide = unit * band
    start = F.col("depth") - F.col("depth") % wide
    nodes = saved(_ancestors(nodes, turns, start, "s").withColumn("top", F.col("depth") == start), "bands")
    within = forward(nodes.repartition("s1", "s2"), unit, most).filter("top")
    # Band roots are the nodes of a smaller tree; its parents are the roots of the bands above.
    roots = within.select("depth", "k1", "k2", F.col("p1").alias("up1"), F.col("p2").alias("up2"), "conv_id", "leaves", "saved")
    roots = saved(_ancestors(roots, turns, F.greatest(F.col("depth") - wide, F.lit(0)), "p"), "band-roots")
    totals = subtree_totals(roots, turns, wide, band, shard_nodes, most)
    ready = roots.drop("leaves", "saved").join(totals, KEY).filter("depth > 0").drop("p1", "p2").withColumnsRenamed({"up1": "p1", "up2": "p2"})
    complete = _received(nodes, _sent(ready, unit))
    return saved(forward(complete.repartition("s1", "s2"), unit, most).select(*KEY, "leaves", "saved"), "tree-totals")


def node_totals(nodes: DataFrame, turns: DataFrame, shard_nodes: int, band: int, most: int) -> DataFrame:
    """(depth, k1, k2, leaves, saved) of all nodes, over their subtrees."""
    total = nodes.agg(F.max("weight")).first()[0] or 0
    limit = max(shard_nodes, math.isqrt(total))
    heavy = nodes.filter((F.col("weight") > limit) | (F.col("depth") == 0))
    # The heavy nodes of a path are its beginning; a light subtree's root is the next node of each of its paths.
    on_path = turns.join(heavy.select(*KEY), KEY, "left_semi").groupBy("c").agg(F.max("depth").alias("heavy"))
    roots = turns.join(on_path, "c", "left").filter(F.col("depth") == F.coalesce("heavy", F.lit(0)) + 1)
    roots = roots.select(F.col("c").alias("conv_id"), F.col("depth").alias("root"), F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    light = nodes.filter((F.col("weight") <= limit) & (F.col("depth") > 0)).select(*KEY, "p1", "p2", "conv_id", "leaves", "saved")
    light = light.join(roots, "conv_id").withColumn("top", F.col("depth") == F.col("root"))
    done = saved(forward(light.select(*KEY, "p1", "p2", "leaves", "saved", "top", "s1", "s2").repartition("s1", "s2"), 1, most), "subtrees")
    above = subtree_totals(_received(heavy, _sent(done.filter("top"), 1)), turns, 1, band, shard_nodes, most)
    return done.select(*KEY, "leaves", "saved").unionByName(above)


def ends(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends): the hash over the ids of the conversations that end at a node.

    Ids are put together in blocks of numbers, so that a task that hashes a node's ids reads few rows, as a stream.
    """
    zero = F.lit(0).cast("long")
    turnless = convs.filter("length = 0").select("c", *[zero.alias(k) for k in KEY])
    last = turns.filter("depth = length").select("c", *KEY).unionByName(turnless)
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string")), ",")
    blocks = last.withColumn("block", F.floor(F.col("c") / CHUNK)).groupBy(*KEY, "block").agg(ids.alias("ids"))
    blocks = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], [*KEY, "ends"])

        node, digest = None, None
        for batch in batches:
            out = []
            for *key, part in zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in (*KEY, "ids")], strict=True):
                if key == node:
                    digest.update(b"," + part.encode())
                    continue
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(part.encode())
            yield table(out)
        if node:
            yield table([(*node, digest.hexdigest())])

    return blocks.mapInArrow(hashed, "depth long, k1 long, k2 long, ends string")


def build_trie(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    shard_nodes: int = 4096, band: int = 64, queue: int = 200_000,
) -> DataFrame:
    """The prefix trie of rebuilt conversations, one row per node.

    A conversation's turns are ordered by ``turn`` (NULL first; ties by role, then
    text; repeated rows are turns each), with NULL role or text as empty.  Conversation
    c is rebuilt from the first h turns of conversation c - c % 20 and its own turns
    after its first h, with h = crc32(c) % 4.  Each distinct sequence of the first d
    rebuilt turns is a node of depth d.  Returned are ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (all long) and ``ends_sha256``.

    Rows with a NULL id are no conversation.  Ids are whole numbers.  Other columns are
    not read, whatever their names.  Without any conversation there is no root, so an
    empty table gives an empty table.  ``shard_nodes``, ``band`` and ``queue`` only set
    how the work is cut.
    """
    turns = saved(ordered_turns(conversations, conv, turn, role, text), "ordered-turns")
    convs, rebuilt = rebuilt_turns(turns)
    steps = paths(rebuilt)
    nodes = trie_nodes(convs, steps)
    totals = node_totals(nodes, steps, shard_nodes, band, queue)
    found = nodes.drop("leaves", "saved").join(totals, KEY).join(ends(convs, steps), KEY, "left")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = found.join(parents, ["depth", "p1", "p2"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
