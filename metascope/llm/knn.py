"""Approximate nearest neighbours by inner product, over stable projections in kd-trees.

Vectors are lengthened by one component so that the largest inner product is the
nearest neighbour.  A Gaussian (2-stable) projection to a few dimensions keeps
distances in law: the projected squared distance over the true one is chi-square.
The projected space is cut into cells by the top of a kd-tree, fitted on a bounded
sample; each cell is cut into blocks of bounded size, and each block is indexed by
a kd-tree of its own.  A query first searches its home cell.  It then visits every
cell whose box could, by the chi-square test, still hold something nearer.  Within
a block, leaves are taken in the order of their projected distance and verified
with the original vectors, until the test says that what is left is nearer only
with a probability below ``miss``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

LEAF = 512


def chi_square_quantile(p: float, m: int) -> float:
    """The value below which a chi-square of an even number ``m`` of degrees lies with probability ``p``."""

    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(m // 2))

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


@dataclass
class Cells:
    """The top of a kd-tree: at node i points with a smaller coordinate ``axis[i]`` than ``cut[i]`` go left."""

    axis: np.ndarray
    cut: np.ndarray
    depth: int

    @classmethod
    def fit(cls, points: np.ndarray, n_cells: int) -> Cells:
        depth = max(0, math.ceil(math.log2(max(n_cells, 1))))
        axis, cut = np.zeros(max(1, 2**depth - 1), int), np.full(max(1, 2**depth - 1), np.inf)

        def split(node: int, own: np.ndarray, level: int) -> None:
            if level == depth or not len(own):
                return
            axis[node] = int(np.argmax(own.max(0) - own.min(0)))
            cut[node] = np.median(own[:, axis[node]])
            left = own[:, axis[node]] < cut[node]
            split(2 * node + 1, own[left], level + 1)
            split(2 * node + 2, own[~left], level + 1)

        split(0, points, 0)
        return cls(axis, cut, depth)

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), int)
        for _ in range(self.depth):
            node = 2 * node + np.where(points[np.arange(len(points)), self.axis[node]] < self.cut[node], 1, 2)
        return node - (2**self.depth - 1)

    def boxes(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.full((1, m), -np.inf), np.full((1, m), np.inf)
        for level in range(self.depth):
            nodes = np.arange(2**level - 1, 2 ** (level + 1) - 1)
            lows, highs = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
            at = np.arange(len(nodes))
            highs[2 * at, self.axis[nodes]] = np.minimum(highs[2 * at, self.axis[nodes]], self.cut[nodes])
            lows[2 * at + 1, self.axis[nodes]] = np.maximum(lows[2 * at + 1, self.axis[nodes]], self.cut[nodes])
            low, high = lows, highs
        return low, high


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances (points, boxes)."""
    out = np.zeros((len(points), len(low)))
    for j in range(points.shape[1]):
        x = points[:, j : j + 1]
        out += np.maximum(np.maximum(low[None, :, j] - x, x - high[None, :, j]), 0) ** 2
    return out


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """A kd-tree's leaves: groups of nearby points; equal points are cut by their order."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        own = open_.pop()
        if len(own) <= LEAF:
            done.append(own)
            continue
        spread = points[own].max(0) - points[own].min(0)
        order = own[np.argsort(points[own, int(np.argmax(spread))], kind="stable")]
        open_ += [order[: len(own) // 2], order[len(own) // 2 :]]
    return done


def inner_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision, summed from the first component to the last, so that equal vectors score the same."""
    return np.add.accumulate(rows * query, axis=1)[:, -1] if rows.shape[1] else np.zeros(len(rows))


@dataclass
class Search:
    """What every task needs to know."""

    matrix: np.ndarray  # (d + 1, m)
    longest: float
    k: int
    limit: float  # the chi-square value of the stopping test

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def projected(self, x: np.ndarray, query: bool) -> np.ndarray:
        if query:
            scaled = x * (self.longest / np.sqrt((x * x).sum(1)))[:, None]
            return np.concatenate([scaled, np.zeros((len(x), 1))], axis=1) @ self.matrix
        return self.lengthened(x) @ self.matrix

    def reach(self, x: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """The squared projected distance at which the test stops a query with this k-th inner product."""
        norm = np.sqrt((x * x).sum(1))
        distance = 2 * self.longest**2 - 2 * self.longest / norm * kth
        return np.maximum(distance, 0) * self.limit

    def block(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, asked: np.ndarray, q: np.ndarray, kth: np.ndarray) -> Iterator[tuple]:
        """(query's row, ids, rows, scores): the nearest of the block for each query that may have some here."""
        groups = leaves(self.projected(x, False))
        order = np.concatenate(groups)
        # Leaves are slices.
        rows, ids, x = rows[order], ids[order], np.ascontiguousarray(x[order])
        ends = np.cumsum([len(g) for g in groups])
        begins = ends - [len(g) for g in groups]
        points, at = self.projected(x, False), self.projected(q, True)
        low, high = np.minimum.reduceat(points, begins), np.maximum.reduceat(points, begins)
        far = box_distance(at, low, high)
        order = np.argsort(far, axis=1)
        norm = np.sqrt((q * q).sum(1))
        for i in range(len(q)):
            best_rows, best_ids, best, bound = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), kth[i]
            slack = 1e-9 * self.longest * norm[i]
            for g in order[i]:
                distance = max(2 * self.longest**2 - 2 * self.longest / norm[i] * bound, 0.0) if bound > -np.inf else np.inf
                if far[i, g] > distance * self.limit:
                    break
                # A fast product sifts; what may count is summed in a fixed order.
                rough = x[begins[g] : ends[g]] @ q[i]
                own = begins[g] + np.flatnonzero(rough >= bound - slack)
                own = own[rows[own] != asked[i]]
                if not len(own):
                    continue
                best_rows = np.concatenate([best_rows, rows[own]])
                best_ids = np.concatenate([best_ids, ids[own]])
                best = np.concatenate([best, inner_products(x[own], q[i])])
                if len(best) > self.k:
                    top = np.lexsort((best_rows, best_ids, -best))[: self.k]
                    best_rows, best_ids, best = best_rows[top], best_ids[top], best[top]
                if len(best) == self.k:
                    bound = max(bound, best.min())
            if len(best):
                yield asked[i], best_ids, best_rows, best


def valid_vectors(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, x) of the vectors that take part, as doubles: none that are NULL, zero, of another length than most, or hold what isn't finite."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), x.alias("x")).filter(F.col("id").isNotNull() & (F.size("x") > 0))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.filter(F.coalesce(finite, F.lit(False)) & F.exists("x", lambda v: v != 0))
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    return rows.join(F.broadcast(usual), F.size("x") == F.col("d")).select("id", "x")


def nearest(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20,
    dimensions: int = 8, miss: float = 0.03, cell_rows: int = 8192, block_rows: int = 8192, block_queries: int = 2048,
    max_cells: int = 1024, sample: int = 20_000, seed: int = 5,
) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` largest inner products found for each query.

    Queries are the vectors whose id is divisible by ``every``; candidates are all
    other rows.  Ties go to the smaller id.  Rows with a NULL id, and vectors that are
    NULL, empty, zero, of another length than most (they have no inner product with
    the others), or hold NULL or what isn't finite, take no part.  Rows with equal ids
    are different rows: each is asked, and each is a candidate of the others.
    The cells are fitted on at most ``sample`` rows, by a hash of the id; every row is
    indexed.  Vectors are searched whole, so with fewer than ``k`` candidates all are
    returned.  Other columns are not read.  An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, id long, score double"
    # Rows are told apart by a number that is written with them.
    rows = saved(valid_vectors(vectors, id_column, vector).withColumn("row", F.monotonically_increasing_id()), "vectors")
    norm2 = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("most"), F.max(F.size("x")).alias("d")).first()
    if not facts["n"]:
        return spark.createDataFrame([], result).withColumnRenamed("id", id_column)
    rng = np.random.default_rng(seed)
    search = Search(rng.normal(size=(facts["d"] + 1, dimensions)), math.sqrt(facts["most"]), k, chi_square_quantile(1 - miss, dimensions))

    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("x").toPandas()
    n_cells = min(max_cells, -(-facts["n"] // cell_rows))
    cells = Cells.fit(search.projected(np.stack(drawn["x"].to_numpy()), False), n_cells)
    low, high = cells.boxes(dimensions)

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=cells.cell_of(search.projected(np.stack(batch["x"].to_numpy()), False)).astype("int32"))

    placed = saved(rows.mapInPandas(put, "id long, x array<double>, row long, cell int"), "vector-cells")
    # Blocks of a cell, so that a cell of any size, also of one vector many times, is many tasks' work.
    per_cell = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).select("cell", F.ceil(F.col("n") / F.lit(block_rows)).cast("int").alias("blocks"))
    per_cell = saved(per_cell, "cell-blocks")
    candidates = placed.join(per_cell, "cell").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).select("cell", "block", "row", "id", "x")
    queries = placed.filter(F.col("id") % every == 0)

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                q = np.stack(batch["x"].to_numpy())
                yield batch.assign(cell=cells.cell_of(search.projected(q, True)).astype("int32"), kth=-np.inf)

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                q = np.stack(batch["x"].to_numpy())
                at, kth = search.projected(q, True), batch["kth"].to_numpy()
                far = box_distance(at, low, high)
                open_ = far <= np.where(np.isfinite(kth), search.reach(q, np.where(np.isfinite(kth), kth, 0)), np.inf)[:, None]
                open_[np.arange(len(q)), cells.cell_of(at)] = False
                row, cell = np.nonzero(open_)
                yield batch.iloc[row].assign(cell=cell.astype("int32"))

    def searched(wanted: DataFrame) -> DataFrame:
        """Wanted: (row, x, cell, kth).  Queries of a cell go to each of its blocks, some thousand at a time."""
        asked = wanted.join(per_cell, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        many = wanted.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_queries)).cast("int").alias("turns"))
        asked = asked.join(many, "cell").withColumn("turn", F.pmod(F.xxhash64("row"), F.col("turns")).cast("int"))
        stored = candidates.join(many, "cell").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        keys = ["cell", "block", "turn"]

        def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(left) and len(right):
                x, q = np.stack(left["x"].to_numpy()), np.stack(right["x"].to_numpy())
                found = list(search.block(*(left[c].to_numpy() for c in ("row", "id")), x, right["row"].to_numpy(), q, right["kth"].to_numpy()))
            if not found:
                return pd.DataFrame({"query": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "row": np.zeros(0, np.int64), "score": np.zeros(0)})
            return pd.DataFrame(
                {
                    "query": np.repeat([f[0] for f in found], [len(f[1]) for f in found]),
                    "id": np.concatenate([f[1] for f in found]),
                    "row": np.concatenate([f[2] for f in found]),
                    "score": np.concatenate([f[3] for f in found]),
                }
            )

        pairs = stored.select(*keys, "row", "id", "x").groupBy(*keys).cogroup(asked.select(*keys, "row", "x", "kth").groupBy(*keys))
        return pairs.applyInPandas(pair, "query long, id long, row long, score double")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    asked = queries.select("row", "x")
    first = saved(best(searched(asked.mapInPandas(home, "row long, x array<double>, cell int, kth double"))), "neighbours-at-home")
    bound = first.groupBy("query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    kth = F.when(F.col("n") == k, F.col("least")).otherwise(F.lit(float("-inf")))
    again = asked.join(bound, asked["row"] == bound["query"], "left").select("row", "x", F.coalesce(kth, F.lit(float("-inf"))).alias("kth"))
    second = searched(again.mapInPandas(visits, "row long, x array<double>, kth double, cell int").select("row", "x", "cell", "kth"))
    final = best(first.select("query", "id", "row", "score").unionByName(second))
    named = queries.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return final.join(named, "query").select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_column), "score")
