"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With the centred rows X (n x d), alternating products Xv and X'u give orthonormal
right vectors v, left vectors u and an upper bidiagonal B with XV = UB.  The left
vectors have one entry per row, so they are never stored: each is X times a short
vector w, and one pass over the rows takes Xw and X'(Xw) together.  As every X'u is
kept, the inner products of left vectors are those of short vectors, and both sides
are reorthogonalised against all earlier ones.  The singular value decomposition
of the small B yields components and deviations.

What passes the driver has d numbers a step.  A step that loses an executor redoes
its tasks from the written table of integer rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved

SCALE, SHIFT = 1024, 100_000


def integer_rows(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, x) of the rows whose vector is not NULL and holds finite entries only; x = floor(1024 c) + 100000 as long."""
    entries = F.transform(F.col(vector), lambda v: v.cast("double"))
    rows = vectors.select(F.col(id_column).alias("id"), entries.alias("c")).filter(F.col("c").isNotNull())
    finite = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.filter(F.coalesce(finite, F.lit(False)))
    return rows.select("id", F.transform("c", lambda v: F.floor(v * SCALE) + F.lit(SHIFT)).alias("x"))


def _matrix(lists: pa.Array, d: int) -> np.ndarray:
    """Integer rows as a matrix; a shorter vector ends in entries of 0, that is, of SHIFT."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if len(n) == 0 or (n == d).all():
        return flat.reshape(len(n), d)
    out = np.full((len(n), d), SHIFT, np.int64)
    out[np.arange(d)[None, :] < n[:, None]] = flat
    return out


@dataclass
class Centre:
    """The number of rows and their sums: rows are centred in integers, before anything is multiplied."""

    n: int
    sums: np.ndarray

    def of(self, lists: pa.Array) -> np.ndarray:
        return (self.n * _matrix(lists, len(self.sums)) - self.sums) / self.n


def _summed(rows: DataFrame, size: int, part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` over all batches: each task sends ``size`` numbers to the one that adds them up."""

    def one(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["z"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(batch)
        yield one(total)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += batch.column(0).flatten().to_numpy().reshape(-1, size).sum(0)
        yield one(total)

    schema = "z array<double>"
    return np.array(rows.mapInArrow(add, schema).repartition(1).mapInArrow(join, schema).first()["z"])


class Bidiagonal:
    """Golub-Kahan-Lanczos steps with full reorthogonalisation of both sides."""

    def __init__(self, product: Callable[[np.ndarray], np.ndarray], d: int, energy: float, seed: int):
        """``product`` gives X'(Xw); ``energy`` is the sum of all squared singular values."""
        self.product, self.d, self.energy = product, d, energy
        self.rng = np.random.default_rng(seed)
        self.v: list[np.ndarray] = []  # right vectors
        self.w: list[np.ndarray] = []  # left vectors are X w
        self.z: list[np.ndarray] = []  # X' of the left vectors
        self.alpha: list[float] = []
        self.beta: list[float] = []  # beta[i] links left vector i and right vector i + 1

    def _clean(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in self.v:
                v = v - (other @ v) * other
        return v

    def _fresh(self) -> np.ndarray | None:
        """A random direction orthogonal to all right vectors."""
        if len(self.v) == self.d:
            return None
        v = self._clean(self.rng.normal(size=self.d))
        return v / np.linalg.norm(v)

    def step(self) -> bool:
        """One more right and left vector; False if the rows have no further direction."""
        tiny = 1e-14 * np.sqrt(self.energy)
        beta, v = 0.0, None
        if self.v and self.alpha[-1] > 0:
            rest = self._clean(self.z[-1] - self.alpha[-1] * self.v[-1])
            beta = float(np.linalg.norm(rest))
            v = rest / beta if beta > tiny and len(self.v) < self.d else None
        if v is None:
            beta, v = 0.0, self._fresh()
        if v is None:
            return False
        if self.v:
            self.beta.append(beta)
        w = v - beta * self.w[-1] if beta else v
        z = self.product(w)
        for _ in range(2):
            for other, image in zip(self.w, self.z, strict=True):
                share = other @ z
                w, z = w - share * other, z - share * image
        alpha = float(np.sqrt(max(w @ z, 0.0)))
        self.v.append(v)
        if alpha > tiny:
            self.alpha.append(alpha)
            self.w.append(w / alpha)
            self.z.append(z / alpha)
        else:
            # X takes v into the span of the earlier left vectors: this one is zero.
            self.alpha.append(0.0)
            self.w.append(np.zeros(self.d))
            self.z.append(np.zeros(self.d))
        return len(self.v) < self.d

    def components(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The leading singular values, right singular vectors (rows) and how far each is from convergence."""
        b = np.diag(self.alpha) + np.diag(self.beta, 1)
        left, values, right = np.linalg.svd(b)
        last = np.linalg.norm(self._clean(self.z[-1] - self.alpha[-1] * self.v[-1])) if len(self.v) < self.d else 0.0
        return values[:k], (right @ np.array(self.v))[:k], last * np.abs(left[-1, :k])


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 8, seed: int = 13,
) -> DataFrame:
    """Rows of ``vectors`` with their whitened coordinates, and the facts of the fit.

    Adds to every row that takes part ``whitened`` (array of double, by falling
    eigenvalue), ``deviation`` (decimal, exact: the sum of (n x - S)^2), ``n``,
    ``eigenvalues``, ``explained`` (arrays) and ``identity_error``, in place of columns
    of these names in any case.  Rows whose vector is NULL or holds NULL or
    non-finite entries are left out; a NULL id is an id.  Shorter vectors count as if
    they ended in zeros, the longest sets the dimension.  Repeated rows count each.
    Directions without variance (an eigenvalue below 1e-12 of the largest) are no
    components, so the arrays are shorter, or empty if all rows are equal or there is
    one row only.  Equal eigenvalues have any basis of their space.  An empty table,
    or one without such rows, gives an empty table.
    """
    spark = vectors.sparkSession
    new = ("whitened", "deviation", "n", "eigenvalues", "explained", "identity_error")
    others = [c for c in vectors.columns if c.lower() not in new]
    packed = vectors.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("doc"))
    rows = saved(integer_rows(packed, "doc", f"doc.`{vector}`").withColumnRenamed("id", "doc"), "integer-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = size["n"], size["d"] or 0
    shifted = [F.sum(F.coalesce(F.get("x", F.lit(i)), F.lit(SHIFT)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(d)]
    sums = np.array([int(s) for s in rows.agg(*shifted).first()], np.int64) if n and d else np.zeros(0, np.int64)
    centre = Centre(n, sums)
    x = rows.select("x")

    values, vectors_, trace = np.zeros(0), np.zeros((0, d)), 0.0
    if n > 1 and d:
        trace = float(_summed(x, 1, lambda batch: np.array([np.square(centre.of(batch.column(0))).sum()]))[0])
    if trace > 0:

        def product(w: np.ndarray) -> np.ndarray:
            def part(batch: pa.RecordBatch) -> np.ndarray:
                rows_ = centre.of(batch.column(0))
                return rows_.T @ (rows_ @ w)

            return _summed(x, d, part)

        lanczos = Bidiagonal(product, d, trace, seed)
        while lanczos.step():
            found, _, open_ = lanczos.components(components)
            # Converged to double precision; a flat spectrum takes all d steps.
            if len(found) == components and (open_ <= 1e-15 * found[0]).all():
                break
        values, vectors_, _ = lanczos.components(components)
        real = values > 1e-6 * values[0]
        values, vectors_ = values[real], vectors_[real]
    eigen = values**2 / max(n, 1)
    to_white = (vectors_ / np.sqrt(eigen)[:, None]).T if len(eigen) else np.zeros((d, 0))
    k = len(eigen)

    error = 0.0
    if k:

        def second(batch: pa.RecordBatch) -> np.ndarray:
            white = centre.of(batch.column(0)) @ to_white
            return np.concatenate([(white.T @ white).ravel(), white.sum(0)])

        moments = _summed(x, k * k + k, second) / n
        mean = moments[k * k :]
        error = float(np.abs(moments[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("x"))
            away = n * _matrix(lists, d) - sums
            white = (away / n) @ to_white
            fits = not away.size or float(np.abs(away).max()) ** 2 * max(d, 1) < 2.0**62
            squares = (away * away).sum(1) if fits else [sum(int(v) ** 2 for v in row) for row in away]
            offsets = pa.array(np.arange(len(white) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc")),
                    pa.ListArray.from_arrays(offsets, pa.array(white.ravel(), pa.float64())),
                    pa.array([Decimal(int(s)) for s in squares], pa.decimal128(38, 0)),
                ],
                ["doc", "whitened", "deviation"],
            )

    schema = rows.select("doc").schema.add("whitened", T.ArrayType(T.DoubleType())).add("deviation", T.DecimalType(38, 0))
    done = rows.mapInArrow(add, schema) if n else spark.createDataFrame([], schema)
    numbers = lambda xs: F.array(*[F.lit(float(v)) for v in xs]).cast("array<double>")
    share = eigen * n / trace if k else eigen
    return done.select(
        *[F.col(f"doc.`{c}`") for c in others],
        "whitened",
        "deviation",
        F.lit(n).cast("long").alias("n"),
        numbers(eigen).alias("eigenvalues"),
        numbers(share).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
