"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

1. ``whole_vectors``: each entry c becomes the whole number ``floor(1024 * c) +
   100000``, computed in Spark and written once.
2. ``Table.product`` is the only pass over the vectors: tasks multiply their centred
   rows, ``X'(XQ)``, Spark adds the tasks' sums, and the driver gets one number
   per dimension and column, whatever the number of vectors.
3. ``leading_components``: a few Lanczos passes on one column bound the spectrum
   from below, on the passes that the first block needs anyway.  Then rounds: a
   Chebyshev polynomial of the covariance, evaluated on a block by its
   three-term recurrence (one pass a degree), damps the spectrum between that
   bound and the block's least Ritz value; QR and Rayleigh-Ritz follow.  Rounds
   go on until the residuals ``|V q - e q|`` of all wanted components are at most
   ``TOLERANCE`` of the largest eigenvalue, or have come to the floor of double
   precision below ``FLOOR`` of it; otherwise an error is raised.
4. ``whiten``: ``(x - S/n)`` on each component over ``sqrt(e)``.

Centring is exact but for one rounding: the whole part of the mean is taken off
in whole numbers first.

Left out are rows whose vector is null or holds null or non-finite entries; an
empty vector, one of another length than most have (the longer one on a tie)
and one with an entry that makes no 52-bit whole number have no place in the
covariance and are left out, too.  Null and repeated ids are kept, row by row.
Components are as many as asked for, at most as many as the vectors have
directions with variance: equal vectors, a single vector or an empty table give
no rows.  A ``deviation`` beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize

SCALE, SHIFT = 1024, 100_000      # Fixed values: whole numbers from entries
COMPONENTS = 8
BLOCK = 32                        # columns of the block, at least twice the components
LANCZOS = 10
DEGREE = 10
TOLERANCE = 1e-13
FLOOR = 1e-10
MOST_ROUNDS = 200
BATCH = 65_536                    # entries in the largest block of rows multiplied at once, times BLOCK


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``(id, x)`` of the vectors that take part, written once, and their length."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fits = F.forall("v", lambda c: F.coalesce((F.abs(c) < float(1 << 42)), F.lit(False)))     # false for NaN, too
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & fits)
    rows = materialize(rows.select("id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x")), "whole-vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = lengths["d"] if lengths else 0
    return rows.where(F.size("x") == d), d


@dataclass(frozen=True)
class Table:
    """The whole-number vectors with their exact sums."""
    rows: DataFrame
    d: int
    n: int
    sums: tuple[int, ...]
    trace: float               # of the covariance

    @staticmethod
    def of(rows: DataFrame, d: int) -> "Table":
        u = F.posexplode("x").alias("i", "x")
        wide = F.col("x").cast("decimal(20,0)") - SHIFT
        found = (rows.select(u).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum(wide).alias("s"),
                                                 F.sum((wide * wide).cast("decimal(38,0)")).alias("q")).orderBy("i").collect()) if d else []
        if not found:
            return Table(rows, d, 0, (), 0.0)
        n = found[0]["n"]
        spread = sum(n * int(r["q"]) - int(r["s"]) ** 2 for r in found)
        return Table(rows, d, n, tuple(int(r["s"]) + n * SHIFT for r in found), float(Fraction(spread, n * n)))

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and the rest, below 1."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, dtype=np.int64), np.array([float(Fraction(s - self.n * w, self.n)) for s, w in zip(self.sums, whole)])

    def product(self, q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``, one pass over the vectors."""
        d, (whole, rest), width = self.d, self.centre(), q.shape[1]
        names = [f"c{j}" for j in range(width)]

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((d, width))
            for batch in batches:
                for y in centred(batch.column(0), d, whole, rest):
                    total += y.T @ (y @ q)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d))] + [pa.array(total[:, j]) for j in range(width)], names=["i", *names])

        parts = self.rows.select("x").mapInArrow(multiply, "i long, " + ", ".join(f"{c} double" for c in names))
        out = np.zeros((d, width))
        for r in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect():
            out[r["i"]] = [r[c] for c in names]
        return out / self.n


def centred(column: pa.Array, d: int, whole: np.ndarray, rest: np.ndarray) -> Iterator[np.ndarray]:
    """The centred rows of an Arrow list column, in blocks of bounded size."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    step = max(1, BATCH * BLOCK // d)
    for i in range(0, len(x), step):
        yield (x[i:i + step] - whole).astype(np.float64) - rest


def lower_bound(table: Table, block: np.ndarray, rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """A value below most of the spectrum by Lanczos steps, and the covariance times ``block``."""
    q = rng.standard_normal(table.d)
    basis, diagonal, off = [q / np.linalg.norm(q)], [], []
    first = None
    for _ in range(min(LANCZOS, table.d)):
        if first is None:
            both = table.product(np.column_stack([block, basis[-1]]))
            first, w = both[:, :-1], both[:, -1]
        else:
            w = table.product(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        for _ in range(2):
            w = w - np.column_stack(basis) @ (np.column_stack(basis).T @ w)
        off.append(float(np.linalg.norm(w)))
        if off[-1] <= 1e-12 * max(abs(x) for x in diagonal):
            break
        basis.append(w / off[-1])
    m = len(diagonal)
    ritz, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(off[:m - 1], 1) + np.diag(off[:m - 1], -1))
    return max(0.0, float(ritz[0] - off[-1] * abs(vectors[-1, 0]))), first


def chebyshev(table: Table, x: np.ndarray, product: np.ndarray, top: float, low: float, high: float) -> np.ndarray:
    """The filtered block: degree ``DEGREE``, small on [low, high], scaled to 1 at ``top``."""
    centre, half = (high + low) / 2, max((high - low) / 2, 1e-14 * top)
    sigma = half / (top - centre)
    tau = 2 / sigma
    y = (product - centre * x) * (sigma / half)
    for _ in range(DEGREE - 1):
        new = 1 / (tau - sigma)
        x, y = y, (table.product(y) - centre * y) * (2 * new / half) - sigma * new * x
        sigma = new
    return y


def leading_components(table: Table, components: int = COMPONENTS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """``(eigenvalues, unit eigenvectors as columns)`` of the covariance, largest first."""
    d, rng = table.d, np.random.default_rng(seed)
    if not d or table.trace <= 0:
        return np.zeros(0), np.zeros((d, 0))
    wanted, width = min(components, d), min(d, max(BLOCK, 2 * components))
    q, _ = np.linalg.qr(rng.standard_normal((d, width)))
    low, product = lower_bound(table, q, rng)
    last = np.inf
    for _ in range(MOST_ROUNDS):
        small = q.T @ product
        ritz, s = np.linalg.eigh((small + small.T) / 2)
        ritz, s = ritz[::-1], s[:, ::-1]
        q, product = q @ s, product @ s
        worst = float(np.max(np.linalg.norm(product - q * ritz, axis=0)[:wanted])) / ritz[0]
        if worst <= TOLERANCE or (worst <= FLOOR and worst > last / 2):
            keep = ritz[:wanted] > 1e-12 * ritz[0]
            return ritz[:wanted][keep], q[:, :wanted][:, keep]
        last = worst
        y = chebyshev(table, q, product, float(ritz[0]), min(low, float(ritz[-1])), float(ritz[-1]))
        q, _ = np.linalg.qr(y)
        product = table.product(q)
    raise RuntimeError(f"components not certified: residual {worst:.1e} of the largest eigenvalue")


def identity_error(table: Table, values: np.ndarray, vectors: np.ndarray) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity, from one more pass."""
    scaled = vectors / np.sqrt(values)
    return float(np.max(np.abs(scaled.T @ table.product(scaled) - np.eye(len(values)))))


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)``, a row per vector and component."""
    table = Table.of(*whole_vectors(vectors, id_col, vector_col))
    values, directions = leading_components(table, components)
    k, n, d = len(values), table.n, table.d
    kind = table.rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return table.rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    whole, rest = table.centre()
    apart = [s - n * int(w) for s, w in zip(table.sums, whole)]
    error, shares, scaled = identity_error(table, values, directions), values / table.trace, directions / np.sqrt(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for y in centred(batch.column(1), d, whole, rest):
                m = len(y)
                x = batch.column(1).slice(done, m).flatten().to_numpy(zero_copy_only=False).reshape(m, d)
                ids = batch.column(0).slice(done, m).take(pa.array(np.repeat(np.arange(m), k)))
                done += m
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     deviations(x, y, whole, apart, n).take(pa.array(np.repeat(np.arange(m), k))), pa.array((y @ scaled).reshape(-1)),
                     pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return table.rows.select("id", "x").mapInArrow(project, schema).withColumnRenamed("id", id_col)


def deviations(x: np.ndarray, y: np.ndarray, whole: np.ndarray, apart: list[int], n: int) -> pa.Array:
    """Per row the exact sum of ``(n * x - S)**2``, null beyond a long."""
    size = np.sum((y * n) ** 2, axis=1)
    if size.max(initial=0.0) < 2.0 ** 62:
        return pa.array(np.sum((n * (x - whole) - np.array(apart, dtype=np.int64)) ** 2, axis=1))
    exact = [sum((n * int(v - w) - a) ** 2 for v, w, a in zip(row, whole, apart)) for row in x]
    return pa.array([e if e < 1 << 63 else None for e in exact], type=pa.int64())
