"""Embedding whitening (operator 12): moments merged by Chan's formula.

Every partition computes count, mean and the scatter around its own mean; pairs of these
are merged in a tree, so that no large offset is ever squared.  The driver holds one
``dim x dim`` matrix, takes its eigenvectors, and a second pass over the fit list
measures how far the whitened vectors' covariance is from the identity.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import Stash, ship

#: Levels of the tree of merges, and rows of a block within a partition.
DEPTH, BLOCK = 2, 4096
#: Largest magnitude of an integer entry: below it, doubles hold integers exactly.
LARGEST = 1 << 52


@dataclass
class Moments:
    """Count, sums and centred scatter of rows; of integers the sums are exact, and means are never rounded before they are subtracted."""

    n: int
    total: list
    scatter: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        n = len(rows)
        if rows.dtype == np.int64:
            total = [sum(map(int, c)) for c in rows.T] if np.abs(rows).max() >= (1 << 62) // n else rows.sum(axis=0).tolist()
            away = centred(rows, n, total)
        else:
            total = rows.sum(axis=0).tolist()
            away = rows - rows.mean(axis=0)
        return cls(n, total, away.T @ away)

    def merged(self, other: Moments) -> Moments:
        """Chan's pairwise formula: both scatters, and that between the two means."""
        n, both = self.n + other.n, self.n * other.n
        step = np.array([(b * self.n - a * other.n) / both for a, b in zip(self.total, other.total)])
        return Moments(n, [a + b for a, b in zip(self.total, other.total)], self.scatter + other.scatter + np.outer(step, step) * (both / n))


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """Integer rows less ``total / n``: first the whole part, exactly, then the rest."""
    q, r = zip(*(divmod(t, n) for t in total))
    return (x - np.array(q, np.int64)).astype(np.float64) - np.array([a / n for a in r])


def moments(rows: DataFrame, matrix: Callable[[pa.ListArray], np.ndarray]) -> Moments:
    """Moments of ``matrix`` of the column ``x``, computed by partition and merged in a tree of tasks; there must be rows."""

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                m = Moments.of(matrix(batch.column(0).slice(at, BLOCK)))
                out = m if out is None else out.merged(m)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(out)], pa.binary())], names=["moments"])

    parts = rows.select("x").mapInArrow(own, "moments binary").rdd.map(lambda r: pickle.loads(bytes(r[0])))
    return parts.treeReduce(lambda a, b: a.merged(b), DEPTH)


def integers(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Whitener:
    """What whitens: count and sums of the fit list, unit components by falling eigenvalue, eigenvalues, their sum."""

    n: int
    total: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = float("nan")

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Rows ``(x - S / n)`` on the components over the roots of the eigenvalues; NaN where an eigenvalue is 0."""
        roots = np.sqrt(np.where(self.values > 0, self.values, np.nan))
        return centred(x, self.n, self.total) @ self.components / roots

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n * x - S)**2``; None beyond a long."""
        bound = self.n * (np.abs(x).max() if x.size else 0) + max(map(abs, self.total), default=0)
        if bound < 1 << 62:
            d = self.n * x - np.array(self.total, np.int64)
            if len(d) and float(np.abs(d).max()) ** 2 * x.shape[1] < 2**62:
                return (d * d).sum(axis=1).tolist()
        out = [sum((self.n * int(a) - s) ** 2 for a, s in zip(row, self.total)) for row in x]
        return [v if v < 1 << 63 else None for v in out]


def fit_whitener(distinct: DataFrame, components: int) -> Whitener:
    """A whitener from a table of distinct integer vectors ``x``, its identity error measured by a second pass."""
    found = moments(distinct, integers)
    e, v = np.linalg.eigh(found.scatter / found.n)
    order = np.argsort(-e, kind="stable")[:components]
    values, trace = e[order].copy(), float(np.trace(found.scatter / found.n))
    values[values <= abs(trace) * len(e) * np.finfo(float).eps * 8] = 0.0  # rounding, not variance
    out = Whitener(found.n, found.total, v[:, order], values, trace)
    use = np.flatnonzero(values > 0)
    if len(use):
        spread = moments(distinct, lambda c: out.projected(integers(c))[:, use])
        out.identity_error = float(np.abs(spread.scatter / spread.n - np.eye(len(use))).max())
    return out


def as_integers(vector: Column, scale: int, offset: int) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))


def whitened(vectors: DataFrame, components: int = 16, scale: int = 64, offset: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per remaining row and component: its id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null or empty, or holds null or non-finite entries (or such as do not fit
    the integers that a double holds) are dropped; so are those of another length than
    most distinct vectors have (at a tie the shorter).  Entry c becomes ``floor(scale * c) + offset``.
    Equal vectors are one in the fit list; each of their rows, and rows with null ids,
    come back.  A component without variance has a null ``whitened`` and is left out of
    the identity error; without any variance ``explained`` and ``identity_error`` are
    null.  A ``deviation`` that does not fit a long is null.  Other columns are not
    looked at; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    ship(spark)
    stash = Stash(spark, "whitening")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    fine = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c.cast("double") * scale) < LARGEST))
    rows = rows.where(F.coalesce((F.size("embedding") > 0) & fine, F.lit(False)))
    rows = stash.put(rows.select("vec_id", as_integers(F.col("embedding"), scale, offset).alias("x")))
    distinct = stash.put(rows.select("x").distinct())
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = distinct.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if lengths is None:
        return spark.createDataFrame([], schema).withColumnRenamed("vec_id", id_col)
    same = F.size("x") == lengths["dim"]
    fit = fit_whitener(distinct.where(same), components)
    explained = [float(v / fit.trace) if fit.trace > 0 else None for v in fit.values]
    error = None if np.isnan(fit.identity_error) else fit.identity_error

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                part = whole.slice(at, BLOCK)
                x = integers(part.column("x"))
                y = fit.projected(x)
                rows, k = y.shape
                every = np.repeat(np.arange(rows), k)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, fit.n, np.int64)), pa.array(fit.deviations(x), pa.int64()).take(pa.array(every)),
                    pa.array(y.ravel(), from_pandas=True), pa.array(explained * rows, pa.float64()), pa.array([error] * (rows * k), pa.float64()),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(same).mapInArrow(run, schema).withColumnRenamed("vec_id", id_col)
