"""An inverted file over vectors: coarse cells, fitted on a bounded sample, that every row is dealt to.

A search looks into the few cells whose centroids are nearest to it and rescores their
rows exactly, so a row's work follows the size of a cell and not that of the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import ship

#: Rows that a cell should hold, sampled rows to fit one, rows sampled at most (both bound the number of cells), rounds of fitting.
CELL_ROWS, PER_CELL, SAMPLE, ROUNDS = 512, 32, 131_072, 8


def unit_matrix(vectors: Iterable) -> np.ndarray:
    """Vectors as rows of length one; a zero vector stays zero."""
    m = np.array(list(vectors), np.float64)
    if not len(m):
        return m.reshape(0, 0)
    m /= np.maximum(np.linalg.norm(m, axis=1), 1e-300)[:, None]
    return m


def _means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Unit centroids of unit rows, started from rows and moved a few times; one that loses its rows takes a row at random."""
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        at = np.concatenate([(x[i : i + 8192] @ c.T).argmax(axis=1) for i in range(0, len(x), 8192)])
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        empty = np.bincount(at, minlength=len(c)) == 0
        sums[empty] = x[rng.integers(len(x), size=int(empty.sum()))]
        c = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-300)[:, None]
    return c


@dataclass
class Cells:
    """Centroids in two levels: ``upper`` ones, and each one's ``lower`` ones, which are the cells; ``start`` numbers the first of each."""

    upper: np.ndarray
    lower: list[np.ndarray]
    start: np.ndarray

    @property
    def count(self) -> int:
        return int(self.start[-1])

    def nearest(self, unit: np.ndarray, probes: int) -> np.ndarray:
        """The numbers of the ``probes`` nearest cells of each row, as far as its nearest upper centroids hold so many; -1 for none."""
        take = min(len(self.upper), max(2, probes))
        near = unit @ self.upper.T
        tops = np.argpartition(-near, take - 1, axis=1)[:, :take] if take < len(self.upper) else np.tile(np.arange(take), (len(unit), 1))
        width = sum(sorted((len(c) for c in self.lower), reverse=True)[:take])
        score, cell = np.full((len(unit), width), -np.inf), np.full((len(unit), width), -1, np.int64)
        used = np.zeros(len(unit), np.int64)
        for u in np.unique(tops):
            rows = np.flatnonzero((tops == u).any(axis=1))
            n = len(self.lower[u])
            at = used[rows][:, None] + np.arange(n)
            score[rows[:, None], at] = unit[rows] @ self.lower[u].T
            cell[rows[:, None], at] = self.start[u] + np.arange(n)
            used[rows] += n
        best = np.argsort(-score, axis=1, kind="stable")[:, :probes]
        return np.take_along_axis(cell, best, axis=1)


def fit_cells(rows: DataFrame, cells: int | None = None, sample: int = SAMPLE, seed: int = 1) -> Cells:
    """Cells for ``id, embedding`` rows of the most frequent length: about one for ``CELL_ROWS`` rows, or as many as asked for.

    Fitted on at most ``sample`` rows or so, picked by a hash of their ids; those are all that reaches
    the driver.  ``PER_CELL`` of them are needed for a cell, so beyond some million rows
    cells grow unless ``sample`` does.
    """
    good = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    n = good.count()
    wanted = cells or -(-n // CELL_ROWS)
    wanted = max(1, min(wanted, sample // PER_CELL))
    share = min(1.0, wanted * PER_CELL * 2 / max(n, 1), sample / max(n, 1))
    picked = good.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("embedding").collect()
    if not picked:
        return Cells(np.zeros((1, 0)), [np.zeros((1, 0))], np.array([0, 1]))
    lengths = np.bincount([len(r[0]) for r in picked])
    x = unit_matrix([r[0] for r in picked if len(r[0]) == lengths.argmax()])
    rng = np.random.default_rng(seed)
    upper = _means(x, 1 if wanted <= 256 else int(np.sqrt(wanted)), rng)
    at = (x @ upper.T).argmax(axis=1)
    lower = []
    for u in range(len(upper)):
        mine = x[at == u]
        lower.append(_means(mine, max(1, round(wanted * len(mine) / len(x))), rng) if len(mine) else upper[u : u + 1])
    return Cells(upper, lower, np.concatenate([[0], np.cumsum([len(c) for c in lower])]))


def placed(rows: DataFrame, cells: Cells, probes: int = 1) -> DataFrame:
    """Rows, with all their columns, copied to their ``probes`` nearest cells as ``cell``.

    With one probe this is the table to keep: rows that come later are placed by the
    same cells and appended.  Rows of another length than the cells have no place.
    """
    ship(rows.sparkSession)
    names = rows.columns
    schema = rows.withColumn("cell", F.lit(0).cast("long")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                found = cells.nearest(unit_matrix(part.column("embedding").to_pylist()), probes)
                row, col = np.nonzero(found >= 0)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([*[part.column(c).take(take) for c in names], pa.array(found[row, col])], names=[*names, "cell"])

    return rows.where(F.size("embedding") == max(1, cells.upper.shape[1])).mapInArrow(run, schema)
