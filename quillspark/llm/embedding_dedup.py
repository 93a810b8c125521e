"""Near-duplicate embeddings by lattice hashing (operator 8).

Each table projects unit vectors onto a few random blocks of eight dimensions and
rounds each block to its nearest point of the E8 lattice, the densest one there is in
eight dimensions; the points together are a vector's cell.  A vector also probes the
neighbouring cells that are nearest to it.  Vectors that meet in a cell are compared
by their cosine.

Equal vectors are one class with one representative.  Cells are compared in blocks of
bounded size, and tasks pass on only who is connected, never pairs.  Links are counted
afterwards within the components, where they all lie, again in blocks.  Most blocks hold
a few rows, so a task takes thousands of them from sorted Arrow batches and multiplies
those of one shape together: its time follows the pairs, not the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.graph import connected_components, labels
from quillspark.runtime import Stash, ship

#: Tables, blocks of eight dimensions in each, neighbouring cells probed, and cells' scale in units of the typical distance of a linked pair.
TABLES, BLOCKS, PROBES, SCALE = 5, 2, 3, 2.24
#: Rows of a side of a block of comparisons, and numbers that a task computes with at a time.
SIDE, AT_ONCE = 512, 1 << 20


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest lattice point of each row: the nearer of those of D8 and of D8 shifted by a half."""
    def d8(y: np.ndarray) -> np.ndarray:
        r = np.rint(y)
        away = y - r
        odd = np.flatnonzero(r.sum(axis=1) % 2)
        worst = np.abs(away[odd]).argmax(axis=1)
        r[odd, worst] += np.where(away[odd, worst] >= 0, 1.0, -1.0)
        return r

    a, b = d8(x), d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def shortest_e8() -> np.ndarray:
    """The 240 shortest vectors of the lattice, the steps to neighbouring cells."""
    out = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


STEPS = shortest_e8()


def projection(dim: int, table: int) -> np.ndarray:
    """Random directions of a table, orthonormal where there is room."""
    rows = np.random.default_rng([dim, table]).normal(size=(8 * BLOCKS, dim))
    if dim >= 8 * BLOCKS:
        return np.linalg.qr(rows.T)[0].T
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def cells(unit: np.ndarray, threshold: float, table: int) -> np.ndarray:
    """Hashes of the own cell and the probed ones of each row, for one table."""
    dim = unit.shape[1]
    width = SCALE * np.sqrt(max(2 - 2 * threshold, 1e-4)) * np.sqrt(8 / dim)
    y = (unit @ projection(dim, table).T / width).reshape(len(unit), BLOCKS, 8)
    points = np.stack([nearest_e8(y[:, k]) for k in range(BLOCKS)], axis=1)
    rest = y - points
    farther = np.concatenate([2 - 2 * rest[:, k] @ STEPS.T for k in range(BLOCKS)], axis=1)
    probes = np.argpartition(farther, PROBES, axis=1)[:, :PROBES]
    at = np.arange(len(unit))
    keys = [points]
    for p in probes.T:
        other = points.copy()
        other[at, p // len(STEPS)] += STEPS[p % len(STEPS)]
        keys.append(other)
    whole = (2 * np.stack(keys, axis=1)).astype(np.int64).reshape(len(unit), 1 + PROBES, 8 * BLOCKS).view(np.uint64)
    h = np.full(whole.shape[:2], 1_000_003 * dim + table, np.uint64)
    for k in range(8 * BLOCKS):
        h = (h ^ whole[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite numbers, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows brought to length one, in double precision (scaled first, lest squares overflow or vanish)."""
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _by_length(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of the rows of each length."""
    sizes = pc.list_value_length(vectors).to_numpy()
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, unit_rows(vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim))


def _cell_rows(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                ids = part.column(0).to_numpy()
                for at, unit in _by_length(part.column(1)):
                    every = np.concatenate([cells(unit, threshold, t) for t in range(TABLES)], axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[at], every.shape[1])), pa.array(every.ravel())], names=["rep", "cell"])

    return run


def _blocks(members: DataFrame, group: str, classes: DataFrame) -> DataFrame:
    """Rows ``group, l, r, own, rep, size, embedding``, copied to the blocks ``(group, l, r)`` in which all pairs of a group's members meet at least once.

    Blocks lie whole in a partition, one after another, left rows first.  Vectors join
    last, so they are shuffled once.  A group of one meets nobody.
    """
    chunks = members.groupBy(group).agg(F.count("*").alias("n")).where("n > 1").select(group, F.ceil(F.col("n") / SIDE).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("chunks")).cast("int")
    spread = members.join(chunks, group).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    spread = spread.select(F.col(group).alias("group"), F.least("own", "other").alias("l"), F.greatest("own", "other").alias("r"), "own", "rep")
    met = spread.join(classes.select("rep", "size", "embedding"), "rep").select("group", "l", "r", "own", "rep", "size", "embedding")
    return met.repartition("group", "l", "r").sortWithinPartitions("group", "l", "r", "own")


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that cut no block; the rows of a block, which are few, wait for the rest of it."""
    def one(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return iter(pa.Table.from_batches(parts).combine_chunks().to_batches())

    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in range(3)]
        before = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0))
        if len(before):
            cut = int(before[-1]) + 1
            yield from one([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield from one(held)


def _links(batch: pa.RecordBatch, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of linked left and right rows of the batch's blocks, some ``AT_ONCE`` pairs at a time.

    Where ``l`` is ``r`` all rows are on both sides, and a link comes both ways.  A cosine
    within rounding of the threshold is computed again from its two rows alone, so that
    a pair is judged alike in whatever block it meets.
    """
    group, l, r, own, rep = (batch.column(c).to_numpy() for c in range(5))
    for at, unit in _by_length(batch.column("embedding")):
        slack = 1e-15 * (unit.shape[1] + 4)
        keys = [k[at] for k in (group, l, r)]
        start = np.concatenate([[0], np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1])
        rows = np.diff(np.append(start, len(at)))
        alone = (keys[1] == keys[2])[start]
        lefts = np.add.reduceat((own[at] == keys[1]).astype(np.int64), start)
        rights = np.where(alone, rows, rows - lefts)
        second = np.where(alone, start, start + lefts)
        some = np.flatnonzero((lefts > 0) & (rights > 0) & (rows > 1))
        shapes, which = np.unique(np.stack([lefts[some], rights[some]], axis=1), axis=0, return_inverse=True)
        order = np.split(some[np.argsort(which, kind="stable")], np.cumsum(np.bincount(which, minlength=len(shapes)))[:-1])
        for (p, q), blocks in zip(shapes, order):
            step = max(1, AT_ONCE // (max(p, q) * max(p, q, unit.shape[1])))
            for k in range(0, len(blocks), step):
                i, j = (s[blocks[k : k + step]][:, None] + np.arange(n) for s, n in ((start, p), (second, q)))
                cosine = unit[i] @ unit[j].transpose(0, 2, 1)
                b, x, y = np.nonzero(cosine >= threshold - slack)
                u, v = i[b, x], j[b, y]
                keep = rep[at[u]] != rep[at[v]]
                near = np.flatnonzero(cosine[b, x, y] < threshold + slack)
                keep[near] &= (unit[u[near]] * unit[v[near]]).sum(axis=1) >= threshold
                yield at[u[keep]], at[v[keep]]


def _connected(threshold: float):
    """Stars ``src, dst`` of the representatives that a batch's links connect."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole(batches):
            reps, node = np.unique(batch.column("rep").to_numpy(), return_inverse=True)
            label = np.arange(len(reps))
            for u, v in _links(batch, threshold):
                label = labels(label[node[u]], label[node[v]], len(reps))[label]
            moved = np.flatnonzero(label != np.arange(len(reps)))
            yield pa.RecordBatch.from_arrays([pa.array(reps[moved]), pa.array(reps[label[moved]])], names=["src", "dst"])

    return run


def _counted(threshold: float):
    """Rows ``rep, links``: the rows of other classes that a batch's links bring to a representative."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole(batches):
            reps, node = np.unique(batch.column("rep").to_numpy(), return_inverse=True)
            size = batch.column("size").to_numpy()
            apart = batch.column("l").to_numpy() != batch.column("r").to_numpy()
            n = np.zeros(len(reps), np.int64)
            for u, v in _links(batch, threshold):
                back = apart[u]
                n += np.bincount(np.concatenate([node[u], node[v[back]]]), np.concatenate([size[v], size[u[back]]]), len(reps)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(n)], names=["rep", "links"])

    return run


def near_embeddings(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``.

    Two rows are linked if their cosine, in double precision, is ``threshold`` or more
    and the lattice tables bring them, or a chain of links between them, together.
    ``n_links`` counts the other rows a row is linked with, ``component_id`` is the
    smallest id reachable.

    A null, empty or zero vector, or one with a null or non-finite component, is linked
    with nothing; so is a vector with any of another length.  Equal rows and ties are
    linked like others.  Rows with a null id are linked with nothing (``component_id``
    null, ``kept`` true).  Ids must fit a long.  Other columns are not looked at; an
    empty table gives an empty one.
    """
    stash = Stash(vectors.sparkSession, "lattice")
    ship(vectors.sparkSession)
    plain = F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    good = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    keys = [F.when(good, F.xxhash64(F.lit(k), "embedding")).alias(f"h{k}") for k in (1, 2)]
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), plain.alias("embedding"))
    rows = stash.put(rows.select("vec_id", "embedding", *keys))
    classes = stash.put(rows.where("h1 is not null").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("embedding").alias("embedding")))
    found = stash.put(classes.select("rep", "embedding").mapInArrow(_cell_rows(threshold), "rep long, cell long"))
    edges = _blocks(found, "cell", classes).mapInArrow(_connected(threshold), "src long, dst long")
    linked = connected_components(edges).select(F.col("node").alias("rep"), "component")
    counts = _blocks(linked, "component", classes).mapInArrow(_counted(threshold), "rep long, links long")
    links = counts.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.select("h1", "h2", "rep", "size").join(linked, "rep", "left").join(links, "rep", "left")
    known = stash.put(known.select("h1", "h2", F.coalesce("component", "rep").alias("component"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    out = rows.drop("embedding").join(known, ["h1", "h2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
