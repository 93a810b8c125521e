"""Graph operators over edge tables: connected components and what follows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import Stash, ship

#: Edges that a task gathers before it reduces them, and edges of a forest that one task finishes.
CHUNK, SMALL = 1_000_000, 1_000_000


def labels(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The least reachable number of each of ``n`` nodes, by hooking roots on lesser ones and shortening paths."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter


def _stars(u: pa.Array, v: pa.Array, every: bool) -> tuple[pa.Array, pa.Array]:
    """Edges reduced to ``(least node, node)`` of each component; with ``every``, the least nodes themselves too."""
    ends = pa.chunked_array([u, v]).combine_chunks().dictionary_encode()
    order = pc.sort_indices(ends.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes = rank[ends.indices.to_numpy()]
    label = labels(codes[: len(u)], codes[len(u) :], len(order))
    node = np.arange(len(order)) if every else np.flatnonzero(label != np.arange(len(order)))
    return ends.dictionary.take(pa.array(order[label[node]])), ends.dictionary.take(pa.array(order[node]))


def _reduced(every: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, held = [], [], 0
        for batch in batches:
            us.append(batch.column(0))
            vs.append(batch.column(1))
            held += batch.num_rows
            if held >= 2 * CHUNK:
                u, v = _stars(pa.concat_arrays(us), pa.concat_arrays(vs), False)
                us, vs, held = [u], [v], len(u)
        if us:
            u, v = _stars(pa.concat_arrays(us), pa.concat_arrays(vs), every)
            for at in range(0, len(u), 65_536):
                yield pa.RecordBatch.from_arrays([u.slice(at, 65_536), v.slice(at, 65_536)], names=["u", "v"])

    return run


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", small: int = SMALL) -> DataFrame:
    """Components of an undirected edge table: rows ``(node, component)``.

    ``component`` is the smallest node id reachable.  Only nodes with an edge
    appear; self-loops, null end points, repeated and reversed edges are harmless
    (a node with nothing but self-loops does not appear), an empty table gives an
    empty one.

    Ids are integers, strings or other plain values that have an order.

    Method: every task reduces the edges it reads to stars, a spanning forest of them,
    before anything is shuffled.  Where at most ``small`` edges are left, one task joins
    the stars.  Otherwise rounds of random-order contraction come before that: every
    node points to its neighbour (or itself) of the least seeded hash, and the edges are
    rewritten to the pointed-to nodes and reduced again; a constant share of the nodes
    is expected to vanish per round, whatever the shape of the graph or the order of the
    ids.  Neighbour choice is a partially aggregated minimum, so a hub never meets in one
    task; the two rewriting joins are plain sort-merge joins which adaptive execution may
    split.  Rounds are written to the shared folder, and nothing but an edge count
    reaches the driver.
    """
    spark = edges.sparkSession
    ship(spark)
    stash = Stash(spark, "components")
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    e = stash.put(e)  # where tasks made them in Python, these need not wait there while others reduce
    e = stash.put(e.mapInArrow(_reduced(False), e.schema))
    assigned, step = None, 0
    while (left := e.count()) > small:
        ends = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        seed = F.lit(7919 * (step + 1))
        best = F.min(F.struct(F.xxhash64("v", seed).alias("h"), F.col("v")))
        point = ends.groupBy("u").agg(best.alias("b"))
        own = F.struct(F.xxhash64("u", seed).alias("h"), F.col("u").alias("v"))
        point = stash.put(point.select("u", F.least(F.col("b"), own)["v"].alias("p")))
        first = e.join(point, "u").select(F.col("p").alias("pu"), F.col("v").alias("u"))
        both = first.join(point, "u").select("pu", F.col("p").alias("pv")).where("pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v"))
        following = stash.put(both.mapInArrow(_reduced(False), both.schema))
        if assigned is None:
            new = stash.put(point.select(F.col("u").alias("node"), F.col("p").alias("root")))
        else:
            new = assigned.join(point, assigned.root == point.u, "left")
            new = stash.put(new.select("node", F.coalesce("p", "root").alias("root")))
            stash.drop(assigned)
        stash.drop(e, point)
        assigned, e, step = new, following, step + 1
    if assigned is None:
        if not left:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        joined = e.coalesce(1).mapInArrow(_reduced(True), e.schema)
        return stash.put(joined.select(F.col("v").alias("node"), F.col("u").alias("component")))
    joined = e.coalesce(1).mapInArrow(_reduced(True), e.schema).select(F.col("v").alias("root"), F.col("u").alias("top"))
    rooted = assigned.join(joined, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    rooted = stash.put(rooted)
    least = rooted.groupBy("root").agg(F.min("node").alias("component"))
    return stash.put(rooted.join(least, "root").select("node", "component"))
