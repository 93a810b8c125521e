"""Cutting large incoherent components into coherent parts, as tables.

Cutting the weakest edges one by one splits a part just where its edges merge it when
they are taken strongest first.  So the parts that can arise are the nodes of a tree of
merges, and if lists of members are joined end to end at each merge, every such part is
an interval of the final list.  Sums of unit vectors over intervals are differences of
running sums, and the parts that are accepted are the widest coherent intervals.

Vectors never leave their own rows' buckets but for the two running sums at an
interval's ends.  Merges take the edges in blocks from the strongest to the weakest, so
a task holds the edges of one block at most, whatever the size of the component.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.graph import connected_components
from quillspark.runtime import Stash, ship

#: Edges of a block of merges, and members of a bucket of running sums.
BLOCK_EDGES, BUCKET = 250_000, 256


def strongest_first(links: pd.DataFrame) -> pd.DataFrame:
    """Edges by falling weight, those without one last; equal ones by falling ends."""
    return links.sort_values(["weight", "source_id", "target_id"], ascending=False, na_position="last")


def _forest(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The strongest spanning forest of a task's edges: what else it read can't be in that of all edges."""
    kept = None
    for pdf in frames:
        both = strongest_first(pdf if kept is None else pd.concat([kept, pdf]))
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := up.setdefault(x, x)) != x:
                up[x] = x = up.setdefault(p, p)
            return x

        take = []
        for k, (a, b) in enumerate(zip(both["source_id"].tolist(), both["target_id"].tolist())):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
                take.append(k)
        kept = both.iloc[take]
    if kept is not None:
        yield kept


def _merged(key: tuple, links: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
    """Merges of a block within one group of clusters: where each cluster's list starts in the joined one, and each merge's interval."""
    links = strongest_first(links)
    size = dict(zip(parts["cluster"].tolist(), parts["size"].tolist()))
    up, start = {c: c for c in size}, dict.fromkeys(size, 0)

    def place(c: int) -> tuple[int, int]:
        path = []
        while up[c] != c:
            path.append(c)
            c = up[c]
        total = 0
        for x in reversed(path):
            total += start[x]
            up[x], start[x] = c, total
        return c, total

    merges = []
    for a, b, s, t in zip(links["a"].tolist(), links["b"].tolist(), links["source_id"].tolist(), links["target_id"].tolist()):
        a, b = place(a)[0], place(b)[0]
        if a == b:
            continue
        if size[a] < size[b]:
            a, b = b, a
        up[b], start[b] = a, size[a]
        size[a] += size[b]
        merges.append((a, size[a], s, t))
    rows = [(key[0], c, place(c)[1], None, None, None) for c in up]
    rows += [(key[0], None, (lo := place(a)[1]), lo + n, s, t) for a, n, s, t in merges]
    return pd.DataFrame(rows, columns=["parent", "cluster", "lo", "hi", "source_id", "target_id"]).astype("Int64")


def _lists(stash: Stash, ids: DataFrame, edges: DataFrame, block_edges: int) -> tuple[DataFrame, DataFrame]:
    """Members ``id, top, place`` in their lists, and merges ``top, lo, hi, source_id, target_id`` as intervals."""
    edges = stash.put(edges.mapInPandas(_forest, edges.schema))
    blocks = max(1, -(-edges.count() // block_edges))
    if blocks > 1:
        order = (F.desc_nulls_last("weight"), F.desc("source_id"), F.desc("target_id"))
        edges = stash.put(edges.repartitionByRange(blocks, *order).withColumn("block", F.spark_partition_id()))
    of = ids.select("id", F.col("id").alias("cluster"))
    sizes = ids.select(F.col("id").alias("cluster"), F.lit(1).cast("bigint").alias("size"))
    levels = []
    for k in range(blocks):
        mine = edges.where(F.col("block") == k) if blocks > 1 else edges
        ends = lambda c: of.select(F.col("id").alias(f"{c}_id"), F.col("cluster").alias(c[0]))
        mine = mine.join(ends("source").withColumnRenamed("s", "a"), "source_id").join(ends("target").withColumnRenamed("t", "b"), "target_id").where("a <> b")
        mine = stash.put(mine.select("a", "b", "source_id", "target_id", "weight"))
        groups = connected_components(mine, "a", "b").select(F.col("node").alias("cluster"), F.col("component").alias("parent"))
        known = mine.join(groups.select(F.col("cluster").alias("a"), "parent"), "a")
        parts = sizes.join(groups, "cluster").select("cluster", "size", F.col("parent").alias("of"))
        out = stash.put(known.groupBy("parent").cogroup(parts.groupBy("of")).applyInPandas(_merged, "parent long, cluster long, lo long, hi long, source_id long, target_id long"))
        levels.append(out)
        if k < blocks - 1:
            of = stash.put(of.join(groups, "cluster", "left").select("id", F.coalesce("parent", "cluster").alias("cluster")))
            sizes = stash.put(sizes.join(groups, "cluster", "left").groupBy(F.coalesce("parent", "cluster").alias("cluster")).agg(F.sum("size").alias("size")))
    at, intervals = None, None
    for out in reversed(levels):
        starts, merges = out.where("cluster is not null").select("parent", "cluster", "lo"), out.where("cluster is null").drop("cluster")
        if at is None:
            placed = starts.select("cluster", F.col("parent").alias("top"), F.col("lo").alias("place"))
            found = merges.select(F.col("parent").alias("top"), "lo", "hi", "source_id", "target_id")
        else:  # a cluster keeps its number where its list stays first, so what the later block says of it may be of its parent
            whole = at.select(F.col("cluster").alias("parent"), "top", "place")
            placed = starts.join(whole, "parent", "left").select("cluster", F.coalesce("top", "parent").alias("top"), (F.coalesce("place", F.lit(0)) + F.col("lo")).alias("place"))
            placed = placed.unionByName(at.join(starts.select("cluster"), "cluster", "left_anti"))
            base = F.coalesce("place", F.lit(0))
            found = merges.join(whole, "parent", "left").select(F.coalesce("top", "parent").alias("top"), (F.col("lo") + base).alias("lo"), (F.col("hi") + base).alias("hi"), "source_id", "target_id")
        at = stash.put(placed)
        intervals = found if intervals is None else intervals.unionByName(found)
    return at.select(F.col("cluster").alias("id"), "top", "place"), stash.put(intervals)


def _running(bucket: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        v = np.array(pdf["embedding"].to_list(), np.float64)
        size = np.linalg.norm(v, axis=1)
        v = np.hstack([v / np.maximum(size, 1e-300)[:, None], (size > 0)[:, None]])
        return pd.DataFrame({"top": key[0], "bucket": key[1], "place": pdf["place"].to_numpy(), "sums": list(v.cumsum(axis=0))})

    return run


def cut_components(members: DataFrame, edges: DataFrame, threshold: float, least: int, block_edges: int = BLOCK_EDGES, bucket: int = BUCKET) -> DataFrame:
    """Coherent parts ``component, group, id`` of components that are incoherent as a whole.

    ``members`` hold ``component, id, embedding`` (none null, of one length), ``edges``
    ``component, source_id, target_id, weight``; ids belong to one component.  A part is
    accepted at the first cut that makes the mean cosine of its pairs reach ``threshold``
    with ``least`` members or more; others are cut on, or dropped.
    """
    spark = members.sparkSession
    ship(spark)
    stash = Stash(spark, "cut")
    members = stash.put(members.select("component", "id", "embedding"))
    ids = members.select("id")
    edges = edges.join(ids.withColumnRenamed("id", "source_id"), "source_id", "left_semi").join(ids.withColumnRenamed("id", "target_id"), "target_id", "left_semi").where("source_id <> target_id")
    edges = stash.put(edges.select("component", "source_id", "target_id", F.col("weight").cast("double").alias("weight")))
    of = F.coalesce("weight", F.lit(float("-inf")))
    weakest = edges.groupBy("component").agg(F.min(F.struct(of.alias("w"), "source_id", "target_id")).alias("e")).select("component", "e.*")
    pair = lambda t: (F.least(f"{t}.source_id", f"{t}.target_id"), F.greatest(f"{t}.source_id", f"{t}.target_id"))
    (a, b), (c, d) = pair("x"), pair("y")
    weakest = weakest.alias("x").join(edges.withColumn("w", of).alias("y"), (a == c) & (b == d) & (F.col("y.w") > F.col("x.w")), "left_anti")  # a stronger one of the same ends was taken
    listed, merges = _lists(stash, ids, edges.drop("component"), block_edges)
    listed = stash.put(listed.join(members.select("id", "component"), "id").withColumn("bucket", F.floor(F.col("place") / bucket)))
    # of a component that its edges don't hold together, the first cut takes the weakest edge, and the part which that edge made is never judged
    loose = listed.groupBy("component").agg((F.count_distinct("top") > 1).alias("loose"), F.count("*").alias("n")).join(members.groupBy("component").agg(F.count("*").alias("all")), "component")
    skipped = weakest.join(loose.where("loose or n < all"), "component", "left_semi").select("source_id", "target_id")
    merges = merges.where(F.col("hi") - F.col("lo") >= least).join(skipped, ["source_id", "target_id"], "left_anti").select("top", "lo", "hi")

    dim = members.select(F.size("embedding")).first()
    if dim is None:
        return members.select("component", F.col("id").alias("group"), "id").where("false")
    kept = listed.join(members.select("id", "embedding"), "id").select("top", "bucket", "place", "embedding")
    sums = stash.put(kept.groupBy("top", "bucket").applyInPandas(_running(bucket), "top long, bucket long, place long, sums array<double>"))
    ends = sums.groupBy("top", "bucket").agg(F.max(F.struct("place", "sums"))["sums"].alias("last"))
    earlier = Window.partitionBy("top").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.array_repeat(F.lit(0.0), dim[0] + 1)
    heads = ends.select("top", "bucket", F.array(*[F.coalesce(F.sum(F.col("last")[i]).over(earlier), F.lit(0.0)) for i in range(dim[0] + 1)]).alias("head"))  # one row per bucket
    upto = sums.join(stash.put(heads), ["top", "bucket"]).select("top", "place", F.zip_with("sums", "head", lambda a, b: a + b).alias("upto"))
    upto = stash.put(upto)
    judged = merges.join(upto.select("top", (F.col("place") + 1).alias("hi"), F.col("upto").alias("_hi")), ["top", "hi"]).join(upto.select("top", (F.col("place") + 1).alias("lo"), F.col("upto").alias("_lo")), ["top", "lo"], "left")
    part = F.zip_with("_hi", F.coalesce("_lo", nothing), lambda a, b: a - b)
    n = F.col("hi") - F.col("lo")
    judged = judged.select("top", "lo", "hi", part.alias("part"))
    square = F.aggregate(F.slice("part", 1, dim[0]), F.lit(0.0), lambda s, x: s + x * x)
    good = judged.where((square - F.round(F.col("part")[dim[0]])) / (n * (n - 1)) >= threshold).select("top", "lo", "hi").withColumn("bucket", F.floor(F.col("lo") / bucket))
    good = stash.put(good)
    # the widest: nested or disjoint as they are, those that no interval before them (by start, then longest) reaches beyond
    far = good.groupBy("top", "bucket").agg(F.max("hi").alias("far"))
    far = far.select("top", "bucket", F.max("far").over(earlier).alias("before"))
    own = Window.partitionBy("top", "bucket").orderBy("lo", F.desc("hi")).rowsBetween(Window.unboundedPreceding, -1)
    reach = good.withColumn("inner", F.max("hi").over(own)).join(far, ["top", "bucket"])
    widest = reach.where(F.greatest(F.coalesce("inner", F.lit(0)), F.coalesce("before", F.lit(0))) <= F.col("lo")).select("top", "lo", "hi")
    spread = widest.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("lo") / bucket), F.floor((F.col("hi") - 1) / bucket))))
    inside = listed.join(spread, ["top", "bucket"]).where((F.col("place") >= F.col("lo")) & (F.col("place") < F.col("hi")))
    inside = stash.put(inside.select("component", "id", "top", "lo"))
    names = inside.groupBy("top", "lo").agg(F.min("id").alias("group"))
    return inside.join(names, ["top", "lo"]).select("component", "group", "id")
