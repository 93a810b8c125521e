"""Centroid clustering (operator 13): plain Lloyd on integer vectors.

The centroids, which are few, go to every task; each finds the nearest one of every
vector by integer arithmetic and passes on one row of integer sums per cluster.  All
numbers are exact, so the result does not depend on partitions or their order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import Stash, ship

#: Largest magnitude of a component, so that squared distances of up to 128 components fit a long.
LARGEST = 1 << 27


def usable(vector: Column, dim: int, scale: int) -> Column:
    """Exactly ``dim`` components, none null or non-finite or beyond ``LARGEST`` when scaled."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < LARGEST))  # false for NaN, which is greater
    return F.coalesce((F.size(vector) == dim) & fine, F.lit(False))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's nearest centroid, the least at a tie, and the squared distance, in integers."""
    best, cluster = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
    for k, c in enumerate(centroids):
        d = x - c
        d = np.einsum("ij,ij->i", d, d)
        closer = d < best
        best[closer], cluster[closer] = d[closer], k
    return cluster, best


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.concatenate(column.to_list()).astype(np.int64).reshape(-1, dim) if len(column) else np.zeros((0, dim), np.int64)


def _summed(centroids: np.ndarray):
    """Per batch and cluster the number of rows and the sums of their components."""
    k, dim = centroids.shape

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for pdf in frames:
            x = _matrix(pdf["x"], dim)
            cluster, _ = nearest(x, centroids)
            n += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += x[cluster == c].sum(axis=0)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": np.repeat(at, dim), "place": np.tile(np.arange(dim), len(at)), "n": np.repeat(n[at], dim), "total": total[at].ravel()})

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)
            cluster, distance = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def lloyd_clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per kept vector: its id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid``.

    Vectors are kept if they have exactly ``dim`` components (128 at most), all finite and smaller than
    2**27 when scaled (beyond that squared distances would not fit a long); component c
    becomes ``floor(scale * c)``.  The first centroids are the ``k`` kept vectors (or
    all, if fewer) of least sha256 of ``seed`` and the id in decimal; ties, which only
    repeated ids make, by the vector.  Each round moves every centroid that has vectors
    to the floor of their mean; an empty one stays.  At equal distances the smaller
    number wins.  Repeated rows count as often as they occur; a row with a null id is
    assigned but is no first centroid (without any id there are no centroids, and no
    rows).  Other columns are not looked at; an empty table gives an empty one.

    The driver holds centroids and sums of ``k * dim`` numbers, whatever the input.
    """
    if not 0 < dim <= 128:
        raise ValueError("dim is 1 to 128")
    spark = vectors.sparkSession
    ship(spark)
    stash = Stash(spark, "lloyd")
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("int"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding")).where(usable(F.col("embedding"), dim, scale))
    rows = stash.put(rows.select("vec_id", whole.alias("x")))
    kind = rows.schema["vec_id"].dataType.simpleString()
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id is not null").select(order.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    if not first:
        return rows.select(F.col("vec_id").alias(id_col), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.array().cast("array<bigint>").alias("centroid")).where("false")
    centroids = np.array([r["x"] for r in first], np.int64)
    for _ in range(rounds):
        parts = rows.select("x").mapInPandas(_summed(centroids), "cluster int, place int, n long, total long")
        for r in parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # k * dim rows at most
            centroids[r["cluster"], r["place"]] = r["total"] // r["n"]
    found = stash.put(rows.mapInArrow(_assigned(centroids), f"vec_id {kind}, cluster int, distance long"))
    inertia = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    of = spark.createDataFrame([(c, n, sum(inertia.values()), centroids[c].tolist()) for c, n in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid array<bigint>")
    out = found.join(F.broadcast(of), "cluster")  # k rows
    return out.select(F.col("vec_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_digest(centroid: Column) -> Column:
    """Lowercase hex sha256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda c: c.cast("string")), ","), 256)
