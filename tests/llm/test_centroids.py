"""Lloyd's rounds against a plain form in Python integers."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm.centroids import centroid_digest, lloyd_clusters, nearest


def plain(rows, k, rounds, dim, scale, seed):
    kept = [(i, [int(np.floor(scale * float(c))) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) and abs(c * scale) < 2**27 for c in v)]
    first = sorted((hashlib.sha256(f"{seed}{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]
    c = [list(x) for _, x in first]
    find = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        at = [find(x)[1] for _, x in kept]
        for j in range(len(c)):
            mine = [x for (_, x), a in zip(kept, at) if a == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    out = [(i, *find(x)[::-1]) for i, x in kept]
    per = {j: sum(d for _, a, d in out if a == j) for j in range(len(c))}
    return sorted([(i, a, d, per[a], sum(per.values()), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for i, a, d in out], key=str)


def test_like_plain_integers(spark):
    rng = np.random.default_rng(5)
    dim = 6
    rows = [(int(i), (rng.normal(size=dim) * rng.choice([0.01, 0.5])).astype(np.float32).tolist()) for i in rng.permutation(120)]
    rows += [(7, rows[0][1]), (7, rows[0][1]), (None, rows[3][1])]
    odd = [(500, None), (501, [1.0] * 5), (502, [0.0] * 5 + [None]), (503, [float("nan")] * dim), (504, [float("-inf")] * dim), (505, [3e30] * dim), (506, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<float>, cluster int").repartition(4)
    for k, rounds in ((9, 3), (1, 1), (500, 2)):
        got = lloyd_clusters(df, k, rounds, dim, 256, "2:").withColumn("sha", centroid_digest(F.col("centroid"))).collect()
        assert sorted([(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.sha) for r in got], key=str) == plain(rows + odd, k, rounds, dim, 256, "2:")


def test_ties_go_to_the_smaller_number():
    cluster, d = nearest(np.array([[0, 0], [4, 0]]), np.array([[2, 0], [-2, 0], [2, 0]]))
    assert cluster.tolist() == [0, 0] and d.tolist() == [4, 4]


def test_no_vectors_and_no_ids(spark):
    shape = "vec_id long, embedding array<float>"
    assert lloyd_clusters(spark.createDataFrame([], shape), 3, 2, 2).collect() == []
    nameless = lloyd_clusters(spark.createDataFrame([(None, [1.0, 2.0])], shape), 3, 2, 2)
    assert nameless.collect() == [] and nameless.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    with pytest.raises(ValueError):
        lloyd_clusters(spark.createDataFrame([], shape), dim=200)
