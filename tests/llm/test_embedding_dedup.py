import numpy as np
import pyarrow as pa

from quillspark.llm import embedding_dedup as ed
from quillspark.llm.embedding_dedup import cells, near_embeddings, nearest_e8, shortest_e8


def test_lattice_points_are_nearest():
    steps = shortest_e8()
    assert len(steps) == 240 and np.allclose((steps**2).sum(axis=1), 2)
    x = np.random.default_rng(1).normal(size=(300, 8)) * 3
    p = nearest_e8(x)
    whole = np.isclose(p, np.rint(p)).all(axis=1) | np.isclose(p - 0.5, np.rint(p - 0.5)).all(axis=1)
    assert whole.all() and np.allclose(p.sum(axis=1) % 2, 0)
    best = ((x - p) ** 2).sum(axis=1)
    assert (best <= 1 + 1e-9).all()  # the covering radius is 1
    for s in steps:
        assert (best <= ((x - p - s) ** 2).sum(axis=1) + 1e-9).all()


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    for dim in (16, 64, 256):
        a = rng.normal(size=(800, dim))
        a /= np.linalg.norm(a, axis=1)[:, None]
        w = rng.normal(size=a.shape)
        w -= (w * a).sum(axis=1)[:, None] * a
        w /= np.linalg.norm(w, axis=1)[:, None]
        b = 0.95 * a + np.sqrt(1 - 0.95**2) * w
        met = np.zeros(len(a), bool)
        for t in range(ed.TABLES):
            met |= (cells(a, 0.95, t)[:, :, None] == cells(b, 0.95, t)[:, None, :]).any(axis=(1, 2))
        assert met.mean() > 0.95, dim


def brute(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent = {i: i for i, _ in rows}
    n = [0] * len(good)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(good):
        for m, (j, b) in enumerate(good[:k]):
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                n[k] += 1
                n[m] += 1
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return sorted((i, n[k], find(i)) for k, (i, _) in enumerate(good))


def test_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ed, "SIDE", 16)
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for size in [1] * 60 + [2] * 10 + [3, 5, 90]:
        base = rng.normal(size=64)
        for _ in range(size):
            v = base + rng.normal(size=64) * rng.choice([0.0, 0.05, 0.12])
            rows.append((int(rng.integers(10**9)), v.astype(np.float32).tolist()))
    rows += [(7, rows[-1][1]), (8, rows[-1][1]), (9, [2 * x for x in rows[0][1]]), (10, [1.0, 0.0]), (11, [1.0, 0.1]), rows[3]]
    odd = [(20, None), (21, []), (22, [0.0] * 64), (23, [float("nan")] + [1.0] * 63), (24, [None] + [1.0] * 63), (25, [float("inf")] * 64), (None, rows[0][1])]
    df = spark.createDataFrame([(*r, 5) for r in rows + odd], "vec_id long, embedding array<float>, component_id int").repartition(4)
    got = near_embeddings(df).collect()
    assert len(got) == len(rows) + len(odd)
    ids = {i for i, _ in odd}
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id not in ids) == brute(rows)
    for r in got:
        if r.vec_id in ids:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
        assert r.vec_id is None or r.kept == (r.vec_id == r.component_id)
    assert near_embeddings(df.limit(0)).collect() == []


def test_small_blocks_are_compared_many_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    rows, links = [], set()
    for group in range(700):
        base = rng.normal(size=8)
        blocks = [(0, 0), (0, 1), (1, 1)] if group % 7 == 0 else [(0, 0)]
        members = [(group * 100 + k, k % 2 if len(blocks) > 1 else 0, base + rng.normal(size=8) * 0.15) for k in range(int(rng.integers(1, 7)))]
        for l, r in blocks:
            rows += [(group, l, r, own, i, 1 + i % 3, v.tolist()) for own in sorted({l, r}) for i, o, v in members if o == own]
        links |= {(i, j) for i, _, v in members for j, _, w in members if i != j and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.95}
    columns = list(zip(*rows))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["group", "l", "r", "own", "rep", "size", "embedding"])
    cut = [batch.slice(at, 101) for at in range(0, batch.num_rows, 101)]  # cuts through blocks
    calls, multiplied = [], ed._links
    monkeypatch.setattr(ed, "_links", lambda *a: calls.extend(found := list(multiplied(*a))) or found)
    got, want = {}, {}
    for out in ed._counted(0.95)(cut):
        for rep, n in zip(*out.to_pydict().values()):
            got[rep] = got.get(rep, 0) + n
    for i, j in links:
        want[i] = want.get(i, 0) + 1 + j % 3
    assert len(links) > 1000 and {i: n for i, n in got.items() if n} == want
    assert len(calls) < len({r[:3] for r in rows}) / 3  # products, not one for each block
    edges = [e for out in ed._connected(0.95)(cut) for e in zip(*out.to_pydict().values())]
    assert set(edges) and all(i // 100 == j // 100 and j < i for i, j in edges)


def test_no_group_is_a_call_of_its_own(spark):
    df = spark.createDataFrame([(k, [1.0, k % 5 / 10]) for k in range(50)], "vec_id long, embedding array<double>")
    got = near_embeddings(df)
    assert "InPandas" not in got._jdf.queryExecution().toString()
    assert sorted((r.vec_id, r.n_links) for r in got.collect()) == [(i, n) for i, n, _ in brute([(k, [1.0, k % 5 / 10]) for k in range(50)])]
