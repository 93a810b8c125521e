"""Queries that do the whole of their operator's job, beside those whose SQL asks for a part of it."""


import numpy as np

import __spark_entry__


def fnv(text):
    h = 2166136261
    for c in text:
        h = ((h ^ ord(c)) * 16777619) & 0xFFFFFFFF
    return f"{h:08x}"


def test_text_functions_see_whole_texts(spark, tmp_path):
    head = "The  same FORTY characters and more of them, "
    texts = [head + "then a", head + "then b", "short", "", head + " \n x" * 500, "é漢" * 60]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.collapsed, r.short, r.fnv) for r in __spark_entry__.queries()["I_text_functions_whole"](spark, str(tmp_path)).collect()}
    assert got == {k: (" ".join(t.lower().split()), t[:20] + "…" if len(t) > 20 else t, fnv(t)) for k, t in enumerate(texts)}
    assert got[0][2] != got[1][2]


def test_every_vector_gets_its_nearest_centroid(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=8).astype("float32").tolist(), k % 3) for k in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.id: (r.registry_id, r.similarity) for r in __spark_entry__.queries()["A18_nearest_label_centroid"](spark, str(tmp_path)).collect()}
    v = np.array([r[1] for r in rows])
    c = np.array([v[k::3].mean(axis=0) for k in range(3)])
    s = (v / np.linalg.norm(v, axis=1)[:, None]) @ (c / np.linalg.norm(c, axis=1)[:, None]).T
    assert {k: x[0] for k, x in got.items()} == {k: int(j) for k, j in enumerate(s.argmax(axis=1))}
    assert np.allclose([got[k][1] for k in range(60)], s.max(axis=1), atol=1e-5)


def test_registered_promotion_finds_duplicates(spark, tmp_path):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    # every row is also a stored live item of its project
    rows = [(k, text(k), "en", "s", 10) for k in (2, 10)] + [(4, text(4), "en", "t", 10)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.id: r.reason for r in __spark_entry__.queries()["P2_promotion_duplicates"](spark, str(tmp_path)).collect()}
    assert "duplicate" in got.values()
