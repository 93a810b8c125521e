"""SQL table functions equal the DataFrame forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import scans, search, vectors
from quillspark.sources.functions import register_functions


@pytest.fixture
def views(spark):
    rng = np.random.default_rng(8)
    words = lambda k: " ".join(f"w{j}" for j in sorted(set(rng.integers(0, 30, size=6).tolist())))
    rows = [(k, "pq"[k % 2], words(k), rng.normal(size=4).tolist(), k % 7 != 0, False, None) for k in range(60)] + [(90, "p", "w1 w2", None, True, False, None), (91, "p", None, [0.0] * 4, True, False, None), (92, "p", "w3", [1.0], True, False, None)]
    items = spark.createDataFrame(rows, "id long, project string, content string, embedding array<double>, is_active boolean, archived boolean, superseded_by long")
    goals = spark.createDataFrame([(1, "p", 2, "b", "active"), (2, "p", None, "a", "active"), (3, "p", 1, "c", "active"), (4, "p", 0, "x", "superseded"), (5, "q", 1, "y", "active")], "id long, project string, rank int, content string, status string")
    items.createOrReplaceTempView("memory_items")
    goals.createOrReplaceTempView("memory_objectives")
    register_functions(spark)
    return items


def test_objective_list(spark, views):
    assert [(r.id, r.place) for r in spark.sql("SELECT * FROM objective_list('p') ORDER BY place").collect()] == [(3, 1), (1, 2), (2, 3)]
    every = spark.sql("SELECT p.p, o.id FROM VALUES ('p'), ('q'), ('z') AS p(p), LATERAL objective_list(p.p) AS o").collect()
    assert sorted((r.p, r.id) for r in every) == [("p", 1), ("p", 2), ("p", 3), ("q", 5)]


def test_match_memories(spark, views):
    asked = spark.createDataFrame([(1000 + k, "pqr"[k % 3], v) for k, v in enumerate(np.random.default_rng(9).normal(size=(9, 4)).tolist())] + [(2000, "p", [0.0] * 4)], "id long, project string, embedding array<double>")
    asked.createOrReplaceTempView("asked")
    got = spark.sql("SELECT a.id, m.id AS match, round(m.similarity, 9) AS s FROM asked a, LATERAL match_memories(a.embedding, 0.3D, 3, a.project) m").collect()
    near = vectors.nearest_neighbours(asked.where("id < 2000"), views.where(scans.live()), 3, within="project", least=0.3)
    assert {tuple(r) for r in got} == {tuple(r) for r in near.select("id", "neighbour", F.round("similarity", 9)).collect()} and len(got) > 6


def test_matches_of_many_rows_are_those_of_the_function(spark, views):
    asked = spark.createDataFrame([(1000 + k, "pqr"[k % 3], v) for k, v in enumerate(np.random.default_rng(9).normal(size=(9, 4)).tolist())] + [(2000, "p", [0.0] * 4), (2001, None, [1.0] * 4), (2002, "p", None), (2003, "p", [2.0])], "id long, project string, embedding array<double>")
    asked = asked.unionByName(views.where("id < 8").select("id", "project", "embedding"))
    asked.createOrReplaceTempView("asked")
    for least in (0.3, -1.0):
        want = spark.sql(f"SELECT a.id, m.id AS match, round(m.similarity, 9) AS s FROM asked a, LATERAL match_memories(a.embedding, {least}D, 3, a.project) m").collect()
        got = search.matched_memories(asked, views, least, 3).select("id", "match_id", F.round("similarity", 9)).collect()
        assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in want) and len(want) > 20


def test_hybrid_search(spark, views):
    asked = spark.createDataFrame([("a", 1, "w1 w5 w9", [1.0, 0.0, 0.0, 0.5]), ("b", 2, "W7, w8", None)], "signal_key string, session_id long, search_text string, embedding array<double>")
    asked.createOrReplaceTempView("asked")
    got = spark.sql("SELECT a.signal_key, m.id, round(m.similarity, 9) AS s, m.place FROM asked a, LATERAL memory_hybrid_search(a.search_text, a.embedding, 5) m").collect()
    live = views.where(scans.live())
    near = vectors.nearest_neighbours(asked.where("embedding is not null").select((-F.col("session_id")).alias("id"), "embedding"), live.where("id <> 91"), 1000).select(F.lit("a").alias("signal_key"), F.col("neighbour").alias("id"), "rank")
    want = search.fused(search.lexical_hits(asked, live, 1000), near)
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in want.select("signal_key", "id", F.round("similarity", 9), "place").collect())
