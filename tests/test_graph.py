import random

from quillspark.operators import graph
from quillspark.operators.graph import connected_components


def by_union_find(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def check(spark, pairs):
    df = spark.createDataFrame(pairs, "src long, dst long").repartition(3)
    for small in (1_000_000, 8):  # joined by one task, and contracted in rounds first
        got = {r.node: r.component for r in connected_components(df, small=small).collect()}
        assert got == by_union_find(pairs)


def test_path_star_and_random(spark):
    rng = random.Random(3)
    check(spark, [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)])
    check(spark, [(rng.randrange(200), rng.randrange(200)) for _ in range(140)])


def test_nulls_loops_repeats_and_empty(spark):
    check(spark, [(1, 1), (None, 2), (3, 4), (4, 3), (3, 4), (9, None)])
    check(spark, [])


def test_chunks_and_text_ids(spark, monkeypatch):
    monkeypatch.setattr(graph, "CHUNK", 4)
    rng = random.Random(5)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(70)]
    check(spark, pairs)
    named = spark.createDataFrame([(f"n{a:02}", f"n{b:02}") for a, b in pairs], "src string, dst string")
    assert {r.node: r.component for r in connected_components(named).collect()} == {f"n{a:02}": f"n{b:02}" for a, b in by_union_find(pairs).items()}
