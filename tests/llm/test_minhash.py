import random

import numpy as np

from quillspark.llm.minhash import COORDINATES, Shingler, near_duplicates, sketch


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width):
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def corpus(seed, bases, group):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    rows = []
    for b in range(bases):
        words = rng.choices(vocabulary, k=rng.randint(1, 120))
        for _ in range(rng.choice([1, 1, 2, 5]) if b else group):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((rng.randrange(10**9), rng.choice([" ", "\n", " \t"]).join(copy)))
    return rows


def test_sketch_estimates_resemblance_and_fills():
    rng = np.random.default_rng(1)
    for share, n in ((0.8, 400), (0.5, 60), (0.8, 9)):
        agree = []
        for _ in range(60):
            both = rng.integers(0, 2**63, n).astype(np.uint64)
            k = round(n * (1 - share) / (1 + share))
            agree.append((sketch(both[k:]) == sketch(both[: n - k])).mean())
        want = (n - 2 * k) / n
        assert abs(np.mean(agree) - want) < 0.03
    assert len(sketch(np.array([7], np.uint64))) == COORDINATES


def test_shingler_matches_sets():
    for t in (None, "", " \n", "a", "a b", "A b\tc d e", "a b c d a b c d a b c d", "x " * 50, "é É ü"):
        for w in (4, 5):
            assert len(Shingler(w).hashes(t)) == len(shingles(t, w))


def test_components_like_brute_force(spark):
    for seed, width, group in ((1, 4, 40), (2, 5, 150)):
        rows = corpus(seed, 120, group) + [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two")]
        df = spark.createDataFrame([(i, t, 0, True) for i, t in rows], "doc_id long, text string, component_id int, kept boolean").repartition(5)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, width).collect()}
        assert got == brute(rows, width)


def test_large_buckets_go_through_exact_blocks(spark, monkeypatch):
    from quillspark.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK", 12)
    monkeypatch.setattr(minhash, "STARS", 1)
    rng = random.Random(8)
    base = [f"w{rng.randrange(900)}" for _ in range(110)]
    rows = []
    for k in range(160):  # copies that are often under 0.8 of each other
        copy = list(base)
        for _ in range(rng.randint(1, 5)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, 4).collect()}
    assert got == brute(rows, 4)


def test_chain_and_edges_of_the_threshold(spark):
    words = [f"v{k}" for k in range(400)]
    rows = [(k, " ".join(words[k * 8 : k * 8 + 80])) for k in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == brute(rows, 4)


def test_nulls_repeats_empty(spark):
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (8, None), (9, "a b c d e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == [(-1, 1, None, True), (7, 1, 7, True), (7, 1, 7, True), (8, 0, 8, True), (9, 1, 7, False)]
    assert near_duplicates(df.limit(0)).collect() == []


def test_an_id_that_repeats_with_another_text_loses_no_link(spark):
    a, b = ([f"{x}{k}" for k in range(60)] for x in "ab")
    rows = [(4, a), (4, b), (2, [*a[:-1], "x"]), (3, [*b[:-1], "y"]), (4, []), (9, ["alone"] * 3), (None, a)]
    df = spark.createDataFrame([(i, " ".join(t), "clash") for i, t in rows], "doc_id long, text string, row string")
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in near_duplicates(df, 4).collect()))
    assert got == [(-1, 57, -1, True), (2, 57, 2, True), (3, 57, 3, True), (4, 0, 4, True), (4, 57, 2, False), (4, 57, 3, False), (9, 1, 9, True)]
