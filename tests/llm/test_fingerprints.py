import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quillspark.llm import fingerprints as fp


def shingles(text, width=5):
    words = [w for w in (text or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("size", [1, 2, 300])
def test_neighbours_like_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(fp, "RANGE_ROWS", 20)
    monkeypatch.setattr(fp, "LEVEL", 5)
    rng = random.Random(size)
    rows = [(rng.randrange(10**6), " ".join(rng.choices("é a bb ccc dd\n 漢字 🙂x".split(" "), k=rng.randint(0, 60))) or None) for _ in range(size)]
    if size > 2:
        rows += [rows[3], (rows[3][0], "another text"), (-5, ""), (None, "no id"), (None, "a no id too")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, range string, guest int").repartition(3)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.edited_sha256, r.n_chars, r.near_edited, r.near_next, r.fingerprint) for r in fp.fingerprint_neighbours(df).collect()), key=lambda x: x[:3])
    ordered = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    want = []
    for k, (known, i, t) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][2]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        want.append((known, i, hashlib.sha256(edited.encode()).hexdigest(), len(t), jaccard(shingles(t), shingles(edited)), jaccard(shingles(t), shingles(following))))
    want.sort(key=lambda x: x[:3])
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:6] == pytest.approx(w[4:6])
    by_text = {}
    for g, (_, _, t) in zip(sorted(got, key=lambda x: (x[0], x[1])), ordered):
        by_text.setdefault(len(g[6]), set()).add(g[6])


def test_estimates_and_merging(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(6000)]
    rows = [(0, " ".join(words[:4000])), (1, " ".join(words[1000:6000])), (2, " ".join(words[1000:2000]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("s", fp.fingerprint(F.col("text"), 1024))
    a, b, c = (r.s for r in df.orderBy("doc_id").collect())
    pair = spark.createDataFrame([(a, b, c)], "a array<bigint>, b array<bigint>, c array<bigint>")
    A, B, C = F.col("a"), F.col("b"), F.col("c")
    r = pair.select(fp.resemblance(A, B, 1024).alias("ab"), fp.containment(C, A, 1024).alias("ca"), fp.containment(A, C, 1024).alias("ac"), fp.distinct_shingles(A, 1024).alias("n"), fp.merged(A, B, 1024).alias("m")).first()
    assert abs(r.ab - 0.5) < 0.06 and abs(r.ca - 1) < 0.15 and abs(r.ac - 0.25) < 0.06 and abs(r.n - 3996) < 400
    parts = spark.createDataFrame([("x", a), ("x", b), ("y", c)], "who string, s array<bigint>")
    merged = {r.who: r.s for r in fp.merge_fingerprints(parts, "who", "s", 1024).collect()}
    assert merged["x"] == r.m and merged["y"] == c


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fp.fingerprint_neighbours(df).collect() == []
