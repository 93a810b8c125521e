import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import aggregates, gates, ledger, scans, search, vectors
from quillspark.plans import jobs
from quillspark.sources import adapters as A
from quillspark.sources.tables import SCHEMAS, align, schema

NOW = dt.datetime(2024, 1, 31)
DAY = dt.timedelta(days=1)


def ids(df, c="id"):
    return sorted(r[c] for r in df.collect())


def test_sessions(spark):
    s = lambda i, ended, started=None, n=5, text="hi", done=None: (i, "p", text, started, ended, n, done)
    rows = [
        s(1, NOW - 3 * DAY), s(2, NOW - 3 * DAY - dt.timedelta(seconds=1)), s(3, None), s(4, NOW, n=2), s(5, NOW, n=None), s(6, NOW, text=" \n "), s(7, NOW, text=None), s(8, NOW, done=NOW), s(9, NOW, started=NOW - DAY),
    ]
    df = spark.createDataFrame(rows, SCHEMAS["memory_sessions"])
    picked = scans.pick_sessions(df, A.at())
    assert [r.id for r in picked.collect()] == [9, 1]
    assert {r.id: r.created_at for r in picked.collect()} == {9: NOW - DAY, 1: NOW - 3 * DAY}
    again = scans.pick_sessions(scans.mark_processed(df, picked, A.at()), A.at())
    assert again.collect() == []
    assert scans.build_signals(picked).first().signal_key == "session:9"


def items(spark, rows):
    """Rows of keyword dicts over a live default item."""
    base = {"id": 1, "content": "x" * 100, "source_type": "decision", "project": "p", "created_at": NOW, "updated_at": NOW, "embedding": None, "is_active": True, "archived": False, "superseded_by": None, "content_hash": "h", "metadata": "{}", "recall_count": 0, "last_recalled_at": None, "recall_boost": 1.0}
    names = schema("memory_items").names
    return spark.createDataFrame([tuple((base | r)[c] for c in names) for r in rows], SCHEMAS["memory_items"])


def test_liveness_and_backlogs(spark):
    df = items(spark, [{"id": 1}, {"id": 2, "archived": True}, {"id": 3, "superseded_by": 9}, {"id": 4, "is_active": None}, {"id": 5, "source_type": "summary"}, {"id": 6, "created_at": NOW - 30 * DAY}, {"id": 7, "content": "short"}])
    assert ids(df.where(scans.live())) == [1, 5, 6, 7]
    assert ids(df.where(scans.active())) == [1, 3, 5, 6, 7]
    swept = spark.createDataFrame([(1, "error", 2, 0)], "memory_id long, status string, attempts int, yields int")
    assert ids(scans.sweep_backlog(df, swept, A.at())) == [1, 3]
    done = spark.createDataFrame([(1, "error", 3, 0), (3, "done", 1, 0)], "memory_id long, status string, attempts int, yields int")
    assert ids(scans.sweep_backlog(df, done, A.at())) == []


def test_reinforcement_is_stable(spark):
    df = items(spark, [{"id": 1, "recall_count": 5, "last_recalled_at": NOW}, {"id": 2, "recall_boost": 1.5}, {"id": 3}, {"id": 4, "recall_count": 5, "last_recalled_at": NOW - 91 * DAY}])
    log = spark.createDataFrame([(1, True, NOW, 0.1, "x"), (1, False, NOW, 0.1, "x"), (3, True, NOW, 0.1, "x"), (None, True, NOW, 0.1, "x")], SCHEMAS["memory_recall_log"])
    out = jobs.reinforce_job(df, log, A.at())
    assert ids(out) == [1, 2]
    updated = ledger.apply_boosts(df, out)
    assert {r.id: round(r.recall_boost, 2) for r in updated.collect()}[2] == 1.25 and updated.count() == 4


def test_gates(spark):
    long = "y" * 4001
    rows = [(1, " Web-One ", "p", "ok"), (2, "desktop", "p", "ok"), (3, "web-one", "", long), (4, "web-one", "x" * 129, "<private>all</private>"), (5, "web-one", "p", "  "), (6, "web-one", "p", "fine"), (7, None, None, None)]
    df = spark.createDataFrame([(i, NOW, a, h, t, "pending", None, None, "{}", None, 0) for i, a, h, t in rows], SCHEMAS["memory_inbox"])
    out = {r.id: r for r in gates.gate_rows(scans.claim_batch(df, A.at()), ("web-one",)).collect()}
    assert {i: r.reason for i, r in out.items()} == {1: None, 2: "invalid-source-agent", 3: "oversize", 4: None, 5: "oversize", 6: None, 7: "oversize"}
    assert (out[3].project, out[4].project, out[4].content, out[3].check, out[5].check) == ("global", "global", "[redacted]", "text-over-4000", "empty-after-redaction")
    got = {r.id: (r.outcome, r.reason) for r in jobs.promote_job(df, items(spark, []), A.at(), jobs.PromoteOptions(cap=2, agents=("web-one",))).collect()}
    assert [got[i] for i in (1, 4, 6)] == [("promoted", None), ("promoted", None), ("deferred", None)]
    bands = spark.createDataFrame([(0.96,), (0.95,), (0.88,), (0.879,)], "s double").select(gates.duplicate_verdict(F.col("s")).alias("v")).collect()
    assert [r.v for r in bands] == ["duplicate", "near-duplicate", "near-duplicate", None]


def test_promotion_compares_within_the_project(spark):
    e = [1.0, 0.0]
    pool = items(spark, [{"id": 100, "project": "p", "embedding": e}, {"id": 101, "project": "q", "embedding": [0.0, 1.0]}])
    df = spark.createDataFrame([(i, NOW, "web-one", h, "text", "pending", None, None, "{}", None, 0) for i, h in ((1, "p"), (2, "q"))], SCHEMAS["memory_inbox"])
    out = jobs.promote_job(df, pool, A.at(), jobs.PromoteOptions(agents=("web-one",)), embed=lambda d: d.withColumn("embedding", F.array(F.lit(1.0), F.lit(0.0))))
    assert {r.id: r.reason for r in out.collect()} == {1: "duplicate", 2: None}


def promoted(spark, rows, pool, classify=None):
    df = spark.createDataFrame([(i, NOW + k * DAY, "web-one", h, "text", "pending", None, None, "{}", None, 0) for k, (i, h, _) in enumerate(rows)], SCHEMAS["memory_inbox"])
    e = spark.createDataFrame([(i, v) for i, _, v in rows], "id long, embedding array<double>")
    out = jobs.promote_job(df, pool, A.at(), jobs.PromoteOptions(agents=("web-one",)), embed=lambda d: d.join(e, "id"), classify=classify)
    return {r.id: r.reason or r.error for r in out.collect()}


def test_promotion_finds_a_duplicate_behind_other_projects(spark):
    pool = items(spark, [{"id": k, "project": "q", "embedding": [1.0, 0.0]} for k in range(60)] + [{"id": 99, "project": "p", "embedding": [1.0, 0.1]}, {"id": 98, "project": None, "embedding": [0.0, 1.0]}])
    assert promoted(spark, [(1, "p", [1.0, 0.0]), (2, "q", [0.0, 1.0]), (3, "p", [0.0, 1.0])], pool) == {1: "duplicate", 2: None, 3: None}


def test_promotion_compares_a_batch_with_itself(spark):
    at = lambda degrees: [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]
    pool = items(spark, [{"id": 99, "project": "z", "embedding": at(0)}])
    # cos 20 is 0.94: 5 is near 9, which is promoted; 2 is near 5 only, which is not
    rows = [(9, "p", at(0)), (5, "p", at(20)), (2, "p", at(40)), (1, "p", at(0)), (3, "q", at(0)), (4, "q", None), (6, "q", None)]
    assert promoted(spark, rows, pool) == {9: None, 5: "near-duplicate", 2: None, 1: "duplicate", 3: None, 4: "embedding-unavailable", 6: "embedding-unavailable"}
    levels = lambda d: d.select("id", F.when(F.col("id") == 9, "street").otherwise("kitchen").alias("level"))
    assert promoted(spark, rows[:4], pool, levels) == {9: "verdict-unreadable", 5: None, 2: "near-duplicate", 1: "near-duplicate"}


def test_edge_upsert_outcomes(spark):
    old = spark.createDataFrame([(1, 2, "relates_to", 0.9, NOW - DAY, "m"), (1, 3, "relates_to", None, NOW, "m"), (1, 4, "relates_to", 0.9, NOW - 8 * DAY, "m"), (1, 5, "other", 0.9, NOW, "m")], "source_id long, target_id long, relationship_type string, weight double, inferred_at timestamp, inferred_by string")
    pairs = spark.createDataFrame([(1, k, 0.95) for k in (2, 3, 4, 5)], "source_id long, target_id long, similarity double")
    table, outcome = ledger.upsert_edges(old, pairs, A.at())
    assert {r.target_id: r.outcome for r in outcome.collect()} == {2: "skipped", 3: "refreshed", 4: "refreshed", 5: "inserted"}
    assert table.count() == 5
    _, second = ledger.upsert_edges(table, pairs, A.at())
    assert {r.outcome for r in second.collect()} == {"skipped"}


def test_nearest_neighbours_like_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(70, 8))
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)] + [(99, None)], "id long, embedding array<double>")
    got = {(r.id, r["rank"]): r.neighbour for r in vectors.nearest_neighbours(df, df, 3, side=16).collect()}
    u = v / np.linalg.norm(v, axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -9)
    assert got == {(i, k + 1): int(j) for i in range(70) for k, j in enumerate(np.argsort(-s[i])[:3])}


def test_splitting():
    v = {k: np.array([1.0, 0.02 * k]) for k in range(3)} | {k: np.array([0.02 * (k - 3), 1.0]) for k in range(3, 6)}
    edges = [(0, 1, 0.99), (1, 2, 0.99), (2, 3, 0.1), (3, 4, 0.99), (4, 5, 0.99)]
    assert sorted(vectors.split_incoherent(list(range(6)), edges, v)) == [[0, 1, 2], [3, 4, 5]]
    assert vectors.split_incoherent([0, 1], edges, v) == []
    assert vectors.split_incoherent([0, 3, 5], [], v) == []
    assert vectors.combined_centroid([1.0, 0.0], 1, [[0.0, 1.0]]) == pytest.approx([0.5**0.5] * 2)


def cut_one_by_one(members, edges, v, threshold, least=3):
    """The plain form: each cut removes the weakest inner edge and looks for the parts anew."""
    rest, waiting, accepted = sorted(edges, key=lambda e: -1.0 if e[2] is None else e[2]), [list(members)], []
    while waiting:
        part = waiting.pop(0)
        if len(part) < least:
            continue
        u = np.array([v[i] / max(np.linalg.norm(v[i]), 1e-300) for i in part])
        if ((u.sum(axis=0) ** 2).sum() - (u**2).sum()) / (len(part) * (len(part) - 1)) >= threshold:
            accepted.append(part)
            continue
        weakest = next((e for e in rest if e[0] in part and e[1] in part), None)
        if weakest is None:
            continue
        rest.remove(weakest)
        left = set(part)
        while left:
            group = {left.pop()}
            while more := {x for a, b, _ in rest for x, y in ((a, b), (b, a)) if y in group and x in left}:
                group |= more
                left -= more
            waiting.append([i for i in part if i in group])
    return accepted


def test_splitting_like_cutting_one_by_one():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(3, 14))
        v = {k: rng.normal(size=2) * (rng.random() > 0.05) for k in range(n)}
        edges = [(int(a), int(b), None if w > 0.9 else round(w, 1)) for a, b, w in zip(rng.integers(0, n, 2 * n), rng.integers(0, n, 2 * n), rng.random(2 * n))][: int(rng.integers(0, 2 * n))]
        for threshold in (0.1, 0.6):
            assert sorted(vectors.split_incoherent(list(range(n)), edges, v, threshold)) == sorted(cut_one_by_one(list(range(n)), edges, v, threshold))


def test_components_above_the_bound_are_judged_too(spark):
    rows = [(0, k, [1.0, 0.01 * k]) for k in range(6)] + [(10, 10 + k, [1.0, 0.0] if k < 3 else [0.0, 1.0]) for k in range(6)] + [(20, 20 + k, [1.0, 1.0]) for k in range(3)]
    m = spark.createDataFrame(rows, "component long, id long, embedding array<double>")
    e = [(c, a, a + 1, 0.1 if a == 12 else 0.9) for c, a, b in ((c, a, b) for c, a, _ in rows for b in [a + 1]) if (c, a + 1) in {(x, y) for x, y, _ in rows}]
    e = spark.createDataFrame(e, "component long, source_id long, target_id long, weight double")
    want = [(0, 0, k) for k in range(6)] + [(10, 10, k) for k in (10, 11, 12)] + [(10, 13, k) for k in (13, 14, 15)] + [(20, 20, k) for k in (20, 21, 22)]
    for largest in (4, 20_000):
        assert sorted(tuple(r) for r in vectors.split_components(m, e, largest=largest).collect()) == want


def test_qualification_by_days(spark):
    for days, n in ((20, 0), (21, 1)):
        df = items(spark, [{"id": k, "embedding": [1.0, 0.01 * k], "created_at": NOW - (k % 2) * days * DAY} for k in (1, 2, 3)])
        edges = spark.createDataFrame([(1, 2, "relates_to", 0.9), (2, 3, "relates_to", 0.9)], "source_id long, target_id long, relationship_type string, weight double")
        registry = spark.createDataFrame([(7, [1.0, 0.02])], "id long, centroid array<double>")
        out = jobs.cluster_job(df, edges, registry).collect()
        assert len(out) == n
        if n:
            assert (out[0].action, out[0].registry_id, out[0].members) == ("reinforce", 7, [1, 2, 3])


def test_communities_and_summaries(spark):
    e = spark.createDataFrame([(k, k + 1, "relates_to", 0.9) for k in range(1, 5)] + [(10, 11, "relates_to", 0.9)], "source_id long, target_id long, relationship_type string, weight double")
    assert {r.community_key: (r.n, r.verdict) for r in jobs.communities(e).collect()} == {1: (5, "qualifying"), 10: (2, "too_small")}
    df = items(spark, [{"id": k} for k in (*range(1, 6), 10, 11)])
    old = lambda m, owned: spark.createDataFrame([(1, m, owned)], "community_key long, members array<long>, owned boolean")
    act = lambda o: jobs.consolidate_job(df, e, o, A.at()).first().action
    assert [act(old([1], True)), act(old([5, 4, 3, 2, 1], True)), act(old([1], False)), act(old([1], True).limit(0))] == ["update", "unchanged", "foreign", "insert"]


def test_drift_has_three_values(spark):
    goals = spark.createDataFrame([(1, "a", "active"), (2, "b", "active"), (None, "c", "active"), (4, "d", "active")], "id long, project string, status string")
    df = items(spark, [{"id": k, "project": p} for p, r in (("a", range(25)), ("b", range(100, 130)), ("d", range(200, 205))) for k in r])
    links = spark.createDataFrame([(0, 1)], "memory_id long, objective_id long")
    got = {r.project: r.drift for r in aggregates.coverage(df, goals, links, A.at()).collect()}
    assert got == {"a": False, "b": True, "c": None, "d": False}
    assert {r.drift for r in aggregates.coverage(df, goals, links, A.at(), linkage=False).collect()} == {None}


def test_near_copies_count_once(spark):
    a = " ".join(f"w{k}" for k in range(20))
    rows = [("s", 1, a), ("s", 2, a.upper()), ("s", 3, a + " extra"), ("s", 4, "else"), ("t", 1, "one")]
    got = {r.key: (r.n, r["distinct"]) for r in aggregates.distinct_clusters(spark.createDataFrame(rows, "k string, id long, content string"), "k").collect()}
    assert got == {"s": (4, 2), "t": (1, 1)}


def test_fusion(spark):
    t = spark.createDataFrame([("s", 1, 1), ("s", 2, 2)], "signal_key string, id long, rank int")
    v = spark.createDataFrame([("s", 2, 1), ("s", 3, 2)], "signal_key string, id long, rank int")
    got = {r.id: r.similarity for r in search.fused(t, v).collect()}
    assert got == pytest.approx({1: 0.4 / 61, 2: 0.4 / 62 + 0.6 / 61, 3: 0.6 / 62})
    assert {r.id: r.similarity for r in search.fused(t, None).collect()} == pytest.approx({1: 1 / 61, 2: 1 / 62})
    s = spark.createDataFrame([("", "x"), ("big cat", "a BIG dog"), ("cat big", "x big"), ("a", "b")], "q string, c string")
    assert [r.v for r in s.select(search.keyword_score(F.col("q"), F.col("c")).alias("v")).collect()] == [0.80, 0.92, 0.75, 0.75]


def test_signals_without_vectors_have_the_lexical_weight(spark):
    t = spark.createDataFrame([("s", 1, 1), ("u", 1, 1)], "signal_key string, id long, rank int")
    v = spark.createDataFrame([("s", 2, 1)], "signal_key string, id long, rank int")
    assert {(r.signal_key, r.id): r.similarity for r in search.fused(t, v).collect()} == pytest.approx({("s", 1): 0.4 / 61, ("s", 2): 0.6 / 61, ("u", 1): 1 / 61})


def test_insights_use_both_branches(spark):
    sessions = spark.createDataFrame([(7, "p", "alpha beta", NOW, NOW, 5, None), (8, "p", "alpha", NOW, NOW, 5, None)], SCHEMAS["memory_sessions"])
    df = items(spark, [{"id": 1, "content": "alpha beta", "embedding": [0.0, 1.0]}, {"id": 2, "content": "no shared word", "embedding": [1.0, 0.0]}, {"id": 3, "content": "neither"}])
    e = spark.createDataFrame([(7, [1.0, 0.1])], "session_id long, embedding array<double>")
    options = jobs.InsightOptions(min_similarity=0.0)
    found = lambda **more: {r.signal_key: r.source_ids for r in jobs.insight_job(sessions, df, A.at(), options, **more).collect()}
    assert found() == {"session:7": [1], "session:8": [1]}
    assert found(embeddings=e) == {"session:7": [1, 2], "session:8": [1]}


def test_schema_alignment_and_checks(spark):
    df = align(spark.createDataFrame([(1, "text")], "id int, content string"), "memory_items")
    assert df.schema == schema("memory_items") and df.first().is_active is None
    bad = ledger.violations(spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "id long, s string"), {"is_a": F.col("s") == "a"}, ["id"])
    assert sorted((r.id, r.violation) for r in bad.collect()) == [(1, "is_a"), (1, "unique"), (1, "unique")]
    row = ledger.job_row(spark.createDataFrame([("x",), ("x",), ("y",)], "outcome string"), "promote", "r1", A.at()).first()
    assert row.counters == {"x": 2, "y": 1}


def test_guard_is_dark_by_default(spark):
    goals = spark.createDataFrame([(1, "a", None, "t", "active", None, None, None)], SCHEMAS["memory_objectives"])
    flags = spark.createDataFrame([], SCHEMAS["objective_flags"])
    links = spark.createDataFrame([], "memory_id long, objective_id long")
    assert jobs.guard_job(items(spark, []), goals, links, flags, A.at()) == {}
    assert set(jobs.guard_job(items(spark, []), goals, links, flags, A.at(), enabled=True)) == {"coverage", "staleness"}
