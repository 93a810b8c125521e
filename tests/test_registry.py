"""Groups go to the registry as if they came one after another."""

import datetime as dt
import json
import time

import numpy as np
from pyspark.sql import functions as F

from quillspark.operators import writes
from quillspark.operators.registry import registry_matches
from quillspark.plans import jobs
from quillspark.sources import adapters as A
from quillspark.sources.tables import SCHEMAS

NOW = dt.datetime(2024, 1, 31)
GROUPS = "id long, position long, member_ids array<long>, member_hashes array<string>, projects array<string>, n long, total array<double>"


def unit(v):
    return np.asarray(v, float) / np.linalg.norm(v)


def one_by_one(groups, registry, least=0.9):
    entries = {i: (unit(c), k) for i, c, k in registry}
    first = max(entries, default=-1) + 1
    out = {}
    for i, _, n, total in sorted(groups, key=lambda g: (g[1], g[0])):
        near = max(((float(c @ unit(total)), -e) for e, (c, _) in entries.items()), default=(-1, 0))
        if near[0] >= least:
            c, k = entries[-near[1]]
            entries[-near[1]] = (unit((c * k + np.array(total)) / (k + n)), k + 1)
            out[i] = ("reinforce", -near[1])
        else:
            entries[first + i] = (unit(total), 1)
            out[i] = ("insert", first + i)
    return out, entries


def test_matches_like_one_by_one(spark):
    rng = np.random.default_rng(7)
    for trial in range(2):
        vector = lambda: (np.eye(3)[rng.integers(3)] * 1.4 + rng.normal(size=3) * 0.45)
        registry = [(k, vector().tolist(), int(rng.integers(1, 5))) for k in range(5 * trial)]
        groups = [(int(i), int(rng.integers(0, 20)), 3, (3 * vector()).tolist()) for i in rng.permutation(40)]
        df = spark.createDataFrame([(i, p, [i], ["h"], [], n, t) for i, p, n, t in groups], GROUPS)
        reg = spark.createDataFrame([(i, unit(c).tolist(), [1000 + i], ["x"], ["q"], k, "candidate", None, None) for i, c, k in registry], SCHEMAS["doctrine_registry"])
        want, entries = one_by_one(groups, registry)
        actions = registry_matches(df, reg)
        assert {r.id: (r.action, r.registry_id) for r in actions.collect()} == want
        after = {r.id: r for r in writes.registry_writes(reg, df, actions, A.at()).collect()}
        assert after.keys() == entries.keys()
        for i, (c, k) in entries.items():
            assert np.allclose(after[i].centroid, c) and after[i].occurrence_count == k
            assert sorted(after[i].member_ids) == sorted([g for g, (_, e) in want.items() if e == i] + [1000 + i] * (i in dict((r[0], 1) for r in registry)))


def test_entries_without_centroid_and_no_groups(spark):
    df = spark.createDataFrame([(0, 0, [1], ["h"], ["p"], 1, [1.0, 0.0]), (1, 0, [2], ["h"], ["p"], 1, [0.0, 0.0])], GROUPS)
    reg = spark.createDataFrame([(4, None, [9], ["x"], ["q"], 1, "candidate", None, None)], SCHEMAS["doctrine_registry"])
    assert {(r.id, r.action, r.registry_id) for r in registry_matches(df, reg).collect()} == {(0, "insert", 5), (1, "insert", 6)}
    none = df.where("false")
    out = writes.registry_writes(reg, none, registry_matches(none, reg), A.at()).collect()
    assert [(r.id, r.member_ids, r.grew) for r in out] == [(4, [9], False)]


def test_a_large_entry_is_quick(spark):
    n = 20_000
    ids = list(range(n))
    df = spark.createDataFrame([(0, 0, ids, ["h"] * n, ["p"], n, [1.0, 0.0])], GROUPS)
    reg = spark.createDataFrame([(4, [1.0, 0.0], ids[:: 2], ["h"] * (n // 2), ["q"], 1, "candidate", None, None)], SCHEMAS["doctrine_registry"])
    actions = spark.createDataFrame([(0, "reinforce", 4)], "id long, action string, registry_id long")
    began = time.time()
    row = writes.registry_writes(reg, df, actions, A.at()).first()
    assert (len(row.member_ids), row.grew, row.drifted) == (n, True, False) and time.time() - began < 40  # it took 85 s when members were looked up in arrays


def test_a_scan_with_verdicts(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    day = lambda k: NOW - dt.timedelta(days=30 * (k % 2))
    rows = [(k, "p", day(k), f"h{k}", (a if k < 6 else b)) for k in range(12)]
    items = spark.createDataFrame(rows, "id long, project string, created_at timestamp, content_hash string, embedding array<double>").withColumns({"is_active": F.lit(True), "archived": F.lit(False), "superseded_by": F.lit(None).cast("long"), "source_type": F.lit("decision")})
    edges = spark.createDataFrame([(k, k + 1, "relates_to", 0.9) for k in range(11) if k != 5], "source_id long, target_id long, relationship_type string, weight double")
    registry = spark.createDataFrame([(3, b, [6], ["old"], ["q"], 2, "drafted", "text", NOW - dt.timedelta(days=60))], SCHEMAS["doctrine_registry"])
    clusters = jobs.cluster_job(items, edges, registry)
    asked = []

    def judge(due):
        got = due.collect()
        asked.append(sorted(r.id for r in got))
        say = lambda r: json.dumps({"coherent": False, "groups": [[str(m) for m in r.members[:3]], [str(m) for m in r.members[3:]]]}) if r.members[0] < 6 else json.dumps({"coherent": True, "verdict": "kitchen", "title": "T", "doctrine_text": "D"})
        return spark.createDataFrame([(r.id, say(r)) for r in got], "id long, reply string")

    after, judged = jobs.registry_job(items, clusters, registry, A.at(), judge)
    got = {r.id: r for r in after.collect()}
    assert (got[3].status, got[3].title, got[3].occurrence_count, got[3].synthesized_at) == ("drafted", "T", 3, NOW)
    # the other group makes entry 4, is split, and its two parts, alike, are taken into it again; the entry stays refused
    assert asked[0] == [3, 4] and (got[4].status, got[4].rejection_reason, got[4].occurrence_count) == ("rejected", "split-into-subclusters", 3)
    quiet, none = jobs.registry_job(items, clusters, registry, A.at())
    assert {r.id: (r.status, r.synthesized_at is None) for r in quiet.collect()} == {3: ("drafted", False), 4: ("candidate", True)} and none.count() == 0
