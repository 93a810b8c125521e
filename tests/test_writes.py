"""Snapshots that promotions, the registry and linkage leave behind, and the functions they rest on."""

import datetime as dt
import json

import numpy as np
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.functions import vectors as V
from quillspark.operators import aggregates, scans, writes
from quillspark.plans import jobs
from quillspark.sources import adapters as A
from quillspark.sources.tables import SCHEMAS

NOW = dt.datetime(2024, 1, 31)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def poly(text):
    h = 0
    units = text.encode("utf-16-le")
    for k in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[k : k + 2], "little")) & 0xFFFFFFFF
    h -= (h >> 31) << 32
    return "fallback:" + ("-" if h < 0 else "") + format(abs(h), "x")


def test_hashes_and_keys(spark):
    for t in ("", "a", "hello world, a longer text", "é漢字", "x😀y"):
        assert one(spark, T.poly31(F.lit(t))) == poly(t)
    assert one(spark, T.objective_key(F.lit(7), F.lit("p"), F.lit("t"))) == "7"
    keys = [one(spark, T.objective_key(F.lit(None).cast("long"), F.lit(p), F.lit("t"))) for p in ("p", "q")]
    assert keys[0] != keys[1] and keys[0].startswith("text:")


def test_json_and_times(spark):
    merged = one(spark, T.json_merged(F.lit('{"a":1,"b":{"c":[1,2]},"s":"x"}'), F.lit('{"a":{"z":null},"n":"y"}')))
    assert json.loads(merged) == {"a": {"z": None}, "b": {"c": [1, 2]}, "s": "x", "n": "y"}
    for broken in (None, "", "[1]", "no json"):
        assert json.loads(one(spark, T.json_merged(F.lit(broken).cast("string"), F.lit('{"a":1}')))) == {"a": 1}
    assert json.loads(one(spark, T.json_without(F.lit('{"a":1,"b":2}'), "a"))) == {"b": 2}
    assert one(spark, T.epoch_ms(F.lit("2024-01-31T00:00:00Z"))) == 1706659200000
    assert one(spark, T.epoch_ms(F.lit("not a time"))) is None


def test_vector_literals(spark):
    assert one(spark, V.parsed_vector(F.lit("[1, -2.5,3e-2]"))) == [1.0, -2.5, 0.03]
    assert one(spark, V.parsed_vector(F.lit("[1,x]"))) is None and one(spark, V.parsed_vector(F.lit("[]"))) == []
    assert one(spark, V.parsed_vector(V.vector_literal(F.array(F.lit(1.5), F.lit(2.0))))) == [1.5, 2.0]


def test_promotion_snapshots(spark):
    row = lambda i, status="pending", attempts=0, metadata='{"client":"c","engine":{"old":1}}': (i, NOW, "web-one", "p", "text", status, None, None, metadata, None, attempts)
    inbox = spark.createDataFrame([row(0), row(1), row(2, "rejected"), row(3, attempts=4), row(4, attempts=None), row(5), row(6, metadata=None)], SCHEMAS["memory_inbox"])
    items = spark.createDataFrame([], SCHEMAS["memory_items"])
    decided = [(0, "promoted", None), (1, "rejected", "duplicate"), (2, "promoted", None), (3, "promoted", None), (4, "promoted", None), (5, "deferred", None), (6, "promoted", None)]
    out = spark.createDataFrame([(i, "web-one", "p", o, r, None, "body") for i, o, r in decided], "id long, agent string, project string, outcome string, reason string, check string, content string")
    failures = spark.createDataFrame([(3, "e" * 600), (4, "e")], "id long, error string")
    new, after, lost = writes.promotion_writes(inbox, items, out, A.at(), "r", failures)
    after = {r.id: r for r in after.collect()}
    assert {i: r.status for i, r in after.items()} == {0: "promoted", 1: "rejected", 2: "rejected", 3: "rejected", 4: "pending", 5: "pending", 6: "promoted"}
    assert {i: r.rejection_reason for i, r in after.items() if r.rejection_reason} == {1: "duplicate", 3: "attempts-exhausted"}
    assert (after[3].attempts, after[4].attempts, after[5].attempts) == (5, 1, 0)
    assert len(json.loads(after[3].metadata)["engine"]["last_error"]) == 500
    assert json.loads(after[0].metadata) == {"client": "c", "engine": {"old": 1, "promoted_at": "2024-01-31T00:00:00Z", "run_id": "r"}}
    assert after[5].metadata == row(5)[8] and [tuple(r) for r in lost.collect()] == [(2, "promoted", "rejected")]
    new = {r.id: r for r in new.collect()}
    assert set(new) == {after[0].promoted_memory_id, after[6].promoted_memory_id} and len(new) == 2
    assert json.loads(new[after[0].promoted_memory_id].metadata)["proposal_metadata"] == {"client": "c"}
    empty = writes.promotion_writes(inbox.where("false"), items, out, A.at(), "r")
    assert [d.count() for d in empty] == [0, 0, 0]


def test_registry_snapshots(spark):
    registry = spark.createDataFrame([(5, [1.0, 0.0], [1, 2], ["a", "b"], ["p"], 3, "ratified", "t", None), (6, [0.0, 1.0], [9], ["z"], ["q"], 1, "candidate", None, None)], SCHEMAS["doctrine_registry"])
    groups = spark.createDataFrame([(0, [2, 3], ["B", "c"], ["q"], 2, [1.0, 1.0]), (1, [3], ["C"], ["p"], 1, [0.0, 2.0]), (2, [8], ["h"], [], 1, [3.0, 4.0])], "id long, member_ids array<long>, member_hashes array<string>, projects array<string>, n long, total array<double>")
    actions = spark.createDataFrame([(0, "reinforce", 5), (1, "reinforce", 5), (2, "insert", None)], "id long, action string, registry_id long")
    rows = {r.id: r for r in writes.registry_writes(registry, groups, actions, A.at()).collect()}
    unit = lambda v: v / np.linalg.norm(v)
    c = unit((np.array([1.0, 0.0]) * 3 + [1, 1]) / 5)
    assert np.allclose(rows[5].centroid, unit((c * 4 + [0, 2]) / 5))
    assert (rows[5].member_ids, rows[5].member_hashes, rows[5].projects) == ([1, 2, 3], ["a", "B", "C"], ["p", "q"])
    assert (rows[5].occurrence_count, rows[5].reinforced_after_ratification, rows[5].grew, rows[5].drifted) == (5, 2, True, True)
    assert (rows[6].occurrence_count, rows[6].grew, rows[6].updated_at) == (1, False, None)
    assert rows[9].centroid == [0.6, 0.8] and rows[9].status == "candidate" and rows[9].grew

    shape = "id long, verdict string, title string, doctrine_text string, evidence array<struct<date:string,gist:string>>, trigger_hints array<string>"
    verdicts = spark.createDataFrame([(5, "recipe", None, None, None, None), (6, "kitchen", "T", "D", [], ["h"])], shape)
    rows = {r.id: r for r in writes.registry_verdicts(registry, verdicts, A.at()).collect()}
    assert (rows[5].status, rows[5].rejection_reason, rows[5].synthesized_at) == ("ratified", None, None)
    assert (rows[6].status, rows[6].title, rows[6].doctrine_text, rows[6].synthesized_at) == ("drafted", "T", "D", NOW)
    rows = {r.id: r for r in writes.registry_verdicts(registry, spark.createDataFrame([(6, None, None, None, None, None)], shape), A.at()).collect()}
    assert (rows[6].status, rows[6].rejection_reason) == ("rejected", "llm-verdict-unparseable")


def test_linkage_variants(spark):
    items = spark.createDataFrame([(1, '{"objectives":["20","x"]}'), (2, None), (3, '{"objectives":5}')], "id long, metadata string")
    edges = spark.createDataFrame([(2, 20), (21, 3), (1, 99), (7, 20)], "source_id long, target_id long")
    goals = spark.createDataFrame([(20,), (21,), (None,)], "id long")
    got = lambda s: sorted(tuple(r) for r in aggregates.linkage(items, edges, goals, s).collect())
    assert got("edges") == [(2, 20), (3, 21)] and got("metadata") == [(1, 20)]
    assert got("both") == [(1, 20), (2, 20), (3, 21)] and got("none") == []


def test_identifiers():
    assert scans.safe_identifier(" links ", "d") == "links"
    assert {scans.safe_identifier(n, "d") for n in (None, "", "Links", "a;drop", "1a", "a" * 64, "a\n")} == {"d", "a"}


def test_guard_snapshots(spark):
    backlog = spark.createDataFrame([(i, "p", "h2") for i in (1, 2, 3, 4)], "id long, project string, objectives_hash string")
    goals = spark.createDataFrame([(10, "p", "active"), (11, "p", "superseded"), (12, "q", "active")], "id long, project string, status string")
    say = lambda *ids: json.dumps({"contradictions": [{"objective_id": str(i), "severity": "low", "rationale": "r"} for i in ids]})
    replies = spark.createDataFrame([(1, say(10, 10, 11, 12, 99)), (2, "?"), (3, say(10)), (9, say(10))], "memory_id long, reply string")
    flags = spark.createDataFrame([("contradiction:3:10",)], "dedup_key string")
    scanned = spark.createDataFrame([(2, None, "error", 1, 0, "h1", "x"), (4, None, "ok", 1, 0, "h1", None)], SCHEMAS["objective_scan"])
    new, after = writes.guard_writes(backlog, replies, goals, flags, scanned, A.at())
    assert [(r.memory_id, r.objective_id, r.severity, r.dedup_key) for r in new.collect()] == [(1, 10, "low", "contradiction:1:10")]
    assert {r.memory_id: (r.status, r.attempts, r.flags_written, r.objectives_hash, r.error is None) for r in after.collect()} == {
        1: ("ok", 1, 1, "h2", True), 2: ("ok", 2, 0, "h2", True), 3: ("ok", 1, 0, "h2", True), 4: ("ok", 1, 0, "h1", True)}
    called = replies.withColumn("error", F.when(F.col("memory_id") == 1, "timeout"))
    new, after = writes.guard_writes(backlog, called, goals, flags, scanned, A.at())
    assert new.count() == 0 and {r.memory_id: (r.status, r.attempts, r.error) for r in after.collect()}[1] == ("error", 1, "timeout")


def test_coverage_rows(spark):
    report = spark.createDataFrame([("p", 2, 30, 0, 0.0, True, "n")], "project string, objective_count long, writes long, linked_writes long, coverage_ratio double, drift boolean, note string")
    row = writes.coverage_rows(report, "r", A.at(), linkage_source="edges").first()
    assert (row.run_id, row.window_start, row.window_end, row.linkage_source, row.drift) == ("r", NOW - dt.timedelta(days=30), NOW, "edges", True)


def test_the_guard_is_one_job(spark):
    goals = spark.createDataFrame([(10, "p", 1, "ship weekly", "active", None), (None, "p", 2, "no new services", "active", None), (11, "q", 1, "x", "active", None)], "id long, project string, rank int, content string, status string, ratified_at timestamp")
    rows = [(k, "w" * 60 if k < 9 else "short", "decision", p, NOW - dt.timedelta(days=1), True, False, None) for k, p in ((1, "p"), (2, "p"), (3, "q"), (4, "z"), (9, "p"))]
    items = spark.createDataFrame(rows, "id long, content string, source_type string, project string, created_at timestamp, is_active boolean, archived boolean, superseded_by long")
    links, flags, scanned = (spark.createDataFrame([], s) for s in ("memory_id long, objective_id long", SCHEMAS["objective_flags"], SCHEMAS["objective_scan"]))
    asked = []

    def judge(backlog):
        got = backlog.collect()
        asked.extend(got)
        text = next(o.objective_key for r in got if r.project == "p" for o in r.objectives if o.objective_key != "10")
        say = json.dumps({"contradictions": [{"objective_id": text, "severity": "high", "rationale": "adds one"}, {"objective_id": "11", "rationale": "not shown"}]})
        return spark.createDataFrame([(r.memory_id, say if r.memory_id == 1 else "?", "timeout" if r.memory_id == 3 else None) for r in got], "memory_id long, reply string, error string")

    out = jobs.guard_job(items, goals, links, flags, A.at(), judge, scanned, enabled=True, run_id="r7")
    assert sorted(r.memory_id for r in asked) == [1, 2, 3] and {len(r.objectives) for r in asked if r.project == "p"} == {2}
    new = out["contradictions"].collect()
    assert [(r.memory_id, r.objective_id, r.severity) for r in new] == [(1, None, "high")] and new[0].dedup_key.startswith("contradiction:1:text:")
    assert {r.memory_id: (r.status, r.flags_written, r.attempts) for r in out["scanned"].collect()} == {1: ("ok", 1, 1), 2: ("ok", 0, 1), 3: ("error", 0, 1)}
    assert {(r.run_id, r.project) for r in out["coverage"].collect()} == {("r7", "p"), ("r7", "q")}
    # judged items come again only where their project's objectives change, or after a failed call
    again = []
    jobs.guard_job(items, goals.where("rank = 1"), links, flags, A.at(), lambda b: again.extend(b.collect()) or spark.createDataFrame([], "memory_id long, reply string"), out["scanned"], enabled=True)
    assert sorted(r.memory_id for r in again) == [1, 2, 3]
    again.clear()
    jobs.guard_job(items, goals, links, flags, A.at(), lambda b: again.extend(b.collect()) or spark.createDataFrame([], "memory_id long, reply string"), out["scanned"], enabled=True)
    assert sorted(r.memory_id for r in again) == [3]
