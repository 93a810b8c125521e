"""Summaries of communities: asked for only where members changed, and never written over what isn't owned."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quillspark.operators import summaries
from quillspark.plans import jobs
from quillspark.sources import adapters as A

NOW = dt.datetime(2024, 1, 31)
ITEM = "id long, content string, source_type string, project string, created_at timestamp, updated_at timestamp, is_active boolean, archived boolean, superseded_by long, content_hash string, metadata string, embedding array<double>, extra int"


def item(i, source_type="fact", project="p", metadata=None, live=True, content=None, embedding=None):
    return (i, content or f"text {i}", source_type, project, NOW - dt.timedelta(days=i % 9), NOW, live, False, None, "h", metadata, embedding, 7)


def note(key, members, **more):
    return json.dumps({"consolidation": {"kind": "community_summary", "community_key": key, "member_ids": members}, **more})


def run(spark, held, communities, least=4, max_calls=40, reply="s", live=lambda i: True):
    rows = [item(i, live=live(i), project="pq"[i >= 20]) for i in range(1, 25)] + held
    df = spark.createDataFrame(rows, ITEM)
    asked = []

    def ask(p):
        got = p.collect()
        asked.extend(got)
        return spark.createDataFrame([(r.community_key, f" {reply}{r.community_key} ".strip() and f" {reply}{r.community_key} " if reply else "") for r in got], "community_key long, reply string")

    after, done = summaries.summarize(df, spark.createDataFrame([(k, len(m), m) for k, m in communities], "community_key long, n long, members array<long>"), A.at(), ask, least, max_calls)
    return {r.id: r for r in after.collect()}, {r.community_key: (r.action, r.summary_id) for r in done.collect()}, asked


def test_every_kind_of_community(spark):
    groups = [(1, [1, 2, 3, 4]), (5, [5, 6, 7, 8]), (9, [9, 10, 11, 12]), (13, [13, 14, 15, 16, 17]), (18, [18, 19, 20, 21])]
    held = [
        item(100, "summary", metadata=note(1, [4, 3, 2, 1]), content="same"), item(101, "summary", "x", note(5, [5, 6], other=1), content="stale", embedding=[1.0]),
        item(102, "decision", metadata=note(9, [9]), content="not ours"), item(103, "summary", metadata='{"consolidation":{"kind":"other","community_key":13}}'), item(104, "summary", metadata="no json"),
    ]
    after, done, asked = run(spark, held, groups)
    assert done == {1: ("unchanged", 100), 5: ("update", 101), 9: ("foreign", 102), 13: ("insert", 104 + 1 + 13), 18: ("insert", 104 + 1 + 18)}
    assert sorted(r.community_key for r in asked) == [5, 13, 18]  # nothing is asked where nothing changed or nothing may be written
    assert (after[100].content, after[102].content, after[104].metadata) == ("same", "not ours", "no json")
    got = json.loads(after[101].metadata)
    assert (after[101].content, after[101].project, after[101].embedding, after[101].extra) == ("s5", "p", [1.0], 7) and got["other"] == 1
    assert got["consolidation"] | {"generated_at": 0} == {"kind": "community_summary", "version": 1, "community_key": 5, "member_ids": [5, 6, 7, 8], "member_count": 4, "generated_at": 0}
    new = after[118]
    assert (new.content, new.source_type, new.project, new.extra) == ("s13", "summary", "p", None) and after[123].project == "global"
    again = summaries.existing_summaries(spark.createDataFrame(list(after.values()), ITEM)).collect()
    assert {(r.community_key, r.summary_id, r.owned) for r in again} >= {(13, 118, True), (9, 102, False)}


def test_a_second_run_asks_nothing(spark):
    groups = [(1, [1, 2, 3, 4]), (5, [5, 6, 7, 8])]
    after, _, asked = run(spark, [], groups)
    kept = [tuple(r) for i, r in after.items() if i > 24]
    _, done, more = run(spark, kept, groups)
    assert len(asked) == 2 and more == [] and {a for a, _ in done.values()} == {"unchanged"}


def test_failed_shrunk_and_deferred(spark):
    groups = [(1, [1, 2, 3, 4, 5]), (6, [6, 7, 8, 9]), (10, [10, 11, 12, 13])]
    after, done, _ = run(spark, [], groups, reply="")
    assert {a for a, _ in done.values()} == {"failed"} and max(after) == 24
    _, done, asked = run(spark, [], groups, max_calls=1, live=lambda i: i != 7)
    assert {k: a for k, (a, _) in done.items()} == {1: "insert", 6: "shrunk", 10: "deferred"} and len(asked) == 1
    assert asked[0].prompt.count("\n\n[") == 5 and "(fact, p) text 1" in asked[0].prompt
    assert run(spark, [], [])[1] == {}


def test_what_is_no_longer_owned_is_refused(spark):
    df = spark.createDataFrame([item(50, "fact", metadata=note(1, [1]))], ITEM)
    plan = spark.createDataFrame([(1, 4, [1, 2, 3, 4], "update", 50, 4, ["p"], ["x"])], "community_key long, n long, members array<long>, action string, summary_id long, live long, projects array<string>, lines array<string>")
    after, done = summaries.summaries_after(df, plan, spark.createDataFrame([(1, "text")], "community_key long, reply string"), A.at())
    assert [r.action for r in done.collect()] == ["foreign"] and after.first().content == "text 50"
    assert F is not None


def test_communities_of_light_edges_beside_many_heavy_ones(spark):
    # 50,000 heavy pairs were all that a cap of as many edges let through
    i = F.col("id")
    items = spark.range(100_010).select("id", F.lit("fact").alias("source_type"), F.lit(True).alias("is_active"), F.lit(False).alias("archived"), F.lit(None).cast("long").alias("superseded_by"))
    edge = lambda target, weight: (i.alias("source_id"), target.alias("target_id"), F.lit("relates_to").alias("relationship_type"), F.lit(weight).alias("weight"))
    edges = items.where("id < 100000 and id % 2 = 0").select(*edge(i + 1, 0.9)).union(items.where("id between 100000 and 100003").select(*edge(i + 1, 0.5)))
    got = jobs.qualifying_communities(items, edges, F.lit("2024-01-31").cast("timestamp")).collect()
    assert [(r.community_key, r.n, r.members) for r in got] == [(100_000, 5, list(range(100_000, 100_005)))]
