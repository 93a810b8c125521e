import json

from pyspark.sql import functions as F

from quillspark.operators import verdicts as v


def replies(spark, rows, key="id"):
    return spark.createDataFrame([(k, r if isinstance(r, str) or r is None else json.dumps(r)) for k, r in rows], f"{key} long, reply string")


def test_levels_fail_closed(spark):
    df = replies(spark, [(1, {"verdict": "kitchen", "suggested_source_type": " Decision "}), (2, "```json\n{\"verdict\": \"recipe\"}\n```"), (3, {"verdict": "maybe"}), (4, "no json"), (5, None), (6, {"verdict": "kitchen", "suggested_source_type": "odd"})])
    got = {r.id: (r.level, r.source_type) for r in v.levels(df).collect()}
    assert got == {1: ("kitchen", "decision"), 2: ("recipe", "fact"), 3: (None, "fact"), 4: (None, "fact"), 5: (None, "fact"), 6: ("kitchen", "fact")}


def test_replies_with_small_faults(spark):
    df = replies(spark, [(1, '{"verdict": "kitchen", "rationale": "two\nlines",}'), (2, '{"verdict": "recipe", "rationale": "a, ]b",\n}'), (3, '{"verdict": "recipe", "rationale": "keeps ,} this"}')])
    assert {r.id: (r.level, r.rationale) for r in v.levels(df).collect()} == {1: ("kitchen", "two\nlines"), 2: ("recipe", "a]b"), 3: ("recipe", "keeps ,} this")}


def test_edge_kinds(spark):
    got = {r.id: r.kind for r in v.edge_kinds(replies(spark, [(1, " Contradicts because"), (2, "unknown"), (3, ""), (4, None)])).collect()}
    assert got == {1: "contradicts", 2: None, 3: None, 4: None}


def test_contradictions(spark):
    c = lambda o, r="why", s="HIGH": {"objective_id": str(o), "rationale": r, "severity": s}
    df = replies(spark, [(1, {"contradictions": [c(10, s="odd"), c(10), c(99), c(11, r="  "), c(12), c(13), c(14)]}), (2, "bad {"), (3, {"contradictions": "x"})], "memory_id")
    shown = spark.createDataFrame([(m, o) for m in (1, 2, 3) for o in range(10, 15)], "memory_id long, objective_id long")
    got = sorted((r.memory_id, r.objective_id, r.severity) for r in v.contradictions(df, shown).collect())
    assert got == [(1, 10, "medium"), (1, 12, "high"), (1, 13, "high")]


def test_extractions_and_vocabulary(spark):
    df = replies(spark, [(1, {"entities": [{"name": "a", "type": "file"}, {"name": " ", "type": "x"}, {"name": "b", "type": "odd"}], "triples": [{"subject": "a", "predicate": "p", "object": "b"}, {"subject": "a"}]}), (2, "x")], "memory_id")
    entities, triples = v.extractions(df)
    assert sorted(r.name for r in entities.collect()) == ["a", "b"] and triples.count() == 1
    kept, dropped = v.by_vocabulary(entities, spark.createDataFrame([("file",)], "type string"), "type")
    assert [r.name for r in kept.collect()] == ["a"] and [(r.type, r.dropped) for r in dropped.collect()] == [("odd", 1)]


def test_cluster_verdicts(spark):
    full = {"coherent": True, "verdict": "kitchen", "title": " T ", "doctrine_text": "D", "evidence": [{"gist": " g "}, {"gist": ""}], "trigger_hints": ["h", " "]}
    cases = [
        (1, full), (2, {"coherent": True, "verdict": "recipe"}), (3, {"coherent": False, "groups": [["1", "2"], ["3", "77"]]}), (4, {"coherent": False, "groups": [["1", "2"], ["2", "3"]]}),
        (5, {"coherent": False, "groups": [["1", "2", "3"]]}), (6, {"coherent": False, "groups": [["1"], ["2"]]}), (7, {"coherent": True, "verdict": "kitchen", "title": "T"}), (8, "nothing"), (9, {"coherent": False, "groups": [["1", "2", "3"], ["77"]]}),
    ]
    df = replies(spark, cases).withColumn("members", F.array(*[F.lit(k).cast("long") for k in (1, 2, 3)]))
    got = {r.id: r for r in v.cluster_verdicts(df).collect()}
    assert {k: r.verdict for k, r in got.items()} == {1: "kitchen", 2: "recipe", 3: "split", 4: None, 5: None, 6: None, 7: None, 8: None, 9: None}
    assert got[3].groups == [[1, 2], [3]] and got[1].title == "T" and [e.gist for e in got[1].evidence] == ["g"] and got[1].trigger_hints == ["h"]


def test_citations_and_prompts(spark):
    df = spark.createDataFrame([([3, 9, 1, 3], [1, 2, 3]), ([9], [1, 2]), (None, [4])], "c array<long>, r array<long>")
    assert [r.v for r in df.select(v.valid_citations(F.col("c"), F.col("r")).alias("v")).collect()] == [[3, 1], [1, 2], [4]]
    rows = spark.createDataFrame([("a", 2, "two"), ("a", 1, "one"), ("b", 1, "x" * 9)], "k string, o int, t string")
    got = {r.k: r.prompt for r in v.prompt("Do it.", rows, "k", F.col("t"), F.col("o"), 5).collect()}
    assert got == {"a": "Do it.\n\n1. one\n2. two", "b": "Do it.\n\n1. xxxxx…"}
