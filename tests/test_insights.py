"""Replies of a model, good and broken, through the plan that writes insights."""

from pyspark.sql import functions as F

from quillspark.operators import insights


def one(key, cited, text):
    return f'{{"key":"{key}","text":"{text}","cited_ids":[{cited}]}}'


#: name: reply, and what the signals a and b get (None for a placeholder)
REPLIES = {
    "plain": ('{"insights":[' + one("a", '"1"', "first") + "," + one("b", '"4"', "second") + "]}", ("first", [1]), ("second", [4])),
    "comma before ]": ('{"insights":[' + one("a", '"1"', "x") + ",]}", ("x", [1]), None),
    "comma before }": ('{"insights":[{"key":"a","text":"x","cited_ids":["1"],}]}', ("x", [1]), None),
    "single objects": (one("a", '"1"', "first") + " NO_JSON " + one("b", '"5"', "second"), ("first", [1]), ("second", [5])),
    "a broken one": (one("a", '"1"', "good") + ' {"key":"b" "text":"bad" "cited_ids":[]}', ("good", [1]), None),
    "nothing": ("{ this is not json ::: }", None, None),
    "fenced": ("```json\n{\"insights\":[" + one("b", '"4"', "in a fence") + "]}\n```", None, ("in a fence", [4])),
    "chatty": ("Sure: {\"insights\":[" + one("a", '"2"', "said") + "]} bye", ("said", [2]), None),
    "line end in a string": ('{"insights":[' + one("a", '"1"', "two\nlines") + "]}", ("two\nlines", [1]), None),
    "unrelated ids": ('{"insights":[' + one("a", '"99","x"', "t") + "]}", ("t", [1, 2]), None),
    "some unrelated": ('{"insights":[' + one("a", '"99","2"', "t") + "]}", ("t", [2]), None),
    "no ids": ('{"insights":[{"key":"a","text":" t "}]}', ("t", [1, 2]), None),
    "empty text": ('{"insights":[' + one("a", '"1"', "  ") + "]}", None, None),
    "named twice": ('{"insights":[' + one("a", '"1"', "old") + "," + one("a", '"2"', "new") + "]}", ("new", [2]), None),
    "another key": ('{"insights":[' + one("z", '"1"', "t") + "]}", None, None),
    "null": (None, None, None),
}


def table(spark, rows):
    return spark.createDataFrame([(k, d, len(r), p, [(n, i, f"text {i}") for n, i in enumerate(r)]) for k, d, p, r in rows], "signal_key string, description string, n long, projects array<string>, related array<struct<place:int,id:long,content:string>>")


def test_replies(spark):
    names = list(REPLIES)
    rows = [(f"{s}", "about it", ["p"], [1, 2] if s == "a" else [4, 5]) for s in "ab"]
    every = spark.createDataFrame([(n, REPLIES[n][0]) for n in names], "name string, reply string")
    asked = []

    def ask(prompts):
        asked.append(prompts.collect())
        return prompts.select("batch").crossJoin(every.where(F.col("name") == name)).select("batch", "reply")

    for name in ("single objects", "some unrelated", "nothing"):
        got = {r.signal_key: r for r in insights.written(table(spark, rows), ask, [F.asc("signal_key")]).collect()}
        check(got, REPLIES[name])
    assert len(asked[0]) == 1 and all(x in asked[0][0].prompt for x in ("Signal a", "Signal b", "- id=4 text 4"))
    # every reply's entries at once
    entries = {r.name: r.e for r in every.select("name", insights.insight_entries(F.col("reply")).alias("e")).collect()}
    for name, (_, a, b) in REPLIES.items():
        last = {e.key: e.text.strip() for e in entries[name]}
        assert [last.get(k) or None for k in "ab"] == [w and w[0] for w in (a, b)], name


def check(got, want):
    for key, w, n in (("a", want[1], [1, 2]), ("b", want[2], [4, 5])):
        r = got[key]
        if w is None:
            assert (r.synthesized, r.source_ids, r.insight) == (False, n, "Found 2 related memories from project p about: about it")
        else:
            assert (r.synthesized, r.insight, r.source_ids) == (True, *w)


def test_batches_budget_and_failed_calls(spark):
    rows = [(f"s{k}", None, [] if k else ["p", "q"], [k]) for k in range(8)]
    asked = []

    def ask(prompts):
        got = prompts.collect()
        asked.extend((r.batch, r.prompt.count("Signal s")) for r in got)
        return spark.createDataFrame([(r.batch, '{"insights":[' + one("s0", "0", "t") + "]}") for r in got if r.batch != 1], "batch int, reply string")

    got = {r.signal_key: r for r in insights.written(table(spark, rows), ask, [F.asc("signal_key")], max_calls=2).collect()}
    assert sorted(asked) == [(0, 3), (1, 3)] and len(got) == 8 and [k for k, r in got.items() if r.synthesized] == ["s0"]
    assert got["s3"].insight == "Found 1 related memory from projects unknown about: "
    quiet = insights.written(table(spark, rows), None, [F.asc("signal_key")]).collect()
    assert len(quiet) == 8 and not any(r.synthesized for r in quiet)
    assert insights.written(table(spark, []), ask, [F.asc("signal_key")]).collect() == []


def test_outermost_objects(spark):
    cases = {"a {x{y}} b {z}": ["{x{y}}", "{z}"], "{a": [], "": [], "no": [], "} {a} {b}": [], "{}{}": ["{}", "{}"]}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.o for r in df.select("t", insights.balanced_objects(F.col("t")).alias("o")).collect()} == cases
