"""Decontamination against a plain form: words, windows and spans looked up one by one."""

import random
import re

from pyspark.sql import functions as F

from quillspark.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width):
    windows = {}
    for i, text in items:
        w = words(text)
        k = min(width, len(w))
        for p in range(len(w) - k + 1) if w and i is not None else ():
            windows.setdefault(tuple(w[p : p + k]), set()).add(str(i))
    out = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in windows:
                    hit |= set(range(p, p + k))
                    found |= windows[tuple(w[p : p + k])]
        out.append((d, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=str)


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 9) for i, t in docs], "doc_id long, text string, words string, key int").repartition(3)
    return d, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


def got(df):
    return sorted([(r.doc_id, r.n_words, r.hit_words, r.item_ids) for r in df.collect()], key=str)


def random_case(seed):
    rng = random.Random(seed)
    some = lambda n, k: " ".join(rng.choice([f"w{j}", f"W{j}", f"é{j}"]) for j in (rng.randrange(k) for _ in range(n)))
    items = [(i, some(rng.randrange(0, 12), 5)) for i in range(25)] + [(100, None), (101, "..."), (None, "w1 w2"), (3, "w0 w0 w0 w0 w0 w0")]
    docs = [(i, some(rng.randrange(0, 60), 5)) for i in range(40)]
    docs += [(40, None), (41, ""), (42, "?!"), (7, docs[7][1]), (7, docs[7][1]), (7, "w0 w0 w0 w0 w0 w0 w1"), (None, "W0--w0\tw0, w0.w0 w0"), (43, "w1 " * 30_000)]
    return docs, items


def test_like_brute_force(spark):
    for seed, width, size in ((1, 4, 48_000_000), (2, 6, 900)):
        docs, items = random_case(seed)
        d, b = tables(spark, docs, items)
        assert got(dc.find_contamination(d, b, width, block_bytes=size)) == brute(docs, items, width)


def test_nothing_to_find_or_to_search(spark):
    docs, items = random_case(3)
    d, b = tables(spark, docs[:5] + [(40, None)], items)
    assert got(dc.find_contamination(d, b.where("false"), 4)) == sorted([(i, len(words(t)), [], []) for i, t in docs[:5] + [(40, None)]], key=str)
    assert dc.find_contamination(d.where("false"), b, 4).collect() == []


def test_shared_passages_are_listed_once(spark):
    passage = " ".join(f"p{k}" for k in range(12))
    items = [(k, passage) for k in range(30)] + [(99, passage + " and more")]
    docs = [(k, f"own{k} {passage} end") for k in range(50)] + [(50, "clean")]
    d, b = tables(spark, docs, items)
    rows = {r.doc_id: r for r in dc.find_contamination(d, b, 10).collect()}
    assert all(rows[k].hit_words == list(range(1, 13)) and rows[k].item_ids == sorted(str(i) for i, _ in items) for k in range(50))
    assert rows[50].hit_words == [] and rows[50].item_ids == []


def test_spans_are_cut_and_documents_dropped(spark):
    items = [(1, "alpha beta gamma delta"), (2, "Solo")]
    docs = [(1, "Keep this; Alpha, beta - GAMMA delta! And this."), (2, "solo"), (3, "clean text"), (4, None), (1, "another row with the same id"), (5, " (x)  alpha beta gamma delta\n\n")]
    d, b = tables(spark, docs, items)
    cut = dc.decontaminate(d, b, width=4)
    assert cut.columns == d.columns
    assert sorted((r.doc_id, r.text or "-") for r in cut.collect()) == sorted([(1, "Keep this! And this."), (2, "-"), (3, "clean text"), (4, "-"), (1, "another row with the same id"), (5, " (x\n\n")])
    left = dc.decontaminate(d, b, "documents", width=4)
    assert left.columns == d.columns and sorted((r.doc_id, r.text or "-") for r in left.collect()) == [(1, "another row with the same id"), (3, "clean text"), (4, "-")]
    assert dc.find_contamination(cut, b, 4).where(F.size("hit_words") > 0).count() == 0
