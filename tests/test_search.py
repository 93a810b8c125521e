"""Full-text ranks against scoring every item."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from quillspark.operators import search


def plain(signals, items, depth):
    texts = {i: Counter(t for t in re.split("[^a-z0-9]+", (c or "").lower()) if t) for i, c in items}
    n, mean = len(items), sum(sum(c.values()) for c in texts.values()) / len(items)
    df = Counter(w for c in texts.values() for w in c)
    out = {}
    for key, text in signals:
        asked = {t for t in re.split("[^a-z0-9]+", text.lower()) if t}
        score = {}
        for i, c in texts.items():
            s = sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in asked if w in c)
            if any(w in c for w in asked):
                score[i] = round(s, 9)
        best = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:depth]
        out.update({(key, i): (round(s, 6), k + 1) for k, (i, s) in enumerate(best)})
    return out


def test_ranks_like_scoring_everything(spark):
    items = [(k, " ".join(["the", "of"] * (1 + k % 5) + [f"w{k % 37}", f"v{k % 11}"] * (1 + k % 3) + ["filler"] * (k % 13))) for k in range(400)] + [(900, None), (901, ""), (902, "the")]
    signals = [("a", "The w3 of v4, w3!"), ("b", "the of"), ("c", "nowhere"), ("d", "v1 v2 w1 w2 the of filler"), ("e", "")]
    s, i = spark.createDataFrame(signals, "signal_key string, search_text string"), spark.createDataFrame(items, "id long, content string").repartition(3)
    for depth in (5, 40):
        got = {(r.signal_key, r.id): (round(r.score, 6), r["rank"]) for r in search.full_text_hits(s, i, depth, seeds=2).collect()}
        assert got == plain(signals, items, depth)
    assert search.full_text_hits(s.where("false"), i).collect() == [] and search.full_text_hits(s, i.where("false")).collect() == []


def test_frequent_words_make_no_candidates(spark, monkeypatch):
    seen = []
    put = search.Stash.put
    monkeypatch.setattr(search.Stash, "put", lambda self, df: seen.append((df.columns, put(self, df))) or seen[-1][1])
    items = spark.createDataFrame([(k, f"the of {'rare ' * 9 if k < 3 else ''}") for k in range(500)], "id long, content string")
    signals = spark.createDataFrame([("a", "the of rare")], "signal_key string, search_text string")
    hits = search.full_text_hits(signals, items, 3, seeds=1)
    assert {r.id for r in hits.collect()} == {0, 1, 2}
    candidates = [df for columns, df in seen if columns == ["signal_key", "id"]]
    assert candidates[-1].agg(F.count("*")).first()[0] == 3
