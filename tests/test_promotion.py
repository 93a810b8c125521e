"""Promotion of a batch equals taking its rows one after another."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import gates, writes
from quillspark.plans import jobs
from quillspark.sources import adapters as A
from quillspark.sources.tables import SCHEMAS

NOW = dt.datetime(2024, 1, 31)
AGENTS = ("web-one", "web-two")
TEXTS = {"empty": "  ", "long": "x" * 4001, "ok": "text"}


def cosine(a, b):
    return float(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b))


def one_by_one(rows, stored, cap, used):
    """The plain form: rows ``id, time, agent, project, text, vector, level`` in order, with the state that each leaves behind."""
    pool, used, out = list(stored), dict(used), {}
    for i, _, agent, project, text, vector, level in sorted(rows, key=lambda r: (r[1], r[0])):
        if TEXTS[text].strip() == "" or len(TEXTS[text]) > 4000:
            out[i] = ("rejected", "oversize")
        elif agent not in AGENTS:
            out[i] = ("rejected", "invalid-source-agent")
        elif used.get(agent, 0) >= cap:
            out[i] = ("deferred", None)
        elif vector is None:
            out[i] = ("failed", "embedding-unavailable")
        elif not any(vector):
            out[i] = ("failed", "similarity-not-a-number")
        else:
            best = max([cosine(v, vector) for p, v in pool if p == project], default=-1)
            if best >= 0.88:
                out[i] = ("rejected", "duplicate" if best > 0.95 else "near-duplicate")
            elif level not in ("kitchen", "recipe"):
                out[i] = ("failed", "verdict-unreadable")
            elif level == "recipe":
                out[i] = ("rejected", "recipe-level")
            else:
                out[i] = ("promoted", None)
                pool.append((project, vector))
                used[agent] = used.get(agent, 0) + 1
    return out


def random_batch(seed):
    rng = np.random.default_rng(seed)
    at = lambda: [float(x) for a in [rng.integers(0, 24) * 15 + rng.integers(0, 3)] for x in (np.cos(np.radians(a)), np.sin(np.radians(a)))]
    rows = []
    for i in rng.permutation(60).tolist():
        vector = [None, [0.0, 0.0], at()][rng.choice(3, p=[0.05, 0.05, 0.9])]
        rows.append((i, int(rng.integers(0, 30)), str(rng.choice([*AGENTS, "desktop"], p=[0.6, 0.3, 0.1])), str(rng.choice(["p", "q"])), str(rng.choice(["ok", "empty", "long"], p=[0.9, 0.05, 0.05])), vector, rng.choice(["kitchen", "recipe", "?", None], p=[0.8, 0.1, 0.05, 0.05])))
    return rows, [("p", at()) for _ in range(3)]


def run(spark, rows, stored, cap, used, slice_rows=None, monkeypatch=None):
    inbox = [(i, NOW - dt.timedelta(hours=40) + dt.timedelta(minutes=m), a, p, TEXTS[t], "pending", None, None, "{}", None, 0) for i, m, a, p, t, *_ in rows]
    inbox += [(1000 + k, NOW, a, "z", "t", "promoted", None, None, "{}", None, 0) for k, a in enumerate(a for a, n in used.items() for _ in range(n))]
    given = spark.createDataFrame([(r[0], r[5], None if r[6] is None else str(r[6])) for r in rows], "id long, embedding array<double>, level string")
    items = spark.createDataFrame([(k, p, v, True, False, None) for k, (p, v) in enumerate(stored)], "id long, project string, embedding array<double>, is_active boolean, archived boolean, superseded_by long")
    asked = []

    def classify(batch):
        asked.extend(r.id for r in batch.select("id").collect())
        return given.join(batch.select("id"), "id").select("id", "level")

    df = spark.createDataFrame(inbox, SCHEMAS["memory_inbox"])
    if slice_rows:
        plain = gates.settled
        monkeypatch.setattr(gates, "settled", lambda *a: plain(*a, slice_rows=slice_rows, fold_rows=0))
    out = jobs.promote_job(df, items, A.at(), jobs.PromoteOptions(batch=1000, cap=cap, agents=AGENTS), lambda b: b.join(given.select("id", "embedding"), "id"), classify)
    return df, items, out, asked


@pytest.mark.parametrize("seed", (0, 1, 3))
def test_like_one_by_one(spark, seed, monkeypatch):
    rows, stored = random_batch(seed)
    cap, used = (6, {"web-one": 1, "web-two": 6}) if seed % 2 else (40, {})
    _, _, out, asked = run(spark, rows, stored, cap, used, 9 if seed > 1 else None, monkeypatch)
    assert {r.id: (r.outcome, r.reason or r.error) for r in out.collect()} == one_by_one(rows, stored, cap, used)
    if seed % 2:
        assert not {r[0] for r in rows if r[2] == "web-two"} & set(asked)  # used up from the start, so nobody is asked


def test_duplicates_use_up_nothing(spark):
    one = [1.0, 0.0]
    rows = [(k, k, "web-one", "p", "ok", one, "kitchen") for k in range(4)] + [(4 + k, 9 + k, "web-one", "p", "ok", [0.0, 1.0] if k == 0 else [-1.0, 0.0] if k == 1 else [0.0, -1.0], "kitchen") for k in range(3)]
    got = {r.id: r.outcome for r in run(spark, rows, [("p", one)], 2, {})[2].collect()}
    assert got == {0: "rejected", 1: "rejected", 2: "rejected", 3: "rejected", 4: "promoted", 5: "promoted", 6: "deferred"}


def test_a_long_chain_of_near_rows(spark, monkeypatch):
    at = lambda k: [float(np.cos(k * 0.4)), float(np.sin(k * 0.4))]  # noqa: E731  each near the next only
    rows = [(k, k, "web-one", "p", "ok", at(k), "kitchen") for k in range(7)]
    got = {r.id: (r.outcome, r.matched_inbox_id) for r in run(spark, rows, [], 50, {}, 3, monkeypatch)[2].collect()}
    assert got == {k: ("promoted", None) if k % 2 == 0 else ("rejected", k - 1) for k in range(7)}


def test_failures_and_details_are_written(spark):
    rows = [(0, 0, "web-one", "p", "ok", [1.0, 0.0], "kitchen"), (1, 1, "web-one", "p", "ok", [1.0, 0.0], "kitchen"), (2, 2, "web-one", "p", "ok", None, "kitchen"), (3, 3, "web-one", "p", "ok", [0.0, 1.0], "?"), (4, 4, "desktop", "p", "ok", [0.0, 1.0], "?"), (5, 5, "web-two", "p", "ok", [-0.9, 0.1], "kitchen")]
    inbox, items, out, _ = run(spark, rows, [("p", [-1.0, 0.0])], 50, {})
    items = items.withColumn("content", F.lit("c"))
    _, after, _ = writes.promotion_writes(inbox, items, out, A.at(), "r")
    got = {r.id: (r.status, r.attempts, json.loads(r.metadata)["engine"]) for r in after.collect()}
    assert {i: g[:2] for i, g in got.items()} == {0: ("promoted", 0), 1: ("rejected", 0), 2: ("pending", 1), 3: ("pending", 1), 4: ("rejected", 0), 5: ("rejected", 0)}
    assert (got[1][2]["matched_memory_id"], got[1][2]["matched_similarity"]) == (1, 1.0) and got[5][2]["matched_memory_id"] == 0
    assert (got[2][2]["last_error"], got[3][2]["last_error"], got[4][2]["source_agent_seen"]) == ("embedding-unavailable", "verdict-unreadable", "desktop")


def test_an_empty_batch(spark):
    _, _, out, _ = run(spark, [], [], 5, {"web-one": 2})
    assert out.collect() == []


def test_only_claimed_rows_are_redacted(spark, monkeypatch):
    seen, gate = [], gates.gate_rows
    monkeypatch.setattr(gates, "gate_rows", lambda batch, *rest: seen.append(batch) or gate(batch, *rest))
    jobs.promote_job(A.memory_inbox(spark, "/root/testdata/sf0.001"), A.memory_items(spark, "/root/testdata/sf0.001"), A.at(), jobs.PromoteOptions(batch=20))
    assert seen[0].count() == 20 and "Limit" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()  # a plan with a limit lets Python see what is before it
