"""The gated promotion of proposals, as ordered conditions over a claimed batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import redacted, trimmed
from quillspark.runtime import Stash, ship

#: The longest text and metadata, project hint, and similarity bands.
MAX_TEXT, MAX_METADATA, MAX_HINT, NEAR, EXACT = 4000, 8192, 128, 0.88, 0.95


def resolved_project(hint: Column) -> Column:
    """The trimmed hint, or ``global`` if there is none or it is too long."""
    t = trimmed(F.coalesce(hint, F.lit("")))
    return F.when((F.length(t) == 0) | (F.length(t) > MAX_HINT), "global").otherwise(t)


def duplicate_verdict(similarity: Column) -> Column:
    """Above 0.95 a duplicate, from 0.88 a near duplicate (0.95 itself included), else null."""
    return F.when(similarity > EXACT, "duplicate").when(similarity >= NEAR, "near-duplicate")


def gate_rows(batch: DataFrame, agents: tuple[str, ...], redact: bool = True) -> DataFrame:
    """Rows with redacted ``content``, ``agent``, ``project``, and the first cheap gate that rejects them (``reason``, ``check``)."""
    ship(batch.sparkSession)
    content = trimmed(redacted(F.coalesce("text", F.lit(""))) if redact else F.coalesce("text", F.lit("")))
    rows = batch.withColumn("content", content).withColumn("agent", F.lower(trimmed(F.coalesce("source_agent", F.lit("")))))
    size = F.length("content")
    check = (
        F.when(size == 0, "empty-after-redaction").when(size > MAX_TEXT, f"text-over-{MAX_TEXT}")
        .when(F.length(F.coalesce("metadata", F.lit("{}"))) > MAX_METADATA, f"metadata-over-{MAX_METADATA}")
    )
    reason = F.when(check.isNotNull(), "oversize").when(~F.col("agent").isin(*agents), "invalid-source-agent")
    return rows.withColumn("check", check).withColumn("reason", reason).withColumn("project", resolved_project(F.col("project_hint")))


def _before(rows: DataFrame, **counted: Column) -> DataFrame:
    """For each row, how many earlier rows of its agent meet each condition.

    Rows carry the ``slice`` of the order (agent, time, id) that they were dealt to; a
    window counts within a slice, and what earlier slices hold is added from one row per
    agent and slice.  So a busy agent is not counted by one task.
    """
    per = rows.groupBy("agent", "slice").agg(*[F.count_if(c).alias(f"_{n}") for n, c in counted.items()])
    earlier = Window.partitionBy("agent").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("agent", "slice", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in counted])
    own = Window.partitionBy("agent", "slice").orderBy("created_at", "id").rowsBetween(Window.unboundedPreceding, -1)
    within = rows.select("*", *[F.coalesce(F.sum(c.cast("int")).over(own), F.lit(0)).alias(f"_own_{n}") for n, c in counted.items()])
    both = within.join(per, ["agent", "slice"])
    return both.select(*rows.columns, *[(F.col(f"_{n}") + F.col(f"_own_{n}")).alias(n) for n in counted])


def _folded(cap: int):
    """The batch of a task in order, with what each agent has used up and which classes have a promoted row."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [f for f in frames if len(f)]
        if not whole:
            return
        pdf = pd.concat(whole).sort_values(["created_at", "id"])
        used: dict = {}
        taken: dict[int, int] = {}
        out = []
        for i, agent, gated, passes, near, own, base in zip(pdf["id"].tolist(), pdf["agent"], pdf["gated"], pdf["passes"], pdf["near"], pdf["class"], pdf["base"]):
            spent = used.setdefault(agent, base)
            deferred, match = not gated and spent >= cap, None
            if not gated and not deferred:
                met = [(n["similarity"], -taken[n["other"]]) for n in (near if near is not None else ()) if n["other"] in taken]
                match = max(met, default=None)
            promoted = bool(passes) and not deferred and match is None
            if promoted:
                used[agent] = spent + 1
                if not pd.isna(own):
                    taken[int(own)] = i
            out.append((i, deferred, promoted, match and -match[1], match and match[0]))
        yield pd.DataFrame(out, columns=["id", "deferred", "promoted", "match_id", "match_similarity"]).astype({"match_id": "Int64", "match_similarity": "float64"})

    return run


def settled(rows: DataFrame, near: DataFrame, promoted: DataFrame, cap: int = 50, slice_rows: int = 50_000, fold_rows: int = 2000) -> DataFrame:
    """Decides a batch as if its rows were taken one after another: ``id, deferred, promoted, match_id, match_similarity``.

    ``rows`` hold ``id, agent, created_at``, ``gated`` (rejected before the cap),
    ``passes`` (nothing but the cap or a row promoted before it can stop it) and
    ``class`` (of rows with one vector in one project, or null); ``near`` holds the
    classes that are near duplicates, both ways and with themselves, as ``class, other,
    similarity``; ``promoted`` what each agent has used up.  A row is deferred once its
    agent has ``cap`` promotions, those of the batch before it included; rejected,
    failed and deferred rows use up nothing.  Otherwise it is a duplicate if a row of a
    near class was promoted before it: ``match_id`` is the most similar one.

    A batch of up to ``fold_rows``, as a claim's limit makes it, is taken in order by one
    task.  A larger one is not, with the same result: rows depend on earlier ones in
    both ways, so they are settled in rounds: promotions
    known so far bound an agent's use from below, undecided rows from above, and a row
    is decided when both bounds agree.  The earliest undecided row always is; in
    practice a few rounds do.  Only the chains of ``near`` within a batch make more.
    """
    stash = Stash(rows.sparkSession, "settled")
    n = rows.count()
    base = promoted.select("agent", F.col("promoted").alias("base"))
    if n <= fold_rows:
        around = near.groupBy("class").agg(F.collect_list(F.struct("other", "similarity")).alias("near"))
        few = rows.join(base, "agent", "left").withColumn("base", F.coalesce("base", F.lit(0))).join(around, "class", "left")
        return few.coalesce(1).mapInPandas(_folded(cap), "id long, deferred boolean, promoted boolean, match_id long, match_similarity double")
    slices = max(1, -(-n // slice_rows))
    state = rows.join(base, "agent", "left").withColumn("base", F.coalesce("base", F.lit(0)))
    state = state.withColumn("moment", F.struct("created_at", "id")).withColumn("state", F.when(~F.col("passes"), "no"))
    if slices > 1:
        state = state.repartitionByRange(slices, "agent", "created_at", "id").withColumn("slice", F.spark_partition_id())
    else:
        state = state.withColumn("slice", F.lit(0))
    state = stash.put(state)
    while not state.where("state is null").isEmpty():
        yes, waits = F.coalesce(F.col("state") == "yes", F.lit(False)), F.col("state").isNull()
        first = state.where(yes | waits).groupBy(F.col("class").alias("other")).agg(F.min(F.when(yes, F.col("moment"))).alias("taken"), F.min(F.when(waits, F.col("moment"))).alias("open"))
        around = near.join(first, "other").groupBy("class").agg(F.min("taken").alias("taken"), F.min("open").alias("open"))
        seen = _before(state, yes=yes, waits=waits).join(around, "class", "left")
        low, high = F.col("base") + F.col("yes"), F.col("base") + F.col("yes") + F.col("waits")
        before = lambda c: F.coalesce(F.col(c) < F.col("moment"), F.lit(False))
        decided = F.when(F.col("state").isNotNull(), F.col("state")).when((low >= cap) | before("taken"), "no").when((high < cap) & ~before("open"), "yes")
        following = stash.put(seen.select(*[decided.alias(c) if c == "state" else F.col(c) for c in state.columns]))
        stash.drop(state)
        state = following
    yes = F.coalesce(F.col("state") == "yes", F.lit(False))
    final = _before(state, yes=yes).withColumn("deferred", ~F.col("gated") & (F.col("base") + F.col("yes") >= cap))
    taken = state.where(yes).select(F.col("class").alias("other"), F.col("id").alias("match_id"), F.col("moment").alias("taken"))
    asks = final.where(~F.col("gated") & ~F.col("deferred") & (F.col("state") == "no")).select("id", "class", "moment")
    met = asks.join(near, "class").join(taken, "other").where(F.col("taken") < F.col("moment"))
    best = met.groupBy("id").agg(F.max(F.struct("similarity", -F.col("match_id"))).alias("m")).select("id", (-F.col("m")["col2"]).alias("match_id"), F.col("m.similarity").alias("match_similarity"))
    return final.select("id", "deferred", yes.alias("promoted")).join(best, "id", "left")


def outcomes(rows: DataFrame) -> DataFrame:
    """Each row's ``outcome`` (promoted, rejected, deferred, failed), with ``reason`` of a rejection or ``error`` of a failure.

    ``rows`` are decided: ``reason`` of the cheap gates, ``deferred``, ``error`` of the
    embedding, ``similarity`` of what it duplicates, ``judged`` (a classifier was asked)
    and ``level``.  Gates stand in that order.  No vector and no readable verdict are
    failures, which leave the row pending, never a promotion or a rejection.
    """
    late = F.when(F.col("error").isNull(), duplicate_verdict(F.col("similarity")))
    unread = F.col("judged") & ~F.coalesce(F.col("level").isin("kitchen", "recipe"), F.lit(False))
    error = F.when(F.col("reason").isNotNull() | F.col("deferred"), None).when(F.col("error").isNotNull(), F.col("error")).when(late.isNull() & unread, "verdict-unreadable")
    reason = F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("deferred") | error.isNotNull(), None).when(late.isNotNull(), late).when(F.col("level") == "recipe", "recipe-level")
    outcome = F.when(F.col("reason").isNotNull(), "rejected").when(F.col("deferred"), "deferred").when(error.isNotNull(), "failed").when(reason.isNotNull(), "rejected").otherwise("promoted")
    return rows.withColumns({"outcome": outcome, "_reason": reason, "error": error}).withColumn("reason", F.col("_reason")).drop("_reason")


def after_failure(attempts: Column, most: int = 5) -> tuple[Column, Column]:
    """Attempts and status after a failed row: rejected for good once exhausted."""
    more = F.coalesce(attempts, F.lit(0)) + 1
    return more, F.when(more >= most, "rejected").otherwise("pending")
