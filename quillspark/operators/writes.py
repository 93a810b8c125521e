"""Writes of the jobs as new snapshots: promotions, rejections, failures and the registry's life cycle.

A guard such as "only while the row is pending" is a condition on the snapshot that the
write starts from, so an outcome that comes too late changes nothing and is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import json_merged, json_without, objective_key
from quillspark.operators import ledger, verdicts
from quillspark.operators.gates import after_failure
from quillspark.operators.registry import registry_centroids
from quillspark.runtime import Stash
from quillspark.sources.tables import align

# The reasons that are written, attempts-exhausted, recipe-level, split-into-subclusters, incoherent-cluster-unresolved, llm-verdict-unparseable.


def _with_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def promotion_writes(inbox: DataFrame, items: DataFrame, outcomes: DataFrame, as_of: Column, run_id: str, failures: DataFrame | None = None, most: int = 5, book: str = "engine") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The new items, the inbox after the batch, and the outcomes that lost their race.

    ``outcomes`` are those of ``promote_job``; a failed one counts an attempt, and so does a row of
    ``failures`` (``id, error``; say, of a write), whatever its outcome.  Only rows
    pending in ``inbox`` change; a deferred row never does.  A new item's id is the inbox
    row's plus one plus the largest item id, so ids of the inbox must be unique and not
    negative.  What the engine notes goes under ``book`` in the row's metadata: for a
    rejection the check, what was matched and how similar it is, the classifier's
    rationale, or the agent as it was given.  The item keeps the metadata without it.
    """
    details = {"source_type": "string", "rationale": "string", "embedding": "array<float>", "error": "string", "matched_id": "long", "matched_inbox_id": "long", "matched_similarity": "double", "agent_seen": "string"}
    out = _with_missing(outcomes, details)
    out = out.select("id", *[F.col(c).alias(f"_{c}") for c in ("outcome", "reason", "check", "agent", "project", "content", *details)])
    rows = _with_missing(inbox, {"promoted_memory_id": "long", "rejection_reason": "string", "metadata": "string", "attempts": "int"}).join(out, "id", "left")
    if failures is not None:
        broken = failures.groupBy("id").agg(F.max("error").alias("_broken")).withColumn("_outcome_", F.lit("failed"))
        rows = rows.join(broken, "id", "left").withColumns({"_error": F.coalesce("_broken", "_error"), "_outcome": F.coalesce("_outcome_", "_outcome")}).drop("_broken", "_outcome_")
    pending = F.coalesce(F.col("status") == "pending", F.lit(False))
    decided = F.col("_outcome").isin("promoted", "rejected")
    rows = rows.withColumn("_act", F.when(pending & F.col("_outcome").isin("promoted", "rejected", "failed"), F.col("_outcome")))
    first = items.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("first")).scalar()
    rows = rows.withColumn("_item", F.when(F.col("_act") == "promoted", first + 1 + F.col("id")))
    rows = rows.withColumn("_matched", F.coalesce("_matched_id", first + 1 + F.col("_matched_inbox_id")))  # a row of the batch by the id of the item that it became
    more, state = after_failure(F.col("attempts"), most)
    act = F.col("_act")
    when = F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    of = lambda condition, column: F.when((act == "rejected") & condition, column)
    note = F.to_json(F.struct(
        F.when(act == "promoted", when).alias("promoted_at"), F.when(act == "rejected", when).alias("rejected_at"), of(F.lit(True), F.col("_check")).alias("check"),
        of(F.lit(True), F.col("_matched")).alias("matched_memory_id"), of(F.lit(True), F.col("_matched_similarity")).alias("matched_similarity"), of(F.col("_reason") == "recipe-level", F.col("_rationale")).alias("kitchen_rationale"),
        of(F.col("_reason") == "invalid-source-agent", F.col("_agent_seen")).alias("source_agent_seen"),
        F.when(act == "failed", when).alias("last_failed_at"), F.when(act == "failed", F.substring("_error", 1, 500)).alias("last_error"), F.when(act == "failed", more).alias("attempts"), F.lit(run_id).alias("run_id"),
    ))
    before = F.get_json_object("metadata", f"$.{book}")
    noted = json_merged(F.col("metadata"), F.concat(F.lit(f'{{"{book}":'), json_merged(before, note), F.lit("}")))
    after = rows.select(*[F.col(c) for c in inbox.columns if c not in ("status", "promoted_memory_id", "rejection_reason", "metadata", "attempts")],
        F.when(act.isin("promoted", "rejected"), act).when(act == "failed", state).otherwise(F.col("status")).alias("status"), F.coalesce("_item", "promoted_memory_id").alias("promoted_memory_id"),
        F.when(act == "rejected", F.col("_reason")).when((act == "failed") & (state == "rejected"), "attempts-exhausted").otherwise(F.col("rejection_reason")).alias("rejection_reason"),
        F.when(act == "failed", more).otherwise(F.col("attempts")).cast("int").alias("attempts"), F.when(act.isNotNull(), noted).otherwise(F.col("metadata")).alias("metadata"))
    kept = F.to_json(F.struct(F.col("id").alias("inbox_id"), F.lit(book).alias("promoted_by"), when.alias("promoted_at"), F.col("_rationale").alias("rationale"), F.try_parse_json(json_without(F.col("metadata"), book)).alias("proposal_metadata")))
    new = rows.where(act == "promoted").select(
        F.col("_item").alias("id"), F.col("_content").alias("content"), F.coalesce("_source_type", F.lit("fact")).alias("source_type"), F.col("_project").alias("project"), as_of.alias("created_at"), as_of.alias("updated_at"),
        F.col("_embedding").alias("embedding"), F.lit(True).alias("is_active"), F.lit(False).alias("archived"), F.md5("_content").alias("content_hash"), kept.alias("metadata"), F.lit(0).alias("recall_count"), F.lit(1.0).alias("recall_boost"), F.col("_agent").alias("source_agent"))
    lost = rows.where(decided & ~pending).select("id", F.col("_outcome").alias("outcome"), "status")
    return align(new, "memory_items", "source_agent"), after, lost


def group_sums(members: DataFrame, key: str) -> DataFrame:
    """Per key the number of vectors ``n`` and their sum ``total``; what a centroid that takes in members needs."""
    parts = members.where(F.col("embedding").isNotNull()).select(F.col(key).alias("key"), F.posexplode("embedding").alias("pos", "x")).groupBy("key", "pos").agg(F.sum(F.col("x").cast("double")).alias("s"), F.count("*").alias("n"))
    return parts.groupBy("key").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda p: p["s"]).alias("total")).withColumnRenamed("key", key)


def registry_writes(registry: DataFrame, groups: DataFrame, actions: DataFrame, as_of: Column) -> DataFrame:
    """The registry after groups of items were reinforced into it or inserted, with ``grew`` and ``drifted`` of each entry.

    ``groups`` hold ``id, member_ids, member_hashes, projects, n, total`` (the last two
    from :func:`group_sums`) and may hold ``position``, their order (else their ids are);
    ``actions`` are those of ``registry_matches`` or ``reinforce_registry``.  An entry
    takes in its groups in order; members and projects are kept in the order in which
    they came, each member with its last hash.  ``grew``: a member is new, or the entry
    is; ``drifted``: a member that the entry had before has another hash.  An inserted entry
    without a given id gets the group's plus one plus the largest one.

    Members are merged as rows, by entry and member, and put together at the end.
    """
    stash = Stash(registry.sparkSession, "registry")
    first = registry.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("first")).scalar()
    both = groups.join(actions.select("id", "action", "registry_id"), "id").withColumn("target", F.coalesce("registry_id", first + 1 + F.col("id")))
    position = F.col("position").cast("long") if "position" in groups.columns else F.col("id")
    both = both.withColumn("turn", F.when(F.col("action") == "insert", F.lit(-(1 << 62))).otherwise(position))  # an entry's maker comes first
    both = stash.put(both.select("target", "turn", F.col("id").alias("group"), "member_ids", "member_hashes", "projects", "n", "total"))
    touched = both.select("target").distinct()
    before = F.lit(-(1 << 63))
    old = registry.withColumnRenamed("id", "target").join(touched, "target", "left_semi").select("target", before.alias("turn"), F.lit(-1).cast("long").alias("group"), "member_ids", "member_hashes", "projects")
    rows = both.select("target", "turn", "group", "member_ids", "member_hashes", "projects").unionByName(old)
    members = rows.select("target", "turn", "group", F.posexplode(F.arrays_zip(F.col("member_ids").alias("i"), F.col("member_hashes").alias("h"))).alias("at", "m")).select("target", F.struct("turn", "group", "at").alias("moment"), F.col("turn").eqNullSafe(before).alias("known"), F.col("m.i").alias("member"), F.col("m.h").alias("hash"))
    mark = F.coalesce(F.col("hash"), F.lit(""))
    per = members.groupBy("target", "member").agg(
        F.min("moment").alias("moment"), F.max(F.struct("moment", "hash"))["hash"].alias("hash"), F.bool_or("known").alias("known"),
        F.max(F.when(F.col("known"), mark)).alias("was"), F.min(F.when(~F.col("known"), mark)).alias("low"), F.max(F.when(~F.col("known"), mark)).alias("high"))
    moved = F.col("known") & F.coalesce((F.col("low") != F.col("was")) | (F.col("high") != F.col("was")), F.lit(False))
    merged = per.groupBy("target").agg(F.array_sort(F.collect_list(F.struct("moment", "member", "hash"))).alias("m"), F.bool_or(~F.col("known")).alias("grew"), F.bool_or(moved).alias("drifted"))
    named = rows.select("target", "turn", "group", F.posexplode("projects").alias("at", "project")).groupBy("target", "project").agg(F.min(F.struct("turn", "group", "at")).alias("moment"))
    named = named.groupBy("target").agg(F.transform(F.array_sort(F.collect_list(F.struct("moment", "project"))), lambda p: p["project"]).alias("_projects"))
    pick = lambda field: F.transform("m", lambda x: x[field])
    state = registry_centroids(both, registry)
    fresh = merged.join(state, "target").join(named, "target", "left").select(
        F.col("target").alias("id"), F.lit(True).alias("_hit"), pick("member").alias("_member_ids"), pick("hash").alias("_member_hashes"), F.coalesce("_projects", F.array().cast("array<string>")).alias("_projects"),
        F.col("centroid").alias("_centroid"), F.col("occurrences").alias("_occurrence_count"), "taken", F.col("grew").alias("_grew"), F.col("drifted").alias("_drifted"))
    fresh = stash.put(fresh)
    kept = _with_missing(registry, {"reinforced_after_ratification": "int", "updated_at": "timestamp"}).join(fresh, "id", "left")
    hit = F.coalesce("_hit", F.lit(False))
    names = [c for c in registry.columns if c not in ("reinforced_after_ratification", "updated_at")]
    change = ("member_ids", "member_hashes", "projects", "centroid", "occurrence_count")
    ratified = F.coalesce("reinforced_after_ratification", F.lit(0)) + F.when(hit & (F.col("status") == "ratified"), F.col("taken")).otherwise(0)
    kept = kept.select(*[(F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)) if c in change else F.col(c)).alias(c) for c in names], ratified.cast("int").alias("reinforced_after_ratification"), F.when(hit, as_of).otherwise(F.col("updated_at")).alias("updated_at"), F.coalesce("_grew", F.lit(False)).alias("grew"), F.coalesce("_drifted", F.lit(False)).alias("drifted"))
    new = fresh.join(registry.select("id"), "id", "left_anti").select(
        "id", *[F.col(f"_{c}").alias(c) for c in change], F.lit("candidate").alias("status"), F.lit(0).alias("reinforced_after_ratification"), as_of.alias("updated_at"), F.lit(True).alias("grew"), F.lit(False).alias("drifted"))
    return kept.unionByName(new, allowMissingColumns=True)


def registry_verdicts(registry: DataFrame, judged: DataFrame, as_of: Column) -> DataFrame:
    """The registry after verdicts on its entries (those of ``cluster_verdicts``).

    A kitchen verdict drafts the entry with its title and text; any other rejects it,
    but only a candidate or a draft.  A group that the judge found incoherent
    (``incoherent``, where ``judged`` has it) without a split that can be followed is
    rejected as unresolved.  Entries without a verdict stay.
    """
    extra = {"title": "string", "rejection_reason": "string", "evidence": "array<struct<date:string,gist:string>>", "trigger_hints": "array<string>"}
    judged = _with_missing(judged, {"incoherent": "boolean"})
    new = judged.select("id", F.lit(True).alias("_judged"), F.coalesce("incoherent", F.lit(False)).alias("_incoherent"), *[F.col(c).alias(f"_{c}") for c in ("verdict", "title", "doctrine_text", "evidence", "trigger_hints")])
    rows = _with_missing(registry, extra).join(new, "id", "left")
    draft = F.coalesce(F.col("_verdict") == "kitchen", F.lit(False))
    refuse = F.col("_judged").isNotNull() & ~draft & F.col("status").isin("candidate", "drafted")
    reason = F.when(F.col("_verdict") == "recipe", "recipe-level").when(F.col("_verdict") == "split", "split-into-subclusters").otherwise("llm-verdict-unparseable")
    change = {"status": F.when(draft, "drafted").when(refuse, "rejected").otherwise(F.col("status")), "synthesized_at": F.when(draft | refuse, as_of).otherwise(F.col("synthesized_at")), "rejection_reason": F.when(refuse, reason).otherwise(F.col("rejection_reason"))}
    for c in ("title", "doctrine_text", "evidence", "trigger_hints"):
        change[c] = F.when(draft, F.col(f"_{c}")).otherwise(F.col(c))
    return rows.select(*[change.get(c, F.col(c)).alias(c) for c in rows.columns if not c.startswith("_")])


def guard_writes(backlog: DataFrame, replies: DataFrame, objectives: DataFrame, flags: DataFrame, scanned: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """The flags that are new, and the ledger of judged items after the replies ``memory_id, reply``.

    ``backlog`` is that of ``contradiction_backlog``; an item is shown its project's
    active objectives, by their ids or, where they have none, by a hash of their text, and
    can only be found to contradict those.  A flag is written
    once per item and objective.  A reply that can't be read finds nothing, and the item
    is judged all the same; only a call that failed (``error`` of ``replies``, where it
    has that column) is an error, which is tried again while attempts last.  Items
    without a row in ``replies`` keep their ledger row.
    """
    if "error" not in replies.columns:
        replies = replies.withColumn("error", F.lit(None).cast("string"))
    of = backlog.select(F.col("id").alias("memory_id"), "project", "objectives_hash")
    goals = _with_missing(objectives, {"content": "string"}).where(F.col("status") == "active").select(F.col("id").alias("objective_id"), "project", objective_key(F.col("id"), F.col("project"), F.col("content")).alias("objective_key"))
    shown = of.join(goals, "project").select("memory_id", "objective_id", "objective_key")
    answered = replies.join(of, "memory_id")
    found = verdicts.contradictions(answered.where("error is null").select("memory_id", "reply"), shown).join(of.select("memory_id", "project"), "memory_id")
    key = F.concat_ws(":", F.lit("contradiction"), F.col("memory_id").cast("string"), F.col("objective_key"))
    rows = found.select(key.alias("dedup_key"), F.lit("contradiction").alias("kind"), "project", "memory_id", "objective_id", "severity", "rationale", as_of.alias("created_at"))
    new = align(ledger.append_new(flags, rows), "objective_flags")
    count = new.groupBy("memory_id").agg(F.count("*").alias("flags_written"))
    judged = answered.groupBy("memory_id", "objectives_hash").agg(F.max("error").alias("error")).join(count, "memory_id", "left")
    status = F.when(F.col("error").isNull(), "ok").otherwise("error")
    entries = judged.select("memory_id", as_of.alias("scanned_at"), status.alias("status"), F.coalesce("flags_written", F.lit(0)).cast("int").alias("flags_written"), "objectives_hash", F.substring("error", 1, 500).alias("error"))
    return new, ledger.upsert_ledger(scanned, entries)


def coverage_rows(report: DataFrame, run_id: str, as_of: Column, window_days: int = 30, linkage_source: str = "both") -> DataFrame:
    """Rows that a run adds to the coverage table, from the report of ``coverage``."""
    start = F.timestamp_seconds(F.unix_timestamp(as_of) - window_days * 86400)
    return align(report.withColumns({"run_id": F.lit(run_id), "window_start": start, "window_end": as_of, "linkage_source": F.lit(linkage_source)}), "objective_coverage")
