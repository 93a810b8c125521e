"""Scans of the store: pickers, backlogs and predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import trimmed

#: Source type of generated summaries, which never count as evidence.
SUMMARY = "summary"
#: Curated types of the cluster pool.
CURATED = ("decision", "architecture", "preference", "bug_fix")


def live(prefix: str = "") -> Column:
    """Active, not archived, not superseded (a null flag is not live)."""
    c = lambda n: F.col(prefix + n)
    return c("is_active") & ~c("archived") & c("superseded_by").isNull()


def active(prefix: str = "") -> Column:
    """The reduced form, which ignores supersession."""
    return F.col(prefix + "is_active") & ~F.col(prefix + "archived")


def pick_sessions(sessions: DataFrame, as_of: Column, lookback_hours: int = 72, min_messages: int = 3, max_sessions: int | None = 10) -> DataFrame:
    """Unprocessed sessions that ended within the look-back, with enough messages and a summary; latest first."""
    since = F.timestamp_seconds(F.unix_timestamp(as_of) - lookback_hours * 3600)
    picked = sessions.where(
        F.col("processed_at").isNull() & F.col("ended_at").isNotNull() & (F.col("ended_at") >= since)
        & (F.coalesce("messages_count", F.lit(0)) >= min_messages) & (F.coalesce(F.length(trimmed(F.col("summary"))), F.lit(0)) > 0)
    ).withColumn("created_at", F.coalesce("started_at", "ended_at"))
    return picked.orderBy(F.desc_nulls_last("ended_at"), "id").limit(max_sessions) if max_sessions else picked


def build_signals(sessions: DataFrame) -> DataFrame:
    """A signal per session: key, search text (2000 characters) and description (240)."""
    text = trimmed(F.col("summary"))
    return sessions.where(F.length(text) > 0).select(
        F.concat(F.lit("session:"), F.col("id").cast("string")).alias("signal_key"), F.col("id").alias("session_id"), "project",
        F.substring(text, 1, 2000).alias("search_text"), F.substring(text, 1, 240).alias("description"), F.coalesce("messages_count", F.lit(0)).alias("event_count"), "created_at",
    )


def mark_processed(sessions: DataFrame, picked: DataFrame, as_of: Column) -> DataFrame:
    """The sessions after stamping those that were picked; a second run then picks none of them."""
    ids = picked.select("id").distinct().withColumn("_picked", F.lit(True))
    return sessions.join(ids, "id", "left").withColumn("processed_at", F.when(F.col("_picked"), F.coalesce("processed_at", as_of)).otherwise(F.col("processed_at"))).drop("_picked")


def pool_size(items: DataFrame, types: tuple[str, ...] = CURATED) -> DataFrame:
    return items.where(live() & F.col("source_type").isin(*types)).agg(F.count("*").alias("pool_size"))


def cluster_edges(edges: DataFrame, items: DataFrame, kinds: tuple[str, ...] = ("relates_to", "elaborates"), types: tuple[str, ...] = CURATED) -> DataFrame:
    """Edges of the kinds whose ends are both live and curated."""
    pool = items.where(live() & F.col("source_type").isin(*types)).select("id")
    e = edges.where(F.col("relationship_type").isin(*kinds))
    return e.join(pool.withColumnRenamed("id", "source_id"), "source_id", "left_semi").join(pool.withColumnRenamed("id", "target_id"), "target_id", "left_semi").select("source_id", "target_id", "relationship_type", "weight")


def live_edges(edges: DataFrame, items: DataFrame, as_of: Column, min_weight: float = 0.5, max_edges: int | None = 50_000) -> DataFrame:
    """Edges heavy enough and valid now, between live items that are no summaries; the cap takes the heaviest, then the least ids."""
    e = edges.where(F.coalesce("weight", F.lit(0.5)) >= min_weight)
    if {"valid_at", "invalid_at"} <= set(edges.columns):
        e = e.where(F.col("invalid_at").isNull() & (F.col("valid_at").isNull() | (F.col("valid_at") <= as_of)))
    pool = items.where(live() & (F.col("source_type") != SUMMARY)).select("id")
    e = e.join(pool.withColumnRenamed("id", "source_id"), "source_id", "left_semi").join(pool.withColumnRenamed("id", "target_id"), "target_id", "left_semi")
    e = e.select("source_id", "target_id", "relationship_type", "weight")
    return e.orderBy(F.desc(F.coalesce("weight", F.lit(0.5))), "source_id", "target_id", "relationship_type").limit(max_edges) if max_edges else e


def reinforce_candidates(items: DataFrame, as_of: Column, window_days: int = 90, batch: int | None = 500) -> DataFrame:
    """Items recalled within the window, or still boosted; latest recalled first."""
    since = F.timestamp_seconds(F.unix_timestamp(as_of) - window_days * 86400)
    rows = items.where(((F.col("recall_count") > 0) & (F.col("last_recalled_at") >= since)) | (F.col("recall_boost") > 1.0))
    rows = rows.select("id", "recall_count", "last_recalled_at", "recall_boost")
    return rows.orderBy(F.desc_nulls_last("last_recalled_at"), "id").limit(batch) if batch else rows


def sweep_backlog(items: DataFrame, ledger: DataFrame, as_of: Column, days: int = 30, min_chars: int = 80, max_attempts: int = 3, excluded: tuple[str, ...] = (SUMMARY,), limit: int | None = 150) -> DataFrame:
    """Recent active items with enough text that were never swept, or failed fewer than ``max_attempts`` times; newest first."""
    since = F.timestamp_seconds(F.unix_timestamp(as_of) - days * 86400)
    rows = items.where(active() & (F.col("created_at") > since) & ~F.col("source_type").isin(*excluded) & (F.length(F.trim("content")) >= min_chars))
    seen = ledger.select(F.col("memory_id").alias("id"), F.col("status").alias("_status"), F.col("attempts").alias("_attempts"))
    rows = rows.join(seen, "id", "left").where(F.col("_status").isNull() | ((F.col("_status") == "error") & (F.col("_attempts") < max_attempts)))
    rows = rows.select("id", "content", "project", "created_at", F.get_json_object("metadata", "$.problem_signature.class").alias("problem_class"))
    return rows.orderBy(F.desc("created_at"), "id").limit(limit) if limit else rows


def contradiction_backlog(items: DataFrame, scanned: DataFrame, hashes: DataFrame, as_of: Column, types: tuple[str, ...] = ("decision", "architecture", "preference"), days: int = 14, min_chars: int = 40, max_attempts: int = 3, limit: int | None = 60) -> DataFrame:
    """Recent live items of judged types in projects with objectives: unjudged, retryable, or judged against other objectives.

    ``hashes`` holds ``project, objectives_hash``; ``scanned`` holds ``memory_id, status,
    attempts, objectives_hash``.
    """
    since = F.timestamp_seconds(F.unix_timestamp(as_of) - days * 86400)
    rows = items.where(live() & F.col("source_type").isin(*types) & (F.col("created_at") > since) & (F.length(F.trim("content")) >= min_chars)).join(hashes, "project")
    s = scanned.select(F.col("memory_id").alias("id"), F.col("status").alias("_status"), F.col("attempts").alias("_attempts"), F.col("objectives_hash").alias("_hash"))
    rows = rows.join(s, "id", "left").where(F.col("_status").isNull() | ((F.col("_status") == "error") & (F.col("_attempts") < max_attempts)) | ~F.col("_hash").eqNullSafe(F.col("objectives_hash")))
    rows = rows.select("id", "project", "content", "source_type", "created_at", "objectives_hash")
    return rows.orderBy(F.desc("created_at"), "id").limit(limit) if limit else rows


def claim_batch(inbox: DataFrame, as_of: Column, batch: int | None = 25, lease_minutes: int = 10) -> DataFrame:
    """The oldest pending rows without a running lease, stamped with a new one; all of them, unordered, where ``batch`` is None."""
    before = F.timestamp_seconds(F.unix_timestamp(as_of) - lease_minutes * 60)
    free = inbox.where((F.col("status") == "pending") & (F.col("claimed_at").isNull() | (F.col("claimed_at") < before)))
    return (free if batch is None else free.orderBy("created_at", "id").limit(batch)).withColumn("claimed_at", as_of)


def promoted_counts(inbox: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    since = F.timestamp_seconds(F.unix_timestamp(as_of) - hours * 3600)
    agent = F.lower(F.trim("source_agent"))
    return inbox.where((F.col("status") == "promoted") & (F.col("created_at") >= since)).groupBy(agent.alias("agent")).agg(F.count("*").alias("promoted"))


def incremental_watermark(edges: DataFrame, prefix: str = "cron-") -> DataFrame:
    return edges.where(F.col("inferred_by").ilike(prefix + "%")).agg(F.max("inferred_at").alias("since"))


def safe_identifier(name: str | None, default: str) -> str:
    """A configured table or column name if it is a plain lower-case identifier, else the default."""
    name = (name or "").strip()
    return name if re.fullmatch(r"[a-z_][a-z0-9_]{0,62}", name) else default


def community_members(items: DataFrame, communities: DataFrame) -> DataFrame:
    """Rows ``community_key, id, content, project, created_at, place`` of members that are still live, oldest first."""
    rows = communities.select("community_key", F.explode("members").alias("id")).join(items.where(live()).select("id", "content", "project", "created_at"), "id")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("community_key").orderBy("created_at", "id")))


def normalize_objectives(objectives: DataFrame) -> DataFrame:
    """Objectives with text, cut to 1000 characters, whole-number ranks and a status.

    The rows have no order; a reader that shows them sorts by project, rank (nulls last) and text.
    """
    text = F.substring(trimmed(F.col("content")), 1, 1000)
    rank = F.expr("try_cast(rank as int)")
    return objectives.where(F.length(text) > 0).select("id", "project", rank.alias("rank"), text.alias("content"), F.coalesce("status", F.lit("active")).alias("status"), "ratified_at")
