"""State changes as new snapshots: upserts, ledgers, guarded updates and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert_edges(existing: DataFrame, pairs: DataFrame, as_of: Column, kind: str = "relates_to", by: str = "cron", refresh_days: int = 7) -> tuple[DataFrame, DataFrame]:
    """The edge table after upserting pairs, and each pair's outcome.

    An existing edge is refreshed only if it lacks a weight or a time, or is older than
    ``refresh_days``; otherwise it is skipped.
    """
    new = pairs.select("source_id", "target_id", F.lit(kind).alias("relationship_type"), F.col("similarity").alias("_weight")).dropDuplicates(["source_id", "target_id"])
    keys = ["source_id", "target_id", "relationship_type"]
    old = existing.select(*keys, "weight", "inferred_at", "inferred_by", F.lit(True).alias("_old"))
    both = old.join(new, keys, "full_outer")
    limit = F.timestamp_seconds(F.unix_timestamp(as_of) - refresh_days * 86400)
    stale = F.col("weight").isNull() | F.col("inferred_at").isNull() | (F.col("inferred_at") < limit)
    outcome = F.when(F.col("_weight").isNull(), F.lit(None)).when(F.col("_old").isNull(), "inserted").when(stale, "refreshed").otherwise("skipped")
    both = both.withColumn("outcome", outcome)
    take = F.col("outcome").isin("inserted", "refreshed")
    tag = F.concat(F.lit(by + "-"), F.date_format(as_of, "yyyy-MM-dd"))
    table = both.select(*keys, F.when(take, F.col("_weight")).otherwise(F.col("weight")).alias("weight"), F.when(take, as_of).otherwise(F.col("inferred_at")).alias("inferred_at"), F.when(take, tag).otherwise(F.col("inferred_by")).alias("inferred_by"))
    return table, both.where("outcome is not null").select(*keys, "outcome")


def apply_boosts(items: DataFrame, updates: DataFrame, lowest: float = 1.0, highest: float = 2.0) -> DataFrame:
    """Items with new boosts within bounds; items without an update keep theirs."""
    u = updates.select("id", F.least(F.lit(highest), F.greatest(F.lit(lowest), F.col("boost"))).alias("_boost"))
    return items.join(u, "id", "left").withColumn("recall_boost", F.coalesce("_boost", "recall_boost")).drop("_boost")


def upsert_ledger(ledger: DataFrame, rows: DataFrame, key: str = "memory_id") -> DataFrame:
    """A ledger after new rows: the new row wins, attempts add up."""
    columns = [c for c in ledger.columns if c not in (key, "attempts")]
    new = rows.select(key, *[F.col(c).alias(f"_{c}") for c in columns if c in rows.columns], F.lit(True).alias("_new"))
    both = ledger.join(new, key, "full_outer")
    pick = lambda c: (F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)) if f"_{c}" in both.columns else F.col(c)).alias(c)
    attempts = (F.coalesce("attempts", F.lit(0)) + F.when(F.col("_new"), 1).otherwise(0)).alias("attempts")
    return both.select(key, *[attempts if c == "attempts" else pick(c) for c in ledger.columns if c != key])


def append_new(existing: DataFrame, rows: DataFrame, key: str = "dedup_key") -> DataFrame:
    """Rows whose key is not there yet, each key once."""
    return rows.dropDuplicates([key]).join(existing.select(key).distinct(), key, "left_anti")


def upsert_summaries(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Action per community ``community_key, members``: insert, update, unchanged or foreign.

    ``existing`` holds ``community_key, members, owned``.  The same members mean nothing
    to do; a summary that is not owned is left alone and counted.
    """
    old = existing.select("community_key", F.array_sort("members").alias("_members"), "owned")
    both = fresh.join(old, "community_key", "left")
    action = F.when(F.col("_members").isNull(), "insert").when(~F.coalesce("owned", F.lit(False)), "foreign").when(F.array_sort("members") == F.col("_members"), "unchanged").otherwise("update")
    return both.select("community_key", "members", action.alias("action"))


def reinforce_registry(groups: DataFrame, nearest: DataFrame, least: float = 0.90) -> DataFrame:
    """What becomes of each qualifying group: reinforce the near entry, or insert a candidate."""
    both = groups.join(nearest, "id", "left")
    near = F.coalesce(F.col("similarity") >= least, F.lit(False))
    return both.select("id", F.when(near, "reinforce").otherwise("insert").alias("action"), F.when(near, F.col("registry_id")).alias("registry_id"), "similarity")


def synthesis_due(registry: DataFrame, as_of: Column, cooldown_days: int = 30, budget: int | None = None) -> DataFrame:
    """Entries due for a text: no text yet, grown or drifted; cooled down; of an open status; the first ``budget`` by size.

    Needs ``id, size, status, doctrine_text, synthesized_at, grew, drifted``.
    """
    cool = F.col("synthesized_at").isNull() | (F.unix_timestamp(as_of) - F.unix_timestamp("synthesized_at") >= cooldown_days * 86400)
    due = registry.where((F.col("doctrine_text").isNull() | F.col("grew") | F.col("drifted")) & cool & ~F.col("status").isin("ratified", "proposed", "rejected", "superseded"))
    return due.orderBy(F.desc("size"), "id").limit(budget) if budget else due


def violations(rows: DataFrame, checks: dict[str, Column], unique: list[str] | None = None) -> DataFrame:
    """Rows that break a check (null counts as passed, as in SQL), with the check's name; and keys that repeat."""
    named = F.array(*[F.when(~condition, name) for name, condition in checks.items()])
    broken = rows.withColumn("violation", F.explode(F.filter(named, lambda x: x.isNotNull())))
    if not unique:
        return broken
    again = rows.groupBy(*unique).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return broken.unionByName(rows.join(again, unique, "left_semi").withColumn("violation", F.lit("unique")))


def job_row(rows: DataFrame, job: str, run_id: str, as_of: Column, status: str = "done", error: str | None = None) -> DataFrame:
    """One ledger row for a run, with the counts of its outcomes."""
    counted = rows.groupBy("outcome").agg(F.count("*").alias("n"))
    counters = F.map_from_entries(F.array_sort(F.collect_list(F.struct("outcome", "n"))))
    return counted.agg(counters.alias("counters")).select(F.lit(job).alias("job"), F.lit(run_id).alias("run_id"), as_of.alias("started_at"), as_of.alias("finished_at"), F.lit(status).alias("status"), "counters", F.lit(error).cast("string").substr(1, 500).alias("error"))
