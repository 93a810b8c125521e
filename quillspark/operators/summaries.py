"""Summaries of communities: which are asked for, what is written, and what is left alone because it isn't ours."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import json_merged, trimmed
from quillspark.operators.scans import SUMMARY, live
from quillspark.runtime import Stash

#: The kind that marks a community's summary in its row's metadata, and where a summary of several projects is filed.
KIND, SEVERAL = "community_summary", "global"
_PATH = "$.consolidation"


def owned() -> Column:
    """Whether an item is a summary that this job wrote: by its type and by its metadata, both."""
    return F.coalesce((F.col("source_type") == SUMMARY) & (F.get_json_object("metadata", f"{_PATH}.kind") == KIND), F.lit(False))


def existing_summaries(items: DataFrame) -> DataFrame:
    """``community_key, summary_id, members, owned`` of the items whose metadata make them a community's summary.

    Any item of that kind holds its key, an item that isn't owned too.  Of several with
    one key an owned one counts before others, then the least id.
    """
    kind = items.where(F.get_json_object("metadata", f"{_PATH}.kind") == KIND)
    key = F.get_json_object("metadata", f"{_PATH}.community_key").try_cast("bigint")
    ids = F.coalesce(F.from_json(F.get_json_object("metadata", f"{_PATH}.member_ids"), "array<bigint>"), F.array().cast("array<bigint>"))
    rows = kind.select(key.alias("community_key"), F.col("id").alias("summary_id"), ids.alias("members"), owned().alias("owned")).where("community_key is not null")
    return rows.groupBy("community_key").agg(F.min_by(F.struct("summary_id", "members", "owned"), F.struct(~F.col("owned"), F.col("summary_id"))).alias("s")).select("community_key", "s.*")


def summary_plan(items: DataFrame, communities: DataFrame, least: int = 4, max_calls: int | None = 40) -> DataFrame:
    """What is to be done about each community ``community_key, n, members``: its rows with ``action, summary_id, live, projects, lines``.

    ``unchanged``: an owned summary has the same members, so nothing is asked.
    ``foreign``: the key is held by an item that isn't owned.  ``shrunk``: fewer than
    ``least`` members are still live.  ``deferred``: beyond ``max_calls``, largest
    communities first.  Else ``update`` or ``insert``; only these are asked for, with their
    live members, oldest first, as ``lines``.
    """
    found = communities.join(existing_summaries(items).withColumnRenamed("members", "_members"), "community_key", "left")
    same = F.array_sort("members") == F.array_sort("_members")
    first = F.when(F.col("owned") & same, "unchanged").when(F.col("summary_id").isNotNull() & ~F.col("owned"), "foreign")
    found = found.withColumn("action", first)
    open_ = found.where("action is null").select("community_key", F.explode("members").alias("id"))
    mine = items.where(live()).select("id", "content", "source_type", "project", "created_at").join(open_, "id")
    project = F.when(F.col("project") != "", F.col("project"))
    line = F.concat(F.lit("("), F.col("source_type"), F.coalesce(F.concat(F.lit(", "), project), F.lit("")), F.lit(") "), F.substring("content", 1, 600))
    read = mine.groupBy("community_key").agg(F.count("*").alias("live"), F.array_sort(F.collect_set(project)).alias("projects"), F.transform(F.array_sort(F.collect_list(F.struct("created_at", "id", line.alias("line")))), lambda r: r["line"]).alias("lines"))
    both = found.join(read, "community_key", "left")
    both = both.withColumn("action", F.when(F.col("action").isNotNull(), F.col("action")).when(F.coalesce("live", F.lit(0)) < least, "shrunk").when(F.col("summary_id").isNotNull(), "update").otherwise("insert"))
    asks = F.col("action").isin("update", "insert")
    if max_calls is not None:  # communities are a budgeted few by now
        turn = F.sum(asks.cast("int")).over(Window.orderBy(F.desc("n"), "community_key").rowsBetween(Window.unboundedPreceding, 0))
        both = both.withColumn("action", F.when(asks & (turn > max_calls), "deferred").otherwise(F.col("action")))
    return both.select("community_key", "n", "members", "action", "summary_id", "live", "projects", "lines")


def prompts(plan: DataFrame) -> DataFrame:
    """``community_key, prompt`` of the communities to ask for."""
    body = F.array_join(F.transform("lines", lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), x)), "\n\n")
    return plan.where(F.col("action").isin("update", "insert")).select("community_key", F.concat(F.lit("Say in a few sentences what these notes have in common.\n\n"), body).alias("prompt"))


def summaries_after(items: DataFrame, plan: DataFrame, replies: DataFrame, as_of: Column, version: int = 1) -> tuple[DataFrame, DataFrame]:
    """The items after the summaries were written, and ``community_key, action, summary_id`` of every community.

    ``replies`` hold ``community_key, reply`` and may hold ``embedding``; an empty or
    missing reply is ``failed`` and writes nothing.  An update changes text, metadata
    (the other fields stay), project and time of an item only if it is owned in the items
    at hand, else it is ``foreign``; its embedding stays where there is no new one.  A
    new summary gets its community's key plus one plus the largest id there is.
    """
    stash = Stash(items.sparkSession, "summaries")
    kind = items.schema["embedding"].dataType.simpleString()
    given = replies.withColumn("embedding", F.lit(None)) if "embedding" not in replies.columns else replies
    said = given.select("community_key", trimmed(F.coalesce("reply", F.lit(""))).alias("_text"), F.col("embedding").cast(kind).alias("_embedding")).where(F.length("_text") > 0)
    rows = plan.join(said, "community_key", "left").join(items.select(F.col("id").alias("summary_id"), owned().alias("_owned")), "summary_id", "left")
    asks = F.col("action").isin("update", "insert")
    action = F.when(~asks, F.col("action")).when(F.col("_text").isNull(), "failed").when((F.col("action") == "update") & ~F.coalesce("_owned", F.lit(False)), "foreign").otherwise(F.col("action"))
    first = items.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("first")).scalar()
    rows = rows.withColumn("action", action).withColumn("summary_id", F.when(F.col("action") == "insert", first + 1 + F.col("community_key")).otherwise(F.col("summary_id")))
    note = F.to_json(F.struct(F.struct(
        F.lit(KIND).alias("kind"), F.lit(version).alias("version"), F.col("community_key").alias("community_key"), F.col("members").alias("member_ids"), F.col("live").alias("member_count"), F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"),
    ).alias("consolidation")))
    project = F.when(F.size("projects") == 1, F.col("projects")[0]).otherwise(SEVERAL)
    written = stash.put(rows.where(F.col("action").isin("update", "insert")).select(F.col("summary_id").alias("id"), F.col("action").alias("_action"), "_text", "_embedding", project.alias("_project"), note.alias("_note")))
    changed = items.join(written.where("_action = 'update'"), "id", "left")
    hit = F.col("_action").isNotNull()
    change = {"content": F.col("_text"), "project": F.col("_project"), "metadata": json_merged(F.col("metadata"), F.col("_note")), "embedding": F.coalesce("_embedding", "embedding"), "updated_at": as_of, "content_hash": F.md5("_text")}
    after = changed.select(*[(F.when(hit, change[c]).otherwise(F.col(c)) if c in change else F.col(c)).alias(c) for c in items.columns])
    new = written.where("_action = 'insert'").select("id", F.col("_text").alias("content"), F.lit(SUMMARY).alias("source_type"), F.col("_project").alias("project"), F.col("_note").alias("metadata"), F.col("_embedding").alias("embedding"),
        as_of.alias("created_at"), as_of.alias("updated_at"), F.lit(True).alias("is_active"), F.lit(False).alias("archived"), F.md5("_text").alias("content_hash"))
    new = new.select(*[c for c in new.columns if c in items.columns])
    return after.unionByName(new, allowMissingColumns=True), rows.select("community_key", "action", "summary_id")


def summarize(items: DataFrame, communities: DataFrame, as_of: Column, ask: Callable[[DataFrame], DataFrame], least: int = 4, max_calls: int | None = 40) -> tuple[DataFrame, DataFrame]:
    """Plan, ask and write in one; ``ask`` gets ``community_key, prompt`` and returns ``community_key, reply`` (and ``embedding``)."""
    stash = Stash(items.sparkSession, "summaries")
    plan = stash.put(summary_plan(items, communities, least, max_calls))
    return summaries_after(items, plan, stash.put(ask(prompts(plan))), as_of)
