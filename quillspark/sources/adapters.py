"""The driver's tables seen as the store's tables, by fixed rules.

Every rule is plain arithmetic on ids, so that any SQL engine can state it too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.sources.tables import load

#: The clock of all queries: nothing reads the current time.
AS_OF = "2024-01-31 00:00:00"


def at(text: str = AS_OF) -> Column:
    return F.lit(text).cast("timestamp")


def seconds(base: Column, amount: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(base) + amount)


def memory_items(spark: SparkSession, base: str, embeddings: bool = False) -> DataFrame:
    d = load(spark, base, "documents")
    i = F.col("doc_id")
    created = seconds(at("2024-01-01 00:00:00"), (i * 37 % 43200) * 60)
    items = d.select(
        i.alias("id"),
        F.col("text").alias("content"),
        F.when(i % 29 == 0, "summary").otherwise(F.element_at(F.array(*map(F.lit, ("decision", "architecture", "preference", "bug_fix", "fact"))), (i % 5 + 1).cast("int"))).alias("source_type"),
        F.when(i % 13 == 0, "").otherwise(F.col("source")).alias("project"),
        created.alias("created_at"),
        seconds(created, i % 7 * 3600).alias("updated_at"),
        (i % 11 != 0).alias("is_active"),
        (i % 17 == 0).alias("archived"),
        F.when(i % 19 == 0, i + 1).alias("superseded_by"),
        F.md5("text").alias("content_hash"),
        F.concat(F.lit('{"problem_signature":{"class":"class'), (i % 8).cast("string"), F.lit('"},"objectives":["'), (i % 40).cast("string"), F.lit('"]}')).alias("metadata"),
        (i % 9).cast("int").alias("recall_count"),
        F.when(i % 4 != 0, seconds(at(), -(i % 120) * 86400)).alias("last_recalled_at"),
        (1.0 + (i % 6) * 0.2).alias("recall_boost"),
    )
    if embeddings:
        e = load(spark, base, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
        items = items.join(e, "id", "left")
    return items


def memory_sessions(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "conversations")
    s = c.groupBy(F.col("conv_id").alias("id")).agg(F.count("*").cast("int").alias("messages_count"), F.min(F.when(F.col("role") == "user", F.struct("turn", "text")))["text"].alias("summary"))
    i = F.col("id")
    ended = F.when(i % 23 != 0, seconds(at(), -(i % 100) * 3600))
    return s.select(
        "id", F.concat(F.lit("src"), (i % 20).cast("string")).alias("project"), "summary", "messages_count", ended.alias("ended_at"),
        F.when(i % 5 != 0, seconds(ended, F.lit(-3600))).alias("started_at"), F.when(i % 7 == 0, at()).alias("processed_at"),
    )


def neighbourly_embeddings(spark: SparkSession, base: str) -> DataFrame:
    """Vectors ``id, embedding`` that lie together by fives: each row's vector, weighed 0.35, on that of the least id of its five."""
    e = load(spark, base, "embeddings").select("vec_id", "embedding")
    lead = e.select(F.col("vec_id").alias("lead"), F.col("embedding").alias("base"))
    both = e.withColumn("lead", F.col("vec_id") - F.col("vec_id") % 5).join(lead, "lead")
    return both.select(F.col("vec_id").alias("id"), F.zip_with("embedding", "base", lambda x, y: x.cast("double") * 0.35 + y.cast("double")).alias("embedding"))


def session_embeddings(spark: SparkSession, base: str) -> DataFrame:
    """A session's embedding is the vector of its id; sessions of other ids have none."""
    return load(spark, base, "embeddings").select(F.col("vec_id").alias("session_id"), "embedding")


def memory_recall_log(spark: SparkSession, base: str) -> DataFrame:
    e = load(spark, base, "events")
    return e.select(F.col("user_id").alias("memory_id"), F.col("event_type").isin("click", "purchase").alias("cited"), F.col("ts").cast("timestamp").alias("created_at"), F.col("value").alias("score"), F.col("event_type").alias("surface"))


#: Agents of the inbox adapter; the first four are the ones gates let through by default.
AGENTS = ("web-one", "web-two", "web-three", "web-four", "desktop", " WEB-ONE ")


def memory_inbox(spark: SparkSession, base: str) -> DataFrame:
    d = load(spark, base, "documents")
    i = F.col("doc_id")
    return d.select(
        i.alias("id"),
        seconds(at("2024-01-20 00:00:00"), (i * 53 % 14400) * 60).alias("created_at"),
        F.element_at(F.array(*map(F.lit, AGENTS)), (i % 6 + 1).cast("int")).alias("source_agent"),
        F.when(i % 8 == 0, "").when(i % 8 == 1, F.repeat(F.lit("p"), 130)).otherwise(F.concat(F.lit(" "), F.col("source"))).alias("project_hint"),
        "text",
        F.when(i % 4 == 3, "promoted").otherwise("pending").alias("status"),
        F.when(i % 10 == 0, seconds(at(), -(i % 30) * 60)).alias("claimed_at"),
        (i % 7).cast("int").alias("attempts"),
        F.when(i % 31 == 0, F.concat(F.lit('{"x":"'), F.repeat(F.lit("y"), 9000), F.lit('"}'))).otherwise("{}").alias("metadata"),
    )


def memory_objectives(spark: SparkSession, base: str) -> DataFrame:
    b = load(spark, base, "benchmark")
    i = F.col("item_id")
    return b.select(
        i.alias("id"), F.concat(F.lit("src"), (i % 20).cast("string")).alias("project"), F.when(i % 7 != 0, (i % 5).cast("int")).alias("rank"), F.col("text").alias("content"),
        F.when(i % 9 == 0, "superseded").when(i % 9 != 1, "active").alias("status"), F.when(i % 6 != 0, seconds(at("2023-01-01 00:00:00"), i * 20 * 86400)).alias("ratified_at"),
    )


def sweep_ledger(spark: SparkSession, base: str) -> DataFrame:
    """A ledger that has seen two thirds of the items, with errors and attempts."""
    d = load(spark, base, "documents").select(F.col("doc_id").alias("memory_id"))
    i = F.col("memory_id")
    return d.where(i % 3 != 0).select("memory_id", F.when(i % 5 == 0, "error").otherwise("done").alias("status"), (i % 4 + 1).cast("int").alias("attempts"), (i % 3).cast("int").alias("yields"))


def memory_relationships(spark: SparkSession, base: str) -> DataFrame:
    """Edges from each item to a later one, of three kinds, some without weight or time."""
    d = load(spark, base, "documents").select(F.col("doc_id").alias("source_id"))
    i = F.col("source_id")
    kinds = F.array(*map(F.lit, ("relates_to", "elaborates", "same_pattern_as")))
    return d.select(
        "source_id", (i + i % 5 + 1).alias("target_id"), F.element_at(kinds, (i % 3 + 1).cast("int")).alias("relationship_type"),
        F.when(i % 10 != 0, (i % 100) / 100).alias("weight"), F.when(i % 8 != 0, seconds(at(), -(i % 20) * 86400)).alias("inferred_at"),
        F.when(i % 2 == 0, "cron-2024-01-20").otherwise("manual").alias("inferred_by"),
        F.when(i % 6 == 0, seconds(at(), (i % 3 - 1) * 86400)).alias("valid_at"), F.when(i % 15 == 0, at()).alias("invalid_at"),
    )
