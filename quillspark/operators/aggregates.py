"""Tallies, histograms, scores and text statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.scoring import confidence, recall_boost
from quillspark.functions.text import age_days, collapsed, fnv1a, fraction_days, jaccard, token_set
from quillspark.operators.scans import active


def recall_tally(log: DataFrame, as_of: Column, window_days: int = 90) -> DataFrame:
    """Cited and surfaced recalls of each memory within the window."""
    since = F.timestamp_seconds(F.unix_timestamp(as_of) - window_days * 86400)
    return log.where((F.col("created_at") >= since) & F.col("memory_id").isNotNull()).groupBy("memory_id").agg(F.count_if("cited").alias("cited_count"), F.count("*").alias("surfaced_count"))


def boosts(candidates: DataFrame, tally: DataFrame, as_of: Column, epsilon: float = 0.005) -> DataFrame:
    """New boosts of candidates, those that move by ``epsilon`` or more."""
    rows = candidates.join(tally.withColumnRenamed("memory_id", "id"), "id", "left")
    days = F.greatest(F.lit(0.0), fraction_days(F.col("last_recalled_at"), as_of))
    days = F.when(F.col("last_recalled_at").isNotNull(), days)
    boost = recall_boost(F.col("recall_count"), F.col("cited_count"), F.col("surfaced_count"), days, F.col("recall_boost"))
    out = rows.select("id", F.coalesce("cited_count", F.lit(0)).alias("cited_count"), F.coalesce("surfaced_count", F.lit(0)).alias("surfaced_count"), F.col("recall_boost").alias("previous"), boost.alias("boost"))
    return out.where(F.abs(F.col("boost") - F.coalesce("previous", F.lit(1.0))) >= epsilon)


def score_quantiles(log: DataFrame, quantiles: tuple[float, ...] = (0, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0), below: float = 0.4, without: str = "graph") -> DataFrame:
    """Exact quantiles of logged scores, for new knots."""
    rows = log.where(F.col("score").isNotNull() & (F.col("score") < below) & (F.col("surface") != without))
    return rows.agg(F.percentile("score", F.array(*map(F.lit, map(float, quantiles)))).alias("v")).select(F.explode(F.arrays_zip(F.array(*map(F.lit, map(float, quantiles))).alias("q"), F.col("v").alias("v"))).alias("z")).select(F.col("z.q").alias("q"), F.col("z.v").alias("score"))


def distinct_clusters(related: DataFrame, key: str, content: str = "content", threshold: float = 0.85) -> DataFrame:
    """How many different texts each key's rows hold, near copies counted once: ``key, n, distinct``.

    ``related`` holds a few rows a key (the top hits of a search).  Equal or nearly equal
    texts are joined and their components counted, all within the key's own row: each
    text joins the clusters that hold one like it into one.
    """
    texts = related.select(F.col(key).alias("key"), F.struct("id", collapsed(F.col(content)).alias("text"), token_set(F.col(content)).alias("tokens")).alias("row"))
    rows = texts.groupBy("key").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    at = lambda i: F.element_at("rows", i)
    same = lambda i, j: F.coalesce((at(i)["text"] == at(j)["text"]) | (jaccard(at(i)["tokens"], at(j)["tokens"]) >= threshold), F.lit(False))
    like = lambda c, i: F.exists(c, lambda j: same(i, j))
    joined = lambda acc, i: F.concat(F.filter(acc, lambda c: ~like(c, i)), F.array(F.array_append(F.flatten(F.filter(acc, lambda c: like(c, i))), i)))
    clusters = F.aggregate(F.sequence(F.lit(1), F.size("rows")), F.array().cast("array<array<int>>"), joined)
    return rows.select("key", F.size("rows").cast("long").alias("n"), F.size(clusters).cast("long").alias("distinct"))


def insight_confidence(related: DataFrame) -> DataFrame:
    """Confidence of each signal from its related items ``signal_key, id, content, project, created_at, similarity``."""
    clusters = distinct_clusters(related, "signal_key").withColumnRenamed("key", "signal_key")
    stats = related.groupBy("signal_key").agg(
        F.max("similarity").alias("best"), F.countDistinct(F.when(F.col("project") != "", F.col("project"))).alias("projects"),
        ((F.unix_timestamp(F.max("created_at")) - F.unix_timestamp(F.min("created_at"))) / 86400).alias("spread"),
    )
    both = stats.join(clusters, "signal_key")
    return both.select("signal_key", "n", "distinct", confidence(F.col("best"), F.col("projects"), F.col("spread"), F.col("n"), F.col("distinct")).alias("confidence"))


def objective_fingerprints(objectives: DataFrame) -> DataFrame:
    """A hash per project that changes with any of its active objectives (a handful each)."""
    ratified = F.date_format("ratified_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    line = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (F.col("id").cast("string"), ratified, F.col("rank").cast("string"), F.col("content"))])
    grouped = objectives.where(F.col("status") == "active").groupBy("project").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    return grouped.select("project", F.concat(F.lit("fnv1a:"), fnv1a(F.array_join("lines", "|")), F.lit(":"), F.size("lines").cast("string")).alias("objectives_hash"))


def linkage(items: DataFrame, edges: DataFrame, objectives: DataFrame, source: str = "both") -> DataFrame:
    """Links ``memory_id, objective_id`` by edges (either end), by ``objectives`` in metadata, by both, or by none."""
    goals = objectives.where(F.col("id").isNotNull()).select(F.col("id").alias("objective_id")).distinct()
    ends = lambda a, b: edges.select(F.col(a).alias("memory_id"), F.col(b).alias("objective_id"))
    own = items.select(F.col("id").alias("memory_id"), F.explode(F.from_json(F.get_json_object("metadata", "$.objectives"), "array<string>")).alias("v")).select("memory_id", F.expr("try_cast(v as bigint)").alias("objective_id"))
    by_edges = ends("source_id", "target_id").unionByName(ends("target_id", "source_id")).join(items.select(F.col("id").alias("memory_id")), "memory_id", "left_semi")
    rows = {"edges": by_edges, "metadata": own, "both": by_edges.unionByName(own), "none": own.where("false")}[source]
    return rows.join(goals, "objective_id", "left_semi").select("memory_id", "objective_id").distinct()


def ranked_objectives(objectives: DataFrame) -> DataFrame:
    """Active objectives of each project in the order they are shown: by rank, those without one last, then by text."""
    order = Window.partitionBy("project").orderBy(F.asc_nulls_last("rank"), "content", "id")
    return objectives.where(F.col("status") == "active").withColumn("place", F.row_number().over(order))


def coverage(items: DataFrame, objectives: DataFrame, links: DataFrame, as_of: Column, window_days: int = 30, min_writes: int = 20, linkage: bool = True) -> DataFrame:
    """Coverage and drift of each project with active objectives.

    ``links`` holds ``memory_id, objective_id``.  Drift has three values: null means
    undetermined (no linkage, or objectives without ids).
    """
    since = F.timestamp_seconds(F.unix_timestamp(as_of) - window_days * 86400)
    goals = objectives.where(F.col("status") == "active")
    per = goals.groupBy("project").agg(F.count("*").alias("objective_count"), F.count("id").alias("with_id"))
    linked = links.join(goals.select(F.col("id").alias("objective_id"), F.col("project").alias("project")), "objective_id").select("memory_id", "project").distinct().withColumn("hit", F.lit(1))
    recent = items.where(active() & (F.col("created_at") > since)).select(F.col("id").alias("memory_id"), "project")
    counted = recent.join(linked, ["memory_id", "project"], "left").groupBy("project").agg(F.count("*").alias("writes"), F.count("hit").alias("linked"))
    rows = per.join(counted, "project", "left").withColumn("writes", F.coalesce("writes", F.lit(0))).withColumn("linked", F.coalesce("linked", F.lit(0)))
    sure = F.lit(linkage) & (F.col("with_id") > 0)
    drift = F.when(~sure, F.lit(None).cast("boolean")).when(F.col("writes") < min_writes, False).when(F.col("linked") == 0, True).otherwise(False)
    reason = F.when(F.lit(not linkage), "links are not kept").when(~sure, "objectives lack ids").when(F.col("writes") < min_writes, f"fewer than {min_writes} new items").when(F.col("linked") == 0, "nothing new serves an objective").otherwise("in use")
    note = F.format_string("%s (%d new, %d linked, %d objectives)", reason, "writes", "linked", "objective_count")
    ratio = F.when(sure & (F.col("writes") > 0), F.round(F.col("linked") / F.col("writes"), 4))
    return rows.select("project", "objective_count", "writes", F.col("linked").alias("linked_writes"), ratio.alias("coverage_ratio"), drift.alias("drift"), note.alias("note"))


def stale_objectives(objectives: DataFrame, as_of: Column, stale_days: int = 180, flag_unratified: bool = False) -> DataFrame:
    """Flags for active objectives ratified long ago (severity by age), or never if asked for."""
    age = age_days(F.col("ratified_at"), as_of)
    rows = objectives.where(F.col("status") == "active").withColumn("age_days", F.when(F.col("ratified_at").isNotNull(), age))
    kind = F.when(F.col("age_days") >= stale_days, "stale").when(F.col("ratified_at").isNull() & F.lit(flag_unratified), "unratified")
    severity = F.when(F.col("age_days") >= 2 * stale_days, "high").otherwise("medium")
    key = F.concat_ws(":", F.lit("staleness"), "project", F.col("id").cast("string"), F.coalesce(F.unix_timestamp("ratified_at").cast("string"), F.lit("never")))
    return rows.withColumn("kind", kind).where("kind is not null").select(key.alias("dedup_key"), "project", F.col("id").alias("objective_id"), "kind", "age_days", severity.alias("severity"))


def cross_project_patterns(items: DataFrame) -> DataFrame:
    """Source types seen in two projects or more."""
    rows = items.where(F.col("project") != "").groupBy("source_type").agg(F.countDistinct("project").alias("projects"), F.count("*").alias("n"))
    return rows.where("projects >= 2")


def sweep_board(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count("*").alias("n"), F.sum("yields").alias("yields"), F.max("attempts").alias("max_attempts"))


def duplicate_entities(entities: DataFrame, limit: int | None = 200) -> DataFrame:
    """Each entity with the one it merges into: the oldest of its type and key; groups of one are left out."""
    oldest = entities.groupBy("entity_type", "entity_key").agg(F.min(F.struct("first_seen_at", "id"))["id"].alias("canonical_id"), F.count("*").alias("n")).where("n > 1")
    if limit:
        oldest = oldest.orderBy("entity_type", "entity_key").limit(limit)
    return entities.join(oldest, ["entity_type", "entity_key"]).where("id <> canonical_id").select("id", "canonical_id", "entity_type", "entity_key")


def merge_mentions(mentions: DataFrame, merges: DataFrame) -> DataFrame:
    """Mentions re-pointed to canonical entities, each once."""
    m = merges.select(F.col("id").alias("entity_id"), "canonical_id")
    return mentions.join(m, "entity_id", "left").select(F.coalesce("canonical_id", "entity_id").alias("entity_id"), "memory_id").distinct()


def same_class_edges(items: DataFrame, cap: int = 5, weight: float = 0.9) -> DataFrame:
    """Edges between items of one project and problem class, to at most ``cap`` of the most recent others.

    Only each group's ``cap + 1`` most recent can be targets, and these are found by a
    partially aggregated ranking, so a group of any size costs ``cap + 1`` rows an item.
    """
    rows = items.where(F.col("problem_class").isNotNull()).select("id", "project", "problem_class", F.unix_micros("created_at").alias("t"))
    salted = Window.partitionBy("project", "problem_class", F.pmod(F.xxhash64("id"), F.lit(32))).orderBy(F.desc("t"), "id")
    few = rows.withColumn("k", F.row_number().over(salted)).where(F.col("k") <= cap + 1)
    order = Window.partitionBy("project", "problem_class").orderBy(F.desc("t"), "id")
    targets = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= cap + 1).select("project", "problem_class", F.col("id").alias("target_id"), "k")
    own = targets.select("project", "problem_class", F.col("target_id").alias("id"), F.col("k").alias("own_k"))
    pairs = rows.join(targets, ["project", "problem_class"]).where("id <> target_id").join(own, ["project", "problem_class", "id"], "left")
    rank = F.when(F.col("own_k").isNull() | (F.col("k") < F.col("own_k")), F.col("k")).otherwise(F.col("k") - 1)
    return pairs.where(rank <= cap).select(F.col("id").alias("source_id"), "target_id", F.lit("same_pattern_as").alias("relationship_type"), F.lit(weight).alias("weight"))
