"""Replies of injected models, parsed and policed in the engine.

A reply is text that should hold JSON.  What cannot be parsed, names things it was not
shown, or lacks what it must have is no verdict; gates treat that as a refusal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import truncated, trimmed, without_fence

#: Kinds of edges a classifier may name, source types it may suggest, and caps on what one reply may hold.
EDGE_KINDS = ("supersedes", "relates_to", "contradicts", "elaborates", "caused_by", "blocks", "inspired_by", "cross_project_link")
SOURCE_TYPES = ("fact", "decision", "preference", "bug_fix", "architecture", "code_context")
MAX_FLAGS, MAX_EVIDENCE, MAX_HINTS, MAX_ENTITIES, MAX_TRIPLES = 3, 20, 8, 12, 12


def parsed(reply: Column, schema: str) -> Column:
    """The reply's JSON object by a schema; null if there is none or it doesn't fit.

    Line ends inside strings are let pass; where the text is no JSON as it stands, commas
    before a closing bracket are taken out first.
    """
    body = F.nullif(without_fence(reply), F.lit(""))
    mended = F.when(F.try_parse_json(body).isNull(), F.regexp_replace(body, r",\s*([\]}])", "$1")).otherwise(body)
    return F.from_json(mended, schema, {"mode": "PERMISSIVE", "allowUnquotedControlChars": "true"})


def short(text: Column, n: int) -> Column:
    return F.substring(trimmed(F.coalesce(text, F.lit(""))), 1, n)


def edge_kinds(replies: DataFrame) -> DataFrame:
    """The first word of each ``reply`` if it is a kind of edge, else null, as ``kind``."""
    token = F.split(F.lower(trimmed(F.col("reply"))), r"\s+")[0]
    return replies.withColumn("kind", F.when(token.isin(*EDGE_KINDS), token))


def levels(replies: DataFrame) -> DataFrame:
    """``id, level, rationale, source_type`` of gate replies; an unknown level is null, an unknown type is ``fact``."""
    v = parsed(F.col("reply"), "verdict string, rationale string, suggested_source_type string")
    kind = F.lower(F.trim(v["suggested_source_type"]))
    return replies.select("id", F.when(v["verdict"].isin("kitchen", "recipe"), v["verdict"]).alias("level"), short(v["rationale"], 500).alias("rationale"), F.when(kind.isin(*SOURCE_TYPES), kind).otherwise("fact").alias("source_type"))


def contradictions(replies: DataFrame, shown: DataFrame) -> DataFrame:
    """Flags ``memory_id, objective_key, objective_id, severity, rationale, gist`` of judges' replies ``memory_id, reply``.

    A flag must name an objective that was ``shown`` (``memory_id, objective_id``, or with
    the ``objective_key`` that it was shown by) and give a reason; each objective once,
    ``MAX_FLAGS`` at most, in the reply's order.  An unknown severity is medium.
    """
    if "objective_key" not in shown.columns:
        shown = shown.withColumn("objective_key", F.col("objective_id").cast("string"))
    v = parsed(F.col("reply"), "contradictions array<struct<objective_id:string,severity:string,rationale:string,gist:string>>")
    rows = replies.select("memory_id", F.posexplode(v["contradictions"]).alias("at", "c"))
    severity = F.lower(F.trim("c.severity"))
    rows = rows.select("memory_id", "at", F.trim("c.objective_id").alias("objective_key"), F.when(severity.isin("high", "low"), severity).otherwise("medium").alias("severity"), short(F.col("c.rationale"), 800).alias("rationale"), short(F.col("c.gist"), 300).alias("gist"))
    known = shown.select("memory_id", "objective_key", "objective_id").dropDuplicates(["memory_id", "objective_key"])
    rows = rows.where(F.length("rationale") > 0).join(known, ["memory_id", "objective_key"])
    once = rows.withColumn("k", F.row_number().over(Window.partitionBy("memory_id", "objective_key").orderBy("at"))).where("k = 1")
    few = once.withColumn("k", F.row_number().over(Window.partitionBy("memory_id").orderBy("at")))
    return few.where(F.col("k") <= MAX_FLAGS).drop("k", "at")


def extractions(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities and triples of extraction replies ``memory_id, reply``, those that are complete, up to their caps."""
    v = parsed(F.col("reply"), "entities array<struct<name:string,type:string,span:string,confidence:double>>, triples array<struct<subject:string,predicate:string,object:string>>")
    entity = F.filter(v["entities"], lambda e: (F.length(F.coalesce(F.trim(e["name"]), F.lit(""))) > 0) & (F.length(F.coalesce(F.trim(e["type"]), F.lit(""))) > 0))
    triple = F.filter(v["triples"], lambda t: t["subject"].isNotNull() & t["predicate"].isNotNull() & t["object"].isNotNull())
    entities = replies.select("memory_id", F.explode(F.slice(entity, 1, MAX_ENTITIES)).alias("e")).select("memory_id", F.trim("e.name").alias("name"), F.trim("e.type").alias("type"), F.substring("e.span", 1, 200).alias("span"), "e.confidence")
    triples = replies.select("memory_id", F.explode(F.slice(triple, 1, MAX_TRIPLES)).alias("t")).select("memory_id", F.trim("t.subject").alias("subject"), F.trim("t.predicate").alias("predicate"), F.trim("t.object").alias("object"))
    return entities, triples


def by_vocabulary(rows: DataFrame, vocabulary: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose value is in the vocabulary (its column of the same name), and how many were dropped per other value."""
    words = vocabulary.select(column).distinct()
    return rows.join(words, column, "left_semi"), rows.join(words, column, "left_anti").groupBy(column).agg(F.count("*").alias("dropped"))


def is_partition(groups: Column, members: Column) -> Column:
    """Whether groups are two or more, none empty, and hold every member exactly once."""
    flat = F.flatten(groups)
    return F.coalesce(
        (F.size(groups) >= 2) & F.forall(groups, lambda g: F.size(g) > 0) & (F.size(flat) == F.size(F.array_distinct(flat))) & (F.size(flat) == F.size(members)) & (F.size(F.array_except(flat, members)) == 0), F.lit(False)
    )


def cluster_verdicts(replies: DataFrame) -> DataFrame:
    """Verdicts on clusters ``id, members, reply``: ``verdict`` is kitchen, recipe, split or null.

    A split must partition the members (names that are no members are ignored); a
    kitchen verdict must have a title and a text.  ``incoherent`` tells that the reply
    says so, whether its split can be followed or not.
    """
    v = parsed(F.col("reply"), "coherent boolean, groups array<array<string>>, verdict string, title string, doctrine_text string, rationale string, evidence array<struct<date:string,gist:string>>, trigger_hints array<string>")
    names = F.transform("members", lambda m: m.cast("string"))
    rows = replies.withColumn("v", v).withColumn("groups", F.transform("v.groups", lambda g: F.filter(g, lambda i: F.array_contains(names, i))))
    verdict = (
        F.when(~F.col("v.coherent") & is_partition(F.col("groups"), names), "split").when(F.col("v.coherent") & (F.col("v.verdict") == "recipe"), "recipe")
        .when(F.col("v.coherent") & (F.col("v.verdict") == "kitchen") & F.col("v.title").isNotNull() & F.col("v.doctrine_text").isNotNull(), "kitchen")
    )
    rows = rows.withColumn("verdict", verdict)
    kitchen = F.col("verdict") == "kitchen"
    evidence = F.filter(F.transform("v.evidence", lambda e: F.struct(F.coalesce(e["date"], F.lit("")).alias("date"), short(e["gist"], 300).alias("gist"))), lambda e: F.length(e["gist"]) > 0)
    hints = F.filter(F.transform("v.trigger_hints", lambda h: short(h, 80)), lambda h: F.length(h) > 0)
    return rows.select(
        "id", "verdict", F.coalesce(~F.col("v.coherent"), F.lit(False)).alias("incoherent"), F.when(F.col("verdict") == "split", F.transform("groups", lambda g: F.transform(g, lambda i: i.cast("bigint")))).alias("groups"),
        F.when(kitchen, short(F.col("v.title"), 200)).alias("title"), F.when(kitchen, short(F.col("v.doctrine_text"), 2000)).alias("doctrine_text"), short(F.col("v.rationale"), 500).alias("rationale"),
        F.when(kitchen, F.slice(evidence, 1, MAX_EVIDENCE)).alias("evidence"), F.when(kitchen, F.slice(hints, 1, MAX_HINTS)).alias("trigger_hints"),
    )


def valid_citations(cited: Column, related: Column) -> Column:
    """Cited ids that are related, each once in their order; all related ones if none is."""
    good = F.array_intersect(F.coalesce(cited, F.array().cast("array<bigint>")), related)
    return F.when(F.size(good) > 0, good).otherwise(related)


def prompt(task: str, rows: DataFrame, key: str, line: Column, order: Column, chars: int = 500) -> DataFrame:
    """A prompt per key: the task, then one numbered line for each of its rows (a bounded few) in order."""
    numbered = rows.select(F.col(key).alias("key"), order.alias("o"), truncated(line, chars).alias("text"))
    grouped = numbered.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("o", "text"))).alias("rows"))
    lines = F.transform("rows", lambda r, i: F.concat((i + 1).cast("string"), F.lit(". "), r["text"]))
    return grouped.select(F.col("key").alias(key), F.concat(F.lit(task + "\n\n"), F.array_join(lines, "\n")).alias("prompt"))
