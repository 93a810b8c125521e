"""Insight texts from an injected model: signals asked about in batches, replies matched by key, placeholders for the rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import trimmed, truncated
from quillspark.operators.verdicts import parsed, valid_citations
from quillspark.runtime import Stash

#: Signals of one call, and calls of a run.
BATCH, MAX_CALLS = 3, 100
_ENTRY = "struct<key:string,text:string,cited_ids:array<string>>"


def balanced_objects(text: Column) -> Column:
    """The outermost ``{...}`` of a text, in order, whatever lies between them.

    Brackets are counted as they come, those inside strings too; a closing one too many
    hides what follows until it is made up for.
    """
    pieces = F.regexp_extract_all(text, F.lit(r"[{}]|[^{}]+"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(None).cast("string").alias("open"), F.array().cast("array<string>").alias("done"))

    def step(s: Column, piece: Column) -> Column:
        depth = s["depth"] + F.when(piece == "{", 1).when(piece == "}", -1).otherwise(0)
        grown = F.when((piece == "{") & (s["depth"] == 0), piece).otherwise(F.concat(s["open"], piece))
        ends = (piece == "}") & (depth == 0) & s["open"].isNotNull()
        return F.struct(depth.alias("depth"), F.when(~ends, grown).alias("open"), F.when(ends, F.array_append(s["done"], F.concat(s["open"], piece))).otherwise(s["done"]).alias("done"))

    return F.coalesce(F.aggregate(pieces, start, step, lambda s: s["done"]), F.array().cast("array<string>"))


def insight_entries(reply: Column) -> Column:
    """The entries ``key, text, cited_ids`` of a reply; empty if nothing can be read.

    First the reply as an object with ``insights`` (fenced or chatty, with commas before
    closing brackets or line ends in strings); failing that, every single object in it
    that can be read by itself, so that a broken one costs only itself.
    """
    whole = parsed(reply, f"insights array<{_ENTRY}>")["insights"]
    mended = F.transform(balanced_objects(reply), lambda c: F.regexp_replace(c, r",\s*([\]}])", "$1"))
    single = F.transform(F.filter(mended, lambda c: F.try_parse_json(c).isNotNull()), lambda c: F.from_json(c, _ENTRY, {"allowUnquotedControlChars": "true"}))
    every = F.coalesce(whole, single, F.array().cast(f"array<{_ENTRY}>"))
    return F.filter(every, lambda e: e["key"].isNotNull() & e["text"].isNotNull())


def placeholder(n: Column, projects: Column, description: Column) -> Column:
    """The text of an insight that no model wrote."""
    named = F.when(F.size(projects) > 0, F.array_join(projects, ", ")).otherwise("unknown")
    return F.concat(F.lit("Found "), n.cast("string"), F.when(n == 1, " related memory from ").otherwise(" related memories from "), F.when(F.size(projects) == 1, "project ").otherwise("projects "), named, F.lit(" about: "), F.substring(F.coalesce(description, F.lit("")), 1, 180))


def written(rows: DataFrame, ask: Callable[[DataFrame], DataFrame] | None, order: list[Column], max_calls: int = MAX_CALLS, size: int = BATCH) -> DataFrame:
    """Insights with their texts: the rows with ``insight, source_ids, synthesized``.

    ``rows`` hold ``signal_key, description, n, projects, related`` (ids and contents in
    order of rank).  Signals are taken in ``order`` in batches of ``size``; ``ask`` gets ``batch,
    prompt`` for the first ``max_calls`` of them and returns ``batch, reply`` (fewer rows where
    calls failed).  A signal whose key a reply names, the last time it does, gets that text and
    the cited ids that are related to it, or all related ids if none is; any other gets
    the placeholder and all related ids.  A run's signals are few by the picker's limit.
    """
    stash = Stash(rows.sparkSession, "insights")
    place = F.row_number().over(Window.orderBy(*order)) - 1
    dealt = stash.put(rows.withColumn("_place", place).withColumn("batch", F.floor(F.col("_place") / size).cast("int")))
    if ask is None:
        said = dealt.where("false").select("signal_key", F.lit("").alias("text"), F.array().cast("array<bigint>").alias("cited"))
    else:
        lines = F.array_join(F.transform("related", lambda r: F.concat(F.lit("- id="), r["id"].cast("string"), F.lit(" "), truncated(r["content"], 400))), "\n")
        block = F.concat(F.lit("Signal "), F.col("signal_key"), F.lit("\n"), F.coalesce("description", F.lit("")), F.lit("\nRelated:\n"), lines)
        prompts = dealt.where(F.col("batch") < max_calls).groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("_place", block.alias("block")))).alias("blocks"))
        prompts = prompts.select("batch", F.concat(F.lit("Write one insight for each signal, as {\"insights\":[{\"key\",\"text\",\"cited_ids\"}]}.\n\n"), F.array_join(F.transform("blocks", lambda b: b["block"]), "\n\n")).alias("prompt"))
        replies = stash.put(ask(prompts).select("batch", "reply"))
        entries = replies.select("batch", F.posexplode(insight_entries(F.col("reply"))).alias("at", "e"))
        entries = entries.join(dealt.select("batch", F.col("signal_key")), "batch").where(F.col("e.key") == F.col("signal_key"))
        last = entries.groupBy("signal_key").agg(F.max_by("e", "at").alias("e"))
        cited = F.filter(F.transform(F.coalesce("e.cited_ids", F.array().cast("array<string>")), lambda c: c.try_cast("bigint")), lambda c: c.isNotNull())
        said = last.select("signal_key", trimmed(F.col("e.text")).alias("text"), cited.alias("cited")).where(F.length("text") > 0)
    both = dealt.join(said, "signal_key", "left")
    ids = F.transform("related", lambda r: r["id"])
    good = F.col("text").isNotNull()
    return both.withColumns({
        "insight": F.when(good, F.col("text")).otherwise(placeholder(F.col("n"), F.col("projects"), F.col("description"))),
        "source_ids": F.when(good, valid_citations(F.col("cited"), ids)).otherwise(ids), "synthesized": good,
    }).drop("_place", "batch", "text", "cited")
