"""Hybrid search: lexical and vector ranks fused, best few per signal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.text import token_set, tokens
from quillspark.functions.vectors import norm
from quillspark.operators.scans import live
from quillspark.operators.vectors import nearest_neighbours
from quillspark.runtime import Stash

#: The rank constant of the fusion, weights of text and vectors, and the hits kept.
RANK_CONSTANT, TEXT_WEIGHT, VECTOR_WEIGHT, TOP = 60, 0.4, 0.6, 5


def lexical_hits(signals: DataFrame, items: DataFrame, depth: int = 50) -> DataFrame:
    """The ``depth`` items that share most search words with each signal: ``signal_key, id, shared, rank``.

    An equi-join on words.  The few signals of a run ask for few words, so their side
    is small enough for the planner to ship; a frequent word then costs no shuffle, and
    counts are added up in map tasks first.  A signal's best are found in salted groups
    and then among those, as any item may share a word with it.
    """
    words = items.select("id", F.explode(token_set(F.col("content"))).alias("word"))
    wanted = signals.select("signal_key", F.explode(token_set(F.col("search_text"))).alias("word"))
    shared = words.join(wanted, "word").groupBy("signal_key", "id").agg(F.count("*").alias("shared"))
    best = (F.desc("shared"), F.asc("id"))
    salted = Window.partitionBy("signal_key", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy(*best)
    few = shared.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= depth)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("signal_key").orderBy(*best))).where(F.col("rank") <= depth)


def _best(rows: DataFrame, depth: int) -> DataFrame:
    """Each signal's ``depth`` best rows by ``score``, then least ids, with their ``rank``; found in salted groups and then among those."""
    best = (F.desc("score"), F.asc("id"))
    salted = Window.partitionBy("signal_key", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy(*best)
    few = rows.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= depth)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("signal_key").orderBy(*best))).where(F.col("rank") <= depth)


def text_terms(signals: DataFrame, items: DataFrame, k1: float = 1.2, b: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """The signals' words, ``signal_key, word, df, bound``, and postings of those words, ``id, word, weight``.

    A posting's weight is ``idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len / mean len))``,
    with ``idf = ln(1 + (n - df + 0.5) / (df + 0.5))``; ``bound`` is what no weight of the word
    reaches.  Items are read for words that are asked for only; empty items count in
    ``n`` and the mean length.
    """
    stash = Stash(items.sparkSession, "postings")
    wanted = stash.put(signals.select("signal_key", F.explode(F.array_distinct(tokens(F.col("search_text")))).alias("word")))
    texts = items.select("id", tokens(F.col("content")).alias("words")).withColumn("len", F.size("words"))
    n, mean = texts.agg(F.count("*"), F.avg("len")).first()
    words = texts.select("id", "len", F.explode("words").alias("word")).join(wanted.select("word").distinct(), "word", "left_semi")
    counted = stash.put(words.groupBy("id", "word").agg(F.count("*").alias("tf"), F.max("len").alias("len")))
    df = stash.put(counted.groupBy("word").agg(F.count("*").alias("df")))
    idf = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    scale = F.col("tf") + k1 * (1 - b + b * F.col("len") / F.lit(mean or 1.0))
    postings = counted.join(df, "word").select("id", "word", (idf * F.col("tf") * (k1 + 1) / scale).alias("weight"))
    return wanted.join(df, "word").select("signal_key", "word", "df", (idf * (k1 + 1)).alias("bound")), stash.put(postings)


def full_text_hits(signals: DataFrame, items: DataFrame, depth: int = 50, digits: int = 9, seeds: int = 8) -> DataFrame:
    """The ``depth`` items that rank highest for each signal by the weights of its words: ``signal_key, id, score, rank``.

    Frequent words are not expanded where they can't decide.  A signal's rarest words
    (of some ``seeds * depth`` postings) alone give ``depth`` items of some score; words
    whose bounds together stay below it can't bring in an item by themselves.  Only the
    others' postings make candidates, which then get the weights of all words, so the
    result is that of scoring everything.  Scores are rounded to ``digits``, lest
    the order of sums decides between equal ones; ties go to the least id.
    """
    stash = Stash(items.sparkSession, "full-text")
    terms, postings = text_terms(signals, items)
    terms = stash.put(terms)
    rarest = Window.partitionBy("signal_key").orderBy("df", "word").rowsBetween(Window.unboundedPreceding, -1)
    seed = terms.withColumn("_before", F.coalesce(F.sum("df").over(rarest), F.lit(0))).where(F.col("_before") < seeds * depth)
    partial = postings.join(seed.select("signal_key", "word"), "word").groupBy("signal_key", "id").agg(F.sum("weight").alias("score"))
    floor = _best(partial, depth).where(F.col("rank") == depth).select("signal_key", F.col("score").alias("floor"))
    weakest = Window.partitionBy("signal_key").orderBy("bound", "word").rowsBetween(Window.unboundedPreceding, 0)
    bounded = terms.withColumn("_upto", F.sum("bound").over(weakest)).join(floor, "signal_key", "left")
    strong = bounded.where(F.col("floor").isNull() | (F.col("_upto") >= F.col("floor") - 1e-6)).select("signal_key", "word")
    candidates = stash.put(postings.join(strong, "word").select("signal_key", "id").distinct())
    weighed = candidates.join(postings, "id").join(terms.select("signal_key", "word"), ["signal_key", "word"])
    scored = weighed.groupBy("signal_key", "id").agg(F.round(F.sum("weight"), digits).alias("score"))
    return _best(scored, depth)


def vector_hits(signals: DataFrame, items: DataFrame, depth: int = 50) -> DataFrame:
    """The ``depth`` nearest items to each signal's embedding: ``signal_key, id, rank``."""
    s = signals.where(F.col("embedding").isNotNull()).select((-F.col("session_id") - 1).alias("id"), "embedding")
    near = nearest_neighbours(s, items.select("id", "embedding"), depth)
    return near.select(F.concat(F.lit("session:"), (-F.col("id") - 1).cast("string")).alias("signal_key"), F.col("neighbour").alias("id"), "rank")


def matched_memories(asked: DataFrame, items: DataFrame, least: float, n: int) -> DataFrame:
    """The SQL function ``match_memories`` for many rows at once: ``id, match_id, similarity`` of the ``n`` live items of each row's project nearest to it.

    ``asked`` holds ``id, project, embedding``.  Rows and items of a project meet in blocks
    of matrix products; a lateral join makes a row of two vectors for each of their pairs.
    """
    direct = norm(F.col("embedding")) > 0
    rows = asked.where(direct).select((-F.col("id") - 1).alias("id"), "embedding", "project")  # apart from the items' ids, as a row may find itself
    pool = items.where(live() & direct).select("id", "embedding", "project")
    near = nearest_neighbours(rows, pool, n, within="project", least=least)
    return near.select((-F.col("id") - 1).alias("id"), F.col("neighbour").alias("match_id"), "similarity")


def fused(text: DataFrame, vectors: DataFrame | None, top: int = TOP) -> DataFrame:
    """Reciprocal-rank fusion of the branches: ``signal_key, id, similarity, place``.

    For a signal without vectors the lexical branch has all the weight.
    """
    rows = text.select("signal_key", "id", F.col("rank").alias("t"))
    if vectors is not None:
        rows = rows.join(vectors.select("signal_key", "id", F.col("rank").alias("v")), ["signal_key", "id"], "full_outer")
        both = F.max("v").over(Window.partitionBy("signal_key")).isNotNull()
        rows = rows.withColumn("weight", F.when(both, TEXT_WEIGHT).otherwise(1.0))
    else:
        rows = rows.withColumn("v", F.lit(None).cast("int")).withColumn("weight", F.lit(1.0))
    score = lambda c, weight: F.coalesce(weight / (RANK_CONSTANT + F.col(c)), F.lit(0.0))
    rows = rows.withColumn("similarity", score("t", F.col("weight")) + score("v", F.lit(VECTOR_WEIGHT)))
    order = Window.partitionBy("signal_key").orderBy(F.desc("similarity"), "id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).select("signal_key", "id", "similarity", "place")


def keyword_score(query: Column, content: Column) -> Column:
    """The keyword form of a hit's score: 0.80 for an empty query, 0.92 if the item holds its first word, 0.85 if all of it, else 0.75."""
    query, content = F.lower(F.coalesce(query, F.lit(""))), F.lower(content)
    first = F.split_part(query, F.lit(" "), F.lit(1))
    return F.when(query == "", 0.80).when(F.instr(content, first) > 0, 0.92).when(F.instr(content, query) > 0, 0.85).otherwise(0.75)
