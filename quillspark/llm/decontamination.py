"""Benchmark decontamination (operator 11), in DataFrame functions only.

The normalised word windows of all benchmark items are a hash set that goes to every
task; each text's windows are looked up in it while the text is read, and a window found
by its hash is compared word by word.  Nothing of a text is shuffled but the places of
its hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import Stash

#: Words of a window, and bytes of windows in one broadcast; a larger set goes in blocks, each with a pass over the texts.
WIDTH, BLOCK_BYTES = 10, 48_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words, after and before A-Z are lower-cased.
PARTED, PARTED_RAW = r"\x00-\x2F\x3A-\x60\x7B-\x7F", r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def normalised_words(text: Column) -> Column:
    """Words of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII; none for a null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), f"[{PARTED}]+"), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _window_key(hashes: str, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(F.col(hashes), start + k) for k in range(length)], F.lit(length))


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the items: ``key`` (hash), ``window`` (its words), ``length``, ``items`` (sorted ids as strings), ``set_key``.

    An item with fewer words than ``width`` is one window; one without words, or with a
    null id, has none.  ``set_key`` names the list of items, so that windows of a
    passage that many items share lead to one list.
    """
    rows = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), normalised_words(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    rows = rows.withColumn("length", F.least(F.size("words"), F.lit(width)))
    starts = rows.select("item", "words", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("start"))
    found = starts.select("item", "length", F.slice("words", F.col("start"), F.col("length")).alias("window"))
    grouped = found.groupBy("window", "length").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("hashes", _hashes(F.col("window")))
    key = F.coalesce(*[F.when(F.col("length") == k, _window_key("hashes", F.lit(0), k)) for k in range(1, width + 1)])
    return grouped.select(key.alias("key"), "window", "length", "items", F.sha2(F.to_json("items"), 256).alias("set_key"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: its id, ``h1, h2`` (hashes of the text), ``n_words``, ``hit_words`` and ``item_ids``.

    ``hit_words`` are the places (from 0, ascending) of the words that lie inside any
    occurrence of a benchmark window, ``item_ids`` the ids, as strings in order, of the
    items with windows that occur.  A null text has no words.  Repeated rows, and rows
    with a null id, each get a row.  Items with a null id are not looked for; an item
    that repeats is one item with the windows of all its texts.  Without items nothing
    is hit; no documents give no rows.  Other columns are not looked at.
    """
    stash = Stash(docs.sparkSession, "contamination")
    windows = stash.put(benchmark_windows(benchmark, width, item_col, item_text_col))
    total = windows.agg(F.coalesce(F.sum(F.octet_length(F.array_join("window", "")) + 250), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    lengths = sorted((r["length"] for r in windows.select("length").distinct().collect()), reverse=True) or [width]  # ``width`` values at most

    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h1"), F.xxhash64(F.lit(2), text_col).alias("h2"), normalised_words(F.col(text_col)).alias("words"))
    texts = texts.withColumn("hashes", _hashes(F.col("words")))
    at = texts.select("id", "h1", "h2", "words", "hashes", F.posexplode_outer("hashes").alias("place", "_hash"))
    if len(lengths) == 1:
        at = at.withColumns({"length": F.lit(lengths[0]), "key": _window_key("hashes", F.col("place"), lengths[0])})
    else:
        probes = F.array(*[F.struct(F.lit(n).alias("length"), _window_key("hashes", F.col("place"), n).alias("key")) for n in lengths])
        at = at.select("*", F.explode(probes).alias("p")).select("id", "h1", "h2", "words", "place", "p.length", "p.key")

    def hits(block: int) -> DataFrame:
        mine = windows.where(F.pmod("key", F.lit(blocks)) == block) if blocks > 1 else windows
        mine = F.broadcast(mine.select(F.col("key").alias("_key"), "window", "set_key"))
        same = (F.col("key") == F.col("_key")) & (F.slice("words", F.col("place") + 1, F.col("length")) == F.col("window"))
        row = (F.coalesce("place", F.lit(0)) == 0) & (F.col("length") == lengths[0]) & F.lit(block == 0)  # once for each row of docs
        seen = at.join(mine, same, "left").where(F.col("window").isNotNull() | row)
        hit = F.when(F.col("window").isNotNull(), F.struct("place", "length"))
        return seen.select("id", "h1", "h2", F.size("words").alias("n_words"), row.cast("int").alias("row"), hit.alias("hit"), "set_key")

    rows = reduce(DataFrame.unionByName, [hits(b) for b in range(blocks)])
    found = rows.groupBy("id", "h1", "h2").agg(F.max("n_words").alias("n_words"), F.sum("row").alias("rows"), F.collect_set("hit").alias("hits"), F.array_sort(F.collect_set("set_key")).alias("sets"))
    found = stash.put(found)
    every = lambda h: F.sequence(h["place"], h["place"] + h["length"] - 1)
    hit = found.where(F.size("sets") > 0).withColumn("hit_words", F.array_sort(F.array_distinct(F.flatten(F.transform("hits", every)))))
    # each list of sets that occurs is resolved once, however many documents have it
    combined = found.where(F.size("sets") > 0).select("sets").distinct()
    lists = windows.groupBy("set_key").agg(F.any_value("items").alias("items"))
    named = combined.select("sets", F.explode("sets").alias("set_key")).join(lists, "set_key").groupBy("sets").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"))
    columns = ["id", "h1", "h2", "n_words", "rows", "hit_words", "item_ids"]
    clean = found.where(F.size("sets") == 0).withColumns({"hit_words": F.array().cast("array<int>"), "item_ids": F.array().cast("array<string>")})
    both = clean.select(*columns).unionByName(hit.join(named, "sets").select(*columns))
    each = both.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("_n"))
    return each.select(F.col("id").alias(id_col), "h1", "h2", "n_words", "hit_words", "item_ids")


def without_words(text: Column, hit_words: Column) -> Column:
    """The text without the words at the given places and what parts each from the word before it."""
    pieces = F.regexp_extract_all(text, F.lit(f"[{PARTED_RAW}]*+[^{PARTED_RAW}]++|[{PARTED_RAW}]++$"), F.lit(0))
    kept = F.transform(F.array(pieces), lambda p: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), hit_words), lambda i: p[i]), ""))
    return kept[0]


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, with all its columns, without what the benchmark holds.

    ``remove="documents"`` drops every row with a hit word; ``remove="spans"`` cuts the
    hit words out of the texts and keeps all rows (a text that was all benchmark keeps
    no words).  Rows without hits, null texts included, come back as they are.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    found = find_contamination(docs, benchmark, width, id_col, text_col, **options).where(F.size("hit_words") > 0)
    found = found.select(F.col(id_col).alias("_id"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("hit_words").alias("_hit")).dropDuplicates(["_id", "_h1", "_h2"])
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("_id")) & (F.xxhash64(f"d.{text_col}") == F.col("_h1")) & (F.xxhash64(F.lit(2), f"d.{text_col}") == F.col("_h2"))
    if remove == "documents":
        return docs.alias("d").join(found, same, "left_anti")
    text = F.when(F.col("_hit").isNull(), F.col(f"d.{text_col}")).otherwise(without_words(F.col(f"d.{text_col}"), F.col("_hit")))
    return docs.alias("d").join(found, same, "left").select(*[text.alias(c) if c == text_col else F.col(f"d.{c}") for c in docs.columns])
