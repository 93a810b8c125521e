"""Bottom-k fingerprints of documents (operator 4), in DataFrame functions only.

A fingerprint is the ``k`` least distinct 64-bit hashes of a text's word shingles, in
order.  Fingerprints of parts merge into that of the whole, and any two estimate the
resemblance and containment of their sets and the number of distinct shingles; for
sets of at most ``k`` shingles all of these are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashes kept, words of a shingle, rows of a range of ids, and ranges at most along each of two levels.
K, WIDTH, RANGE_ROWS, LEVEL = 128, 5, 2000, 128


def bound_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, though ``use`` names it often or in a lambda."""
    return F.transform(F.array(value), use)[0]


def fingerprint(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """Sorted array of at most ``k`` hashes; empty for a null text or one without words.

    Words are split at ASCII white space and lower-cased; with fewer than ``width``
    words the whole sequence is the one shingle.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def least(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(1)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, width)))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.slice(F.sort_array(F.array_distinct(hashes)), 1, k))

    return bound_once(words, least)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of the union of the parts that ``a`` and ``b`` are of."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of either; two empty sets are alike (1), an empty and another are not (0)."""
    share = lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(bound_once(merged(a, b, k), share))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    place = (a[k - 1].cast("double") + F.lit(float(1 << 63))) / F.lit(float(1 << 64))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too; 1 for an empty ``a``."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """Hashes as 16 hexadecimal digits each."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def merge_fingerprints(parts: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """One fingerprint per key of the fingerprints of its parts.

    The hashes are first made distinct with their keys, which map tasks do for
    themselves.  A key's least ``k`` are found in salted groups and then among those, so
    that a key with very many parts is not ranked by one task alone.
    """
    hashes = parts.select(F.col(key).alias("key"), F.explode(sketch).alias("h")).distinct()
    salted = Window.partitionBy("key", F.pmod("h", F.lit(64))).orderBy("h")
    few = hashes.withColumn("at", F.row_number().over(salted)).where(F.col("at") <= k)
    ranked = few.withColumn("at", F.row_number().over(Window.partitionBy("key").orderBy("h"))).where(F.col("at") <= k)
    return ranked.groupBy("key").agg(F.sort_array(F.collect_list("h")).alias(sketch)).withColumnRenamed("key", key)


def _with_ranges(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with ``range``, the number of their key's range, ascending with the key."""
    n = rows.count()
    ranges = max(1, min(LEVEL * LEVEL, -(-n // RANGE_ROWS)))
    bounds: list[int] = []
    if ranges > 1:
        found = rows.select(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
        bounds = sorted(set(found))
    step = max(1, -(-len(bounds) // LEVEL))
    coarse = bounds[::step][1:]
    fine = [bounds[i : i + step] for i in range(0, max(1, len(bounds)), step)]
    longs = lambda xs: F.array(*[F.lit(x).cast("bigint") for x in xs]) if xs else F.array().cast("array<bigint>")
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= F.col("key")))
    block = below(longs(coarse))
    return rows.withColumn("block", block).withColumn("range", F.col("block") * step + below(F.element_at(F.array(*map(longs, fine)), F.col("block") + 1))).drop("block"), len(bounds) + 1


def fingerprint_neighbours(docs: DataFrame, k: int = K, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each row's text, of its edited text, and their likeness to the row's and the next row's.

    Rows are in ascending order of id (then text; null ids first); after the last comes
    the first.  The edited text has the last ``floor(n/2)`` code points replaced by the
    first as many (or all) of the next row's text.  Null texts count as empty.  Repeated
    rows follow each other; a single row is its own next.  Other columns are not looked
    at; an empty table gives an empty one.

    Texts are shuffled once, by ranges of ids found from the ids alone, so that a row's
    next is in its task; each range also gets a copy of the first row of the range that
    follows.
    """
    kind = docs.schema[id_col].dataType
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63)))
    rows, n = _with_ranges(docs.select(key.alias("key"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    first = rows.groupBy("range").agg(F.min("key").alias("key"))
    turn = Window.orderBy("range")  # as many rows as ranges, and these are bounded
    wrap = F.coalesce(F.lead("key").over(turn), F.first("key").over(turn))
    follows = F.broadcast(first.select(F.col("range").alias("before"), wrap.alias("key")))
    guests = rows.select("key", "text").join(follows, "key").groupBy("before").agg(F.min("text").alias("text"))
    guests = guests.select(F.lit(None).cast("bigint").alias("key"), F.lit(None).cast(kind).alias("doc_id"), "text", F.col("before").alias("range"), F.lit(1).alias("guest"))
    both = rows.withColumn("guest", F.lit(0)).unionByName(guests)
    order = Window.partitionBy("range").orderBy("guest", "key", "text")
    n_chars = F.length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.substring("text", 1, n_chars - half), F.substring(F.coalesce(F.col("following"), F.lit("")), 1, half))
    seen = both.withColumn("following", F.lead("text").over(order)).select("range", "guest", "key", "doc_id", "text", n_chars.cast("long").alias("n_chars"), edited.alias("edited"))
    made = seen.select(
        "range", "guest", "key", "doc_id", "text", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), k, width).alias("own"), fingerprint(F.col("edited"), k, width).alias("changed"),
    )
    paired = made.withColumn("after", F.lead("own").over(order)).where("guest = 0")
    return paired.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("changed"), k).alias("near_edited"), resemblance(F.col("own"), F.col("after"), k).alias("near_next"),
        distinct_shingles(F.col("own"), k).alias("distinct_shingles"),
    )
