"""Near-duplicate documents by fast similarity sketches (operator 9).

A sketch has ``t`` coordinates.  In round ``i`` every shingle is hashed to a bin
and a fraction, and a bin keeps the least ``i + fraction`` it has seen; rounds go on
until every bin is filled, and from round ``t`` on the round number itself is the
bin, so that all are filled after ``2 t`` rounds at the latest.  Coordinates agree
with the sets' resemblance as probability, and concentrate like those of ``t``
independent permutations at the cost of a few passes (Dahlgaard, Knudsen and
Thorup, 2017).  Bands of coordinates give buckets; links are confirmed on the full
shingle sets.

No bucket is ever expanded into all its pairs.  Equal sets are one class with one
representative.  In a bucket, members are first compared with a centre; what that
links is one component, and only members of *different* components still need
comparing.  Each of those names the few most alike others, which settles nearly all
buckets.  What is left of large ones goes, with its full sets, through blocks of
bounded size that compare everything that still matters and pass on only who is
joined.  So a group of thousands of near copies costs a few comparisons a member, yet
no link between components is left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.texts import Cache, held, map_texts
from quillspark.operators.graph import connected_components
from quillspark.runtime import Stash

#: Coordinates of a sketch, bands and rows of a band: at resemblance 0.8 a pair shares no band with probability 3e-6.
COORDINATES, BANDS, ROWS = 160, 32, 5
#: Share of agreeing coordinates below which a pair is not confirmed: 4.7 standard deviations under 0.8.
PLAUSIBLE = 0.65
#: Rows of a side of a block, and the candidates a row names before the exact blocks.
BLOCK, NAMED = 256, 3
#: Star rounds before blocks, and distinct shingles up to which a block is compared by one matrix product.
STARS, VOCABULARY = 2, 100_000

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Hashes of the distinct word shingles of a text, sorted; words are runs of non-white-space bytes, A-Z lower-cased."""

    def __init__(self, width: int):
        self.width = width
        self.factors = mix(np.arange(1, width + 1, dtype=_U)) | _U(1)
        self.known: Cache = Cache(100_000)

    def hashes(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, _U)
        self.known.trim()
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            for k, w in enumerate(words):
                if found[k] is None:
                    if w not in known and known.recall(w) is None:
                        known[w] = xxhash.xxh64_intdigest(w)
                    found[k] = known[w]
        h = np.array(found, _U)
        n = min(self.width, len(words))
        out = np.full(len(h) - n + 1, n, _U)
        for k in range(n):
            out += h[k : len(h) - n + 1 + k] * self.factors[k]
        return np.unique(mix(out))


def shingler_of(width: int) -> Shingler:
    """The worker's shingler, which outlives a task."""
    return held((Shingler, width), lambda: Shingler(width))


def sketch(shingles: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """``t`` coordinates of 16 bits each, for a set that is not empty."""
    least = np.full(t, np.iinfo(np.uint64).max, _U)
    done, size = 0, max(1, int(np.ceil(1.5 * t * np.log(t) / len(shingles))))
    while done < 2 * t:
        size = max(1, min(size, 2 * t - done, 1 + 200_000 // len(shingles)))
        rounds = np.arange(done, done + size, dtype=_U)
        h = mix(shingles[None, :] ^ mix(rounds + _U(0x5851F42D4C957F2D))[:, None])
        bins = ((h >> _U(32)) * _U(t)) >> _U(32)
        bins[rounds >= _U(t)] = (rounds[rounds >= _U(t)] - _U(t))[:, None]
        np.minimum.at(least, bins.ravel().astype(np.int64), ((rounds << _U(32))[:, None] | (h & _U(0xFFFFFFFF))).ravel())
        done += size
        if least.max() < np.iinfo(np.uint64).max:
            break
    return (mix(least) & _U(0xFFFF)).astype(np.uint16)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Per row: ``doc_id, n_shingles, digest`` (of the set; null if empty) and ``sketch``."""

    def make():
        shingler = shingler_of(width)

        def work(part: pa.RecordBatch, texts: list) -> dict:
            n, digests, sketches = [], [], []
            for t in texts:
                s = shingler.hashes(t)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sketches.append(sketch(s).tobytes() if len(s) else None)
            return {"doc_id": part.column(0), "n_shingles": n, "digest": digests, "sketch": sketches}

        return work

    return map_texts(docs, ["doc_id", "text"], "doc_id long, n_shingles long, digest binary, sketch binary", make)


def _shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """Per row: ``doc_id`` and the sorted hashes of its shingles."""

    def make():
        return lambda part, some: {"doc_id": part.column(0), "shingles": [shingler_of(width).hashes(t).tobytes() for t in some]}

    return map_texts(texts, ["doc_id", "text"], "doc_id long, shingles binary", make)


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Of pairs ``(a, b)`` those whose full sets have a resemblance of ``percent`` or more."""
    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, last, own = shingler_of(width), None, None
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last:
                    last, own = a, shingler.hashes(text_a.as_py())
                other = shingler.hashes(text_b.as_py())
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _plausible(group: dict[str, np.ndarray], percent: int) -> Iterator[np.ndarray]:
    """Rows ``(left, right, agreeing)`` of pairs of a block in different components whose first common band is this one."""
    left, right = np.flatnonzero(group["side"] == 0), np.flatnonzero(group["side"] == 1)
    s, comp, n = group["sketch"], group["comp"], group["n_shingles"]
    for start in range(0, len(left), 64):
        at = left[start : start + 64]
        small, large = np.minimum(n[at][:, None], n[right][None, :]), np.maximum(n[at][:, None], n[right][None, :])
        i, j = np.nonzero((comp[at][:, None] != comp[right][None, :]) & (100 * small >= percent * large))
        for part in range(0, len(i), 8192):
            a, b = at[i[part : part + 8192]], right[j[part : part + 8192]]
            same = s[a] == s[b]
            agree = same.sum(axis=1)
            first = same.reshape(len(a), BANDS, ROWS).all(axis=2).argmax(axis=1)
            on = (agree >= PLAUSIBLE * COORDINATES) & (first == group["slot"][a])
            yield np.column_stack([a[on], b[on], agree[on]])


def _name_pairs(group: dict[str, np.ndarray], percent: int) -> dict[str, np.ndarray]:
    """At most ``NAMED`` plausible pairs of each left row, most alike first, and whether its block had more."""
    ids = group["doc_id"]
    found = np.concatenate([np.empty((0, 3), np.int64), *_plausible(group, percent)]).astype(np.int64)
    found = found[np.lexsort((ids[found[:, 1]], -found[:, 2], found[:, 0]))]
    rank = np.arange(len(found)) - np.searchsorted(found[:, 0], found[:, 0])
    more, found = bool((rank >= NAMED).any()), found[rank < NAMED]
    a, b = ids[found[:, 0]], ids[found[:, 1]]
    return {"band": np.full(len(a), group["band"][0]), "a": np.minimum(a, b), "b": np.maximum(a, b), "more": np.full(len(a), more)}


def _join_all(group: dict[str, np.ndarray], percent: int) -> dict[str, np.ndarray]:
    """Links that join a block's components: all plausible pairs are confirmed on the full sets, those that join nothing new are not passed on."""
    sets = [np.frombuffer(x, _U) for x in group["shingles"]]
    ids, comp = group["doc_id"], group["comp"]
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    matrix = None
    words = np.unique(np.concatenate(sets)) if sets else np.empty(0, _U)
    if len(words) <= VOCABULARY:
        matrix = np.zeros((len(sets), len(words)), np.float32)
        for k, x in enumerate(sets):
            matrix[k, np.searchsorted(words, x)] = 1
        left, right = np.flatnonzero(group["side"] == 0), np.flatnonzero(group["side"] == 1)
        common = matrix[left] @ matrix[right].T
        row, column = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
        row[left], column[right] = np.arange(len(left)), np.arange(len(right))
    a_out, b_out = [], []
    for pairs in _plausible(group, percent):
        for a, b in zip(*pairs[:, :2].T.tolist()) if len(pairs) else ():
            p, q = find(int(comp[a])), find(int(comp[b]))
            if p == q:
                continue
            both = int(common[row[a], column[b]]) if matrix is not None else len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[max(p, q)] = min(p, q)
                a_out.append(ids[a])
                b_out.append(ids[b])
    return {"a": np.array(a_out, np.int64), "b": np.array(b_out, np.int64)}


def _blocks(work, percent: int, columns: list[str], schema: pa.Schema):
    """Over rows in the order of their blocks ``(band, l, r)``: what ``work`` gives for each block."""
    key = ("band", "l", "r")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(table: pa.Table) -> pa.RecordBatch:
            data = {c: table.column(c).to_numpy() for c in (*key, "slot", "doc_id", "comp", "n_shingles", "side")}
            data["sketch"] = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, COORDINATES)
            for c in columns:
                data[c] = np.array([*table.column(c).to_pylist(), None], object)[:-1]
            place = np.column_stack([data[c] for c in key])
            cuts = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(place)]
            found = [work({c: v[i:j] for c, v in data.items()}, percent) for i, j in zip(cuts, cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[c.name] for f in found]), c.type) for c in schema], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            tail = np.ones(held.num_rows, bool)
            for c in key:
                values = held.column(c).to_numpy()
                tail &= values == values[-1]
            whole = held.num_rows - int(tail.sum())
            if whole:
                yield done(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield done(held)

    return run


def _dealt(rows: DataFrame, everywhere: bool) -> DataFrame:
    """Rows of buckets dealt to blocks ``(band, l, r)``: left those outside the bucket's largest component, right all.

    A left row meets every block of right rows, or (not ``everywhere``) only one.
    """
    counts = rows.groupBy("band", "comp").agg(F.count("*").alias("n"))
    largest = counts.groupBy("band").agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("total"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    largest = largest.select("band", F.col("m.comp").alias("main"), blocks(F.col("total") - F.col("m.n")).alias("lefts"), blocks(F.col("total")).alias("rights"))
    dealt = rows.join(largest, "band")
    place = lambda n, salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = dealt.where("comp <> main").select(*rows.columns, "rights", place(F.col("lefts"), 1).alias("l"), (every("rights") if everywhere else place(F.col("rights"), 3)).alias("r"), F.lit(0).alias("side"))
    right = dealt.select(*rows.columns, "rights", every("lefts").alias("l"), place(F.col("rights"), 2).alias("r"), F.lit(1).alias("side"))
    return left.unionByName(right).repartition("band", "l", "r").sortWithinPartitions("band", "l", "r")


def _unsettled(bands: DataFrame, comp: DataFrame | None) -> DataFrame:
    """Band rows with their components, of buckets that hold two components or more."""
    if comp is None:
        rows = bands.withColumn("comp", F.col("doc_id"))
    else:
        rows = bands.join(comp.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
    open_ = rows.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band")
    return rows.join(open_, "band")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased.  A
    row's set is its distinct ``width``-word shingles; with fewer words the whole
    sequence is the one shingle; without words, or with a null text, it is empty and
    linked with nothing.  Rows are linked whose sets have a resemblance of ``percent``
    in a hundred or more; ``component_id`` is the smallest id reachable.

    Repeated rows and ties are members of one class; where an id repeats with another
    set, each row takes the component of its own text (:func:`_row_by_row`).  Rows with a null id are counted
    but linked with nothing (``component_id`` null, ``kept`` true).  Ids must fit a
    long.  Other columns are not looked at.  An empty table gives an empty one.
    """
    stash = Stash(docs.sparkSession, "near")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stash.put(signatures(source, width))
    same = F.xxhash64("digest")
    clashes = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min(same).alias("lo"), F.max(same).alias("hi")).where("lo <> hi")
    if not clashes.isEmpty():
        return _row_by_row(source, width, percent, stash)
    linkable = signed.where("digest is not null and doc_id is not null")
    classes = stash.put(linkable.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")))
    size = 2 * ROWS
    slots = F.array(*[F.xxhash64(F.lit(k), F.expr(f"substring(sketch, {k * size + 1}, {size})")) for k in range(BANDS)])
    bands = classes.select("doc_id", F.posexplode(slots).alias("slot", "band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    bands = stash.put(bands.join(shared, "band"))
    members = bands.select("doc_id").distinct()
    texts = stash.put(source.join(members, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))

    links, comp, tested = None, None, None

    def settle(pairs: DataFrame) -> None:
        nonlocal links, comp, tested
        fresh = pairs.select("a", "b", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).dropDuplicates(["lo", "hi"])
        fresh = stash.put(fresh if tested is None else fresh.join(tested, ["lo", "hi"], "left_anti"))
        found = stash.put(confirmed(fresh.select("a", "b"), texts, width, percent))
        tested = fresh if tested is None else tested.unionByName(fresh)
        links = found if links is None else links.unionByName(found)
        if comp is None or not found.isEmpty():
            comp = connected_components(links, "a", "b")

    for star in range(STARS):
        rows = stash.put(_unsettled(bands, comp))
        if rows.isEmpty():
            break
        order = F.struct(F.xxhash64("doc_id", F.lit(star)).alias("h"), "doc_id", "comp")
        centres = rows.groupBy("band").agg(F.min(order).alias("c")).select("band", F.col("c.doc_id").alias("centre"), F.col("c.comp").alias("centre_comp"))
        pairs = rows.join(centres, "band").where("comp <> centre_comp")
        settle(pairs.select(F.col("centre").alias("a"), F.col("doc_id").alias("b")))
    rows = stash.put(_unsettled(bands, comp).join(classes.select("doc_id", "n_shingles", "sketch"), "doc_id"))
    if not rows.isEmpty():
        kind = pa.schema([("band", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("more", pa.bool_())])
        named = stash.put(_dealt(rows, False).drop("rights").mapInArrow(_blocks(_name_pairs, percent, [], kind), "band long, a long, b long, more boolean"))
        settle(named)
        large = rows.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("band")
        again = named.where("more").select("band").union(large).distinct()
        rows = stash.put(_unsettled(bands.join(again, "band"), comp))
        if not rows.isEmpty():
            sets = _shingle_sets(texts.join(rows.select("doc_id").distinct(), "doc_id", "left_semi"), width)
            sets = stash.put(sets.join(classes.select("doc_id", "n_shingles", "sketch"), "doc_id"))
            rows = rows.join(sets, "doc_id")
            kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])
            joined = stash.put(_dealt(rows, True).drop("rights").mapInArrow(_blocks(_join_all, percent, ["shingles"], kind), "a long, b long"))
            comp = connected_components(links.unionByName(joined) if links is not None else joined, "a", "b")
    if comp is None:
        grouped = classes.select("digest", F.col("doc_id").alias("component_id"))
    else:
        grouped = classes.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("digest", F.coalesce("component", "doc_id").alias("component_id"))
    out = signed.drop("sketch").join(grouped, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _row_by_row(source: DataFrame, width: int, percent: int, stash: Stash) -> DataFrame:
    """:func:`near_duplicates` where ids repeat with other sets: rows are numbered, linked by number, and named by their ids at the end."""
    rows = stash.put(source.withColumn("row", F.monotonically_increasing_id()))
    linked = near_duplicates(rows.where("doc_id is not null"), width, percent, "row").drop("kept").withColumnRenamed("doc_id", "row")
    named = stash.put(linked.join(rows.select("row", "doc_id"), "row"))
    least = named.groupBy("component_id").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "component_id").select("doc_id", "n_shingles", F.col("least").alias("component_id"), (F.col("doc_id") == F.col("least")).alias("kept"))
    nameless = rows.where("doc_id is null")
    if nameless.isEmpty():
        return out
    return out.unionByName(near_duplicates(nameless.select("doc_id", "text"), width, percent))


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of which one stays for each group of near duplicates.

    The one with the smallest id stays; of its repeated rows (same id and text) one.
    Where an id repeats with other texts, all of them stay if one of them does.
    Rows without words, and rows with a null id, all stay.
    """
    kept = near_duplicates(docs, width, percent, id_col, text_col).where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept_id")).distinct()
    named = docs.where(F.col(id_col).isNotNull())
    one = named.join(kept, named[id_col].cast("long") == F.col("_kept_id"), "left_semi").dropDuplicates([id_col, text_col])
    return one.unionByName(docs.where(F.col(id_col).isNull()))
