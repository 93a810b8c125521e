"""Best-fit packing of tokenized documents by a grouping genetic algorithm (operator 10).

Pieces are dealt by hash into shards of a bounded size.  Each shard is a bin-packing
problem on which several islands (tasks) evolve populations of packings.  A
crossover puts whole well-filled bins of one parent into the other, removes the
bins that held duplicates of their pieces, and best-fits the displaced pieces.
Between epochs each island's elite migrates to the next island of its shard.  The
badly filled bins that shards end with are pooled and packed again, so the share
of wasted room does not depend on the number of shards.  Where pooling no longer
gets on (most pieces cannot fill bins better), a level's bins are final as they are.
"""

from __future__ import annotations

import os
import zlib
from array import array
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.texts import Cache, held, map_texts
from quillspark.runtime import Stash, ship

#: Pieces in a shard (expected), islands of a shard, epochs, generations in an epoch, size of a population.
SHARD_PIECES, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 32_768, 2, 3, 12, 4
#: A finished bin less full than this is opened again and its pieces pooled.
OPEN_BELOW = 0.98
#: A level that reopens more than this share of its pieces is the last: packing them again would hardly close more.
REOPEN_MOST = 0.9
#: Bytes (about) of a generation of a worker's cache of encoded words.
CACHE_BYTES = 100_000_000


def best_fit(lengths: np.ndarray, items, capacity: int, bins: list[list[int]] | None = None) -> list[list[int]]:
    """Put items, in the given order, each into the fullest bin that has room, else a new one.

    Bins are kept in stacks by room left; an integer's bits say which stacks have
    any, so the best fit is one shift and one lowest-bit search.
    """
    bins = [] if bins is None else bins
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = 0
    for b, full in enumerate(filled(lengths, bins).tolist()):
        room = capacity - full
        stacks[room].append(b)
        bits |= 1 << room
    for item, size in zip(items, lengths[items].tolist()):
        above = bits >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            stack = stacks[room]
            b = stack.pop()
            if not stack:
                bits &= ~(1 << room)
            bins[b].append(item)
        else:
            room, b = capacity, len(bins)
            bins.append([item])
        room -= size
        stacks[room].append(b)
        bits |= 1 << room
    return bins


def filled(lengths: np.ndarray, bins: list[list[int]]) -> np.ndarray:
    """Total length of each bin; no bin is empty."""
    if not bins:
        return np.empty(0, np.int64)
    starts = np.cumsum([0, *map(len, bins[:-1])])
    return np.add.reduceat(lengths[np.fromiter(chain.from_iterable(bins), np.int64)], starts)


def fitness(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> tuple[int, float]:
    """Fewer bins first; then the packing whose bins are more unequally filled (mean square fill)."""
    fill = filled(lengths, bins) / capacity
    return -len(bins), float((fill**2).mean()) if len(bins) else 0.0


def crossover(lengths: np.ndarray, giver: list[list[int]], taker: list[list[int]], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """A child: well-filled bins of ``giver`` injected into ``taker``, the displaced pieces best-fitted."""
    fill = filled(lengths, giver)
    order = np.argsort(-fill - rng.random(len(fill)) * capacity * 0.02)
    injected = [list(giver[k]) for k in order[: max(1, len(giver) // 2)]]
    held = set(chain.from_iterable(injected))
    kept, displaced = [], []
    for b in taker:
        if held.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [i for i in b if i not in held]
    displaced.sort(key=lambda i: (-lengths[i], i))
    return best_fit(lengths, displaced, capacity, injected + kept)


def mutate(lengths: np.ndarray, bins: list[list[int]], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Empty the worst-filled bins and a few random ones, and best-fit their pieces again."""
    fill = filled(lengths, bins)
    emptied = {*np.argsort(fill)[: max(2, len(bins) // 20)].tolist(), *rng.integers(0, len(bins), 2).tolist()}
    loose = [i for k in emptied for i in bins[k]]
    loose.sort(key=lambda i: (-lengths[i], i))
    return best_fit(lengths, loose, capacity, [list(b) for k, b in enumerate(bins) if k not in emptied])


def evolve(lengths: np.ndarray, capacity: int, seed: int, guests: list[list[list[int]]], generations: int = GENERATIONS) -> list[list[int]]:
    """The best packing found; stops at the volume bound, which nothing can beat."""
    if not len(lengths):
        return []
    rng = np.random.default_rng(seed)
    bound = -(-int(lengths.sum()) // capacity)
    falling = np.argsort(-lengths, kind="stable")
    people = [*guests]
    if not guests:
        people.append(best_fit(lengths, falling.tolist(), capacity))
        while len(people) < POPULATION and len(people[0]) > bound:
            noisy = np.argsort(-lengths * (1 + 0.3 * rng.random(len(lengths))), kind="stable")
            people.append(best_fit(lengths, noisy.tolist(), capacity))
    people = sorted(((fitness(lengths, p, capacity), k, p) for k, p in enumerate(people)), key=lambda x: x[0], reverse=True)
    for _ in range(generations):
        if len(people[0][2]) <= bound:
            break
        a, b = rng.integers(0, len(people), 2)
        child = mutate(lengths, crossover(lengths, people[a][2], people[b][2], capacity, rng), capacity, rng)
        people.append((fitness(lengths, child, capacity), 0, child))
        people.sort(key=lambda x: x[0], reverse=True)
        del people[POPULATION:]
    return people[0][2]


def _bins(of: np.ndarray) -> list[list[int]]:
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    return [g.tolist() for g in np.split(order, cuts)]


def _island(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "key"], ascending=[False, True], kind="stable").reset_index(drop=True)
    lengths = pdf["length"].to_numpy(np.int64)
    shard, island = int(pdf["shard"].iloc[0]), int(pdf["island"].iloc[0])
    guests = [_bins(pdf[c].to_numpy()) for c in ("own", "guest") if pdf[c].iloc[0] >= 0]
    best = evolve(lengths, capacity, seed=shard * 31 + island, guests=guests)
    bin_of, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
    for k, members in enumerate(best):
        bin_of[members] = k
        offset[members] = np.cumsum(lengths[members]) - lengths[members]
    fill = np.bincount(bin_of, lengths, minlength=len(best))
    return pd.DataFrame({"shard": shard, "island": island, "key": pdf["key"], "length": lengths, "bin": bin_of, "offset": offset, "fill": fill[bin_of].astype(np.int64), "bins": len(best), "bound": -(-int(lengths.sum()) // capacity)})


def pack(pieces: DataFrame, capacity: int, stash: Stash | None = None) -> DataFrame:
    """Pack rows ``(key string, length long)`` into bins: ``(key, length, sequence_id, offset)``.

    ``key`` must be unique; lengths are 1 to ``capacity``.  ``sequence_id`` is a
    string-free long; offsets are gapless from 0 in each bin.  An empty table gives
    an empty one.
    """
    stash = stash or Stash(pieces.sparkSession, "packing")
    ship(pieces.sparkSession)
    todo, done, level, n = pieces, None, 0, pieces.count()
    while True:
        shards = max(1, round(n / SHARD_PIECES))
        shard = F.pmod(F.xxhash64("key", F.lit(level)), F.lit(shards))
        islands = F.explode(F.array(*map(F.lit, range(ISLANDS))))
        state = todo.select(shard.alias("shard"), "key", "length", islands.alias("island"), F.lit(-1).cast("long").alias("own"), F.lit(-1).cast("long").alias("guest"))
        kind = "shard long, island int, key string, length long, bin long, offset long, fill long, bins long, bound long"
        best = None
        for epoch in range(EPOCHS):
            ran = stash.put(state.groupBy("shard", "island").applyInPandas(lambda pdf: _island(pdf, capacity), kind))
            elite = ran.groupBy("shard").agg(F.min(F.struct("bins", "island"))["island"].alias("island"), (F.min("bins") > F.max("bound")).alias("open"))
            elite = stash.put(elite)
            leaves = ran.join(elite.where("not open" if epoch < EPOCHS - 1 else "true").drop("open"), ["shard", "island"], "left_semi")
            best = leaves if best is None else best.unionByName(leaves)
            if epoch == EPOCHS - 1 or elite.where("open").isEmpty():
                break
            stay = ran.join(elite.where("open").select("shard"), "shard", "left_semi")
            moved = stay.select("shard", "key", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("bin").alias("guest"))
            state = stay.select("shard", "island", "key", "length", F.col("bin").alias("own")).join(moved, ["shard", "island", "key"])
        opened = (F.col("fill") < int(capacity * OPEN_BELOW)) if shards > 1 else F.lit(False)
        packed = stash.put(best.select("key", "length", "shard", "bin", "offset", opened.alias("opened")))
        number = (F.lit(level).cast("long") * (1 << 56)) + F.col("shard") * (1 << 26) + F.col("bin")
        left = packed.where("opened").count() if shards > 1 else 0
        last = not left or left > n * REOPEN_MOST
        closed = (packed if last else packed.where("not opened")).select("key", "length", number.alias("sequence_id"), "offset")
        done = closed if done is None else done.unionByName(closed)
        if last:
            return done
        todo, level, n = packed.where("opened").select("key", "length"), level + 1, left


#: ASCII punctuation that no token joins to a letter before it (fixed value).
AFTER = ".,!?;:#$%&*)"


class WordEncoder:
    """Ids by the tokenizers library, each distinct word of a slice looked up once.

    White space is dropped by the tokenizer and nothing crosses it, so Arrow cuts the
    texts at ASCII white space and numbers the distinct chunks; their ids are gathered
    by those numbers.  A chunk is a word of letters and punctuation after it, which are
    looked up apart, or else it is looked up whole.
    """

    def __init__(self, path: str, cache_bytes: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.words: Cache = Cache(nbytes=cache_bytes or CACHE_BYTES)
        self.last = np.zeros(self.library.get_vocab_size(), bool)
        self.last[[i for t, i in self.library.get_vocab().items() if t.endswith("</w>")]] = True

    def learn(self, new: list[str]) -> None:
        """Encode unseen words.

        Words of letters alone are one word to the tokenizer, and its last token an end of
        word, so they are encoded as one spaced text and told apart at those tokens; all
        others are encoded alone, as are all where that count doesn't fit.
        """
        plain = [w for w in new if w.isalpha()]
        if plain:
            ids = np.array(self.library.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(plain):
                raw, ends = ids.tobytes(), (ends * 4).tolist()
                self.words.update(zip(plain, [raw[a:b] for a, b in zip([0, *ends], ends)]))
                new = [w for w in new if not w.isalpha()]
        for w, e in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False)):
            self.words[w] = array("I", e.ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of each text, without special tokens added."""
        self.words.trim()
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()).fill_null(""))
        coded = cut.flatten().dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        heads = [h if (h := c.rstrip(AFTER)).isalpha() else c for c in chunks]
        tails = [(k, c[len(h) :]) for k, (c, h) in enumerate(zip(chunks, heads)) if len(h) < len(c)]
        keys = [h.lower() if h.isascii() and h.isalpha() else h for h in heads]  # the tokenizer lower-cases too
        words = self.words
        ids = list(map(words.get, keys))
        gaps = [k for k, x in enumerate(ids) if x is None]
        self.learn(words.unknown({keys[k] for k in gaps} | {t for t in {t for _, t in tails} if t not in words}))
        for k in gaps:
            ids[k] = words[keys[k]]
        for k, t in tails:
            ids[k] += words[t]
        packed = pa.array(ids, pa.large_binary()).take(coded.indices)
        at = np.frombuffer(packed.buffers()[1], np.int64, len(packed) + 1, packed.offset * 8)
        ends = at[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
        raw = memoryview(packed.buffers()[2] or b"")
        return [bytes(raw[a:b]) for a, b in zip(ends, ends[1:])]


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder, which outlives a task."""
    return held((WordEncoder, path), lambda: WordEncoder(path))


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: ``doc_id, copy, piece, start, length, ids_crc32[, ids]``.

    A document is its text's ids and then ``end_id``; only longer ones are cut.  A
    null text counts as empty and still gives one piece, the end id alone.  ``copy``
    tells rows with the same id apart.
    """
    tail = array("I", [end_id]).tobytes()
    step = capacity * 4

    def make():
        encoder = word_encoder(tokenizer_path)

        def work(part: pa.RecordBatch, texts: list) -> dict:
            rows = {k: [] for k in ("at", "piece", "start", "length", "ids_crc32", "ids")}
            for at, packed in enumerate(encoder.encode(texts)):
                packed += tail
                for piece, start in enumerate(range(0, len(packed), step)):
                    ids = packed[start : start + step]
                    for k, v in zip(rows, (at, piece, start // 4, len(ids) // 4, zlib.crc32(ids), ids)):
                        rows[k].append(v)
            at = pa.array(rows.pop("at"), pa.int32())
            return rows | {"doc_id": part.column(0).take(at), "copy": part.column(2).take(at)}

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("copy"))
    out = f"doc_id {kind}, copy long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_texts(rows, ["doc_id", "text", "copy"], out, make)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece.

    Null texts are empty documents (one piece, the end id).  Null ids and repeated
    rows are packed like any others, one set of pieces for each row.  Other columns
    are not looked at.  An empty table gives an empty one.

    Texts are read once, in a narrow map; only the few numbers of each piece are
    stored and shuffled, by a hash, so no key can be hot.
    """
    stash = Stash(docs.sparkSession, "packing")
    pieces = stash.put(tokenized_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col))
    key = F.concat_ws(":", F.col("copy").cast("string"), F.col("piece").cast("string"))
    keyed = pieces.withColumn("key", key)
    placed = pack(keyed.select("key", "length"), capacity, stash)
    return keyed.join(placed.drop("length"), "key").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
