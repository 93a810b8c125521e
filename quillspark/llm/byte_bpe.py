"""Byte-level BPE by corpus-level merge replay, and its decoding (operator 7).

The distinct pieces of a block of the corpus are laid out as one sequence of
symbols with links to left and right neighbours.  An inverted index holds, for
every adjacent pair of symbols, the positions where it occurs.  Merges are taken
from a queue in rank order; each is applied at all its positions in all pieces at
once, and only the pairs that touch a merged position enter or leave the index.
Pieces never interact, so a piece's ids do not depend on the block it is in.
"""

from __future__ import annotations

import hashlib
from array import array
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.pretokens import chunks, load_ranks
from quillspark.llm.texts import Cache, held, map_texts


class MergeReplay:
    """Encoder and decoder for a file of ranks; a token's id is its rank."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.pattern = regex.compile(pattern)
        self.joined: dict[tuple[int, int], int | None] = {}
        self.pieces: Cache = Cache()
        self.chunks: Cache = Cache()

    def _join(self, a: int, b: int) -> int | None:
        """The id of two symbols as one, if there is one; it is also the merge's rank."""
        key = (a, b)
        if key not in self.joined:
            if len(self.joined) > 1_000_000:
                self.joined.clear()
            self.joined[key] = self.ranks.get(self.tokens[a] + self.tokens[b])
        return self.joined[key]

    def replay(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each of some distinct pieces, by replaying merges over all of them."""
        symbol, right, left, first = [], [], [], []
        for p in pieces:
            at = len(symbol)
            first.append(at)
            symbol += [self.single[b] for b in p]
            n = len(symbol)
            right += [*range(at + 1, n), -1]
            left += [-1, *range(at, n - 1)]
        join, known = self._join, self.joined
        index: dict[int, list[int]] = {}
        for at, after in enumerate(right):
            if after >= 0:
                a, b = symbol[at], symbol[after]
                new = known[a, b] if (a, b) in known else join(a, b)
                if new is not None:
                    index.setdefault(new, []).append(at)
        queue = list(index)
        heapify(queue)
        while queue:
            new = heappop(queue)
            places = index.pop(new, None)
            if places is None:
                continue
            places.sort()  # equal neighbours merge from the left
            for at in places:
                after = right[at]
                if after < 0 or symbol[at] < 0 or join(symbol[at], symbol[after]) != new:
                    continue  # an earlier merge took one of the two
                symbol[at], symbol[after] = new, -1
                beyond = right[at] = right[after]
                right[after] = -1
                if beyond >= 0:
                    left[beyond] = at
                    b = symbol[beyond]
                    touched = known[new, b] if (new, b) in known else join(new, b)
                    if touched is not None:
                        if touched not in index:
                            index[touched] = []
                            heappush(queue, touched)
                        index[touched].append(at)
                before = left[at]
                if before >= 0:
                    a = symbol[before]
                    touched = known[a, new] if (a, new) in known else join(a, new)
                    if touched is not None:
                        if touched not in index:
                            index[touched] = []
                            heappush(queue, touched)
                        index[touched].append(before)
        out = []
        for at in first:
            ids = []
            while at >= 0:
                ids.append(symbol[at])
                at = right[at]
            out.append(ids)
        return out

    def encode_block(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for kept in (self.chunks, self.pieces):
            kept.trim()
        cut = [chunks(t) if t else [] for t in texts]
        got = [list(map(self.chunks.get, c)) for c in cut]
        gaps = [(c, g, [k for k, x in enumerate(g) if x is None]) for c, g in zip(cut, got) if None in g]
        new = [w for w in {c[k] for c, _, at in gaps for k in at} if self.chunks.recall(w) is None]
        split = {w: [p.encode() for p in self.pattern.findall(w)] for w in new}
        unseen = [p for p in set().union(*split.values()) if p not in self.pieces and self.pieces.recall(p) is None]
        for p, ids in zip(unseen, self.replay(unseen)):
            self.pieces[p] = array("I", ids).tobytes()
        for w, pieces in split.items():
            self.chunks[w] = b"".join([self.pieces[p] for p in pieces])
        for c, g, at in gaps:
            for k in at:
                g[k] = self.chunks[c[k]]
        return [b"".join(g) for g in got]

    def decode(self, packed: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        return b"".join(map(self.tokens.__getitem__, array("I", packed)))


def merge_replay(path: str, pattern: str) -> MergeReplay:
    """The worker's encoder, which outlives a task."""
    return held((MergeReplay, path, pattern), lambda: MergeReplay(path, pattern))


def byte_bpe(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``ids`` (packed, little-endian unsigned 32-bit), ``decoded`` bytes.

    Ids equal the tiktoken library's ``encode_ordinary``: no special tokens, each
    match of ``pattern`` on its own.  A null text counts as empty: no ids.  Null ids,
    ties and repeated rows pass through, one row out for each row in; other columns
    are not looked at; an empty table gives an empty one.  A narrow map without a
    shuffle; a worker holds a block's texts and bounded caches.
    """
    def make():
        replay = merge_replay(ranks_path, pattern)

        def work(part: pa.RecordBatch, texts: list) -> dict:
            packed = replay.encode_block(texts)
            return {"doc_id": part.column(0), "ids": packed, "decoded": [replay.decode(p) for p in packed]}

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(rows, ["doc_id", "text"], f"doc_id {kind}, ids binary, decoded binary", make)


def byte_bpe_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`byte_bpe` reduced to ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    def make():
        replay = merge_replay(ranks_path, pattern)

        def work(part: pa.RecordBatch, texts: list) -> dict:
            packed = replay.encode_block(texts)
            return {
                "doc_id": part.column(0),
                "n_tokens": [len(p) // 4 for p in packed],
                "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
                "decoded_sha256": [hashlib.sha256(replay.decode(p)).hexdigest() for p in packed],
            }

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(rows, ["doc_id", "text"], f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
