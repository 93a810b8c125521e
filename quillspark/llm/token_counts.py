"""Exact token counts at every prefix of a text (operator 1).

Within a piece, byte-pair merging has an optimal-substructure property: the
encoding of a prefix that ends in token ``t`` is the encoding of the prefix
without ``t`` followed by ``t``, and exactly one ``t`` leaves a pair that merging
would not disturb.  So one pass over the bytes finds, for each prefix, its last
token and its count (``count[i] = count[i - len(t)] + 1``) without ever encoding
a prefix anew.  A text's table is the running sum over its chunks, plus the table
of the chunk in which a prefix ends.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.pretokens import chunks, load_json_ranks
from quillspark.llm.texts import Cache, held, map_texts

#: The split pattern of the byte-level vocabularies (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A rank above all others.
NEVER = 1 << 30


class PrefixCounter:
    """Prefix tables for one vocabulary."""

    def __init__(self, path: str):
        _, self.merges, self.added = load_json_ranks(path)
        self.whole: dict[bytes, bool] = {bytes([b]): True for b in range(256)}
        for a, b in self.merges:
            self.whole.setdefault(a + b, True)
        self.longest = max(map(len, self.whole))
        self.pattern = regex.compile(PATTERN)
        self.space, self.trailing = regex.compile(r"\s+"), regex.compile(r"\s*")
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.edges: tuple[dict, dict] = ({}, {})
        self.fits: Cache = Cache()
        self.tables: Cache = Cache()
        self.counts: Cache = Cache()

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge is the last when ``token`` is merged alone; None if that doesn't give ``token``."""
        parts = [token[i : i + 1] for i in range(len(token))]
        last = None
        while len(parts) > 1:
            rank, at = min((self.merges.get((a, b), NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                return None
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return last or (token, b"")

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stands at the token's first (0) or last (1) place while it is merged, each with the rank that ends it."""
        held = self.edges[side].get(token)
        if held is None:
            parts = self.split(token)
            if parts is None:
                held = []
            elif not parts[1]:
                held = [(token, NEVER)]
            else:
                inner = self.edge(parts[side], side)
                held = [*inner[:-1], (inner[-1][0], self.merges[parts]), (token, NEVER)]
            self.edges[side][token] = held
        return held

    def stands(self, last: bytes | None, token: bytes) -> bool:
        """Whether merging ``last + token`` gives these two back (or ``token`` alone itself).

        It does unless some merge across the border comes before the merges that take
        the symbols at the border away; at equal rank the left one comes first.
        """
        right = self.edge(token, 0)
        got = bool(right)
        if got and last is not None:
            left, i, j = self.edge(last, 1), 0, 0
            while True:
                (a, until_a), (b, until_b) = left[i], right[j]
                rank = self.merges.get((a, b), NEVER)
                if rank < until_a and rank <= until_b and rank < NEVER:
                    got = False
                    break
                if until_a == until_b == NEVER:
                    break
                if until_a <= until_b:
                    i += 1
                else:
                    j += 1
        self.fits[last, token] = got
        return got

    def piece(self, raw: bytes) -> list[int] | bytes:
        """Token counts of every byte prefix of a piece, the empty one first."""
        table = self.tables.get(raw)
        if table is None:
            table = self.tables.recall(raw)
        if table is None:
            n, whole, fits = len(raw), self.whole, self.fits
            table, last = [0] * (n + 1), [None] * (n + 1)
            for i in range(1, n + 1):
                for j in range(i - self.longest if i > self.longest else 0, i):
                    token = raw[j:i]
                    if token in whole:
                        stands = fits.get((last[j], token))
                        if stands is None:
                            stands = self.stands(last[j], token)
                        if stands:
                            table[i], last[i] = table[j] + 1, token
                            break
            if n <= 64:
                table = bytes(table)
                self.tables[raw] = table
        return table

    def chunk(self, chunk: str) -> int:
        """Token count of a chunk."""
        n = self.counts.get(chunk)
        if n is None:
            n = self.counts.recall(chunk)
        if n is None:
            n = sum(self.piece(p.encode())[-1] for p in self.pattern.findall(chunk))
            if len(chunk) <= 64:
                self.counts[chunk] = n
        return n

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Stretches of ordinary text and special strings, in order."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                yield text[at : m.start()], False
            yield m[0], True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    def table(self, text: str | None) -> tuple[list[str], list[int]]:
        """Chunks (special strings are chunks of their own) and the token count of each."""
        if not text:
            return [], []
        self.counts.trim()
        self.tables.trim()
        self.fits.trim()
        if self.special is None or not any(s in text for s in self.added):
            cut = chunks(text)
            counts = list(map(self.counts.get, cut))
            if None in counts:
                counts = [self.chunk(c) if n is None else n for n, c in zip(counts, cut)]
            return cut, counts
        cut, counts = [], []
        for part, special in self.parts(text):
            new = [part] if special else chunks(part)
            cut += new
            counts += [1] if special else map(self.chunk, new)
        return cut, counts

    def inside(self, before: str, chunk: str) -> list[int]:
        """Counts at every character prefix of a chunk, given what precedes it (a space run joins it).

        Only the last piece of a prefix can differ from the whole chunk's pieces: a
        trailing white-space run is one piece; a cut contraction is split anew; for any
        other piece its own table holds the count.
        """
        runs = {}  # by position in the chunk: the count before a run, its table, the bytes done
        for m in self.space.finditer(chunk):
            held = before[len(before) - len(self.trailing.match(before[::-1])[0]) :] if not m.start() else ""
            runs[m.start()] = (held, self.piece((held + m[0]).encode()))
        out, base, run = [0], 0, None
        for m in self.pattern.finditer(chunk):
            piece, table = m[0], self.piece(m[0].encode())
            size = 0
            for k, c in enumerate(piece, 1):
                size += len(c.encode())
                at = m.start() + k - 1
                if at in runs:
                    held, counts = runs[at]
                    done = len(held.encode())
                    run = [out[at] - counts[done], counts, done]
                if self.space.match(c):
                    run[2] += len(c.encode())
                    out.append(run[0] + run[1][run[2]])
                elif piece[0] == "'" and k < len(piece) and piece[1].isalpha():
                    out.append(base + sum(self.piece(p.encode())[-1] for p in self.pattern.findall(piece[:k])))
                else:
                    out.append(base + table[size])
            base += table[-1]
        return out

    def count_at(self, text: str | None, chars: int) -> int:
        """Tokens of the first ``chars`` characters, read from the tables."""
        if not text or chars <= 0:
            return 0
        cut, counts = self.table(text)
        counts = np.cumsum(counts).tolist()
        ends = np.cumsum([len(c) for c in cut]).tolist()
        k = bisect_right(ends, chars)
        done, at = (counts[k - 1], ends[k - 1]) if k else (0, 0)
        if k == len(cut) or at == chars:
            return done
        if cut[k] in self.added:  # a cut special string is ordinary text and joins the chunk before it
            joins = k and cut[k - 1] not in self.added
            part = (cut[k - 1] if joins else "") + cut[k][: chars - at]
            return (counts[k - 2] if k > 1 else 0) * bool(joins) + done * (not joins) + sum(map(self.chunk, chunks(part)))
        return done + self.inside(cut[k - 1] if k else "", cut[k])[chars - at]

    def longest_within(self, text: str | None, budget: int, table: tuple[list[str], list[int]] | None = None) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        cut, counts = table or self.table(text)
        counts = np.cumsum(counts).tolist()
        k = bisect_right(counts, budget)
        chars = sum(map(len, cut[:k]))
        if k < len(cut) and cut[k] not in self.added:
            done = counts[k - 1] if k else 0
            chars += max(i for i, n in enumerate(self.inside(cut[k - 1] if k else "", cut[k])) if done + n <= budget)
        elif k < len(cut):
            text = "".join(cut[: k + 1])
            chars += max(i for i in range(len(cut[k])) if not i or self.count_at(text, chars + i) <= budget)
        return chars


def prefix_counter(path: str) -> PrefixCounter:
    """The worker's counter, which outlives a task."""
    return held((PrefixCounter, path), lambda: PrefixCounter(path))


def token_counts(docs: DataFrame, tokenizer_path: str, budget: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``cut_chars``.

    ``n_tokens`` is what the tokenizers library gives for the whole text with
    ``add_special_tokens=False`` (special strings inside a text are special tokens,
    as is its default).  ``cut_chars`` is the length in characters of the longest
    prefix of at most ``budget`` tokens, read from the prefix table.

    A null text counts as empty (0 bytes, 0 tokens, 0 characters).  Null ids, ties
    and repeated rows pass through, one row out for each row in; other columns of
    ``docs`` are not looked at, whatever their names.  An empty table gives an empty
    one.  A narrow map: no shuffle, one pass, memory bounded by the caches.
    """

    def make():
        counter = prefix_counter(tokenizer_path)

        def work(part: pa.RecordBatch, texts: list) -> dict:
            tokens, cuts = [], []
            for text in texts:
                table = counter.table(text)
                total = sum(table[1])
                tokens.append(total)
                cuts.append(len(text or "") if total <= budget else counter.longest_within(text, budget, table))
            return {"doc_id": part.column(0), "n_bytes": part.column(2), "n_tokens": tokens, "over_limit": [n > budget for n in tokens], "cut_chars": cuts}

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return map_texts(rows, ["doc_id", "text", "n_bytes"], f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, cut_chars long", make)
