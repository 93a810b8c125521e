import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillspark.llm import packing
from quillspark.llm.packing import WordEncoder, best_fit, crossover, evolve, pack, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = WordEncoder(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"abcdetsTHEÉ'   \n\t.!#19ß漢Σ", "the", " and", "'ll", "ing", "<|endoftext|>", "<|ENDOFTEXT|>", "İst", ".", "&)", "½", "\x1c", " ", "é", "́"]), max_size=40).map("".join))
def test_words_like_the_library(text):
    assert array("I", ENCODER.encode([text])[0]).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_small_cache_changes_nothing():
    small = WordEncoder(PATH, 4000)
    texts = [" ".join(f"{a}{b}{c}." for a in "xyz" for b in "abcdef"[: k % 7]) + " İzmir DON'T 3rd" for k in range(40) for c in "qrst"] + [None, "", "   "]
    for at in range(0, len(texts), 9):
        part = texts[at : at + 9]
        assert small.encode(part) == ENCODER.encode(part)
        assert [array("I", x).tolist() for x in small.encode(part)] == [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in part]
    assert small.words.old and small.encode([]) == []


def whole(bins, n):
    return sorted(i for b in bins for i in b) == list(range(n))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60), st.integers(0, 9))
def test_every_step_keeps_all_pieces(sizes, seed):
    lengths = np.array(sizes)
    a = best_fit(lengths, list(range(len(sizes))), 100)
    b = best_fit(lengths, list(reversed(range(len(sizes)))), 100)
    child = crossover(lengths, a, b, 100, np.random.default_rng(seed))
    best = evolve(lengths, 100, seed, [])
    for bins in (a, b, child, best):
        assert whole(bins, len(sizes)) and all(lengths[x].sum() <= 100 for x in bins)
    assert -(-lengths.sum() // 100) <= len(best) <= len(best_fit(lengths, np.argsort(-lengths, kind="stable").tolist(), 100))


def test_evolution_beats_plain_best_fit():
    lengths = np.array([49, 41, 34, 33, 29, 26, 26, 22, 20, 19] * 12)
    plain = best_fit(lengths, np.argsort(-lengths, kind="stable").tolist(), 100)
    assert len(evolve(lengths, 100, 1, [], 60)) <= len(plain)


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 40)
    texts = ["word " * (k * 37 % 900) for k in range(150)] + [None, "", "deep learning " * 5000, "Big text <|endoftext|> here"]
    rows = [(k, t, 7) for k, t in enumerate(texts)] + [(3, texts[3], 7), (None, "no id", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length long").repartition(3)
    got = [r.asDict() for r in pack_documents(df, PATH, capacity=1000).collect()]
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1000
    total = 0
    for doc, text, _ in rows:
        ids = (LIBRARY.encode(text, add_special_tokens=False).ids if text else []) + [1]
        total += len(ids)
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc])
        want = [(p, s, len(ids[s : s + 1000]), zlib.crc32(array("I", ids[s : s + 1000]).tobytes())) for p, s in enumerate(range(0, len(ids), 1000))]
        assert mine == sorted(want * sum(d == doc for d, _, _ in rows))
    assert len(by_seq) <= -(-total // 1000) * 1.1
    assert pack_documents(df.limit(0), PATH).collect() == []


@pytest.mark.parametrize("lengths", [[610] * 150, [610] * 140 + [300, 700, 990, 1000] * 10])
def test_pieces_that_cannot_fill_bins(spark, monkeypatch, lengths):
    monkeypatch.setattr(packing, "SHARD_PIECES", 40)
    put = packing.Stash.put
    puts = []

    def counted(self, df):
        puts.append(1)
        assert len(puts) < 60, "pack does not end"
        return put(self, df)

    monkeypatch.setattr(packing.Stash, "put", counted)
    pieces = spark.createDataFrame([(str(k), n) for k, n in enumerate(lengths)], "key string, length long")
    rows = pack(pieces, 1000).collect()
    assert sorted((r.key, r.length) for r in rows) == sorted((str(k), n) for k, n in enumerate(lengths))
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 1000
