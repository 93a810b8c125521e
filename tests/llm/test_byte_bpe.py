import hashlib
from array import array

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm.byte_bpe import MergeReplay, byte_bpe, byte_bpe_digests
from quillspark.llm.pretokens import load_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
REPLAY = MergeReplay(PATH, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"abcdetsTHEzz'   \n\t.!#19éß漢", "the", " and", "'ll", "ing", "aaaaaaa", "<|endoftext|>", "\x1c", " "]), max_size=30).map("".join), max_size=6))
def test_like_the_library(texts):
    packed = REPLAY.encode_block(texts)
    assert [array("I", p).tolist() for p in packed] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [REPLAY.decode(p) for p in packed] == [t.encode() for t in texts]


def test_rows(spark):
    rows = [(1, "the cat's pyjamas  \n", "x"), (None, "x", "y"), (2, None, ""), (3, "", ""), (4, "lowest newer wider " * 2000, ""), (1, "the cat's pyjamas  \n", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    for r in byte_bpe_digests(df, PATH, public_tokenizers.PATTERN).collect():
        text = next(t for i, t, _ in rows if i == r.doc_id) or ""
        ids = LIBRARY.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    full = byte_bpe(df, PATH, public_tokenizers.PATTERN).collect()
    assert len(full) == 6 and bytes(full[0].decoded).decode() == rows[0][1]
    assert byte_bpe(df.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
