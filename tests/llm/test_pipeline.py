import random

import public_tokenizers
from test_minhash import brute
from tokenizers import Tokenizer

import corpus_pipeline
from quillspark.llm.language_id import identify_languages, train_models
from quillspark.llm.toxicity import score_toxicity, train_toxicity

BAD = ["grobnik", "wuzzock", "flimpet"]


def fixture(spark, tmp_path):
    rng = random.Random(5)
    syllables = {"aa": "ka lo mi ter san".split(), "bb": "schu ung ver ick öl".split()}
    rows, marks = [], []
    for k in range(240):
        lang = "aa" if k % 3 else "bb"
        words = ["".join(rng.choices(syllables[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(30, 90))]
        bad = k % 5 == 0
        for _ in range(4 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((k, " ".join(words), lang, "src"))
        marks.append((k, 1, int(bad)))
        if k % 7 == 0:
            copy = list(words)
            copy[rng.randrange(len(copy))] = rng.choice(syllables[lang])
            rows.append((1000 + k, " ".join(copy), lang, "src"))
            rows.append((2000 + k, " ".join(words), lang, "src"))
    rows += [(5000, None, "aa", "s"), (5001, "", None, "s"), (5002, "12345 !!", "bb", "s"), (5003, "xqzwj wwpfx jjgxh pqwxz zzxqk wjxfq " * 3, None, "s"), (None, "kalomi tersan kalo " * 9, "aa", "s")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet")


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs, labels = fixture(spark, tmp_path)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "toxicity", "minhash_near_dedup", "best_fit_packing"]
    rejected = {r.doc_id for r in identify_languages(docs, train_models(docs)).where("rejected").collect()}
    assert {5000, 5001, 5002, 5003} == rejected
    kept = stages["language_id"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - rejected

    toxic = {r.doc_id for r in score_toxicity(kept, train_toxicity(kept, labels)).where("predicted = 1").collect()}
    civil = stages["toxicity"](spark, kept, str(tmp_path))
    assert civil.columns == docs.columns
    assert {r.doc_id for r in civil.collect()} == {r.doc_id for r in kept.collect()} - toxic
    wanted = {r.doc_id for r in kept.collect() if any(b in r.text for b in BAD)}
    assert len(toxic ^ wanted) <= 3

    one = stages["minhash_near_dedup"](spark, civil, str(tmp_path))
    assert one.columns == docs.columns
    groups = brute([(r.doc_id, r.text) for r in civil.collect() if r.doc_id is not None], 5)
    assert {r.doc_id for r in one.collect()} == {i for i, (_, _, keep) in groups.items() if keep} | {None}

    packed = stages["best_fit_packing"](spark, one, str(tmp_path)).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in one.collect()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_run_applies_all_stages_and_repeated_rows_go(spark, tmp_path):
    fixture(spark, tmp_path)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and len({r.doc_id for r in got}) == len({(r.doc_id, r.start) for r in got}) == len(got)
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, "")], "doc_id long, text string")
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["minhash_near_dedup"](spark, twice, "").collect()) == [1, 3]


def test_all_operators_are_registered():
    from quillspark.llm.queries import queries

    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
