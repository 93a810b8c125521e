import random
from collections import Counter

import numpy as np
import pytest

from quillspark.llm.language_id import LanguageModels, identify_languages, kneser_ney, train_models

SYLLABLES = {"aa": "ka lo mi ter san".split(), "bb": "schu ung ver ick öl".split(), "cc": "que ado ción la ez".split()}


def texts(lang, n, rng):
    return [" ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 40))) + "." for _ in range(n)]


@pytest.fixture(scope="module")
def models():
    rng = random.Random(1)
    return LanguageModels({g: texts(g, 60, rng) for g in SYLLABLES})


def test_probabilities_sum_to_one():
    words = Counter("banana bandana ban nab abba".split())
    letters = len(set("".join(words))) + 2
    probs, backs = kneser_ney(words, 3, letters)
    model = LanguageModels({"x": ["banana bandana ban nab abba"]}, order=3)
    for context in ("\x02", "\x02b", "an", "na", "bb"):
        total = 0.0
        for c in [*"abdn", "\x03", "z"]:
            p = 1 / letters
            for k in range(1, 4):
                gram = (context + c)[-k:] if k <= len(context) + 1 else None
                if gram is not None:
                    p = probs[k].get(gram, backs[k].get(gram[:-1], 1.0) * p)
            total += p
        assert abs(total - 1) < 1e-9
    scores, n = model.score_words(["ban", "zq", "a"])
    for word, got, size in zip(["ban", "zq", "a"], scores[:, 0], n):
        marked, want = f"\x02{word}\x03", 0.0
        for end in range(1, len(marked)):
            p = 1 / letters
            for k in range(1, min(3, end + 1) + 1):
                gram = marked[end - k + 1 : end + 1]
                p = probs[k].get(gram, backs[k].get(gram[:-1], 1.0) * p)
            want += np.log(p)
        assert abs(got - want) < 1e-4 and size == len(word) + 1


def test_held_out_accuracy_and_rejection(models):
    rng = random.Random(2)
    for lang in SYLLABLES:
        for t in texts(lang, 30, rng):
            scores, n = models.score_words(t.rstrip(".").split())
            best, score, _, rejected = models.decide(scores.sum(axis=0, keepdims=True), np.array([n.sum()]))
            assert models.langs[best[0]] == lang and not rejected[0] and 0 <= score[0] <= 1
    scores, n = models.score_words(["xqzwj", "wwpfx", "jjgxh", "pqwxz"])
    assert models.decide(scores.sum(axis=0, keepdims=True), np.array([n.sum()]))[3][0]


def test_rows(spark):
    rng = random.Random(3)
    rows = [(k * 3 + j, t, g) for j, g in enumerate(SYLLABLES) for k, t in enumerate(texts(g, 50, rng))]
    odd = [(900, None, "aa"), (901, "", None), (902, "123 +++", "bb"), (904, "½ ² Ⅷ ①", None), (None, rows[0][1], "aa"), rows[5], (903, rows[7][1] * 400, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows + odd], "doc_id long, text string, lang string, score string")
    got = identify_languages(df, train_models(df)).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == g for i, _, g in rows)
    for i in (900, 901, 902, 904):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].cross_entropy, by_id[i].rejected) == ("und", 0.0, None, True)
    assert by_id[None].lang_pred == "aa" and by_id[None].held_out is False
    empty = df.limit(0)
    assert train_models(empty) is None and identify_languages(empty, None).collect() == []
    assert {r.lang_pred for r in identify_languages(df, None).collect()} == {"und"}
