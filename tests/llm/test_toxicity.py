import random

import numpy as np
import pytest

from quillspark.llm.toxicity import DECAY, Subsequences, ToxicityModel, score_toxicity, spaced_units, squared_hinge, train_toxicity, units_of

BAD = ["grobnik", "wuzzock", "flimpet"]


def corpus(n, seed):
    rng = random.Random(seed)
    syllables = "ka lo mi ter san ver ick que la ez on er th ing".split()
    texts, labels = [], []
    for k in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 80))]
        bad = k % 4 == 0
        for _ in range(rng.randint(2, 4) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        texts.append(". ".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9)))
        labels.append(int(bad))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    texts, labels = corpus(400, 1)
    return ToxicityModel(texts, labels, {0: 1.0, 1: 1.0})


def test_units():
    assert units_of("I.d.i.o.t!!") == ["idiot"]
    assert units_of("foo-barbaz") == ["foobarbaz", "foo", "barbaz"]
    assert units_of("$$$ 12") == []
    assert spaced_units("such an i d i o t he is") == ["idiot"]


def test_features_are_decayed_common_subsequences():
    features = Subsequences("abcdefgh")
    owner, code, weight = features(["abc", "axbc"])
    kernel = sum(w * v for c, w in zip(code[owner == 0], weight[owner == 0]) for d, v in zip(code[owner == 1], weight[owner == 1]) if c == d)
    # by hand, with end marks: the subsequences of three and four of the marked words within the windows
    def weights(s):
        out = {}
        for n, window in ((3, 5), (4, 6)):
            from itertools import combinations

            for at in combinations(range(len(s)), n):
                if at[-1] - at[0] < window:
                    key = "".join(s[i] for i in at)
                    out[key] = out.get(key, 0) + DECAY ** (at[-1] - at[0] + 1 - n)
        return out

    a, b = weights("<abc>"), weights("<axbc>")
    assert abs(kernel - sum(v * b.get(k, 0) for k, v in a.items())) < 1e-9


def test_squared_hinge_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5))
    y = np.sign(x[:, 0] + 0.3)
    w = squared_hinge(x, y, np.ones(200), 10.0)
    assert ((np.column_stack([x, np.ones(200)]) @ w > 0) == (y > 0)).mean() > 0.97


def rows_for(spark, n, seed):
    texts, labels = corpus(n, seed)
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, score string")
    marks = spark.createDataFrame([(k, y) for k, y in enumerate(labels)] + [(None, 1), (5, None), (10**6, 1)], "doc_id long, toxic int")
    return texts, labels, docs, marks


def test_held_out_accuracy_and_odd_rows(spark):
    texts, labels, docs, marks = rows_for(spark, 400, 2)
    odd = [(900, None, "x"), (901, "", "x"), (902, "12 ++", "x"), (None, texts[0], "x"), (0, texts[0], "x"), (903, "calm words " * 9000 + "grobnik wuzzock flimpet wuzzock", "x")]
    everything = docs.union(spark.createDataFrame(odd, docs.schema))
    got = score_toxicity(everything, train_toxicity(docs, marks)).collect()
    assert len(got) == 406
    by_id = {r.doc_id: r for r in got}
    held = [k for k in range(400) if by_id[k].held_out]
    assert 40 < len(held) < 140
    assert np.mean([by_id[k].predicted == labels[k] for k in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert by_id[900].score == by_id[901].score == by_id[902].score < 0.5
    assert by_id[903].predicted == 1 and by_id[None].held_out is False


def test_gaps_and_insertions(model):
    from quillspark.llm.toxicity import summary

    def score(words):
        units = [u for w in words.split() for u in units_of(w)] + spaced_units(words)
        return model.score(np.array([summary(model.units(units))]))[0]

    calm = "kalo minter sanver ickla onering thela kamilo " * 5
    assert score(calm) < 0.5
    for bad in ("grobnik wuzzock", "g.r.o.b.n.i.k w-u-z-z-o-c-k", "grobxnik wuzzaock flimpyet", "g r o b n i k and w u z z o c k"):
        assert score(calm + bad) > 0.5, bad


def test_nothing_to_learn_from(spark):
    _, _, docs, marks = rows_for(spark, 8, 3)
    assert train_toxicity(docs, marks.limit(0)) is None
    assert {(r.score, r.predicted) for r in score_toxicity(docs, None).collect()} == {(0.0, 0)}
    assert score_toxicity(docs.limit(0), None).collect() == []


def test_scoring_cuts_at_all_white_space(model):
    from quillspark.llm.toxicity import _scores

    text = "kalo mi grobnik san wuzzock ver flimpet lo"
    texts = [text] + [text.replace(" ", gap) for gap in ("\t", "\u00a0", "\r\n", "\u2003")] + ["", " \t ", None]
    got = _scores(model, texts)
    assert np.allclose(got[1:5], got[0], atol=1e-12) and np.allclose(got[5:], got[5])
