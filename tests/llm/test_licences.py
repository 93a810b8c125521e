import numpy as np
import pytest

from quillspark.llm.licence_texts import NOTICES
from quillspark.llm.licences import LicenceModel, scan_licences, spoil, train_licences

PLAIN = ["ka lomi ter san ver ick la que ez on er the and of " + str(k) for k in range(200)] + ["the license of the car was version 2", "public works in general", "We met under the oak. " * 30]


@pytest.fixture(scope="module")
def model():
    return LicenceModel(PLAIN)


def test_held_out_accuracy(model):
    rng = np.random.default_rng(99)
    filler = "alpha beta gamma delta the and of to in".split()
    right = total = 0
    for family, notices in NOTICES.items():
        for n in notices:
            for _ in range(10):
                got = model.predict(spoil(n, filler, rng))[0]
                right += got == family
                total += 1
    assert right / total > 0.9
    assert all(model.predict(p)[0] is None for p in ("The licence office is open on Monday", "He modified the copy and distributed it", "", "plain words of nothing"))
    assert sum(len([1 for x in w if x]) for w in model.weights.values()) < 0.5 * len(model.weights) * (len(model.families) + 1)


def test_scan_matches_plain_form(spark, model):
    texts = [
        None, "", "\n", "Just words\nLicensed under CC BY-NC 4.0.\nmore words", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0. " + "words beside it " * 40, "\n".join(NOTICES["MIT"]), "no notice here but a license plate", "é Ünder Lizenz\n" * 50 + NOTICES["BSD"][3], "GNU GENERAL PUBLIC LICENSE",
        "Licensed under CC BY 4.0.\nLicensed under CC BY-SA 4.0.",
    ]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, texts[3], "x"), (4, texts[4], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, licence string")
    got = scan_licences(df, model).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id if r.doc_id is not None else 3]
        lines = [] if text is None else text.split("\n")
        want = [(k, *model.predict(p)) for k, p in enumerate(lines)]
        want = [w for w in want if w[1]]
        assert r.n_paragraphs == len(lines)
        assert (r.paragraphs, r.families) == ([w[0] for w in want], [w[1] for w in want]), text
        assert r.probabilities == pytest.approx([w[2] for w in want]) and r.alike == pytest.approx([w[3] for w in want])
        best = min(((w[3] < 0.5, -w[2], w[1]) for w in want), default=None)
        assert r.candidate == (best[2] if best else None) and r.licence == (r.candidate if r.confirmed else None) and r.confirmed == (None if best is None else not best[0])
    by_id = {r.doc_id: r.licence for r in got}
    assert [by_id[k] for k in (3, 4, 5, 6, 7)] == ["CC-BY-NC", "MIT", "GPL", "Apache-2.0", "MIT"]
    assert scan_licences(df.limit(0), model).collect() == []


def test_training_from_a_table(spark):
    df = spark.createDataFrame([(k, f"{p}\nReleased under the MIT License.") for k, p in enumerate(PLAIN)] + [(999, None)], "doc_id long, text string")
    model = train_licences(df)
    assert model.predict("Released under the MIT License.")[0] == "MIT"
    assert train_licences(df.limit(0)).predict("Licensed under CC BY-NC 4.0.")[0] == "CC-BY-NC"
