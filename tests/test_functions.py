import math

import pytest
from pyspark.sql import functions as F

from quillspark.functions import scoring, text, vectors


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(x):
    return F.lit(x)


def test_knots_map_to_their_quantiles(spark):
    df = spark.createDataFrame([list(k) for k in scoring.RANK_SCORE_KNOTS], "x double, q double")
    for r in df.select("q", scoring.normalized_rank_score(F.col("x")).alias("v")).collect():
        assert r.v == pytest.approx(r.q, abs=1e-9)
    for x, want in ((0.0, 0.0), (1.0, 1.0), (float("nan"), 0.0), (float("inf"), 0.0), (None, 0.0)):
        assert value(spark, scoring.normalized_rank_score(lit(x).cast("double"))) == want
    previous = -1.0
    for r in spark.range(0, 900).select((F.col("id") / 10000).alias("x")).select(scoring.normalized_rank_score(F.col("x")).alias("v")).collect():
        assert r.v >= previous
        previous = r.v


@pytest.mark.parametrize(("raw", "size", "want"), [(1.5, 10, 0.9), (1.0, 1, 0.4), (1.0, 4, 0.7), (1.0, 5, 0.9), (1.0, 15, 1.0), (-1.0, 20, 0.0), (float("nan"), 20, 0.0)])
def test_sized_score(spark, raw, size, want):
    assert value(spark, scoring.sized_score(lit(raw), lit(size))) == pytest.approx(want)


@pytest.mark.parametrize(
    ("best", "projects", "days", "n", "distinct", "want"),
    [(0.02188507, 1, 0.0, 1, 1, 0.275), (0.0738, 2, 0.0, 2, 2, 0.85), (0.0738, 1, 14.0, 2, 2, 0.70), (0.0738, 2, 30.0, 2, 2, 1.0), (0.0, 0, None, 0, 0, 0.0), (0.0, 1, 0.0, 1, 1, 0.0), (1.0, 1, None, 1, 1, 0.55)],
)
def test_confidence(spark, best, projects, days, n, distinct, want):
    assert value(spark, scoring.confidence(lit(best), lit(projects), lit(days).cast("double"), lit(n), lit(distinct))) == pytest.approx(want)


def boost(spark, recalls=0.0, cited=0.0, surfaced=0.0, days=0.0, previous=1.0):
    c = lambda x: lit(x).cast("double")
    return value(spark, scoring.recall_boost(c(recalls), c(cited), c(surfaced), c(days), c(previous)))


def test_recall_boost(spark):
    assert boost(spark) == 1.0
    assert boost(spark, cited=5, surfaced=5, days=None) == 1.0
    assert boost(spark, cited=1000, surfaced=1000) == pytest.approx(1.5)
    assert boost(spark, cited=1000, surfaced=1000, previous=2.0) == pytest.approx(2.0)
    assert abs(boost(spark, recalls=1000) - boost(spark, recalls=200)) < 0.01
    assert boost(spark, cited=3, surfaced=3, days=30) < boost(spark, cited=3, surfaced=3)
    assert boost(spark, recalls=float("nan"), cited=float("nan"), surfaced=None, days=float("nan"), previous=float("nan")) == 1.0
    assert boost(spark, previous=9.0) == pytest.approx(1.5)
    assert boost(spark, cited=2, surfaced=5, recalls=9, days=15, previous=1.2) == pytest.approx(1.2 + 0.5 * (1 + (1 - math.exp(-11 / 12)) * 0.5**0.5 - 1.2))


def test_text_functions(spark):
    assert value(spark, text.fnv1a(lit("hello"))) == "4f9f2cab"
    assert value(spark, text.short_id(lit("ab-cd-ef-gh-ij"))) == "abcdefgh"
    assert value(spark, text.trimmed(lit(" \n\t a b  "))) == "a b"
    assert value(spark, text.truncated(lit("abcdef"), 3)) == "abc…" and value(spark, text.truncated(lit("abc"), 3)) == "abc"
    assert value(spark, text.jaccard(text.token_set(lit("A b, c!")), text.token_set(lit("a B d")))) == pytest.approx(0.5)
    assert value(spark, text.jaccard(text.token_set(lit("")), text.token_set(lit("!!")))) == 1.0
    assert value(spark, text.without_fence(lit('say {"a": {"b": 1}} end'))) == '{"a": {"b": 1}}'


@pytest.mark.parametrize(
    ("raw", "want", "found"),
    [
        ("plain < text", "plain < text", False), ("a <private>x</private> b", "a [redacted] b", True), ("<PRIVATE why='1'>x</Private > y", "[redacted] y", True),
        ("a <private>1<private>2</private>3</private> b", "a [redacted] b", True), ("a <private>open", "a <private>open", False),
        ("<private>x</private> <private>y", "[redacted] <private>y", True), ("</private> a", "</private> a", False), ("<privateer>x</private>", "<privateer>x</private>", False), (None, None, False),
    ],
)
def test_redaction(spark, raw, want, found):
    assert text.redact_private(raw) == (want, found)
    assert value(spark, text.redacted(lit(raw).cast("string"))) == want


@pytest.mark.parametrize(
    ("raw", "n"),
    [('[{"a": 1}, {"a": 2}]', 2), ('```json\n{"insights": [{"a": 1}]}\n```', 1), ('Sure! {"a": 1} done', 1), ('[{"a": 1,}, {"a": 2},]', 2), ('[{"a": 1}, {"a": 2}, {"a": ', 2), ("nothing", 0), ("", 0), (None, 0), ('{"a": 1}', 1)],
)
def test_tolerant_json(raw, n):
    assert len(text.tolerant_json(raw)) == n


def test_vectors(spark):
    a = lambda *x: F.array(*[lit(float(i)) for i in x])
    assert value(spark, vectors.cosine(a(1, 0), a(1, 1))) == pytest.approx(math.sqrt(0.5))
    assert value(spark, vectors.cosine(a(0, 0), a(1, 1))) == 0.0
    assert value(spark, vectors.cosine(a(1, 2, 3), a(1, 2))) == pytest.approx(5 / math.sqrt(14 * 5))
    assert value(spark, vectors.normalized(a(3, 4))) == pytest.approx([0.6, 0.8])


def test_tolerant_json_lets_line_ends_in_strings_pass():
    assert text.tolerant_json('[{"title": "two\nlines", "n": 1},]') == [{"title": "two\nlines", "n": 1}]
    assert text.tolerant_json('first {"a": "x\ny"} then {"b": 2} {"c": ') == [{"a": "x\ny"}, {"b": 2}]
