"""Licence scans by a trained paragraph classifier (operator 6); scanning is in DataFrame functions only.

A paragraph's words and word pairs are hashed into slots.  A multinomial logistic
regression with an L1 penalty, trained on licence notices, spoilt copies of them and
paragraphs that are none, gives each family and the unknown class a sparse set of
weights; its temperature and the threshold for a prediction are set on examples kept
back.  A predicted family is confirmed by comparing the paragraph's word triples with
those of the family's notices.

Weights are constants of the plan, so a scan is one narrow pass without joins or
shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.licence_texts import NOTICES, OTHERWISE

#: Slots for words and pairs, spoilt copies of a notice, L1 penalty, documents whose paragraphs are examples of none, and paragraphs taken of them.
SLOTS, COPIES, PENALTY, SAMPLE, PARAGRAPHS = 1 << 13, 60, 4e-4, 300, 3000
#: Share of word triples in common from which a notice confirms a prediction.
CONFIRMS = 0.5

_SPLIT = r"[^\p{L}\p{N}]+"


def _hash(text: str) -> int:
    """What Spark's ``xxhash64`` gives for a string."""
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def words_of(paragraph: str) -> list[str]:
    return re.findall(r"[^\W_]+", paragraph.lower())


def slots_of(paragraph: str) -> set[int]:
    words = words_of(paragraph)
    return {_hash(g) % SLOTS for g in [*words, *map(" ".join, zip(words, words[1:]))]}


def triples_of(paragraph: str) -> set[int]:
    words = words_of(paragraph)
    return {_hash(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))} if words else set()


def spoil(paragraph: str, filler: Sequence[str], rng: np.random.Generator) -> str:
    """A copy with words lost or changed, possibly cut, within other words."""
    words = paragraph.split()
    if len(words) > 12 and rng.random() < 0.5:
        size = int(rng.integers(10, len(words)))
        start = int(rng.integers(0, len(words) - size + 1))
        words = words[start : start + size]
    loss = rng.random() * 0.15
    words = [str(rng.choice(filler)) if rng.random() < loss / 2 else w for w in words if rng.random() >= loss]
    before, after = (list(rng.choice(filler, int(rng.integers(0, 25)))) if rng.random() < 0.4 else [] for _ in range(2))
    return " ".join([*map(str, before), *words, *map(str, after)])


class LicenceModel:
    """Sparse weights per family, temperature and threshold."""

    def __init__(self, paragraphs: Sequence[str] = (), seed: int = 3):
        rng = np.random.default_rng(seed)
        self.families = sorted(NOTICES)
        plain = [p for p in paragraphs if p.strip()]
        filler = sorted({w for p in plain[:300] for w in p.split()})[:5000] or ["lorem"]
        known = [(f, triples_of(n)) for f in self.families for n in NOTICES[f]]
        plain = [p for p in plain if all(len(triples_of(p) & t) < CONFIRMS * len(t) for _, t in known)] + OTHERWISE * 20
        texts, labels = [], []
        for k, f in enumerate(self.families):
            for n in NOTICES[f]:
                copies = [n] * 6 + [spoil(n, filler, rng) for _ in range(COPIES)]
                texts += copies
                labels += [k] * len(copies)
        texts += plain
        labels += [len(self.families)] * len(plain)
        y = np.array(labels)
        slots = [slots_of(t) for t in texts]
        used = sorted({s for f in self.families for n in NOTICES[f] for s in slots_of(n)})
        place = {s: i for i, s in enumerate(used)}
        x = np.zeros((len(texts), len(used)), np.float32)
        for i, own in enumerate(slots):
            x[i, [place[s] for s in own if s in place]] = 1
        kept_back = rng.random(len(y)) < 0.2
        w, b = self._fit(x[~kept_back], y[~kept_back])
        score = x[kept_back] @ w + b
        self.temperature = min((0.5, 0.7, 0.85, 1.0, 1.25, 1.5, 2.0, 3.0), key=lambda t: self._loss(score / t, y[kept_back]))
        chance = self._soft(score / self.temperature)
        best, top = chance[:, :-1].argmax(axis=1), chance[:, :-1].max(axis=1)
        right = lambda t: np.where(top >= t, best, len(self.families)) == y[kept_back]
        self.threshold = max((0.5, 0.6, 0.7, 0.8, 0.9), key=lambda t: float(right(t).mean()))
        self.bias = b.astype(float)
        self.weights = {s: w[i].astype(float) for s, i in place.items() if np.abs(w[i]).max() > 1e-6}
        self.triples = {f: [sorted(t) for g, t in known if g == f] for f in self.families}

    def _fit(self, x: np.ndarray, y: np.ndarray, steps: int = 250) -> tuple[np.ndarray, np.ndarray]:
        """Accelerated proximal gradient; classes weigh equally but for the unknown, which weighs four times."""
        k = len(self.families) + 1
        count = np.bincount(y, minlength=k)
        weight = (np.where(np.arange(k) == k - 1, 4.0, 1.0) / np.maximum(count, 1))[y]
        weight = (weight / weight.sum()).astype(np.float32)
        target = np.eye(k, dtype=np.float32)[y]
        w, b = np.zeros((x.shape[1], k), np.float32), np.zeros(k, np.float32)
        vw, vb, t = w, b, 1.0
        step = 4.0 / max(1.0, float((weight * (x**2).sum(axis=1)).sum()))
        for _ in range(steps):
            gap = (self._soft(x @ vw + vb) - target) * weight[:, None]
            new = vw - step * (x.T @ gap)
            new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
            new_b = vb - step * gap.sum(axis=0)
            after = (1 + (1 + 4 * t * t) ** 0.5) / 2
            vw, vb = new + (t - 1) / after * (new - w), new_b + (t - 1) / after * (new_b - b)
            w, b, t = new, new_b, after
        return w, b

    @staticmethod
    def _soft(score: np.ndarray) -> np.ndarray:
        e = np.exp(score - score.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def _loss(self, score: np.ndarray, y: np.ndarray) -> float:
        return float(-np.log(np.maximum(self._soft(score)[np.arange(len(y)), y], 1e-12)).mean())

    def predict(self, paragraph: str) -> tuple[str | None, float, float]:
        """Family (or None), its probability and the share in common with its nearest notice; the plain form of the scan."""
        rows = [self.weights[s] for s in slots_of(paragraph) if s in self.weights]
        if not rows:
            return None, 0.0, 0.0
        chance = self._soft(((np.sum(rows, axis=0) + self.bias) / self.temperature)[None])[0, :-1]
        k = int(chance.argmax())
        if chance[k] < self.threshold:
            return None, 0.0, 0.0
        own = triples_of(paragraph)
        alike = max((max(len(own & set(t)) / len(t), len(own & set(t)) / max(1, len(own))) for t in self.triples[self.families[k]]), default=0.0)
        return self.families[k], float(chance[k]), alike


def train_licences(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> LicenceModel:
    """A model whose examples of no licence are paragraphs of about ``sample`` documents, chosen by a hash of their text."""
    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    share = min(1.0, sample / max(1, docs.count()))
    chosen = texts.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000)).dropDuplicates()
    lines = sorted({p for r in chosen.toLocalIterator() for p in r[0].split("\n") if p.strip()}, key=_hash)
    return LicenceModel(lines[:PARAGRAPHS])


def _longs(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def scan_licences(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_paragraphs, licence, candidate, probability, confirmed, families, paragraphs, probabilities, alike``.

    Paragraphs are lines, numbered from 0.  ``families``, ``paragraphs``,
    ``probabilities`` and ``alike`` list every paragraph that a family is predicted for.
    ``candidate`` is the most probable confirmed family, else the most probable one (with
    ``confirmed`` false), else null; ``licence`` is it if it is confirmed.  A null text has no paragraphs.  Null ids, ties and
    repeated rows pass through, one row out for each row in; other columns are not
    looked at; an empty table gives an empty one.
    """
    slots = sorted(model.weights)
    number = {s: i for i, s in enumerate(slots)}
    spot = F.array(*[F.lit(number.get(s, -1)) for s in range(SLOTS)])
    table = [F.array(*[F.lit(float(model.weights[s][k])) for s in slots]) for k in range(len(model.families) + 1)]

    def hashed(grams: Column) -> Column:
        return F.filter(F.array_distinct(F.transform(grams, lambda g: spot[F.pmod(F.xxhash64(g), F.lit(SLOTS)).cast("int")])), lambda s: s >= 0)

    def adding(t: Column):
        return lambda acc, i: acc + t[i]

    def pairs(w: Column) -> Column:
        return F.when(F.size(w) < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat(w[i], F.lit(" "), w[i + 1])))

    def triples(w: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice(w, i, 3), " "))))

    def alike(own: Column, family: str) -> Column:
        shares = []
        for t in model.triples[family]:
            both = F.size(F.array_intersect(own, _longs(t)))
            shares.append(both / F.least(F.lit(len(t)), F.size(own)))
        return F.greatest(*shares, F.lit(0.0))

    def judged(paragraph: Column, at: Column) -> Column:
        words = F.filter(F.split(F.lower(paragraph), _SPLIT), lambda w: w != "")

        def with_words(w: Column) -> Column:
            def with_slots(s: Column) -> Column:
                scores = [(F.aggregate(s, F.lit(float(model.bias[k])), adding(t)) / model.temperature) for k, t in enumerate(table)]

                def with_scores(v: Column) -> Column:
                    whole = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + F.exp(x - F.array_max(v)))
                    top = F.array_max(F.slice(v, 1, len(model.families)))
                    chance = F.exp(top - F.array_max(v)) / whole
                    family = F.element_at(F.array(*map(F.lit, model.families)), F.array_position(v, top).cast("int"))
                    return F.when(chance >= model.threshold, F.struct(at.alias("paragraph"), family.alias("family"), chance.alias("probability"), w.alias("words")))

                return F.when(F.size(s) > 0, F.transform(F.array(F.array(*scores)), with_scores)[0])

            return F.transform(F.array(F.array_distinct(F.concat(hashed(w), hashed(pairs(w))))), with_slots)[0]

        return F.transform(F.array(words), with_words)[0]

    def confirmed(hit: Column) -> Column:
        def with_triples(own: Column) -> Column:
            value = F.lit(0.0)
            for f in model.families:
                value = F.when(hit["family"] == f, alike(own, f)).otherwise(value)
            return value

        return F.struct(hit["paragraph"].alias("paragraph"), hit["family"].alias("family"), hit["probability"].alias("probability"), F.transform(F.array(triples(hit["words"])), with_triples)[0].alias("alike"))

    lines = F.split(F.col(text_col), "\n", -1)
    hits = F.filter(F.transform(lines, judged), lambda h: h.isNotNull())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.size(lines), F.lit(0)).alias("n"), F.transform(F.coalesce(hits, F.array().cast("array<struct<paragraph:int,family:string,probability:double,words:array<string>>>")), confirmed).alias("hits"))
    ranked = F.array_sort(
        F.transform("hits", lambda h: F.struct((h["alike"] < CONFIRMS).alias("loose"), (-h["probability"]).alias("order"), h["family"].alias("family")))
    )
    best = F.get(ranked, F.lit(0))
    return rows.select(
        "doc_id", F.greatest("n", F.lit(0)).cast("long").alias("n_paragraphs"), F.when(~best["loose"], best["family"]).alias("licence"), best["family"].alias("candidate"), (-best["order"]).alias("probability"), (~best["loose"]).alias("confirmed"),
        *[F.col(f"hits.{k}").alias(name) for k, name in (("family", "families"), ("paragraph", "paragraphs"), ("probability", "probabilities"), ("alike", "alike"))],
    )
