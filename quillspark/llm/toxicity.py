"""Toxicity by a subsequence string-kernel machine with Nyström landmarks (operator 3).

A unit is a word of a sentence with everything but its letters removed, so that
inserted punctuation ("i.d.i.o.t") and spacing ("i d i o t") vanish.  The kernel
between units counts common subsequences of three and four characters within a
window of five and six, decayed by the gaps they span, so that inserted characters ("idxiot") cost
little.  A linear machine is trained on the units of labelled sentences in the
space of kernel values to a few landmark units (Nyström).  A toxic text need hold
only a few toxic units, so which units carry the label is found by alternating
between training and choosing them (multiple-instance learning).

The decision value is a weighted sum of kernels to the landmarks, and the kernel is
a dot product of explicit subsequence weights; so the landmarks fold into one
weight per subsequence, and a unit costs one table look-up per subsequence however
many landmarks there are.  A text's score is a calibrated logistic function of its
few highest unit values.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.sampling import labelled_sample
from quillspark.llm.texts import Cache, filter_texts, held, is_held_out, learnable, map_texts

#: Decay per gap, window, slots of the table of subsequences, landmarks, and labelled documents of each label used for training (about).
DECAY, WINDOW, SLOTS, LANDMARKS, SAMPLE = 0.7, 6, 1 << 20, 288, 3000
#: The most frequent toxic units, of which copies with an inserted letter are trained on too.
SPOILT = 120
#: Units of clean sentences that train the machine at first, those added in each round as they were hardest, and rounds of choosing the toxic ones.
NEGATIVES, HARDEST, CHOICES = 6_000, 2_000, 2

LETTERS = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
SPACED = re.compile(r"(?<!\S)(?:[^\W\d_] ){2,}[^\W\d_](?!\S)")
_THREES = [(a, b) for b in range(2, WINDOW - 1) for a in range(1, b)]
_FOURS = [(a, b, c) for c in range(3, WINDOW) for b in range(2, c) for a in range(1, b)]


def units_of(chunk: str) -> list[str]:
    """Units of a white-space-delimited chunk: its letters joined, and its longer runs where it has several."""
    runs = LETTERS.findall(chunk.lower())
    if len(runs) <= 1:
        return runs
    return ["".join(runs), *(r for r in runs if len(r) > 2)]


def spaced_units(text: str) -> list[str]:
    """Words written with a space after each letter."""
    return [m.replace(" ", "").lower() for m in SPACED.findall(text)]


class Subsequences:
    """Explicit features: three or four characters in order within the window, each by its decayed weight."""

    def __init__(self, alphabet: str):
        self.codes = np.full(0x110000 // 16, 62, np.int64)
        for k, c in enumerate(alphabet[:61]):
            if ord(c) < len(self.codes):
                self.codes[ord(c)] = k

    def __call__(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit number, subsequence code and weight; one entry for each distinct pair."""
        if not units:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        sizes = np.array([len(u) for u in units], np.int64) + 2
        points = np.frombuffer("".join(f" {u} " for u in units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        codes = self.codes[np.minimum(points, len(self.codes) - 1)]
        ends = np.cumsum(sizes)
        codes[ends - sizes], codes[ends - 1] = 61, 63
        owner = np.repeat(np.arange(len(units)), sizes)
        limit = np.repeat(ends, sizes)
        at = np.arange(len(codes))
        keys, weights = [], []
        for offsets in (*_THREES, *_FOURS):
            i = at[at + offsets[-1] < limit]
            code = codes[i]
            for o in offsets:
                code = (code << 6) | codes[i + o]
            if len(offsets) == 3:
                code = ((code * 0x9E3779B1) >> 12) + 7
            keys.append((owner[i] << 20) | (code & (SLOTS - 1)))
            weights.append(np.full(len(i), DECAY ** (offsets[-1] - len(offsets))))
        keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        return keys >> 20, keys & (SLOTS - 1), np.bincount(inverse, np.concatenate(weights), len(keys))


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float, steps: int = 8) -> np.ndarray:
    """A linear machine with squared hinge loss by Newton steps; the last coefficient is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1.0)
    ridge[-1] = 1e-6
    for _ in range(steps):
        on = y * (x @ w) < 1
        xa, wa = x[on], weight[on] * cost
        new = np.linalg.solve((xa * wa[:, None]).T @ xa + np.diag(ridge), (xa * (wa * y[on])[:, None]).sum(axis=0))
        if np.abs(new - w).max() < 1e-6:
            return new
        w = new
    return w


def rising_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps without falling coefficients: features whose coefficient would be negative are left out.  The last one is the bias."""
    use = np.arange(x.shape[1])
    while True:
        design = np.column_stack([x[:, use], np.ones(len(x))])
        penalty = np.append(np.full(len(use), ridge), 1e-6)
        w = np.zeros(len(use) + 1)
        loss = lambda w: float((weight * np.logaddexp(0, np.where(y > 0, -1, 1) * (design @ w))).sum() + (penalty * w * w).sum() / 2)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            curve = weight * p * (1 - p) + 1e-9
            step = np.linalg.solve((design * curve[:, None]).T @ design + np.diag(penalty), design.T @ (weight * (y - p)) - penalty * w)
            while np.abs(step).max() > 1e-6 and loss(w + step) > loss(w):
                step = step / 2
            w = w + step
            if np.abs(step).max() < 1e-6:
                break
        if (w[:-1] >= 0).all():
            out = np.zeros(x.shape[1] + 1)
            out[use], out[-1] = w[:-1], w[-1]
            return out
        use = use[w[:-1] >= 0]


class Sentences:
    """Units of the distinct sentences of some texts, as numbers."""

    def __init__(self, texts: list[str | None]):
        number: dict[str, int] = {}
        owner, hashes, sizes, units = [], [], [], array("i")
        for k, text in enumerate(texts):
            for s in dict.fromkeys(SENTENCE.split(text or "")):
                found = {u for c in s.split() for u in units_of(c)} | set(spaced_units(s))
                owner.append(k)
                hashes.append(xxhash.xxh3_64_intdigest(s) >> 1)
                sizes.append(len(found))
                units.extend(sorted(number.setdefault(u, len(number)) for u in sorted(found)))
        self.names = list(number)
        self.owner, self.hashes = np.array(owner, np.int64), np.array(hashes, np.int64)
        self.sizes, self.units = np.array(sizes, np.int64), np.array(units, np.int64)
        self.of_unit = np.repeat(np.arange(len(owner)), self.sizes)

    def counts(self, texts: np.ndarray) -> tuple[int, np.ndarray]:
        """One more than the number of distinct sentences of the texts, and in how many of them each unit is."""
        mine = np.flatnonzero(texts[self.owner]) if len(self.owner) else np.empty(0, np.int64)
        _, first = np.unique(self.hashes[mine], return_index=True)
        taken = np.zeros(len(self.owner), bool)
        taken[mine[first]] = True
        return len(first) + 1, np.bincount(self.units[taken[self.of_unit]], minlength=len(self.names))

    def text_units(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Units of each text that has any, one for each sentence they are in; and the texts' numbers."""
        texts = self.owner[self.of_unit]
        return np.split(self.units, np.flatnonzero(np.diff(texts)) + 1), texts[np.append(0, np.flatnonzero(np.diff(texts)) + 1)] if len(texts) else texts


class UnitMachine:
    """The string-kernel machine on units; its landmarks fold into one weight per subsequence.

    Units are counted once for each distinct sentence of each label, so copies of a
    text do not make its words look frequent.
    """

    def __init__(self, features: Subsequences, corpus: Sentences, labels: np.ndarray, use: np.ndarray, seed: int = 5):
        self.features = features
        self.weights, self.bias = np.zeros(SLOTS, np.float32), -1.0
        n_bad, found = corpus.counts(use & (labels == 1))
        bad = {corpus.names[k]: int(found[k]) for k in np.flatnonzero(found)}
        n_good, found = corpus.counts(use & (labels == 0))
        good = {corpus.names[k]: int(found[k]) for k in np.flatnonzero(found)}
        odds = {u: np.log((n + 0.5) / n_bad) - np.log((good.get(u, 0) + 0.5) / n_good) for u, n in bad.items()}
        chosen = {u: bad[u] for u, o in odds.items() if bad[u] >= 3 and o > np.log(6)}
        if not chosen or not good:
            return
        rng = np.random.default_rng(seed)
        everything = sorted(good)
        clean = [everything[k] for k in np.sort(rng.choice(len(everything), min(NEGATIVES, len(everything)), replace=False))]
        hard: list[str] = []
        self._fit(chosen, hard, [u for u in clean if u not in chosen], good, rng)
        for _ in range(CHOICES):
            seen = sorted(u for u, o in odds.items() if bad[u] > 1 and o > np.log(2.5))
            values = dict(zip(seen, self(seen)))
            chosen = {u: bad[u] for u in seen if values[u] > 0} or chosen
            against = [u for u in everything if u not in chosen]
            values = np.concatenate([self(against[k : k + 4000]) for k in range(0, len(against), 4000)]) if against else np.empty(0)
            worst = np.argsort(-values, kind="stable")[:HARDEST]
            hard = [against[k] for k in worst if values[k] > -1]
            clean = sorted({*clean, *hard})
            self._fit(chosen, hard, [u for u in clean if u not in chosen], good, rng)

    def _fit(self, chosen: dict[str, int], hard: list[str], clean: list[str], good: dict[str, int], rng: np.random.Generator) -> None:
        ranked = sorted(chosen, key=lambda u: (-chosen[u], u))
        landmarks = [*ranked[: LANDMARKS // 2], *hard[: LANDMARKS // 4]]
        landmarks += [clean[k] for k in rng.choice(len(clean), min(LANDMARKS - len(landmarks), len(clean)), replace=False)] if clean else []
        landmarks = list(dict.fromkeys(landmarks))
        owner, code, weight = self.features(landmarks)
        columns, place = np.unique(code, return_inverse=True)
        basis = np.zeros((len(landmarks), len(columns)))
        basis[owner, place] = weight
        basis /= np.maximum(np.sqrt((basis**2).sum(axis=1)), 1e-12)[:, None]
        values, vectors = np.linalg.eigh(basis @ basis.T)
        root = vectors[:, values > 1e-8] / np.sqrt(values[values > 1e-8])
        letters = sorted({c for u in ranked for c in u})
        spoilt = [(u, u[:k] + str(rng.choice(letters)) + u[k:]) for u in ranked[:SPOILT] if len(u) > 3 for k in rng.integers(1, len(u), 3)]
        units = [*ranked, *(v for _, v in spoilt), *clean]
        kernel = self._kernel(units, columns, basis)
        n = len(ranked) + len(spoilt)
        y = np.where(np.arange(len(units)) < n, 1.0, -1.0)
        counts = np.array([chosen[u] for u in ranked] + [chosen[u] / 12 for u, _ in spoilt] + [good[u] for u in clean], float) ** 0.5
        counts[:n] /= counts[:n].sum()
        counts[n:] /= max(counts[n:].sum(), 1e-9) / 3
        w = squared_hinge(kernel @ root, y, counts, cost=2000.0)
        self.weights = np.zeros(SLOTS, np.float32)
        self.weights[columns] = (root @ w[:-1]) @ basis
        self.bias = float(w[-1])

    def _kernel(self, units: list[str], columns: np.ndarray, basis: np.ndarray) -> np.ndarray:
        """Normalised kernel of each unit with each landmark."""
        place = np.full(SLOTS, -1)
        place[columns] = np.arange(len(columns))
        out = np.zeros((len(units), len(basis)))
        turned = np.ascontiguousarray(basis.T.astype(np.float32))
        for start in range(0, len(units), 1000):
            owner, code, weight = self.features(units[start : start + 1000])
            n = min(1000, len(units) - start)
            norm = np.sqrt(np.bincount(owner, weight**2, n))
            on = place[code] >= 0
            here, first = np.unique(owner[on], return_index=True)
            if len(here):
                out[start + here] = np.add.reduceat(turned[place[code[on]]] * weight[on, None].astype(np.float32), first, axis=0)
            out[start : start + n] /= np.maximum(norm, 1e-12)[:, None]
        return out

    def __call__(self, units: list[str]) -> np.ndarray:
        """Decision values."""
        owner, code, weight = self.features(units)
        norm = np.sqrt(np.bincount(owner, weight**2, len(units)))
        return np.bincount(owner, weight * self.weights[code], len(units)) / np.maximum(norm, 1e-12) + self.bias


def summary(values: np.ndarray) -> list[float]:
    """What of a text's unit values its score depends on."""
    if not len(values):
        return [-2.0, -2.0, -2.0, 0.0]
    top = np.sort(np.partition(values, -3)[-3:] if len(values) > 3 else values)[::-1]
    top = np.clip(np.concatenate([top, np.full(3, -2.0)])[:3], -2.0, 2.0)
    return [*top.tolist(), float(np.log1p((1 / (1 + np.exp(-8 * (np.clip(values, -2, 2) - 0.5)))).sum()))]


class ToxicityModel:
    """Unit machine and calibration, learned from labelled texts."""

    def __init__(self, texts: list[str | None], labels: list[int], shares: dict[int, float]):
        self.token = uuid.uuid4().hex  # names the caches of its results
        y = np.array(labels)
        corpus = Sentences(texts)
        alphabet = "".join(c for c, _ in sorted(Counter("".join(corpus.names)).items(), key=lambda x: (-x[1], x[0]))[:61])
        features = Subsequences(alphabet)
        fold = np.zeros(len(y), int)  # either label in equal parts
        for label in (0, 1):
            fold[y == label] = np.arange((y == label).sum()) % 2
        rows = np.tile(summary(np.empty(0)), (len(y), 1))
        bags, owners = corpus.text_units()
        for k in (0, 1):
            part = UnitMachine(features, corpus, y, fold != k)
            values = np.concatenate([part(corpus.names[i : i + 4000]) for i in range(0, len(corpus.names), 4000)]) if corpus.names else np.empty(0)
            for bag, i in zip(bags, owners):
                if fold[i] == k:
                    rows[i] = summary(values[bag])
        self.units = UnitMachine(features, corpus, y, np.ones(len(y), bool))
        weight = np.array([1 / max(shares.get(int(v), 1.0), 1e-9) for v in y])
        self.coefficients = rising_logistic(rows, y, weight / weight.mean()) if len(set(labels)) > 1 else np.array([0, 0, 0, 0, -4.0 + 8.0 * bool(y.sum())])

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ self.coefficients[:-1] + self.coefficients[-1], -30, 30)))


def train_toxicity(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> ToxicityModel | None:
    """A model from about ``bound`` documents of each label, of the rows that may be learned from."""
    marked = labels.where(learnable(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sample, shares = labelled_sample(marked, "toxic", bound)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most 2 * bound rows of two numbers
    rows = sorted((r.doc_id, r.text or "", r.toxic) for r in chosen.toLocalIterator())
    return ToxicityModel([r[1] for r in rows], [r[2] for r in rows], shares) if rows else None


def _scores(machine: ToxicityModel | None, texts: list) -> np.ndarray:
    """Score of each text."""
    if machine is None:
        return np.zeros(len(texts))
    known: Cache = held((ToxicityModel, machine.token), Cache)
    known.trim()
    cut = [t.split() if t else [] for t in texts]
    got = [list(map(known.get, c)) for c in cut]
    gaps = [(c, g, [k for k, x in enumerate(g) if x is None]) for c, g in zip(cut, got) if None in g]
    new = [w for w in {c[k] for c, _, at in gaps for k in at} if known.recall(w) is None]
    for start in range(0, len(new), 20_000):
        names = new[start : start + 20_000]
        parts = [units_of(w) for w in names]
        sizes = np.array([len(p) for p in parts])
        best = np.full(len(names), np.nan)
        full = np.flatnonzero(sizes)
        if len(full):
            values = machine.units([u for p in parts for u in p])
            best[full] = np.maximum.reduceat(values, (np.cumsum(sizes) - sizes)[full])
        known.update(zip(names, best.tolist()))
    for c, g, at in gaps:
        for k in at:
            g[k] = known[c[k]]
    rows = []
    for t, g in zip(texts, got):
        values = np.array(g, float)
        if t and len(spaced := spaced_units(t)):
            values = np.concatenate([values, machine.units(spaced)])
        rows.append(summary(values[~np.isnan(values)]))
    return machine.score(np.array(rows).reshape(len(rows), 4))


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted`` (1 if the score is 0.5 or more).

    Whole texts count, however long; a null or empty text, or one without letters,
    gets the score of a text without units.  Without any labelled row every score is
    0.  Null ids (``held_out`` false), ties and repeated rows pass through, one row
    out for each row in; other columns are not looked at; an empty table gives an
    empty one.  A narrow map; the model's size is fixed.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(part: pa.RecordBatch, texts: list) -> dict:
            scores = _scores(shipped.value, texts)
            return {"doc_id": part.column(0), "held_out": part.column(2), "score": scores, "predicted": (scores >= 0.5).astype(np.int32)}

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), is_held_out(F.col(id_col)).alias("held_out"))
    return map_texts(rows, ["doc_id", "text", "held_out"], f"doc_id {kind}, held_out boolean, score double, predicted int", make)


def keep_civil(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that :func:`score_toxicity` does not predict to be toxic."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return filter_texts(docs, text_col, lambda: lambda texts: _scores(shipped.value, texts) < 0.5)
