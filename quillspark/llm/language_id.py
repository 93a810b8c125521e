"""Language identification by interpolated Kneser-Ney character models (operator 5).

One model per language, over the letters of words with a mark at each end, all
orders interpolated.  A seen n-gram's probability in every language is resolved
when the model is built and stored with its hash in one sorted array per order; a
second sorted array holds each context's back-off weights.  A word's score is a few
binary searches for all languages at once, and a text's cross-entropy is the sum
over its words by the number of characters, so each distinct word is looked up once.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.sampling import labelled_sample
from quillspark.llm.texts import CACHE_ENTRIES, filter_texts, held, is_held_out, learnable, map_texts

#: Order of the models, and documents of each language they are trained on (about).
ORDER, SAMPLE = 5, 600
#: Characters of evidence that the score counts at most; a text is rejected that strays from its language by more than so many times the usual, and by more than so many nats a character.
EVIDENCE, REJECT, APART = 60, 4.0, 1.3

WORD = regex.compile(r"\p{L}+")
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0x7FB5D329728EA185)
    return h ^ (h >> _U(27))


def gram_hash(gram: str) -> int:
    h = 0
    for c in gram:
        h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
    return int(_finish(np.array([h], _U))[0])


def kneser_ney(words: Counter, order: int, letters: int) -> tuple[list[dict], list[dict]]:
    """Log probabilities by n-gram and log back-off weights by context, per order from 1.

    Counts below the highest order are continuation counts: the number of different
    letters seen before.  Absolute discounts follow from the counts of counts.
    """
    top: list[Counter] = [Counter() for _ in range(order + 1)]
    for word, n in words.items():
        marked = f"\x02{word}\x03"
        for end in range(1, len(marked)):
            for k in range(1, order + 1):
                if k > end + 1:
                    break
                top[k][marked[end - k + 1 : end + 1]] += n
    counts: list[Counter] = [Counter() for _ in range(order + 1)]
    counts[order] = top[order]
    for k in range(order - 1, 0, -1):
        for gram in top[k + 1]:
            counts[k][gram[1:]] += 1
        for gram, n in top[k].items():  # nothing comes before the mark at a word's start
            if gram[0] == "\x02":
                counts[k][gram] = n
    probs: list[dict] = [{} for _ in range(order + 1)]
    backs: list[dict] = [{} for _ in range(order + 1)]
    for k in range(1, order + 1):
        total, kinds = Counter(), Counter()
        for gram, n in counts[k].items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        ones, twos = (sum(1 for n in counts[k].values() if n == m) for m in (1, 2))
        discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        for context, n in total.items():
            backs[k][context] = discount * kinds[context] / n
        for gram, n in counts[k].items():
            context = gram[:-1]
            lower = probs[k - 1].get(gram[1:]) if k > 1 else 1 / letters
            if lower is None:
                lower = 1 / letters
            probs[k][gram] = max(n - discount, 0) / total[context] + backs[k][context] * lower
    return probs, backs


class LanguageModels:
    """The models of all languages in sorted hash arrays."""

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        self.token = uuid.uuid4().hex  # names the caches of its results
        self.order, self.langs = order, sorted(samples)
        words = {g: Counter(w for t in samples[g] for w in WORD.findall(t.lower())) for g in self.langs}
        self.letters = letters = len({c for ws in words.values() for w in ws for c in w}) + 2
        self.unseen = float(-np.log(letters))
        models = [kneser_ney(words[g], order, letters) for g in self.langs]

        def resolve(k: int, gram: str, probs: list[dict], backs: list[dict]) -> float:
            weight = 1.0
            for j in range(k, 0, -1):
                if (p := probs[j].get(gram[k - j :])) is not None:
                    return weight * p
                weight *= backs[j].get(gram[k - j : -1], 1.0)
            return weight / letters

        self.grams, self.values, self.contexts, self.weights = [None], [None], [None], [None]
        for k in range(1, order + 1):
            grams = sorted({g for p, _ in models for g in p[k]})
            contexts = sorted({c for _, b in models for c in b[k]})
            for names, keys, columns, fill in (
                (grams, self.grams, self.values, lambda g: [resolve(k, g, p, b) for p, b in models]),
                (contexts, self.contexts, self.weights, lambda c: [b[k].get(c, 1.0) for _, b in models]),
            ):
                h = np.array([gram_hash(g) for g in names], _U)
                at = np.argsort(h)
                keys.append(h[at])
                columns.append(np.log(np.array([fill(g) for g in names], np.float64).reshape(len(names), -1))[at].astype(np.float32))
        self.calibrate(samples)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log probability in each language, and the number of characters (the end mark is one), of each word."""
        sizes = np.array([len(w) for w in words], np.int64) + 2
        codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U)
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        total = np.zeros((len(codes), len(self.langs)), np.float32)
        open_ = place > 0
        hashes = [None]
        h, power = np.zeros(len(codes), _U), 1
        for k in range(self.order):
            h = h.copy()
            h[k:] += (codes[: max(0, len(codes) - k)] + _U(1)) * _U(power)
            power = power * int(_BASE) % (1 << 64)
            hashes.append(_finish(h))
        for k in range(self.order, 0, -1):
            at = np.flatnonzero(open_ & (place >= k - 1))
            row, hit = self._find(self.grams[k], hashes[k][at])
            total[at[hit]] += self.values[k][row[hit]]
            open_[at[hit]] = False
            at = at[~hit]
            if k > 1:
                row, hit = self._find(self.contexts[k], hashes[k - 1][at - 1])
                total[at[hit]] += self.weights[k][row[hit]]
            else:
                total[at] += self.weights[1][0] + self.unseen
        return np.add.reduceat(total, starts, axis=0) if len(words) else np.zeros((0, len(self.langs)), np.float32), sizes - 1

    def calibrate(self, samples: dict[str, list[str]]) -> None:
        """How far texts of a language stray from its usual cross-entropy, by length."""
        self.usual, self.stray = np.zeros(len(self.langs)), np.zeros(len(self.langs))
        for k, g in enumerate(self.langs):
            words = [WORD.findall(t.lower()) for t in samples[g]]
            words = [w for w in words if w]
            if not words:
                continue
            scores, n = self.score_words([x for w in words for x in w])
            cuts = np.cumsum([len(w) for w in words]) - [len(w) for w in words]
            chars = np.add.reduceat(n, cuts)
            entropy = -np.add.reduceat(scores[:, k].astype(np.float64), cuts) / chars
            self.usual[k] = np.median(entropy)
            self.stray[k] = max(1.0, np.quantile((entropy - self.usual[k]) * np.sqrt(np.minimum(chars, 400)), 0.95))

    def decide(self, totals: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its calibrated score, its cross-entropy, and whether the text is rejected."""
        entropy = -totals / np.maximum(chars, 1)[:, None]
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(best)), best]
        score = 1 / np.exp((least[:, None] - entropy) * np.minimum(chars, EVIDENCE)[:, None]).sum(axis=1)
        away = least - self.usual[best]
        far = away * np.sqrt(np.minimum(chars, 400)) > REJECT * self.stray[best]
        return best, score, least, (far & (away > APART)) | (chars == 0)


def train_models(docs: DataFrame, lang: str = "lang", bound: int = SAMPLE) -> LanguageModels | None:
    """Models from about ``bound`` whole documents of each language, of the rows that may be learned from."""
    rows = docs.where(learnable(F.col("doc_id")) & F.col("text").isNotNull()).select("doc_id", "text", F.col(lang).alias("lang"))
    sample, _ = labelled_sample(rows, "lang", bound)
    texts = defaultdict(list)
    for r in sample.select("lang", "text").toLocalIterator():
        texts[r[0]].append(r[1])
    texts = {g: t for g, t in texts.items() if any(WORD.search(x) for x in t)}
    return LanguageModels(texts) if texts else None


def _judge(model: LanguageModels | None, texts: list) -> dict:
    """Prediction, score, cross-entropy and rejection of each text."""
    if model is None:
        n = len(texts)
        return {"lang_pred": ["und"] * n, "score": [0.0] * n, "cross_entropy": [None] * n, "rejected": [True] * n}
    state = held((LanguageModels, model.token), lambda: {"known": {}, "vectors": np.zeros((1, len(model.langs) + 1))})
    known, vectors = state["known"], state["vectors"]
    if len(known) > CACHE_ENTRIES:
        known.clear()
        vectors = vectors[:1]
    cut = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
    ids = [list(map(known.get, c)) for c in cut]
    gaps = [k for k, x in enumerate(ids) if None in x]
    new = list({w for k in gaps for w, i in zip(cut[k], ids[k]) if i is None})
    found = [WORD.findall(w.lower()) for w in new]
    fresh = np.zeros((len(new), vectors.shape[1]))
    words = [x for f in found for x in f]
    if words:
        scores, n = model.score_words(words)
        owner = np.repeat(np.arange(len(new)), [len(f) for f in found])
        np.add.at(fresh, owner, np.column_stack([scores, n]))
    known.update(zip(new, range(len(vectors), len(vectors) + len(new))))
    vectors = state["vectors"] = np.concatenate([vectors, fresh])
    for k in gaps:
        ids[k] = [known[w] if i is None else i for w, i in zip(cut[k], ids[k])]
    sums = np.array([vectors[i].sum(axis=0) if i else vectors[0] for i in ids]).reshape(len(ids), -1)
    best, score, entropy, rejected = model.decide(sums[:, :-1], sums[:, -1])
    empty = sums[:, -1] == 0
    return {
        "lang_pred": ["und" if e else model.langs[b] for b, e in zip(best, empty)],
        "score": np.where(empty, 0.0, score),
        "cross_entropy": pa.array(entropy, pa.float64(), mask=empty),
        "rejected": rejected,
    }


def identify_languages(docs: DataFrame, models: LanguageModels | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score, cross_entropy, rejected``.

    ``lang_pred`` is the language of least cross-entropy; ``und`` with score 0, null
    cross-entropy and rejected if the text is null, empty or without a letter (or
    nothing could be learned).  ``rejected`` also marks texts that stray further from
    their language than calibration allows; they keep their ``lang_pred``.

    Whole texts count, however long.  Null ids (``held_out`` false), ties and repeated
    rows pass through, one row out for each row in; other columns are not looked at;
    an empty table gives an empty one.  A narrow map; the model's size depends on the
    bounded sample only.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(models)

    def make():
        return lambda part, texts: {"doc_id": part.column(0), "held_out": part.column(2)} | _judge(shipped.value, texts)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), is_held_out(F.col(id_col)).alias("held_out"))
    return map_texts(rows, ["doc_id", "text", "held_out"], f"doc_id {kind}, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean", make)


def keep_identified(docs: DataFrame, models: LanguageModels | None, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that :func:`identify_languages` does not reject; all rows if nothing could be learned."""
    if models is None:
        return docs
    shipped = docs.sparkSession.sparkContext.broadcast(models)
    return filter_texts(docs, text_col, lambda: lambda texts: ~np.asarray(_judge(shipped.value, texts)["rejected"]))
