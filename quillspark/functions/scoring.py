"""Scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Raw fused rank scores and the share of observed hits below them.
RANK_SCORE_KNOTS: tuple[tuple[float, float], ...] = (
    (0.00308726, 0.0),
    (0.00942629, 0.05),
    (0.0109489, 0.1),
    (0.01420284, 0.2),
    (0.01695351, 0.3),
    (0.01936442, 0.4),
    (0.02188507, 0.5),
    (0.024213, 0.6),
    (0.02671364, 0.7),
    (0.02951747, 0.8),
    (0.03268172, 0.9),
    (0.03486153, 0.95),
    (0.04917757, 0.99),
    (0.07377007, 1.0),
)
#: Weights of similarity, span of projects and of time, and the days at which the latter is full.
CONFIDENCE_WEIGHTS, SPREAD_DAYS = (0.55, 0.30, 0.15), 14.0
#: Factors by size of context below 2, 5 and 15.
CONTEXT_FACTORS = ((2, 0.4), (5, 0.7), (15, 0.9))


def finite_or(x: Column, default: float) -> Column:
    """``x``, or ``default`` where it is null, NaN or infinite."""
    x = x.cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(default)).otherwise(x)


def clamp(x: Column, low: float, high: float) -> Column:
    """``x`` within bounds; ``low`` for null or NaN."""
    x = x.cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(low)).otherwise(F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def round_half_up(x: Column, digits: int = 3) -> Column:
    scale = 10**digits
    return F.floor(x * scale + 0.5) / scale


def normalized_rank_score(raw: Column) -> Column:
    """Place of a fused rank score among observed ones: linear between knots, 0 up to the first, 1 beyond the last."""
    x = finite_or(raw, 0.0)
    out = F.when(x <= RANK_SCORE_KNOTS[0][0], 0.0)
    for (x0, y0), (x1, y1) in zip(RANK_SCORE_KNOTS, RANK_SCORE_KNOTS[1:]):
        out = out.when(x <= x1, F.lit(y0) + (x - x0) / (x1 - x0) * (y1 - y0))
    return out.otherwise(1.0)


def sized_score(raw: Column, size: Column) -> Column:
    """A score between 0 and 1, damped where little context backs it."""
    x = clamp(finite_or(raw, 0.0), 0.0, 1.0)
    factor = F.lit(1.0)
    for below, f in reversed(CONTEXT_FACTORS):
        factor = F.when(size < below, f).otherwise(factor)
    return x * factor


def novelty_factor(distinct: Column, n: Column) -> Column:
    """Half, plus half the share of distinct pieces of evidence; 1 for a single piece or none."""
    return F.when(n <= 1, 1.0).otherwise(0.5 + 0.5 * distinct / n)


def confidence(best: Column, projects: Column, spread_days: Column, n: Column, distinct: Column) -> Column:
    """Confidence of an insight from its related items; 0 without any."""
    w = CONFIDENCE_WEIGHTS
    span = F.when(projects >= 2, 1.0).otherwise(0.0)
    age = F.when(n < 2, 0.0).otherwise(F.least(F.lit(1.0), F.coalesce(spread_days, F.lit(0.0)) / SPREAD_DAYS))
    raw = (w[0] * normalized_rank_score(F.greatest(best, F.lit(0.0))) + w[1] * span + w[2] * age) * novelty_factor(distinct, n)
    return F.when(n == 0, 0.0).otherwise(round_half_up(clamp(raw, 0.0, 1.0)))


def recall_boost(recalls: Column, cited: Column, surfaced: Column, days: Column, previous: Column, lowest: float = 1.0, highest: float = 2.0, cited_weight: float = 3.0, surfaced_weight: float = 1.0, alltime_weight: float = 0.5, scale: float = 12.0, halflife: float = 30.0, alpha: float = 0.5) -> Column:
    """Bounded reinforcement weight: saturating in use, halving with age, smoothed towards its target.

    ``days`` since the last recall: null means never, so full decay; NaN means now.
    """
    c, s, r = (finite_or(x, 0.0) for x in (cited, surfaced, recalls))
    used = cited_weight * c + surfaced_weight * F.greatest(F.lit(0.0), s - c) + alltime_weight * F.greatest(F.lit(0.0), r - s)
    usage = 1 - F.exp(-used / scale)
    d = days.cast("double")
    recency = F.when(d.isNull(), 0.0).when(F.isnan(d), 1.0).otherwise(F.pow(F.lit(0.5), F.greatest(F.lit(0.0), d) / halflife))
    before = clamp(finite_or(previous, lowest), lowest, highest)
    return clamp(before + alpha * (lowest + (highest - lowest) * usage * recency - before), lowest, highest)
