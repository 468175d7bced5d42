"""Toxicity: cumulative-link ordinal regression on sparse text features.

One weight vector is shared by all thresholds: P(grade > k) = sigmoid(score - threshold k), with
rising thresholds, so that a text can never be likelier to pass a higher grade than a lower one.
Features are words and word beginnings, with the logarithm of their counts as values.

The labels only say toxic or not. Toxic training texts are graded 1 to GRADES by the number of
strongly associated words they hold, cut at equal shares of the toxic texts; others are grade 0.

Only features whose log-odds between toxic and clean texts are far from 0 by their standard error
are used, so that words common to all texts cannot stand in for the thresholds. The thresholds are
held by one more training text: the text without any feature, clean, with a weight of ``NEUTRAL``
of the sample.

The model is fitted on a bounded sample of labelled documents (``sample``, never more than twice
that many) and applied to every text. Null and empty texts, and texts without any feature of the
model, have severity by the thresholds alone, which is low, and are never rejected. Rows without label are scored like all
others; extra columns are not read. Without any toxic or any clean training text nothing is rejected.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratingloom.llm.common import bounded_sample, collected, map_rows

SAMPLE = 6_000
GRADES = 3
BEGINNINGS = (3, 4, 5, 6, 7, 8)
MIN_TEXTS = 4  # toxic sample texts that must hold a feature
MAX_FEATURES = 4_000
MIN_Z = 3.0  # log-odds of a feature over their standard error
NEUTRAL = 0.5  # weight of the text without features, as a share of the sample
STRONG = 2.5  # log-odds of a strongly associated feature
REJECT_AT = 0.3  # probability of grade 1 or more
CACHE_WORDS = 100_000
WORD = re.compile(r"[^\W\d_]+")
SCHEMA = "expected_severity double, p_toxic double, grade int, toxic boolean"


@dataclass(frozen=True)
class Model:
    features: dict[str, float]
    thresholds: tuple[float, ...]


def features_of(word: str) -> list[str]:
    return [word + "$", *[word[:n] for n in BEGINNINGS if n <= len(word)]]


def text_features(text: str | None, only=None) -> Counter:
    """Feature -> count, of the features in ``only`` if given."""
    counts: Counter = Counter()
    for word, n in Counter(WORD.findall((text or "").lower())).items():
        for f in features_of(word):
            if only is None or f in only:
                counts[f] += n
    return counts


def train(rows: list[tuple[str | None, int | None]], grades: int = GRADES, steps: int = 400, l2: float = 2e-4) -> Model:
    """A model from (text, toxic 0/1) pairs; pairs without label are left out.

    Only features of enough toxic texts are counted in the others and kept, so that memory follows
    the vocabulary of the toxic part of the sample.
    """
    rows = [(t, int(y > 0)) for t, y in rows if y is not None]
    labels = np.array([y for _, y in rows], np.int64)
    n_toxic = int(labels.sum())
    if not n_toxic or n_toxic == len(rows):
        return Model({}, (40.0,) * grades)
    toxic: Counter = Counter()
    for t, y in rows:
        if y:
            toxic.update(set(text_features(t)))
    toxic = Counter({f: n for f, n in toxic.items() if n >= MIN_TEXTS})
    clean: Counter = Counter()
    for t, y in rows:
        if not y:
            clean.update(text_features(t, toxic).keys())
    odds = {
        f: math.log((a + 0.1) / (n_toxic - a + 0.5)) - math.log((clean[f] + 0.1) / (len(rows) - n_toxic - clean[f] + 0.5))
        for f, a in toxic.items()
    }
    error_of = {
        f: math.sqrt(1 / (a + 0.5) + 1 / (n_toxic - a + 0.5) + 1 / (clean[f] + 0.5) + 1 / (len(rows) - n_toxic - clean[f] + 0.5))
        for f, a in toxic.items()
    }
    odds = {f: x for f, x in odds.items() if abs(x) >= MIN_Z * error_of[f]}
    # features that say something about the label, strongest evidence first
    ranked = sorted(odds, key=lambda f: (-abs(odds[f]) * math.sqrt(toxic[f]), f))[:MAX_FEATURES]
    place = {f: n for n, f in enumerate(ranked)}
    strong = {f for f in ranked if odds[f] >= STRONG}
    counted = [text_features(t, place) for t, _ in rows]

    intensity = np.array([sum(n for f, n in c.items() if f in strong and f[-1] == "$") for c in counted], float)
    cuts = np.quantile(intensity[labels == 1], [g / grades for g in range(1, grades)])
    grade = np.where(labels == 1, 1 + np.searchsorted(cuts, intensity, side="left"), 0)

    row_of, col_of, values = [], [], []
    for n, counts in enumerate(counted):
        for f, count in counts.items():
            if f in place:
                row_of.append(n)
                col_of.append(place[f])
                values.append(math.log1p(count))
    r, c, v = np.array(row_of, np.int64), np.array(col_of, np.int64), np.array(values)
    n_rows, n_cols = len(rows), len(ranked)
    w = np.zeros(n_cols)
    share = [np.clip((grade > k).mean(), 1e-3, 1 - 1e-3) for k in range(grades)]
    cut = np.maximum.accumulate([math.log((1 - s) / s) for s in share])
    above = np.stack([grade > k for k in range(grades)], 1)
    # each threshold is a logistic loss on the shared score; Adam on weights and thresholds
    parameters = np.concatenate([w, cut])
    m1, m2 = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, steps + 1):
        w, cut = parameters[:n_cols], parameters[n_cols:]
        score = np.bincount(r, weights=v * w[c], minlength=n_rows)
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - cut[None, :], -40, 40)))
        error = (p - above) / n_rows
        grad_w = np.bincount(c, weights=v * error.sum(1)[r], minlength=n_cols) + l2 * w
        neutral = NEUTRAL / (1 + np.exp(np.clip(cut, -40, 40)))
        grad = np.concatenate([grad_w, -error.sum(0) - neutral])
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad * grad
        parameters = parameters - 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        parameters[n_cols:] = np.maximum.accumulate(parameters[n_cols:])
    w, cut = parameters[:n_cols], parameters[n_cols:]
    kept = {f: round(float(x), 6) for f, x in zip(ranked, w) if abs(x) > 1e-3}
    return Model(kept, tuple(round(float(x), 6) for x in cut))


class Scorer:
    """Scores texts; remembers the features of recent words."""

    def __init__(self, model: Model, reject_at: float = REJECT_AT):
        self.model, self.reject_at = model, reject_at
        self.cache: dict[str, tuple[str, ...]] = {}

    def __call__(self, text: str | None) -> tuple[float, float, int, bool]:
        weights, cache = self.model.features, self.cache
        counts: dict[str, int] = {}
        for word, n in Counter(WORD.findall((text or "").lower())).items():
            known = cache.get(word)
            if known is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                known = cache[word] = tuple(f for f in features_of(word) if f in weights)
            for f in known:
                counts[f] = counts.get(f, 0) + n
        score = math.fsum(weights[f] * math.log1p(n) for f, n in counts.items())
        p = [1 / (1 + math.exp(-max(-40.0, min(40.0, score - cut)))) for cut in self.model.thresholds]
        severity = sum(p)
        toxic = bool(counts) and p[0] >= self.reject_at
        return severity, p[0], max(int(toxic), sum(x >= 0.5 for x in p)), toxic


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """A model from a bounded sample of the labelled documents."""
    chosen = bounded_sample(labels.select(key, "toxic").filter(F.col(key).isNotNull()), key, sample)
    rows = docs.select(key, text).join(F.broadcast(chosen), key).select(text, "toxic")
    return train([tuple(r) for r in collected(rows)])


def score_toxicity(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), reject_at: float = REJECT_AT
) -> DataFrame:
    """Columns ``keep``, expected severity, P(grade >= 1), grade and verdict of every row; no shuffle."""
    return map_rows(docs, [text], lambda: Scorer(model, reject_at), SCHEMA, keep)


def is_toxic(text: Column, model: Model, reject_at: float = REJECT_AT) -> Column:
    """The verdict as a column, for filters: only the text goes to Python."""

    @F.pandas_udf("boolean")
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = Scorer(model, reject_at)
        for texts in batches:
            yield pd.Series([score(t)[3] for t in texts], dtype=bool)

    return verdict(text)
