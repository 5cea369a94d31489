"""Quality classifier: ordinal cumulative-link regression on hashed text.

Grades are ordered: 0 toxic, 1 of low quality, 2 good. One weight vector is
shared by all grades and ordered thresholds cut its score, so that
``P(grade > k) = sigmoid(w.x - threshold_k)``. The model gives the expected grade and
the tail probability of the top grade, by which documents are selected.

The fit uses a bounded sample of labelled rows (``SAMPLE``, taken by hash, so
it is the same on each run); every document is scored on its whole text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.common import first_of

#: Labelled rows the fit reads at most.
SAMPLE = 4000
#: Hashed weights.
BUCKETS = 1 << 15
#: Ridge penalty of a weight, as a share of the sample's mean loss.
PENALTY = 3e-6
#: A document stays when its probability of the top grade is at least this.
KEEP = 0.5
PREFIXES = (4, 5, 6)
GRADES = 3

_CORE = re.compile(r"[^\W\d_]+")
_cache: dict[str, np.ndarray] = {}


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def _of_token(token: str) -> np.ndarray:
    """Buckets of one token: its words, their beginnings, its marks and its case."""
    got = _cache.get(token)
    if got is None:
        if len(_cache) > 200_000:
            _cache.clear()
        names = ["m:" + _CORE.sub("x", token)[:40]]
        for core in _CORE.findall(token):
            low = core.lower()
            names.append("w:" + low)
            names += [f"p:{low[:n]}" for n in PREFIXES if len(low) > n]
            if len(core) > 1 and core.isupper():
                names.append("caps")
        got = _cache[token] = np.array([_bucket(n) for n in names], np.int64)
    return got


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values, the root of a feature's share, of a whole text."""
    tokens = text.split() if text else []
    if not tokens:
        return np.array([_bucket("empty")]), np.ones(1, np.float32)
    counts = Counter(tokens)
    parts = [_of_token(t) for t in counts]
    where = np.concatenate(parts)
    many = np.repeat(np.fromiter(counts.values(), np.float64, len(counts)), [len(p) for p in parts])
    again = sum(a == b for a, b in pairwise(tokens))
    where = np.append(where, [_bucket("again"), _bucket("any")])
    many = np.append(many, [again, len(tokens)])
    buckets, place = np.unique(where, return_inverse=True)
    return buckets, np.sqrt(np.bincount(place, many) / len(tokens)).astype(np.float32)


@dataclass
class Ordinal:
    """Weights and rising thresholds; no thresholds if there was nothing to learn from."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, buckets: np.ndarray, values: np.ndarray) -> float:
        return float(self.weights[buckets] @ values)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """Probabilities to be above grade 0, 1, ..., one column each."""
        return _sigmoid(np.asarray(score)[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _loss(theta, rows, buckets, values, grade, dims):
    """Penalised mean negative log likelihood and its gradient."""
    w, first, steps = theta[:dims], theta[dims], np.exp(np.clip(theta[dims + 1 :], -20, 20))
    cuts = first + np.concatenate(([0.0], np.cumsum(steps)))
    n = len(grade)
    score = np.bincount(rows, w[buckets] * values, n)
    top = len(cuts)
    above = np.where(grade > 0, score - cuts[np.maximum(grade - 1, 0)], np.inf)
    below = np.where(grade < top, score - cuts[np.minimum(grade, top - 1)], -np.inf)
    a, b = _sigmoid(above), _sigmoid(below)
    p = np.maximum(a - b, 1e-12)
    da, db = a * (1 - a), b * (1 - b)
    g_score = -(da - db) / p / n
    g_cuts = np.zeros(top)
    np.add.at(g_cuts, grade[grade > 0] - 1, (da / p / n)[grade > 0])
    np.add.at(g_cuts, grade[grade < top], (-db / p / n)[grade < top])
    g = np.empty_like(theta)
    g[:dims] = np.bincount(buckets, g_score[rows] * values, dims) + 2 * PENALTY * w
    g[dims] = g_cuts.sum()
    g[dims + 1 :] = [steps[k] * g_cuts[k + 1 :].sum() for k in range(len(steps))]
    return -np.log(p).mean() + PENALTY * _dot(w, w), g


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    """Inner product on one thread: more only get in each other's way here."""
    return float(np.sum(a * b))


def _minimise(loss, start: np.ndarray, rounds: int = 70, memory: int = 10) -> np.ndarray:
    """Limited-memory quasi-Newton steps with backtracking."""
    x, (value, grad), past = start, loss(start), []
    for _ in range(rounds):
        step, stack = grad.copy(), []
        for s, y, r in reversed(past):
            a = r * _dot(s, step)
            step -= a * y
            stack.append(a)
        if past:
            s, y, _ = past[-1]
            step *= _dot(s, y) / _dot(y, y)
        for (s, y, r), a in zip(past, reversed(stack), strict=True):
            step += s * (a - r * _dot(y, step))
        slope, size = _dot(grad, step), 1.0 if past else 1.0 / max(1e-12, np.abs(grad).sum())
        if slope <= 0:
            break
        while True:
            new = x - size * step
            new_value, new_grad = loss(new)
            if new_value <= value - 1e-4 * size * slope or size < 1e-10:
                break
            size /= 2
        s, y = new - x, new_grad - grad
        bend = _dot(s, y)
        if bend > 1e-12:
            past = [*past[-memory + 1 :], (s, y, 1 / bend)]
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        x, value, grad = new, new_value, new_grad
        if done:
            break
    return x


def fit_sample(examples: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, dims: int = BUCKETS) -> Ordinal:
    """The model of ``examples``. Grades that do not occur get no mass of their own."""
    kinds = np.unique(grade)
    if len(kinds) < 2:
        return Ordinal(np.zeros(dims), np.zeros(0))
    rows = np.repeat(np.arange(len(examples)), [len(b) for b, _ in examples])
    buckets = np.concatenate([b for b, _ in examples])
    values = np.concatenate([v for _, v in examples]).astype(np.float64)
    level = np.searchsorted(kinds, grade)
    share = np.cumsum(np.bincount(level))[:-1] / len(level)
    cuts = np.log(share / (1 - share))
    start = np.concatenate((np.zeros(dims), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))))
    best = _minimise(lambda t: _loss(t, rows, buckets, values, level, dims), start)
    steps = np.exp(np.clip(best[dims + 1 :], -20, 20))
    found = best[dims] + np.concatenate(([0.0], np.cumsum(steps)))
    cuts = np.array([found[np.searchsorted(kinds, k, side="right") - 1] if k >= kinds[0] else -np.inf for k in range(kinds[-1])])
    return Ordinal(best[:dims], np.concatenate((cuts, np.full(GRADES - 1 - len(cuts), np.inf))))


def grades(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` of what is labelled: the lowest grade of an id; rows without a usable label are left out."""
    grade = (
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).otherwise(None)
    )
    known = labels.select("doc_id", grade.alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL")
    return known.groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, ident: str = "doc_id", text: str = "text") -> Ordinal:
    """Learn from at most ``sample`` labelled documents of ``docs``, chosen by hash."""
    known = grades(labels)
    rows = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    # The labelled ids of these documents, then the sample of them: bounded, so it may be broadcast.
    ids = rows.select("doc_id").join(known, "doc_id").dropDuplicates(["doc_id"])
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = first_of(rows.join(F.broadcast(chosen), "doc_id"), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [features(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "grade": batch["grade"],
                    "buckets": [b.astype("<u2").tobytes() for b, _ in got],
                    "values": [v.astype("<f4").tobytes() for _, v in got],
                }
            )

    schema = "doc_id long, grade int, buckets binary, values binary"
    learnt = sorted(picked.select("doc_id", "text", "grade").mapInPandas(run, schema).collect())
    examples = [
        (np.frombuffer(bytes(r.buckets), "<u2").astype(np.int64), np.frombuffer(bytes(r["values"]), "<f4")) for r in learnt
    ]
    return fit_sample(examples, np.array([r.grade for r in learnt], np.int64))


def graded(model: Ordinal, text):
    """Column ``struct<expected_grade, p_top>`` of a column of texts."""

    @F.pandas_udf("expected_grade double, p_top double")
    def grade(texts: pd.Series) -> pd.DataFrame:
        if not len(model.thresholds):
            return pd.DataFrame({"expected_grade": [None] * len(texts), "p_top": [1.0] * len(texts)})
        tails = model.tails(np.array([model.score(*features(t)) for t in texts]))
        return pd.DataFrame({"expected_grade": tails.sum(axis=1), "p_top": tails[:, -1]})

    return grade(text)


def scored(
    docs: DataFrame,
    labels: DataFrame,
    keep: float = KEEP,
    sample: int = SAMPLE,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, expected_grade, p_top, kept``.

    A null text is scored as an empty one. Labels of ids that ``docs`` lacks,
    and null labels, teach nothing; of labels that repeat an id the lowest
    grade holds, and of rows that repeat an id one text is learnt from. With
    fewer than two grades among the labels nothing is learnt: the grade is null and
    every document is kept. Columns beyond id and text are ignored. An empty
    table gives an empty result.
    """
    model = fit(docs, labels, sample, ident, text)
    return docs.select(F.col(ident).alias("doc_id"), graded(model, F.col(text)).alias("g")).select(
        "doc_id", "g.expected_grade", "g.p_top", (F.col("g.p_top") >= keep).alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, keep: float = KEEP, text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns, each judged by its text alone.

    A null text is judged as an empty one. With fewer than two grades among the
    labels all rows stay; an empty table stays empty.
    """
    model = fit(docs, labels, text=text, **how)
    return docs.where(graded(model, docs[text])["p_top"] >= keep)
