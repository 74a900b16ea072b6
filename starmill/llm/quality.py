"""Quality selection by ordinal regression (cumulative logits) on graded ratings.

``P(grade <= k) = sigmoid(threshold[k] - w.x)`` with one weight vector for all grades.  ``x``
marks the distinct words of a text and their beginnings, by 64-bit hash, and the tenths that
shares such as repetition, symbols and capitals reach.  Weights are never positive.  A document is kept when the probability of the highest
grade reaches ``KEEP``.

The model is fitted on at most ``SAMPLE`` labelled ids, chosen by hash, with one text each; a
mark must be clearly more frequent below the top grade.  So weights and what is broadcast are bounded.  Scoring is one
pass over the texts and shuffles nothing.

Defined results: a NULL or empty text has the mark of an empty text only; documents without a
label, or with a NULL in it, take no part in fitting; of several labels for one id the lowest
grade counts; without labelled documents every document is kept with probability 1; repeated
rows are scored alike; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import arrow_map, free_name

SAMPLE = 8000  # labelled documents used for fitting, at most
SUPPORT, LIFT = 5, 3.0  # a mark needs so many documents below the top grade, and so much more of them than of the top grade
KEEP = 0.5
STEPS, RATE, RIDGE, LASSO = 800, 0.1, 1e-6, 1e-6
_EDGES = ".,;:!?\"'()[]{}<>*#%&$|-_"


def features(text: str | None) -> np.ndarray:
    """Distinct 64-bit marks of a text."""
    digest = xxhash.xxh3_64_intdigest
    words = (text or "").split()
    if not words:
        return np.array([digest("=empty")], np.uint64)
    bare = {v.strip(_EDGES) for v in set(text.lower().split())}
    marks = {digest(w) for w in bare if w}
    marks |= {digest(w + "=") for w in {w[:5] for w in bare if len(w) > 5}}
    n = len(words)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    alone = sum(1 for w in words if not w.strip(_EDGES)) / n
    tails = sum(1 for w in words if len(w) > 1 and w[-1] in "!#$%&*") / n
    capitals = sum(1 for w in words if len(w) > 1 and w.isupper()) / n
    for name, share in (("same", same), ("alone", alone), ("tails", tails), ("capitals", capitals)):
        for tenth in range(1, int(np.ceil(share * 10)) + 1):
            marks.add(digest(f"={name} {tenth}"))
    return np.fromiter(marks, np.uint64, len(marks))


@dataclass
class Model:
    """Sorted marks with their weights, and the ordered thresholds between grades."""

    marks: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, found: np.ndarray) -> float:
        if not len(self.marks):
            return 0.0
        at = np.minimum(np.searchsorted(self.marks, found), len(self.marks) - 1)
        return float(self.weights[at][self.marks[at] == found].sum())

    def tails(self, score: float) -> np.ndarray:
        """Probabilities that the grade lies above each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -500, 500)))


def objective(theta: np.ndarray, cell: np.ndarray, row: np.ndarray, grades: np.ndarray, marks: int) -> tuple[float, np.ndarray]:
    """Mean negative log-likelihood with the ridge, and its gradient.

    ``theta`` holds the weights, the first threshold and the logarithms of the steps between
    thresholds; row ``row[i]`` has mark ``cell[i]``.
    """
    n, levels = len(grades), len(theta) - marks
    w, steps = theta[:marks], np.exp(theta[marks + 1 :])
    cut = theta[marks] + np.concatenate([[0.0], np.cumsum(steps)])
    score = np.bincount(row, weights=w[cell], minlength=n) if len(cell) else np.zeros(n)
    # Each row has the thresholds just below and just above its grade; outer ones are infinite.
    above = np.where(grades < levels, cut[np.minimum(grades, levels - 1)] - score, np.inf)
    below = np.where(grades > 0, cut[np.maximum(grades, 1) - 1] - score, -np.inf)
    upper, lower = 1 / (1 + np.exp(-np.clip(above, -40, 40))), 1 / (1 + np.exp(-np.clip(below, -40, 40)))
    upper, lower = np.where(np.isinf(above), 1.0, upper), np.where(np.isinf(below), 0.0, lower)
    p = np.maximum(upper - lower, 1e-12)
    du, dl = upper * (1 - upper) / p / n, lower * (1 - lower) / p / n
    grad = np.zeros_like(theta)
    grad[:marks] = np.bincount(cell, weights=(du - dl)[row], minlength=marks) + RIDGE * w
    at_cut = np.bincount(np.minimum(grades, levels - 1), weights=np.where(grades < levels, -du, 0), minlength=levels)
    at_cut += np.bincount(np.maximum(grades, 1) - 1, weights=np.where(grades > 0, dl, 0), minlength=levels)
    grad[marks] = at_cut.sum()
    for k in range(levels - 1):
        grad[marks + 1 + k] = at_cut[k + 1 :].sum() * steps[k]
    return float(-np.log(p).mean() + RIDGE / 2 * (w @ w)), grad


def fit(rows: list[np.ndarray], grades: np.ndarray, grade_count: int) -> Model:
    """Full-batch fit by scaled gradient steps with soft thresholding; the order is fixed."""
    every, where = np.unique(np.concatenate(rows), return_inverse=True)
    top = np.repeat(grades == grade_count - 1, [len(r) for r in rows])
    good = np.bincount(where, weights=top, minlength=len(every))
    poor = np.bincount(where, weights=~top, minlength=len(every))
    share = max(1, int((grades < grade_count - 1).sum())) / max(1, int((grades == grade_count - 1).sum()))
    marks = every[(poor >= SUPPORT) & (poor + 0.5 > LIFT * share * (good + 0.5))]
    cells, owner = [], []
    for i, r in enumerate(rows):
        at = np.searchsorted(marks, r)
        at = at[(at < len(marks)) & (marks[np.minimum(at, max(len(marks) - 1, 0))] == r)] if len(marks) else np.zeros(0, np.int64)
        cells.append(at)
        owner.append(np.full(len(at), i))
    cell, row = np.concatenate(cells), np.concatenate(owner)
    levels = grade_count - 1
    share = np.array([np.clip((grades <= k).mean(), 1e-3, 1 - 1e-3) for k in range(levels)])
    cut = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(len(marks)), [cut[0]], np.log(np.maximum(np.diff(cut), 1e-2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        grad = objective(theta, cell, row, grades, len(marks))[1]
        m, v = 0.9 * m + 0.1 * grad, 0.98 * v + 0.02 * grad**2
        scale = np.sqrt(v / (1 - 0.98**step)) + 1e-8
        theta = theta - RATE * (m / (1 - 0.9**step)) / scale
        shrink = RATE * LASSO / scale[: len(marks)]
        # A mark may only count against a text: short texts without marks stay at the base rate.
        theta[: len(marks)] = np.minimum(theta[: len(marks)] + shrink, 0)
    cut = theta[len(marks)] + np.concatenate([[0.0], np.cumsum(np.exp(theta[len(marks) + 1 :]))])
    used = theta[: len(marks)] != 0
    return Model(marks[used], theta[: len(marks)][used], cut)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings of the label table as grades: 0 poor, 1 well made but toxic, 2 good."""
    grade: Column = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.min(grade).alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows of ``ratings`` (``doc_id``, ``grade`` from 0).

    The rows with the lowest hash count, whatever the order of tasks; of several texts of one id
    the one with the smallest marks.
    """
    total = max(1, ratings.count())
    share = min(1 << 30, int((1 << 30) * sample / total))
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    picked = ratings.where(place < share).orderBy(place, "doc_id").limit(sample)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [features(t).tobytes() for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(found, pa.binary())], names=["doc_id", "grade", "marks"])

        return step

    # The sample is bounded, so it may be broadcast; the texts stay where they are.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    marked = arrow_map(texts.select("doc_id", "grade", "text"), make, "doc_id long, grade int, marks binary")
    rows = marked.groupBy("doc_id").agg(F.min("grade").alias("grade"), F.min("marks").alias("marks")).collect()  # ``sample`` rows at most
    rows.sort(key=lambda r: (r["grade"], bytes(r["marks"])))
    if not rows:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.array([-50.0, -49.0]))
    grades = np.array([r["grade"] for r in rows], np.int64)
    return fit([np.frombuffer(r["marks"], np.uint64) for r in rows], grades, max(3, int(grades.max()) + 1))


def scored(docs: DataFrame, model: Model, expected: str = "expected_grade", tail: str = "tail_probability") -> DataFrame:
    """``docs`` with the expected grade and the probability of the highest grade."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            tails = [known.tails(known.score(features(t))) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([float(t.sum()) for t in tails], pa.float64()), pa.array([float(t[-1]) for t in tails], pa.float64())],
                names=[*batch.schema.names, expected, tail],
            )

        return step

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{expected}` double, `{tail}` double"])
    return arrow_map(docs, make, schema)


def select(docs: DataFrame, ratings: DataFrame, keep: float = KEEP) -> DataFrame:
    """The documents worth keeping, with all their columns and no others."""
    expected, tail = free_name(docs, "expected_grade"), free_name(docs, "tail_probability")
    return scored(docs, train(docs, ratings), expected, tail).where(F.col(tail) >= keep).drop(expected, tail)
