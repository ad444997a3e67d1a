"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct lower-cased words and the five-letter beginnings of longer words, hashed to 2^18
numbers. The score is the logistic of b + sum w_i + sum_{i<j} <v_i, v_j> over the terms present: pairs such as an
insult with a group's name add what neither word does alone. Only terms whose presence depends on the label in the
sample (likelihood ratio above ``DEPENDS``, a toxic share of ``LIFT`` times the usual or more, in ``LEAST`` documents or
more) get weights.

It learns from a bounded sample of labelled rows (``SAMPLE_ROWS``, smallest id hashes first); all rows are scored on
their whole text. Without labelled rows of both classes every score is the share of toxic ones (0 if there are none).
Null and empty texts hold no term and get the logistic of b.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, fold_of, labelled

SAMPLE_ROWS = 20_000
HASHES, FACTORS, STEPS = 1 << 18, 8, 150
LEAST, DEPENDS, LIFT, START = 4, 15.0, 1.6, 5

_WORD = re.compile(r"\w+")


class TermNumbers(dict):
    """word -> the hashes of its terms; forgets all when full."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= 200_000:
            self.clear()
        terms = (word, word[:START] + "*") if len(word) > START else (word,)
        value = self[word] = tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) % HASHES for t in terms)
        return value


def terms(text: str | None, numbers: TermNumbers) -> set[int]:
    return {n for word in set(_WORD.findall((text or "").lower())) for n in numbers[word]}


@dataclass(frozen=True)
class Machine:
    bias: float
    places: dict[int, int]  # term -> row of weights and factors
    weights: np.ndarray
    factors: np.ndarray

    def score(self, found: set[int]) -> float:
        at = [p for p in map(self.places.get, found) if p is not None]
        z = self.bias
        if at:
            f = self.factors[at]
            s = f.sum(axis=0)
            z += self.weights[at].sum() + 0.5 * float(s @ s - (f * f).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _dependent(lists: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Terms whose presence and the label are not independent, by the likelihood ratio of the 2 x 2 table."""
    every = np.concatenate(lists) if lists else np.empty(0, np.int64)
    n = np.bincount(every, minlength=HASHES).astype(float)
    toxic = np.bincount(every, weights=np.repeat(y, [len(x) for x in lists]), minlength=HASHES)
    rows, positive = len(y), y.sum()
    cells = [(toxic, n * positive / rows), (n - toxic, n * (rows - positive) / rows), (positive - toxic, (rows - n) * positive / rows)]
    cells.append((rows - n - positive + toxic, (rows - n) * (rows - positive) / rows))
    ratio = sum(2 * seen * np.log(np.maximum(seen, 1e-12) / np.maximum(due, 1e-12)) for seen, due in cells)
    odds = ((toxic + 0.5) / (n + 1)) / ((positive + 0.5) / (rows + 1))
    return np.flatnonzero((n >= LEAST) & (ratio > DEPENDS) & (odds >= LIFT))


class _Sums:
    """Sums of rows of values over groups, by one sort up front."""

    def __init__(self, groups: np.ndarray, size: int) -> None:
        self.order = np.argsort(groups, kind="stable")
        ordered = groups[self.order]
        self.starts = np.flatnonzero(np.diff(ordered, prepend=-1))
        self.into, self.size = ordered[self.starts], size

    def __call__(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros((self.size, *values.shape[1:]))
        if len(self.into):
            out[self.into] = np.add.reduceat(values[self.order], self.starts, axis=0)
        return out


def fit(lists: list[np.ndarray], y: np.ndarray) -> Machine:
    """The machine for rows given as arrays of distinct term numbers; full-batch Adam from a fixed start."""
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return Machine(40.0 if share else -40.0, {}, np.zeros(0), np.zeros((0, FACTORS)))
    active = _dependent(lists, y)
    places = {int(t): i for i, t in enumerate(active)}
    pairs = [(i, places[t]) for i, row in enumerate(lists) for t in row.tolist() if t in places]
    row, col = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 2
    rng = np.random.default_rng(2)
    state = [np.array([np.log(share / (1 - share))]), np.zeros(len(active)), rng.normal(0, 0.05, (len(active), FACTORS))]
    first, second = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]

    by_row, by_col = _Sums(row, len(y)), _Sums(col, len(active))
    for step in range(1, STEPS + 1):
        bias, w, v = state
        drawn = v[col]
        sums = by_row(drawn)
        z = bias + by_row(w[col]) + 0.5 * ((sums**2).sum(1) - by_row((drawn**2).sum(1)))
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / len(y)
        slope = [np.array([error.sum()]), by_col(error[row]) + 1e-5 * w]
        slope.append(by_col(error[row, None] * (sums[row] - drawn)) + 1e-4 * v)
        for i, g in enumerate(slope):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            state[i] = state[i] - 0.05 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-9)
    return Machine(float(state[0][0]), places, state[1], state[2])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = TermNumbers()
    for batch in batches:
        lists = [sorted(terms(t, numbers)) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), batch["y"]], names=["terms", "y"])


def _fitted(rows: pd.DataFrame) -> pd.DataFrame:
    machine = fit([np.asarray(t, np.int64) for t in rows["terms"]], rows["y"].to_numpy(float))
    return pd.DataFrame(
        {"bias": [machine.bias], "places": [list(machine.places)], "weights": [machine.weights.tolist()], "factors": [machine.factors.ravel().tolist()]}
    )


def train(sample: DataFrame) -> Machine:
    """Learns from a bounded sample (text, y): terms are read in parallel, the fit runs in one task."""
    bound_batches(sample.sparkSession)
    listed = sample.mapInArrow(_listed, "terms array<int>, y double")
    kinds = "bias double, places array<int>, weights array<double>, factors array<double>"
    row = listed.withColumn("all", F.lit("")).groupBy("all").applyInPandas(_fitted, kinds).first()
    if row is None:
        return fit([], np.empty(0))
    weights = np.array(row.weights, float)
    return Machine(row.bias, {t: i for i, t in enumerate(row.places)}, weights, np.array(row.factors, float).reshape(len(weights), FACTORS))


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score of every row's whole text."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # at most HASHES terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, model = TermNumbers(), shared.value
        for batch in batches:
            scores = [model.score(terms(t, numbers)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted; learns only outside the held-out fold."""
    machine = train(labelled(docs, labels, "toxic", folds, held, sample_rows))
    return scored(docs, machine).select(
        "doc_id", fold_of(F.col("doc_id"), folds, held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
