"""Language identification by the nearest centroid of TF-IDF n-gram vectors.

Letters are lower-cased, everything else is a blank; runs of two and three characters are hashed to ``SLOTS`` numbers,
weighted by the root of their count and by inverse document frequency, and scaled to length 1. A learned document's
margin is its cosine to its own language's mean less that to the nearest other mean. Documents with under ``CLEAR`` of
their language's median margin count as mislabelled or mixed and are left out (two passes). Each language then has up to
``CENTROIDS`` spherical k-means centroids; clusters with under ``SHARE`` of its documents are dropped. The language of the centroid with the largest cosine is predicted and the
cosine is the score. A text is rejected when its cosine falls below ``SLACK`` times the smallest one that a learned
document of like length (by powers of four) had with its own language; unknown lengths use the nearest known one.

It learns from at most ``PER_LANGUAGE`` documents of each language (smallest id hashes), outside the held-out
fold. Text that is null or without a letter is ``und``, score 0, rejected; so is all text if nothing could be learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, fold_of

PER_LANGUAGE, CENTROIDS = 300, 4
SLOT_BITS = 13
SLOTS = 1 << SLOT_BITS
SLACK = 0.3
CLEAR, SHARE = 0.5, 0.1
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def counts(text: str | None) -> np.ndarray | None:
    """n-gram counts of the whole text; None without a letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_is_letter()[points], points, np.uint32(32))
    points = np.concatenate((np.array([32], np.uint32), points, np.array([32], np.uint32)))
    points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
    if len(points) < 3:
        return None
    two = points[:-1] * np.uint32(0x9E3779B1) + points[1:]
    three = two[:-1] * np.uint32(0x85EBCA6B) + points[2:]
    shift, stir = np.uint32(32 - SLOT_BITS), np.uint32(0xC2B2AE35)
    grams = np.concatenate(((two ^ two >> np.uint32(15)) * stir >> shift, (three ^ three >> np.uint32(13)) * stir >> shift))
    return np.bincount(grams, minlength=SLOTS)


def _scaled(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def _length_class(n: int) -> int:
    return int(np.log2(max(n, 1)) // 2)


@dataclass(frozen=True)
class Centroids:
    languages: list[str]  # of each centroid
    idf: np.ndarray
    rows: np.ndarray
    floors: dict[tuple[str, int], float]

    def floor(self, language: str, size: int) -> float:
        at = [(abs(k - size), v) for (name, k), v in self.floors.items() if name == language]
        return min(at)[1] if at else 0.0

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        found = counts(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0, True
        vector = np.sqrt(found) * self.idf
        cosines = self.rows @ vector.astype(np.float32) / max(np.linalg.norm(vector), 1e-12)
        best = int(cosines.argmax())
        score = float(np.clip(cosines[best], 0, 1))
        language = self.languages[best]
        return language, score, score < SLACK * self.floor(language, _length_class(int(found.sum())))


def _clustered(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from rows spread evenly over the cosines to the mean; empty clusters stay as they are."""
    order = (rows @ rows.mean(axis=0)).argsort(kind="stable")
    k = min(k, len(rows))
    centres = rows[[order[(2 * i + 1) * len(rows) // (2 * k)] for i in range(k)]]
    for _ in range(10):
        nearest = (rows @ centres.T).argmax(axis=1)
        centres = _scaled(np.stack([rows[nearest == i].sum(0) if (nearest == i).any() else c for i, c in enumerate(centres)]))
    sizes = np.bincount((rows @ centres.T).argmax(axis=1), minlength=len(centres))
    return centres[sizes >= max(1, min(sizes.max(), SHARE * len(rows)))]


def _clear(rows: np.ndarray, labels: np.ndarray, kinds: list[str], used: np.ndarray) -> np.ndarray:
    """Which rows are clearly of their language, by the means of those used so far; never none of a language."""
    means = _scaled(np.stack([rows[(labels == name) & used].mean(axis=0) for name in kinds]))
    cosines = rows @ means.T
    mine = labels[:, None] == np.array(kinds)
    margins = cosines[mine] - np.where(mine, -1, cosines).max(axis=1)
    out = np.zeros(len(rows), bool)
    for name in kinds:
        own = labels == name
        middle = np.median(margins[own])
        out |= own & (margins >= (CLEAR * middle if middle > 0 else middle))
    return out


def fit(texts: list[str], languages: list[str]) -> Centroids:
    pairs = sorted((lang, text) for lang, text in zip(languages, texts))
    known = [(lang, c) for lang, text in pairs if (c := counts(text)) is not None]
    if not known:
        return Centroids([], np.ones(SLOTS), np.zeros((0, SLOTS), np.float32), {})
    seen = sum((c > 0).astype(np.int64) for _, c in known)
    idf = np.log((1 + len(known)) / (1 + seen)) + 0.2
    names, centres, floors = [], [], {}
    every = _scaled(np.stack([np.sqrt(c) * idf for _, c in known]).astype(np.float32))
    labels = np.array([lang for lang, _ in known])
    kinds = sorted({lang for lang, _ in known})
    clear = np.ones(len(labels), bool)
    for _ in range(2 if len(kinds) > 1 else 0):
        clear = _clear(every, labels, kinds, clear)
    for name in kinds:
        use = (labels == name) & clear
        own = [c for (_, c), u in zip(known, use) if u]
        vectors = every[use]
        found = _clustered(vectors, CENTROIDS)
        names += [name] * len(found)
        centres.append(found)
        for c, cosine in zip(own, (vectors @ found.T).max(axis=1)):
            key = (name, _length_class(int(c.sum())))
            floors[key] = min(floors.get(key, 1.0), float(cosine))
    return Centroids(names, idf, np.concatenate(centres).astype(np.float32), floors)


def _fitted(rows: pd.DataFrame) -> pd.DataFrame:
    model = fit(rows["text"].tolist(), rows["lang"].tolist())
    return pd.DataFrame(
        {
            "languages": [model.languages],
            "idf": [model.idf.tolist()],
            "rows": [model.rows.tobytes()],
            "floors": [[{"name": k[0], "size": k[1], "least": v} for k, v in model.floors.items()]],
        }
    )


def train(docs: DataFrame, folds: int = 4, held: int = 2, per_language: int = PER_LANGUAGE) -> Centroids:
    """Learns from a bounded number of documents of each language, outside the held-out fold."""
    bound_batches(docs.sparkSession)
    ids = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    ids = ids.where(~fold_of(F.col("doc_id"), folds, held)).select(F.col("doc_id").alias("__id"), "lang", "text")
    order = W.partitionBy("lang").orderBy(F.xxhash64("__id"), "__id")
    some = ids.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= per_language).select("text", "lang")
    kinds = "languages array<string>, idf array<double>, rows binary, floors array<struct<name: string, size: int, least: double>>"
    row = some.withColumn("all", F.lit("")).groupBy("all").applyInPandas(_fitted, kinds).first()
    if row is None:
        return fit([], [])
    floors = {(f.name, f.size): f.least for f in row.floors}
    return Centroids(list(row.languages), np.array(row.idf), np.frombuffer(row.rows, np.float32).reshape(-1, SLOTS), floors)


def predicted(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row's whole text."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CENTROIDS rows of SLOTS numbers for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch["text"].to_pylist()]
            names, scores, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def identified(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    found = predicted(docs, train(docs, folds, held))
    return found.select("doc_id", fold_of(F.col("doc_id"), folds, held).alias("held_out"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected; columns as given, no shuffle: each batch is filtered in place."""
    model = train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = [not shared.value.predict(t)[2] for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
