"""Document fingerprints by consistent weighted sampling.

A text is a bag of lower-cased words weighted by their counts. For each of ``SAMPLES`` samples every word draws, from
its own hash, two Gamma(2, 1) values r and c and a uniform b (the same in every document); with weight w,
t = floor(ln w / r + b) and the word with the smallest ln c - r (t - b) - r is the sample. Two texts agree on a
sample (word, t) with the probability of their generalised Jaccard similarity, sum min(w) / sum max(w). A
fingerprint keeps 16 bits of each (word, t), in hexadecimal.

Null text is empty; all empty texts share one fingerprint, which agrees with no other text's. Documents follow each
other by doc_id (nulls first, repeated ids by text), and the first follows the last.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches

SAMPLES = 64
#: Words whose draws a worker keeps: 64 x 4 floats each.
KNOWN_WORDS = 200_000

_SEEDS = np.random.default_rng(64).integers(0, 1 << 63, (5, SAMPLES), dtype=np.uint64)


def _stirred(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _orders(r: np.ndarray, ln_c: np.ndarray, b: np.ndarray, weights: np.ndarray | float) -> np.ndarray:
    """What each sample takes the smallest of, for words of these weights (logarithms of counts)."""
    t = np.floor(weights / r + b)
    return ln_c - r * (t - b) - r


class Draws:
    """r, ln c, b and the order as a single word, of each word met so far; when full, keeps those met in several texts."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.values = np.empty((4, KNOWN_WORDS, SAMPLES), np.float32)
        self.hashes = np.empty(KNOWN_WORDS, np.uint64)
        self.uses = np.zeros(KNOWN_WORDS, np.int64)

    def _forget(self, room: int) -> None:
        """Keeps the words asked for most: half of the table at most, and ``room`` free."""
        # a word of one text is asked for by two signatures: the text's own and one of an edited text
        kept = np.flatnonzero(self.uses[: len(self.rows)] > 2)
        most = np.argsort(-self.uses[kept], kind="stable")[: min(KNOWN_WORDS // 2, KNOWN_WORDS - room)]
        kept = np.sort(kept[most])
        names = list(self.rows)
        self.rows = {names[k]: row for row, k in enumerate(kept.tolist())}
        for column in (*self.values, self.hashes):
            column[: len(kept)] = column[kept]
        self.uses[: len(kept)] = self.uses[kept] >> 1
        self.uses[len(kept) :] = 0

    def of(self, words: list[str]) -> np.ndarray:
        """Where ``hashes`` and ``values`` have each of at most KNOWN_WORDS distinct words."""
        at = np.fromiter(map(self.rows.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(self.rows) + len(missing) > KNOWN_WORDS:
            self._forget(len(words))
            return self.of(words)
        if len(missing):
            new = [words[k] for k in missing.tolist()]
            first = len(self.rows)
            at[missing] = np.arange(first, first + len(new))
            self.rows.update(zip(new, range(first, first + len(new))))
            hashes = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in new], np.uint64)
            self.hashes[first : first + len(new)] = hashes
            for start in range(0, len(new), 32):  # few words at a time stay in the processor's cache
                part = hashes[start : start + 32]
                u = (_stirred(part[:, None] ^ _SEEDS[:, None]) >> np.uint64(11)).view(np.int64).astype(np.float64)
                u += 0.5
                u *= 2.0**-53
                place = slice(first + start, first + start + len(part))
                self.values[0, place] = -np.log(u[0] * u[1])
                self.values[1, place] = np.log(-np.log(u[2] * u[3]))
                self.values[2, place] = u[4]
                self.values[3, place] = _orders(*self.values[:3, place], np.float32(0))
        self.uses[at] += 1
        return at


@lru_cache(maxsize=1)
def _draws() -> Draws:
    """A worker's draws: they serve all tasks the worker runs."""
    return Draws()


def signature(text: str, draws: Draws) -> np.ndarray:
    """``SAMPLES`` 16-bit symbols; for a wordless text none."""
    counts = Counter(text.lower().split())
    least = np.full(SAMPLES, np.inf, np.float32)
    symbols = np.zeros(SAMPLES, np.uint64)
    words = sorted(counts)  # ties go to the first word, whatever the order of the text
    for start in range(0, len(words), 4096):
        part = words[start : start + 4096]
        at = draws.of(part)
        weights = np.log(np.fromiter(map(counts.__getitem__, part), np.float32, len(part)))
        orders = draws.values[3].take(at, axis=0)
        several = np.flatnonzero(weights)
        if len(several):
            r, ln_c, b = draws.values[:3].take(at[several], axis=1)
            orders[several] = _orders(r, ln_c, b, weights[several, None])
        here = orders.min(axis=0)
        word, sample = np.nonzero(orders == here)
        first = np.empty(SAMPLES, np.int64)
        first[sample[::-1]] = word[::-1]
        r, _, b = draws.values[:3, at[first], np.arange(SAMPLES)]
        step = np.floor(weights[first] / r + b).astype(np.int64).astype(np.uint64)
        drawn = _stirred(draws.hashes[at[first]] ^ (step * np.uint64(0x9E3779B97F4A7C15) + _SEEDS[0]))
        better = here < least
        least[better], symbols[better] = here[better], drawn[better]
    return (symbols >> np.uint64(40)).astype(np.uint16) if words else np.empty(0, np.uint16)


def written(symbols: np.ndarray) -> str:
    return symbols.astype(">u2").tobytes().hex() if len(symbols) else "empty"


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of samples that agree; 1 for two empty texts, 0 if only one is empty."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block and doc_id; each block ends with its ``tail``, the first document of the next."""
    draws, waiting = _draws(), None
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    for batch in batches:
        out: list[tuple] = []
        for doc, text, block, tail in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "block", "tail"))):
            if tail and (waiting is None or waiting[2] != block):
                continue  # a second tail of the block
            text = text or ""
            mark = signature(text, draws)
            if waiting is not None:
                before, own, _, before_doc = waiting
                changed = edited(before, text)
                other = signature(changed, draws)
                digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((before_doc, len(before), digest, written(own), written(other), likeness(own, other), likeness(own, mark)))
            waiting = None if tail else (text, mark, block, doc)
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def compared(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness to each other and to the next one's.

    Documents are cut into ranges of doc_id, each sorted in its own task; a range also gets the first document
    of the next. Only the ``blocks`` cut values and first ids pass through the driver.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = blocks or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / blocks for i in range(1, blocks)]
    ids = rows.select("doc_id")
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 100 * blocks) if shares else F.array().cast("array<long>")).first()[0]
    cuts = sorted(set(cuts or []))
    held = F.array(*(F.lit(c).cast("long") for c in cuts)) if cuts else F.array().cast("array<long>")
    block = F.size(F.filter(held, lambda c: F.col("doc_id") >= c)).cast("int") if cuts else F.lit(0)
    block = F.when(F.col("doc_id").isNull(), 0).otherwise(block)

    firsts = ids.withColumn("block", block).groupBy("block").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nameless"))
    firsts = sorted(firsts.collect(), key=lambda r: r.block)
    entries = [(None if r.nameless else r.least, firsts[i - 1].block) for i, r in enumerate(firsts)]
    tails = spark.createDataFrame(entries, "first long, block int") if entries else spark.range(0).selectExpr("id AS first", "0 AS block")
    extra = rows.join(F.broadcast(tails), F.col("doc_id").eqNullSafe(F.col("first"))).select("doc_id", "text", "block", F.lit(True).alias("tail"))
    dealt = rows.select("doc_id", "text", block.alias("block"), F.lit(False).alias("tail")).union(extra)
    dealt = dealt.repartition(blocks, "block").sortWithinPartitions("block", "tail", "doc_id", "text")
    return dealt.mapInArrow(
        _compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
