"""Importance resampling towards a target distribution, by hashed word n-grams over a head-tail vocabulary.

A text's features are its words and its pairs of neighbouring words, repeats counted; a feature's bucket is the CRC-32
of its UTF-8 bytes modulo ``BUCKETS``. CRC-32 goes on from a state, so the pair "a b" is " b" carried on from the state
of "a". The head, the most frequent words with their exact CRC states and the most frequent pairs with their buckets,
is broadcast (both lists have a fixed length, and words in it at most ``HEAD_BYTES`` bytes). Every other feature is the
tail: its CRC is taken directly. Both ways give the same bucket, so the head decides the speed and never a result, and
the bucket totals of the corpus are exact.

A bucket's gain is the smoothed log-ratio of its share in the target and in the corpus, a document's weight the mean gain
of its features, and documents are drawn by weight plus Gumbel noise, seeded by doc_id: the highest scores among those
with enough words. The corpus is read three times: head, totals, weights. Only totals of buckets and the head pass
through the driver; ranks come from ranges of the score, none of which is one task's whole order.

Null, empty and wordless texts have no features and weight 0. A null doc_id is seeded as empty text and comes after all
others among equal scores. Rows that repeat a document count, and are scored, once each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, settle
from millrace.llm.words import slices, split
from millrace.operators.scale import numbered

BUCKETS = 10_000
#: What is broadcast of the vocabulary, at most.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 40_000, 200_000, 64
#: Least words of a document that can be drawn, share drawn in percent, seed of the noise.
MIN_WORDS, SHARE, SEED = 20, 25, 7
#: Features one map task holds while it looks for frequent ones, and those of a slice that it takes note of.
_HELD, _NOTED = 200_000, 20_000


@dataclass(frozen=True)
class Head:
    """Frequent words with the CRC of each, and frequent pairs (numbers of two words) with the bucket of each."""

    words: pa.Array
    states: np.ndarray
    pairs: pa.Array
    pair_buckets: np.ndarray


@dataclass
class Features:
    """Distinct features of a slice by bucket, and where they occur: word ``code``s, and pairs with their texts."""

    word_bucket: np.ndarray
    code: np.ndarray
    text: np.ndarray
    pair_bucket: np.ndarray
    pair_code: np.ndarray
    pair_text: np.ndarray
    counts: np.ndarray


def _pairs(words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, second word) of each distinct pair, the pair of each occurrence, and its text."""
    follows = words.text[1:] == words.text[:-1]
    size = max(1, len(words.known))
    keys = words.code[:-1].astype(np.int64)[follows] * size + words.code[1:][follows]
    coded = pa.array(keys).dictionary_encode()
    distinct = coded.dictionary.to_numpy()
    return distinct // size, distinct % size, coded.indices.to_numpy(), words.text[1:][follows]


def features(texts: pa.Array, head: Head) -> Features:
    words = split(texts)
    first, second, pair_code, pair_text = _pairs(words)
    rank = pc.fill_null(pc.index_in(words.known.cast(pa.string()), value_set=head.words), -1).to_numpy().astype(np.int64)
    state = np.zeros(len(rank), np.int64)
    state[rank >= 0] = head.states[rank[rank >= 0]]
    tail = np.flatnonzero(rank < 0)
    spelled = words.known.cast(pa.large_binary()).to_pylist()
    state[tail] = np.fromiter((crc32(spelled[i]) for i in tail), np.int64, len(tail))

    both = np.where((rank[first] >= 0) & (rank[second] >= 0), rank[first] * max(1, len(head.words)) + rank[second], -1)
    place = pc.fill_null(pc.index_in(pa.array(both), value_set=head.pairs), -1).to_numpy()
    bucket = np.zeros(len(first), np.int64)
    bucket[place >= 0] = head.pair_buckets[place[place >= 0]]
    tail = np.flatnonzero(place < 0)
    joined = [b" " + w for w in spelled]
    ends = (crc32(joined[b], s) for b, s in zip(second[tail].tolist(), state[first[tail]].tolist()))
    bucket[tail] = np.fromiter(ends, np.int64, len(tail)) % BUCKETS
    return Features(state % BUCKETS, words.code, words.text, bucket, pair_code, pair_text, words.counts)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, feature, n): the features one task met most often; the rare ones among many are forgotten."""
    held: tuple[Counter, Counter] = (Counter(), Counter())
    for part in slices(batches):
        words = split(part["text"])
        first, second, pair_code, _ = _pairs(words)
        spelled = words.known.to_pylist()
        short = pc.less_equal(pc.binary_length(words.known), HEAD_BYTES).to_numpy(zero_copy_only=False)
        n = np.bincount(words.code, minlength=len(spelled)) * short
        most = np.argsort(-n, kind="stable")[:_NOTED]
        held[0].update({spelled[i]: int(n[i]) for i in most if n[i]})
        n = np.bincount(pair_code, minlength=len(first)) * (short[first] & short[second])
        most = np.argsort(-n, kind="stable")[:_NOTED]
        held[1].update({f"{spelled[first[i]]} {spelled[second[i]]}": int(n[i]) for i in most if n[i]})
        for found in held:
            if len(found) > 2 * _HELD:
                kept = dict(found.most_common(_HELD))
                found.clear()
                found.update(kept)
    for pair, found in enumerate(held):
        top = found.most_common(_HELD)
        for start in range(0, len(top), 50_000):
            names, counts = zip(*top[start : start + 50_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array([bool(pair)] * len(names)), pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["pair", "feature", "n"]
            )


def frequent_head(docs: DataFrame, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS) -> Head:
    """The most frequent words and pairs over all documents, with their CRC states and buckets."""
    found = docs.select("text").mapInArrow(_frequent, "pair boolean, feature string, n long")
    found = settle(found.groupBy("pair", "feature").agg(F.sum("n").alias("n")), "vocabulary")
    crc = F.crc32(F.col("feature").cast("binary")).alias("crc")
    best = [F.desc("n"), "feature"]
    top = found.where(~F.col("pair")).orderBy(*best).limit(words).select("feature", crc).toArrow().combine_chunks()
    known = top["feature"].combine_chunks().cast(pa.string())
    joint = found.where("pair").orderBy(*best).limit(pairs).select("feature", crc).toArrow().combine_chunks()
    halves = pc.split_pattern(joint["feature"].combine_chunks(), " ").flatten().cast(pa.string())
    ranks = pc.fill_null(pc.index_in(halves, value_set=known), -1).to_numpy().astype(np.int64).reshape(-1, 2)
    inside = (ranks >= 0).all(axis=1)
    keys = ranks[inside, 0] * max(1, len(known)) + ranks[inside, 1]
    return Head(known, top["crc"].to_numpy(), pa.array(keys, pa.int64()), joint["crc"].to_numpy()[inside] % BUCKETS)


def bucket_totals(docs: DataFrame, head: Head) -> np.ndarray:
    """Exact number of features in each bucket, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for part in slices(batches):
            f = features(part["text"], shared.value)
            for bucket, code in ((f.word_bucket, f.code), (f.pair_bucket, f.pair_code)):
                n = np.bincount(code, minlength=len(bucket))
                total += np.bincount(bucket, weights=n, minlength=BUCKETS).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(totals, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in counted.collect():  # at most BUCKETS rows
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the smoothed log-ratio of shares, floored, of each bucket."""
    s, t = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(corpus, target)], np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel draw, floored: from the first 32 bits of the SHA-256 of seed and doc_id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((drawn + 0.5) / 4294967296.0))).cast("long")


def weighted(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each document."""
    spark = docs.sparkSession
    bound_batches(spark)
    text = F.col("text").cast("string").alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    head = frequent_head(rows)
    gain = gains(bucket_totals(rows, head), bucket_totals(benchmark.select(text), head))
    shared = spark.sparkContext.broadcast((head, gain))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, gain = shared.value
        for part in slices(batches):
            f = features(part["text"], head)
            size = len(f.counts)
            total = np.zeros(size, np.int64)
            for bucket, code, text in ((f.word_bucket, f.code, f.text), (f.pair_bucket, f.pair_code, f.pair_text)):
                total += np.bincount(text, weights=gain[bucket][code], minlength=size).astype(np.int64)
            n = f.counts + np.maximum(f.counts - 1, 0)
            columns = [part["doc_id"], f.counts, n, np.where(n > 0, total // np.maximum(n, 1), 0)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def resampled(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, share: int = SHARE, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): ``share`` percent of the documents with ``min_words`` words are drawn.

    ``rank`` counts the drawn from 1, highest score first, equal scores by doc_id; it is null for the others.
    """
    score = (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score")
    may = (F.col("n_words") >= min_words).alias("__may")
    # settled: the ranges are sampled and dealt from it, the texts are weighed once
    scored = settle(weighted(docs, benchmark).select("doc_id", "n_features", "weight", score, may), "weights")
    drawn = scored.where("__may").count() * share // 100
    order = [F.desc("__may"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    placed = numbered(scored, order, "__place")
    rank = F.when(F.col("__place") < drawn, F.col("__place") + 1).cast("long").alias("rank")
    return placed.select("doc_id", "n_features", "weight", "score", rank)


def drawn(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The drawn documents, columns as given. Rows that repeat a doc_id are drawn together if one of them is."""
    chosen = resampled(docs, benchmark, **how).where("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn_id")).distinct()
    chosen = chosen.select(F.struct("__drawn_id").alias("chosen"))
    return docs.join(chosen, docs["doc_id"].cast("long").eqNullSafe(chosen["chosen.__drawn_id"]), "left_semi")


# CRC-32 in SQL: the remainder of each byte by eight halvings, then one step per byte of each distinct feature.
_HALVE = "list_reduce([{0}::BIGINT] || repeat([0::BIGINT], 8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)"
SQL = f"""
WITH remainder AS (SELECT list_transform(range(256), lambda b: {_HALVE.format("b")}) AS r),
words AS (SELECT 0 AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL SELECT 1, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
features AS (SELECT side, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM words),
counted AS (SELECT side, id, feature, count(*) AS n FROM features GROUP BY ALL),
spelled AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM counted)),
bytes AS (SELECT feature, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM spelled),
hashed AS (SELECT feature, xor(list_reduce([4294967295::BIGINT] || b,
    lambda s, x: xor(s >> 8, r[(xor(s, x) & 255) + 1])), 4294967295::BIGINT) % {BUCKETS} AS bucket FROM bytes, remainder),
totals AS (SELECT k.bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
  FROM counted JOIN hashed k USING (feature) GROUP BY 1),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM totals) + {BUCKETS}) / ((s + 1) * ((SELECT sum(t) FROM totals) + {BUCKETS}))))::BIGINT AS g
  FROM totals),
weights AS (SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * g)::DOUBLE / sum(n))::BIGINT AS weight
  FROM counted JOIN hashed USING (feature) JOIN gain USING (bucket) WHERE side = 0 GROUP BY 1),
scored AS (SELECT id AS doc_id, len(w) >= {MIN_WORDS} AS may, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('{SEED}:' || id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (id) WHERE side = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY may) AS total FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= total * {SHARE} // 100 THEN place END AS rank FROM ranked
"""
