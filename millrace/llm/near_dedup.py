"""Near duplicates: b-bit MinHash signatures joined by a multi-index over Hamming distance, confirmed on full sets.

A document's set holds its distinct five-word shingles (``shingle_set``). Its signature is ``SYMBOLS`` MinHash
values cut to 16 bits, and ``BITS`` values cut to one bit for finer distances. The signature is split into ``SYMBOLS / CHUNK`` chunks; a chunk enters the index once for
every position left out, so two signatures meet whenever some chunk has at most one differing symbol. By the
pigeonhole principle that is every pair whose signatures differ in at most ``2 * chunks - 1`` = 19 symbols. A pair
of similarity 0.75 escapes with probability 1.5e-6 (all ten chunks with two errors or more).

Buckets are never expanded into all pairs. Documents with the same set are one node. Each bucket offers stars
around three of its members; each node is confirmed against its closest hub first, then across components that
are still apart. Whatever still lies outside a bucket's main component is compared with the rest of the bucket, so
no link between components is lost. The last step grows with (rows outside the main component) x (bucket).

Null or wordless text: empty set, linked with nothing. Rows that repeat a doc_id are one document. A null doc_id
takes part, and is never chosen as a component's name while a known one is in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, settle, shuffled, shuffled_unless_few

SYMBOLS, CHUNK, WORDS = 40, 4, 5
BITS = 512
#: Candidates that differ in more bits than this are not confirmed; at similarity 0.75 (64 expected) the chance of it is 6e-6.
FARTHEST = 98
#: The same for pairs across components of a bucket, drawn only for documents in such buckets: 256 of FINE expected.
FINE, FINEST = 2048, 322
#: Nodes of documents without an id start here.
NAMELESS = 1 << 62

_DRAWN = np.random.default_rng(20)
_FLIP = _DRAWN.integers(0, 1 << 63, BITS + FINE, dtype=np.uint64)[:, None]
_TIMES = _DRAWN.integers(0, 1 << 63, BITS + FINE, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STIR = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hashes of words; forgets all when full, so a worker's memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles (of the whole sequence, if it is shorter)."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z, splits at ASCII space
    if not found:
        return np.empty(0, np.uint64)
    each = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    width = min(WORDS, len(each))
    shingles = np.full(len(each) - width + 1, width, np.uint64)
    for i in range(width):
        shingles = shingles * _BASE + each[i : len(each) - width + 1 + i]
    shingles ^= shingles >> np.uint64(31)
    shingles *= _STIR
    shingles ^= shingles >> np.uint64(29)
    return np.unique(shingles)


def _least(shingles: np.ndarray, draws: slice) -> np.ndarray:
    """MinHash values of a non-empty set for some of the draws, without the lowest bits."""
    flip, times = _FLIP[draws], _TIMES[draws]
    least = np.full(len(flip), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 256):
        least = np.minimum(least, ((shingles[start : start + 256] ^ flip) * times).min(axis=1))
    return least >> np.uint64(12)


def _packed(least: np.ndarray) -> np.ndarray:
    return np.packbits((least & np.uint64(1)).astype(np.uint8)).view(np.int64)


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a non-empty set: the 16-bit symbols, and the single bits packed into numbers."""
    least = _least(shingles, slice(0, BITS))
    return (least[:SYMBOLS] & np.uint64(0xFFFF)).astype(np.int32), _packed(least)


def set_name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in batches:
        sets = [shingle_set(t, words) for t in batch["text"].to_pylist()]
        drawn = [signature(s) if len(s) else (None, None) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_name(s) for s in sets], pa.binary()),
                pa.array([d[0] for d in drawn], pa.list_(pa.int32())),
                pa.array([d[1] for d in drawn], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "set_name", "symbols", "bits"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_name (a digest of the full set), symbols and bits (null for an empty set)."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_sketch, "doc_id long, n_shingles long, set_name binary, symbols array<int>, bits array<long>")


def _index_keys(symbols: str = "symbols") -> Column:
    """The entries of a signature in the index, in order: every chunk, every left-out position."""
    keys = []
    for chunk in range(SYMBOLS // CHUNK):
        for out in range(CHUNK):
            kept = [F.col(symbols)[chunk * CHUNK + i].cast("long") for i in range(CHUNK) if i != out]
            key = F.lit(chunk * CHUNK + out).cast("long")
            for symbol in kept:
                key = F.shiftleft(key, 16).bitwiseOR(symbol)
            keys.append(key)
    return F.array(*keys)


def _far_apart(x: Column, y: Column) -> Column:
    """The same for any number of bits; slower, so it stands behind the shorter test."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, m: n + m)


def _apart(x: Column, y: Column) -> Column:
    """In how many bits two signatures differ."""
    total = F.lit(0)
    for i in range(BITS // 64):
        total = total + F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
    return total


def _possible(n: Column, m: Column) -> Column:
    """Sizes that still allow 100 * intersection >= 75 * union."""
    return 100 * F.least(n, m) >= 75 * F.greatest(n, m)


def _with_nodes(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) with their distance, without those that sizes or signatures rule out."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("sb"))
    near = pairs.join(shuffled(a), "a").join(shuffled(b), "b").where(_possible(F.col("na"), F.col("nb")))
    return near.select("a", "b", _apart(F.col("sa"), F.col("sb")).alias("apart")).where(F.col("apart") <= FARTHEST)


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in batches:
        nodes, sets = [], []
        for node, name, text in zip(batch["node"].to_pylist(), batch["set_name"].to_pylist(), batch["text"].to_pylist()):
            found = shingle_set(text, words)
            if set_name(found) == name:
                nodes.append(node)
                sets.append(found.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "hashes"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for one, two in zip(batch["ha"], batch["hb"]):
            x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, set_name, text): the documents that may show a node's set; ``wanted`` holds nodes."""
    ids = nodes.join(wanted, "node").select("node", "set_name", F.col("doc_id").alias("__doc"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return shuffled(rows).join(ids, F.col("doc_id").eqNullSafe(F.col("__doc"))).select("node", "set_name", "text")


def _finely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _full_sets(batches):
        sets = (np.frombuffer(h.as_buffer(), np.uint64) for h in batch["hashes"])
        bits = [_packed(_least(s, slice(BITS, BITS + FINE))) for s in sets]
        yield pa.RecordBatch.from_arrays([batch["node"], pa.array(bits, pa.list_(pa.int64()))], names=["node", "fine"])


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= 75 * union."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _texts(wanted, nodes, docs).mapInArrow(_full_sets, "node long, hashes binary").dropDuplicates(["node"])
    sets = settle(sets, "near-sets")
    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    return shuffled_unless_few(pairs.select("a", "b")).join(a, "a").join(b, "b").mapInArrow(_confirm, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node: the smallest node reachable.

    Alternates large-star and small-star steps until the links no longer change; the number of rounds grows
    with the logarithm of the longest path. Hubs are folded by ``min`` before the shuffle.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = shuffled_unless_few(both).join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        edges = settle(small.where("u <> v").distinct(), "links")
        state = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    return nodes.select("node").join(shuffled_unless_few(components(links)), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    a = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return pairs.join(shuffled(a), "a").join(shuffled(b), "b").where("ca <> cb").drop("ca", "cb")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept."""
    sketched = settle(sketches(docs), "near-sketches")
    nodes = sketched.where("n_shingles > 0").groupBy("set_name").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("symbols").alias("symbols"), F.first("bits").alias("bits")
    )
    nameless = F.lit(NAMELESS) + F.shiftrightunsigned(F.xxhash64("set_name"), 3)
    nodes = settle(nodes.withColumn("node", F.coalesce("doc_id", nameless)), "near-nodes")

    entries = nodes.select(F.explode(_index_keys()).alias("key"), "node")
    hubs = entries.groupBy("key").agg(
        F.min("node").alias("h1"), F.max("node").alias("h2"), F.min(F.struct(F.xxhash64("node"), "node"))["node"].alias("h3")
    ).where("h1 < h2")
    shared = settle(shuffled(entries).join(hubs, "key"), "near-buckets")

    stars = shared.select("node", F.explode(F.array("h1", "h2", "h3")).alias("hub")).where("node <> hub")
    stars = stars.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    stars = settle(_with_nodes(stars, nodes), "near-stars")

    ends = stars.select("a", "b", "apart", F.explode(F.array("a", "b")).alias("node"))
    closest = ends.groupBy("node").agg(F.min(F.struct("apart", "a", "b")).alias("best"))
    closest = closest.select("best.a", "best.b").distinct()
    links = settle(confirmed(settle(closest, "near-closest"), nodes, docs), "near-links")
    labels = settle(_labels(nodes, links), "near-labels")

    rest = settle(_between(stars.join(closest, ["a", "b"], "left_anti"), labels).select("a", "b"), "near-rest")
    links = settle(links.union(confirmed(rest, nodes, docs)), "near-links")
    labels = settle(_labels(nodes, links), "near-labels")

    tried = stars.select("a", "b")
    across = settle(_across(shared, nodes, labels, docs).join(shuffled_unless_few(tried), ["a", "b"], "left_anti"), "near-across")
    links = links.union(confirmed(across, nodes, docs))
    return _result(sketched, nodes, _labels(nodes, links))


def _across(shared: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs of a bucket with an end outside its main component and ends in different components."""
    placed = shared.select("key", "node").join(shuffled(labels), "node")
    parts = placed.groupBy("key", "component").agg(F.count("node").alias("size"))
    main = parts.groupBy("key").agg(
        F.max(F.struct("size", "component"))["component"].alias("main"), F.count("component").alias("parts")
    ).where("parts > 1")
    split = settle(placed.join(main, "key").select("key", "node", "component", "main"), "near-split")
    fine = _texts(split.select("node").distinct(), nodes, docs).mapInArrow(_finely, "node long, fine array<long>").dropDuplicates(["node"])
    known = nodes.select("node", "n", "bits", _index_keys().alias("keys"))
    known = shuffled(known).join(fine, "node")
    split = settle(shuffled(split).join(known, "node"), "near-split")
    out = split.where("component <> main").select(
        "key", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("bits").alias("sa"), F.col("keys").alias("ka"),
        F.col("fine").alias("fa"),
    )
    all_rows = split.select(
        "key", F.col("node").alias("b"), F.col("component").alias("cb"), "main", F.col("n").alias("nb"), F.col("bits").alias("sb"), F.col("keys").alias("kb"),
        F.col("fine").alias("fb"),
    )
    once = (F.col("cb") == F.col("main")) | (F.col("a") < F.col("b"))
    near = (F.col("ca") != F.col("cb")) & once & _possible(F.col("na"), F.col("nb"))
    near = near & (_apart(F.col("sa"), F.col("sb")) <= FARTHEST)
    near = near & (F.get(F.array_intersect("ka", "kb"), F.lit(0)) == out["key"])  # in the first bucket they share
    near = near & (_far_apart(F.col("fa"), F.col("fb")) <= FINEST)
    pairs = shuffled(out).join(all_rows, (out["key"] == all_rows["key"]) & near)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _result(sketched: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    named = nodes.select("set_name", "node").join(labels, "node")
    named = named.select("set_name", F.when(F.col("component") < NAMELESS, F.col("component")).alias("__least"))
    joined = sketched.select("doc_id", "n_shingles", "set_name").join(named, "set_name", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("__least")).otherwise(F.col("doc_id"))
    out = joined.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates; columns as given. Rows that repeat a doc_id share its fate."""
    verdict = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(verdict, F.col("doc_id").eqNullSafe(F.col("__gone")), "left_anti")
