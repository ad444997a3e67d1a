"""Ranked lexical search of all documents for a set of query items, by presence masks.

Documents are reduced once to a narrow index: of each its length in terms and its counts of those terms that some item
asks for. The index is settled in the shared folder; numbers of documents and lengths come from the whole of it. Then
every task walks over slices of the index. In a slice each asked term has a bitmap of the documents that hold it. The
bitmaps of one item's terms, laid side by side, give each document its mask of matched terms, and documents with one
mask form a group. No document of a group can score above the sum, over the mask, of the best share any document of
the slice gets from the term. Groups are evaluated by descending bound, until the bound lies below the ``k`` highest
scores the task already has: then every other document is safely out. A task keeps ``k`` documents an item, and the
best ``k`` of all tasks are the result.

Nothing is shuffled but those; texts are read once for each block of items. Items go out in blocks of bounded size, each
settled before the next is collected. Terms are runs of ASCII letters and digits and of all characters beyond ASCII;
A-Z are lower-cased. Null, empty and termless texts are found by nothing, null and termless items find nothing. Repeated
rows of documents are ranked each; a repeated item_id is answered once for each of its rows. Documents with a null id
come after all others of the same score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, settle
from millrace.llm.words import slices, split

#: Documents returned for an item.
BEST = 50
#: Characters of items in one block, on average; blocks are cut by hash.
BLOCK_CHARS = 200_000
#: Cells (asked term, document) a task lays out at a time, and documents evaluated in the first round of an item.
CELLS, ROUND = 6_000_000, 64


def _asked(items: pa.Table) -> tuple[pa.Array, list[tuple[int | None, np.ndarray]]]:
    """The distinct terms of a block of items, and (item_id, numbers of its terms) of each item with terms."""
    words = split(items["text"].combine_chunks())
    asked = []
    ends = np.append(0, np.cumsum(words.counts))
    for row, item in enumerate(items["item_id"].to_pylist()):
        codes = np.unique(words.code[ends[row] : ends[row + 1]])
        if len(codes):
            asked.append((item, codes.astype(np.int64)))
    return words.known, asked


def _indexer(shared):
    """(doc_id, n, terms, counts) of each document with terms: length, and the asked terms with their counts."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value[0]
        for part in slices(batches):
            words = split(part["text"])
            number = pc.fill_null(pc.index_in(words.known, value_set=terms), -1).to_numpy().astype(np.int64)[words.code]
            wanted = number >= 0
            keys = pa.array(words.text[wanted] * max(1, len(terms)) + number[wanted]).dictionary_encode()
            counts = np.bincount(keys.indices.to_numpy(), minlength=len(keys.dictionary))
            keys = keys.dictionary.to_numpy()
            order = np.argsort(keys, kind="stable")
            text, number = np.divmod(keys[order], max(1, len(terms)))
            ends = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)), pa.int32())
            columns = [
                pa.array(part["doc_id"], pa.int64()), pa.array(words.counts, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(number, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(counts[order], pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    return index


class Found:
    """The best documents of one item so far: highest score first, equal scores by doc_id."""

    def __init__(self, best: int) -> None:
        self.best, self.scores, self.docs, self.named = best, *[np.empty(0, np.int64)] * 2, np.empty(0, bool)

    def least(self) -> int:
        """No document under this score can come in."""
        return int(self.scores[-1]) if len(self.scores) == self.best else 1

    def add(self, scores: np.ndarray, docs: np.ndarray, named: np.ndarray) -> None:
        good = scores >= self.least()
        scores = np.concatenate([self.scores, scores[good]])
        docs, named = np.concatenate([self.docs, docs[good]]), np.concatenate([self.named, named[good]])
        order = np.lexsort((docs, ~named, -scores))[: self.best]
        self.scores, self.docs, self.named = scores[order], docs[order], named[order]


def masks_of(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From terms x documents: one document of each distinct mask, and the mask each document has."""
    packed = np.packbits(present, axis=0)
    packed = np.pad(packed, ((0, -len(packed) % 8), (0, 0)))
    words = np.ascontiguousarray(packed.T).view(np.uint64)
    if words.shape[1] == 1:
        _, first, group = np.unique(words[:, 0], return_index=True, return_inverse=True)
    else:
        _, first, group = np.unique(words, axis=0, return_index=True, return_inverse=True)
    return first, group.ravel()


def search_slice(codes: np.ndarray, weights: np.ndarray, impact: np.ndarray, most: np.ndarray, docs, named, found: Found) -> int:
    """Adds to ``found`` what the slice has for one item; returns the number of documents evaluated."""
    holds = impact[codes]
    present = holds > 0
    some = np.flatnonzero(present.any(axis=0))
    if not len(some):
        return 0
    first, group = masks_of(present[:, some])
    bounds = (weights[codes] * most[codes]) @ present[:, some[first]]
    order = np.argsort(-bounds, kind="stable")
    members = np.argsort(group, kind="stable")  # documents by group
    sizes = np.bincount(group, minlength=len(first))
    ends = np.append(0, np.cumsum(sizes))
    reached = np.cumsum(sizes[order])
    at, size, seen = 0, ROUND, 0
    while at < len(order) and bounds[order[at]] >= found.least():
        after = int(np.searchsorted(reached, seen + size)) + 1
        here = order[at:after]
        chosen = np.concatenate([members[ends[g] : ends[g + 1]] for g in here])
        rows = some[chosen]
        scores = weights[codes] @ holds[:, rows].astype(np.int64)
        found.add(scores, docs[rows], named[rows])
        at, size, seen = after, 2 * size, seen + len(rows)
    return seen


def _searcher(shared, best: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, asked, weights, documents, length = shared.value
        found = [Found(best) for _ in asked]
        width = max(64, min(8192, CELLS // max(1, len(terms))))
        for batch in batches:
            for start in range(0, batch.num_rows, width):
                part = batch.slice(start, width)
                size = part.num_rows
                n = part["n"].to_numpy()
                doc = np.repeat(np.arange(size), pc.list_value_length(part["terms"]).to_numpy())
                term, tf = part["terms"].flatten().to_numpy(), part["counts"].flatten().to_numpy()
                m = 50 + (50 * n * documents) // length
                impact = np.zeros((len(terms), size), np.int32)
                impact[term, doc] = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
                most = impact.max(axis=1).astype(np.int64)
                named = part["doc_id"].is_valid().to_numpy(zero_copy_only=False)
                docs = pc.fill_null(part["doc_id"], 0).to_numpy()
                for (_, codes), kept in zip(asked, found):
                    search_slice(codes, weights, impact, most, docs, named, kept)
        for number, ((item, _), kept) in enumerate(zip(asked, found)):
            size = len(kept.scores)
            columns = [
                pa.array([number] * size, pa.int32()), pa.array([item] * size, pa.int64()),
                pa.array(kept.docs, pa.int64(), mask=~kept.named), pa.array(kept.scores, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "item_id", "doc_id", "score"])

    return search


def ranked(docs: DataFrame, items: DataFrame, best: int = BEST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``best`` documents with a score above 0."""
    spark = docs.sparkSession
    bound_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    blocks = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // block_chars + 1
    out = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        terms, asked = _asked(part)
        found = settle(_search_block(rows, terms, asked, best), "search")
        found = found.withColumn("block", F.lit(block))
        out = found if out is None else out.union(found)
    order = W.partitionBy("block", "row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    placed = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return placed.select("item_id", "rank", "doc_id", "score")


def _search_block(rows: DataFrame, terms: pa.Array, asked: list, best: int) -> DataFrame:
    """(row, item_id, doc_id, score): what each task found for a block of items."""
    context = rows.sparkSession.sparkContext
    schema = "doc_id long, n long, terms array<int>, counts array<long>"
    index = settle(rows.mapInArrow(_indexer(context.broadcast((terms,))), schema), "search-index").where("n > 0")
    documents, length = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).first()
    holding = np.zeros(len(terms), np.int64)
    for row in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most one row a term
        holding[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2.0 * documents + 2) / (2.0 * df + 1))) for df in holding], np.int64)
    shared = context.broadcast((terms, asked, weights, documents, length))
    return index.where(F.size("terms") > 0).mapInArrow(_searcher(shared, best), "row int, item_id long, doc_id long, score long")


_TERMS = "list_transform(regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"
SQL = f"""
WITH asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
held AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM (SELECT doc_id, {_TERMS} AS t FROM documents)),
docs AS (SELECT DISTINCT doc_id, n FROM held),
whole AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM docs),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, whole GROUP BY 1),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term), whole GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0) WHERE rank <= {BEST}
"""
