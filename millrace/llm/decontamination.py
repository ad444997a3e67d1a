"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are reduced to lower-cased runs of letters and digits with one blank between them. An item
of ``n`` characters may occur with up to ``floor(n * ERROR_RATE)`` = k edits. It is split into k + 1 pieces: in any
such occurrence at least one piece is untouched, so an automaton over all pieces finds every candidate place. Around
each hit Myers' bit-parallel distance decides.

The test set goes out in blocks of bounded size, each scanned against all documents; documents are not shuffled.

Null, empty or wordless texts and items match nothing. Repeated items are reported for each of their ids; rows that
repeat a document are each reported. A null item_id or doc_id is carried through.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches

ERROR_RATE = 0.06
#: Characters of test items in one block, on average; blocks are cut by hash.
BLOCK_CHARS = 4_000_000

_TOKEN = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    """Lower-cased tokens between single blanks, with a blank at either end; empty without tokens."""
    tokens = " ".join(_TOKEN.findall(text or "")).lower()
    return f" {tokens} " if tokens else ""


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): the item cut into errors + 1 pieces of nearly equal length."""
    cuts = [i * len(item) // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """One test item: its bit masks, its budget, and Myers' distance against a stretch of text."""

    def __init__(self, item: str, rate: float) -> None:
        self.item, self.size = item, len(item)
        self.budget = int(self.size * rate)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(fewest edits, end) over all substrings of ``text``; the first end among equals."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score, least = full, 0, self.size, (self.size, 0)
        for end, c in enumerate(text, 1):
            same = self.masks.get(c, 0)
            across = same | down
            same |= (((same & up) + up) ^ up) & full
            rise = (down | ~(same | up)) & full
            fall = up & same
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
            rise, fall = rise << 1 & full, fall << 1 & full
            up, down = fall | (~(across | rise) & full), rise & across
            if score < least[0]:
                least = (score, end)
        return least


@lru_cache(maxsize=2)
def _prepared(items: tuple[str, ...], rate: float):
    patterns = [Pattern(item, rate) for item in items]
    found: dict[str, list[tuple[int, int]]] = {}
    for number, pattern in enumerate(patterns):
        for offset, piece in pieces(pattern.item, pattern.budget):
            found.setdefault(piece, []).append((number, offset))
    automaton = ahocorasick.Automaton()
    for piece, places in found.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    return patterns, automaton


def occurrences(text: str, patterns, automaton) -> list[tuple[int, int, int, int]]:
    """(item number, edits, start, end) in the normalised text; one per stretch of overlapping candidates."""
    starts: dict[int, set[int]] = {}
    for last, (size, places) in automaton.iter(text):
        for number, offset in places:
            starts.setdefault(number, set()).add(last - size + 1 - offset - patterns[number].budget)
    out = []
    for number, found in starts.items():
        pattern, reached = patterns[number], -1
        spans: list[list[int]] = []
        for start in sorted(found):  # hits of later pieces may open earlier windows
            if not spans or start - spans[-1][0] > 2 * pattern.budget:
                spans.append([start, 0])
            spans[-1][1] = start + pattern.size + 2 * pattern.budget
        for start, end in spans:
            start, end = max(0, start), min(len(text), end)
            edits, stop = pattern.best(text[start:end])
            if edits <= pattern.budget and start + stop > reached:
                reached = start + stop
                out.append((number, edits, max(0, reached - pattern.size), reached))
    return out


def _spans(text: str, found: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Where matches of the normalised text lie in the text itself (whole tokens)."""
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    starts = list(accumulate((len(text[a:b].lower()) + 1 for a, b in tokens), initial=1))
    at = lambda place: max(0, min(len(tokens) - 1, bisect_right(starts, place) - 1))
    return [(tokens[at(a + 1)][0], tokens[at(max(a, b - 2))][1]) for _, _, a, b in found]


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, start, end): where a document holds a test item with at most its budget of edits.

    ``start`` and ``end`` (exclusive) are code points of the whole text.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where(F.col("text").isNotNull())
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = total // block_chars + 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        known = [(r.item_id, normal(r.text)) for r in part.orderBy("item_id", "text").collect()]
        known = [(i, t) for i, t in known if t]
        found = rows.mapInArrow(_scanner(spark.sparkContext.broadcast(known), rate), "doc_id long, item_id long, edits int, start int, end int")
        out = found if out is None else out.union(found)
    return out


def _scanner(shared, rate: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        patterns, automaton = _prepared(tuple(t for _, t in known), rate)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()) if known else ():
                plain = normal(text)
                found = occurrences(plain, patterns, automaton) if plain else []
                if found:
                    for (number, edits, _, _), (a, b) in zip(found, _spans(text, found)):
                        rows.append((doc, known[number][0], edits, a, b))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "edits", "start", "end"]
            )

    return scan


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item; columns as given. Rows that repeat a doc_id share its fate."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__bad")), "left_anti")
