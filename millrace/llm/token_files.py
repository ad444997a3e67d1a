"""Token files: ids of all documents in ascending doc_id order, in checksummed blocks of a context-mixing range coder.

``write`` deals documents into ranges of doc_id (nulls last, rows that repeat an id by the hash of their text), sorts each
range, encodes the texts, ends each document with an id of its own and writes blocks of about ``BLOCK_IDS`` ids. A block
can be read without any other: it holds its place in the range, the table of its documents, the code of its ids
(``token_coder``) and a CRC-32 of both, and its model starts anew. A document longer than the rest of a block goes on in
the next ones. Blocks are rows of Parquet files, so that Spark's committer writes them to any store and a lost task
writes them again; ``range`` and ``block`` give their order.

``read`` gives the ids back, ``digests`` their counts, places and CRC-32 only; both check every block. The place of a
document among all ids is the sum of the ranges before it (one row a range) plus its place in the range.

Texts are cut at places where the tokenizer's own pattern always cuts, so that an equal stretch is encoded once; a worker
keeps a table of the stretches it met, up to a bound.
Null text is empty, empty text gives the end id alone, and a null doc_id stays null.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from millrace.llm import token_coder
from millrace.llm.common import bound_batches, settle
from millrace.llm.words import as_bytes, slices
from millrace.sources.paths import scratch_folder

BLOCK_IDS = 1 << 21
END = 0
#: Stretches, and ids of stretches, from which on a worker forgets those it met; bytes of text it encodes at a time.
KEPT, KEPT_IDS, SLICE_BYTES = 1_000_000, 6_000_000, 8 << 20

_HEADER = struct.Struct("<4sIIIQQQII")  # magic, vocabulary, documents, bytes of the table, ids, first document, ids before, bytes of the code, CRC-32
_MAGIC = b"IDS1"
BLOCKS = "range int, block int, n_ids long, body binary"


class BrokenBlock(ValueError):
    """A block whose bytes are not those that were written."""


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary(path: str) -> int:
    """One more than the greatest id."""
    return max(tokenizer(path).get_vocab(with_added_tokens=True).values()) + 1


#: Of each byte: begins a visible character (ASCII, or U+00C0 to U+00FF), is one, is a letter, a sign that ends a word, a blank, a
#: line break, a byte that goes on, the first byte of U+00C0 to U+00FF. No sign: the apostrophe, and those of special tokens.
_BEGINS, _VISIBLE, _LETTER, _SIGN, _BLANK, _BREAK, _TAIL, _LATIN = (1 << k for k in range(8))
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _BEGINS | _VISIBLE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] |= _LETTER
_KIND[[ord(c) for c in string.punctuation if c not in "'<|>"]] |= _SIGN
_KIND[0x20], _KIND[0x0A], _KIND[0x80:0xC0], _KIND[0xC3] = _BLANK, _BREAK, _TAIL, _BEGINS | _LATIN


def stretches(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the bytes are cut: at each text, and where the tokenizer's pattern cuts whatever lies around.

    These are the places before a blank, and before and after a line break, between two visible characters (ASCII, or
    U+00C0 to U+00FF), and between a letter of these and a sign.
    """
    if len(data) < 3:
        return np.unique(ends)
    marks = np.zeros(len(data) + 1, bool)
    kind = _KIND.take(data)
    latin = np.zeros(len(data), np.uint8)  # 1 for a byte that ends one of U+00C0 to U+00FF
    latin[1:] = (kind[:-1] >> 7) & (kind[1:] >> 6)
    before, here, after = (kind | latin << 1)[:-2], kind[1:-1], kind[2:]
    seen = ((before >> 1) & after & 1).view(bool)
    breaks = seen & (here & _BREAK != 0)
    marks[1:-2] = seen & (here & (_BLANK | _BREAK) != 0)
    marks[2:-1] |= breaks
    latin[1:] &= (data[1:] != 0x97) & (data[1:] != 0xB7)  # the signs U+00D7, U+00F7 are no letters
    marks[1:-2] |= ((here >> 3) & (kind >> 2 | latin)[:-2] & 1).view(bool)
    marks[ends] = True
    return np.flatnonzero(marks)


#: A stretch that can be told from others by line breaks between them: the pattern cuts before and after each of those.
_PLAIN = r"^ ?[!-~\x{C0}-\x{FF}]([^\n]*[!-~\x{C0}-\x{FF}])?$"


class Encoder:
    """Ids of many texts; remembers the stretches met so far, up to a bound. Stretch 0 is the end of a text."""

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizer(path)
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.first, self.size, self.ids = np.zeros(1, np.int64), np.ones(1, np.int64), np.array([END], np.int32)

    def _learn(self, new: np.ndarray, plain: np.ndarray) -> None:
        """Takes up new stretches, of which the ``plain`` come first."""
        self.known.update(zip(new, range(len(self.known) + 1, len(self.known) + 1 + len(new))))
        texts, odd = new[: plain.sum()].tolist(), new[plain.sum() :].tolist()
        ids, sizes = [], []
        for start in range(0, len(texts), 50):
            coded = self.tokenizer.encode_batch_fast(["\n".join(texts[start : start + 50])], add_special_tokens=False)[0].ids
            coded.append(self.line_break)
            ids.append(np.array(coded, np.int32))
        if ids:
            joined = np.concatenate(ids)
            inside = joined != self.line_break
            if len(joined) - inside.sum() != len(texts):
                raise ValueError("the tokenizer does not cut at line breaks")
            ids, sizes = [joined[inside]], [np.diff(np.flatnonzero(~inside), prepend=-1) - 1]
        for start in range(0, len(odd), 200):
            part = odd[start : start + 200]
            coded = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(coded.ids, np.int32))
            sizes.append(np.bincount(np.array(coded.word_ids, np.int64), minlength=len(part)))
        sizes = np.concatenate(sizes)
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.first, self.size = np.concatenate([self.first, starts]), np.concatenate([self.size, sizes])
        self.ids = np.concatenate([self.ids, *ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each ended by ``END``; number of ids of each text)."""
        data, ends = as_bytes(texts)
        if not len(data):
            return np.full(len(texts), END, np.int32), np.ones(len(texts), np.int64)
        cuts = stretches(data, ends)
        pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        if len(self.known) > KEPT or len(self.ids) > KEPT_IDS:
            self._forget()
        found = pieces.dictionary.to_numpy(zero_copy_only=False)
        place = np.fromiter(map(self.known.get, found, repeat(0)), np.int64, len(found))
        new = np.flatnonzero(place == 0)
        if len(new):
            plain = pc.match_substring_regex(pieces.dictionary.take(pa.array(new)), _PLAIN).to_numpy(zero_copy_only=False)
            new = np.concatenate([new[plain], new[~plain]])
            place[new] = len(self.known) + 1 + np.arange(len(new))
            self._learn(found[new], plain)
        place = place.take(pieces.indices.to_numpy())
        upto = np.searchsorted(cuts[:-1], ends[1:])  # stretches up to the end of each text
        place = np.insert(place, upto, 0)
        size = self.size.take(place)
        ends_of = np.cumsum(size)
        source = np.repeat(self.first.take(place) - (ends_of - size), size)
        source += np.arange(len(source))
        return self.ids.take(source), np.diff(ends_of[upto + np.arange(len(upto))], prepend=0)


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """A worker's encoder: it serves all tasks the worker runs."""
    return Encoder(path)


def pack(ids: np.ndarray, table: np.ndarray, first: int, before: int, size: int) -> bytes:
    """A block: ``table`` has a row (doc_id, ids here, 1 null id + 2 begun earlier + 4 goes on) for each document."""
    listed = zlib.compress(np.ascontiguousarray(table.T).astype("<i8").tobytes(), 1)
    code = token_coder.encode(ids, size)
    head = _HEADER.pack(_MAGIC, size, len(table), len(listed), len(ids), first, before, len(code), zlib.crc32(listed + code))
    return head + listed + code


def unpack(body: bytes) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(ids, table, first document, ids before) of a block."""
    if len(body) < _HEADER.size:
        raise BrokenBlock("a block is shorter than its header")
    magic, size, docs, table_size, n, first, before, code_size, crc = _HEADER.unpack_from(body)
    rest = body[_HEADER.size :]
    if magic != _MAGIC or len(rest) != table_size + code_size or zlib.crc32(rest) != crc:
        raise BrokenBlock("a block differs from its checksum")
    table = np.frombuffer(zlib.decompress(rest[:table_size]), "<i8").reshape(3, docs).T
    return token_coder.decode(rest[table_size:], n, size), table, first, before


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of up to ``SLICE_BYTES`` of text (or one row): what repeats in one is looked up once."""
    held, size = [], 0
    for part in slices(batches, SLICE_BYTES):
        _, ends = as_bytes(part["text"])
        if held and size + ends[-1] > SLICE_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(part)
        size += int(ends[-1])
    if held:
        yield pa.concat_batches(held)


def _writer(path: str, size: int, block_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        encoder = _encoder(path)
        held: list[np.ndarray] = []
        rows: list[list[int]] = []
        count, block, first, before = 0, 0, 0, 0

        def full() -> pa.RecordBatch:
            nonlocal held, rows, count, block, first, before
            body = pack(np.concatenate(held), np.array(rows, np.int64), first, before, size)
            columns = [pa.array([place], pa.int32()), pa.array([block], pa.int32()), pa.array([count], pa.int64()), pa.array([body], pa.binary())]
            first += len(rows) - (rows[-1][2] >= 4)
            before, block = before + count, block + 1
            held, rows, count = [], [], 0
            return pa.RecordBatch.from_arrays(columns, names=["range", "block", "n_ids", "body"])

        for part in _gathered(batches):
            ids, counts = encoder.encode(part["text"])
            at = 0
            for doc, n in zip(part["doc_id"].to_pylist(), counts.tolist()):
                mark, stop = doc is None, at + n
                while stop - at > block_ids - count:
                    room = block_ids - count
                    held.append(ids[at : at + room])
                    rows.append([doc or 0, room, mark | 4])
                    at, count, mark = at + room, count + room, mark & 1 | 2
                    yield full()
                held.append(ids[at:stop])
                rows.append([doc or 0, stop - at, mark])
                at, count = stop, count + stop - at
        if rows:
            yield full()

    return write


def write(docs: DataFrame, folder: str, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Writes the token files of ``docs`` (doc_id, text) to a new ``folder``; ``path`` is the tokenizer's file."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), *order).sortWithinPartitions(*order)
    dealt.mapInArrow(_writer(path, vocabulary(path), block_ids), BLOCKS).write.parquet(folder)


def _blocks(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The blocks, and of each range the ids before it."""
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    sizes = blocks.groupBy("range").agg(F.sum("n_ids").alias("n"))
    earlier = W.partitionBy(F.lit(0)).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    return blocks, sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))


def _pieces(bodies: Iterator[pa.RecordBatch], what: str) -> Iterator[pa.RecordBatch]:
    """Rows (range, doc, doc_id, parted, at, n, and ``ids`` or ``crc``) for each document, or part of one, in a block."""
    for batch in bodies:
        for place, body in zip(batch["range"].to_pylist(), batch["body"]):
            ids, table, first, before = unpack(body.as_py())
            ends = np.append(0, np.cumsum(table[:, 1]))
            rows = len(table)
            if what == "ids":
                last = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            else:
                plain = ids.astype("<u4")
                last = pa.array([zlib.crc32(plain[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())
            columns = [
                pa.array(np.full(rows, place), pa.int32()), pa.array(first + np.arange(rows), pa.int64()),
                pa.array(table[:, 0], pa.int64(), mask=table[:, 2] & 1 == 1), pa.array(table[:, 2] >= 2),
                pa.array(before + ends[:-1], pa.int64()), pa.array(table[:, 1], pa.int64()), last,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["range", "doc", "doc_id", "parted", "at", "n", what])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids): each document's ids, its end id included, and the number of ids before it."""
    blocks, offsets = _blocks(spark, folder)
    pieces = blocks.select("range", "body").mapInArrow(
        lambda rows: _pieces(rows, "ids"), "range int, doc long, doc_id long, parted boolean, at long, n long, ids array<int>"
    )
    whole = pieces.groupBy("range", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("parts")
    )
    ids = F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")
    # at most one row a range
    return whole.join(F.broadcast(offsets), "range").select("doc_id", (F.col("offset") + F.col("at")).alias("start"), ids)


@F.pandas_udf(LongType())
def _joined_crc(parts: pd.Series) -> pd.Series:
    """CRC-32 of parts one after another: a CRC carried over zeros differs from one of zeros alone by what came before."""

    def joined(rows) -> int:
        crc = 0
        for row in sorted(rows, key=lambda r: r["at"]):
            zeros = bytes(4 * row["n"])
            crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ row["crc"]
        return crc

    return parts.map(joined)


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the decoded blocks."""
    blocks, offsets = _blocks(spark, folder)
    pieces = blocks.select("range", "body").mapInArrow(
        lambda rows: _pieces(rows, "crc"), "range int, doc long, doc_id long, parted boolean, at long, n long, crc long"
    )
    pieces = settle(pieces, "token-digests")  # narrow; the blocks are decoded once
    whole = pieces.where("NOT parted").select("range", "doc_id", "at", "n", "crc")
    parts = pieces.where("parted").groupBy("range", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n"), F.collect_list(F.struct("at", "n", "crc")).alias("parts")
    )
    whole = whole.union(parts.select("range", "doc_id", "at", "n", _joined_crc("parts").alias("crc")))
    # at most one row a range
    return whole.join(F.broadcast(offsets), "range").select(
        "doc_id", (F.col("offset") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``digests`` of the files that ``write`` makes of ``docs``, in a new scratch folder."""
    folder = scratch_folder(docs.sparkSession, "token-files")
    write(docs, folder, path)
    return digests(docs.sparkSession, folder)
