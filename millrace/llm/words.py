"""Words of whole texts as Arrow arrays, found by byte class: no Python step per word.

A word is a maximal run of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased.
In UTF-8 every byte of a character beyond ASCII is 0x80 or more, so a table of 256 bytes decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are split at a time; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20

#: The lower-cased byte, or 0 where a byte belongs to no word.
_LETTER = np.zeros(256, np.uint8)
_LETTER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each starts and the last ends; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``text`` takes at most ``limit`` bytes (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = as_bytes(batch["text"])
        row = 0
        while row < batch.num_rows:
            after = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
            yield batch.slice(row, after - row)
            row = after


@dataclass
class Words:
    """Word occurrences of a slice: ``known[code[i]]`` is a word of text ``text[i]``; in order."""

    known: pa.Array
    code: np.ndarray
    text: np.ndarray
    counts: np.ndarray  # words of each text


def split(texts: pa.Array) -> Words:
    data, ends = as_bytes(texts)
    letters = _LETTER[data]
    inside = letters != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < len(data)]
    begins[heads] = inside[heads]  # a word does not go on into the next text
    places = np.flatnonzero(begins)
    taken = np.cumsum(inside)
    letters = letters[inside]
    offsets = np.append(taken[places] - 1, len(letters)).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters)))
    coded = words.dictionary_encode()
    counts = np.diff(np.searchsorted(places, ends))
    text = np.repeat(np.arange(len(texts)), counts)
    return Words(coded.dictionary, coded.indices.to_numpy(), text, counts)
